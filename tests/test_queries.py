"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare, database
from checks import registry


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, db, sf_dir, name):
    # a query without rows on the smallest tables is compared on the next larger ones
    for folder, views in ((sf_dir, db), (sf_dir.replace("0.001", "0.01"), None)):
        state, n, _, note = compare(
            spark, views or database(folder), folder, name, registry.QUERIES[name],
            registry.SQL.get(name)
        )
        assert state in ("ok", "rows"), note
        assert not note, note
        if n:
            break
    assert n > 0, "no rows, so nothing was compared"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ix", "iy", "it", "dzdt", "n"]
    df.collect()


def test_duckdb_is_only_for_checks():
    assert duckdb.__version__
