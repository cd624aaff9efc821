"""URL filters: rules for hosts and paths, then a list behind a blocked Bloom filter."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.operators.skew import attach, keep
from icegrid.session import cut_lineage

# Listed URLs per block of 8 words of 32 bits, one bit set in each: about 1 in 2000 others pass.
URLS_PER_BLOCK = 16
WORDS = 8
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"

# (verdict, host, path), as in the contract of op9
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ://, or null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(lower_ascii(found), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """host/path?query without scheme, www. or m., tracking parameters, fragment, index page
    and last slash. Null without ://."""
    rest = _rest(url)
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    host = F.regexp_replace(host, r":(?:80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(?:/index)?\.html?$", "")
    path = F.regexp_replace(path, r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|&){TRACKING}", "")
    query = F.regexp_replace(query, r"^&", "")
    return F.when(rest.isNotNull(), F.concat(host, path, F.when(query != "", F.concat(
        F.lit("?"), query)).otherwise(F.lit(""))))


def rule_verdict(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of rule (host and path) and verdict of the longest rule that fits; null if none.

    A rule fits its host and all subdomains if the path starts with the rule's. Of two rules of
    one length the first in the list wins.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"),
                                    F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _bits(url: Column) -> list[Column]:
    """The bit of each of the 8 words, from 5 bits each of a second hash."""
    h = F.xxhash64(url, F.lit(17))
    return [F.pow(F.lit(2.0), F.pmod(F.shiftrightunsigned(h, 5 * k), F.lit(32))).cast("long")
            for k in range(WORDS)]


def bloom_filter(listed: DataFrame, url: str, urls_per_block: int = URLS_PER_BLOCK
                 ) -> tuple[DataFrame, int]:
    """(blocks, their number): a row for each block with keys, and the bits of its 8 words.

    A table, so its size does not matter: Spark sends it to the tasks if it is small and
    shuffles it if not. Runs one job, that counts.
    """
    n = max(1, math.ceil(listed.count() / urls_per_block))
    rows = listed.select(_block(F.col(url), n).alias("block"),
                         *[b.alias(f"w{k}") for k, b in enumerate(_bits(F.col(url)))])
    return rows.groupBy("block").agg(
        *[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)]), n


def _block(url: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(29)), F.lit(n))


def in_list(urls: DataFrame, listed: DataFrame, url: str) -> DataFrame:
    """Distinct values of the column url of urls that are in the same column of listed.

    Each is looked up in its block of the filter; those whose 8 bits are set may be listed, and
    a hash join with the list removes the rest. Nulls are in no list.
    """
    listed = cut_lineage(listed.select(url).where(F.col(url).isNotNull()).distinct())
    blocks, n = bloom_filter(listed, url)
    asked = urls.select(url).where(F.col(url).isNotNull()).distinct()
    asked = asked.withColumn("block", _block(F.col(url), n))
    seen = attach(asked, blocks, ["block"], "inner")
    hit = F.lit(True)
    for k, bit in enumerate(_bits(F.col(url))):
        hit = hit & (F.col(f"w{k}").bitwiseAND(bit) == bit)
    return keep(seen.where(hit).select(url), listed.hint("shuffle_hash"), [url])


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Verdict for the URL of each row: of the longest rule that fits; else block if its
    canonical form is that of a URL in listed (column url), else allow.

    Returns id_col, host, path, rule (null if none fits), canonical (null without ://), listed
    and verdict, one row per row. Null URLs and those without :// have empty host and path and
    are allowed. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"))
    rows = rows.select("id", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"),
                       canonical(F.col("u")).alias("canonical"))
    rows = rows.withColumn("r", rule_verdict(F.col("host"), F.col("path"), rules))
    names = listed.select(canonical(F.col("url")).alias("canonical"))
    found = in_list(rows, names, "canonical").withColumn("listed", F.lit(True))
    out = attach(rows, found, ["canonical"])
    hit = F.coalesce("listed", F.lit(False))
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), "canonical",
        hit.alias("listed"),
        F.coalesce(F.col("r.verdict"), F.when(hit, "block").otherwise("allow")).alias("verdict"),
    )
