"""Gridding of repeat-track height measurements with PySpark DataFrames."""

import os

# Spark runs one task a core, and a pool of BLAS threads beside the driver's own can block it.
# Read when numpy is loaded, so this comes before any import of it.
for _name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
    os.environ.setdefault(_name, "1")

from icegrid.session import cut_lineage, scratch_dir, tune  # noqa: E402

__all__ = ["cut_lineage", "scratch_dir", "tune"]
