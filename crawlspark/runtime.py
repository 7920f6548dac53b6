"""Session helpers: the shared work folder and the size checks that guard broadcasts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it stays under both bounds.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# What a Python task gets of whole pages at a time; it holds some copies of it
BATCH_BYTES = 4 * 1024 * 1024
_MAX_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNITS = {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}

# Scans of up to this many splits may be moved to use all cores
SPREAD_MAX_SPLITS = 16


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that the cluster shares (``spark.checkpoint.dir``).

    Only a local session may fall back to a temporary folder, since executors of a cluster could
    not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="crawlspark-")
    return f"{base.rstrip('/')}/crawlspark/{purpose}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Python tasks need it to open a file."""
    if "://" in path or path.startswith("file:"):
        return path
    path = os.path.abspath(path)
    default_fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return default_fs.rstrip("/") + path if "://" in default_fs.rstrip("/") else "file://" + path


def fits_in_memory(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """True if ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes.

    Reads at most ``max_rows + 1`` rows.
    """
    size = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    rows, width = (
        df.select(size.alias("size"))
        .limit(max_rows + 1)
        .agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and width <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it is small; beyond that leave the join to the optimizer."""
    return F.broadcast(df) if fits_in_memory(df, max_rows) else df


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let Arrow batches end at some ``most`` bytes, so that Python tasks hold as much of a table of any size.

    By default a batch holds 10,000 rows, or 64 MB, and tasks hold the more the larger the table is. A
    lower limit of the session stays.
    """
    number, unit = re.fullmatch(r"(\d+)([bkmgtp]?)b?", spark.conf.get(_MAX_BYTES, "64m").strip().lower()).groups()
    if int(number) << _UNITS[unit] > most:
        spark.conf.set(_MAX_BYTES, str(most))


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of a small scan that has fewer splits than the session has cores.

    For work that costs more than moving its rows. Scans of more than a few splits stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits < cores and splits <= SPREAD_MAX_SPLITS else df
