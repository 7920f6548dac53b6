"""Runs whose results, files read and counters become visible together.

A run writes each of its tables to ``<base>/<kind>/run=<id>`` and, last of all, one small file
``<base>/commits/<version>``. Readers take the runs that a commit names and nothing else, so a run that
stops before leaves no results and no marks. The next version can be created once: of two runs that
began at the same commit one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMIT = "version long, run string"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def commits(spark: SparkSession, base: str) -> DataFrame:
    """``version, run`` of all runs that were committed."""
    if not _exists(spark, f"{base}/commits"):
        return spark.createDataFrame([], _COMMIT)
    # a commit that is being written has no run yet
    return spark.read.schema(_COMMIT).json(f"{base}/commits").where("run is not null")


def begin(spark: SparkSession, base: str) -> tuple[str, int]:
    """A new run: its id, and the version that it will commit."""
    last = commits(spark, base).agg(F.max("version")).first()[0]
    return uuid.uuid4().hex, 1 if last is None else last + 1


def part(base: str, kind: str, run: str) -> str:
    """Where a run writes one of its tables."""
    return f"{base.rstrip('/')}/{kind}/run={run}"


def commit(spark: SparkSession, base: str, run: str, version: int) -> None:
    """Make the tables of a run visible, if no other run has committed this version."""
    system, place = _file_system(spark, f"{base.rstrip('/')}/commits/{version:010d}.json")
    if system.exists(place):
        raise RuntimeError(f"version {version} of {base} is another run's: run again")
    out = system.create(place, False)
    try:
        out.write(bytearray(json.dumps({"version": version, "run": run}) + "\n", "utf-8"))
    finally:
        out.close()


def read(spark: SparkSession, base: str, kind: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of all committed runs, and the ``run``. Only their folders are read."""
    whole = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    if not _exists(spark, f"{base}/{kind}"):
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).format(fmt).load(f"{base}/{kind}")
    return rows.join(commits(spark, base).select("run"), "run", "left_semi").select(*whole.names)


def read_last(spark: SparkSession, base: str, kind: str, schema: T.StructType) -> DataFrame:
    """The rows of the run that was committed last: of a table that every run writes anew."""
    last = commits(spark, base).agg(F.max_by("run", "version")).first()[0]
    path = None if last is None else part(base, kind, last)
    if path is None or not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
