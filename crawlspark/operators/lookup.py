"""Dictionary lookups as joins.

How a join runs is left to Spark, which knows the sizes once the sides are computed: a small side is
broadcast, and values that many rows share are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlspark.functions.crawls import crawl_epoch
from crawlspark.runtime import work_dir
from crawlspark.schemas import APP_DIM
from crawlspark.sources import run_log


def crawl_calendar(crawls: DataFrame) -> DataFrame:
    """``crawl`` to ``epoch`` for the distinct ids of ``crawls``."""
    ids = crawls.select("crawl").distinct()
    return ids.withColumn("epoch", crawl_epoch(F.col("crawl")))


def with_crawl_epoch(
    df: DataFrame, calendar: DataFrame | None = None, name: str = "seen_time_epoch"
) -> DataFrame:
    """Epoch of the row's ``crawl``: from the calendar if it lists the id, else computed.

    Without a calendar there is no join: the formula gives the listed values as well.
    """
    computed = crawl_epoch(F.col("crawl"))
    if calendar is None:
        return df.withColumn(name, computed)
    listed = calendar.select("crawl", F.col("epoch").alias("_listed"))
    joined = df.join(listed, "crawl", "left")
    return joined.withColumn(name, F.coalesce("_listed", computed)).drop("_listed")


def with_app_id(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Name to id."""
    return df.join(dim, "app_name", "left")


def with_app_name(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Id to name."""
    return df.join(dim, "app_id", "left")


def read_dim(spark: SparkSession, base: str) -> DataFrame:
    """M7: the app dictionary kept below ``base``, as its last commit left it."""
    return run_log.read(spark, base, "ids", APP_DIM).drop("run")


def grow_dim(spark: SparkSession, base: str, names: DataFrame) -> DataFrame:
    """The app dictionary below ``base`` with the ``app_name`` of ``names`` that it lacked.

    New names get the ids after the highest one, in their order; ids once given are never written again.
    New rows become visible by one commit, and of two runs that grow the same state one fails, so no id
    is given twice. Null names get none. Nothing is committed if there is nothing new.
    """
    run, version = run_log.begin(spark, base)
    held = read_dim(spark, base)
    last = held.agg(F.max("app_id")).first()[0] or 0
    new = names.select("app_name").where("app_name is not null").distinct().join(held, "app_name", "left_anti")
    numbered = dense_ids(new, "app_name", "app_id")
    if numbered.isEmpty():
        return held
    ids = numbered.select((F.col("app_id") + F.lit(last)).alias("app_id"), "app_name")
    ids.write.parquet(run_log.part(base, "ids", run))
    run_log.commit(spark, base, run, version)
    return read_dim(spark, base)


def with_kept_app_id(df: DataFrame, base: str) -> DataFrame:
    """J5 with a dictionary that grows: a name seen for the first time gets the next id."""
    return with_app_id(df, grow_dim(df.sparkSession, base, df))


def dense_ids(df: DataFrame, order: str, name: str) -> DataFrame:
    """Number the rows from 1 by ``order``, whose values are distinct.

    The table is sorted across all tasks and written out, whatever its size; the ids are then the
    position in the written part plus the size of the parts before it.
    """
    spark = df.sparkSession
    path = work_dir(spark, "dense-ids")
    # monotonically_increasing_id: part number in the high bits, position in the part in the low
    place = F.monotonically_increasing_id()
    sorted_rows = df.sort(order).withColumn("_place", place)
    sorted_rows.select(
        "*",
        F.shiftright("_place", 33).alias("_part"),
        F.col("_place").bitwiseAND((1 << 33) - 1).alias("_position"),
    ).drop("_place").write.parquet(path)
    written = spark.read.parquet(path)
    # one row per part, so this window is as small as the number of tasks
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written.groupBy("_part").agg(F.count("*").alias("_size"))
    rows_before = F.coalesce(F.sum("_size").over(before), F.lit(0))
    offsets = parts.select("_part", rows_before.alias("_before"))
    return (
        written.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_position") + 1)
        .drop("_part", "_position", "_before")
    )
