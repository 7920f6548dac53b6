"""What several operators need: tables, saved intermediates, words, running totals, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlspark.runtime import work_dir

# A word, as Java and Python regular expressions read it; bytes.split() gives the same words
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, read through Spark whatever the store."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage, keeps the rows when executors are lost, and lets Spark plan later joins by the
    true size.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Let no Arrow batch hold more than ``rows`` rows, so that long texts pass in small groups."""
    held = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if held <= 0 or held > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of(ids: Column) -> Column:
    """CRC-32 of the id as text; null counts as an empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary"))


def running_totals(df: DataFrame, order: list[str], values: list[str], purpose: str) -> DataFrame:
    """``df`` with ``<value>_before``: the sum of each value over all rows that come earlier.

    Rows are sorted by range over many tasks, each task sums its range, and the totals of the earlier
    ranges (one row per task) are added. Ties in ``order`` are put in any order. Null sorts first.
    """
    held = saved(
        df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), f"{purpose}-ranges"
    )
    sums = held.groupBy("__range").agg(*(F.sum(v).alias(f"__{v}") for v in values))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "__range", *(F.coalesce(F.sum(f"__{v}").over(earlier), F.lit(0)).alias(f"__{v}") for v in values)
    )
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    kept = df.columns
    return (
        held.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
        .join(offsets, "__range")
        .select(*kept, *((F.col(f"{v}_before") + F.col(f"__{v}")).alias(f"{v}_before") for v in values))
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``; the root is the smallest node it reaches.

    Alternates the large-star and small-star steps: the number of rounds grows with the logarithm of
    the graph, no step pairs the neighbours of a node, and every round is a written table.
    """
    now = saved(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
        "links",
    )
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = saved(
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            "large-star",
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = saved(
            hooked.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "small-star"
        )
        mark = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if mark == state:
            roots = now.select("b").distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
            )
        state = mark
