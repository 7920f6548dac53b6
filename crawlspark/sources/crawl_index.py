"""Columnar crawl index: scan, and materialized selections of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from crawlspark.schemas import CRAWL_INDEX


def read_index(
    spark: SparkSession, root: str, crawls: Sequence[str], subset: str = "warc"
) -> DataFrame:
    """The rows of some crawls. Only the folders of those crawls are read."""
    index = spark.read.schema(CRAWL_INDEX).parquet(root)
    return index.where(F.col("crawl").isin(list(crawls)) & (F.col("subset") == subset))


def materialize(
    df: DataFrame, path: str, fmt: str = "json", partition_by: Sequence[str] = ()
) -> None:
    """Write a query result as files in any format of the session; JSON is gzipped.

    Avro is one once the session has the spark-avro package; Spark says so where it has not.
    """
    _writer(df, fmt).partitionBy(*partition_by).save(path)


def materialize_table(df: DataFrame, table: str, fmt: str = "json") -> None:
    """S7, into the session catalog."""
    _writer(df, fmt).saveAsTable(table)


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    writer = df.write.mode("overwrite").format(fmt.lower())
    return writer.option("compression", "gzip") if fmt.lower() == "json" else writer


def storage_files(df: DataFrame) -> DataFrame:
    """The distinct files behind a table read from files."""
    return df.select(F.col("_metadata.file_path").alias("path")).distinct()
