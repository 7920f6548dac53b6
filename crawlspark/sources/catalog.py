"""Signature catalog: load, explode, clean, validate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.functions import patterns
from crawlspark.functions.ambiguity import exponential
from crawlspark.operators.lookup import dense_ids
from crawlspark.schemas import CATALOG_FILE, SIGNATURES


def read_apps(spark: SparkSession, path: str) -> DataFrame:
    """One row per app of a catalog file: ``app_name``, ``signatures``."""
    return _apps(spark.read.schema(CATALOG_FILE).option("multiLine", True).json(path))


def parse_apps(documents: DataFrame, column: str) -> DataFrame:
    """S10 for catalogs that are already a text column."""
    return _apps(documents.select(F.from_json(column, CATALOG_FILE).alias("c")).select("c.apps"))


def parse_signatures(text: Column) -> Column:
    """The signatures of one app from their JSON text."""
    return F.from_json(text, SIGNATURES)


def _apps(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.explode("apps").alias("app_name", "signatures"))


def explode_apps(apps: DataFrame) -> DataFrame:
    """One row per pattern, tags cut off. All kinds of evidence in one pass."""

    def rows(evidence: str, values: Column) -> Column:
        return F.transform(values, lambda p: _entry(evidence, F.lit(None).cast("string"), p))

    headers = F.coalesce(
        F.map_entries("signatures.headers"),
        F.array().cast("array<struct<key:string,value:string>>"),
    )
    entries = F.concat(
        F.transform(headers, lambda h: _entry("headers", h["key"], h["value"])),
        rows("html", patterns.as_list(F.col("signatures.html"))),
        rows("scripts", patterns.as_list(F.col("signatures.script"))),
    )
    return apps.select("app_name", F.explode(entries).alias("entry")).select("app_name", "entry.*")


def _entry(evidence: str, header_name: Column, pattern: Column) -> Column:
    return F.struct(
        F.lit(evidence).alias("evidence"),
        header_name.alias("header_name"),
        patterns.strip_tags(pattern).alias("pattern"),
    )


def _judged(catalog: DataFrame) -> DataFrame:
    pattern = F.col("pattern")
    endless = exponential(pattern, F.col("evidence") == "headers")
    reason = F.when(~patterns.is_valid(pattern), "syntax").when(endless, "backtracking")
    reason = reason.when(endless.isNull(), "not judged")
    return catalog.withColumn("reason", reason)


def valid_patterns(catalog: DataFrame) -> DataFrame:
    """the patterns that compile and cannot take exponential time, each judged on its own (Q7)."""
    return _judged(catalog).where(F.col("pattern").isNotNull() & F.col("reason").isNull()).drop("reason")


def rejected_patterns(catalog: DataFrame) -> DataFrame:
    """the other ones with the ``reason``: ``syntax``, ``backtracking``, or ``not judged`` where it is not known
    whether they can take exponential time."""
    return _judged(catalog).where(F.col("pattern").isNotNull() & F.col("reason").isNotNull())


def union_patterns(catalog: DataFrame) -> DataFrame:
    """one expression per app, kind of evidence and header name that matches where any of its patterns does.

    ``regex`` holds the patterns that can stand beside each other, null if there are none, and ``alone`` the
    others. An app's patterns come together in one row, sorted.
    """
    beside = patterns.can_join(F.col("pattern"))
    held = F.array_sort(F.collect_set(F.when(beside, F.col("pattern"))))
    union = patterns.union(held)
    return catalog.groupBy("app_name", "evidence", "header_name").agg(
        F.when(
            F.size(held) > 0,
            F.when(F.col("evidence") == "headers", patterns.header_regex(union)).otherwise(patterns.body_regex(union)),
        ).alias("regex"),
        F.array_sort(F.collect_set(F.when(~beside, F.col("pattern")))).alias("alone"),
    )


def app_dim(catalog: DataFrame) -> DataFrame:
    """M7: dense ids from 1, in order of the name."""
    return dense_ids(catalog.select("app_name").distinct(), "app_name", "app_id")


def catalog_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A catalog from ``(app_name, evidence, header_name, pattern)`` tuples."""
    fields = [
        T.StructField(name, T.StringType())
        for name in ("app_name", "evidence", "header_name", "pattern")
    ]
    return spark.createDataFrame(rows, T.StructType(fields))
