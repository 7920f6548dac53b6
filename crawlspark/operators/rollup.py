"""From match facts to one row per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crawlspark.functions.crawls import process_time, source_tag
from crawlspark.functions.urls import host_no_www
from crawlspark.operators.lookup import with_crawl_epoch
from crawlspark.schemas import HOST_ROLLUP, MATCH_FACT

SIGNATURE = ("fqdn_no_www", "app_name", "app_type")

# Which match of a host comes first (Q5): the earliest, then by URL
CARRIER = ("seen_time_epoch", "page_url", "process_time_epoch", "source")


def to_facts(
    matches: DataFrame, process_epoch: int | None = None, calendar: DataFrame | None = None
) -> DataFrame:
    """Match facts from matches with ``url`` and ``crawl``."""
    tagged = matches.select(
        "crawl",
        process_time(process_epoch).alias("process_time_epoch"),
        source_tag(F.col("crawl")).alias("source"),
        host_no_www(F.col("url")).alias("fqdn_no_www"),
        F.col("url").alias("page_url"),
        "app_type",
        "app_name",
    )
    return with_crawl_epoch(tagged, calendar).select(*MATCH_FACT.fieldNames())


def rollup_hosts(facts: DataFrame) -> DataFrame:
    """One row per host: its first match and its distinct (app, type) pairs, sorted.

    Tasks combine their rows before the shuffle; what a host can grow to is the number of pairs in
    the catalog, however many pages it has.
    """
    rolled = facts.groupBy("fqdn_no_www").agg(
        F.min(F.struct(*CARRIER)).alias("first"),
        F.array_sort(F.collect_set(F.struct("app_name", "app_type"))).alias("name_type_list"),
    )
    return rolled.select("*", "first.*").select(*HOST_ROLLUP.fieldNames())


def first_match_per_host(facts: DataFrame) -> DataFrame:
    """W2."""
    order = F.struct(*CARRIER, "app_name", "app_type")
    first = facts.groupBy("fqdn_no_www").agg(F.min(order).alias("first"))
    return first.select("fqdn_no_www", "first.*")


def distinct_signatures(facts: DataFrame) -> DataFrame:
    """The distinct (host, app, type)."""
    return facts.select(*SIGNATURE).distinct()


def fact_stats(facts: DataFrame) -> DataFrame:
    """One row: matches, hosts, distinct signatures and repeats of one."""
    signatures = facts.groupBy(*SIGNATURE).agg(F.count("*").alias("matches"))
    hosts = signatures.groupBy("fqdn_no_www").agg(
        F.count("*").alias("signatures"), F.sum("matches").alias("matches")
    )
    total = hosts.agg(
        F.count("*").alias("hosts_added"),
        F.coalesce(F.sum("signatures"), F.lit(0)).alias("signatures_new"),
        F.coalesce(F.sum("matches"), F.lit(0)).alias("technologies"),
    )
    return total.withColumn("signatures_repeated", F.col("technologies") - F.col("signatures_new"))


def evidence_stats(facts: DataFrame) -> DataFrame:
    """Matches by kind of evidence and the pages and hosts behind them."""
    pages = facts.groupBy("app_type", "fqdn_no_www", "page_url").agg(F.count("*").alias("n"))
    hosts = pages.groupBy("app_type", "fqdn_no_www").agg(
        F.count("*").alias("pages"), F.sum("n").alias("n")
    )
    return hosts.groupBy("app_type").agg(
        F.sum("n").alias("technologies"),
        F.sum("pages").alias("pages"),
        F.count("*").alias("hosts"),
    )


def observed(df: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """A6 in flight: counters filled in while ``df`` is used, without a second pass."""
    observation = Observation()
    counts = [F.count_if(condition).alias(name) for name, condition in counters.items()]
    return df.observe(observation, F.count("*").alias("rows"), *counts), observation
