"""Streams of match facts: repeats dropped, rows held per host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.operators.rollup import CARRIER, SIGNATURE

SALTS = 16


def stream_distinct_signatures(
    facts: DataFrame, delay: str = "60 seconds", time: str = "seen_ts", salts: int = SALTS
) -> DataFrame:
    """Facts without repeats of a signature, known for ``delay`` of event time.

    The time counts from the first sight of a signature, so one that keeps coming is emitted again
    after the delay (Q16); the facts of one crawl share one event time and are deduplicated
    completely. A signature found on very many pages is first reduced in ``salts`` groups.
    """
    timed = facts.withWatermark(time, delay)
    if salts > 1:
        spread = F.xxhash64("page_url", F.spark_partition_id())
        salted = timed.withColumn("_salt", F.pmod(spread, F.lit(salts)))
        timed = salted.dropDuplicatesWithinWatermark([*SIGNATURE, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark(list(SIGNATURE))


def _signature_sessions(facts: DataFrame, gap: str, time: str) -> DataFrame:
    order = F.struct(*CARRIER)
    sessions = facts.groupBy(*SIGNATURE, F.session_window(time, gap).alias("session"))
    found = sessions.agg(F.min(order).alias("first"), F.max(time).alias("last_seen"), F.count("*").alias("matches"))
    return found.select("session", *SIGNATURE, "first.*", "last_seen", "matches")


def stream_signature_sessions(
    facts: DataFrame, gap: str = "60 seconds", delay: str = "60 seconds", time: str = "seen_ts"
) -> DataFrame:
    """T2 where each repeat keeps a signature known: its first match and the number of ``matches``.

    A signature is known until none of it came for ``gap`` of event time, however long that takes (Q16).
    Its row is emitted when the watermark passes that end, so a signature that keeps coming gives one row.
    State is one row per known signature, and tasks combine their rows before the shuffle. What is
    known when finished input ends is in ``open_signature_sessions``.
    """
    return _signature_sessions(facts.withWatermark(time, delay), gap, time)


def open_signature_sessions(
    facts: DataFrame, gap: str = "60 seconds", delay: str = "60 seconds", time: str = "seen_ts"
) -> DataFrame:
    """The rows that ``stream_signature_sessions`` holds back when its input has ended; ``facts`` are the
    same in batch."""
    last = facts.agg((F.max(time) - F.expr(f"interval {delay}")).alias("mark")).first()["mark"]
    mark = F.date_trunc("millisecond", F.lit(last))
    # a filter on the session's end would be moved below the aggregation, to the rows that make it up
    end = F.col("last_seen") + F.expr(f"interval {gap}")
    return _signature_sessions(facts, gap, time).where(end > mark)


def stream_host_rollup(
    facts: DataFrame, hold: str = "60 seconds", delay: str = "60 seconds", time: str = "seen_ts"
) -> DataFrame:
    """One row per host and window of ``hold``, emitted once the watermark passes its end.

    The windows are fixed in time and do not start at a host's first match. The windows that are
    open when finished input ends are those of ``open_host_windows``.
    """
    return _host_windows(facts.withWatermark(time, delay), hold, time)


def open_host_windows(
    facts: DataFrame, hold: str = "60 seconds", delay: str = "60 seconds", time: str = "seen_ts"
) -> DataFrame:
    """The rows that ``stream_host_rollup`` holds back when its input has ended.

    ``facts`` are the same facts in batch. Windows that end after the last watermark were never
    emitted, and none of their facts came too late.
    """
    last = facts.agg(F.max(time) - F.expr(f"interval {delay}")).first()[0]
    held = facts.where(F.window(time, hold)["end"] > F.lit(last))
    return _host_windows(held, hold, time)


def _host_windows(facts: DataFrame, hold: str, time: str) -> DataFrame:
    return (
        facts.groupBy(F.window(time, hold), "fqdn_no_www")
        .agg(
            F.min(F.struct(*CARRIER)).alias("first"),
            F.array_sort(F.collect_set(F.struct("app_name", "app_type"))).alias("name_type_list"),
        )
        .select("window", "fqdn_no_www", "first.*", "name_type_list")
    )
