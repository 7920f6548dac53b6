"""End-to-end jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlspark.functions.payload import decode_payload, http_body, http_headers
from crawlspark.operators.emails import emails_by_host
from crawlspark.operators.match import technologies
from crawlspark.operators.rollup import observed, rollup_hosts, to_facts
from crawlspark.operators.select_urls import (
    URL_COLUMNS,
    cap_per_domain,
    count_root_pages,
    counts_with,
    root_pages,
    select_root_urls,
)
from crawlspark.runtime import work_dir
from crawlspark.schemas import DOMAIN_COUNTS, DONE_FILES, STREAM_COUNTERS
from crawlspark.sources import run_log
from crawlspark.sources.crawl_index import materialize, read_index
from crawlspark.sources.url_files import read_selected, read_unseen, write_rolled
from crawlspark.sources.warc import failed_records, read_records
from crawlspark.streaming.url_stream import stream_cap_per_domain

DEFAULT_CAP = 3


def index_selection(
    spark: SparkSession, index_root: str, crawls: Sequence[str], out: str, fmt: str = "json"
) -> None:
    """B1: homepages and level-1 pages of some crawls, written as files, a folder per crawl."""
    chosen = select_root_urls(read_index(spark, index_root, crawls))
    # the crawl stays a column of the files, as their readers expect it there
    materialize(chosen.withColumn("crawl_id", F.col("crawl")), out, fmt, partition_by=["crawl_id"])


def technology_findings(
    wanted: DataFrame,
    archive_uri: str,
    catalog: DataFrame,
    scan_scope: str = "body",
    partitions: int | None = None,
) -> DataFrame:
    """Every selected URL with the technologies ``found`` in its page, or the ``error`` of its fetch.

    Each page is fetched and read once for all kinds of evidence. ``scan_scope`` is ``body`` or
    ``full`` (HTTP head and body, Q20).
    """
    if scan_scope not in ("body", "full"):
        raise ValueError(f"unknown scan scope {scan_scope!r}; expected body or full")
    text = decode_payload(F.col("payload"))
    # without a payload there is no text, and nothing is found
    pages = read_records(wanted, archive_uri, partitions).select(
        *URL_COLUMNS,
        "error",
        (http_body(text) if scan_scope == "body" else text).alias("html"),
        http_headers(text).alias("headers"),
    )
    return technologies(pages, catalog, headers="headers")


def technology_facts(findings: DataFrame, process_epoch: int | None = None) -> DataFrame:
    """The facts of ``technology_findings``."""
    found = findings.select("url", "crawl", F.explode("found").alias("_found"))
    return to_facts(found.select("url", "crawl", "_found.*"), process_epoch)


def rejects_of(out: str) -> str:
    """The folder for failed fetches beside that of the results."""
    return f"{out.rstrip('/')}-rejects"


def counters_of(out: str) -> str:
    """The folder for a stream's counters beside that of the results."""
    return f"{out.rstrip('/')}-counters"


def stream_counters(spark: SparkSession, out: str) -> DataFrame:
    """``trigger, fetched, failed, facts`` of every trigger of the stream that writes to ``out``, while it
    runs and after it."""
    return spark.read.schema(STREAM_COUNTERS).json(counters_of(out))


def _scan(wanted: DataFrame, archive_uri: str, catalog: DataFrame, rejects: str, **options) -> tuple[DataFrame, Observation]:
    """Findings that are fetched and written once, with the failed ones as JSON lines in ``rejects``."""
    findings, counters = observed(
        technology_findings(wanted, archive_uri, catalog, **options), failed=F.col("error").isNotNull()
    )
    path = work_dir(wanted.sparkSession, "findings")
    findings.where(F.col("error").isNotNull() | (F.size("found") > 0)).write.parquet(path)
    written = wanted.sparkSession.read.schema(findings.schema).parquet(path)
    failed_records(written).drop("found").write.mode("overwrite").json(rejects)
    return written, counters


def technology_scan(
    selected: DataFrame,
    archive_uri: str,
    catalog: DataFrame,
    out: str,
    cap: int = DEFAULT_CAP,
    process_epoch: int | None = None,
    seen: DataFrame | None = None,
    rejects: str | None = None,
    **options,
) -> Observation:
    """B2: the technologies of every host of a crawl as JSON lines, and the URLs whose fetch failed,
    with the reason, in ``rejects``, by default ``rejects_of(out)``.

    The cap and the root filter come before the fetch, which is the expensive step. What is found is
    written before it is rolled up, so a lost executor costs no second fetch. ``seen`` are the pages per
    domain of earlier runs, which count toward the cap. The observation counts fetched and failed records.
    """
    wanted = root_pages(cap_per_domain(selected, cap, seen))
    findings, counters = _scan(wanted, archive_uri, catalog, rejects or rejects_of(out), **options)
    write_rolled(rollup_hosts(technology_facts(findings, process_epoch)), out)
    return counters


def technology_scan_unseen(
    spark: SparkSession,
    root: str,
    archive_uri: str,
    catalog: DataFrame,
    base: str,
    cap: int = DEFAULT_CAP,
    **options,
) -> Observation:
    """B2 over the files of selected URLs below ``root`` that no earlier run into ``base`` has read.

    A run writes its ``results``, ``rejects``, the ``files`` it has read and the ``counts`` per domain, and
    commits them together: one that fails leaves none of them and is repeated whole. The cap holds over
    all runs. ``run_log.read`` gives the tables of the committed runs.
    """
    run, version = run_log.begin(spark, base)
    rows, files = read_unseen(spark, root, run_log.read(spark, base, "files", DONE_FILES))
    held = work_dir(spark, "selected")
    rows.write.parquet(held)
    selected = spark.read.schema(rows.schema).parquet(held)
    seen = run_log.read_last(spark, base, "counts", DOMAIN_COUNTS)
    out = {kind: run_log.part(base, kind, run) for kind in ("results", "rejects", "files", "counts")}
    counters = technology_scan(
        selected, archive_uri, catalog, out["results"], cap, seen=seen, rejects=out["rejects"], **options
    )
    files.select("path").write.parquet(out["files"])
    # without a cap nothing is counted, but what earlier runs have counted stays
    (counts_with(selected, cap, seen) if cap else seen).write.parquet(out["counts"])
    run_log.commit(spark, base, run, version)
    return counters


def technology_stream(
    selected: DataFrame,
    archive_uri: str,
    catalog: DataFrame,
    out: str,
    checkpoint: str,
    cap: int = DEFAULT_CAP,
    process_epoch: int | None = None,
    **options,
) -> StreamingQuery:
    """B2 over a stream of selected URLs (T1, T4): match facts as JSON lines, and failed fetches in
    ``rejects_of(out)``.

    A trigger writes to folders of its own and replaces them if it runs again, so every fact is
    written once. The host rows are ``rollup_hosts`` of the facts. What a trigger has fetched, failed to
    fetch and found is counted while it is written, and kept with it: ``stream_counters``.
    """
    spark = selected.sparkSession

    def scan(wanted: DataFrame, number: int) -> None:
        findings, counters = _scan(wanted, archive_uri, catalog, f"{rejects_of(out)}/trigger={number}", **options)
        facts, found = observed(technology_facts(findings, process_epoch))
        facts.write.mode("overwrite").json(f"{out}/trigger={number}")
        fetched = counters.get
        row = (number, fetched["rows"], fetched["failed"], found.get["rows"])
        counts = spark.createDataFrame([row], STREAM_COUNTERS).drop("trigger")
        counts.coalesce(1).write.mode("overwrite").json(f"{counters_of(out)}/trigger={number}")

    return (
        root_pages(stream_cap_per_domain(selected, cap))
        .writeStream.foreachBatch(scan)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def root_page_count(spark: SparkSession, selected_root: str) -> DataFrame:
    """B3."""
    return count_root_pages(read_selected(spark, selected_root))


def email_scan(pages: DataFrame, text: str = "html") -> DataFrame:
    """B4."""
    return emails_by_host(pages, text)
