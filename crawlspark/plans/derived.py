"""Inputs that the test tables do not hold, derived from them by Spark: URLs, index, archives."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.functions.urls import host_no_www
from crawlspark.plans.sample_catalog import SAMPLE_CATALOG
from crawlspark.runtime import bound_batches, qualified, spread, work_dir
from crawlspark.sources import catalog

CRAWLS = ("CC-MAIN-2020-45", "CC-MAIN-2020-50")
ARCHIVE_BYTES = 256 * 1024 * 1024
ORIGIN = r"^([a-z]+://[^/?#]+)"
FIRST_SEGMENT = r"^[a-z]+://[^/?#]+/([^/?#]+)"
PATH = r"^[a-z]+://[^/?#]+([^?#]*)"
QUERY = r"\?([^#]*)"
RECORD_SCHEMA = (
    "page_id long, url string, warc_filename string, warc_record_offset long, "
    "warc_record_length long, crawl string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages_to_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages for work that reads their whole text."""
    return spread(table(spark, sf_dir, "pages"))


def sample_catalog(spark: SparkSession) -> DataFrame:
    text = spark.range(1).select(F.lit(SAMPLE_CATALOG).alias("text"))
    return catalog.valid_patterns(catalog.explode_apps(catalog.parse_apps(text, "text")))


def with_variants(pages: DataFrame, *keep: str) -> DataFrame:
    """Five URLs per page: its own, its host's root, the first folder, robots.txt, the bare host."""
    origin = F.regexp_extract("url", ORIGIN, 1)
    folder = F.concat(origin, F.lit("/"), F.regexp_extract("url", FIRST_SEGMENT, 1), F.lit("/"))
    variants = F.array(
        F.col("url"),
        F.concat(origin, F.lit("/")),
        folder,
        F.concat(origin, F.lit("/robots.txt")),
        origin,
    )
    return pages.select("page_id", *keep, F.posexplode(variants).alias("variant", "url"))


def as_selected(variants: DataFrame, *keep: str) -> DataFrame:
    """Selected URLs (M2) with the page they come from."""
    crawl = F.when(F.startswith("url", F.lit("https:")), CRAWLS[1]).otherwise(CRAWLS[0])
    return variants.select(
        "page_id",
        "variant",
        *keep,
        "url",
        F.concat(crawl, F.lit("/"), host_no_www(F.col("url")), F.lit(".gz")).alias("warc_filename"),
        (F.col("page_id") * 5 + F.col("variant")).alias("warc_record_offset"),
        F.length("url").cast("long").alias("warc_record_length"),
        crawl.alias("crawl"),
    )


def selected_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_selected(with_variants(table(spark, sf_dir, "pages")))


def crawl_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl index (M1). The registered domain is taken to be the last two labels of the host."""
    urls = selected_urls(spark, sf_dir)
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    return urls.select(
        "page_id",
        "url",
        F.regexp_extract("url", PATH, 1).alias("url_path"),
        F.when(F.contains("url", F.lit("?")), F.regexp_extract("url", QUERY, 1)).alias("url_query"),
        host.alias("url_host_name"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("url_host_registered_domain"),
        "warc_filename",
        "warc_record_offset",
        "warc_record_length",
        "crawl",
        F.when(F.col("variant") == 3, "robotstxt").otherwise("warc").alias("subset"),
    )


def http_payload() -> list:
    """A response for a page: head with a repeated name and a value that holds ``": "``."""
    host = host_no_www(F.col("url"))
    return [
        F.lit("HTTP/1.1 200 OK\r\nServer: first\r\nX-Note: a: b\r\nSet-Cookie: "),
        host,
        F.lit("\r\nX-Powered-CMS: "),
        F.when(F.startswith("url", F.lit("https:")), "bitrix site manager 9").otherwise("none"),
        F.lit("\r\nServer: "),
        F.when(F.startswith(host, F.lit("blog.")), "nginx/1.").otherwise("Apache/2."),
        F.col("page_id").cast("string"),
        F.lit("\r\n\r\n"),
        F.col("html"),
    ]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an HTTP response, head and body."""
    pages = pages_to_search(spark, sf_dir)
    return pages.select("page_id", "url", "html", F.concat(*http_payload()).alias("response"))


def write_archives(records: DataFrame, root: str) -> DataFrame:
    """Write records (``page_id``, ``url``, ``crawl``, ``payload``) to archives below ``root``.

    Gives the index of what was written. A task that runs again writes to files of its own; the
    index, itself written before use, lists the files of the attempt that counted.
    """
    spark = records.sparkSession
    uri = qualified(spark, root)
    bound_batches(spark)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        system.create_dir(folder, recursive=True)
        out, name, at = None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, crawl, payload in batch.itertuples(index=False):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    first = _record("warcinfo", name, b"software: test data\r\n")
                    out.write(first)
                    at += len(first)
                member = _record("response", url, payload)
                out.write(member)
                rows.append((page_id, url, name, at, len(member), crawl))
                at += len(member)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD_SCHEMA.split(", ")])
        if out is not None:
            out.close()

    columns = records.select("page_id", "url", "crawl", "payload")
    columns.mapInPandas(write, RECORD_SCHEMA).write.parquet(f"{root}-index")
    return spark.read.schema(RECORD_SCHEMA).parquet(f"{root}-index")


def _record(kind: str, target: str, content: bytes) -> bytes:
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {target}\r\n"
        f"Content-Length: {len(content)}\r\n\r\n"
    )
    return gzip.compress(head.encode() + content + b"\r\n\r\n", mtime=0)


def archived_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The pages' responses as archives: index of the records, and the folder of the files."""
    root = work_dir(spark, "archives")
    records = responses(spark, sf_dir).select(
        "page_id",
        "url",
        F.lit(CRAWLS[1]).alias("crawl"),
        F.encode("response", "UTF-8").alias("payload"),
    )
    return write_archives(records, root), qualified(spark, root)


def archived_candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The same for all five URLs of every page."""
    root = work_dir(spark, "archives")
    pages = pages_to_search(spark, sf_dir)
    records = as_selected(with_variants(pages, "html"), "html").select(
        "page_id",
        "url",
        "crawl",
        F.encode(F.concat(*http_payload()), "UTF-8").alias("payload"),
    )
    return write_archives(records, root), qualified(spark, root)
