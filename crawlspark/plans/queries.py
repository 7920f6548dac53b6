"""Queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.functions import crawls, emails, patterns, payload, urls
from crawlspark.operators import lookup, match, rollup, select_urls
from crawlspark.operators.emails import emails_by_host, explode_emails
from crawlspark.plans import derived, jobs, oracle
from crawlspark.plans.derived import table
from crawlspark.runtime import spread, work_dir
from crawlspark.schemas import DOMAIN_COUNTS, HOST_ROLLUP, MATCH_FACT
from crawlspark.sources import catalog, crawl_index, run_log, url_files, warc
from crawlspark.streaming import fact_stream, host_hold, url_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CAP = 3
PROCESS_EPOCH = 1_609_459_200
MATCH_COLUMNS = ("page_id", "url", "app_name", "app_type")


def query(sql: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        SQL[run.__name__] = sql
        return run

    return register


def _md5(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


def _joined(pairs: str) -> Column:
    """(app, type) pairs as text."""
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(p["app_name"], F.lit(":"), p["app_type"])), ","
    )


# --- URL functions ---------------------------------------------------------------------------


@query(oracle.FQDN_NO_WWW)
def fqdn_no_www(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.host_no_www(F.col("url")).alias("fqdn_no_www"))


@query(oracle.URL_SHAPE)
def url_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2-F5."""
    url = F.col("url")
    return derived.selected_urls(spark, sf_dir).select(
        "page_id",
        "url",
        urls.slash_count(url).cast("long").alias("slashes"),
        urls.is_root_page(url).alias("root_page"),
        urls.is_homepage(url).alias("homepage"),
        urls.is_robots_file(url).alias("robots_file"),
        urls.has_query(url).alias("has_query"),
    )


@query(oracle.S3_PARTS)
def s3_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F20, on the page URLs with an s3 scheme and as they are."""
    pages = table(spark, sf_dir, "pages")
    paths = F.array(F.regexp_replace("url", "^[a-z]+://", "s3://"), F.col("url"))
    exploded = pages.select("page_id", F.explode(paths).alias("path"))
    return exploded.select(
        "page_id",
        "path",
        urls.storage_bucket(F.col("path")).alias("bucket"),
        urls.storage_key(F.col("path")).alias("key"),
    )


@query(oracle.BYTE_RANGES)
def byte_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15, F16."""
    offset, length = F.col("warc_record_offset"), F.col("warc_record_length")
    return derived.selected_urls(spark, sf_dir).select(
        urls.archive_uri("s3://crawl-data/", F.col("warc_filename")).alias("uri"),
        offset.alias("range_start"),
        urls.byte_range_end(offset, length).alias("range_end"),
    )


# --- selection of URLs -----------------------------------------------------------------------


@query(oracle.INDEX_PARTITION_SCAN)
def index_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One crawl of a partitioned index."""
    root = work_dir(spark, "index")
    index = derived.crawl_index(spark, sf_dir).drop("page_id")
    index.write.partitionBy("crawl", "subset").parquet(root)
    scan = crawl_index.read_index(spark, root, [derived.CRAWLS[1]])
    return scan.select(*select_urls.URL_COLUMNS)


@query(oracle.INDEX_HOMEPAGE_LEVEL1)
def index_homepage_level1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3-P6."""
    index = derived.crawl_index(spark, sf_dir)
    return select_urls.select_root_urls(index.where(F.col("subset") == "warc"))


@query(oracle.INDEX_HOMEPAGE_LEVEL1)
def index_selection_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index to gzipped JSON lines and back."""
    root, out = work_dir(spark, "index"), work_dir(spark, "selected")
    index = derived.crawl_index(spark, sf_dir).drop("page_id")
    index.write.partitionBy("crawl", "subset").parquet(root)
    jobs.index_selection(spark, root, derived.CRAWLS, out)
    return url_files.read_selected(spark, out)


@query(oracle.STORAGE_FILES)
def storage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which crawls the files of a materialized selection belong to."""
    files = crawl_index.storage_files(url_files.read_selected(spark, _materialized(spark, sf_dir)))
    return files.select(F.regexp_extract("path", "crawl_id=([^/]+)/", 1).alias("crawl")).distinct()


@query(oracle.INCREMENTAL_PICKUP)
def incremental_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the rows of files that are not done; those of the first crawl are."""
    root, done = _materialized(spark, sf_dir), work_dir(spark, "done")
    files = url_files.list_files(spark, root)
    url_files.mark_done(files.where(F.contains("path", F.lit(derived.CRAWLS[0]))), done)
    return url_files.read_unseen(spark, root, url_files.read_done(spark, done))[0]


def _materialized(spark: SparkSession, sf_dir: str) -> str:
    """The selected URLs as gzipped JSON lines, a folder per crawl."""
    out = work_dir(spark, "selected")
    selected = derived.selected_urls(spark, sf_dir).select(*select_urls.URL_COLUMNS)
    selected = selected.withColumn("crawl_id", F.col("crawl"))
    crawl_index.materialize(selected, out, "json", ["crawl_id"])
    return out


@query(oracle.UNSEEN_FILES)
def unseen_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per document, done where the document has a label."""

    def paths(name: str) -> DataFrame:
        path = F.concat(F.lit("documents/"), F.col("doc_id"), F.lit(".json.gz"))
        return table(spark, sf_dir, name).select(path.alias("path"))

    return url_files.unseen_files(paths("documents"), paths("labels"))


@query(oracle.ROOT_PAGES)
def root_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7."""
    return select_urls.root_pages(derived.selected_urls(spark, sf_dir)).select("page_id", "url")


@query(oracle.ROOT_HOMEPAGES)
def root_homepages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8."""
    return select_urls.root_homepages(derived.selected_urls(spark, sf_dir)).select("page_id", "url")


@query(oracle.ROOT_PAGE_COUNT)
def root_page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4."""
    return select_urls.count_root_pages(derived.selected_urls(spark, sf_dir))


@query(oracle.ROOT_PAGE_COUNT)
def root_page_count_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3, from files."""
    return jobs.root_page_count(spark, _materialized(spark, sf_dir))


@query(oracle.DOMAIN_COUNTS)
def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5."""
    return select_urls.count_per_domain(derived.selected_urls(spark, sf_dir))


@query(oracle.FIRST_PER_DOMAIN)
def first_per_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1."""
    first = select_urls.first_per_domain(derived.selected_urls(spark, sf_dir), CAP)
    return first.select("page_id", "variant", "url")


@query(oracle.CAPPED_PAGES)
def capped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, P9, P7."""
    capped = select_urls.cap_per_domain(derived.selected_urls(spark, sf_dir), CAP)
    return select_urls.root_pages(capped).select("page_id", "variant", "url")


@query(oracle.CAPPED_RUNS)
def capped_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, W1 over two runs of half the pages each, with a third that fails between them."""
    base = work_dir(spark, "runs")
    selected = derived.selected_urls(spark, sf_dir)
    for half, stopped in ((0, False), (1, True), (1, False)):
        run, version = run_log.begin(spark, base)
        rows = selected.where(F.col("page_id") % 2 == half)
        seen = run_log.read_last(spark, base, "counts", DOMAIN_COUNTS)
        kept = select_urls.cap_per_domain(rows, CAP, seen).select("page_id", "variant", "url")
        kept.write.parquet(run_log.part(base, "kept", run))
        select_urls.counts_with(rows, CAP, seen).write.parquet(run_log.part(base, "counts", run))
        if not stopped:
            run_log.commit(spark, base, run, version)
    return run_log.read(spark, base, "kept", kept.schema).drop("run")


@query(oracle.CAPPED_HOMEPAGES)
def capped_homepages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, P9, P8."""
    capped = select_urls.cap_per_domain(derived.selected_urls(spark, sf_dir), CAP)
    return select_urls.root_homepages(capped).select("page_id", "variant", "url")


@query(oracle.SELECTION_STATS)
def selection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    return select_urls.selection_stats(derived.selected_urls(spark, sf_dir), CAP)


# --- e-mails ---------------------------------------------------------------------------------


@query(oracle.EMAILS_PAGES)
def emails_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14, P10, G3."""
    rows = explode_emails(table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    return rows.withColumn("position", F.col("position").cast("long"))


@query(oracle.EMAILS_DOCUMENTS)
def emails_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14, P10, G3."""
    rows = explode_emails(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return rows.withColumn("position", F.col("position").cast("long"))


@query(oracle.EMAIL_COUNTS)
def email_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14 on every document: also those without an address."""
    found = emails.find_emails(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(found).cast("long").alias("emails")
    )


@query(oracle.EMAILS_BY_HOST)
def emails_of_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4."""
    return emails_by_host(table(spark, sf_dir, "pages"))


# --- catalog ---------------------------------------------------------------------------------


def _part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One app per part: a header pattern, an html pattern, and a list of scripts, one invalid."""
    signatures = F.concat(
        F.lit('{"headers": {"X-Brand": "'),
        F.col("p_brand"),
        F.lit(r'\\;version:\\1"}, "html": "\\('),
        F.col("p_name"),
        F.lit(r'([a-z]+)(?:\\d|[(])\\;confidence:50", "script": ["'),
        F.col("p_type"),
        F.lit(r'\\.js", "a(b'),
        F.col("p_partkey"),
        F.lit('"]}'),
    )
    apps = table(spark, sf_dir, "part").select(
        F.concat_ws("#", "p_name", "p_partkey").alias("app_name"),
        catalog.parse_signatures(signatures).alias("signatures"),
    )
    return catalog.explode_apps(apps)


@query(oracle.CATALOG_PATTERNS)
def catalog_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10, G2, F8, F12, F13, F21."""
    return catalog.valid_patterns(_part_catalog(spark, sf_dir))


@query(oracle.CATALOG_REJECTS)
def catalog_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12."""
    rejected = catalog.rejected_patterns(_part_catalog(spark, sf_dir))
    return rejected.select("app_name", "evidence", "pattern")


@query(oracle.CATALOG_AMBIGUOUS)
def catalog_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """of four patterns of every part, those that may backtrack without end are rejected, the others kept."""
    key = F.col("p_partkey").cast("string")
    shapes = F.array(
        F.concat(F.lit("(x+)+"), key, F.lit("$")),
        F.concat(F.lit("(xy+)+"), key, F.lit("$")),
        F.concat(F.lit("(?:"), F.lower("p_type"), F.lit("\\s*|\\s*)*"), key),
        F.concat(F.lit("(?:[a-z]+ )*"), key),
    )
    apps = spread(table(spark, sf_dir, "part")).select(
        F.concat_ws("#", "p_name", "p_partkey").alias("app_name"), F.explode(shapes).alias("pattern")
    )
    rows = apps.withColumns({"evidence": F.lit("html"), "header_name": F.lit(None).cast("string")})
    rejected = catalog.rejected_patterns(rows).select("app_name", "pattern", "reason")
    return rejected.unionByName(catalog.valid_patterns(rows).select("app_name", "pattern", F.lit("none").alias("reason")))


@query(oracle.CATALOG_UNIONS)
def catalog_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the patterns of each brand's parts as one expression, and the hits of it."""
    rows = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("app_name"),
        F.lit("html").alias("evidence"),
        F.lit(None).cast("string").alias("header_name"),
        F.concat(F.lit("("), F.col("p_name"), F.lit(")[0-9]|"), F.lower("p_type"), F.lit("+#")).alias("pattern"),
    )
    return catalog.union_patterns(rows).select("app_name", "regex", F.size("alone").cast("long").alias("alone"))


@query(oracle.CATALOG_GROUPS)
def catalog_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9, F10, F11."""
    html = _part_catalog(spark, sf_dir).where(F.col("evidence") == "html")
    plain = patterns.non_capturing(F.col("pattern"))
    return html.select(
        "app_name",
        plain.alias("non_capturing"),
        patterns.grouped(plain).alias("grouped"),
        patterns.body_regex(plain).alias("body_regex"),
        patterns.header_regex(plain).alias("header_regex"),
    )


@query(oracle.APP_DIM)
def app_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, J5."""
    return catalog.app_dim(_part_apps(spark, sf_dir))


@query(oracle.APP_IDS)
def app_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5, to the id and back to the name."""
    parts = _part_apps(spark, sf_dir)
    dim = catalog.app_dim(parts)
    ids = lookup.with_app_id(parts, dim).drop("app_name")
    return lookup.with_app_name(ids, dim)


@query(oracle.APP_IDS_KEPT)
def app_ids_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a first catalog stay when a second one is added, and names that neither has get the next."""
    base = work_dir(spark, "app-ids")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", F.col("p_name").alias("app_name"))
    lookup.grow_dim(spark, base, parts.where("p_size <= 10"))
    lookup.grow_dim(spark, base, parts.select(F.col("p_brand").alias("app_name")))
    return lookup.with_kept_app_id(parts, base).select("p_partkey", "app_name", "app_id")


def _part_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("app_name"))


# --- technologies ----------------------------------------------------------------------------


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the header map of their responses."""
    rows = derived.responses(spark, sf_dir)
    return rows.select(
        "page_id", "url", "html", payload.http_headers(F.col("response")).alias("headers")
    )


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all kinds of evidence, by crawl."""
    found = match.match_pages(
        _responses(spark, sf_dir), derived.sample_catalog(spark), headers="headers"
    )
    https = F.startswith("url", F.lit("https:"))
    crawl = F.when(https, derived.CRAWLS[1]).otherwise(derived.CRAWLS[0])
    return rollup.to_facts(found.withColumn("crawl", crawl), PROCESS_EPOCH)


@query(oracle.TECH_HTML)
def tech_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, A3."""
    pages = derived.pages_to_search(spark, sf_dir)
    return match.match_pages(pages, derived.sample_catalog(spark), kinds=["html"])


@query(oracle.TECH_SCRIPTS)
def tech_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, A3."""
    pages = derived.pages_to_search(spark, sf_dir)
    return match.match_pages(pages, derived.sample_catalog(spark), kinds=["scripts"])


@query(oracle.TECH_MANY_SIGNATURES)
def tech_many_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J2 with a large catalog: the links and the track numbers of all pages."""
    pages = derived.pages_to_search(spark, sf_dir).select("page_id", "html")
    return match.match_pages(pages, _many_signatures(pages))


@query(oracle.TECH_REPEATED_PAGES)
def tech_repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: every page twice, against a catalog that travels as many constants."""
    pages = derived.pages_to_search(spark, sf_dir).select("page_id", "html")
    found = match.match_pages(pages.unionByName(pages), _many_signatures(pages), rules_per_share=100)
    return found.groupBy("page_id", "app_name", "app_type").agg(F.count("*").alias("times"))


def _many_signatures(pages: DataFrame) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit(r'<a href="/([^"]+)">'), F.lit(1))
    numbers = F.regexp_extract_all("html", F.lit(r"track\((\d+)\)"), F.lit(1))
    quoted = F.regexp_replace("word", r"([.^$|?*+(){}\[\]\\])", r"\\$1")
    words = pages.select(F.explode(links).alias("word")).distinct()
    calls = pages.select(F.explode(numbers).alias("word")).distinct()
    return words.select(
        F.concat(F.lit("link "), "word").alias("app_name"),
        F.lit("html").alias("evidence"),
        F.lit(None).cast("string").alias("header_name"),
        F.concat(F.lit('<a href="/'), quoted, F.lit('">[^<]+</a>')).alias("pattern"),
    ).unionByName(
        calls.select(
            F.concat(F.lit("track "), "word").alias("app_name"),
            F.lit("scripts").alias("evidence"),
            F.lit(None).cast("string").alias("header_name"),
            F.concat(F.lit(r"track\("), "word", F.lit(r"\);?</script>")).alias("pattern"),
        )
    )


@query(oracle.TECH_LINE_ENDS)
def tech_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchored patterns on pages whose tags end in one of five line ends."""
    ends = F.array(*(F.lit(e) for e in ("\n", "\r", "\r\n", "\x85", "\u2028")))
    end = F.element_at(ends, (F.col("page_id") % 5 + 1).cast("int"))
    body = F.replace("html", F.lit(">"), F.concat(F.lit(">"), end)).alias("html")
    rows = [("Paragraph", "html", None, "^<p>"), ("Text End", "html", None, "</p>$"), ("Page End", "html", None, "</html>$")]
    pages = derived.pages_to_search(spark, sf_dir).select("page_id", body)
    return match.match_pages(pages, catalog.catalog_rows(spark, rows))


@query(oracle.HEADERS_PARSED)
def headers_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, M5."""
    headers = F.explode("headers").alias("header_name", "header_value")
    return _responses(spark, sf_dir).select("page_id", headers)


@query(oracle.TECH_HEADERS)
def tech_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 as a join on the header name."""
    headers = F.explode("headers").alias("header_name", "header_value")
    long = _responses(spark, sf_dir).select("page_id", "url", headers)
    return match.match_headers(long, derived.sample_catalog(spark))


@query(oracle.TECH_FACTS)
def tech_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1-J3, U2, G1, J4, F17, F18, F22."""
    return _facts(spark, sf_dir)


@query(oracle.HOST_APP_TYPES)
def host_app_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, F19."""
    return rollup.distinct_signatures(_facts(spark, sf_dir))


@query(oracle.TECH_BY_HOST)
def tech_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, W2, M9."""
    rolled = rollup.rollup_hosts(_facts(spark, sf_dir))
    return rolled.withColumn("name_type_list", _joined("name_type_list"))


@query(oracle.FIRST_MATCHES)
def first_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2."""
    return rollup.first_match_per_host(_facts(spark, sf_dir))


@query(oracle.FACT_STATS)
def fact_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    return rollup.fact_stats(_facts(spark, sf_dir))


@query(oracle.EVIDENCE_STATS)
def evidence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    return rollup.evidence_stats(_facts(spark, sf_dir))


@query(oracle.EXTRACT_FINDINGS)
def extract_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1."""
    technologies = match.technology_extractor(derived.sample_catalog(spark))
    pages = derived.pages_to_search(spark, sf_dir)
    return match.extract(pages, [technologies, match.email_extractor()])


@query(oracle.TECH_BY_HOST)
def rolled_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host rows written as rolled JSON lines and read back."""
    out = work_dir(spark, "technologies")
    url_files.write_rolled(rollup.rollup_hosts(_facts(spark, sf_dir)), out, rows_per_file=20)
    rolled = spark.read.schema(HOST_ROLLUP).json(out)
    return rolled.withColumn("name_type_list", _joined("name_type_list"))


# --- crawls ----------------------------------------------------------------------------------


def _crawl_of(date: str) -> Column:
    """Crawl id of the year and the seven-day week of a date."""
    week = F.ceil(F.dayofyear(date) / 7)
    return F.concat(
        F.lit("CC-MAIN-"), F.year(date), F.lit("-"), F.lpad(week.cast("string"), 2, "0")
    ).alias("crawl")


@query(oracle.CRAWL_EPOCH)
def crawl_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17, S11."""
    return lookup.crawl_calendar(table(spark, sf_dir, "orders").select(_crawl_of("o_orderdate")))


@query(oracle.CRAWL_EPOCH_LOOKUP)
def crawl_epoch_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates against a calendar that lists the weeks of the orders by their first key."""
    orders = table(spark, sf_dir, "orders").select(_crawl_of("o_orderdate"), "o_orderkey")
    calendar = orders.groupBy("crawl").agg(F.min("o_orderkey").alias("epoch"))
    shipped = table(spark, sf_dir, "lineitem").select(_crawl_of("l_shipdate"))
    tagged = lookup.with_crawl_epoch(shipped, calendar)
    return tagged.groupBy(
        crawls.source_tag(F.col("crawl")).alias("source"), "seen_time_epoch"
    ).agg(F.count("*").alias("items"))


# --- JSON ------------------------------------------------------------------------------------


@query(oracle.JSON_ROWS)
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F21."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k long")["k"].alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("line"),
    )


# --- archives --------------------------------------------------------------------------------


@query(oracle.DECODE_BYTES)
def decode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as UTF-8 bytes, and the same with a byte that makes them ISO-8859-1."""
    utf8 = F.encode("html", "UTF-8")
    raws = F.array(utf8, F.concat(utf8, F.lit(b"\xe9")))
    raw = table(spark, sf_dir, "pages").select("page_id", F.explode(raws).alias("raw"))
    text = payload.decode_payload(F.col("raw"))
    return raw.select(
        "page_id",
        payload.is_utf8(F.col("raw")).alias("utf8"),
        F.length(text).cast("long").alias("chars"),
        _md5(text).alias("text_md5"),
    )


@query(oracle.WARC_RANGE_READ)
def warc_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, F6."""
    index, uri = derived.archived_pages(spark, sf_dir)
    texts = warc.page_texts(warc.read_records(index, uri))
    return texts.select("page_id", "url", _md5(F.col("text")).alias("text_md5"))


@query(oracle.WARC_ARCHIVE_SCAN)
def warc_archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All archives, each in many small ranges."""
    index, uri = derived.archived_pages(spark, sf_dir)
    name = F.element_at(F.split("path", "/"), -1).alias("warc_filename")
    files = url_files.list_files(spark, uri).select("path", "length", name)
    written = files.join(index.select("warc_filename").distinct(), "warc_filename", "left_semi")
    records = warc.scan_archives(written, split_bytes=64 * 1024)
    return records.where(F.col("warc_type") == "response").select(
        F.col("target_uri").alias("url"),
        F.col("http_status").cast("long").alias("http_status"),
        F.md5("payload").alias("payload_md5"),
    )


@query(oracle.FETCH_OUTCOMES)
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record as it is, cut short, and in a file that is not there."""
    index, uri = derived.archived_pages(spark, sf_dir)
    short = index.withColumn("warc_record_length", F.col("warc_record_length") - 10)
    missing = index.withColumn("warc_filename", F.lit("missing.warc.gz"))
    records = warc.read_records(index.unionByName(short).unionByName(missing), uri)
    return records.groupBy("page_id").agg(
        F.count_if(F.col("error").isNull()).alias("read"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


@query(oracle.TECHNOLOGY_SCAN_JOB)
def technology_scan_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: index rows and archives to one line per host."""
    index, uri = derived.archived_candidates(spark, sf_dir)
    out = work_dir(spark, "technologies")
    jobs.technology_scan(
        index.drop("page_id"),
        uri,
        derived.sample_catalog(spark),
        out,
        cap=CAP,
        process_epoch=PROCESS_EPOCH,
    )
    rolled = spark.read.schema(HOST_ROLLUP).json(out)
    return rolled.withColumn("name_type_list", _joined("name_type_list"))


@query(oracle.SCAN_REJECTS)
def scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job and a stream report of records that are cut short or not there."""
    index, uri = derived.archived_pages(spark, sf_dir)
    third = F.col("page_id") % 3
    urls_of = F.concat(F.regexp_extract("url", derived.ORIGIN, 1), F.lit("/"), "page_id")
    broken = index.select(
        urls_of.alias("url"),
        F.when(third == 1, "missing.warc.gz").otherwise(F.col("warc_filename")).alias("warc_filename"),
        "warc_record_offset",
        (F.col("warc_record_length") - F.when(third == 0, 10).otherwise(0)).alias("warc_record_length"),
        "crawl",
    )
    root, out = work_dir(spark, "selected"), work_dir(spark, "rejected")
    crawl_index.materialize(broken, root)
    rules = derived.sample_catalog(spark)
    jobs.technology_scan_unseen(spark, root, uri, rules, f"{out}-batch", cap=0)
    running = jobs.technology_stream(
        url_stream.stream_selected(spark, root), uri, rules, f"{out}-stream", f"{out}-checkpoint", cap=0
    )
    running.awaitTermination()

    def rejects(rows: DataFrame, via: str) -> DataFrame:
        return rows.select("url", F.substring_index("error", ":", 1).alias("reason"), F.lit(via).alias("via"))

    schema = T.StructType().add("url", "string").add("error", "string")
    batch = run_log.read(spark, f"{out}-batch", "rejects", schema, "json")
    streamed = spark.read.schema(schema).json(jobs.rejects_of(f"{out}-stream"))
    return rejects(batch, "batch").unionByName(rejects(streamed, "stream"))


# --- streams ---------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def _run(stream: DataFrame) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    spark, out = stream.sparkSession, work_dir(stream.sparkSession, "stream")
    running = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query(oracle.SELECTED_URLS)
def stream_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T5."""
    return _run(url_stream.stream_selected(spark, _materialized(spark, sf_dir), 1))


@query(oracle.CAPPED_PAGES)
def stream_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4."""
    selected = derived.as_selected(derived.with_variants(_stream(spark, sf_dir, "pages")))
    capped = url_stream.stream_cap_per_domain(selected, CAP)
    return _run(select_urls.root_pages(capped).select("page_id", "variant", "url"))


@query(oracle.TECHNOLOGY_SCAN_JOB)
def stream_technology_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 as a stream, then A1."""
    index, uri = derived.archived_candidates(spark, sf_dir)
    root, out = work_dir(spark, "selected"), work_dir(spark, "facts")
    crawl_index.materialize(index.select(*select_urls.URL_COLUMNS), root)
    running = jobs.technology_stream(
        url_stream.stream_selected(spark, root),
        uri,
        derived.sample_catalog(spark),
        out,
        f"{out}-checkpoint",
        cap=CAP,
        process_epoch=PROCESS_EPOCH,
    )
    running.awaitTermination()
    rolled = rollup.rollup_hosts(spark.read.schema(MATCH_FACT).json(out))
    return rolled.withColumn("name_type_list", _joined("name_type_list"))


@query(oracle.STREAM_SCAN_COUNTERS)
def stream_scan_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 on the stream of B2: its counters, over all triggers of two runs with a restart between them."""
    index, uri = derived.archived_candidates(spark, sf_dir)
    root, out = work_dir(spark, "selected"), work_dir(spark, "facts")
    for some in (F.startswith("url", F.lit("https:")), ~F.startswith("url", F.lit("https:"))):
        crawl_index.materialize(index.where(some).select(*select_urls.URL_COLUMNS), f"{root}/{uuid.uuid4().hex}")
        running = jobs.technology_stream(
            url_stream.stream_selected(spark, root),
            uri,
            derived.sample_catalog(spark),
            out,
            f"{out}-checkpoint",
            cap=0,
            process_epoch=PROCESS_EPOCH,
        )
        running.awaitTermination()
    return jobs.stream_counters(spark, out).agg(
        F.sum("fetched").alias("fetched"), F.sum("failed").alias("failed"), F.sum("facts").alias("facts")
    )


@query(oracle.HOST_APP_TYPES)
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within one crawl, whose facts share an event time, complete."""
    pages = _stream(spark, sf_dir, "pages")
    headers = payload.http_headers(F.concat(*derived.http_payload()))
    rows = pages.select("url", "html", headers.alias("headers"))
    found = match.match_pages(rows, derived.sample_catalog(spark), headers="headers")
    facts = rollup.to_facts(found.withColumn("crawl", F.lit(derived.CRAWLS[1])), PROCESS_EPOCH)
    timed = facts.withColumn("seen_ts", F.timestamp_seconds("seen_time_epoch"))
    return _run(fact_stream.stream_distinct_signatures(timed).select(*rollup.SIGNATURE))


def _event_facts(events: DataFrame) -> DataFrame:
    """Events as match facts of their users."""
    epoch = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    return events.select(
        F.floor(epoch / 1_000_000).alias("seen_time_epoch"),
        F.lit(PROCESS_EPOCH).cast("long").alias("process_time_epoch"),
        F.lit("events").alias("source"),
        F.concat(F.lit("user-"), "user_id").alias("fqdn_no_www"),
        F.concat(F.lit("event-"), "event_id").alias("page_url"),
        F.lit("html").alias("app_type"),
        F.col("event_type").alias("app_name"),
        F.timestamp_micros(epoch).alias("seen_ts"),
    )


@query(oracle.STREAM_HOST_WINDOW)
def stream_host_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as facts of their users, held for a day, and what is held when they end."""
    rolled = (
        F.unix_seconds("window.start").alias("window_start"),
        "fqdn_no_www",
        "seen_time_epoch",
        "page_url",
        _joined("name_type_list").alias("name_type_list"),
    )
    events = _event_facts(_stream(spark, sf_dir, "events"))
    emitted = _run(fact_stream.stream_host_rollup(events, hold="1 day").select(*rolled))
    still_open = fact_stream.open_host_windows(_event_facts(table(spark, sf_dir, "events")), hold="1 day")
    return emitted.unionByName(still_open.select(*rolled))


@query(oracle.STREAM_HOST_HOLD)
def stream_host_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as facts of their users, held for a day from a user's first on, and what is held when they end."""
    rolled = (
        F.unix_micros("hold_start").alias("hold_start"),
        "fqdn_no_www",
        "seen_time_epoch",
        "page_url",
        _joined("name_type_list").alias("name_type_list"),
    )
    events = _event_facts(_stream(spark, sf_dir, "events"))
    users = table(spark, sf_dir, "events").select("user_id").distinct().count()
    emitted = _run(host_hold.stream_host_hold(events, hold="1 day", max_hosts=64 * max(1, users)).select(*rolled))
    still_open = host_hold.open_host_holds(_event_facts(table(spark, sf_dir, "events")), hold="1 day")
    return emitted.unionByName(still_open.select(*rolled))


@query(oracle.STREAM_SESSIONS)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as facts of their users; a repeat within two days keeps a signature known."""
    rows = (
        F.unix_micros("session.end").alias("known_until"),
        *rollup.SIGNATURE[:2],
        "seen_time_epoch",
        "page_url",
        "matches",
    )
    events = _event_facts(_stream(spark, sf_dir, "events"))
    emitted = _run(fact_stream.stream_signature_sessions(events, gap="2 days").select(*rows))
    known = fact_stream.open_signature_sessions(_event_facts(table(spark, sf_dir, "events")), gap="2 days")
    return emitted.unionByName(known.select(*rows))
