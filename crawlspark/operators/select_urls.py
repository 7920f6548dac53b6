"""Selection of URLs from the index and of pages per domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.functions import urls
from crawlspark.schemas import SELECTED_URL

URL_COLUMNS = SELECTED_URL.fieldNames()

# The order in which the pages of a domain use up its quota (Q5)
QUOTA_ORDER = ("url", "warc_filename", "warc_record_offset")

# Up to the cap of this setting Spark keeps a top list per task; above it hot domains are salted
TOP_LIST_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64


def no_query(query: Column) -> Column:
    """P3."""
    return query.isNull()


def is_root_path(path: Column) -> Column:
    """Homepage, or a page or folder one level below it."""
    # fixed values, as in the specification
    return (F.length(path) == 0) | (path == "/") | path.rlike(r"^/[^/]+/?$")


def is_index_page(path: Column, url: Column, host: Column, domain: Column) -> Column:
    """P5: index page of a bare host over https, or of a ``www.`` host.

    Beyond P4 this adds ``index.html`` and its kin without a leading slash (Q15).
    """
    extra = F.length(host) - F.length(domain)
    bare_https = (extra == 0) & F.startswith(url, F.lit("https://"))
    www = (extra == 4) & F.startswith(host, F.lit("www."))
    # fixed values, as in the specification
    return path.rlike(r"^/?(?:index\.(?:html?|php))?$") & (bare_https | www)


def select_root_urls(index: DataFrame) -> DataFrame:
    """Homepages and level-1 pages of an index scan."""
    path, host = F.col("url_path"), F.col("url_host_name")
    wanted = is_root_path(path) | is_index_page(
        path, F.col("url"), host, F.col("url_host_registered_domain")
    )
    return index.where(no_query(F.col("url_query")) & wanted).select(*URL_COLUMNS)


def root_pages(df: DataFrame) -> DataFrame:
    """P7."""
    url = F.col("url")
    return df.where(~urls.is_robots_file(url) & ~urls.has_query(url) & urls.is_root_page(url))


def root_homepages(df: DataFrame) -> DataFrame:
    """P8."""
    return df.where(urls.is_homepage(F.col("url")))


def first_per_domain(df: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` pages of every domain.

    Each task keeps only ``cap`` rows per domain before the shuffle, so a domain that holds a
    large part of the rows does not gather in one task.
    """
    keyed = df.withColumn("_host", urls.host_no_www(F.col("url")))
    if cap > int(df.sparkSession.conf.get(TOP_LIST_SETTING)):
        # the task number spreads copies of one row as well
        salt = F.pmod(F.xxhash64(*QUOTA_ORDER, F.spark_partition_id()), F.lit(SALTS))
        salted = keyed.withColumn("_salt", salt)
        keyed = _first(salted, cap, "_host", "_salt").drop("_salt")
    return _first(keyed, cap, "_host").drop("_host")


def _first(df: DataFrame, cap: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(*QUOTA_ORDER)
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= cap).drop("_rank")


def cap_per_domain(df: DataFrame, cap: int, seen: DataFrame | None = None) -> DataFrame:
    """The first ``cap`` pages of every domain and all homepages; 0 keeps everything.

    Homepages count toward the cap but are never dropped, so they need no ranking of their own:
    they are taken from the input as they are, and only the other pages come from the ranking.
    With ``seen``, the ``counts_with`` of earlier runs, the pages of these go first.
    """
    if cap == 0:
        return df
    home = urls.is_homepage(F.col("url"))
    first = first_per_domain(df, cap)
    if seen is not None:
        # what is left of a domain here is at most cap rows
        host = urls.host_no_www(F.col("url"))
        order = Window.partitionBy("_host").orderBy(*QUOTA_ORDER)
        ranked = first.withColumn("_host", host).withColumn("_rank", F.row_number().over(order))
        before = seen.select(F.col("fqdn_no_www").alias("_host"), F.col("pages").alias("_before"))
        place = F.col("_rank") + F.coalesce("_before", F.lit(0))
        first = ranked.join(before, "_host", "left").where(place <= cap).select(*df.columns)
    return first.where(~home).unionByName(df.where(home))


def counts_with(df: DataFrame, cap: int, seen: DataFrame) -> DataFrame:
    """``fqdn_no_www, pages``: the counts of earlier runs, ``seen``, and of ``df`` in one table, up to the cap."""
    both = seen.select("fqdn_no_www", "pages").unionByName(count_per_domain(df))
    # no run needs to know more than that a domain is full
    pages = F.least(F.sum("pages"), F.lit(cap)).cast("long")
    return both.groupBy("fqdn_no_www").agg(pages.alias("pages"))


def count_root_pages(df: DataFrame) -> DataFrame:
    """A4: number of root pages per crawl."""
    return root_pages(df).groupBy("crawl").agg(F.count("*").alias("root_pages"))


def count_per_domain(df: DataFrame) -> DataFrame:
    """A5."""
    host = urls.host_no_www(F.col("url")).alias("fqdn_no_www")
    return df.groupBy(host).agg(F.count("*").alias("pages"))


def selection_stats(df: DataFrame, cap: int) -> DataFrame:
    """One row: URLs seen, skipped by the cap, returned as root pages, and the percentage.

    The homepages, which the cap never drops, are counted together with all URLs.
    """
    url = F.col("url")
    home = urls.is_homepage(url)
    root = ~urls.is_robots_file(url) & ~urls.has_query(url) & urls.is_root_page(url)
    everything = cap == 0
    before = df.agg(
        F.count("*").alias("seen"),
        F.count_if(F.lit(everything) | home).alias("kept"),
        F.count_if(F.lit(everything) & root | home & root).alias("root"),
    )
    others = first_per_domain(df, cap).where(~home)
    after = others.agg(
        F.lit(0).cast("long").alias("seen"),
        F.count("*").alias("kept"),
        F.count_if(root).alias("root"),
    )
    counts = before.unionByName(after).agg(*(F.sum(c).alias(c) for c in before.columns))
    return counts.select(
        F.col("seen").alias("urls_seen"),
        (F.col("seen") - F.col("kept")).alias("urls_skipped_same_domain"),
        F.col("root").alias("urls_returned"),
        F.try_divide(F.lit(100.0) * F.col("root"), F.col("seen")).alias("returned_percent"),
    )
