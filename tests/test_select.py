import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from crawlspark.operators import select_urls

SCHEMA = "url string, warc_filename string, warc_record_offset long, warc_record_length long, crawl string"


def frame(spark, urls):
    return spark.createDataFrame([(u, "f", i, 1, "C") for i, u in enumerate(urls)], SCHEMA)


def some_urls(n=3000):
    """One host holds a third of the rows, many of them copies of one URL."""
    source = random.Random(3)
    paths = ["", "/", "/a", "/b/", "/c/d", "/robots.txt", "/?q=1"]
    urls = []
    for i in range(n):
        host = "hot.com" if i % 3 == 0 else f"h{source.randint(0, 200)}.com"
        www = source.choice(["", "www."])
        tail = source.choice(paths)
        urls.append(f"https://{www}{host}{tail}" if i % 6 else "https://hot.com/same/page")
    return urls


def is_home(url):
    return url.count("/") == 2 or (url.count("/") == 3 and url.endswith("/"))


def brute(urls, cap):
    by_host = defaultdict(list)
    for i, u in enumerate(urls):
        by_host[u.split("/")[2].removeprefix("www.")].append((u, i))
    kept, first = set(), set()
    for rows in by_host.values():
        for rank, entry in enumerate(sorted(rows)):
            if rank < cap:
                first.add(entry)
            if rank < cap or is_home(entry[0]):
                kept.add(entry)
    return first, kept


def pairs(df):
    rows = [(r.url, r.warc_record_offset) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("cap", [1, 3, 50])
@pytest.mark.parametrize("top_list", [1000, 0])
def test_cap(spark, cap, top_list):
    spark.conf.set(select_urls.TOP_LIST_SETTING, top_list)
    urls = some_urls()
    df = frame(spark, urls).repartition(5)
    first, kept = brute(urls, cap)
    assert pairs(select_urls.first_per_domain(df, cap)) == first
    assert pairs(select_urls.cap_per_domain(df, cap)) == kept
    spark.conf.unset(select_urls.TOP_LIST_SETTING)


def test_cap_off(spark):
    df = frame(spark, some_urls(30))
    assert select_urls.cap_per_domain(df, 0) is df


def test_filtered_pages_use_up_the_cap(spark):
    urls = ["https://a.com/?1", "https://a.com/?2", "https://a.com/robots.txt", "https://a.com/z", "https://a.com/"]
    kept = select_urls.root_pages(select_urls.cap_per_domain(frame(spark, urls), 3))
    assert {r.url for r in kept.collect()} == {"https://a.com/"}


def test_only_top_rows_are_shuffled(spark, plan):
    text = plan(select_urls.cap_per_domain(frame(spark, some_urls(30)), 3))
    partial, exchange = text.find("row_number(), 3, Partial"), text.find("Exchange hashpartitioning")
    assert partial > exchange > 0  # printed from the result down to the scan
    assert text.count("Exchange") == 1


def test_counts(spark):
    df = frame(spark, ["https://a.com", "https://www.a.com/x", "https://b.com/x/y", "https://b.com/?q"])
    assert select_urls.count_root_pages(df).collect() == [("C", 2)]
    assert dict(select_urls.count_per_domain(df).collect()) == {"a.com": 2, "b.com": 2}
    assert {r.url for r in select_urls.root_homepages(df).collect()} == {"https://a.com"}


def test_stats(spark):
    urls = some_urls()
    _, kept = brute(urls, 3)
    root = [u for u, _ in kept if "?" not in u and not u.endswith("robots.txt") and (u.count("/") in (2, 3) or (u.count("/") == 4 and u.endswith("/")))]
    row = select_urls.selection_stats(frame(spark, urls), 3).first()
    assert (row.urls_seen, row.urls_skipped_same_domain) == (3000, 3000 - len(kept))
    assert (row.urls_returned, row.returned_percent) == (len(root), 100.0 * len(root) / 3000)
    empty = select_urls.selection_stats(frame(spark, urls).limit(0), 3).first()
    assert tuple(empty) == (0, 0, 0, None)


def test_stats_without_cap(spark):
    urls = ["https://a.com", "https://a.com/x/y", "https://a.com/x", "https://a.com/?q"]
    row = select_urls.selection_stats(frame(spark, urls), 0).first()
    assert tuple(row) == (4, 0, 2, 50.0)
