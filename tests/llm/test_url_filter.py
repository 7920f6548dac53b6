import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlspark.llm import url_filter
from crawlspark.llm.queries import RULES
from crawlspark.llm.url_filter import Rule

SCHEMA = "page_id long, url string, host string, key string, verdict string"
BY_HAND = [
    ("https://WWW.Example.ORG/en/2", "www.example.org", "/en/2", "org/", "allow"),
    ("http://example.org/en/17?x#y", "example.org", "/en/17", "example.org/en/1", "block"),
    ("http://a.b.example.org/es/", "a.b.example.org", "/es/", "example.org/es/", "block"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://example.com/de/1", "example.com", "/de/1", "com/de/", "block"),
    ("http://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("http://xcom/fr/", "xcom", "/fr/", None, "allow"),
    ("x://y://z/w?q", "y:", "//z/w", None, "allow"),
    ("no scheme/at/all", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://É.net?a=/b", "É.net", "", None, "allow"),
    ("HTTPS://Bad.net:443/x/?utm_source=f&b=2&a=1#t", "bad.net:443", "/x/", None, "block"),
    ("ftp://bad.net/x?a=1&b=2", "bad.net", "/x", None, "block"),
    ("http://bad.net/x?a=1", "bad.net", "/x", None, "allow"),
]


@pytest.mark.parametrize("blocks", [1, 2**18])
def test_verdicts(frame, blocks):
    listed = frame([("http://bad.net/x?b=2&a=1",), (None,), ("nothing",), ("http://bad.net/x?b=2&a=1",)], "url string")
    data = [(i, r[0], "h", "k", "v") for i, r in enumerate(BY_HAND)] * 2 + [(None, "http://bad.net/x?a=1&b=2", "h", "k", "v")]
    rows = url_filter.filter_urls(frame(data, SCHEMA), listed, RULES, blocks).collect()
    assert len(rows) == len(data)
    for r in rows:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == BY_HAND[r["page_id"]][1:]
        else:
            assert r["verdict"] == "block"


def test_the_longest_rule_wins(spark):
    rules = [Rule("allow", "a.com", "/"), Rule("block", "com", "/path/long"), Rule("allow", "com", "/")]
    name, verdict = url_filter.matching_rule(F.lit("a.com"), F.lit("/path/longer"), rules)
    assert tuple(spark.range(1).select(name, verdict).first()) == ("com/path/long", "block")


def test_bloom_filter_misses_nothing_and_passes_little(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("host/"), "id").alias("key"))
    words = url_filter.bloom_filter(keys, "key")
    hashes = np.array(keys.select(F.xxhash64("key")).toPandas().iloc[:, 0])
    assert url_filter.probe(words, hashes).all()
    others = spark.range(50_000).select(F.xxhash64(F.concat(F.lit("other/"), "id"))).toPandas().iloc[:, 0]
    assert url_filter.probe(words, np.array(others)).mean() < 0.02
    # a filter that may not grow stays right and passes more
    small = url_filter.bloom_filter(keys, "key", 64)
    assert len(small) == 64 and url_filter.probe(small, hashes).all()


def test_empty(frame):
    none = frame([], "url string")
    assert url_filter.filter_urls(frame([], SCHEMA), none, RULES).count() == 0
    assert url_filter.filter_urls(frame([(1, "http://a.net/", "", "", "")], SCHEMA), none, RULES).first()["verdict"] == "allow"
