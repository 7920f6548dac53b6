import pytest
from pyspark.sql import functions as F

from crawlspark.functions import urls


def values(spark, inputs, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.x for r in rows.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_host_no_www(spark):
    cases = {
        "https://www.Acme.com/a": "acme.com",
        "http://user:pw@blog.acme.com:8080/x": "blog.acme.com",
        "acme.com/x": "acme.com",
        "//acme.com": "acme.com",
        "https://www.awww.com/": "awww.com",
        "http://10.0.0.1:80/": "10.0.0.1",
        "https://acme.com?x=/y": "acme.com",
        "": "",
    }
    assert values(spark, cases, urls.host_no_www) == list(cases.values())


# url, root page, homepage
SHAPES = [
    ("https://acme.com", True, True),
    ("https://acme.com/", True, True),
    ("https://acme.com/blog", True, False),
    ("https://acme.com/blog/", True, False),
    ("https://acme.com/blog/x", False, False),
    ("https://acme.com/robots.txt", True, False),
    ("https://acme.com/?q=1", True, False),
    ("acme.com", False, False),
]


def test_url_shapes(spark):
    inputs = [s[0] for s in SHAPES]
    assert values(spark, inputs, urls.is_root_page) == [s[1] for s in SHAPES]
    assert values(spark, inputs, urls.is_homepage) == [s[2] for s in SHAPES]


def test_suffix_and_query(spark):
    inputs = ["https://a.com/robots.txt", "https://a.com/?x", "https://a.com/"]
    assert values(spark, inputs, urls.is_robots_file) == [True, False, False]
    assert values(spark, inputs, urls.has_query) == [False, True, False]


@pytest.mark.parametrize(
    "path, bucket, key",
    [
        ("s3://bucket/a/b.gz", "bucket", "a/b.gz"),
        ("s3://bucket//a", "bucket", "a"),
        ("http://x/y", None, None),
    ],
)
def test_storage_parts(spark, path, bucket, key):
    assert values(spark, [path], urls.storage_bucket) == [bucket]
    assert values(spark, [path], urls.storage_key) == [key]


def test_archive_uri_and_range(spark):
    row = spark.range(1).select(
        urls.archive_uri("file:/data/", F.lit("a/b.gz")).alias("uri"),
        urls.byte_range_end(F.lit(10), F.lit(5)).alias("end"),
    ).first()
    assert (row.uri, row.end) == ("file:/data/a/b.gz", 15)
