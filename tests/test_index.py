import pytest
from pyspark.errors import AnalysisException

from crawlspark.operators.select_urls import select_root_urls
from crawlspark.schemas import CRAWL_INDEX
from crawlspark.sources import crawl_index

HOST, DOMAIN = "acme.com", "acme.com"


def row(path, query=None, scheme="https", host=HOST, crawl="C1", subset="warc"):
    url = f"{scheme}://{host}{path or ''}"
    return (url, path, query, host, DOMAIN, "f.gz", 1, 2, crawl, subset)


def index(spark, *rows):
    return spark.createDataFrame(list(rows), CRAWL_INDEX)


@pytest.mark.parametrize(
    "entry, kept",
    [
        (row(""), True),
        (row("/"), True),
        (row("/about-us"), True),
        (row("/about-us/"), True),
        (row("/about-us.html"), True),
        (row("/a/b"), False),
        (row("/", query="x=1"), False),
        (row("index.html"), True),
        (row("index.php"), True),
        (row("index.html", scheme="http"), False),
        (row("index.htm", scheme="http", host="www.acme.com"), True),
        (row("index.html", host="blog.acme.com"), False),
        (row("home.html"), False),
        (row(None), False),
    ],
)
def test_root_urls(spark, entry, kept):
    got = select_root_urls(index(spark, entry))
    assert got.count() == int(kept)
    assert got.columns == ["url", "warc_filename", "warc_record_offset", "warc_record_length", "crawl"]


def test_scan_reads_only_its_partitions(spark, plan, tmp_path):
    rows = [row("/", crawl=c, subset=s) for c in ("C1", "C2", "C3") for s in ("warc", "robotstxt")]
    index(spark, *rows).write.partitionBy("crawl", "subset").parquet(str(tmp_path / "i"))
    scan = select_root_urls(crawl_index.read_index(spark, str(tmp_path / "i"), ["C1", "C3"]))
    assert {r.crawl for r in scan.collect()} == {"C1", "C3"} and scan.count() == 2
    text = plan(scan)
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "crawl" in filters and "subset" in filters
    assert "IsNull(url_query)" in text.split("PushedFilters: [")[1].split("]")[0]
    assert "Exchange" not in text


@pytest.mark.parametrize("fmt", ["JSON", "parquet", "orc"])
def test_materialize(spark, tmp_path, fmt):
    rows = index(spark, row("/"), row("/a"))
    out = str(tmp_path / "t")
    crawl_index.materialize(rows, out, fmt)
    back = spark.read.schema(CRAWL_INDEX).format(fmt.lower()).load(out)
    assert sorted(back.collect()) == sorted(rows.collect())
    files = [r.path for r in crawl_index.storage_files(back).collect()]
    assert files and all(("json.gz" in f) or fmt != "JSON" for f in files)


def test_materialize_table(spark):
    crawl_index.materialize_table(index(spark, row("/")), "selected_one", "JSON")
    assert spark.table("selected_one").count() == 1
    spark.sql("drop table selected_one")


def test_avro_needs_its_package(spark, tmp_path):
    with pytest.raises(AnalysisException, match="avro"):
        crawl_index.materialize(index(spark, row("/")), str(tmp_path / "t"), "AVRO")
