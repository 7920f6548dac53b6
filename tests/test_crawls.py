import calendar
import datetime

from pyspark.sql import functions as F

from crawlspark.functions.crawls import crawl_epoch, process_time, source_tag
from crawlspark.operators import lookup


def epochs(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "crawl string")
    return dict(rows.select("crawl", crawl_epoch(F.col("crawl"))).collect())


def test_known_epochs(spark):
    known = {
        "CC-MAIN-2014-10": 1394928000,
        "CC-MAIN-2014-52": 1420329600,
        "CC-MAIN-2017-51": 1514073600,
        "CC-MAIN-2020-40": 1602374400,
    }
    assert epochs(spark, known) == known


def test_against_the_calendar(spark):
    expected = {}
    for year in range(2012, 2031):
        for week in range(1, 53):
            day = datetime.datetime.strptime(f"{year} {week} 0", "%Y %W %w")
            expected[f"CC-MAIN-{year}-{week:02d}"] = calendar.timegm(day.timetuple())
    assert epochs(spark, expected) == expected


def test_other_ids_have_no_epoch(spark):
    assert set(epochs(spark, ["", "CC", "CC-MAIN-x-y", "CC-MAIN-2020"]).values()) == {None}


def test_calendar_lookup(spark):
    rows = spark.createDataFrame([("CC-MAIN-2020-40",), ("CC-MAIN-2020-45",)], "crawl string")
    listed = spark.createDataFrame([("CC-MAIN-2020-40", 7)], "crawl string, epoch long")
    got = dict(lookup.with_crawl_epoch(rows, listed).collect())
    assert got == {"CC-MAIN-2020-40": 7, "CC-MAIN-2020-45": 1605398400}
    plain = lookup.with_crawl_epoch(rows).withColumnRenamed("seen_time_epoch", "epoch")
    assert sorted(plain.collect()) == sorted(lookup.crawl_calendar(rows.union(rows)).collect())


def test_source_and_process_time(spark):
    row = spark.range(1).select(
        source_tag(F.lit("CC-MAIN-2020-40")).alias("source"),
        process_time(5).alias("given"),
        process_time().alias("now"),
    ).first()
    assert row.source == "cc:CC-MAIN-2020-40" and row.given == 5
    assert abs(row.now - datetime.datetime.now().timestamp()) < 60
