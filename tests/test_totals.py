import random

from pyspark.sql import functions as F

from crawlspark.operators.totals import equal_shares, running_total


def test_running_total_in_order(spark):
    source = random.Random(3)
    rows = [(f"k{source.randint(0, 9)}", i, source.choice([None, 0, 1, 7, 10**12])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, i long, n long").repartition(6)
    got, total = running_total(df, F.col("n"), "before", ["k", "i"])
    assert got.columns == ["k", "i", "n", "before"]
    expected, upto = [], 0
    for k, i, n in sorted(rows, key=lambda r: r[:2]):
        expected.append((k, i, n, upto))
        upto += n or 0
    assert total == upto
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == expected


def test_numbers_without_order(spark):
    rows, total = running_total(spark.range(100).repartition(7), F.lit(1), "n")
    assert total == 100
    assert sorted(r.n for r in rows.collect()) == list(range(100))
    rows, total = running_total(spark.range(0), F.lit(1), "n")
    assert (rows.collect(), total) == ([], 0)


def test_equal_shares(spark):
    df = spark.range(1000).withColumn("same", F.lit(1))
    by_part = F.spark_partition_id().alias("p")
    counts = equal_shares(df, F.lit(3), ["same", "id"], 300).groupBy(by_part).count().collect()
    assert sorted(r["count"] for r in counts) == [100] * 10
    assert equal_shares(df, F.lit(3), ["id"], 300, at_most=4).rdd.getNumPartitions() == 4
    assert equal_shares(df, F.lit(3), ["id"], 10_000, spread=(8, 1000)).rdd.getNumPartitions() == 3
    nothing = equal_shares(df, F.lit(0), ["id"], 300, at_least=2)
    assert nothing.rdd.getNumPartitions() == 2 and nothing.count() == 1000
    assert equal_shares(df.limit(0), F.lit(1), ["id"], 300).collect() == []
