import pytest
from pyspark.sql import functions as F

from crawlspark.operators import lookup
from crawlspark.runtime import broadcast_if_small, fits_in_memory
from crawlspark.sources import run_log


def test_dense_ids(spark):
    names = spark.range(1000).select(F.format_string("%04d", F.pmod(F.col("id") * 37, 1000)).alias("n"))
    names = names.repartition(7)
    assert sorted(lookup.dense_ids(names, "n", "id").collect()) == [(f"{i:04d}", i + 1) for i in range(1000)]
    assert lookup.dense_ids(names.limit(0), "n", "id").collect() == []


def test_app_ids(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "app_id long, app_name string")
    facts = spark.createDataFrame([("b",), ("a",), ("c",)], "app_name string")
    ids = lookup.with_app_id(facts, dim)
    assert sorted(ids.collect(), key=str) == sorted([("b", 2), ("a", 1), ("c", None)], key=str)
    back = lookup.with_app_name(ids.select("app_id"), dim)
    assert {r.app_name for r in back.collect()} == {"a", "b", None}


def test_size_check(spark, plan):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"), "id")
    assert fits_in_memory(df, 100)
    assert not fits_in_memory(df, 99)
    assert not fits_in_memory(df, 100, 50_000)
    assert fits_in_memory(df.limit(0))
    assert broadcast_if_small(df, 99) is df


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "app_name string")


def ids(df):
    return {r.app_name: r.app_id for r in df.collect()}


def test_ids_stay_when_apps_are_added(spark, tmp_path):
    base = str(tmp_path / "dim")
    assert ids(lookup.read_dim(spark, base)) == {}
    assert ids(lookup.grow_dim(spark, base, names(spark, "m", "c", "m", None))) == {"c": 1, "m": 2}
    assert ids(lookup.grow_dim(spark, base, names(spark, "z", "a", "m"))) == {"c": 1, "m": 2, "a": 3, "z": 4}
    assert ids(lookup.grow_dim(spark, base, names(spark, "a"))) == {"c": 1, "m": 2, "a": 3, "z": 4}
    assert run_log.commits(spark, base).count() == 2
    facts = names(spark, "z", "new", None, "new")
    got = lookup.with_kept_app_id(facts, base).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("z", 4), ("new", 5), (None, None), ("new", 5)], key=str)
    assert ids(lookup.read_dim(spark, base))["c"] == 1


def test_a_run_that_stops_or_comes_late_gives_no_ids(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "dim")
    lookup.grow_dim(spark, base, names(spark, "a"))

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(run_log, "commit", stopped)
        with pytest.raises(RuntimeError):
            lookup.grow_dim(spark, base, names(spark, "b"))
    assert ids(lookup.read_dim(spark, base)) == {"a": 1}
    own = run_log.begin

    def overtaken(*args):
        found = own(*args)
        with monkeypatch.context() as m:
            m.setattr(run_log, "begin", own)
            lookup.grow_dim(spark, base, names(spark, "c"))
        return found

    monkeypatch.setattr(run_log, "begin", overtaken)
    with pytest.raises(RuntimeError, match="another run"):
        lookup.grow_dim(spark, base, names(spark, "b"))
    assert ids(lookup.read_dim(spark, base)) == {"a": 1, "c": 2}
