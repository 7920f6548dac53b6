import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.functions.urls import host_no_www
from crawlspark.operators.select_urls import cap_per_domain, counts_with
from crawlspark.schemas import DOMAIN_COUNTS, SELECTED_URL
from crawlspark.sources import run_log, url_files

N = T.StructType().add("n", "long")


def write(spark, base, run, kind, numbers):
    spark.createDataFrame([(n,) for n in numbers], N).write.parquet(run_log.part(base, kind, run))


def numbers(df):
    return sorted(r["n"] for r in df.collect())


def test_only_committed_runs_are_read(spark, tmp_path):
    base = str(tmp_path)
    assert run_log.read(spark, base, "a", N).collect() == [] and run_log.commits(spark, base).count() == 0
    first, version = run_log.begin(spark, base)
    write(spark, base, first, "a", [1, 2])
    assert numbers(run_log.read(spark, base, "a", N)) == []
    run_log.commit(spark, base, first, version)
    stopped, version = run_log.begin(spark, base)
    write(spark, base, stopped, "a", [3])
    second, version = run_log.begin(spark, base)
    write(spark, base, second, "a", [4])
    run_log.commit(spark, base, second, version)
    rows = run_log.read(spark, base, "a", N)
    assert numbers(rows) == [1, 2, 4] and {r["run"] for r in rows.collect()} == {first, second}
    assert numbers(run_log.read_last(spark, base, "a", N)) == [4]
    assert run_log.read_last(spark, base, "b", N).collect() == []


def test_one_of_two_runs_from_one_commit_fails(spark, tmp_path):
    base = str(tmp_path)
    (one, v1), (two, v2) = run_log.begin(spark, base), run_log.begin(spark, base)
    write(spark, base, one, "a", [1])
    write(spark, base, two, "a", [2])
    run_log.commit(spark, base, two, v2)
    with pytest.raises(RuntimeError):
        run_log.commit(spark, base, one, v1)
    assert numbers(run_log.read(spark, base, "a", N)) == [2]


def test_a_commit_that_is_being_written_counts_for_nothing(spark, tmp_path):
    base = str(tmp_path)
    run, version = run_log.begin(spark, base)
    write(spark, base, run, "a", [1])
    run_log.commit(spark, base, run, version)
    (tmp_path / "commits" / "0000000002.json").write_text('{"vers')
    assert numbers(run_log.read(spark, base, "a", N)) == [1]


@pytest.mark.parametrize("cap", [1, 3, 1_500])
def test_the_cap_holds_over_runs(spark, cap):
    source = random.Random(cap)
    urls = [f"https://{source.choice('aaab')}.com/{source.choice(['', 'x/y', 'z'])}{i if i % 4 else ''}" for i in range(60)]
    rows = [(u, "f", i, 1, "C") for i, u in enumerate(sorted(urls))]
    # in the order of the quota, so that runs over parts are one run over the whole
    df = spark.createDataFrame(rows, SELECTED_URL)
    whole = sorted(r["url"] for r in cap_per_domain(df, cap).collect())
    seen = spark.createDataFrame([], DOMAIN_COUNTS)
    kept = []
    for part in (rows[:25], rows[25:26], rows[26:]):
        own = spark.createDataFrame(part, SELECTED_URL)
        kept += [r["url"] for r in cap_per_domain(own, cap, seen).collect()]
        seen = counts_with(own, cap, seen)
    assert sorted(kept) == whole
    counts = df.groupBy(host_no_www(F.col("url")).alias("h")).agg(F.least(F.count("*"), F.lit(cap)).alias("n"))
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, counts.collect()))


def test_listed_files_are_read_as_whole_folders_are(spark, tmp_path):
    from test_url_files import line
    from test_url_files import write as write_lines

    write_lines(tmp_path / "a.gz", *[line(f"u{i}") for i in range(500)], "not json", "", "  ", '{"url": "é\\"x"}\r')
    write_lines(tmp_path / "deep" / "b.gz")
    write_lines(tmp_path / "deep" / "c d.gz", line("last"))
    files = url_files.list_files(spark, str(tmp_path))
    expected = sorted(map(str, url_files.read_selected(spark, str(tmp_path)).collect()))
    for task_bytes in (1, 10**9):
        found = url_files.read_listed(files, task_bytes)
        assert found.schema == SELECTED_URL and sorted(map(str, found.collect())) == expected
    assert url_files.read_listed(files.limit(0)).collect() == []
