import gzip
import json

import pytest
from pyspark.sql import functions as F

from crawlspark.operators import select_urls
from crawlspark.schemas import MATCH_FACT, SELECTED_URL
from crawlspark.streaming import fact_stream, url_stream
from test_select import brute, is_home, pairs, some_urls


def write(path, urls, start=0):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        for i, u in enumerate(urls, start):
            row = {"url": u, "warc_filename": "f", "warc_record_offset": i, "warc_record_length": 1, "crawl": "C"}
            out.write(json.dumps(row) + "\n")


def run(stream, out):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/data")


def test_resumes_with_new_files(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    write(root / "a.gz", ["https://a.com"])
    assert run(url_stream.stream_selected(spark, str(root)), out).count() == 1
    assert run(url_stream.stream_selected(spark, str(root)), out).count() == 1
    write(root / "deep" / "b.json.gz", ["https://b.com"])
    (root / "c.json").write_text("{}")
    assert {r.url for r in run(url_stream.stream_selected(spark, str(root)), out).collect()} == {"https://a.com", "https://b.com"}


def test_cap_of_one_trigger_is_the_batch_cap(spark, tmp_path):
    urls = some_urls()
    for part in range(4):
        write(tmp_path / "in" / f"{part}.gz", urls[part * 750 : (part + 1) * 750], part * 750)
    stream = url_stream.stream_selected(spark, str(tmp_path / "in"))
    kept = run(url_stream.stream_cap_per_domain(stream, 3), tmp_path / "out")
    assert pairs(kept) == brute(urls, 3)[1]
    batch = select_urls.cap_per_domain(spark.read.schema(SELECTED_URL).json(str(tmp_path / "in")), 3)
    assert pairs(kept) == pairs(batch)


def test_cap_over_triggers(spark, tmp_path):
    urls = some_urls()
    for part in range(4):
        write(tmp_path / "in" / f"{part}.gz", urls[part * 750 : (part + 1) * 750], part * 750)
    stream = url_stream.stream_selected(spark, str(tmp_path / "in"), files_per_trigger=1)
    kept = pairs(run(url_stream.stream_cap_per_domain(stream, 3), tmp_path / "out"))
    first, _ = brute(urls, 3)

    def host(url):
        return url.split("/")[2].removeprefix("www.")

    # every homepage, and per host no more than the cap of the others
    assert {u for u in kept if is_home(u[0])} == {(u, i) for i, u in enumerate(urls) if is_home(u)}
    for name in {host(u) for u in urls}:
        others = [u for u in kept if host(u[0]) == name and not is_home(u[0])]
        assert len(others) <= 3
    assert {host(u) for u, _ in kept} == {host(u) for u in urls}


@pytest.fixture
def fact_files(spark, tmp_path):
    def write_facts(number, rows):
        """Facts as (seen, host, page, app); one file per trigger."""
        facts = [(s, 1, "cc:A", h, p, "html", a) for s, h, p, a in rows]
        frame = spark.createDataFrame(facts, MATCH_FACT).coalesce(1)
        frame.write.mode("append").json(str(tmp_path / "facts" / f"n={number}"))

    def stream():
        frame = (
            spark.readStream.schema(MATCH_FACT).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).json(str(tmp_path / "facts"))
        )
        return frame.withColumn("seen_ts", F.timestamp_seconds("seen_time_epoch"))

    return write_facts, stream


@pytest.mark.parametrize("salts", [1, 16])
def test_repeats_are_dropped(spark, tmp_path, fact_files, salts):
    write_facts, stream = fact_files
    write_facts(0, [(100, "a", f"p{i}", "X") for i in range(500)] + [(100, "b", "p", "X")])
    write_facts(1, [(100, "a", f"q{i}", "X") for i in range(500)] + [(100, "a", "p1", "Y")])
    rows = run(fact_stream.stream_distinct_signatures(stream(), salts=salts), tmp_path / "out")
    assert sorted((r.fqdn_no_www, r.app_name) for r in rows.collect()) == [("a", "X"), ("a", "Y"), ("b", "X")]


def test_a_repeat_keeps_a_signature_known(spark, tmp_path, fact_files):
    """One every 30 seconds under a gap of 60 is one row, through many triggers; after a pause it is new."""
    write_facts, stream = fact_files
    for part in range(6):
        write_facts(part, [(s, "a", f"p{s:04d}", "X") for s in range(1000 + part * 60, 1060 + part * 60, 30)])
    write_facts(6, [(1500, "a", "p", "X"), (1500, "b", "q", "X")])
    write_facts(7, [(s, "c", "p", "Y") for s in (4850, 4905, 4955, 5000)])
    rows = run(fact_stream.stream_signature_sessions(stream()), tmp_path / "out").collect()
    assert sorted((r.fqdn_no_www, r.page_url, r.matches) for r in rows) == [("a", "p", 1), ("a", "p1000", 12), ("b", "q", 1)]
    facts = spark.read.schema(MATCH_FACT).option("recursiveFileLookup", True).json(str(tmp_path / "facts"))
    facts = facts.withColumn("seen_ts", F.timestamp_seconds("seen_time_epoch"))
    known = fact_stream.open_signature_sessions(facts).collect()
    assert [(r.fqdn_no_www, r.matches) for r in known] == [("c", 4)]
    assert fact_stream.open_signature_sessions(facts.limit(0)).collect() == []


def test_hosts_are_held(spark, tmp_path, fact_files):
    write_facts, stream = fact_files
    write_facts(0, [(0, "a", "p2", "X"), (1, "a", "p1", "Y"), (2, "a", "p3", "X"), (61, "a", "p", "Z")])
    write_facts(1, [(59, "b", "p", "X"), (500, "c", "p", "X")])
    rows = run(fact_stream.stream_host_rollup(stream()), tmp_path / "out").collect()
    got = {(r.fqdn_no_www, r.page_url, tuple(p.app_name for p in r.name_type_list)) for r in rows}
    assert got == {("a", "p2", ("X", "Y")), ("a", "p", ("Z",)), ("b", "p", ("X",))}
    facts = spark.read.schema(MATCH_FACT).option("recursiveFileLookup", True).json(str(tmp_path / "facts"))
    facts = facts.withColumn("seen_ts", F.timestamp_seconds("seen_time_epoch"))
    left = fact_stream.open_host_windows(facts).collect()
    assert [(r.fqdn_no_www, r.page_url) for r in left] == [("c", "p")]


def test_cap_beyond_a_batch(spark, tmp_path):
    urls = [f"https://a.com/{i}" for i in range(900)] + ["https://a.com"]
    write(tmp_path / "in" / "a.gz", urls)
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        stream = url_stream.stream_selected(spark, str(tmp_path / "in"))
        kept = run(url_stream.stream_cap_per_domain(stream, 350), tmp_path / "out")
        batch = select_urls.cap_per_domain(spark.read.schema(SELECTED_URL).json(str(tmp_path / "in")), 350)
        assert pairs(kept) == pairs(batch) and kept.count() in (350, 351)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
