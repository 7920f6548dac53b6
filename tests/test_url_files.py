import gzip
import json

import pytest
from pyspark.sql import functions as F

from crawlspark.schemas import SELECTED_URL
from crawlspark.sources import url_files


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.writelines(f"{line}\n" for line in lines)


def line(url):
    return json.dumps(
        {"url": url, "warc_filename": "f", "warc_record_offset": 1, "warc_record_length": 2, "crawl": "C"}
    )


def test_nested_files(spark, tmp_path):
    write(tmp_path / "x.gz", line("u1"))
    write(tmp_path / "a" / "b" / "y.json.gz", line("u2"), "not json", line("u3"))
    (tmp_path / "z.json").write_text(line("u4"))
    rows = url_files.read_selected(spark, str(tmp_path), keep_corrupt=True)
    got = sorted((r.url or "", r[url_files.CORRUPT] or "") for r in rows.collect())
    assert got == [("", "not json"), ("u1", ""), ("u2", ""), ("u3", "")]
    assert url_files.read_selected(spark, str(tmp_path)).columns[-1] == "crawl"
    listed = {r.path.rsplit("/", 1)[1]: r.length for r in url_files.list_files(spark, str(tmp_path)).collect()}
    assert listed.keys() == {"x.gz", "y.json.gz"} and min(listed.values()) > 20


def test_unseen(spark, tmp_path):
    root, done = tmp_path / "in", str(tmp_path / "done")
    write(root / "x.gz", line("u1"))
    write(root / "deep" / "y.gz", line("u2"))

    files = url_files.list_files(spark, str(root))
    url_files.mark_done(files.where(F.endswith("path", F.lit("x.gz"))), done)
    rows, read = url_files.read_unseen(spark, str(root), url_files.read_done(spark, done))
    write(root / "z.gz", line("u3"))  # arrives between reading and marking
    assert [r.url for r in rows.collect()] == ["u2"]

    url_files.mark_done(read, done)
    rows, read = url_files.read_unseen(spark, str(root), url_files.read_done(spark, done))
    assert [r.url for r in rows.collect()] == ["u3"]

    url_files.mark_done(read, done)
    rows, read = url_files.read_unseen(spark, str(root), url_files.read_done(spark, done))
    assert read.count() == 0
    assert rows.collect() == [] and rows.schema == SELECTED_URL


@pytest.mark.parametrize("parts", [1, 3, 25])
def test_rolled_sink_fills_files(spark, tmp_path, parts):
    out = tmp_path / "out"
    url_files.write_rolled(spark.range(25).repartition(parts), str(out), rows_per_file=10)
    files = [p.read_text().splitlines() for p in out.glob("part-*")]
    assert sorted(map(len, files)) == [5, 10, 10]
    assert sorted(json.loads(r)["id"] for f in files for r in f) == list(range(25))


def test_rolled_sink_without_rows(spark, tmp_path):
    out = tmp_path / "out"
    url_files.write_rolled(spark.range(5), str(out), rows_per_file=10)
    url_files.write_rolled(spark.range(0), str(out), rows_per_file=10)
    assert spark.read.schema("id long").json(str(out)).collect() == []
