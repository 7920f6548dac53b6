import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawlspark.operators import match
from crawlspark.plans import derived
from crawlspark.runtime import BATCH_BYTES, bound_batches, work_dir
from crawlspark.sources import catalog, warc

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
PAGE = "<p>" + "x" * 1_000_000


@pytest.fixture
def wide(spark):
    """A session that lets batches of 64 MB into tasks."""
    held = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "64m")
    yield spark
    spark.conf.set(LIMIT, held)


def pages(spark):
    return spark.range(0, 24, 1, 1).select(F.col("id").alias("page_id"), F.lit(PAGE).alias("html"))


def largest_batch(df):
    """Bytes of the largest batch that a task gets."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return df.mapInArrow(run, "n long").agg(F.max("n")).first()[0]


def in_bounds(spark):
    # the row that passes the limit is the last one
    return largest_batch(pages(spark)) <= BATCH_BYTES + 2 * len(PAGE)


def test_a_lower_limit_stays(wide):
    assert not in_bounds(wide)
    for limit, kept in (("64m", str(BATCH_BYTES)), ("1mb", "1mb"), ("2048", "2048"), ("1g", str(BATCH_BYTES))):
        wide.conf.set(LIMIT, limit)
        bound_batches(wide)
        assert wide.conf.get(LIMIT) == kept
    assert in_bounds(wide)


def test_pages_meet_a_large_catalog_in_small_batches(wide, monkeypatch):
    monkeypatch.setattr(match, "INDEX_ABOVE", 1)
    rules = catalog.catalog_rows(wide, [("P", "html", None, "<p>xxxx"), ("Q", "html", None, "<q>xxxx")])
    assert match.match_pages(pages(wide), rules).count() == 24
    assert in_bounds(wide)


def test_archives_are_written_and_read_in_small_batches(wide):
    root = work_dir(wide, "archives")
    records = pages(wide).select(
        "page_id", F.lit("http://a.org/").alias("url"), F.lit("c").alias("crawl"), F.encode("html", "UTF-8").alias("payload")
    )
    index = derived.write_archives(records, root)
    assert in_bounds(wide)
    wide.conf.set(LIMIT, "64m")
    read = warc.read_records(index, f"file://{root}")
    assert in_bounds(wide)
    assert read.where(F.octet_length("payload") == len(PAGE)).count() == 24
    assert largest_batch(read) <= BATCH_BYTES + 2 * len(PAGE)
