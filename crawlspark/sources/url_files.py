"""Files of selected URLs, done-file bookkeeping and the rolled result sink."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.operators.totals import running_total
from crawlspark.runtime import work_dir
from crawlspark.schemas import DONE_FILES, SELECTED_URL

# Bytes of packed files that a task reads, and of lines that it holds
TASK_BYTES = 64 * 1024 * 1024
LINES_BYTES = 4 * 1024 * 1024
ROWS_PER_FILE = 1_500_000
CORRUPT = "_corrupt"


def read_selected(
    spark: SparkSession, root: str | list[str], keep_corrupt: bool = False
) -> DataFrame:
    """All ``*.gz`` JSON-lines files below ``root``, at any depth.

    A line that is no JSON object gives a row of nulls; with ``keep_corrupt`` its text is kept.
    """
    schema = SELECTED_URL
    if keep_corrupt:
        schema = T.StructType([*SELECTED_URL.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.gz")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(root)
    )


def list_files(spark: SparkSession, root: str, pattern: str = "*.gz") -> DataFrame:
    """Path and length of every matching file below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )


def unseen_files(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose ``path`` is not in the done table."""
    return files.join(done.select("path"), "path", "left_anti")


def read_listed(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The rows of the files in ``path, length``, as ``read_selected`` gives them.

    The list stays a table: files are dealt over tasks, as many as their bytes call for, and each task
    unpacks and reads its own line by line. A line that is no JSON object gives a row of nulls.
    """
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // task_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                # Spark gives paths as they are, a URI has spaces and the like encoded
                system, place = fs.FileSystem.from_uri(quote(path, safe=":/"))
                with gzip.open(system.open_input_stream(place, compression=None)) as lines:
                    while held := lines.readlines(LINES_BYTES):
                        rows = [line.rstrip(b"\r\n").decode("utf-8", "replace") for line in held]
                        yield pa.RecordBatch.from_arrays([pa.array([r for r in rows if r.strip()], pa.string())], ["line"])

    lines = files.select("path").repartition(tasks).mapInArrow(run, "line string")
    return lines.select(F.from_json("line", SELECTED_URL).alias("row")).select("row.*")


def read_unseen(spark: SparkSession, root: str, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S4 in batch: the rows of the files below ``root`` that the done table does not list, and
    these files, to be marked once the rows are used.

    The files are found by a join, and their list is written: files that arrive later are in neither.
    """
    listing = work_dir(spark, "unseen")
    unseen_files(list_files(spark, root), done).write.parquet(listing)
    files = spark.read.schema("path string, length long").parquet(listing)
    return read_listed(files), files


def mark_done(files: DataFrame, done_path: str) -> None:
    """Add files, as ``list_files`` gives them, to the done table."""
    files.select("path").write.mode("append").json(done_path)


def read_done(spark: SparkSession, done_path: str) -> DataFrame:
    """M11."""
    return spark.read.schema(DONE_FILES).json(done_path)


def write_rolled(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """JSON lines in files of ``rows_per_file`` rows, all full but the last, however many tasks ``df`` has.

    The rows are numbered by running totals and go to the file of their number, one task each. No rows
    leave one empty file.
    """
    rows, total = running_total(df, F.lit(1), "__number")
    files = max(1, -(-total // rows_per_file))
    number = F.expr(f"__number div {rows_per_file}").cast("int")
    rows.repartitionById(files, number).drop("__number").write.mode("overwrite").json(path)
