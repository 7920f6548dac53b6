"""Archived page records: by byte range, or whole archives.

Archives are gzip files of many members, one record each. The functions that run inside tasks do no
more than open a file, unpack one member and cut off its record head; which task reads what is
decided by Spark.
"""

from __future__ import annotations

import io
import time
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.functions.payload import decode_payload
from crawlspark.operators.totals import equal_shares
from crawlspark.runtime import bound_batches
from crawlspark.schemas import ARCHIVE_RECORD

# A task reads or scans this much, if there is enough for all cores: less than FEW_BYTES is not divided
TASK_BYTES = 512 * 1024 * 1024
FEW_BYTES = 4 * 1024 * 1024
# What opening a record costs, in bytes that could be read meanwhile
READ_COST_BYTES = 32 * 1024
# Above so many tasks their bytes grow instead
MAX_TASKS = 100_000
# Reads that a task has under way at a time
READ_THREADS = 16
# A read that the storage refuses is tried so often, after a pause that doubles
READ_ATTEMPTS = 3
PAUSE_SECONDS = 0.5
# An archive is scanned in ranges of this size
SPLIT_BYTES = 128 * 1024 * 1024
# Rows go back to Spark once they hold this much
YIELD_BYTES = 4 * 1024 * 1024
BUFFER_BYTES = 1024 * 1024
BLOCK_BYTES = 32 * 1024
MEMBER_START = b"\x1f\x8b\x08"


def read_records(
    selected: DataFrame,
    base_uri: str,
    partitions: int | None = None,
    threads: int = READ_THREADS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Add ``payload`` and ``error`` to URLs with file, offset and length.

    ``payload`` is the content of the record at the offset, HTTP head and body. A record that
    cannot be read has a null payload and the reason in ``error``; errors of the storage, but for a
    missing file, are tried ``READ_ATTEMPTS`` times first.

    The rows are small but each costs a read, so tasks are cut by the bytes they have to read: from the
    running total of the record lengths over file and offset. They follow the bytes in number, and a
    file that many rows point to is shared. ``task_bytes`` counts ``READ_COST_BYTES`` for every record.
    A null length counts as 0.
    """
    bound_batches(selected.sparkSession)
    cost = F.greatest(F.col("warc_record_length").cast("long"), F.lit(0)) + READ_COST_BYTES
    placed = _by_bytes(selected, cost, ["warc_filename", "warc_record_offset"], task_bytes, partitions)
    schema = T.StructType(
        [
            *selected.schema.fields,
            T.StructField("payload", T.BinaryType()),
            T.StructField("error", T.StringType()),
        ]
    )
    columns = [*selected.columns, "payload", "error"]
    base = base_uri.rstrip("/")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = lru_cache(maxsize=4)(lambda name: open_storage(f"{base}/{name}"))

        def read(row: tuple) -> tuple:
            for attempt in range(READ_ATTEMPTS):
                try:
                    length, offset = int(row.warc_record_length), int(row.warc_record_offset)
                    member = opened(row.warc_filename).read_at(length, offset)
                    return (*row, record_content(unpack(member))[1], None)
                except (OSError, ValueError, TypeError, zlib.error) as problem:
                    reason = f"{type(problem).__name__}: {problem}"
                    passing = isinstance(problem, OSError) and not isinstance(problem, FileNotFoundError)
                    if not passing or attempt + 1 == READ_ATTEMPTS:
                        break
                    opened.cache_clear()
                    time.sleep(PAUSE_SECONDS * 2**attempt)
            return (*row, None, reason)

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                rows = batch.itertuples(index=False)
                done, size = [], 0
                while some := list(islice(rows, 2 * threads)):
                    done += pool.map(read, some)
                    size += sum(len(r[-2] or b"") for r in done[-len(some) :])
                    if size >= YIELD_BYTES:
                        yield pd.DataFrame(done, columns=columns)
                        done, size = [], 0
                yield pd.DataFrame(done, columns=columns)

    return placed.mapInPandas(fetch, schema)


def _by_bytes(
    rows: DataFrame, amount: Column, order: list[str], task_bytes: int, partitions: int | None
) -> DataFrame:
    """Rows in partitions of some ``task_bytes``, or in ``partitions`` equal ones."""
    if partitions:
        return equal_shares(rows, amount, order, 1, partitions, partitions)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return equal_shares(rows, amount, order, task_bytes, at_most=MAX_TASKS, spread=(cores, FEW_BYTES))


def scan_archives(
    files: DataFrame,
    split_bytes: int = SPLIT_BYTES,
    partitions: int | None = None,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """All records of the archives listed with ``path`` and ``length``.

    An archive is cut into ranges, and the ranges of all archives into tasks of ``task_bytes``, so neither
    one large archive nor very many small ones are a task of their own; a record belongs to the range
    that its first byte is in. Members that cannot be unpacked give a row with ``error``, and reading goes on
    at the next one. The rows are the same however the archives are cut.
    """
    starts = F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")
    )
    size = F.least(F.lit(split_bytes).cast("long"), F.col("length") - F.col("start"))
    ranges = (
        files.where(F.col("length") > 0)
        .select("path", "length", F.explode(starts).alias("start"))
        .select("path", "start", size.alias("size"))
    )
    names = ARCHIVE_RECORD.fieldNames()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"].tolist()):
                rows, size = [], 0
                with io.BufferedReader(open_storage(path), BUFFER_BYTES) as file:
                    for offset, content, error in members(file, start, start + split_bytes):
                        rows.append((path, offset, *describe(content, error)))
                        size += len(content or b"")
                        if size >= YIELD_BYTES:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    placed = _by_bytes(ranges, F.col("size"), ["path", "start"], task_bytes, partitions)
    return placed.mapInPandas(scan, ARCHIVE_RECORD)


def page_texts(records: DataFrame) -> DataFrame:
    """The records that could be read, as ``text``."""
    return records.where(F.col("error").isNull()).select(
        *(c for c in records.columns if c not in ("payload", "error")),
        decode_payload(F.col("payload")).alias("text"),
    )


def failed_records(records: DataFrame) -> DataFrame:
    """The other ones."""
    return records.where(F.col("error").isNotNull()).drop("payload")


# --- inside tasks ---------------------------------------------------------------------------


def open_storage(uri: str):
    """A seekable file on any storage that Arrow knows."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :].removeprefix("//")
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def unpack(member: bytes) -> bytes:
    """Content of the gzip member that ``member`` starts with."""
    unpacker = zlib.decompressobj(wbits=31)
    content = unpacker.decompress(member)
    if not unpacker.eof:
        raise ValueError("truncated gzip member")
    return content


def record_content(record: bytes) -> tuple[dict[str, str], bytes]:
    """Head fields (lower-case names) and content of an archive record."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not blank or not lines[0].startswith("WARC/"):
        raise ValueError("not an archive record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields.get("content-length", ""))
    if len(rest) < length:
        raise ValueError("truncated record content")
    return fields, rest[:length]


def describe(content: bytes | None, error: str | None) -> tuple:
    """Record type, target, HTTP status, content and error of one member."""
    if error is None:
        try:
            fields, payload = record_content(content)
        except ValueError as problem:
            return None, None, None, None, f"ValueError: {problem}"
        first = payload[:64].split(b"\r\n", 1)[0].split()
        is_status = len(first) > 1 and first[0].startswith(b"HTTP/") and first[1].isdigit()
        return (
            fields.get("warc-type"),
            fields.get("warc-target-uri"),
            int(first[1]) if is_status else None,
            payload,
            None,
        )
    return None, None, None, None, error


def members(file, start: int, end: int) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Offset, content and error of the members of the range ``[start, end)``.

    They are the records that begin in it, and what follows one of them without being a record: the
    range after this one cannot tell such bytes from the inside of a member.
    """
    offset = start if start == 0 else next_member(file, start, end)
    while offset is not None and (offset < end or not starts_record(file, offset)):
        content, length, error = read_member(file, offset)
        if length == 0:
            return
        yield offset, content, error
        offset = offset + length if error is None else next_member(file, offset + 1, end)


def read_member(file, offset: int) -> tuple[bytes | None, int, str | None]:
    """Content, packed length and error of the member at ``offset``; length 0 at the end."""
    file.seek(offset)
    unpacker = zlib.decompressobj(wbits=31)
    parts, read = [], 0
    try:
        while not unpacker.eof:
            block = file.read(BLOCK_BYTES)
            if not block:
                return None, read, "ValueError: truncated gzip member"
            read += len(block)
            parts.append(unpacker.decompress(block))
    except zlib.error as problem:
        return None, read, f"error: {problem}"
    return b"".join(parts), read - len(unpacker.unused_data), None


def next_member(file, start: int, end: int) -> int | None:
    """Offset of the first member that begins in ``[start, end)`` and unpacks to a record.

    The bytes that open a member can also occur inside one by chance; the record head tells.
    """
    position = start
    while position < end:
        file.seek(position)
        block = file.read(min(BUFFER_BYTES, end - position) + len(MEMBER_START) - 1)
        found = block.find(MEMBER_START)
        while found >= 0:
            if starts_record(file, position + found):
                return position + found
            found = block.find(MEMBER_START, found + 1)
        position += BUFFER_BYTES
    return None


def starts_record(file, offset: int) -> bool:
    file.seek(offset)
    try:
        return zlib.decompressobj(wbits=31).decompress(file.read(4096), 5) == b"WARC/"
    except zlib.error:
        return False
