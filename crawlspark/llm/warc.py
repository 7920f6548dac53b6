"""Operator 10: WARC archives, written with one gzip member per record and read back in sequence."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, saved
from crawlspark.runtime import qualified, work_dir

FILE_BYTES = 256 * 1024 * 1024
CHUNK = 1024 * 1024
DATE = "2020-01-01T00:00:00Z"  # no table has a date; a fixed one keeps archives equal between runs

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, digest_ok boolean"
)


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name and name != "null" else None


def _http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _target(url: str | None) -> str:
    """Header line of the URL as it is, but for line ends, which would end the header: they are percent-encoded."""
    if url is None:
        return ""
    return f"WARC-Target-URI: {url.replace('\r', '%0D').replace('\n', '%0A')}\r\n"


def member(head: str, block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    digest = base32_sha1(hashlib.sha1(block).digest())
    text = f"WARC/1.1\r\n{head}WARC-Date: {DATE}\r\nWARC-Block-Digest: sha1:{digest}\r\nContent-Length: {len(block)}\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(text.encode()) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def response(page_id: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    head = (
        f"WARC-Type: response\r\nWARC-Record-ID: {_urn(page_id)}\r\n{_target(url)}"
        f"WARC-Payload-Digest: sha1:{digest}\r\nContent-Type: application/http; msgtype=response\r\n"
    )
    return member(head, _http_head(len(payload)) + payload)


def revisit(page_id: int | None, url: str | None, length: int, digest: str, refers_to: int | None) -> bytes:
    """A record with the HTTP head only; its Content-Length is that of the payload it refers to."""
    head = (
        f"WARC-Type: revisit\r\nWARC-Record-ID: {_urn(page_id)}\r\n{_target(url)}"
        f"WARC-Refers-To: {_urn(refers_to)}\r\nWARC-Payload-Digest: sha1:{digest}\r\n"
        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
        "Content-Type: application/http; msgtype=response\r\n"
    )
    return member(head, _http_head(length))


class _Frame:
    """What one record has told so far: fed by pieces, it never holds more than heads and a piece."""

    def __init__(self) -> None:
        self.held, self.headers, self.left = b"", None, 0
        self.http, self.block, self.payload = None, hashlib.sha1(), hashlib.sha1()
        self.payload_bytes, self.tail = 0, b""

    def feed(self, data: bytes) -> None:
        if self.headers is None:
            self.held += data
            end = self.held.find(b"\r\n\r\n")
            if end < 0:
                return
            self.headers = _headers(self.held[:end])
            data, self.held = self.held[end + 4 :], b""
            self.left = int(self.headers["content-length"])
        part, rest = data[: self.left], data[self.left :]
        self.left -= len(part)
        self.tail += rest
        self.block.update(part)
        if self.http is None and part:
            self.held += part
            end = self.held.find(b"\r\n\r\n")
            if end < 0:
                return
            self.http = _headers(self.held[:end])
            part, self.held = self.held[end + 4 :], b""
        self.payload.update(part)
        self.payload_bytes += len(part)

    def record(self) -> dict:
        """The record; raises ValueError if its framing is broken."""
        if self.headers is None or self.left or self.tail != b"\r\n\r\n":
            raise ValueError("record is cut or longer than its Content-Length")
        kind = self.headers.get("warc-type")
        digest = self.headers.get("warc-payload-digest", "").removeprefix("sha1:")
        ok = self.headers.get("warc-block-digest") == "sha1:" + base32_sha1(self.block.digest())
        length = self.payload_bytes
        if kind == "revisit":
            length = int(self.http["content-length"])
        else:
            ok = ok and digest == base32_sha1(self.payload.digest())
            ok = ok and (self.http or {}).get("content-length") == str(length)
        return {
            "page_id": _page_id(self.headers.get("warc-record-id")),
            "url": self.headers.get("warc-target-uri"),
            "payload_bytes": length,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": _page_id(self.headers.get("warc-refers-to")),
            "digest_ok": ok,
        }


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_stream(stream: BinaryIO) -> Iterator[dict]:
    """Records of an archive in order. Reads and inflates a megabyte at a time, whatever a record's size.

    Raises ValueError at a damaged or cut record: an archive that its writer listed must be whole.
    """
    inflate, frame = zlib.decompressobj(31), _Frame()
    data, begun = stream.read(CHUNK), False
    while data:
        begun = True
        try:
            frame.feed(inflate.decompress(data, CHUNK))
        except zlib.error as error:
            raise ValueError(f"damaged member: {error}") from error
        if inflate.eof:
            yield frame.record()
            data, inflate, frame, begun = inflate.unused_data, zlib.decompressobj(31), _Frame(), False
        else:
            data = inflate.unconsumed_tail
        if not data:
            data = stream.read(CHUNK)
    if begun:
        raise ValueError("archive ends inside a member")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress each payload before it may be shuffled."""
    for batch in batches:
        urls, pages = batch["url"].to_pylist(), batch["html"].to_pylist()
        packed, sizes = [], []
        for i, (page_id, url, html, sha) in enumerate(
            zip(batch["page_id"].to_pylist(), urls, pages, batch["sha1"].to_pylist(), strict=True)
        ):
            payload = (html or "").encode()
            pages[i] = None
            packed.append(response(page_id, url, payload, base32_sha1(bytes.fromhex(sha))))
            sizes.append(len(payload))
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], batch["sha1"], pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
            ["page_id", "url", "sha1", "payload_bytes", "member"],
        )


def _writer(folder: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        out, path, records, size, number = None, "", 0, 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    # a name for each attempt: files of failed or repeated attempts are never listed
                    name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                    path, records, size, number = f"{root}/{name}", 0, 0, number + 1
                    out = store.open_output_stream(path, compression=None)
                data = row["member"]
                if row["revisit"]:
                    digest = base32_sha1(bytes.fromhex(row["sha1"]))
                    data = revisit(row["page_id"], row["url"], row["payload_bytes"], digest, row["newest"])
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((path, records, size))
        if out is not None:
            out.close()
            done.append((path, records, size))
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "records": n, "bytes": b} for p, n, b in done],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return write


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages(page_id, url, html)``; return the manifest, which is saved.

    Of rows with equal payloads of at least ``min_bytes`` bytes those with the largest page_id are
    responses and the others revisit them. Equal payloads are found by SHA-1 and length, on rows
    without the payload; only payload groups of two or more are joined to the pages. A payload travels
    compressed. A null html is an empty payload; a null page_id is smaller than any other and refers
    like one; rows repeated with the largest page_id are all responses; a null url has no header,
    line ends in a url stay percent-encoded and the rest of it is as given. Tables without rows give an
    empty manifest. Other columns are not read.
    """
    spark = pages.sparkSession
    bound_batches(spark, 500)
    folder = qualified(spark, folder or work_dir(spark, "warc"))
    rows = pages.select("page_id", "url", "html").withColumn(
        "sha1", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    )
    length = F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")
    groups = (
        rows.select("page_id", "sha1", length.alias("size"))
        .groupBy("sha1", "size")
        .agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & (F.col("size") >= min_bytes))
        .select("sha1", F.col("size").alias("payload_bytes"), "newest")
    )
    members = rows.mapInArrow(_members, "page_id long, url string, sha1 string, payload_bytes long, member binary")
    typed = (
        members.join(saved(groups.withColumn("grouped", F.lit(True)), "payloads"), ["sha1", "payload_bytes"], "left")
        .withColumn("revisit", F.col("grouped").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest")))
        .select(
            "page_id",
            "url",
            "sha1",
            "payload_bytes",
            F.when(~F.col("revisit"), F.col("member")).alias("member"),
            "revisit",
            "newest",
        )
    )
    _make_folder(folder)
    return saved(typed.mapInArrow(_writer(folder, file_bytes), MANIFEST).withColumn("root", F.lit(folder)), "warc-files")


def _make_folder(folder: str) -> None:
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row for every record of the archives in ``manifest(path, root)``, one task per archive.

    ``digest_ok`` says whether the block digest, and for a response the payload digest and length, are
    those of the bytes read. A damaged archive fails the job.
    """
    bound_batches(manifest.sparkSession, 500)
    fields = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    schema = pa.schema(list(zip(fields, types, strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, root in zip(batch["path"].to_pylist(), batch["root"].to_pylist(), strict=True):
                store, _ = pafs.FileSystem.from_uri(root)
                held = []
                with store.open_input_stream(path, compression=None) as stream:
                    for record in read_stream(stream):
                        held.append(record)
                        if len(held) == 2_000:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    return manifest.select("path", "root").repartition(max(1, manifest.count())).mapInArrow(read, RECORDS)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archives and read them back."""
    return read_archives(write_archives(pages, folder))
