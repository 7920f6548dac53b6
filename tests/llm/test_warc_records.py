import base64
import gzip
import hashlib
import io

import pytest

from crawlspark.llm import warc

SCHEMA = "page_id long, url string, html string, sha1 string, member int"
PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (4, "http://a/4\r\nWARC-Type: x", ""),
    (5, "http://a/5", None),
    (6, "http://a/%0A6", "é\r\n\r\n漢" * 5),
    (7, "http://a/7", "x" * 3_000_000),
    (8, "http://a/8", "twice"),
    (8, "http://a/8", "twice"),
    (None, "http://a/n", "<p>same</p>"),
    (None, "http://a/n", "only"),
]


def expected(pages, least=0):
    out = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == body]
        newest = max((p for p in same if p is not None), default=None)
        again = len(same) > 1 and len(body) >= least and page_id != newest
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "revisit" if again else "response", newest if again else None, True))
    return sorted(out, key=str)


FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def frame_of(frame, pages):
    return frame([(*p, "x", 1) for p in pages], SCHEMA)


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(frame, rows, least):
    found = warc.read_archives(warc.write_archives(frame_of(frame, PAGES), min_bytes=least))
    assert rows(found, *FIELDS) == expected(PAGES, least)
    urls = {p[1] and p[1].replace("\r", "%0D").replace("\n", "%0A") for p in PAGES}
    assert {r["url"] for r in found.collect()} == urls


def test_urls_stand_in_the_header_as_they_are():
    record = gzip.decompress(warc.response(1, "http://a/%41?q=100%25&x=\u00e9", b"", ""))
    assert "WARC-Target-URI: http://a/%41?q=100%25&x=\u00e9\r\n".encode() in record


def test_archives_roll_and_are_listed(frame, rows, tmp_path):
    manifest = warc.write_archives(frame_of(frame, PAGES).coalesce(1), str(tmp_path / "out"), file_bytes=600)
    assert manifest.count() > 2
    assert sum(r["records"] for r in manifest.collect()) == len(PAGES)
    assert rows(warc.read_archives(manifest), *FIELDS) == expected(PAGES)
    # what failed attempts leave is not in the manifest
    (tmp_path / "out" / "pages-00000-9999-0000.warc.gz").write_bytes(b"half a member")
    assert rows(warc.read_archives(manifest), *FIELDS) == expected(PAGES)


def test_empty(frame):
    assert warc.archive_round_trip(frame([], SCHEMA)).count() == 0


def test_members_stand_alone():
    record = warc.response(1, "http://a/", b"body", "D")
    text = gzip.decompress(record)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\nbody\r\n\r\n")


def archive():
    digest = warc.base32_sha1(hashlib.sha1(b"body").digest())
    return warc.response(1, "u", b"body", digest) + warc.revisit(2, None, 4, digest, 1)


def test_reads_in_small_pieces(monkeypatch):
    whole = list(warc.read_stream(io.BytesIO(archive())))
    assert [r["record_type"] for r in whole] == ["response", "revisit"] and all(r["digest_ok"] for r in whole)
    for size in (1, 7, 64):
        monkeypatch.setattr(warc, "CHUNK", size)
        assert list(warc.read_stream(io.BytesIO(archive()))) == whole


def test_damage_is_told():
    with pytest.raises(ValueError):
        list(warc.read_stream(io.BytesIO(archive()[:-3])))
    with pytest.raises(ValueError):
        list(warc.read_stream(io.BytesIO(archive()[:30] + b"\xff\xff" + archive()[32:])))
    wrong = warc.response(1, "u", b"body", warc.base32_sha1(b"0" * 20))
    assert [r["digest_ok"] for r in warc.read_stream(io.BytesIO(wrong))] == [False]
    cut = gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.read_stream(io.BytesIO(cut)))
