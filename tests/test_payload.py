from pyspark.sql import functions as F

from crawlspark.functions import payload


def test_decode(spark):
    raws = [b"abc", "é".encode(), b"\xe9\xff", b""]
    rows = spark.createDataFrame([(bytearray(r),) for r in raws], "raw binary")
    got = [r.t for r in rows.select(payload.decode_payload(F.col("raw")).alias("t")).collect()]
    assert got == ["abc", "é", "éÿ", ""]


def parsed(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(
        payload.http_headers(F.col("t")).alias("headers"),
        payload.http_body(F.col("t")).alias("body"),
    ).first()
    return row.headers, row.body


def test_headers(spark):
    text = "HTTP/1.1 200 OK\r\nA: 1\r\nB: x: y\nA: 2\r\nno colon\r\n\r\nbody\r\n\r\nmore"
    assert parsed(spark, text) == ({"A": "2", "B": "x: y"}, "body\r\n\r\nmore")


def test_no_blank_line(spark):
    assert parsed(spark, "HTTP/1.1 200 OK\r\nA: 1") == (None, "HTTP/1.1 200 OK\r\nA: 1")


def test_no_headers(spark):
    assert parsed(spark, "HTTP/1.1 204 Gone\r\n\r\n") == ({}, "")


def test_many_lines(spark):
    lines = [f"Name-{i % 700}: {i}" for i in range(4_000)]
    headers, _ = parsed(spark, "HTTP/1.1 200 OK\r\n" + "\r\n".join(lines) + "\r\n\r\n")
    assert headers == {f"Name-{i % 700}": str(i) for i in range(4_000)}
