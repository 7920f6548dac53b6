"""Decoding of raw records and of the HTTP head in front of a page."""

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK_LINE = "\r\n\r\n"


def is_utf8(payload: Column) -> Column:
    return F.is_valid_utf8(payload.cast("string"))


def decode_payload(payload: Column) -> Column:
    """UTF-8, or ISO-8859-1 where the bytes are not valid UTF-8."""
    return F.when(is_utf8(payload), payload.cast("string")).otherwise(
        F.decode(payload, "ISO-8859-1")
    )


def has_http_head(text: Column) -> Column:
    return F.contains(text, F.lit(BLANK_LINE))


def http_head(text: Column) -> Column:
    """Text before the first blank line; null without one."""
    return F.when(has_http_head(text), F.substring_index(text, BLANK_LINE, 1))


def http_body(text: Column) -> Column:
    """Text after the first blank line; the whole text without one."""
    start = F.instr(text, F.lit(BLANK_LINE)) + len(BLANK_LINE)
    return F.when(has_http_head(text), F.substr(text, start)).otherwise(text)


def http_headers(text: Column) -> Column:
    """header name to value. Of equal names the last wins; the status line is left out."""
    lines = F.filter(
        F.split(http_head(text), r"\r?\n"),
        lambda line: ~F.startswith(F.lower(line), F.lit("http/")) & F.contains(line, F.lit(": ")),
    )

    # sorted by name and place, a line counts if the next one has another name
    ordered = F.array_sort(
        F.transform(
            lines,
            lambda line, place: F.struct(
                F.substring_index(line, ": ", 1).alias("name"),
                place.alias("place"),
                F.substr(line, F.instr(line, F.lit(": ")) + 2).alias("value"),
            ),
        )
    )
    pairs = F.zip_with(
        ordered,
        F.slice(ordered, 2, F.size(ordered)),
        lambda line, following: F.struct(
            line["name"].alias("name"), line["value"].alias("value"), following["name"].alias("following")
        ),
    )
    last = F.filter(pairs, lambda x: x["following"].isNull() | (x["following"] != x["name"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["name"], x["value"])))
