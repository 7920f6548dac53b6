"""URL and storage path functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme and user are optional; the host ends at a port, path, query or fragment. What comes before
# the mark of an optional part cannot hold the mark, so a run without it is not tried again (*+).
HOST_PATTERN = r"^(?:(?:[a-zA-Z][\w+.-]*+:)?//)?(?:[^/?#@]*+@)?([^/?#:]+)"
STORAGE_PATTERN = r"^s3://([^/]+)/+(.*)$"


def host_no_www(url: Column) -> Column:
    """lower-case host without a leading ``www.``; a ``www.`` further in stays (Q4)."""
    host = F.lower(F.regexp_extract(url, HOST_PATTERN, 1))
    return F.when(F.startswith(host, F.lit("www.")), F.substr(host, F.lit(5))).otherwise(host)


def slash_count(url: Column) -> Column:
    """F2."""
    return F.length(url) - F.length(F.replace(url, F.lit("/"), F.lit("")))


def is_root_page(url: Column) -> Column:
    """the homepage or a page one level below it."""
    slashes = slash_count(url)
    return slashes.isin(2, 3) | ((slashes == 4) & F.endswith(url, F.lit("/")))


def is_homepage(url: Column) -> Column:
    """F4."""
    slashes = slash_count(url)
    return (slashes == 2) | ((slashes == 3) & F.endswith(url, F.lit("/")))


def is_robots_file(url: Column) -> Column:
    """F5."""
    return F.endswith(url, F.lit("robots.txt"))


def has_query(url: Column) -> Column:
    """F5."""
    return F.contains(url, F.lit("?"))


def byte_range_end(offset: Column, length: Column) -> Column:
    """first byte after the record (Q11)."""
    return offset + length


def archive_uri(base: str, filename: Column) -> Column:
    """F16."""
    return F.concat(F.lit(base.rstrip("/") + "/"), filename)


def storage_bucket(path: Column) -> Column:
    """bucket of an ``s3://`` path, null for any other scheme."""
    return _storage_part(path, 1)


def storage_key(path: Column) -> Column:
    """key of an ``s3://`` path, null for any other scheme."""
    return _storage_part(path, 2)


def _storage_part(path: Column, group: int) -> Column:
    return F.when(path.rlike(STORAGE_PATTERN), F.regexp_extract(path, STORAGE_PATTERN, group))
