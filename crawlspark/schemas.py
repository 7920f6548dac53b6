"""Declared schemas. Nothing in the package infers one."""

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# M1: columnar crawl index, partitioned by crawl and subset
CRAWL_INDEX = _struct(
    url=_S,
    url_path=_S,
    url_query=_S,
    url_host_name=_S,
    url_host_registered_domain=_S,
    warc_filename=_S,
    warc_record_offset=_L,
    warc_record_length=_L,
    crawl=_S,
    subset=_S,
)

# M2: one selected URL
SELECTED_URL = _struct(
    url=_S, warc_filename=_S, warc_record_offset=_L, warc_record_length=_L, crawl=_S
)

# M3: raw record of an archive, as the whole-archive scan returns it
ARCHIVE_RECORD = _struct(
    path=_S,
    record_offset=_L,
    warc_type=_S,
    target_uri=_S,
    http_status=T.IntegerType(),
    payload=T.BinaryType(),
    error=_S,
)

# M6: signature catalog file. html and script hold a string or a list: both arrive as text.
SIGNATURES = _struct(headers=T.MapType(_S, _S), html=_S, script=_S)
CATALOG_FILE = _struct(apps=T.MapType(_S, SIGNATURES))

# M6, exploded
CATALOG = _struct(app_name=_S, evidence=_S, header_name=_S, pattern=_S)

# M7: app dictionary
APP_DIM = _struct(app_id=_L, app_name=_S)

# M8: one technology seen on one page
MATCH_FACT = _struct(
    seen_time_epoch=_L,
    process_time_epoch=_L,
    source=_S,
    fqdn_no_www=_S,
    page_url=_S,
    app_type=_S,
    app_name=_S,
)

# M9: one row per host
HOST_ROLLUP = _struct(
    fqdn_no_www=_S,
    seen_time_epoch=_L,
    process_time_epoch=_L,
    source=_S,
    page_url=_S,
    name_type_list=T.ArrayType(_struct(app_name=_S, app_type=_S)),
)

# Crawl calendar
CRAWL_CALENDAR = _struct(crawl=_S, epoch=_L)

# List of files already read
DONE_FILES = _struct(path=_S)

# Pages of each domain that earlier runs let through, up to the cap
DOMAIN_COUNTS = _struct(fqdn_no_www=_S, pages=_L)

# Records that a trigger of the technology stream has fetched or failed to fetch, and facts found
STREAM_COUNTERS = _struct(trigger=_L, fetched=_L, failed=_L, facts=_L)
