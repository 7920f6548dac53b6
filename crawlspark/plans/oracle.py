"""The SQL that each query is checked against."""

HOST_PATTERN = r"^(?:(?:[a-zA-Z][\w+.-]*:)?//)?(?:[^/?#@]*@)?([^/?#:]+)"

# --- fragments -------------------------------------------------------------------------------


def _host(url: str) -> str:
    return f"regexp_replace(lower(regexp_extract({url}, '{HOST_PATTERN}', 1)), '^www\\.', '')"


def _slashes(url: str) -> str:
    return f"(length({url}) - length(replace({url}, '/', '')))"


def _root_page(url: str) -> str:
    n = _slashes(url)
    return f"({n} = 2 OR {n} = 3 OR ({n} = 4 AND ends_with({url}, '/')))"


def _homepage(url: str) -> str:
    n = _slashes(url)
    return f"({n} = 2 OR ({n} = 3 AND ends_with({url}, '/')))"


def _p7(url: str) -> str:
    kept = f"NOT ends_with({url}, 'robots.txt') AND NOT contains({url}, '?')"
    return f"({kept} AND {_root_page(url)})"


CRAWL = "CASE WHEN starts_with(url, 'https:') THEN 'CC-MAIN-2020-50' ELSE 'CC-MAIN-2020-45' END"

_VARIANTS = """
parts AS (
  SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS origin,
         regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1) AS folder
  FROM pages),
variants AS (
  SELECT page_id, 0 AS variant, url FROM parts
  UNION ALL SELECT page_id, 1, origin || '/' FROM parts
  UNION ALL SELECT page_id, 2, origin || '/' || folder || '/' FROM parts
  UNION ALL SELECT page_id, 3, origin || '/robots.txt' FROM parts
  UNION ALL SELECT page_id, 4, origin FROM parts)"""

SELECTED = f"""{_VARIANTS},
selected AS (
  SELECT page_id, variant, url, host AS fqdn_no_www,
         crawl || '/' || host || '.gz' AS warc_filename,
         page_id * 5 + variant AS warc_record_offset, length(url) AS warc_record_length, crawl
  FROM (SELECT *, {CRAWL} AS crawl, {_host("url")} AS host FROM variants))"""

_FIVE = "url, warc_filename, warc_record_offset, warc_record_length, crawl"

RANKED = f"""{SELECTED},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY fqdn_no_www ORDER BY url, warc_filename, warc_record_offset) AS rn
  FROM selected),
capped AS (SELECT * FROM ranked WHERE rn <= 3 OR {_homepage("url")})"""

# --- URLs ------------------------------------------------------------------------------------

FQDN_NO_WWW = f"SELECT page_id, {_host('url')} AS fqdn_no_www FROM pages"

URL_SHAPE = f"""
WITH {SELECTED}
SELECT page_id, url, {_slashes("url")} AS slashes, {_root_page("url")} AS root_page,
       {_homepage("url")} AS homepage, ends_with(url, 'robots.txt') AS robots_file,
       contains(url, '?') AS has_query
FROM selected"""

S3_PARTS = """
WITH paths AS (
  SELECT page_id, url AS path FROM pages
  UNION ALL SELECT page_id, regexp_replace(url, '^[a-z]+://', 's3://') FROM pages)
SELECT page_id, path,
       CASE WHEN starts_with(path, 's3://')
            THEN split_part(substr(path, 6), '/', 1) END AS bucket,
       CASE WHEN starts_with(path, 's3://')
            THEN substr(path, 6 + strpos(substr(path, 6), '/')) END AS "key"
FROM paths"""

BYTE_RANGES = f"""
WITH {SELECTED}
SELECT 's3://crawl-data/' || warc_filename AS uri, warc_record_offset AS range_start,
       warc_record_offset + warc_record_length AS range_end
FROM selected"""

# --- selection -------------------------------------------------------------------------------

SELECTED_URLS = f"WITH {SELECTED} SELECT {_FIVE} FROM selected"

INDEX_PARTITION_SCAN = f"""
WITH {SELECTED} SELECT {_FIVE} FROM selected WHERE crawl = 'CC-MAIN-2020-50' AND variant <> 3"""

# The path patterns are part of the specification.
INDEX_HOMEPAGE_LEVEL1 = f"""
WITH {SELECTED},
ccindex AS (
  SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS url_path,
         CASE WHEN contains(url, '?') THEN regexp_extract(url, '\\?([^#]*)', 1) END AS url_query,
         regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS url_host_name,
         regexp_extract(url, '^[a-z]+://(?:[^/?#]*\\.)?([^./?#]+\\.[^./?#]+)', 1)
           AS url_host_registered_domain,
         CASE WHEN variant = 3 THEN 'robotstxt' ELSE 'warc' END AS subset
  FROM selected)
SELECT {_FIVE} FROM ccindex
WHERE subset = 'warc' AND url_query IS NULL
  AND (length(url_path) = 0 OR url_path = '/' OR regexp_matches(url_path, '^/[^/]+/?$')
       OR regexp_matches(url_path, '^/[^/]+$')
       OR (regexp_matches(url_path, '^/?(?:index\\.(?:html?|php))?$')
           AND (length(url_host_name) = length(url_host_registered_domain)
                  AND substr(url, 1, 8) = 'https://'
                OR length(url_host_name) = length(url_host_registered_domain) + 4
                  AND substr(url_host_name, 1, 4) = 'www.')))"""

STORAGE_FILES = f"WITH {SELECTED} SELECT DISTINCT crawl FROM selected"

INCREMENTAL_PICKUP = f"""
WITH {SELECTED} SELECT {_FIVE} FROM selected WHERE crawl <> 'CC-MAIN-2020-45'"""

UNSEEN_FILES = """
SELECT 'documents/' || doc_id || '.json.gz' AS path FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

ROOT_PAGES = f"WITH {SELECTED} SELECT page_id, url FROM selected WHERE {_p7('url')}"

ROOT_HOMEPAGES = f"WITH {SELECTED} SELECT page_id, url FROM selected WHERE {_homepage('url')}"

ROOT_PAGE_COUNT = f"""
WITH {SELECTED}
SELECT crawl, count(*) AS root_pages FROM selected WHERE {_p7("url")} GROUP BY crawl"""

DOMAIN_COUNTS = f"""
WITH {SELECTED} SELECT fqdn_no_www, count(*) AS pages FROM selected GROUP BY fqdn_no_www"""

FIRST_PER_DOMAIN = f"""
WITH {RANKED} SELECT page_id, variant, url FROM ranked WHERE rn <= 3"""

CAPPED_PAGES = f"""
WITH {RANKED} SELECT page_id, variant, url FROM capped WHERE {_p7("url")}"""

CAPPED_RUNS = f"""
WITH {SELECTED},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY fqdn_no_www ORDER BY page_id % 2, url, warc_filename, warc_record_offset) AS rn
  FROM selected)
SELECT page_id, variant, url FROM ranked WHERE rn <= 3 OR {_homepage("url")}"""

CAPPED_HOMEPAGES = f"""
WITH {RANKED} SELECT page_id, variant, url FROM capped WHERE {_homepage("url")}"""

SELECTION_STATS = f"""
WITH {RANKED},
counts AS (
  SELECT (SELECT count(*) FROM selected) AS seen, (SELECT count(*) FROM capped) AS kept,
         (SELECT count(*) FROM capped WHERE {_p7("url")}) AS root)
SELECT seen AS urls_seen, seen - kept AS urls_skipped_same_domain, root AS urls_returned,
       CAST(100 * root AS DOUBLE) / seen AS returned_percent
FROM counts"""

# --- e-mails ---------------------------------------------------------------------------------


# The address pattern and the image endings are part of the specification.
def _emails(text: str) -> str:
    return (
        f"[e FOR e IN regexp_extract_all({text}, '[\\w\\.-]+@[\\w\\.-]+\\.\\w+') "
        "IF NOT regexp_matches(lower(e), '\\.(jpg|jpeg|gif|png)')]"
    )


def _email_rows(key: str, text: str, source: str) -> str:
    return f"""
WITH found AS (SELECT {key}, {_emails(text)} AS emails FROM {source})
SELECT {key}, unnest(range(len(emails))) AS position, unnest(emails) AS email FROM found"""


EMAILS_PAGES = _email_rows("page_id", "html", "pages")
EMAILS_DOCUMENTS = _email_rows("doc_id", "text", "documents")
EMAIL_COUNTS = f"SELECT doc_id, len({_emails('text')}) AS emails FROM documents"
EMAILS_BY_HOST = f"""
SELECT DISTINCT {_host("url")} AS fqdn_no_www, unnest({_emails("html")}) AS email FROM pages"""

# --- catalog ---------------------------------------------------------------------------------

CATALOG_PATTERNS = """
WITH apps AS (SELECT *, p_name || '#' || p_partkey AS app_name FROM part)
SELECT app_name, 'headers' AS evidence, 'X-Brand' AS header_name, p_brand AS pattern FROM apps
UNION ALL SELECT app_name, 'html', NULL, '\\(' || p_name || '([a-z]+)(?:\\d|[(])' FROM apps
UNION ALL SELECT app_name, 'scripts', NULL, p_type || '\\.js' FROM apps"""

CATALOG_REJECTS = """
SELECT p_name || '#' || p_partkey AS app_name, 'scripts' AS evidence, 'a(b' || p_partkey AS pattern
FROM part"""

CATALOG_GROUPS = """
WITH apps AS (
  SELECT p_name || '#' || p_partkey AS app_name,
         '\\(' || p_name || '(?:[a-z]+)(?:\\d|[(])' AS non_capturing
  FROM part)
SELECT app_name, non_capturing, '(?:' || non_capturing || ')' AS grouped,
       '(?smd)' || non_capturing AS body_regex,
       '(?sid)^(?:' || non_capturing || ')' AS header_regex
FROM apps"""

CATALOG_AMBIGUOUS = r"""
SELECT p_name || '#' || p_partkey AS app_name, unnest([
         '(x+)+' || p_partkey || '$', '(xy+)+' || p_partkey || '$',
         '(?:' || lower(p_type) || '\s*|\s*)*' || p_partkey, '(?:[a-z]+ )*' || p_partkey]) AS pattern,
       unnest(['backtracking', 'none', 'backtracking', 'none']) AS reason
FROM part"""

CATALOG_UNIONS = """
SELECT app_name, '(?smd)' || string_agg('(?:' || pattern || ')', '|' ORDER BY pattern) AS regex,
       CAST(0 AS BIGINT) AS alone
FROM (SELECT DISTINCT p_brand AS app_name, '(' || p_name || ')[0-9]|' || lower(p_type) || '+#' AS pattern
      FROM part)
GROUP BY app_name"""

APP_IDS_KEPT = """
WITH steps AS (
  SELECT 1 AS step, p_name AS app_name FROM part WHERE p_size <= 10
  UNION ALL SELECT 2, p_brand FROM part
  UNION ALL SELECT 3, p_name FROM part),
ids AS (
  SELECT app_name, row_number() OVER (ORDER BY min(step), app_name) AS app_id FROM steps GROUP BY app_name)
SELECT p_partkey, p_name AS app_name, app_id FROM part JOIN ids ON p_name = app_name"""

APP_DIM = """
SELECT row_number() OVER (ORDER BY app_name) AS app_id, app_name
FROM (SELECT DISTINCT p_name AS app_name FROM part)"""

APP_IDS = f"""
WITH dim AS ({APP_DIM})
SELECT p_partkey, app_id, app_name FROM part JOIN dim ON p_name = app_name"""

# --- technologies ----------------------------------------------------------------------------

# The patterns of the sample catalog, tags cut off.
_CATALOG = """
signatures(app_name, evidence, header_name, pattern) AS (VALUES
  ('1C-Bitrix', 'headers', 'Set-Cookie', 'BITRIX_'),
  ('1C-Bitrix', 'headers', 'X-Powered-CMS', 'Bitrix Site Manager'),
  ('Ad Server', 'html', NULL, '<div class="ad">'),
  ('Ad Server', 'html', NULL, '<!-- ad \\d+ -->'),
  ('Apache', 'headers', 'Server', '(?:Apache|HTTPD)(?:/([\\d.]+))?'),
  ('Click Tracker', 'scripts', NULL, 'track\\([0-9]*7\\)'),
  ('Data Table', 'html', NULL, '<table[^>]*>'),
  ('German Edition', 'html', NULL, '<html[^>]+lang="de"'),
  ('Inline Style', 'html', NULL, '<style>[^<]+</style>'),
  ('Inline Style', 'scripts', NULL, 'track\\(1'),
  ('Inline Style', 'scripts', NULL, 'track\\(2'),
  ('Site Footer', 'html', NULL, '<(?:footer|FOOTER)'),
  ('nginx', 'headers', 'Server', 'nginx(?:/([\\d.]+))?'))"""

_HEADERS = f"""
headers AS (
  SELECT page_id, url, unnest(['X-Note', 'Set-Cookie', 'X-Powered-CMS', 'Server']) AS header_name,
         unnest(['a: b', host,
                 CASE WHEN starts_with(url, 'https:') THEN 'bitrix site manager 9' ELSE 'none' END,
                 CASE WHEN starts_with(host, 'blog.') THEN 'nginx/1.' ELSE 'Apache/2.' END
                   || page_id]) AS header_value
  FROM (SELECT page_id, url, {_host("url")} AS host FROM pages))"""

_MATCHES = f"""{_CATALOG},{_HEADERS},
matches AS (
  SELECT DISTINCT page_id, url, app_name, evidence AS app_type
  FROM pages JOIN signatures
    ON evidence IN ('html', 'scripts') AND regexp_matches(html, '(?sm)(?:' || pattern || ')')
  UNION ALL
  SELECT DISTINCT page_id, url, app_name, 'headers'
  FROM headers JOIN signatures USING (header_name)
  WHERE evidence = 'headers' AND regexp_matches(header_value, '(?si)^(?:' || pattern || ')'))"""


def _matches_of(kind: str) -> str:
    return f"""
WITH {_MATCHES} SELECT page_id, url, app_name, app_type FROM matches WHERE app_type = '{kind}'"""


TECH_HTML = _matches_of("html")
TECH_SCRIPTS = _matches_of("scripts")
TECH_HEADERS = _matches_of("headers")
HEADERS_PARSED = f"WITH {_HEADERS} SELECT page_id, header_name, header_value FROM headers"

TECH_MANY_SIGNATURES = """
WITH words AS (
  SELECT DISTINCT unnest(regexp_extract_all(html, '<a href="/([^"]+)">', 1)) AS word FROM pages),
calls AS (
  SELECT DISTINCT unnest(regexp_extract_all(html, 'track\\((\\d+)\\)', 1)) AS word FROM pages),
signatures AS (
  SELECT 'link ' || word AS app_name, 'html' AS app_type,
         '<a href="/' ||
         regexp_replace(word, '([.^$|?*+(){}\\[\\]\\\\])', '\\\\\\1', 'g') || '">[^<]+</a>' AS pattern
  FROM words
  UNION ALL
  SELECT 'track ' || word, 'scripts', 'track\\(' || word || '\\);?</script>' FROM calls)
SELECT DISTINCT page_id, app_name, app_type
FROM pages JOIN signatures ON regexp_matches(html, '(?sm)(?:' || pattern || ')')"""

TECH_REPEATED_PAGES = f"""
SELECT page_id, app_name, app_type, CAST(2 AS BIGINT) AS times FROM ({TECH_MANY_SIGNATURES})"""

TECH_LINE_ENDS = """
WITH bodies AS (
  SELECT page_id, replace(html, '>', '>' || CASE page_id % 5
    WHEN 0 THEN chr(10) WHEN 1 THEN chr(13) WHEN 2 THEN chr(13) || chr(10)
    WHEN 3 THEN chr(133) ELSE chr(8232) END) AS body
  FROM pages)
SELECT DISTINCT page_id, app_name, 'html' AS app_type
FROM bodies JOIN (VALUES ('Paragraph', '^<p>'), ('Text End', '</p>$'), ('Page End', '</html>$')) s(app_name, pattern)
  ON regexp_matches(body, '(?sm)(?:' || pattern || ')')"""


def _sunday(year: str, week: str) -> str:
    return (
        f"CAST(epoch(date_trunc('week', make_date({year}, 1, 1) + 6) "
        f"+ to_days(CAST(({week} - 1) * 7 + 6 AS INTEGER))) AS BIGINT)"
    )


_CRAWL_SUNDAY = _sunday(
    "CAST(split_part(crawl, '-', 3) AS INTEGER)", "CAST(split_part(crawl, '-', 4) AS INTEGER)"
)

_FACTS = f"""{_MATCHES},
facts AS (
  SELECT {_CRAWL_SUNDAY} AS seen_time_epoch, CAST(1609459200 AS BIGINT) AS process_time_epoch,
         'cc:' || crawl AS source, {_host("url")} AS fqdn_no_www, url AS page_url,
         app_type, app_name
  FROM (SELECT *, {CRAWL} AS crawl FROM matches))"""

TECH_FACTS = f"WITH {_FACTS} SELECT * FROM facts"

HOST_APP_TYPES = f"WITH {_FACTS} SELECT DISTINCT fqdn_no_www, app_name, app_type FROM facts"


def _by_host(facts: str) -> str:
    return f"""
WITH {facts},
firsts AS (
  SELECT *, row_number() OVER (
    PARTITION BY fqdn_no_www ORDER BY seen_time_epoch, page_url, process_time_epoch, source,
    app_name, app_type) AS rn
  FROM facts),
pairs AS (
  SELECT fqdn_no_www, string_agg(app_name || ':' || app_type, ',' ORDER BY app_name, app_type)
    AS name_type_list
  FROM (SELECT DISTINCT fqdn_no_www, app_name, app_type FROM facts) GROUP BY fqdn_no_www)
SELECT fqdn_no_www, seen_time_epoch, process_time_epoch, source, page_url, name_type_list
FROM firsts JOIN pairs USING (fqdn_no_www) WHERE rn = 1"""


TECH_BY_HOST = _by_host(_FACTS)

FIRST_MATCHES = f"""
WITH {_FACTS},
firsts AS (
  SELECT *, row_number() OVER (
    PARTITION BY fqdn_no_www ORDER BY seen_time_epoch, page_url, process_time_epoch, source,
    app_name, app_type) AS rn
  FROM facts)
SELECT * EXCLUDE (rn) FROM firsts WHERE rn = 1"""

FACT_STATS = f"""
WITH {_FACTS},
counts AS (
  SELECT count(DISTINCT fqdn_no_www) AS hosts_added,
         count(DISTINCT (fqdn_no_www, app_name, app_type)) AS signatures_new,
         count(*) AS technologies
  FROM facts)
SELECT *, technologies - signatures_new AS signatures_repeated FROM counts"""

EVIDENCE_STATS = f"""
WITH {_FACTS}
SELECT app_type, count(*) AS technologies, count(DISTINCT (fqdn_no_www, page_url)) AS pages,
       count(DISTINCT fqdn_no_www) AS hosts
FROM facts GROUP BY app_type"""

EXTRACT_FINDINGS = f"""
WITH {_MATCHES}
SELECT page_id, 'technology:' || app_type AS kind, app_name AS "value"
FROM matches WHERE app_type <> 'headers'
UNION ALL
SELECT page_id, 'email', email
FROM (SELECT DISTINCT page_id, unnest({_emails("html")}) AS email FROM pages)"""

# --- crawls ----------------------------------------------------------------------------------


def _crawl_of(date: str) -> str:
    return (
        f"'CC-MAIN-' || year({date}) || '-' || "
        f"lpad(CAST((dayofyear({date}) + 6) // 7 AS VARCHAR), 2, '0')"
    )


CRAWL_EPOCH = f"""
SELECT crawl, {_CRAWL_SUNDAY} AS epoch
FROM (SELECT DISTINCT {_crawl_of("o_orderdate")} AS crawl FROM orders)"""

CRAWL_EPOCH_LOOKUP = f"""
WITH calendar AS (
  SELECT {_crawl_of("o_orderdate")} AS crawl, min(o_orderkey) AS epoch FROM orders GROUP BY 1),
shipped AS (SELECT {_crawl_of("l_shipdate")} AS crawl FROM lineitem)
SELECT 'cc:' || crawl AS source, coalesce(epoch, {_CRAWL_SUNDAY}) AS seen_time_epoch,
       count(*) AS items
FROM shipped LEFT JOIN calendar USING (crawl) GROUP BY 1, 2"""

JSON_ROWS = """
SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k,
       '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS line
FROM events"""

# --- archives --------------------------------------------------------------------------------

DECODE_BYTES = """
WITH texts AS (
  SELECT page_id, true AS utf8, html AS body FROM pages
  UNION ALL
  SELECT page_id, false, array_to_string(
    [chr(CAST('0x' || pair AS INTEGER))
     FOR pair IN regexp_extract_all(hex(encode(html)) || 'E9', '..')], '')
  FROM pages)
SELECT page_id, utf8, length(body) AS chars, md5(body) AS text_md5 FROM texts"""

_RESPONSES = f"""
responses AS (
  SELECT page_id, url,
         concat('HTTP/1.1 200 OK', eol, 'Server: first', eol, 'X-Note: a: b', eol,
                'Set-Cookie: ', host, eol, 'X-Powered-CMS: ',
                CASE WHEN starts_with(url, 'https:') THEN 'bitrix site manager 9' ELSE 'none' END,
                eol, 'Server: ',
                CASE WHEN starts_with(host, 'blog.') THEN 'nginx/1.' ELSE 'Apache/2.' END,
                page_id, eol, eol, html) AS response
  FROM (SELECT *, {_host("url")} AS host, chr(13) || chr(10) AS eol FROM pages))"""

WARC_RANGE_READ = f"WITH {_RESPONSES} SELECT page_id, url, md5(response) AS text_md5 FROM responses"

WARC_ARCHIVE_SCAN = f"""
WITH {_RESPONSES}
SELECT url, CAST(200 AS BIGINT) AS http_status, md5(response) AS payload_md5 FROM responses"""

FETCH_OUTCOMES = """
SELECT page_id, count(*) AS "read", 2 * count(*) AS failed FROM pages GROUP BY page_id"""

SCAN_REJECTS = """
SELECT regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/' || page_id AS url,
       CASE page_id % 3 WHEN 0 THEN 'ValueError' ELSE 'FileNotFoundError' END AS reason,
       unnest(['batch', 'stream']) AS via
FROM pages WHERE page_id % 3 < 2"""

# The archived record of a URL holds the page that the URL was derived from.
TECHNOLOGY_SCAN_JOB = _by_host(
    f"""{RANKED},{_CATALOG},
fetched AS (SELECT c.url, c.crawl, c.fqdn_no_www, p.page_id, p.html
            FROM capped c JOIN pages p ON c.page_id = p.page_id WHERE {_p7("c.url")}),
heads AS (
  SELECT url, crawl, fqdn_no_www,
         unnest(['Set-Cookie', 'X-Powered-CMS', 'Server']) AS header_name,
         unnest([fqdn_no_www,
                 CASE WHEN starts_with(url, 'https:') THEN 'bitrix site manager 9' ELSE 'none' END,
                 CASE WHEN starts_with(fqdn_no_www, 'blog.') THEN 'nginx/1.' ELSE 'Apache/2.' END
                   || page_id]) AS header_value
  FROM fetched),
found AS (
  SELECT url, crawl, fqdn_no_www, app_name, evidence AS app_type
  FROM fetched JOIN signatures
    ON evidence IN ('html', 'scripts') AND regexp_matches(html, '(?sm)(?:' || pattern || ')')
  UNION ALL
  SELECT url, crawl, fqdn_no_www, app_name, 'headers'
  FROM heads JOIN signatures USING (header_name)
  WHERE evidence = 'headers' AND regexp_matches(header_value, '(?si)^(?:' || pattern || ')')),
facts AS (
  SELECT {_CRAWL_SUNDAY} AS seen_time_epoch, CAST(1609459200 AS BIGINT) AS process_time_epoch,
         'cc:' || crawl AS source, fqdn_no_www, url AS page_url, app_type, app_name
  FROM found)"""
)

STREAM_SCAN_COUNTERS = f"""
WITH {SELECTED},{_CATALOG},
fetched AS (SELECT c.page_id, c.variant, c.url, {_host("c.url")} AS host, p.html
            FROM selected c JOIN pages p ON c.page_id = p.page_id WHERE {_p7("c.url")}),
heads AS (
  SELECT page_id, variant, unnest(['Set-Cookie', 'X-Powered-CMS', 'Server']) AS header_name,
         unnest([host,
                 CASE WHEN starts_with(url, 'https:') THEN 'bitrix site manager 9' ELSE 'none' END,
                 CASE WHEN starts_with(host, 'blog.') THEN 'nginx/1.' ELSE 'Apache/2.' END
                   || page_id]) AS header_value
  FROM fetched),
found AS (
  SELECT page_id, variant, app_name, evidence
  FROM fetched JOIN signatures
    ON evidence IN ('html', 'scripts') AND regexp_matches(html, '(?sm)(?:' || pattern || ')')
  UNION
  SELECT page_id, variant, app_name, evidence
  FROM heads JOIN signatures USING (header_name)
  WHERE evidence = 'headers' AND regexp_matches(header_value, '(?si)^(?:' || pattern || ')'))
SELECT (SELECT count(*) FROM fetched) AS fetched, CAST(0 AS BIGINT) AS failed,
       (SELECT count(*) FROM found) AS facts"""

# --- streams ---------------------------------------------------------------------------------

# A window is out once the watermark, a minute behind the newest event, has reached its end.
STREAM_HOST_WINDOW = """
WITH facts AS (
  SELECT CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS seen_time_epoch,
         'user-' || user_id AS fqdn_no_www, 'event-' || event_id AS page_url,
         event_type AS app_name
  FROM events),
held AS (
  SELECT *, seen_time_epoch - seen_time_epoch % 86400 AS window_start FROM facts),
firsts AS (
  SELECT *, row_number() OVER (
    PARTITION BY window_start, fqdn_no_www ORDER BY seen_time_epoch, page_url) AS rn
  FROM held),
pairs AS (
  SELECT window_start, fqdn_no_www,
         string_agg(app_name || ':html', ',' ORDER BY app_name) AS name_type_list
  FROM (SELECT DISTINCT window_start, fqdn_no_www, app_name FROM held) GROUP BY 1, 2)
SELECT window_start, fqdn_no_www, seen_time_epoch, page_url, name_type_list
FROM firsts JOIN pairs USING (window_start, fqdn_no_www)
WHERE rn = 1"""

STREAM_HOST_HOLD = """
WITH RECURSIVE facts AS (
  SELECT epoch_us(ts) AS us, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS seen_time_epoch,
         'user-' || user_id AS fqdn_no_www, 'event-' || event_id AS page_url,
         event_type AS app_name
  FROM events),
starts AS (
  SELECT fqdn_no_www, min(us) AS hold_start FROM facts GROUP BY fqdn_no_www
  UNION ALL
  SELECT s.fqdn_no_www, min(f.us)
  FROM starts s JOIN facts f ON f.fqdn_no_www = s.fqdn_no_www AND f.us >= s.hold_start + 86400000000
  GROUP BY s.fqdn_no_www, s.hold_start),
held AS (
  SELECT f.*, s.hold_start
  FROM facts f JOIN starts s
    ON f.fqdn_no_www = s.fqdn_no_www AND f.us >= s.hold_start AND f.us < s.hold_start + 86400000000),
firsts AS (
  SELECT *, row_number() OVER (
    PARTITION BY hold_start, fqdn_no_www ORDER BY seen_time_epoch, page_url) AS rn
  FROM held),
pairs AS (
  SELECT hold_start, fqdn_no_www,
         string_agg(app_name || ':html', ',' ORDER BY app_name) AS name_type_list
  FROM (SELECT DISTINCT hold_start, fqdn_no_www, app_name FROM held) GROUP BY 1, 2)
SELECT hold_start, fqdn_no_www, seen_time_epoch, page_url, name_type_list
FROM firsts JOIN pairs USING (hold_start, fqdn_no_www)
WHERE rn = 1"""


# A signature ends two days after its last match before a pause of that length.
STREAM_SESSIONS = """
WITH facts AS (
  SELECT epoch_us(ts) AS us, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS seen_time_epoch,
         'user-' || user_id AS fqdn_no_www, 'event-' || event_id AS page_url,
         event_type AS app_name
  FROM events),
marked AS (
  SELECT *, CASE WHEN us - lag(us) OVER w <= 172800000000 THEN 0 ELSE 1 END AS starts
  FROM facts WINDOW w AS (PARTITION BY fqdn_no_www, app_name ORDER BY us)),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY fqdn_no_www, app_name ORDER BY us) AS session FROM marked)
SELECT max(us) + 172800000000 AS known_until, fqdn_no_www, app_name, min(seen_time_epoch) AS seen_time_epoch,
       arg_min(page_url, (seen_time_epoch, page_url)) AS page_url, count(*) AS matches
FROM numbered GROUP BY fqdn_no_www, app_name, session"""
