"""A small signature catalog in the format of a catalog file."""

# The entry 1C-Bitrix, by which a given case is checked. The others are our own.
SAMPLE_CATALOG = r"""
{"apps": {
  "1C-Bitrix": {"headers": {"Set-Cookie": "BITRIX_", "X-Powered-CMS": "Bitrix Site Manager"}},
  "Ad Server": {"html": ["<div class=\"ad\">", "<!-- ad \\d+ -->"]},
  "Apache": {"headers": {"Server": "(?:Apache|HTTPD)(?:/([\\d.]+))?\\;version:\\1"}},
  "Click Tracker": {"script": "track\\([0-9]*7\\)\\;confidence:50"},
  "Data Table": {"html": "<table[^>]*>"},
  "German Edition": {"html": "<html[^>]+lang=\"de\""},
  "Inline Style": {
    "html": "<style>[^<]+</style>\\;version:1", "script": ["track\\(1", "track\\(2"]
  },
  "Site Footer": {"html": "<(?:footer|FOOTER)"},
  "nginx": {"headers": {"Server": "nginx(?:/([\\d.]+))?\\;version:\\1"}}
}}
"""
