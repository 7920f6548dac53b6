import json

from pyspark.sql import functions as F

from crawlspark.sources import catalog

APPS = {
    "Cache": {"headers": {"Age": "\\d{4,}\\;version:\\1\\;confidence:10"}, "html": []},
    "One": {"html": "<one(\\d)\\;version:\\1", "script": ["a\\(b", "[xy]\\.js\\;confidence:50"]},
    "Ahead": {"html": ["x(?!y)"]},
    "Broken": {"html": ["a(b", "fine"], "headers": {"X": "("}},
    "Nothing": {},
    "Class": {"script": "[a-z]+\\.js"},
}

EXPECTED = [
    ("Ahead", "html", None, "x(?!y)"),
    ("Broken", "html", None, "fine"),
    ("Cache", "headers", "Age", "\\d{4,}"),
    ("Class", "scripts", None, "[a-z]+\\.js"),
    ("One", "html", None, "<one(\\d)"),
    ("One", "scripts", None, "[xy]\\.js"),
    ("One", "scripts", None, "a\\(b"),
]


def load(spark, tmp_path):
    path = tmp_path / "apps.json"
    path.write_text(json.dumps({"apps": APPS}, indent=2))
    return catalog.explode_apps(catalog.read_apps(spark, str(path)))


def test_catalog_file(spark, tmp_path):
    loaded = load(spark, tmp_path)
    good = [tuple(r) for r in catalog.valid_patterns(loaded).collect()]
    assert sorted(good, key=str) == sorted(EXPECTED, key=str)
    bad = catalog.rejected_patterns(loaded).select("app_name", "evidence", "pattern").collect()
    assert sorted(bad) == [("Broken", "headers", "("), ("Broken", "html", "a(b")]


def test_catalog_text(spark, tmp_path):
    text = spark.createDataFrame([(json.dumps({"apps": APPS}),)], "t string")
    exploded = catalog.explode_apps(catalog.parse_apps(text, "t"))
    assert sorted(exploded.collect(), key=str) == sorted(load(spark, tmp_path).collect(), key=str)


def test_app_dim(spark):
    rows = catalog.catalog_rows(spark, EXPECTED)
    dim = dict((r.app_name, r.app_id) for r in catalog.app_dim(rows).collect())
    assert dim == {"Ahead": 1, "Broken": 2, "Cache": 3, "Class": 4, "One": 5}
    assert rows.where(F.col("header_name").isNull()).count() == 6
