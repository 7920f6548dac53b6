import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlspark.operators import match, rule_index
from crawlspark.sources.catalog import catalog_rows

WORDS = ["wp-content", "track(7)", "<div id=app>", "jquery.js", "äöü", "react", "\n"]


def made_pages(spark, n=200):
    source = random.Random(5)
    pages = [(i, "".join(source.choices(WORDS, k=source.randint(0, 6)))) for i in range(n)]
    return pages, spark.createDataFrame([*pages, (n, None)], "page_id int, html string")


def made_catalog(spark, many):
    """Patterns that Java and Python read alike; with ``many``, too many to try one by one."""
    rows = [
        ("WP", "html", None, "wp-content"),
        ("WP", "html", None, "wp-[a-z]+"),
        ("Track", "scripts", None, r"track\(\d\)<div"),
        ("Any", "html", None, "(react|jquery)"),
        ("Start", "html", None, "^react"),
        ("Dot", "scripts", None, "jquery.js.*äöü"),
        ("Ahead", "html", None, "wp-content(?!wp)"),
        ("Short", "html", None, "j"),
    ]
    if many:
        rows += [(f"N{i}", "scripts", None, rf"jquery\.js+react|x{i}") for i in range(5)]
        rows += [(f"M{i}", "html", None, rf"react(?:track)?.{{{i}}}jquery") for i in range(60)]
    return rows, catalog_rows(spark, rows)


def brute(pages, rules):
    return {
        (page, app, kind)
        for page, text in pages
        for app, kind, _, pattern in rules
        if re.search(pattern, text, re.DOTALL | re.MULTILINE | re.ASCII)
    }


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("many", [False, True])
def test_against_brute_force(spark, plan, many):
    pages, df = made_pages(spark)
    rules, catalog = made_catalog(spark, many)
    result = match.match_pages(df, catalog)
    assert found(result) == brute(pages, rules)
    text = plan(result)
    assert ("ArrowEvalPython" in text) == many
    assert "Exchange" not in text and "Join" not in text


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize("per_share", [3, 5_000])
def test_repeated_pages_have_rows_of_their_own(spark, many, per_share):
    pages, df = made_pages(spark)
    rules, catalog = made_catalog(spark, many)
    rows = [tuple(r) for r in match.match_pages(df.union(df), catalog, rules_per_share=per_share).collect()]
    assert sorted(rows) == sorted([*brute(pages, rules)] * 2)


def test_alternatives_count_as_rules(spark, monkeypatch):
    monkeypatch.setattr(match, "INDEX_ABOVE", 2)
    # one row, three rules
    catalog = catalog_rows(spark, [("A", "html", None, "ab|cd|ef")])
    df = spark.createDataFrame([(1, "x cd ef"), (2, "c d"), (3, "ab")], "page_id int, html string")
    assert found(match.match_pages(df, catalog)) == {(1, "A", "html"), (3, "A", "html")}


@pytest.mark.parametrize("literal", [64, 0])
def test_only_a_line_feed_ends_a_line(spark, monkeypatch, literal):
    monkeypatch.setattr(match, "LITERAL_MAX", literal)
    text = "foo\r\nbar baz\u0085qux\u2028end"
    rules = [(p, "html", None, p) for p in ("foo$", "bar$", "^bar", "^baz", "^qux", "^end", "end$")]
    df = spark.createDataFrame([(1, text)], "page_id int, html string")
    assert found(match.match_pages(df, catalog_rows(spark, rules))) == {(1, "^bar", "html"), (1, "end$", "html")}
    heads = spark.createDataFrame([(1, "", {"A": "x\u0085"})], "page_id int, html string, h map<string,string>")
    rules = [("End", "headers", "A", "x$"), ("All", "headers", "A", "X.$")]
    assert found(match.match_pages(heads, catalog_rows(spark, rules), headers="h")) == {(1, "All", "headers")}


def test_a_large_catalog_on_a_stream(spark, tmp_path):
    pages, df = made_pages(spark)
    rules, catalog = made_catalog(spark, True)
    df.write.parquet(str(tmp_path / "in"))
    stream = match.match_pages(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), catalog, rules_per_share=20)
    run = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
    run.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert found(spark.read.parquet(str(tmp_path / "out"))) == brute(pages, rules)


def test_kinds(spark):
    pages, df = made_pages(spark)
    rules, catalog = made_catalog(spark, False)
    expected = {f for f in brute(pages, rules) if f[2] == "scripts"}
    assert found(match.match_pages(df, catalog, kinds=["scripts"])) == expected


def test_empty_catalog(spark):
    _, df = made_pages(spark, 3)
    assert match.match_pages(df, catalog_rows(spark, [])).count() == 0


HEADERS = [
    ("Gate", "headers", "Via", "(?:\\d\\.)?\\d gate-[a-f]"),
    ("Gate", "headers", "X-Trace", "$"),
    ("nginx", "headers", "Server", "nginx(?:/([\\d.]+))?"),
]


@pytest.mark.parametrize(
    "headers, apps",
    [
        # a match begins where the value does, in any case, and may end early
        ({"Via": "1.1 GATE-F, 2 proxy"}, {"Gate"}),
        ({"Via": "proxy, 1.1 gate-a"}, set()),
        ({"Via": "11 gate-a"}, set()),
        # only an empty value or one that a line feed ends
        ({"X-Trace": ""}, {"Gate"}),
        ({"X-Trace": "0"}, set()),
        # names are compared as they are
        ({"via": "1 gate-a", "x-trace": ""}, set()),
        ({"Server": "Nginx\nx", "Other": "nginx", "Via": "2 gate-g"}, {"nginx"}),
        ({"Server": "nginx/1.2", "Via": "2 gate-b", "X-Trace": ""}, {"Gate", "nginx"}),
        ({}, set()),
    ],
)
def test_headers(spark, headers, apps):
    catalog = catalog_rows(spark, HEADERS)
    page = spark.createDataFrame([(1, "", headers)], "page_id int, html string, headers map<string,string>")
    in_row = match.match_pages(page, catalog, headers="headers")
    long = page.select("page_id", F.explode("headers").alias("header_name", "header_value"))
    expected = {(1, app, "headers") for app in apps}
    assert found(in_row) == expected
    assert found(match.match_headers(long, catalog)) == expected


def test_pages_without_headers(spark):
    page = spark.createDataFrame([(1, "wp-content", None)], "page_id int, html string, headers map<string,string>")
    catalog = catalog_rows(spark, [*HEADERS, ("WP", "html", None, "wp-content")])
    assert found(match.match_pages(page, catalog, headers="headers")) == {(1, "WP", "html")}


def test_header_join_broadcasts_a_small_catalog(spark, plan):
    long = spark.createDataFrame([(1, "Server", "nginx")], "page_id int, header_name string, header_value string")
    assert "BroadcastHashJoin" in plan(match.match_headers(long, catalog_rows(spark, HEADERS)))


def test_extractors(spark):
    pages = spark.createDataFrame([(1, "wp-content a@b.cc a@b.cc"), (2, "")], "page_id int, html string")
    catalog = catalog_rows(spark, [("WP", "html", None, "wp-content")])
    rows = match.extract(pages, [match.technology_extractor(catalog), match.email_extractor()])
    assert rows._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    assert found(rows) == {(1, "technology:html", "WP"), (1, "email", "a@b.cc")}


@pytest.mark.parametrize("lists", [1, 7, 2_000])
def test_catalogs_of_any_size_are_joined(spark, monkeypatch, lists):
    monkeypatch.setattr(match, "INDEX_ABOVE", 2)
    monkeypatch.setattr(rule_index, "RULES_PER_LIST", lists)
    pages, df = made_pages(spark)
    rules, catalog = made_catalog(spark, lists != 1)
    rows = [tuple(r) for r in match.match_pages(df.union(df), catalog).collect()]
    assert sorted(rows) == sorted([*brute(pages, rules)] * 2)


def test_joined_headers(spark, monkeypatch):
    monkeypatch.setattr(match, "INDEX_ABOVE", 2)
    page = spark.createDataFrame([(1, "wp-content", {"Server": "nginx", "Via": "3 gate-c"}), (1, "", None), (2, None, {"server": "nginx"})], "page_id int, html string, headers map<string,string>")
    catalog = catalog_rows(spark, [*HEADERS, ("WP", "html", None, "wp-content"), ("Any", "html", None, "[a-z]+")])
    expected = {(1, "Gate", "headers"), (1, "nginx", "headers"), (1, "WP", "html"), (1, "Any", "html")}
    assert found(match.match_pages(page, catalog, headers="headers")) == expected
    every = match.technologies(page, catalog, headers="headers")
    assert sorted((r["page_id"], len(r["found"])) for r in every.collect()) == [(1, 0), (1, 4), (2, 0)]


def test_joined_catalog_is_no_constant_of_the_plan(spark, monkeypatch, plan):
    monkeypatch.setattr(match, "INDEX_ABOVE", 50)
    catalog = spark.range(300).selectExpr("concat('app', id) app_name", "'html' evidence", "cast(null as string) header_name", "concat('unmistakable-', id, '[a-z]+') pattern")
    page = spark.createDataFrame([(1, "x unmistakable-7b unmistakable-299 unmistakable-12é")], "page_id int, html string")
    result = match.match_pages(page, catalog)
    assert found(result) == {(1, "app7", "html")}
    assert "unmistakable" not in result._jdf.queryExecution().toString()


def test_large_catalogs_are_refused_on_streams(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(match, "MAX_RULES", 2)
    _, df = made_pages(spark, 3)
    df.write.parquet(str(tmp_path / "in"))
    with pytest.raises(match.TooManyRules):
        match.match_pages(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), made_catalog(spark, True)[1])


@pytest.mark.parametrize("most", [0, 20_000])
def test_extractor_with_headers(spark, monkeypatch, most):
    monkeypatch.setattr(match, "INDEX_ABOVE", most)
    pages = spark.createDataFrame([(1, "wp-content a@b.cc", {"Server": "nginx"}), (1, "a@b.cc", None)], "page_id int, html string, headers map<string,string>")
    catalog = catalog_rows(spark, [*HEADERS, ("WP", "html", None, "wp-content")])
    rows = match.extract(pages, [match.email_extractor(), match.technology_extractor(catalog, headers="headers")])
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "email", "a@b.cc")] * 2 + [(1, "technology:headers", "nginx"), (1, "technology:html", "WP")]


def test_pieces():
    for text in (b"", b"a", b"ab", b"abcdefghijk", bytes(range(256)) * 3):
        for size in rule_index.PIECE_SIZES:
            runs = [text[i : i + size] for i in range(len(text) - size + 1)]
            found = [int(x) for part in rule_index.pieces(text, size) for x in part]
            assert len(found) == len(runs) and len(set(found)) == len(set(runs))
    long = bytes(range(251)) * 5_000
    assert sum(len(p) for p in rule_index.pieces(long, 8)) == len(long) - 7
    words = np.full(1 << 10, 2**64 - 1, np.uint64)
    inside = {int(x) for x in rule_index.page_pieces("nach außen gehen".encode(), words)}
    assert {int(x) for x in rule_index.rule_pieces(["außen", "ch", "geh"])} <= inside
    assert not len(rule_index.page_pieces(b"", words))


def test_queries_with_derived_catalogs_as_tables(spark, monkeypatch):
    from crawlspark.plans import queries

    names = ["tech_many_signatures", "tech_repeated_pages", "extract_findings", "technology_scan_job"]
    whole = [sorted(map(str, queries.QUERIES[n](spark, "/root/testdata/sf0.001").collect())) for n in names]
    monkeypatch.setattr(match, "INDEX_ABOVE", 0)
    assert [sorted(map(str, queries.QUERIES[n](spark, "/root/testdata/sf0.001").collect())) for n in names] == whole


@pytest.mark.parametrize("limits", [(0, 0), (0, 2_000), (64, 2_000)])
def test_header_unions(spark, monkeypatch, limits):
    """All ways to check headers give the same, also patterns that no union can hold."""
    monkeypatch.setattr(match, "LITERAL_MAX", limits[0])
    monkeypatch.setattr(match, "UNION_MAX", limits[1])
    rules = [("Num", "headers", "Age", r"\d{2}"), ("Twice", "headers", "Via", r"(\w)\1"), ("Via", "headers", "Via", "x|y"),
             ("Flag", "headers", "Tag", r"(?-i)Ab"), ("Tag", "headers", "Tag", "ab$"), ("No", "headers", None, "a")]
    catalog = catalog_rows(spark, rules[:-1])
    values = [{"Age": "123", "Via": "aab"}, {"Age": "1", "Via": "yes"}, {"Tag": "AB"}, {"Tag": "Abc"}, {"tag": "ab"}, {}]
    pages = spark.createDataFrame(list(enumerate(values)), "page_id int, headers map<string,string>").withColumn("html", F.lit(""))
    expected = {(0, "Num"), (0, "Twice"), (1, "Via"), (2, "Tag"), (3, "Flag")}
    in_row = match.match_pages(pages, catalog, headers="headers")
    assert {(r.page_id, r.app_name) for r in in_row.collect()} == expected
    long = pages.select("page_id", F.explode("headers").alias("header_name", "header_value"))
    got = match.match_headers(long, catalog_rows(spark, rules)).collect()
    assert {(r.page_id, r.app_name) for r in got} == expected
