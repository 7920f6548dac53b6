from pyspark.sql import functions as F

from crawlspark.operators import rollup
from crawlspark.schemas import HOST_ROLLUP, MATCH_FACT

FACTS = [
    (5, 9, "cc:A", "a.com", "http://a.com/2", "html", "X"),
    (5, 9, "cc:A", "a.com", "http://a.com/1", "html", "X"),
    (5, 9, "cc:A", "a.com", "http://a.com/1", "scripts", "X"),
    (7, 9, "cc:B", "a.com", "http://a.com/0", "headers", "B"),
    (5, 9, "cc:A", "b__c", "http://b__c/", "html", "d"),
    (5, 9, "cc:A", "b", "http://b/", "html", "c__d"),
]


def facts(spark, times=1):
    return spark.createDataFrame(FACTS * times, MATCH_FACT).repartition(3)


def test_rollup(spark):
    rolled = rollup.rollup_hosts(facts(spark, 3))
    assert [f.name for f in rolled.schema] == HOST_ROLLUP.fieldNames()
    rows = {r.fqdn_no_www: r for r in rolled.collect()}
    assert rows.keys() == {"a.com", "b__c", "b"}
    a = rows["a.com"]
    assert (a.seen_time_epoch, a.page_url, a.source) == (5, "http://a.com/1", "cc:A")
    assert [tuple(p) for p in a.name_type_list] == [("B", "headers"), ("X", "html"), ("X", "scripts")]


def test_rollup_shuffles_once(spark, plan):
    text = plan(rollup.rollup_hosts(facts(spark)))
    assert text.count("Exchange hashpartitioning(fqdn_no_www") == 1
    assert "partial_min" in text and "partial_collect_set" in text


def test_signatures_and_first_match(spark):
    distinct = rollup.distinct_signatures(facts(spark, 2))
    assert distinct.count() == 5
    first = {r.fqdn_no_www: r for r in rollup.first_match_per_host(facts(spark)).collect()}
    assert (first["a.com"].page_url, first["a.com"].app_type) == ("http://a.com/1", "html")


def test_stats(spark):
    row = rollup.fact_stats(facts(spark, 2)).first()
    assert (row.hosts_added, row.signatures_new, row.technologies, row.signatures_repeated) == (3, 5, 12, 7)
    assert rollup.fact_stats(facts(spark).limit(0)).first().technologies == 0
    kinds = {r.app_type: tuple(r)[1:] for r in rollup.evidence_stats(facts(spark)).collect()}
    assert kinds == {"html": (4, 4, 3), "scripts": (1, 1, 1), "headers": (1, 1, 1)}


def test_pairs_of_the_rollup_are_the_signatures(spark):
    df = facts(spark, 4)
    pairs = rollup.rollup_hosts(df).select("fqdn_no_www", F.inline("name_type_list"))
    assert sorted(pairs.collect()) == sorted(rollup.distinct_signatures(df).collect())


def test_to_facts(spark):
    found = spark.createDataFrame(
        [("https://www.a.com/x", "CC-MAIN-2020-40", "X", "html")],
        "url string, crawl string, app_name string, app_type string",
    )
    assert [tuple(r) for r in rollup.to_facts(found, 9).collect()] == [
        (1602374400, 9, "cc:CC-MAIN-2020-40", "a.com", "https://www.a.com/x", "html", "X")
    ]


def test_observed(spark):
    df, counters = rollup.observed(facts(spark), html=F.col("app_type") == "html")
    df.write.format("noop").mode("overwrite").save()
    assert counters.get == {"rows": 6, "html": 4}
