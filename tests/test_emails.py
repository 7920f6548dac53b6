import random
import re
import time

import pytest
from pyspark.sql import functions as F

from crawlspark.functions.emails import find_emails
from crawlspark.operators.emails import emails_by_host, explode_emails

PLAIN = re.compile(r"[\w\.-]+@[\w\.-]+\.\w+", re.ASCII)


def found(spark, bodies):
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    rows = rows.select("i", find_emails(F.col("body")).alias("emails")).orderBy("i")
    return [r.emails for r in rows.collect()]


@pytest.mark.parametrize("edge", "aZ0_.-")
def test_characters_of_an_address(spark, edge):
    """Every class of character at both ends of the local part and at the start of the domain."""
    bodies = [f"{edge}x@y.z", f"x{edge}@y.z", f"x@{edge}y.z", f"({edge}@{edge}.q)"]
    assert found(spark, bodies) == [[f"{edge}x@y.z"], [f"x{edge}@y.z"], [f"x@{edge}y.z"], [f"{edge}@{edge}.q"]]


@pytest.mark.parametrize("outside", " é<>\";,:/+%'(\n")
def test_characters_around_an_address(spark, outside):
    """Other characters end the local part, the domain and its last label, and are part of none."""
    assert found(spark, [f"w{outside}x@y.zz{outside}w", f"x{outside}@y.zz", f"x@y.{outside}zz"]) == [["x@y.zz"], [], []]


@pytest.mark.parametrize(
    "body, emails",
    [
        # the last label has no dot or hyphen, so these stay outside
        ("x@y.zz.", ["x@y.zz"]),
        ("x@y.zz-", ["x@y.zz"]),
        ("x@y-zz", []),
        # two signs: the second cannot be in a domain
        ("x@@y.zz", []),
        ("x@y@z.ww", ["y@z.ww"]),
        # what ends one address begins the next
        ("x@y.zz.-@d.e", ["x@y.zz", ".-@d.e"]),
        ("x@y.zz@d.e", ["x@y.zz"]),
        # image names go, repeats stay
        ("x@1.gIf x@1.gift x@y.zz x@y.zz", ["x@y.zz", "x@y.zz"]),
    ],
)
def test_ends_of_an_address(spark, body, emails):
    assert found(spark, [body]) == [emails]


def test_finds_what_the_plain_pattern_finds(spark):
    source = random.Random(1)
    bodies = ["".join(source.choices("ab.@- _<é", k=source.randint(1, 30))) for _ in range(5000)]
    assert found(spark, bodies) == [PLAIN.findall(b) for b in bodies]


def test_long_runs_take_linear_time(spark):
    begin = time.time()
    assert found(spark, ["x" * 2_000_000 + " @ " + "y" * 2_000_000 + "@z"]) == [[]]
    assert time.time() - begin < 20


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "https://www.a.com/1", "x@y.zz q@r.ss"), (2, "http://a.com/2", "x@y.zz"), (3, "http://b.com", "")],
        "page_id int, url string, html string",
    )
    rows = explode_emails(pages.select("page_id", "html"), "html")
    assert sorted(rows.collect()) == [(1, 0, "x@y.zz"), (1, 1, "q@r.ss"), (2, 0, "x@y.zz")]
    assert sorted(emails_by_host(pages).collect()) == [("a.com", "q@r.ss"), ("a.com", "x@y.zz")]
