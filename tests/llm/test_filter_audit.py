import itertools
import random
import re

import pytest

from crawlspark.llm import filter_audit

DOCS = "doc_id long, text string, lang string, mask int, digest string, part string"
LABELS = "doc_id long, quality int, toxic int, text string"


def by_hand(docs, labels):
    """Rows of the audit by playing all orders."""
    masked = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in docs)
        failed = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            re.search(r"[#$%&*|]", text) is not None,
            copy,
        ]
        own = [x for x in labels if doc_id is not None and x[0] == doc_id]
        masked.append((lang or "", failed, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    rows, removals = [], {}
    for part in {m[0] for m in masked}:
        for order in itertools.permutations(range(5)):
            left, gone = [m for m in masked if m[0] == part], []
            name = "".join("ABCDE"[i] for i in order)
            for step, i in enumerate(order, 1):
                removed = [m for m in left if m[1][i]]
                left = [m for m in left if not m[1][i]]
                redundant = sum(m[1][i] for m in gone)
                gone += removed
                unique = sum(m[0] == part and m[1][i] and sum(m[1]) == 1 for m in masked)
                removals[part, i] = removals.get((part, i), 0) + len(removed)
                good, toxic = sum(m[2] for m in removed), sum(m[3] for m in removed)
                rows.append((part, name, step, len(left), len(removed), redundant, unique, good, toxic, i))
    return sorted((*r[:-1], removals[r[0], r[-1]]) for r in rows)


def many(n=400):
    random.seed(3)
    texts = [None, "", " \t", "one word", "a#b", "É" * 40 + "A", "ABC " * 210, "word " * 300]
    texts += [" ".join(f"w{random.randrange(900)}" for _ in range(random.choice([150, 260]))) + random.choice(["", " $", " LOUD" * 40]) for _ in range(30)]
    docs = [(random.choice([None, i, i, i // 3]), random.choice(texts), random.choice(["en", "de", None, ""])) for i in range(n)]
    labels = [(random.choice([None, random.randrange(n)]), random.choice([None, 0, 1]), random.choice([None, 0, 1])) for _ in range(n)]
    return docs, labels


@pytest.mark.parametrize(
    "docs, labels",
    [
        many(),
        ([(1, "x", "en")] * 3 + [(0, "x", "de"), (None, "x", "en"), (None, "x", "en")], [(0, 1, 0), (0, 0, 1), (1, 1, None)]),
        ([(None, None, None)], []),
        ([], [(1, 1, 1)]),
    ],
)
def test_audit_is_that_of_played_orders(spark, docs, labels):
    found = filter_audit.audit_filters(
        spark.createDataFrame([(*d, 7, "x", "y") for d in docs], DOCS),
        spark.createDataFrame([(*x, "t") for x in labels], LABELS),
    )
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in found.collect()) == by_hand(docs, labels)


def test_limits_of_the_filters():
    def bits(text):
        return filter_audit.fails(text.encode(), len(text))

    fresh = [f"w{i}x" for i in range(200)]
    assert bits(" ".join(fresh)) == 0 and bits(" ".join(fresh[1:])) == 1
    assert bits(" ".join(fresh[:100] * 2)) == 0 and bits(" ".join(fresh[:100] * 2 + ["w1x"])) == 2
    assert bits(" ".join(fresh)[:97] + "ABC") == 1 and bits(" ".join(fresh)[:97] + "ABCD") == 5
    assert bits("é " * 200 + "A" * 12) == 2 and bits("é " * 200 + "A" * 13) == 6
    assert bits(" ".join(fresh) + "|") == 8 and bits(" ".join(fresh) + "^") == 0
    assert bits("x\x0by\x0cz z " * 60) == 0b11


def test_very_long_text(spark):
    text = " ".join(str(i) for i in range(1_500_000))
    docs = spark.createDataFrame([(2, text, "en"), (1, text, "en")], "doc_id long, text string, lang string")
    masks = sorted((r["doc_id"], r["mask"]) for r in filter_audit.judged(docs).collect())
    assert masks == [(1, 0), (2, 0)]


def test_row_limit_of_recursions_follows_the_parts(spark):
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "500")
        cells = spark.createDataFrame([(f"p{i}", 1 + i % 2, False, False, i) for i in range(6)], "part string, mask int, good boolean, toxic boolean, n long")
        found = filter_audit.walk_orders(cells, "ABC")
        assert found.count() == 6 * 6 * 3
        first = found.filter("part = 'p3' and filter_order = 'CBA'").orderBy("step").collect()
        assert [(r["removed"], r["kept"], r["shapley"]) for r in first] == [(0, 3, 0), (3, 0, 18), (0, 0, 0)]
    finally:
        spark.conf.set(limit, before)
