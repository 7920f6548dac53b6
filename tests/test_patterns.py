from pyspark.sql import functions as F
import pytest

from crawlspark.functions import patterns


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "pattern, plain",
    [
        (r"a(b)c\;version:\1", r"a(b)c"),
        (r"a\;confidence:50\;version:\1", "a"),
        ("a;b", "a;b"),
    ],
)
def test_strip_tags(spark, pattern, plain):
    assert value(spark, pattern, patterns.strip_tags) == plain


@pytest.mark.parametrize(
    "pattern, plain",
    [
        ("a(b)(?:c)", "a(?:b)(?:c)"),
        (r"\(a(b\))", r"\(a(?:b\))"),
        (r"\\(a)", r"\\(?:a)"),
        ("[(](a)[^(]", "[(](?:a)[^(]"),
        ("(?=a)((b))", "(?=a)(?:(?:b))"),
        ("(?i)a\\(", "(?i)a\\("),
        ("[](](a)", "[](](?:a)"),
        ("", ""),
    ],
)
def test_non_capturing(spark, pattern, plain):
    assert value(spark, pattern, patterns.non_capturing) == plain


@pytest.mark.parametrize(
    "text, listed",
    [('["a", "b\\\\."]', ["a", "b\\."]), ("a", ["a"]), ("[a-z]+", ["[a-z]+"]), (None, [])],
)
def test_as_list(spark, text, listed):
    assert value(spark, text, patterns.as_list) == listed


def test_is_valid(spark):
    for pattern, valid in [("a(b", False), ("a(?!b)", True), ("(?<n>a)", True), ("a)(b", False)]:
        assert value(spark, pattern, patterns.is_valid) is valid


@pytest.mark.parametrize(
    "pattern, texts",
    [
        ("wp-content", ["wp-content"]),
        (r"<script[^>]+lib\.js", ["<script", "lib.js"]),
        (r"track\(12\);?</script>", ["track(12)", "</script>"]),
        ("abc+def", ["abc", "def"]),
        ("ab[cd]e", ["ab"]),
        ("abcd?efg", ["abc", "efg"]),
        ("abcd*?xyz", ["abc", "xyz"]),
        ("abc(def)?xyz", ["abc", "xyz"]),
        ("abc(d|(e(f)))xyz", ["abc", "xyz"]),
        ("abcd{0,2}xyz", ["abc", "xyz"]),
        (r"abc\\xyz", ["abc\\xyz"]),
        (r"abc\+\.xyz", ["abc+.xyz"]),
        (r"abc\.?xyz", ["abc", "xyz"]),
        (r"abc\d\pLxyz", ["abc", "xyz"]),
        (r"abc\"xyz", ['abc"xyz']),
        (r"abc[\]x]xyz", ["abc", "xyz"]),
        ("abc|def", None),
        ("(?i)abc", None),
        ("(?x)abc def", None),
        (r"\Qabc\E", None),
        (r"\x41bc|abc", None),
        ("abc\\" + "u0041", None),
        ("[a[bcd]]efg", None),
        ("ab", ["ab"]),
        ("a", None),
        ("(abc)", None),
    ],
)
def test_required_texts(spark, pattern, texts):
    assert value(spark, pattern, patterns.required_texts) == texts


@pytest.mark.parametrize(
    "pattern, text",
    [
        ('<div class="ad">', '<div class="ad">'),
        (r"a\.b\\c\(\/", "a.b\\c(/"),
        ("a.b", None),
        ("(ab)", None),
        (r"ab\d", None),
        (r"\x41b", None),
        ("a|b", None),
        ("^ab", None),
        ("ab]", None),
        ("a", None),
    ],
)
def test_literal_text(spark, pattern, text):
    assert value(spark, pattern, patterns.literal_text) == text


@pytest.mark.parametrize(
    "pattern, parts",
    [
        ("abc", ["abc"]),
        ("abc|def", ["abc", "def"]),
        ("(?:abc|def)", ["abc", "def"]),
        ("(?:a|b)c|d(e|(f|g))\\|h", ["(?:a|b)c", "d(e|(f|g))\\|h"]),
        ("(a|b)", ["(a|b)"]),
        ("a||b|", ["a", "", "b", ""]),
        (r"a\\|b\(|c", [r"a\\", r"b\(", "c"]),
        ("(?i)a|b", ["(?i)a|b"]),
        (r"(a)\1|b", [r"(a)\1|b"]),
        ("[(|]a|b", ["[(|]a|b"]),
        ("[^x]a|b", ["[^x]a", "b"]),
        ("(?:a)(?:b|c)|d", ["(?:a)(?:b|c)", "d"]),
        ("((((((a|b))))))|c", ["((((((a|b))))))|c"]),
    ],
)
def test_alternatives(spark, pattern, parts):
    assert value(spark, pattern, patterns.alternatives) == parts


def test_required_texts_are_in_every_match(spark):
    """Against generated patterns: a text that matches always holds the texts."""
    import itertools
    import random

    source = random.Random(7)
    pieces = ["abc", "xyz", "a", ".", "b?", "(abc|xyz)", "(?:ab)c", "[xyz]", "c+", "a*", r"\.", "z{2}", "b{0,1}", "^", "(a(b)?c)?", "|", r"\w", r"\(", "y??", "(?=ab)"]
    made = {"".join(source.choices(pieces, k=source.randint(1, 6))) for _ in range(700)}
    texts = ["".join(source.choices("abcxyz.(", k=source.randint(1, 14))) for _ in range(300)]
    texts += ["".join(t) for t in itertools.product(["abc", "xyz", "ab", "zz", ".", "("], repeat=3)]
    rules = spark.createDataFrame([(m,) for m in sorted(made)], "p string")
    rules = rules.where(patterns.is_valid(F.col("p")))
    pages = spark.createDataFrame([(texts,)], "t array<string>")
    every = rules.join(F.broadcast(pages)).select("p", F.explode("t").alias("t"))
    parts = F.exists(
        patterns.alternatives(F.col("p")), lambda part: F.rlike(F.col("t"), patterns.body_regex(part))
    )
    assert every.where(parts != F.rlike("t", patterns.body_regex(F.col("p")))).collect() == []

    rules = rules.select("p", patterns.required_texts(F.col("p")).alias("texts"))
    known = [(r.p, r.texts) for r in rules.collect() if r.texts]
    assert len(known) > 100
    rules = spark.createDataFrame(known, "p string, texts array<string>")
    pairs = rules.join(F.broadcast(pages)).select("p", "texts", F.explode("t").alias("t"))
    matching = pairs.where(F.rlike("t", patterns.body_regex(F.col("p"))))
    missed = matching.where(F.exists("texts", lambda x: ~F.contains(F.col("t"), x)))
    assert matching.count() > 300
    assert missed.collect() == []
