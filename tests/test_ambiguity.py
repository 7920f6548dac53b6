import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlspark.functions import ambiguity
from crawlspark.functions.ambiguity import can_explode
from crawlspark.plans import queries
from crawlspark.sources import catalog

EXPLODING = [
    r"(a+)+$", r"(a*)*b", r"(a|a)*b", r"(?:a?b?)*c", r"(x+x+)+y", r"(?:\s*\w+\s*)+=", r"(a|aa)+$", r"([a-z]+)*\d",
    r"(?:a{2,3})+$", r"(.*)*x", r"(?:(?:a+)+b)*c", r"^(\d+)*$",
]
FINE = [
    r"(ab+)+$", r"(a+)+", r"[^>]*>", r"(?:[a-z]+\.)+com", r".*a.*b", r"(?:\d{4})+$", r"(a|b)*c", r"(?:a?)+", r"(?:/\w+)*/x",
    r'<script[^>]+src="[^"]*lib-\d+\.js', r"(?:ab|cd)+e", r'(?:[^"\\]|\\.)*"', "", r"(a)\1+$", r"a(b", r"\p{L}+", r"(a++)+$", r"x{1000}",
]


@pytest.mark.parametrize("pattern", EXPLODING)
def test_exploding(pattern):
    assert can_explode(pattern)


@pytest.mark.parametrize("pattern", FINE)
def test_fine(pattern):
    assert not can_explode(pattern)


def test_case_counts_where_it_is_ignored():
    assert can_explode("(a+A)+$", ignore_case=True) and not can_explode("(a+A)+$")
    assert can_explode("(é+[à-ÿ])+$") and not can_explode("(é+ā)+$")


parts = st.recursive(
    st.sampled_from(["a", "b", "[ab]"]),
    lambda p: st.one_of(
        st.tuples(p, p).map("".join),
        st.tuples(p, p).map(lambda x: f"(?:{x[0]}|{x[1]})"),
        st.tuples(p, st.sampled_from("*+?")).map(lambda x: f"(?:{x[0]}){x[1]}"),
    ),
    max_leaves=5,
)


def ways(tree, text, at, ends):
    """Number of ways in which a parsed pattern matches from ``at``, by place of the end; no empty turns."""
    from re import _constants as op

    if not tree:
        ends[at] = ends.get(at, 0) + 1
        return
    (kind, value), rest = tree[0], tree[1:]

    def go_on(found):
        for end, n in found.items():
            more = {}
            ways(rest, text, end, more)
            for e, m in more.items():
                ends[e] = ends.get(e, 0) + n * m

    if kind in (op.LITERAL, op.IN):
        own = {chr(value)} if kind is op.LITERAL else {chr(v) for _, v in value}
        if at < len(text) and text[at] in own:
            ways(rest, text, at + 1, ends)
    elif kind is op.SUBPATTERN:
        ways([*value[3], *rest], text, at, ends)
    elif kind is op.BRANCH:
        for alternative in value[1]:
            ways([*alternative, *rest], text, at, ends)
    else:
        least, most, body = value
        turns, found = {at: 1}, {at: 1} if least == 0 else {}
        for turn in range(len(text) + 1 if most is op.MAXREPEAT else most):
            nexts = {}
            for start, n in turns.items():
                own = {}
                ways(list(body), text, start, own)
                for e, m in own.items():
                    if e > start:
                        nexts[e] = nexts.get(e, 0) + n * m
                    elif least and turn == 0:
                        found[e] = found.get(e, 0) + n * m
            turns = nexts
            for e, n in turns.items():
                found[e] = found.get(e, 0) + n
        go_on(found)


@given(parts)
@settings(max_examples=60, deadline=None)
def test_what_counts_as_fine_has_few_ways(part):
    """Brute force: ways to match grow by a power of the length, not exponentially."""
    from re import _parser as parser

    pattern = f"{part}$"
    if can_explode(pattern):
        return
    tree = [x for x in parser.parse(pattern) if x[0] is not __import__("re")._constants.AT]
    for unit in ("a", "ab", "b"):
        text = unit * (10 // len(unit))
        ends = {}
        ways(tree, text, 0, ends)
        assert max(ends.values(), default=0) <= 400, text


texts = st.sampled_from(["", "a", "12", "ab 7", "{2", "é", "a|b", r"\d4", r"\x61", "[a]1", "x" * 150, "b{3}", "$", "^ab"])


@given(texts, parts, st.sampled_from("*+"), texts, parts, texts)
@settings(max_examples=300, deadline=None)
def test_text_outside_groups_changes_nothing(before, first, times, between, second, after):
    pattern = f"{before}(?:{first}){times}{between}(?:{second})+{after}"
    assert can_explode(pattern) == ambiguity._verdict.__wrapped__(pattern, False)[0], pattern


def test_patterns_with_equal_loops_are_judged_once(monkeypatch):
    judged, automaton = [], ambiguity._Automaton

    def counted(pattern, ignore_case):
        judged.append(pattern)
        return automaton(pattern, ignore_case)

    monkeypatch.setattr(ambiguity, "_Automaton", counted)
    ambiguity._verdict.cache_clear()
    for i in range(500):
        assert can_explode(f"shop {i}(u+)+{i * 37}$") and not can_explode(f"shop {i}(uv+)+{i * 37}$")
    assert len(judged) == 2
    # what is left out counts as states, beyond which no pattern is judged
    assert can_explode(f"(u+)+{'a' * 199}") and not can_explode(f"(u+)+{'a' * 200}")


def test_engine_agrees():
    """The engine at hand needs long for one kind and not for the other, on a text that is refused."""
    text = "a" * 18 + "!"
    for pattern, slow in ((r"(a+)+$", True), (r"(?:a|aa)+$", True), (r"(ab?)+$", False)):
        begin = time.perf_counter()
        re.match(pattern, text)
        spent = time.perf_counter() - begin
        assert can_explode(pattern) == slow and (slow or spent < 0.01)


def test_catalog_rejects_with_reason(spark):
    rows = [
        ("A", "html", None, "(a+)+$"), ("A", "html", None, "(ab+)+$"), ("A", "html", None, "a(b"), ("A", "html", None, None),
        ("B", "headers", "X", "(a+A)+$"), ("B", "scripts", None, "(a+A)+$"),
    ]
    df = catalog.catalog_rows(spark, rows)
    bad = {(r.evidence, r.pattern, r.reason) for r in catalog.rejected_patterns(df).collect()}
    assert bad == {("html", "(a+)+$", "backtracking"), ("html", "a(b", "syntax"), ("headers", "(a+A)+$", "backtracking")}
    assert {(r.evidence, r.pattern) for r in catalog.valid_patterns(df).collect()} == {("html", "(ab+)+$"), ("scripts", "(a+A)+$")}


# What Python cannot read, or what is long, nested or looked at by itself, once passed as fine
JAVA_EXPLODING = [
    r"(\p{L}+)+$", r"(\p{IsGreek}+)+$", r"(?<n>a+)+$", r"\Qx(\E(a+)+$", r"(\h+)+$", r"x(?i)(a+A)+$", r"(?d)(a+)+$", r"(?x)(a+) +$", r"(?:\R)+x",
    r"(?:[a-z&&[^b]]+)+$", r"(?:[\u0400-\u04ff]|[\u0401-\u0410])*$", r"(?:\d|\w)*$", r"(?>(a+)+b)", r"(?:(?:a+)+b)++", r"(?=(a+)+$)x",
    r"(a+)+\1", r"(a)(b+)+\1", r"(a+)+b++c", r"(a+)\Q\E+$", r"(?iu)(é+É)+$", r"(a+)+" + "b" * 200, r"(a+)+[a-z]{300}$", r"(?:(?:[a-z]{1,300}x)+)+$", r"(?:a{1,5000})+$",
    "(" * 700 + "(a+)+" + ")" * 700 + "$", f"(?:{'|'.join(f'w{i}x' for i in range(200))}|w7|x)*$", "(?:(?:a+)+x){3}", "(?:(?:a+)+){2}",
]
JAVA_FINE = [
    r"(\p{L}+\p{N})+$", r"(\p{IsGreek}x)+$", r"(?<n>ab+)+$", r"(?:[a-z&&[^b]]+b)+$", r"(?>(a+)+)", r"(?:a+)++$", r"(?:\w++\s*+)*$", r"(a++)+$",
    r"(?:(['\"])[^'\"]*\1 )*>", r"(ab)+\1", r"(?i)(é+É)+$", r"(ab+)+" + "b" * 500 + "$", r"(?:[a-z]{1,63}\.){1,127}com$", r"(?:a{5000})+$", r"(?:a{1,5000}b)+$",
    f"(?:{'|'.join(f'w{i}x' for i in range(200))})*$", "(?:(?:a+)+){1,3}", r"(?:[\u0400-\u04ff]|[\u0500-\u0510])*$",
]
NO_VERDICT = [r"(?:(a+)\1b)*$", r"(a)(?:b\1|ba)*$", r"(a)(?:(?i:\1)|A)*$", r"(?:(a)\1+b|aaab)*$", r"(?:\p{IsGreek}++a|ba)*$", r"(?:\p{IsGreek}|\p{InGreek})*$", r"(?:a{1,2000000000}b)+$", r"(?:(?>a|ab)(?>b|c)?)*$"]


@pytest.mark.parametrize("pattern", JAVA_EXPLODING)
def test_judged_as_exploding(pattern):
    assert ambiguity.judge(pattern) is True


@pytest.mark.parametrize("pattern", JAVA_FINE)
def test_judged_as_fine(pattern):
    assert ambiguity.judge(pattern) is False


@pytest.mark.parametrize("pattern", NO_VERDICT)
def test_no_verdict_is_not_fine(pattern):
    assert ambiguity.judge(pattern) is None


def test_the_first_step_says_where_it_ends():
    pattern = f"(u+)+{'a' * 200}"
    assert can_explode(pattern) is None and ambiguity.judge(pattern)


def test_catalog_rejects_what_is_not_judged(spark):
    rows = [("A", "html", None, p) for p in (*JAVA_EXPLODING, *JAVA_FINE, *NO_VERDICT, "a(b")]
    df = catalog.catalog_rows(spark, rows).repartition(2)
    reasons = {r.pattern: r.reason for r in catalog.rejected_patterns(df).collect()}
    assert reasons == dict.fromkeys(JAVA_EXPLODING, "backtracking") | dict.fromkeys(NO_VERDICT, "not judged") | {"a(b": "syntax"}
    assert {r.pattern for r in catalog.valid_patterns(df).collect()} == set(JAVA_FINE)


def test_query_judges_long_types(spark, tmp_path):
    rows = [(1, "n", "STANDARD " + "PLATED " * 50 + "TIN"), (2, "m", "ЛАТУНЬ"), (3, "o", "X" * 4000)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    got = sorted(map(tuple, queries.catalog_ambiguous(spark, str(tmp_path)).collect()))
    assert got == sorted(
        (f"{name}#{key}", pattern, reason)
        for key, name, kind in rows
        for pattern, reason in (
            (f"(x+)+{key}$", "backtracking"), (f"(xy+)+{key}$", "none"),
            (rf"(?:{kind.lower()}\s*|\s*)*{key}", "backtracking"), (f"(?:[a-z]+ )*{key}", "none"),
        )
    )


def test_union_of_an_app(spark):
    rows = [("A", "html", None, p) for p in ("b|c", "a", "a", r"(x)\1")] + [("A", "headers", "X", "v(1)"), ("B", "html", None, r"(y)\1")]
    got = {(r.app_name, r.evidence, r.header_name): (r.regex, r.alone) for r in catalog.union_patterns(catalog.catalog_rows(spark, rows)).collect()}
    assert got == {
        ("A", "html", None): ("(?smd)(?:a)|(?:b|c)", [r"(x)\1"]),
        ("A", "headers", "X"): ("(?sid)^(?:(?:v(1)))", []),
        ("B", "html", None): (None, [r"(y)\1"]),
    }
