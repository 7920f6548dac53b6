"""Technology detection: pages against a catalog of signatures.

A page is matched inside its own row, so detection neither shuffles nor pairs every page with
every pattern. Two steps:

1. *Candidates.* Most patterns have texts that every match contains (``required_texts``). The page
   is searched for them: with ``contains`` for a small catalog; for a large one in one pass over
   the page, whatever the number of patterns.
2. *Check.* The regular expressions of the candidates, and of the patterns without such texts, run
   on the page. A pattern that is a text and nothing else needs no check.

Both ways give the same rows, as does a third for catalogs of more rules than a plan should hold: rules
and pages are then joined by the text pieces they share (``rule_index``).
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import patterns
from crawlspark.functions.emails import find_emails
from crawlspark.operators.rule_index import indexed_matches
from crawlspark.runtime import bound_batches, broadcast_if_small, work_dir

BODY_KINDS = ("html", "scripts")

# Up to this many patterns with sure texts are tried one by one
ONE_BY_ONE_MAX = 12

# Up to this many patterns without such texts, or for headers, are constants of the plan, which
# are compiled once
LITERAL_MAX = 64

# Up to this many header rules are constants, behind one expression per header name
UNION_MAX = 2_000

# Rules that travel to the tasks as one constant; a larger catalog is several
RULES_PER_SHARE = 5_000

# Constants of one plan: tasks with many more cannot be serialized, so shares grow instead
MAX_SHARES = 20

# Rules that a plan holds when alternatives are split; larger catalogs are joined as a table
INDEX_ABOVE = 5_000

# What a catalog for a stream may hold, which is always a part of the plan
MAX_RULES = 200_000

_FOUND = "array<struct<app_name:string,app_type:string>>"
_RULES = (
    "array<struct<app_name:string,app_type:string,header_name:string,regex:string,"
    "texts:array<string>>>"
)


class TooManyRules(ValueError):
    """A catalog is larger than what one pass over the pages takes."""


def match_pages(
    pages: DataFrame,
    catalog: DataFrame,
    text: str = "html",
    headers: str | None = None,
    kinds: Sequence[str] = BODY_KINDS,
    rules_per_share: int = RULES_PER_SHARE,
) -> DataFrame:
    """Distinct ``app_name``, ``app_type`` per page, all kinds in one pass.

    ``text`` is searched by the patterns of ``kinds``. With ``headers``, a map column, the header
    patterns are applied too. Both columns are left out of the result. Every page row gives its own
    rows, for a catalog of any size. ``pages`` may be a stream for catalogs of up to MAX_RULES; beyond,
    match its batches.
    """
    found = technologies(pages, catalog, text, headers, kinds, rules_per_share, "_found")
    kept = [c for c in pages.columns if c not in (text, headers)]
    return found.select(*kept, F.explode("_found").alias("_found")).select(*kept, "_found.*")


def _saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def technologies(
    pages: DataFrame,
    catalog: DataFrame,
    text: str = "html",
    headers: str | None = None,
    kinds: Sequence[str] = BODY_KINDS,
    rules_per_share: int = RULES_PER_SHARE,
    name: str = "found",
) -> DataFrame:
    """The same with a row for every page, which holds its (app_name, app_type) as ``name``.

    For a catalog of more than INDEX_ABOVE rules, pages and findings are written on the way.
    """
    bound_batches(pages.sparkSession)
    if headers is not None:
        kinds = [*kinds, "headers"]
    wanted = catalog.where(F.col("evidence").isin(list(kinds)))
    rules = _rules(wanted, MAX_RULES if pages.isStreaming else INDEX_ABOVE)
    kept = [c for c in pages.columns if c not in (text, headers)]
    if rules is not None:
        return pages.select(*kept, _evidence(rules, text, headers, rules_per_share).alias(name))
    if pages.isStreaming:
        raise TooManyRules(f"more than {MAX_RULES} rules: match the stream's batches")
    rows = _saved(pages.withColumn("_row", F.monotonically_increasing_id()), "pages")
    matched = indexed_matches(rows, _rule_rows(wanted), text, headers, _saved)
    apps = matched.groupBy("_row").agg(F.collect_list(F.struct("app_name", "app_type")).alias(name))
    none = F.array().cast(_FOUND)
    return rows.select("_row", *kept).join(apps, "_row", "left").select(*kept, F.coalesce(name, none).alias(name))


def _rule_rows(catalog: DataFrame) -> DataFrame:
    """Patterns as they are run, with the texts they need."""
    is_header, pattern = F.col("evidence") == "headers", F.col("pattern")
    parts = F.when(is_header, F.array(pattern)).otherwise(patterns.alternatives(pattern))
    rules = catalog.withColumn("pattern", F.explode(parts))
    literal = F.when(~is_header, patterns.literal_text(pattern))
    body = F.when(literal.isNull(), patterns.body_regex(pattern))
    needed = patterns.required_texts(pattern)
    texts = F.when(literal.isNotNull(), F.array(literal)).otherwise(needed)
    return rules.select(
        "app_name",
        F.col("evidence").alias("app_type"),
        "header_name",
        F.when(is_header, patterns.header_regex(pattern)).otherwise(body).alias("regex"),
        F.when(~is_header, texts).alias("texts"),
    )


def _rules(catalog: DataFrame, most: int) -> list[dict] | None:
    """Rules in the driver, or None if there are more than ``most``. One action reads and checks them."""
    rows = _rule_rows(catalog).limit(most + 1).collect()
    return None if len(rows) > most else [row.asDict() for row in rows]


def _shares(rules: list[dict], size: int) -> Iterator[list[dict]]:
    size = max(size, -(-len(rules) // MAX_SHARES))
    for start in range(0, len(rules), size):
        yield rules[start : start + size]


def _evidence(
    rules: list[dict], text: str, headers: str | None = None, per_share: int = RULES_PER_SHARE
) -> Column:
    """The distinct ``app_name``, ``app_type`` of a page."""
    body = [r for r in rules if r["app_type"] != "headers"]
    certain = [r for r in body if r["texts"]]
    unsure = [r for r in body if not r["texts"]]
    found = []
    if len(unsure) <= LITERAL_MAX:
        found.append(_literal_check(unsure, F.col(text)))
    else:
        found += [_check(_array(share), F.col(text)) for share in _shares(unsure, per_share)]
    if len(certain) <= ONE_BY_ONE_MAX:
        found.append(_literal_check(certain, F.col(text)))
    else:
        for share in _shares(certain, per_share):
            positions = _text_finder([r["texts"] for r in share])(F.col(text))
            found.append(_check(F.transform(positions, _entry(_array(share))), F.col(text)))
    if headers is not None:
        header_rules = [r for r in rules if r["app_type"] == "headers"]
        found.append(_check_headers(header_rules, F.col(headers)))
    return F.array_distinct(F.concat(*(F.coalesce(f, F.array().cast(_FOUND)) for f in found)))


def _entry(rules: Column) -> Callable[[Column], Column]:
    return lambda position: F.get(rules, position)


def _array(rules) -> Column:
    """Rules as one constant."""
    return F.from_json(F.lit(json.dumps(list(rules))), _RULES)


def _check(rules: Column, text: Column) -> Column:
    return _apps(F.filter(rules, lambda r: r["regex"].isNull() | F.rlike(text, r["regex"])))


def _literal_check(rules: list[dict], text: Column | None, headers: Column | None = None) -> Column:
    """Rules as constants of the plan, one by one: their regular expressions are compiled once."""
    hits = []
    for rule in rules:
        value = text if headers is None else F.element_at(headers, F.lit(rule["header_name"]))
        tests = [F.contains(value, F.lit(part)) for part in rule["texts"] or []]
        if rule["regex"] is not None:
            tests.append(F.rlike(value, F.lit(rule["regex"])))
        app = F.struct(F.lit(rule["app_name"]).alias("app_name"), F.lit(rule["app_type"]).alias("app_type"))
        hits.append(F.when(reduce(Column.__and__, tests), app))
    return F.array_compact(F.array(*hits)) if hits else F.array().cast(_FOUND)


def _check_headers(rules: list[dict], headers: Column) -> Column:
    """J3 inside the row: the patterns listed for a header's name against its value."""
    if len(rules) <= LITERAL_MAX:
        return _literal_check(rules, None, headers)
    if len(rules) <= UNION_MAX:
        return _union_check(rules, lambda name: F.element_at(headers, F.lit(name)))
    by_name = _by_name(rules)
    known = F.from_json(F.lit(json.dumps(by_name)), f"map<string,{_RULES}>")

    def apps(header: Column) -> Column:
        listed = F.coalesce(F.element_at(known, header["key"]), F.array().cast(_RULES))
        return _apps(F.filter(listed, lambda rule: F.rlike(header["value"], rule["regex"])))

    return F.flatten(F.transform(F.map_entries(headers), apps))


def _by_name(rules: list[dict]) -> dict[str, list[dict]]:
    by_name: dict[str, list[dict]] = {}
    for rule in rules:
        by_name.setdefault(rule["header_name"], []).append(rule)
    return by_name


def _union(rules: list[dict]) -> str | None:
    """one expression for the rules of a header name, if all can stand beside each other."""
    regexes = sorted({rule["regex"] for rule in rules})
    if any(re.search(r"\\[1-9kQ]|\(\?<[a-zA-Z]|\(\?[a-zA-Z]*x", regex) for regex in regexes):
        return None
    # flags inside a group end with it
    return "|".join(f"(?:{regex})" for regex in regexes)


def _union_check(rules: list[dict], value_of: Callable[[str], Column]) -> Column:
    """Header rules as constants: a name's rules are tried one by one only where their union matches."""
    found = []
    for name, own in _by_name(rules).items():
        value, union = value_of(name), _union(own)
        hits = [
            F.when(
                F.rlike(value, F.lit(rule["regex"])),
                F.struct(F.lit(rule["app_name"]).alias("app_name"), F.lit(rule["app_type"]).alias("app_type")),
            )
            for rule in own
        ]
        apps = F.array_compact(F.array(*hits))
        found.append(apps if union is None else F.when(F.rlike(value, F.lit(union)), apps))
    none = F.array().cast(_FOUND)
    return F.concat(*(F.coalesce(f, none) for f in found))


def _apps(rules: Column) -> Column:
    return F.transform(
        rules, lambda r: F.struct(r["app_name"].alias("app_name"), r["app_type"].alias("app_type"))
    )


def _text_finder(needed: list[list[str]]) -> Callable[[Column], Column]:
    """A function that gives the positions in ``needed`` whose texts are all in a page."""
    shared = Counter(text for texts in needed for text in texts)
    # search for the text of a pattern that the fewest patterns share, look for the others after
    keyed: dict[str, list[int]] = {}
    for position, texts in enumerate(needed):
        key = min(texts, key=lambda text: (shared[text], -len(text)))
        keyed.setdefault(key, []).append(position)

    import ahocorasick  # package pyahocorasick: fails here, at plan time, where it is missing

    @F.pandas_udf("array<int>")
    def find(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = ahocorasick.Automaton()
        for key in keyed:
            search.add_word(key, key)
        search.make_automaton()

        def candidates(page: str | None) -> list[int]:
            if not page:
                return []
            keys = {key for _, key in search.iter(page)}
            positions = (position for key in keys for position in keyed[key])
            return [p for p in positions if all(text in page for text in needed[p])]

        for batch in pages:
            yield batch.map(candidates)

    return find


def match_headers(headers: DataFrame, catalog: DataFrame) -> DataFrame:
    """J3 on a long table with ``header_name``, ``header_value``: join on the name, then regex.

    Up to UNION_MAX rules, only rows that the union of their name's rules matches are joined; the unions are
    constants, compiled once a task.
    """
    wanted = catalog.where((F.col("evidence") == "headers") & F.col("header_name").isNotNull())
    rules = wanted.select("app_name", "header_name", patterns.header_regex(F.col("pattern")).alias("_regex"))
    listed = rules.limit(UNION_MAX + 1).collect()
    if len(listed) <= UNION_MAX:
        by_name = _by_name([{"header_name": r["header_name"], "regex": r["_regex"]} for r in listed])
        hit = F.lit(False)
        for name, own in by_name.items():
            union, named = _union(own), F.col("header_name") == F.lit(name)
            hit = hit | (named if union is None else named & F.rlike("header_value", F.lit(union)))
        headers = headers.where(hit)
    kept = [c for c in headers.columns if c not in ("header_name", "header_value")]
    return (
        headers.join(broadcast_if_small(rules), "header_name")
        .where(F.rlike("header_value", F.col("_regex")))
        .select(*kept, "app_name", F.lit("headers").alias("app_type"))
        .distinct()
    )


# An extractor is a column, the findings of a page as an array of (kind, value), or a function that
# gives (key, kind, value) rows of all pages.
_FINDINGS = "array<struct<kind:string,value:string>>"
Extractor = Column | Callable[[DataFrame, str], DataFrame]


def _finding(kind: Column, value: Column) -> Column:
    return F.struct(kind.alias("kind"), value.alias("value"))


def technology_extractor(catalog: DataFrame, text: str = "html", headers: str | None = None) -> Extractor:
    """Technologies by ``text``, and by the map column ``headers`` if one is named."""
    kinds = [*BODY_KINDS, "headers"] if headers is not None else list(BODY_KINDS)
    bound_batches(catalog.sparkSession)
    rules = _rules(catalog.where(F.col("evidence").isin(kinds)), INDEX_ABOVE)

    def finding(found: Column) -> Column:
        return _finding(F.concat(F.lit("technology:"), found["app_type"]), found["app_name"])

    if rules is not None:
        return F.transform(_evidence(rules, text, headers), finding)

    def findings(pages: DataFrame, key: str) -> DataFrame:
        read = [key, text] if headers is None else [key, text, headers]
        found = technologies(pages.select(*read), catalog, text, headers, name="_found")
        return found.select(key, F.explode(F.transform("_found", finding)).alias("_found")).select(key, "_found.*")

    return findings


def email_extractor(text: str = "html") -> Column:
    found = F.array_distinct(find_emails(F.col(text)))
    return F.transform(found, lambda email: _finding(F.lit("email"), email))


def extract(pages: DataFrame, extractors: Sequence[Extractor], key: str = "page_id") -> DataFrame:
    """The findings of several extractors. Those that are columns share one pass over the pages, which may
    be a stream; that of a catalog too large for a plan makes joins of its own and takes no stream.
    """
    none = F.array().cast(_FINDINGS)
    columns = [e for e in extractors if isinstance(e, Column)]
    found = F.concat(none, *(F.coalesce(e.cast(_FINDINGS), none) for e in columns))
    out = pages.select(key, F.explode(found).alias("_found")).select(key, "_found.*")
    for findings in extractors:
        if not isinstance(findings, Column):
            out = out.unionByName(findings(pages, key))
    return out
