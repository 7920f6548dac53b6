"""Operator 4: replace personal data by keyed surrogates of the same type and format."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, saved

#: After so many attempts the format of an entity counts as full: further ones are longer than it.
SAME_FORMAT = 8
#: The most characters of a real value, for types whose longer surrogates pass them.
LONGEST = {"phone": 15, "card": 19, "ssn": 9, "iban": 34}

# Titles that tell a name, with the gender they tell. Fixed values.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Signor": "m",
    "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mademoiselle": "f",
    "Señora": "f", "Señorita": "f", "Sra": "f", "Signora": "f", "Госпожа": "f", "Κυρία": "f",
    "Dr": "n", "Prof": "n", "Professor": "n",
}

# Syllables of made-up names, by script; an ending tells the gender. Fixed values.
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ka ke ki la le li lo ma me mi mo na ne ni no pa ra re ri ro sa se si ta te ti to va ve vi".split(),
    "cyrillic": "ба бе ва ве га да де ка ке ла ле ли ма ме ми на не ни па ра ре ри са се ти та то фа зо жа".split(),
    "greek": "βα βε γα δα δε κα κε λα λε λι μα με μι να νε νι πα ρα ρε ρι σα σε τα τε τι φα ζο".split(),
}
ENDINGS = {
    "latin": {"m": "n", "f": "la", "n": "s"},
    "cyrillic": {"m": "н", "f": "ла", "n": "с"},
    "greek": {"m": "ν", "f": "λα", "n": "ς"},
}

_EMAIL = r"(?P<email>[\w.%+-]{1,64}@(?:[\w-]{1,63}\.)+[\w-]{2,63})"
_SECRET = (
    r"(?P<secret_head>(?i:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key|auth)[\"']?[ \t]*[=:][ \t]*[\"']?)"
    r"(?P<secret>[\w+/~.!@#$%^&*-]{6,}=*)"
)
_ACCESS = r"(?P<access>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
_IP = r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
_IP6 = r"(?P<ip6>(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d))"
_IBAN = r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
_CARD = r"(?P<card>(?<![\w.-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w-]|\.\d))"
_SSN = r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
_PHONE = r"(?P<phone>(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])(?:\d{2,4}[ .-]){0,3}\d{3,4}(?![\w-]|\.\d)|(?<![\w.+-])\+\d{8,15}(?!\w))"
ENTITY = re.compile("|".join([_SECRET, _ACCESS, _EMAIL, _IP, _IP6, _CARD, _SSN, _IBAN, _PHONE]))
NAME = re.compile(
    r"\b(?P<title>" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.?[  ](?P<name>[^\W\d_a-z][\w'’-]+(?:[  ][^\W\d_a-z][\w'’-]+){0,2})"
)


#: Kinds of names: by their place in a text, with gender and script, and settled over all texts.
NAMES = ("first_", "last_", "name_")


class Mention(NamedTuple):
    start: int
    end: int
    kind: str
    value: str  # what the entity is known by, whatever its format


def _luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 * (int(d) > 4)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _iban(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN").split()[0].lower()
    return name if name in SYLLABLES else "latin"


def _digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def _entity(match: re.Match) -> Mention | None:
    kind = match.lastgroup
    text = match[kind]
    start, end = match.span(kind)
    if kind == "email":
        # a dot or dash before the address or a dash behind it is not part of it
        lead = len(text) - len(text.lstrip(".%+-"))
        return Mention(start + lead, end, kind, text[lead:].lower())
    if kind == "card":
        digits = _digits(text)
        # bare numbers of 16 digits that begin like a card's are taken for one even if mistyped
        return Mention(start, end, kind, digits) if _luhn(digits) or (len(digits) == 16 and digits[0] in "3456") else None
    if kind == "iban":
        value = text.replace(" ", "")
        return Mention(start, end, kind, value) if 15 <= len(value) <= 34 and _iban(value) else None
    if kind == "phone":
        digits = _digits(text)
        # without a plus or an area code in brackets, short ones are years and other numbers
        return Mention(start, end, kind, digits) if (8 if text[0] in "+(" else 9) <= len(digits) <= 15 else None
    if kind == "ssn":
        return Mention(start, end, kind, _digits(text))
    if kind == "ip6":
        # times and names in code are no addresses, nor are those of the own machine
        if sum(map(bool, text.split(":"))) < 2 or not _digits(text):
            return None
        try:
            return Mention(start, end, "ip", ipaddress.IPv6Address(text).compressed)
        except ValueError:
            return None
    if kind == "secret" and not any(map(str.isalnum, text)):
        # masked already
        return None
    return Mention(start, end, kind, text)


def mentions(text: str) -> list[Mention]:
    """Entities of a whole text in order, without overlaps.

    A name is known by the title before it. Where the text then has the full name, or the last name in
    the same writing, without a title, that is the same person.
    """
    found = []
    if any(c in text for c in "0123456789@=:"):
        at = 0
        while match := ENTITY.search(text, at):
            entity = _entity(match)
            # what turned out to be no entity may hold one further on
            at = entity.end if entity else match.start() + 1
            while not entity and at < len(text) and text[at - 1].isalnum() and text[at].isalnum():
                at += 1
            if entity:
                found.append(entity)
    people: dict[str, tuple[str, str]] = {}
    if any(t in text for t in TITLES):
        for match in NAME.finditer(text):
            gender = TITLES[match["title"]]
            words = re.split("[  ]", match["name"])
            for i, word in enumerate(words):
                people.setdefault(word, ("last", "n") if i == len(words) - 1 else ("first", gender))
                if i < len(words) - 1 and people[word][1] == "n" and people[word][0] == "first":
                    people[word] = ("first", gender)
    if people:
        every = re.compile(r"\b(?:" + "|".join(re.escape(w) for w in sorted(people, key=len, reverse=True)) + r")\b")
        firsts = {w for w, (part, _) in people.items() if part == "first"}
        taken = [(m.start, m.end) for m in found]
        for match in every.finditer(text):
            word, (part, gender) = match[0], people[match[0]]
            if any(a < match.end() and match.start() < b for a, b in taken):
                continue
            if word in firsts and not _by_name(text, match, people):
                continue
            found.append(Mention(*match.span(), f"{part}_{gender}_{_script(word)}", word.casefold()))
        found.sort()
    return found


def _by_name(text: str, match: re.Match, people: dict) -> bool:
    """A first name counts where a title stands before it or another part of a name next to it."""
    after = re.match(r"[  ]([\w'’-]+)", text[match.end() : match.end() + 60])
    before = re.search(r"([\w'’-]+)\.?[  ]$", text[max(0, match.start() - 60) : match.start()])
    return bool((after and after[1] in people) or (before and (before[1] in TITLES or before[1] in people)))


class _Stream:
    """Numbers drawn from the key, the entity and the attempt."""

    def __init__(self, key: bytes, *parts: str) -> None:
        self.key, self.text, self.block, self.held = key, "\0".join(parts).encode(), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        while self.bits < 96:
            digest = hmac.new(self.key, self.block.to_bytes(4) + self.text, hashlib.sha256).digest()
            self.held = self.held << 256 | int.from_bytes(digest)
            self.bits += 256
            self.block += 1
        self.bits -= 64
        value = (self.held >> self.bits) & (2**64 - 1)
        self.held &= (1 << self.bits) - 1
        return value % n

    def like(self, c: str) -> str:
        """A character of the same class."""
        if c.isascii():
            for group in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
                if c in group:
                    return group[self.below(len(group))]
            return c
        return "abcdefghijklmnopqrstuvwxyz"[self.below(26)] if c.isalnum() else c


def _code(stream: _Stream, value: str) -> str:
    if re.fullmatch(r"[0-9a-f]+", value):
        return "".join("0123456789abcdef"[stream.below(16)] for _ in value)
    if re.fullmatch(r"[0-9A-F]+", value):
        return "".join("0123456789ABCDEF"[stream.below(16)] for _ in value)
    return "".join(map(stream.like, value))


def _pool(kind: str) -> str:
    """The type within which surrogates must differ: all names of a script are one."""
    return "name_" + kind.rpartition("_")[2] if kind.startswith(NAMES) else kind


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """What stands for an entity: the same type, length class, alphabet, script and gender, by the key alone.

    Later attempts are longer and longer, so that every entity comes to one of its own.
    """
    # one name has one surrogate, whatever its place; the gender is in the ending
    stream = _Stream(key, _pool(kind), value, str(attempt))
    wider = 4 * (attempt // SAME_FORMAT)
    if wider and kind in LONGEST:
        value += "0" * (LONGEST[kind] + wider - len(value))
    if kind == "email":
        local, _, domain = value.partition("@")
        # one domain has one surrogate; .example is nobody's
        site = _Stream(key, "domain", domain)
        return "".join(map(stream.like, local + "0" * wider)) + "@" + "".join(map(site.like, domain.rpartition(".")[0])) + ".example"
    if kind == "ip" and (wider or ":" in value):
        # of version 6, or no more of version 4 are left; this prefix is nobody's
        return ipaddress.IPv6Address("2001:db8:" + ":".join(f"{stream.below(65536):x}" for _ in range(6))).compressed
    if kind == "ip":
        return f"{1 + stream.below(223)}.{stream.below(256)}.{stream.below(256)}.{1 + stream.below(254)}"
    if kind == "card":
        body = value[0] + "".join(str(stream.below(10)) for _ in value[2:])
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
    if kind in ("phone", "ssn"):
        return "".join(str(2 + stream.below(8)) if i in (0, len(value) - 10, len(value) - 7) else str(stream.below(10)) for i in range(len(value)))
    if kind == "iban":
        body = "".join(map(stream.like, value[4:]))
        check = 98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    if kind == "access":
        return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[stream.below(32)] for _ in value[4:])
    if kind.startswith(NAMES):
        _, gender, script = kind.split("_")
        syllables = 2 + stream.below(2) + attempt // SAME_FORMAT
        name = "".join(SYLLABLES[script][stream.below(len(SYLLABLES[script]))] for _ in range(syllables))
        return name + ENDINGS[script][gender]
    return _code(stream, value + "0" * wider)


def rendered(mention: Mention, text: str, other: str) -> str:
    """A surrogate in the writing of this mention: its punctuation, country code or case."""
    own = text[mention.start : mention.end]
    if mention.kind in ("card", "phone", "ssn", "iban"):
        kept = iter(other)
        out = "".join(next(kept) if c.isalnum() else c for c in own) + "".join(kept)
        code = re.match(r"\+(\d{1,3})[ .(-]", own)
        if mention.kind == "phone" and code:
            out = "+" + code[1] + out[len(code[1]) + 1 :]
        return out
    if mention.kind.startswith(NAMES):
        return other.upper() if own.isupper() and len(own) > 1 else other[:1].upper() + other[1:]
    if mention.kind == "email" and own.isupper():
        return other.upper()
    return other


def comparable(kind: str, value: str, other: str) -> str:
    """What two surrogates must differ in: a phone keeps its country code, so that is left out."""
    if kind == "phone" and len(other) > LONGEST[kind]:
        return other[3:]
    return other[-9:] if kind == "phone" and len(value) > 9 else other


def replace(text: str, key: bytes, settled: dict[tuple[str, str], tuple[str, int]]) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and how many of each type.

    ``settled`` gives kind and attempt where they are not the entity's own kind and the first attempt.
    """
    out, at, kinds = [], 0, {}
    for m in mentions(text):
        kind, attempt = settled.get((m.kind, m.value), (m.kind, 0))
        out += [text[at : m.start], rendered(m, text, surrogate(key, kind, m.value, attempt))]
        at = m.end
        kind = "name" if m.kind.startswith(NAMES) else m.kind
        kinds[kind] = kinds.get(kind, 0) + 1
    return "".join([*out, text[at:]]), kinds


def entities(docs: DataFrame) -> DataFrame:
    """Saved ``doc_id, kind, value``: the distinct entities of every row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, kinds, values = [], [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                for kind, value in sorted({(m.kind, m.value) for m in mentions(text or "")}):
                    row.append(i)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                ["doc_id", "kind", "value"],
            )

    return saved(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, kind string, value string"), "entities")


def assigned(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, settled, attempt`` of every entity: the attempt at which its surrogate is its own.

    A name is one entity, first or last and whatever the titles before it. Its ``settled`` kind has the
    gender that all texts tell, or none if they tell both or neither; other kinds are settled as they are.
    All entities try at once. A surrogate that is also a real value of the type, or that was given to
    another entity, is no one's: of several that try the same at once the first by value has it. All
    names of a script are one type here. The
    others try again, with longer surrogates where a format is full, until none is left. Every step is a
    join or an aggregate over written tables.
    """

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            other = [comparable(r["kind"], r["value"], surrogate(key, r["kind"], r["value"], r["attempt"])) for r in rows]
            yield batch.append_column("other", pa.array(other, pa.string()))

    schema = "kind string, value string, attempt int, other string"

    def comparable_value(kind: str = "kind", value: str = "value"):
        cut = (F.col(kind) == "phone") & (F.length(value) > 9)
        return F.when(cut, F.substring(F.col(value), -9, 9)).otherwise(F.col(value))

    is_name = F.col("kind").rlike("^(first|last|name)_")
    pool = F.when(is_name, F.concat(F.lit("name_"), F.substring_index("kind", "_", -1))).otherwise(F.col("kind"))
    gender = F.when(is_name, F.element_at(F.split("kind", "_"), 2))
    own = saved(found.select(pool.alias("pool"), "kind", "value", gender.alias("gender")).distinct(), "kinds")
    told = F.collect_set(F.when(F.col("gender") != "n", F.col("gender")))
    whole = own.groupBy("pool", "value").agg(F.first("gender").alias("any"), told.alias("told"))
    one = F.when(F.size("told") == 1, F.element_at("told", 1)).otherwise("n")
    settled = F.when(F.col("any").isNotNull(), F.concat_ws("_", F.lit("name"), one, F.substring_index("pool", "_", -1)))
    whole = saved(whole.select("pool", "value", F.coalesce(settled, "pool").alias("settled")), "settled")
    pending = whole.select(F.col("settled").alias("kind"), "value", F.lit(0).alias("attempt"))
    real = saved(whole.select("pool", comparable_value("pool").alias("other")).distinct(), "real-values")
    done = []
    for round_ in count():
        tries = saved(pending.mapInArrow(tried, schema).withColumn("pool", pool), "tries")
        free = tries.join(real, ["pool", "other"], "left_anti")
        for earlier in done:
            free = free.join(earlier, ["pool", "other"], "left_anti")
        first = free.groupBy("pool", "other").agg(F.min(F.struct("value", "kind")).alias("first"))
        won = saved(first.select("pool", "other", "first.*", F.lit(round_).alias("attempt")), "won")
        done.append(won)
        pending = saved(
            tries.join(won, ["kind", "value"], "left_anti").select("kind", "value", F.lit(round_ + 1).alias("attempt")),
            "pending",
        )
        if pending.isEmpty():
            break
    out = done[0]
    for won in done[1:]:
        out = out.unionByName(won)
    out = out.select("pool", "value", F.col("kind").alias("settled"), "attempt")
    return own.join(out, ["pool", "value"]).select("kind", "value", "settled", "attempt")


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """All columns of ``docs``, the text with surrogates, and ``__kinds``: entities replaced, by type.

    Surrogates follow from the secret ``key`` and the entity, so one entity has the same in every
    document. Entities that are settled otherwise than their own text tells are listed for the documents
    that hold them: names of another gender, and those whose first surrogate was not their own. They are
    joined to the documents by Spark, by broadcast only if the written list is small. Null texts stay
    null, texts without entities stay as they are, repeated rows are treated alike, rows with a null
    doc_id keep it, and texts are read whole. An empty table gives no rows. Other columns stay as they
    are, but for one named ``__kinds``, which is replaced.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    found = entities(docs)
    changed = (F.col("attempt") > 0) | (F.col("settled") != F.regexp_replace("kind", "^(first|last)_", "name_"))
    again = saved(assigned(found, key).filter(changed), "later-attempts")
    row_id, fixed = _unused("__id", docs.columns), _unused("__fixes", docs.columns)
    fixes = saved(
        found.distinct()
        .join(again, ["kind", "value"])
        .groupBy(F.col("doc_id").alias(row_id))
        .agg(F.collect_set(F.struct("kind", "value", "settled", "attempt")).alias(fixed)),
        "fixes",
    )
    bound_batches(docs.sparkSession)
    kept = docs.drop("__kinds")
    rows = kept.join(fixes, F.col("doc_id").eqNullSafe(F.col(row_id)), "left").drop(row_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kinds = [], []
            for text, own in zip(batch["text"].to_pylist(), batch[fixed].to_pylist(), strict=True):
                settled = {(x["kind"], x["value"]): (x["settled"], x["attempt"]) for x in own or ()}
                new, counts = (None, {}) if text is None else replace(text, key, settled)
                texts.append(new)
                kinds.append(list(counts.items()))
            names = [n for n in batch.schema.names if n != fixed]
            columns = [pa.array(texts, pa.string()) if n == "text" else batch[n] for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kinds, pa.map_(pa.string(), pa.int32()))], [*names, "__kinds"]
            )

    schema = kept.withColumn("__kinds", F.lit(None).cast("map<string,int>")).schema
    return rows.mapInArrow(run, schema)


def _unused(name: str, columns: list[str]) -> str:
    """The name, longer if a column has it."""
    while name in map(str.lower, columns):
        name += "_"
    return name
