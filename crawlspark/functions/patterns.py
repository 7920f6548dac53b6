r"""Functions over signature patterns, run on the catalog and never on pages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-ins for escaped special characters, for brackets that are done with, and a mark for what
# is cut out
_SPECIAL = "\\.[]{}()^$|?*+"
_SAFE = "".join(chr(0xE000 + i) for i in range(len(_SPECIAL)))
_OPEN, _CLOSE, _BAR, _GAP = "\uE0F0", "\uE0F1", "\uE0F2", "\uE0F3"
_STAND_INS = f"[{_SAFE}{_OPEN}{_CLOSE}{_BAR}{_GAP}]"

# Length from which a text is worth looking for
_MIN_TEXT = 2

# Group depth that alternatives and required_texts see through
_DEPTH = 4

# d: only \n ends a line, as in the engines the catalog is written for
BODY_FLAGS = "(?smd)"
HEADER_FLAGS = "(?sid)"

# One step over a pattern: an escape, a character class, an existing (?...) or a plain character.
_STEP = r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\(\?|[^\\(\[]"


def strip_tags(pattern: Column) -> Column:
    r"""F8: cut at the first ``\;``, which starts a version or confidence tag (Q9)."""
    return F.substring_index(pattern, r"\;", 1)


def non_capturing(pattern: Column) -> Column:
    r"""``(`` to ``(?:``, but neither in ``\(`` or ``[(]`` nor where ``(?`` stands (Q8)."""
    return F.regexp_replace(pattern, rf"(?s)\G((?:{_STEP})*+)\(", "$1(?:")


def grouped(pattern: Column) -> Column:
    """F10."""
    return F.concat(F.lit("(?:"), pattern, F.lit(")"))


def can_join(pattern: Column) -> Column:
    """False for patterns whose meaning hangs on the text around them: references to groups, named groups,
    quoting, and spaces that are left out."""
    return ~pattern.rlike(r"\\[1-9kQ]|\(\?<[a-zA-Z]|\(\?[a-zA-Z]*x")


def union(parts: Column) -> Column:
    """one pattern that matches where any pattern of an array does."""
    return F.array_join(F.transform(parts, grouped), "|")


def body_regex(pattern: Column) -> Column:
    """html and script patterns match anywhere, case-sensitive.

    Without a group around it: the regex engine skips ahead to a text that a pattern opens with,
    but does not see it in a group. The flags hold for all alternatives all the same.
    """
    return F.concat(F.lit(BODY_FLAGS), pattern)


def header_regex(pattern: Column) -> Column:
    """header patterns match from the start of the value, in any case."""
    return F.concat(F.lit(HEADER_FLAGS + "^"), grouped(pattern))


def is_valid(pattern: Column) -> Column:
    """F12."""
    return F.try_reflect(
        F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern
    ).isNotNull()


def as_list(value: Column) -> Column:
    """one pattern, or a JSON list of patterns, to an array; null to an empty one."""
    listed = F.when(F.startswith(value, F.lit("[")), F.from_json(value, "array<string>"))
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(
        F.coalesce(listed, F.array(value))
    )


def alternatives(pattern: Column) -> Column:
    """Patterns that together match where ``pattern`` does: its alternatives at the top level.

    Each has required texts of its own, which the whole has not. A pattern that is safer in one
    piece, as with flags or references to groups, comes back alone.
    """
    hidden = _hide_escapes(F.regexp_replace(pattern, r"^\(\?:([^()\\\[]*)\)$", "$1"))
    for _ in range(_DEPTH):
        hidden = F.regexp_replace(hidden, r"\|(?=[^()]*\))", _BAR)
        hidden = F.regexp_replace(hidden, r"\(([^()]*)\)", f"{_OPEN}$1{_CLOSE}")
    whole = (
        pattern.rlike(_STAND_INS)
        | pattern.rlike(r"\(\?-?[a-zA-Z]|\\[QEk1-9]|&&|\[[^\]]*[()|\[]")
        | hidden.rlike(r"[()]")
    )
    parts = F.transform(F.split(hidden, r"\|"), _show_escapes)
    return F.when(whole, F.array(pattern)).otherwise(parts)


def literal_text(pattern: Column) -> Column:
    """The text that ``pattern`` stands for if it is one without any operators, else null."""
    plain = F.regexp_replace(_hide_escapes(pattern), r"\\([^a-zA-Z0-9])", "$1")
    is_text = ~pattern.rlike(_STAND_INS) & ~plain.rlike(r"[\\.^$|?*+()\[\]{}]")
    return F.when(is_text & (F.length(plain) >= _MIN_TEXT), F.translate(plain, _SAFE, _SPECIAL))


def required_texts(pattern: Column) -> Column:
    """Texts of two and more characters that every match of ``pattern`` contains, all of them.

    Everything that a match can do without is cut out first: classes, groups, and whatever a
    quantifier follows. Null if no such text is certain, as with alternatives at the top level,
    flags and quoting.
    """
    hidden = _hide_escapes(pattern)
    left = F.regexp_replace(hidden, r"\\([^a-zA-Z0-9])", "$1")
    left = F.regexp_replace(left, r"\\[pP](?:\{[^}]*\}|.)|\\k<[^>]*>|\\\d+|\\.", _GAP)
    left = F.regexp_replace(left, r"\[\^?\]?[^\]\[]*\]", _GAP)
    for _ in range(_DEPTH):
        left = F.regexp_replace(left, r"\([^()]*\)", _GAP)
    left = F.regexp_replace(left, r"(?s).[?*][?+]?|.\{[^}]*\}[?+]?", _GAP)
    runs = F.filter(F.split(left, rf"[{_GAP}.^$+]"), lambda run: F.length(run) >= _MIN_TEXT)
    texts = F.array_distinct(F.transform(runs, lambda run: F.translate(run, _SAFE, _SPECIAL)))
    unsure = (
        pattern.rlike(_STAND_INS)
        | hidden.rlike(r"\(\?-?[a-zA-Z]|\\[QExu0cN]|&&")
        | left.rlike(r"[|()\[\]{}\\]")
    )
    return F.when(~unsure & (F.size(texts) > 0), texts)


def _hide_escapes(pattern: Column) -> Column:
    """Escaped special characters, which stand for themselves, as their stand-ins."""
    hidden = F.regexp_replace(pattern, r"\\\\", _SAFE[0])
    for special, safe in zip(_SPECIAL[1:], _SAFE[1:]):
        hidden = F.replace(hidden, F.lit("\\" + special), F.lit(safe))
    return hidden


def _show_escapes(hidden: Column) -> Column:
    shown = F.translate(hidden, _OPEN + _CLOSE + _BAR, "()|")
    for special, safe in zip(_SPECIAL, _SAFE):
        shown = F.replace(shown, F.lit(safe), F.lit("\\" + special))
    return shown
