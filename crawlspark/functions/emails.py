"""E-mail extraction."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Finds what [\w\.-]+@[\w\.-]+\.\w+ finds, in one pass: a match can only begin where a run of
# address characters begins or where the match before it ended, so no run is rescanned from
# each of its characters.
EMAIL_PATTERN = r"(?:(?<![\w.-])|\G)[\w.-]++@[\w.-]+\.\w+"

# File endings that mark an image name rather than an address.
IMAGE_PATTERN = r"(?i)\.(jpg|jpeg|gif|png)"


def find_emails(text: Column) -> Column:
    """All addresses in order, repeats kept; empty for a text without any."""
    found = F.regexp_extract_all(text, F.lit(EMAIL_PATTERN), F.lit(0))
    return F.when(
        F.contains(text, F.lit("@")), F.filter(found, lambda address: is_address(address))
    ).otherwise(F.array().cast("array<string>"))


def is_address(address: Column) -> Column:
    """P10: drops image names such as ``logo@2x.png``."""
    return ~address.rlike(IMAGE_PATTERN)
