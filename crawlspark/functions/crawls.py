"""Functions over crawl ids such as ``CC-MAIN-2020-50``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def crawl_epoch(crawl: Column) -> Column:
    """Sunday of the crawl's week at 00:00 UTC, weeks counted from the year's first Monday.

    Null for an id without year and week. Independent of the session time zone (Q17).
    """
    year = F.split_part(crawl, F.lit("-"), F.lit(3)).try_cast("int")
    week = F.split_part(crawl, F.lit("-"), F.lit(4)).try_cast("int")
    new_year = F.make_date(year, F.lit(1), F.lit(1))
    first_monday = F.next_day(F.date_sub(new_year, 1), "MON")
    sunday = F.date_add(first_monday, (week - 1) * 7 + 6)
    return F.unix_date(sunday).cast("long") * SECONDS_PER_DAY


def source_tag(crawl: Column) -> Column:
    """F18."""
    return F.concat(F.lit("cc:"), crawl)


def process_time(epoch: int | None = None) -> Column:
    """the given epoch, or the start of the query."""
    if epoch is None:
        return F.unix_timestamp(F.current_timestamp())
    return F.lit(epoch).cast("long")
