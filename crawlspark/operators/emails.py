"""E-mail rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.emails import find_emails
from crawlspark.functions.urls import host_no_www


def explode_emails(df: DataFrame, text: str) -> DataFrame:
    """One row per address, with its position among the addresses of the text."""
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.posexplode(find_emails(F.col(text))).alias("position", "email"))


def emails_by_host(pages: DataFrame, text: str = "html") -> DataFrame:
    """The distinct addresses of every host."""
    host = host_no_www(F.col("url")).alias("fqdn_no_www")
    return pages.select(host, F.explode(find_emails(F.col(text))).alias("email")).distinct()
