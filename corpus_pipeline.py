"""The corpus pipeline: every stage takes the documents that the one before has left.

Toxic documents go, one document of each group of near duplicates stays, personal data gets surrogates,
sources are mixed to their weights, and the mix is packed into sequences. No stage needs its rows in
any order, and none reads the tables' documents anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.llm import mixing, packing, pii, simhash, toxicity
from crawlspark.llm.common import saved, table
from crawlspark.llm.queries import SURROGATE_KEY


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.3."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that the SimHash operator links."""
    return simhash.one_of_each(docs, simhash.SHINGLE)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in their texts; ``n_chars`` follows the text."""
    replaced = pii.with_surrogates(docs, SURROGATE_KEY).select(*docs.columns)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, once or twice or not at all, so that the sources come near their targets."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents of the mix, in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Scores, hashes and tokens have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of the folder; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
