import corpus_pipeline
import pytest

from crawlspark.llm import pii, toxicity
from crawlspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    held = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        held.append(docs.collect())
    toxic, single, private, mixed = held
    rejected = {r["doc_id"] for r in toxicity.score_toxicity(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in toxic} == {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()} - rejected
    assert {r["doc_id"] for r in single} <= {r["doc_id"] for r in toxic} and len({r["text"] for r in single}) == len(single)
    assert [r["doc_id"] for r in sorted(single)] == [r["doc_id"] for r in sorted(private)]
    before = {r["doc_id"]: r["text"] for r in single}
    for r in private:
        assert r["n_chars"] == len(r["text"])
        for m in pii.mentions(before[r["doc_id"]]):
            assert before[r["doc_id"]][m.start : m.end] not in r["text"]
    texts = {(r["doc_id"], r["text"]) for r in private}
    assert {(r["doc_id"], r["text"]) for r in mixed} <= texts
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in mixed}
    assert sum(p["length"] for p in pieces if p["start"] + p["length"] == p["doc_tokens"]) > 0


def test_run(spark):
    first, again = (sorted((p["doc_id"], p["start"], p["length"], p["ids_crc32"]) for p in corpus_pipeline.run(spark, SF).collect()) for _ in range(2))
    assert first == again and first


@pytest.mark.parametrize("data", [[], [(1, None, None, None, None)], [(None, "", "en", "a", 0), (None, "", "en", "a", 0), (2, "a b", None, None, 3)]])
def test_odd_documents_pass_all_stages(spark, data):
    docs = spark.createDataFrame(data, SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), "test-odd")
    assert (docs.count() > 0) == bool([d for d in data if d[1]])


def test_queries(spark):
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert corpus_pipeline.ORACLE_SQL is None
