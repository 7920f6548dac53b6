import zlib
from collections import Counter

import numpy as np
import pytest

from crawlspark.llm import language

SCHEMA = "doc_id long, text string, lang string, score string, held_out string"
SAMPLES = {
    "en": "the cat and the dog went to the house with their old friends",
    "de": "die katze und der hund gingen mit ihren alten freunden nach haus",
    "fr": "le chat et le chien sont allés à la maison avec leurs vieux amis",
}


def escape_code(text, trained, symbols, size):
    """Bits of a text by hand: contexts of 2, 1 and 0 symbols, escapes with exclusion."""
    counts = {}
    for t in trained:
        s = [0, 0, *t]
        for i in range(2, len(s)):
            for k in range(3):
                counts.setdefault(tuple(s[i - k : i]), Counter())[s[i]] += 1
    bits, s = 0.0, [0, 0, *text]
    for i in range(2, len(s)):
        out = set()
        for k in (2, 1, 0):
            seen = {x: n for x, n in counts.get(tuple(s[i - k : i]), {}).items() if x not in out}
            weight = sum(seen.values()) + len(seen)
            if s[i] in seen:
                bits -= np.log2(seen[s[i]] / weight)
                break
            if seen:
                bits -= np.log2(len(seen) / weight)
            out |= set(seen)
        else:
            bits += np.log2(size - len(out))
    return bits


def test_code_lengths(spark, frame):
    trained = {"a": ["abab abba 12", "", "été"], "b": ["xyz xyz zyx"]}
    docs = frame([(t, k) for k, v in trained.items() for t in v], "text string, lang string")
    model = language.train(docs)
    texts = ["abba", "xyzzy? 99 é", "ЖЖ", "zéa b", ""]
    narrow = {}
    for i in range(256):
        narrow[i] = int(model.symbols[i])
    code = lambda t: [narrow[b] for b in t.lower().encode()]
    found = model.lengths(texts)
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.langs):
            assert found[i, j] == pytest.approx(escape_code(code(t), map(code, trained[lang]), None, model.size), rel=1e-4, abs=1e-4)


def test_odds_of_a_context_add_up():
    model = language.Model(["a"], [(np.array([0, 5 * 156 + 7, 5 * 156 + 8]), np.array([3, 2, 9]))])
    assert np.exp2(-model.bits[0].astype(float)).reshape(-1, model.size).sum(axis=1) == pytest.approx(1.0, rel=1e-4)


def test_identify(frame):
    data = [(i, t + f" {i}", lang) for i, (lang, t) in enumerate(list(SAMPLES.items()) * 10)]
    data += [(100, None, "en"), (101, "", "de"), (102, "12 34 !", "fr"), (103, "the house", None), (None, "die katze und der hund", None)]
    data += [(104, "le chien " * 3_000, "fr")] * 2
    rows = language.identify(frame([(*d, "x", "y") for d in data], SCHEMA)).collect()
    assert len(rows) == len(data)
    by_id = {r["doc_id"]: r for r in rows}
    for doc_id, _, lang in data[:30]:
        assert by_id[doc_id]["lang_pred"] == lang
        assert by_id[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert (by_id[103]["lang_pred"], by_id[None]["lang_pred"], by_id[104]["lang_pred"]) == ("en", "de", "fr")
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).filter("held_out").join(docs, "doc_id").filter("lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found) > 100


def test_seventy_languages(frame):
    """All languages are learned, and blocks of them give the rows of one model."""
    own = {f"l{i:02d}": f"{chr(97 + i // 26)}{chr(97 + i % 26)}x{chr(97 + i * 7 % 26)} " * 5 for i in range(70)}
    data = [(100 * n + i, text, lang) for n in range(6) for i, (lang, text) in enumerate(own.items())]
    data += [(9001, None, "l01"), (9002, "5 ² ½ ① 12", "l02"), (9003, "ª", None), (9004, "", None)]
    docs = frame([(*d, "x", "y") for d in data], SCHEMA)
    whole = {r["doc_id"]: r for r in language.identify(docs, block_bytes=1 << 40).collect()}
    assert all(whole[i]["lang_pred"] == lang for i, _, lang in data[:-4])
    assert [whole[i]["lang_pred"] for i in (9001, 9002, 9004)] == ["und"] * 3 and whole[9003]["lang_pred"] != "und"
    parts = {r["doc_id"]: r for r in language.identify(docs, block_bytes=30 * 4 * 30**3).collect()}
    assert len(parts) == len(whole) == len(data)
    for i, r in whole.items():
        assert (parts[i]["lang_pred"], parts[i]["held_out"]) == (r["lang_pred"], r["held_out"])
        assert parts[i]["score"] == pytest.approx(r["score"], rel=1e-6)


def test_nothing_learned(frame):
    assert [r["lang_pred"] for r in language.identify(frame([(1, "some text", None, "", "")], SCHEMA)).collect()] == ["und"]
    assert language.identify(frame([], SCHEMA)).count() == 0
