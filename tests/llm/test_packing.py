import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crawlspark.llm import packing

SCHEMA = "doc_id long, text string, source string, start string, queue int"


@pytest.fixture(scope="module")
def full():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: own.encode(text, add_special_tokens=False).ids


def ids_of(text):
    return np.frombuffer(packing.tokenizer(None).encode(text), "<u2").tolist()


@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\xa0 '’.,!ab12éß§Ω漢한🙂"), st.characters(codec="utf-8")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_whole_text(full, text):
    assert ids_of(text) == full(text)


@pytest.mark.parametrize("text", ["<|endoftext|> foo", "a  <|endoftext|>", "x <|endoftext|><|endoftext|>\n y", "<|endoftext", "é漢 <|endoftext|>"])
def test_special_tokens_are_read_as_the_library_reads_them(full, text):
    assert ids_of(text) == full(text)
    assert (50256 in ids_of(text)) == ("<|endoftext|>" in text)


def test_ids_of_the_table(full, spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect():
        assert ids_of(row["text"]) == full(row["text"])


def check(pieces, data, full, sequence):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc_id, text, *_ in data:
        ids = [*full(text or ""), 0]
        own = sorted((p for p in by_doc[doc_id, len(ids)]), key=lambda p: p["start"])
        copies = sum(1 for d in data if d[0] == doc_id and d[1] == text)
        assert [p["start"] for p in own[::copies]] == np.cumsum([0, *(p["length"] for p in own[::copies])])[:-1].tolist() or copies > 1
        assert sum(p["length"] for p in own) == copies * len(ids)
        for p in own:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == p["ids_crc32"] and p["length"] > 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return {s: sum(n for _, n in p) for s, p in by_sequence.items()}


def test_pieces_hold_every_token_once(frame, full):
    random.seed(3)
    data = [(i, " ".join(random.choices(["the", "of", "thoned", "été", "12"], k=random.choice([0, 1, 30, 400]))), random.choice(["a", "a", "a", "b", "c", None]), "x", 1) for i in range(300)]
    data += [(1000, None, "b", "x", 1), (1001, "", None, "x", 1), (None, "no id", "z", "x", 1), (1002, "twice", "c", "x", 1), (1002, "twice", "c", "x", 1)]
    docs = frame(data, SCHEMA).repartition(5)
    pieces = packing.pack(docs).collect()
    used = check(pieces, data, full, 1024)
    total = sum(p["length"] for p in pieces)
    assert sorted(used) == list(range(len(used)))
    assert len(used) == -(-total // 1024)
    # each sequence's sources are near their share of all tokens
    source = {d[0]: d[2] for d in data}
    share = sum(p["length"] for p in pieces if source[p["doc_id"]] == "a") / total
    for s in sorted(used)[:-2]:
        own = sum(p["length"] for p in pieces if p["sequence_id"] == s and source[p["doc_id"]] == "a")
        assert abs(own / 1024 - share) < 0.3
    # deficits are carried: any run of sequences has the share, but for a slot or two
    first = [sum(p["length"] for p in pieces if p["sequence_id"] <= s and source[p["doc_id"]] == "a") for s in sorted(used)]
    assert all(abs(x - share * 1024 * (s + 1)) < 4 * 128 for s, x in enumerate(first[:-1]))


def many_sources():
    """1,200 sources and one that holds a third of the rows, with nulls, empty and long texts."""
    random.seed(5)
    data = [(i, "some words here " * (i % 9), f"s{i % 1200}", "x", 1) for i in range(2400)]
    data += [(10_000 + i, "hot source text " * random.choice([0, 1, 30]), "hot", "x", 1) for i in range(1200)]
    return data + [(20_000, None, None, "x", 1), (20_001, "long " * 20_000, "s3", "x", 1), (None, "", "s4", "x", 1)]


def test_many_sources_have_queues_of_their_own(frame, full, rows):
    data = many_sources()
    docs = frame(data, SCHEMA).repartition(3)
    found = packing.pack(docs)
    used = check(found.collect(), data, full, 1024)
    assert sorted(used) == list(range(len(used)))
    # the way with all queues in every task places all pieces alike
    assert rows(found) == rows(packing.pack(docs, max_queues=2_000))


def test_hot_source_keeps_its_share_among_many(frame):
    data = [r for r in many_sources() if r[0] != 20_001]
    pieces = packing.pack(frame(data, SCHEMA)).collect()
    source = {d[0]: d[2] for d in data}
    total = sum(p["length"] for p in pieces)
    share = sum(p["length"] for p in pieces if source[p["doc_id"]] == "hot") / total
    last = max(p["sequence_id"] for p in pieces)
    for half in (range(last // 2), range(last // 2, last)):
        own = [p for p in pieces if p["sequence_id"] in half]
        hot = sum(p["length"] for p in own if source[p["doc_id"]] == "hot")
        assert abs(hot / sum(p["length"] for p in own) - share) < 0.1


@pytest.mark.parametrize("max_queues", [2, 100])
def test_target_weights(frame, full, max_queues):
    data = [(i, "some words here " * 40, "abc"[i % 3], "x", 1) for i in range(300)]
    weights = frame([("a", 5.0), ("b", 1.5), ("b", 0.5), ("c", 1.0), ("none", 9.0)], "source string, weight double")
    pieces = packing.pack(frame(data, SCHEMA), max_queues=max_queues, weights=weights).collect()
    check(pieces, data, full, 1024)
    source = {d[0]: d[2] for d in data}
    first = max(p["sequence_id"] for p in pieces if source[p["doc_id"]] == "a")
    # 5 : 2 : 1 of the 8 slots in every sequence for as long as all sources last
    for s in range(first - 1):
        own = {x: sum(p["length"] for p in pieces if p["sequence_id"] == s and source[p["doc_id"]] == x) for x in "abc"}
        assert own == {"a": 640, "b": 256, "c": 128}


def test_sources_need_weights(frame):
    docs = frame([(1, "text", "a", "x", 1), (2, "text", None, "x", 1)], SCHEMA)
    for weights in ([("a", 1.0)], [("a", 1.0), (None, 0.0)]):
        with pytest.raises(ValueError, match="1 sources"):
            packing.pack(docs, weights=frame(weights, "source string, weight double"))


@pytest.mark.parametrize("begun", [0.0, 0.25])
@pytest.mark.parametrize("share", [[4, 2, 1, 1], [3.5, 2.5, 1.5, 0.5], [0.125, 7.875], [8]])
def test_places_are_those_of_the_rounds_played(share, begun):
    random.seed(len(share))
    slots = [random.choice([1, 7, 60]) for _ in share]
    queues = packing.Queues(np.array(slots), np.array(share, float), np.full(len(share), begun))
    rounds = packing.Rounds(np.array(slots) * 128, queues)
    credit, done, played = [begun] * len(share), [0] * len(share), []
    while done != slots:
        for q in range(len(share)):
            credit[q] += share[q]
            while credit[q] >= 1 and done[q] < slots[q]:
                played.append((q, done[q]))
                done[q] += 1
                credit[q] -= 1
    queue, k = (np.array(x) for x in zip(*played, strict=True))
    assert rounds.place(queue, k).tolist() == list(range(len(played)))


@pytest.mark.parametrize("tokens", [[1], [128, 128], [5000, 1, 1], [10**6, 333_333, 77, 129, 128 * 7], [3] * 200])
@pytest.mark.parametrize("begun", [0.0, 0.37])
def test_rounds_place_each_slot_once(tokens, begun):
    tokens = np.array(tokens, np.int64)
    slots = -(-tokens // 128)
    rounds = packing.Rounds(tokens, packing.Queues(slots, 8 * slots / slots.sum(), np.full(len(tokens), begun)))
    queue = np.repeat(np.arange(len(tokens)), slots)
    k = np.concatenate([np.arange(n) for n in slots])
    places, before = rounds.place(queue, k), rounds.tokens_before(queue, k)
    assert sorted(places.tolist()) == list(range(slots.sum()))
    for q in range(len(tokens)):
        assert (np.diff(places[queue == q]) > 0).all()
    own = np.minimum(tokens[queue] - 128 * k, 128)[np.argsort(places)]
    assert before[np.argsort(places)].tolist() == (np.cumsum(own) - own).tolist()


def test_empty(frame):
    assert packing.pack(frame([], SCHEMA)).count() == 0
    assert packing.pack(frame([], SCHEMA), max_queues=-1).count() == 0
