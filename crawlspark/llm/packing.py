"""Operator 7: pack documents into sequences in which sources keep their proportions."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, running_totals, saved

SEQUENCE = 1024
SLOT = 128  # tokens a queue is served at once
END = 0  # follows each document
#: Above this many sources, slots are put in order by a distributed sort; below it every task knows all queues.
#: Both ways give the same pieces.
MAX_QUEUES = 1_000
CACHE_WORDS = 300_000

LATIN = "\u024f"  # both libraries agree on parts of such characters
SPACE = re.compile(r" (?=\S)")
RUN = re.compile(r" (?:\s|$)")

STATE = ("slots", "share", "begun")
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class ByteTokenizer:
    """Ids of the byte-level vocabulary, a word at a time, frequent words from a bounded store.

    The vocabulary splits a text before each single space that a visible character follows, and no
    token spans such a place, so a text's ids are those of its parts. ``ranks`` is the same vocabulary
    as ``json``; parts of characters beyond Latin go to the library of the latter.
    """

    def __init__(self, json: str, ranks: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.full = Tokenizer.from_file(json)
        special = [re.escape(t.content) for t in self.full.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)")
        outer = self

        class Store(dict):
            def __missing__(self, word: str) -> bytes:
                ids = outer.part(" " + word)
                if len(self) < CACHE_WORDS:
                    self[word] = ids
                return ids

        self.store = Store()

    def part(self, text: str) -> bytes:
        if text.isascii() or max(text) <= LATIN:
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.full.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 16-bit numbers.

        A text that holds the string of a special token goes to the library whole: it cuts the text there.
        """
        if self.special.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        first, *rest = SPACE.split(text) if RUN.search(text) else text.split(" ")
        return self.part(first) + b"".join(map(self.store.__getitem__, rest))


@lru_cache(maxsize=2)
def tokenizer(folder: str | None) -> ByteTokenizer:
    """The tokenizer from ``folder``, or from the installed files of public tokenizers."""
    import public_tokenizers as public

    def path(name: str) -> str:
        return f"{folder}/{name}" if folder else public.path(name)

    return ByteTokenizer(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public.PATTERN)


def queue_of(source: str) -> Column:
    """Name of a source's queue; null has one of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def tokenized(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Saved ``doc_id, queue, task, before, n, ids`` for every row: its queue, the tokens of the queue that
    the same task had before, its own number of tokens and their ids as 16-bit numbers."""
    bound_batches(docs.sparkSession, 1_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, served = tokenizer(folder).encode, TaskContext.get().partitionId(), {}
        end = END.to_bytes(2, "little")
        for batch in batches:
            before, sizes, ids = [], [], []
            for name, text in zip(batch["queue"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = encode(text or "") + end
                before.append(served.get(name, 0))
                sizes.append(len(own) // 2)
                served[name] = before[-1] + sizes[-1]
                ids.append(own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["queue"],
                    pa.array([task] * len(ids), pa.int32()),
                    pa.array(before, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "queue", "task", "before", "n", "ids"],
            )

    rows = docs.select("doc_id", queue_of("source").alias("queue"), "text").mapInArrow(
        run, "doc_id long, queue string, task int, before long, n long, ids binary"
    )
    return saved(rows, "tokens")


class Queues:
    """The rounds of a deficit round-robin in closed form, for a number of queues at once.

    Each round gives a queue its share of slots as credit, on top of what it began with; it serves whole
    slots and carries the rest. So it has served floor(begun + r x share) slots after round r.
    """

    def __init__(self, slots: np.ndarray, share: np.ndarray, begun: np.ndarray) -> None:
        self.slots, self.share, self.begun = slots, share, begun

    def __getitem__(self, at) -> Queues:
        return Queues(self.slots[at], self.share[at], self.begun[at])

    def served(self, rounds: np.ndarray) -> np.ndarray:
        return np.minimum(self.slots, np.floor(self.begun + rounds * self.share).astype(np.int64))

    def round_of(self, k: np.ndarray) -> np.ndarray:
        """Round in which each queue serves its k-th slot."""
        r = np.maximum(1, np.ceil((k + 1 - self.begun) / self.share).astype(np.int64))
        for _ in range(2):  # rounding may put the quotient a round off
            r = np.where((r > 1) & (self.served(r - 1) > k), r - 1, r)
            r = np.where(self.served(r) <= k, r + 1, r)
        return r


class Rounds:
    """Places of all slots, where all queues are known: after those of earlier rounds, then by queue."""

    def __init__(self, tokens: np.ndarray, queues: Queues, slot: int = SLOT) -> None:
        self.queues, self.slot = queues, slot
        # the last slot of a queue may be short; what follows moves up
        last = self.place(np.arange(len(tokens)), queues.slots - 1)
        order = np.argsort(last)
        self.last = last[order]
        self.missing = np.concatenate(([0], np.cumsum((queues.slots * slot - tokens)[order])))

    def place(self, queue: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place among all slots of the k-th slot of each queue."""
        own = self.queues[queue]
        r = own.round_of(k)
        place = k - own.served(r - 1)
        every, column = np.arange(len(self.queues.slots))[:, None], self.queues[:, None]
        step = max(1, 2**20 // max(1, len(every)))
        for i in range(0, len(k), step):
            part = slice(i, i + step)
            now = column.served(np.where(every < queue[part], r[part], r[part] - 1))
            place[part] += now.sum(axis=0)
        return place

    def tokens_before(self, queue: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Tokens of all queues before the k-th slot of each queue."""
        places = self.place(queue, k)
        return places * self.slot - self.missing[np.searchsorted(self.last, places)]


def by_slots(batch: pa.RecordBatch, slot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A batch's documents cut where slots end: row, slot of its queue, tokens of the slot before the piece,
    and the piece's begin and end in the document."""
    n = batch["n"].to_numpy()
    begin = batch["base"].to_numpy() + batch["before"].to_numpy()
    first, last = begin // slot, (begin + n - 1) // slot
    count = last - first + 1
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    start = np.maximum(k * slot - begin[row], 0)
    return row, k, np.maximum(begin[row] - k * slot, 0), start, np.minimum((k + 1) * slot - begin[row], n[row])


def by_sequences(
    doc_id: pa.Array, doc_tokens: np.ndarray, ids: list[bytes], row: np.ndarray, first: np.ndarray,
    start: np.ndarray, stop: np.ndarray, before: np.ndarray, sequence: int,
) -> pa.RecordBatch:
    """Pieces as ``PIECES``, cut once more where a sequence ends.

    ``before`` are the tokens of all queues before each piece, ``first`` the place in its document of the
    first token that ``ids`` of its row holds.
    """
    room = sequence - before % sequence
    over = np.flatnonzero(stop - start > room)
    middle = start[over] + room[over]
    row, first = np.concatenate([row, row[over]]), np.concatenate([first, first[over]])
    before = np.concatenate([before, before[over] + room[over]])
    start, stop = np.concatenate([start, middle]), np.concatenate([stop, stop[over]])
    stop[over] = middle
    wide = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in ids]
    spans = zip(row.tolist(), (4 * (start - first)).tolist(), (4 * (stop - first)).tolist(), strict=True)
    crc = np.array([zlib.crc32(wide[i][a:b]) for i, a, b in spans], np.int64)
    columns = (start, stop - start, crc, doc_tokens[row], before // sequence, before % sequence)
    return pa.RecordBatch.from_arrays(
        [doc_id.take(pa.array(row)), *map(pa.array, columns)],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )


def pack(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    slot: int = SLOT,
    max_queues: int = MAX_QUEUES,
    folder: str | None = None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """Pieces of all rows of ``docs(doc_id, text, source)``, packed into sequences of ``sequence`` tokens.

    Every source is a queue, in the order its rows are read. Queues are served in turn, ``slot`` tokens
    at once, by deficit round-robin, and what is served fills one sequence after the other. The targets
    are the proportions of ``weights(source, weight)``, or else the sources' shares of all slots; once a
    queue is empty, the others share what is left by their weights. Rows of a source add up; a source of
    the documents without a weight above 0 is an error. Queues begin with a part of a slot as credit, by
    hash, so that many small sources are spread over all sequences. Documents are tokenized once; a
    task's place in a queue is the sum of what earlier tasks hold of it, and the rounds have a closed
    form, so all tasks lay out their own documents at the same time and no token is shuffled for it. With
    more than ``max_queues`` sources no task knows all queues: it finds the rounds of its pieces, and a
    sort by range and prefix sums give their places; the pieces carry their ids there. Only the last
    sequence is not full. A null or empty text is the end token alone; null is a source of its own; a
    document with a null id and repeated rows are packed like others; long texts are tokenized whole; an
    empty table gives no rows; other columns are not read.
    """
    if sequence < slot:
        raise ValueError("a slot must not be longer than a sequence")
    tokens = tokenized(docs, folder)
    parts = tokens.groupBy("queue", "task").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = saved(
        parts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("queue", "task", "base"),
        "queue-parts",
    )
    queues = _shares(parts.groupBy("queue").agg(F.sum("n").alias("total")), weights, sequence, slot)
    if queues.count() > max_queues:
        return _sorted(tokens.join(base.join(queues, "queue"), ["queue", "task"]), sequence, slot)
    held = queues.orderBy("queue").limit(max_queues).toPandas()
    number = {q: i for i, q in enumerate(held["queue"])}
    rounds = Rounds(held["total"].to_numpy(), Queues(*(held[c].to_numpy() for c in STATE)), slot)

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, k, at, start, stop = by_slots(batch, slot)
            queue = np.array([number[q] for q in batch["queue"].to_pylist()], np.int64)
            before = rounds.tokens_before(queue[row], k) + at
            n, ids, none = batch["n"].to_numpy(), batch["ids"].to_pylist(), np.zeros(len(row), np.int64)
            yield by_sequences(batch["doc_id"], n, ids, row, none, start, stop, before, sequence)

    return tokens.join(base, ["queue", "task"]).mapInArrow(lay_out, PIECES)


def _shares(queues: DataFrame, weights: DataFrame | None, sequence: int, slot: int) -> DataFrame:
    """Saved ``queue, total, slots, share, begun``: the slots that every round gives a queue, and its first credit."""
    queues = queues.withColumn("slots", F.ceil(F.col("total") / F.lit(slot)).cast("long"))
    if weights is None:
        queues = queues.withColumn("weight", F.col("slots").cast("double"))
    else:
        given = weights.select(queue_of("source").alias("queue"), F.col("weight").cast("double").alias("weight"))
        queues = queues.join(given.groupBy("queue").agg(F.sum("weight").alias("weight")), "queue", "left")
    queues = saved(queues, "queues")
    usable = F.coalesce((F.col("weight") > 0) & (F.col("weight") < float("inf")), F.lit(False))
    missing, total = queues.agg(F.count_if(~usable), F.sum("weight")).first()
    if missing:
        raise ValueError(f"{missing} sources have no weight above 0")
    share = F.col("weight") * F.lit(sequence / slot / (total or 1))
    begun = F.pmod(F.xxhash64("queue"), F.lit(2**20)) / F.lit(float(2**20))
    return queues.select("queue", "total", "slots", share.alias("share"), begun.alias("begun"))


def _sorted(tokens: DataFrame, sequence: int, slot: int) -> DataFrame:
    """The pieces where no task holds all queues."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, k, at, start, stop = by_slots(batch, slot)
            rounds = Queues(*(batch[c].to_numpy()[row] for c in STATE)).round_of(k)
            own = [batch[c].take(pa.array(row)) for c in ("doc_id", "queue", "n")]
            texts = batch["ids"].to_pylist()
            spans = zip(row.tolist(), (2 * start).tolist(), (2 * stop).tolist(), strict=True)
            ids = pa.array([texts[i][a:b] for i, a, b in spans], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*own, *map(pa.array, (start, stop - start, rounds, k, at)), ids],
                ["doc_id", "queue", "n", "start", "length", "round", "k", "at", "ids"],
            )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, before = batch["start"].to_numpy(), batch["length_before"].to_numpy()
            n, ids, row = batch["n"].to_numpy(), batch["ids"].to_pylist(), np.arange(len(start))
            stop = start + batch["length"].to_numpy()
            yield by_sequences(batch["doc_id"], n, ids, row, start, start, stop, before, sequence)

    fields = (
        "doc_id long, queue string, n long, start long, length long, round long, k long, at long, ids binary"
    )
    cut = tokens.mapInArrow(run, fields)
    return running_totals(cut, ["round", "queue", "k", "at"], ["length"], "slots").mapInArrow(finish, PIECES)
