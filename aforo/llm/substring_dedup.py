"""Repeated passages by phrase automata.

Every window of ``window`` words holds its minimizer, the phrase of ``PHRASE`` words with the least hash, so
equal windows hold equal phrases. Phrases that recur in several documents are confirmed by a count over the corpus.
Each block of documents gets an Aho-Corasick automaton of the confirmed phrases it may hold, a shard whose size is
bounded by the block, and all its documents are streamed through it to locate every occurrence. Only windows around
an occurrence can recur; the least document of each such window is found by a second count and sent back to the blocks.

A phrase recurs when two different texts hold it. Copies of one text need no windows: all words of a later copy go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aforo.llm.common import Staging, WordHashes, give_back, id_and_text, mixed, squeeze, unsqueeze, tidied

WINDOW = 50
PHRASE = 10
BLOCK_BYTES = 2 << 20
PACKED = "block long, ids array<long>, sizes array<long>, texts array<binary>, raw array<binary>, words binary"
ROW = pa.schema(
    [
        ("block", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.binary())),
        ("raw", pa.list_(pa.binary())),
        ("words", pa.binary()),
    ]
)
PHRASES = "block long, hash long, least long, most long"
FOUND = "block long, hash long, check long, least long, most long"
RESULT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.binary()),
        ("text_md5", pa.string()),
    ]
)
JUDGED = "id long, n_words long, n_removed long, kept_sha256 string, kept binary, text_md5 string"
# Odd, so that powers of them keep all 64 bits.
STEP, CHECK_STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of all runs of a fixed length, from running sums of a polynomial."""

    def __init__(self, step: int = STEP) -> None:
        self.step, self.up, self.down = step, np.empty(0, np.uint64), np.empty(0, np.uint64)

    def runs(self, hashes: np.ndarray, size: int) -> np.ndarray:
        n = len(hashes)
        if n < size:
            return np.empty(0, np.uint64)
        if n > len(self.up):
            self.up = _powers(self.step, 2 * n)
            self.down = _powers(pow(self.step, -1, 1 << 64), 2 * n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.up[:n], out=sums[1:])
        return mixed((sums[size:] - sums[:-size]) * self.down[: n - size + 1])


def minimizers(phrases: np.ndarray, per_window: int) -> np.ndarray:
    """Start of the phrase with the least hash (the first such) in each run of ``per_window`` phrases, once each."""
    if len(phrases) < per_window:
        return np.empty(0, np.int64)
    # Doubling: least of 1, 2, 4, ... values, then two overlapping runs cover the window.
    least, at, length = phrases, np.arange(len(phrases)), 1
    while 2 * length <= per_window:
        least, at = _lesser(least[:-length], at[:-length], least[length:], at[length:])
        length *= 2
    rest = per_window - length
    if rest:
        least, at = _lesser(least[:-rest], at[:-rest], least[rest:], at[rest:])
    return np.unique(at)


def _lesser(a, at_a, b, at_b):
    first = a <= b
    return np.where(first, a, b), np.where(first, at_a, at_b)


@tidied
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 24
    ids, sizes, names, raws, texts, total = [], [], [], [], [], 0

    def row():
        values = {"block": number, "ids": ids, "sizes": sizes, "texts": names, "raw": raws}
        return pa.RecordBatch.from_pylist([values | {"words": squeeze(b" ".join(texts))}], schema=ROW)

    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = value.as_py() or b""
            words = raw.split()
            joined = b" ".join(words)
            ids.append(key)
            sizes.append(len(words))
            names.append(xxhash.xxh3_128_digest(joined))
            raws.append(hashlib.md5(raw).digest())
            if words:
                texts.append(joined)
                total += len(joined)
            if total >= BLOCK_BYTES:
                yield row()
                number += 1
                ids, sizes, names, raws, texts, total = [], [], [], [], [], 0
    if ids:
        yield row()


class _Documents:
    """The documents of a packed block: keys, words and the hash of each word."""

    def __init__(self, row: dict, hashes: WordHashes):
        self.words = unsqueeze(row["words"]).split()
        self.hashes = hashes.of(self.words)
        self.ids, self.sizes = row["ids"], row["sizes"]
        self.texts = np.frombuffer(b"".join(row["texts"]), np.int64).reshape(-1, 2)
        self.raw = row["raw"]

    def __iter__(self):
        ends = np.cumsum(self.sizes).tolist()
        return zip(self.ids, [0, *ends[:-1]], ends)


class _Extremes:
    """Of each hash, the least and the greatest of what it comes with."""

    def __init__(self) -> None:
        self.rows: list[tuple[np.ndarray, ...]] = []

    def add(self, key: int, *hashes: np.ndarray) -> None:
        if len(hashes[0]):
            _, first = np.unique(hashes[0], return_index=True)
            self.rows.append((*(h[first].astype(np.int64) for h in hashes), np.full(len(first), key, np.int64)))

    def batch(self, block: int, *names: str) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.rows)] or [np.empty(0, np.int64)] * (len(names) + 1)
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(order)][: len(first)] - 1
        out = [np.full(len(first), block, np.int64), *(c[first] for c in columns), columns[-1][last]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["block", *names, "least", "most"])


@tidied
def _phrases(batches: Iterator[pa.RecordBatch], window: int, phrase: int) -> Iterator[pa.RecordBatch]:
    rolling, hashes = Rolling(), WordHashes()
    for batch in batches:
        for row in batch.to_pylist():
            documents, found = _Documents(row, hashes), _Extremes()
            for (key, a, b), text in zip(documents, documents.texts[:, 0].tolist()):
                if key is not None and b - a >= window:
                    runs = rolling.runs(documents.hashes[a:b], phrase)
                    found.add(text, runs[minimizers(runs, window - phrase + 1)])
            yield found.batch(row["block"], "hash")


@tidied
def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = _Extremes()
            texts = np.frombuffer(b"".join(row["texts"]), np.int64).reshape(-1, 2)
            for i, key in enumerate(row["ids"]):
                if key is not None:
                    found.add(key, texts[i : i + 1, 0], texts[i : i + 1, 1])
            yield found.batch(row["block"], "hash", "check")


def _occurrences(words: list[bytes], starts: np.ndarray, size: int) -> np.ndarray:
    """Word positions of every occurrence of the phrases that start at ``starts``.

    The automaton compares the very words. Bytes are read as Latin-1, which keeps each as one character.
    """
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for start in starts.tolist():
        automaton.add_word((b" " + b" ".join(words[start : start + size]) + b" ").decode("latin-1"))
    automaton.make_automaton()
    text = (b" " + b" ".join(words) + b" ").decode("latin-1")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    hits = np.fromiter((end for end, _ in automaton.iter(text)), np.int64)
    return np.searchsorted(ends, hits) - size + 1


def _windows(blocks: pa.Table, confirmed: pa.Table, window: int, phrase: int) -> pa.Table:
    """The windows of a block's documents that hold a recurring phrase, with least and greatest document."""
    rolling, second, hashes = Rolling(), Rolling(CHECK_STEP), WordHashes()
    known = np.sort(np.array(confirmed.column("hash"), np.int64).view(np.uint64))
    out = []
    for row in blocks.to_pylist():
        documents, found = _Documents(row, hashes), _Extremes()
        if len(known) and documents.words:
            runs = rolling.runs(documents.hashes, phrase)
            # Where the block holds each recurring phrase for the first time.
            candidates = np.flatnonzero(np.isin(runs, known))
            _, first = np.unique(runs[candidates], return_index=True)
            at = np.sort(_occurrences(documents.words, candidates[first], phrase))
            for key, a, b in documents:
                n = b - a - window + 1
                if key is None or n <= 0:
                    continue
                own = at[np.searchsorted(at, a) : np.searchsorted(at, b - phrase, "right")] - a
                near = np.zeros(n + 1, np.int64)
                np.add.at(near, np.clip(own - (window - phrase), 0, n), 1)
                np.add.at(near, np.clip(own + 1, 0, n), -1)
                open_ = np.cumsum(near)[:n] > 0
                if open_.any():
                    own = documents.hashes[a:b]
                    found.add(key, rolling.runs(own, window)[open_], second.runs(own, window)[open_])
        out.append(found.batch(row["block"], "hash", "check"))
        del documents
    give_back()
    empty = _Extremes().batch(0, "hash", "check")
    return pa.Table.from_batches([*out, empty])


def _judge(blocks: pa.Table, repeated: pa.Table, window: int) -> pa.Table:
    rolling, second, hashes = Rolling(), Rolling(CHECK_STEP), WordHashes()
    known, check, least = (np.array(repeated.column(c), np.int64) for c in ("hash", "check", "least"))
    order = np.argsort(known)
    known, check, least = known[order], check[order], least[order]

    def first_of(a: np.ndarray, b: np.ndarray, key: int) -> np.ndarray:
        """Whether an earlier document has it."""
        at = np.minimum(np.searchsorted(known, a), len(known) - 1)
        return (known[at] == a) & (check[at] == b) & (least[at] < key)

    out = {f.name: [] for f in RESULT}
    for row in blocks.to_pylist():
        documents = _Documents(row, hashes)
        for (key, a, b), text, raw in zip(documents, documents.texts, documents.raw):
            words, covered = documents.words[a:b], np.zeros(b - a, bool)
            if len(known) and key is not None and b - a >= window:
                if first_of(text[:1], text[1:], key).any():
                    covered[:] = True
                else:
                    own = documents.hashes[a:b]
                    runs, other = (r.runs(own, window).view(np.int64) for r in (rolling, second))
                    removed = np.flatnonzero(first_of(runs, other, key))
                    edges = np.zeros(b - a + 1, np.int64)
                    edges[removed] += 1
                    edges[removed + window] -= 1
                    covered = np.cumsum(edges)[:-1] > 0
            any_ = bool(covered.any())
            if any_:
                words = [w for w, c in zip(words, covered.tolist()) if not c]
            kept = b" ".join(words)
            values = (key, b - a, b - a - len(words), hashlib.sha256(kept).hexdigest(), kept if any_ else None, raw.hex())
            for column, value in zip(out.values(), values):
                column.append(value)
    give_back()
    return pa.Table.from_pydict(out, schema=RESULT)


def repeated_passages(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, phrase: int = PHRASE
) -> DataFrame:
    """Per row of ``df``: the key, ``n_words``, ``n_removed``, ``kept_sha256`` of the words that stay joined by one
    space, ``kept`` (these words; NULL where nothing goes) and ``text_md5`` of the input text.

    A word goes if a window of ``window`` words covers it whose sequence also starts in a document with
    a lesser key. Words are separated by ASCII white space and compared as they are. A NULL or empty
    text has no words. A row with a NULL key is left whole and takes nothing from others. Rows with
    equal keys are one document: they take nothing from each other. Other columns are not read.
    """
    stage = Staging(df.sparkSession, "passages")
    blocks = stage.table(id_and_text(df, key, text).mapInArrow(_pack, PACKED), "blocks")

    def phrases(batches):
        return _phrases(batches, window, phrase)

    def windows(packed: pa.Table, confirmed: pa.Table) -> pa.Table:
        return _windows(packed, confirmed, window, phrase)

    def judge(packed: pa.Table, repeated: pa.Table) -> pa.Table:
        return _judge(packed, repeated, window)

    # A block sends each hash once, so a hash has as many rows as blocks that hold it.
    same = Window.partitionBy("hash")
    confirmed = (
        blocks.mapInArrow(phrases, PHRASES)
        .withColumns({"first": F.min("least").over(same), "last": F.max("most").over(same)})
        .where("first < last")
        .select("block", "hash")
    )
    columns = blocks.select("block", "ids", "sizes", "texts", "raw", "words")
    found = columns.groupBy("block").cogroup(confirmed.groupBy("block")).applyInArrow(windows, FOUND)
    copies = blocks.select("block", "ids", "texts").mapInArrow(_copies, FOUND)
    equal = Window.partitionBy("hash", "check")
    repeated = (
        found.unionByName(copies)
        .withColumns({"first": F.min("least").over(equal), "last": F.max("most").over(equal)})
        .where("first < last")
        .select("block", "hash", "check", F.col("first").alias("least"))
    )
    judged = columns.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(judge, JUDGED)
    return stage.result(judged.withColumnRenamed("id", key))
