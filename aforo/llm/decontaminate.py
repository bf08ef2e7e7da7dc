"""Benchmark passages in documents, found by edit distance.

The CGK embedding walks over a word sequence: at each step it writes the word under the walk and moves on, or not,
by a random bit of (step, word). Sequences at a small edit distance fall back into step, so their embeddings are at
a small Hamming distance. Bit sampling draws a few steps of the embedding as a hash key; repeated walks and draws reach
the target recall over item-sized windows. Every candidate is confirmed by its exact edit distance.

A window can only match if it holds nearly as many words of the benchmark's vocabulary as the item has words; this
bound is exact and leaves few windows to walk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import CACHE_WORDS, MIX, id_and_text, mixed, text_md5, tidied

EDITS = 0.15
MIN_WORDS = 5
WALKS = 12
DRAWN = 3
# Benchmark text that one scan of the documents carries; a larger benchmark is scanned for in slices.
SLICE_BYTES = 16 << 20
TRIM = bytes(i for i in range(128) if not chr(i).isalnum())
FOUND = "doc_id long, item_id long, distance int, at_word long, text_md5 string"


def words_of(raw: bytes | None) -> list[bytes]:
    """A-Z lower-cased words without ASCII punctuation at their ends; words of nothing else are left out."""
    return [w for w in (x.strip(TRIM) for x in (raw or b"").lower().split()) if w]


def edits_of(words: int, edits: float = EDITS) -> int:
    """Greatest edit distance, in words, at which an item of so many words is found."""
    return int(edits * words)


class _Walks:
    """For each walk a random number per vocabulary word; its product with a step's odd number tells whether to move."""

    def __init__(self, numbers: int, walks: int):
        random = np.random.default_rng(walks)
        seeds = random.integers(1, 1 << 63, walks, dtype=np.uint64)
        self.words = [mixed(np.arange(numbers, dtype=np.uint64) * MIX + seed) for seed in seeds]

    def bits(self, walk: int, sequence: np.ndarray) -> np.ndarray:
        return self.words[walk][sequence]


class _Class:
    """Items of about equal sizes: the keys of their embeddings, walk by walk."""

    def __init__(self, items: list[int], words: list[np.ndarray], edits: float, walks: _Walks, drawn: int):
        sizes = [len(words[i]) for i in items]
        # A walk takes two steps a word on average, so it seldom comes to the end of an item.
        self.least, self.steps = min(sizes), max(drawn, 3 * min(sizes) // 2)
        self.edits = max(edits_of(n, edits) for n in sizes)
        random = np.random.default_rng(self.least)
        self.draws = [np.sort(random.choice(self.steps, drawn, replace=False)) for _ in walks.words]
        end = len(walks.words[0]) - 1
        starts, row, at = [], [], 0
        for i in items:
            starts.append(at)
            row.append(np.r_[words[i], np.full(self.steps, end, np.int32)])
            at += len(row[-1])
        sequence, starts, owner = np.concatenate(row), np.array(starts), np.array(items)
        self.tables = []
        for walk in range(len(walks.words)):
            keys = self.keys(walks.bits(walk, sequence), starts, walk)
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], owner[order]))

    def keys(self, bits: np.ndarray, starts: np.ndarray, walk: int) -> np.ndarray:
        """Of the walk from each start, a hash of the drawn steps. Enough other words follow the last start."""
        at, key, drawn = starts.copy(), np.zeros(len(starts), np.uint64), set(self.draws[walk].tolist())
        for step in range(int(self.draws[walk][-1]) + 1):
            word = bits[at]
            if step in drawn:
                key = key * MIX + word
            at += ((word * np.uint64(2 * step + 1)) >> np.uint64(63)).astype(np.int64)
        return mixed(key)

    def starts(self, sequence: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Where an item can start; ``known`` counts vocabulary words up to each word."""
        n = self.least
        enough = known[n:] - known[:-n] >= n - self.edits
        return np.flatnonzero(enough & (sequence[: len(enough)] > 0))

    def candidates(self, bits: np.ndarray, starts: np.ndarray, walk: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, items) whose keys are equal in the walk."""
        keys, owner = self.tables[walk]
        own = self.keys(bits, starts, walk)
        left, right = np.searchsorted(keys, own), np.searchsorted(keys, own, "right")
        hit = np.flatnonzero(right - left)
        count = (right - left)[hit]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(starts[hit], count), owner[np.repeat(left[hit], count) + within]


class Benchmark:
    """Items prepared for a scan: words as numbers (0 is any other word) and classes by size."""

    def __init__(self, rows, edits: float = EDITS, min_words: int = MIN_WORDS, walks: int = WALKS, drawn: int = DRAWN):
        self.edits, self.vocabulary, self.ids, self.words = edits, {}, [], []
        for key, raw in rows:
            words = words_of(raw)
            if key is not None and len(words) >= min_words:
                number = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                self.ids.append(key)
                self.words.append(np.array(number, np.int32))
        classes: dict[int, list[int]] = {}
        for i, words in enumerate(self.words):
            classes.setdefault(int(math.log(len(words), 1.3)), []).append(i)
        self.walks = _Walks(len(self.vocabulary) + 2, walks)
        self.classes = [_Class(c, self.words, edits, self.walks, drawn) for c in classes.values()]
        self.present = np.zeros(len(self.vocabulary) + 2, bool)
        self.longest = max(map(len, self.words), default=0)
        # Zeros between documents: no walk from one reaches the words of the next.
        self.gap = 2 * self.longest + 1


def distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to any run of the words, and where that run ends."""
    row = np.zeros(len(words) + 1, np.int64)
    steps = np.arange(len(words) + 1)
    for i, word in enumerate(item.tolist(), 1):
        best = np.minimum(row[:-1] + (words != word), row[1:] + 1)
        row = np.r_[i, best]
        row = np.minimum.accumulate(row - steps) + steps
    return int(row.min()), int(row.argmin())


class _Numbers(dict):
    """Raw word -> its number in the vocabulary, 0 if it is another, -1 if nothing is left of it."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, raw: bytes) -> int:
        word = raw.strip(TRIM)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[raw] = number = self.vocabulary.get(word, 0) if word else -1
        return number


def _confirm(
    benchmark: Benchmark, sequence: np.ndarray, first: int, end: int, item: int, starts: list[int]
) -> tuple[int, int] | None:
    """(distance, start) of the item near its candidate starts in one document; None if none is near enough."""
    words = benchmark.words[item]
    most, best = edits_of(len(words), benchmark.edits), None
    spans: list[list[int]] = []
    for at in starts:
        low, high = max(first, at - most), min(end, at + len(words) + 2 * most)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])
    for low, high in spans:
        benchmark.present[sequence[low:high]] = True
        held = int(benchmark.present[words].sum())
        benchmark.present[sequence[low:high]] = False
        if held < len(words) - most:
            continue
        d, stop = distance(words, sequence[low:high])
        if d <= most and (best is None or d < best[0]):
            best = d, max(first, low + stop - len(words)) - first
    return best


@tidied
def _scan(batches: Iterator[pa.RecordBatch], benchmark: Benchmark) -> Iterator[pa.RecordBatch]:
    number, gap = _Numbers(benchmark.vocabulary), np.zeros(benchmark.gap, np.int32)

    def scanned(keys: list[tuple], parts: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.array([len(p) for p in parts])
        firsts = np.cumsum(lengths + len(gap)) - lengths - len(gap)
        sequence = np.concatenate([x for p in parts for x in (p, gap)])
        known = np.r_[0, np.cumsum(sequence > 0)]
        pairs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        opened = [(c, c.starts(sequence, known)) for c in benchmark.classes]
        for walk in range(len(benchmark.walks.words)):
            bits = benchmark.walks.bits(walk, sequence)
            for c, open_ in opened:
                starts, items = c.candidates(bits, open_, walk)
                pairs[0].append(starts), pairs[1].append(items)
        starts, items = np.concatenate(pairs[0]), np.concatenate(pairs[1])
        starts, items = np.unique(np.stack([starts, items]), axis=1)
        document = np.searchsorted(firsts, starts, "right") - 1
        out = {"doc_id": [], "item_id": [], "distance": [], "at_word": [], "text_md5": []}
        near: dict[tuple[int, int], list[int]] = {}
        for d, item, at in zip(document.tolist(), items.tolist(), starts.tolist()):
            near.setdefault((d, item), []).append(at)
        for (d, item), ats in near.items():
            end = int(firsts[d] + lengths[d])
            if best := _confirm(benchmark, sequence, int(firsts[d]), end, item, ats):
                for column, value in zip(out.values(), (keys[d][0], benchmark.ids[item], *best, keys[d][1])):
                    column.append(value)
        return pa.RecordBatch.from_pydict(
            out,
            schema=pa.schema(
                [
                    ("doc_id", pa.int64()),
                    ("item_id", pa.int64()),
                    ("distance", pa.int32()),
                    ("at_word", pa.int64()),
                    ("text_md5", pa.string()),
                ]
            ),
        )

    for batch in batches:
        keys, parts, size = [], [], 0
        keyed = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
        for key, value in zip(keyed, batch.column(1)):
            words = (value.as_py() or b"").lower().split()
            numbers = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            keys.append(key), parts.append(numbers[numbers >= 0])
            size += len(words)
            if size > 1 << 20:
                yield scanned(keys, parts)
                keys, parts, size = [], [], 0
        if keys:
            yield scanned(keys, parts)


def leaks(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    edits: float = EDITS,
    min_words: int = MIN_WORDS,
    slice_bytes: int = SLICE_BYTES,
    digest: bool = False,
) -> DataFrame:
    """(doc_id, item_id, distance, at_word) of every item that a document holds within ``edits`` times its words.

    ``distance`` is the least edit distance in words to any passage of the document and ``at_word`` about where
    it starts. Words are compared without case (A-Z) and punctuation at their ends. Items of fewer than
    ``min_words`` words are no evidence and match nothing. NULL or empty texts hold nothing; items with a NULL
    key are left out, documents with one are reported with it. Equal rows are each reported. ``digest`` adds
    ``text_md5`` of the document, which tells documents with equal or NULL keys apart.

    The items are sent to all tasks in slices of at most ``slice_bytes`` (one item at least), each with a scan of its own.
    """
    rows = id_and_text(items, item_key, item_text).where("id IS NOT NULL AND text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = total // slice_bytes + 1
    source, out = id_and_text(documents, key, text, text_md5(text).alias("text_md5")), None
    for n in range(slices):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == n).orderBy("id", "text")
        benchmark = Benchmark(((r.id, bytes(r.text)) for r in part.toLocalIterator()), edits, min_words)
        if benchmark.words:
            found = source.mapInArrow(partial(_scan, benchmark=benchmark), FOUND)
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = source.sparkSession.createDataFrame([], FOUND)
    out = out.withColumnRenamed("doc_id", key).withColumnRenamed("item_id", item_key)
    return out if digest else out.drop("text_md5")
