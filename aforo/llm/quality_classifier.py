"""Document quality by random-indexing word vectors and a small network.

Every token has a sparse random index vector, derived from its hash. A token's vector adds the index vectors of the
tokens that it stood beside in the training texts to its own. A document pools the vectors of all its tokens, and a
two-layer network turns the pool into a score, whose temperature is fitted on training rows kept aside.

The model is fitted on a bounded sample of labelled rows (``SAMPLE``); scoring covers every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import CACHE_WORDS, id_and_text, squeeze, tidied, unsqueeze

# Labelled rows that the model is fitted on: those with the least hash of their key.
SAMPLE = 12_000
BUCKETS = 1 << 13
WIDTH = 64
NONZERO = 4
HIDDEN = 24
EPOCHS = 40
TASKS = 12
# Neighbour sums leave the tasks in slices of so many tokens.
SLICE = 256
AGAIN, LINE_AGAIN = 0, 1
RESERVED = 2
PIECE = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
SCORED = "id long, score double"


def index_vectors() -> np.ndarray:
    """A sparse vector of +1 and -1 for every token number."""
    random = np.random.default_rng(11)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    for column in range(NONZERO):
        at = random.integers(0, WIDTH // NONZERO, BUCKETS) + column * (WIDTH // NONZERO)
        out[np.arange(BUCKETS), at] = random.choice([-1.0, 1.0], BUCKETS)
    return out


class _Tokens(dict):
    """Raw word -> numbers of its pieces: each piece itself and its shape."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        out = []
        for piece in PIECE.findall(word):
            first = piece[:1]
            if first.isdigit():
                shape = b"0"
            elif first.isalpha() or first >= b"\x80":
                shape = b"A" if piece.upper() == piece and piece.lower() != piece else b"Aa" if piece.istitle() else b"a"
            else:
                shape = b"." + bytes(sorted(set(piece)))[:4] + (b"+" if len(piece) > 2 else b"")
            for token in (piece.lower(), b" " + shape):
                out.append(RESERVED + xxhash.xxh3_64_intdigest(token) % (BUCKETS - RESERVED))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = numbers = tuple(out)
        return numbers


def tokens_of(raw: bytes | None, cache: _Tokens) -> np.ndarray:
    """Token numbers of the whole text; a word or line that comes again adds a token that says so."""
    out: list[int] = []
    lines: set[bytes] = set()
    for line in (raw or b"").split(b"\n"):
        words = line.split()
        if not words:
            continue
        if line in lines:
            out.extend([LINE_AGAIN] * len(words))
        lines.add(line)
        before = None
        for word in words:
            out.extend(cache[word])
            if word == before:
                out.append(AGAIN)
            before = word
    return np.array(out, np.int64)


def pool(tokens: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The mean vector of the tokens, with the logarithm of their number."""
    if not len(tokens):
        return np.zeros(vectors.shape[1] + 1, np.float32)
    counts = np.bincount(tokens, minlength=len(vectors))
    used = np.flatnonzero(counts)
    mean = counts[used].astype(np.float32) @ vectors[used] / len(tokens)
    return np.r_[mean, np.float32(np.log1p(len(tokens)) / 10)]


@dataclass
class Model:
    vectors: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        x = (pooled - self.shift) / self.scale
        return np.tanh(x @ self.first + self.first_bias) @ self.second + self.second_bias

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -50, 50)))


@tidied
def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair of tokens of the task stood side by side, applied to the index vectors: a row per slice of tokens."""
    index, total, cache = index_vectors(), np.zeros((BUCKETS, WIDTH), np.float64), _Tokens()
    for batch in batches:
        for value in batch.column(1):
            tokens = tokens_of(value.as_py(), cache)
            pairs, counts = np.unique(tokens[:-1] * BUCKETS + tokens[1:], return_counts=True)
            left, right = pairs // BUCKETS, pairs % BUCKETS
            np.add.at(total, left, index[right] * counts[:, None])
            np.add.at(total, right, index[left] * counts[:, None])
    for at in range(0, BUCKETS, SLICE):
        if (part := total[at : at + SLICE].astype(np.float32)).any():
            yield pa.RecordBatch.from_pydict({"at": pa.array([at]), "sums": pa.array([squeeze(part.tobytes())], pa.binary())})


def _added(slices: pa.Table) -> pa.Table:
    """The sum of a slice over all tasks."""
    total = np.zeros(SLICE * WIDTH)
    for part in slices.column("sums"):
        total += np.frombuffer(unsqueeze(part.as_py()), np.float32)
    return pa.table({"at": slices.column("at")[:1], "sums": pa.array([total.tobytes()], pa.binary())})


@tidied
def _pooled(batches: Iterator[pa.RecordBatch], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    cache = _Tokens()
    for batch in batches:
        rows = [pool(tokens_of(v.as_py(), cache), vectors).astype(np.float32).tobytes() for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["id", "pooled"])


@tidied
def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    cache = _Tokens()
    for batch in batches:
        rows = [pool(tokens_of(v.as_py(), cache), model.vectors) for v in batch.column(1)]
        scores = model.scores(np.array(rows)) if rows else np.empty(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores.astype(np.float64))], names=["id", "score"]
        )


def _train(pooled: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Model:
    """Fit the network by mini-batches; every fifth row is kept aside and sets the number of epochs and the temperature."""
    random, kept = np.random.default_rng(5), np.arange(len(labels)) % 5 == 4
    if kept.sum() < 20:
        kept[:] = False
    x, y = pooled[~kept].astype(np.float64), labels[~kept]
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    parts = [
        random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    x = (x - shift) / scale
    moment, spread, turn = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    best, best_loss = [p.copy() for p in parts], np.inf

    def model(values: list[np.ndarray], temperature: float = 1.0) -> Model:
        return Model(vectors, shift, scale, *values[:3], float(values[3][0]), temperature)

    def loss(m: Model) -> float:
        rows = kept if kept.any() else ~kept
        p = np.clip(m.scores(pooled[rows]), 1e-9, 1 - 1e-9)
        return float(-np.mean(np.log(np.where(labels[rows] > 0.5, p, 1 - p))))

    for _ in range(EPOCHS):
        order = random.permutation(len(x))
        for at in range(0, len(order), 64):
            rows, turn = order[at : at + 64], turn + 1
            hidden = np.tanh(x[rows] @ parts[0] + parts[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ parts[2] + parts[3], -50, 50))) - y[rows]) / len(rows)
            back = np.outer(error, parts[2]) * (1 - hidden**2)
            slopes = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            for p, g, m, v in zip(parts, slopes, moment, spread):
                m += 0.1 * (g + 1e-4 * p - m)
                v += 0.001 * (g**2 - v)
                p -= 0.004 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        if (now := loss(model(parts))) < best_loss:
            best, best_loss = [p.copy() for p in parts], now
    heats = np.exp(np.linspace(-1.5, 1.5, 61))
    return model(best, float(min(heats, key=lambda t: loss(model(best, t)))))


def fit(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Model | float:
    """The model of at most ``sample`` labelled keys, or a constant score if fewer than two labels occur.

    A key with several labels has the one that most of them give (1 on a tie), one with several documents the least
    of their texts. Rows with a NULL key or label, and labels of absent documents, are not used.
    """
    named = (
        labels.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("double").alias("y"))
        .where("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg((F.avg("y") >= 0.5).cast("double").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    texts = id_and_text(documents, key, text).join(F.broadcast(named), "id").select("id", "text")
    # Copies of a key fall together in the map tasks, so a key on many rows is one text here.
    texts = texts.groupBy("id").agg(F.min("text").alias("text")).repartition(TASKS, "id")
    index, total = index_vectors(), np.zeros((BUCKETS, WIDTH), np.float64)
    # Added up by the tasks, so that the driver takes one matrix whatever their number is.
    slices = texts.mapInArrow(_neighbours, "at long, sums binary").groupBy("at").applyInArrow(_added, "at long, sums binary")
    for row in slices.collect():
        total[row["at"] : row["at"] + SLICE] = np.frombuffer(row.sums).reshape(SLICE, WIDTH)
    norms = np.linalg.norm(total, axis=1, keepdims=True)
    vectors = (index + total / np.maximum(norms, 1)).astype(np.float32)
    truth = {r.id: r.y for r in named.collect()}
    rows = texts.mapInArrow(partial(_pooled, vectors=vectors), "id long, pooled binary").collect()
    rows = sorted((r.id, bytes(r.pooled)) for r in rows)
    y = np.array([truth[i] for i, _ in rows])
    if len(set(y.tolist())) < 2:
        return float((y.sum() + 1) / (len(y) + 2))
    return _train(np.array([np.frombuffer(p, np.float32) for _, p in rows]), y, vectors)


def passing(documents: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """The rows of ``documents`` with a score of 0.5 or more, all columns as they are."""
    if isinstance(model, float):
        return documents.where(F.lit(model >= 0.5))
    fields, column = documents.schema, documents.columns.index(text)

    @tidied
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Tokens()
        for batch in batches:
            texts = batch.column(column).cast(pa.binary())
            rows = [pool(tokens_of(v.as_py(), cache), model.vectors) for v in texts]
            if rows:
                yield batch.filter(pa.array(model.scores(np.array(rows)) >= 0.5))

    return documents.mapInArrow(keep, fields)


def score(documents: DataFrame, model: Model | float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``documents``: the key and ``score`` (0 to 1). NULL and empty texts are scored as texts without tokens."""
    source = id_and_text(documents, key, text)
    if isinstance(model, float):
        out = source.select("id", F.lit(model).alias("score"))
    else:
        out = source.mapInArrow(partial(_score, model=model), SCORED)
    return out.withColumnRenamed("id", key)
