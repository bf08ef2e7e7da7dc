"""Log probabilities of texts under an n-gram model kept in Elias-Fano tries.

Documents are packed by block. A block sends its distinct bigrams, with their counts in its training documents, to shards
by hash. A shard adds the counts up, builds a trie whose levels are Elias-Fano sequences in a memory-mapped
file, with the quantised discounted count of each bigram, and answers every block by successor search. Words go the
same way for their counts and for the totals of their contexts. A block then scores its documents.

The model discounts bigram counts by ``DISCOUNT`` and gives what that frees to the smoothed word probabilities:
p(w | v) = (max(c(v, w) - d, 0) + d * types(v) * p(w)) / c(v), p(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)), and p(w)
after a word that no training document holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo.llm.blocks import packed
from aforo.llm.common import Staging, give_back, mixed, squeeze, unpack_ints, unpack_strings, unsqueeze, tidied
from aforo.llm.elias_fano import File, Monotone, Trie

DISCOUNT = 0.75
# Text whose bigrams one shard takes.
SHARD_BYTES = 12 << 20
# Words that no text holds.
START, END = b"\t", b"\n"
SCALE = 4096

ASKED = "shard int, block long, keys binary, counts binary"
ANSWERED = "block long, shard int, codes binary, contexts binary, totals binary, types binary"
WORDS = "block long, shard int, counts binary, totals binary, types binary, tokens long, distinct long"
SCORED = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def split(raw: bytes) -> list[bytes]:
    return [*raw.lower().split(), END]


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as compressed byte planes of their differences."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


class _Block:
    """A block's documents: hashes of its words (the last one is the start), and the word before each token."""

    def __init__(self, row: dict):
        words = unpack_strings(row["vocabulary"])
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, [*words, START]), np.uint64, len(words) + 1)
        self.tokens = unpack_ints(row["sequence"]).astype(np.int64)
        self.sizes = unpack_ints(row["sizes"]).astype(np.int64)
        self.train = np.repeat(np.array([f is True for f in row["flags"]], bool), self.sizes)
        self.before = np.r_[0, self.tokens[:-1]]
        self.before[np.cumsum(self.sizes) - self.sizes] = len(words)
        top = self.hashes >> np.uint64(32)
        keys = (top[self.before] << np.uint64(32)) | top[self.tokens]
        self.keys, self.place = np.unique(keys, return_inverse=True)

    def bigram_counts(self) -> np.ndarray:
        return np.bincount(self.place[self.train], minlength=len(self.keys))

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.hashes))


def _by_bigram(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys) % np.uint64(shards)).astype(np.int32)


def _by_word(top: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a word by the upper 32 bits of its hash, which also name it as a context."""
    return ((top * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)


def _ordered(keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
    return np.lexsort((keys, shard))


@tidied
def _ask(batches: Iterator[pa.RecordBatch], shards: int, bigrams: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row)
            if bigrams:
                keys, counts = block.keys, block.bigram_counts()
                shard = _by_bigram(keys, shards)
            else:
                keys, counts = block.hashes, block.word_counts()
                shard = _by_word(keys >> np.uint64(32), shards)
            del block
            order = _ordered(keys, shard)
            keys, counts, shard = keys[order], counts[order], shard[order]
            cuts = (np.flatnonzero(np.diff(shard)) + 1).tolist()
            give_back()
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([int(shard[a])], pa.int32()),
                        "block": [row["block"]],
                        "keys": pa.array([_pack_keys(keys[a:b])], pa.binary()),
                        "counts": pa.array([squeeze(counts[a:b].astype("<u4").tobytes())], pa.binary()),
                    }
                )


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(unsqueeze(data), "<u4").astype(np.int64)


def _summed(asked: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a shard that occur in training documents, and their counts over all blocks."""
    keys, counts = [], []
    for row in zip(asked.column("keys"), asked.column("counts")):
        own, n = _unpack_keys(row[0].as_py()), _counts(row[1].as_py())
        keys.append(own[n > 0])
        counts.append(n[n > 0])
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts


def quantised(counts: np.ndarray, discount: float) -> np.ndarray:
    """Codes of discounted counts; 0 is kept for none. Rounded down, so that probabilities add up to at most 1."""
    return np.floor((np.log10(counts - discount) + 1) * SCALE).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10 ** (codes / SCALE - 1), 0.0)


def _bigram_shard(asked: pa.Table, shards: int, discount: float) -> pa.Table:
    keys, counts = _summed(asked)
    trie = Trie(keys, quantised(counts, discount))
    out = {name: [] for name in ("block", "shard", "codes", "contexts", "totals", "types")}

    def add(block, shard, codes=None, contexts=None, totals=None, types=None):
        for column, value in zip(out.values(), (block, shard, codes, contexts, totals, types)):
            column.append(value)

    number = asked.column("shard")[0].as_py()
    for block, sought in zip(asked.column("block").to_pylist(), asked.column("keys")):
        add(block, number, squeeze(trie.codes_of(_unpack_keys(sought.as_py())).tobytes()))
    contexts, first = np.unique(keys >> np.uint64(32), return_index=True)
    if len(contexts):
        totals = np.add.reduceat(counts, first)
        types = np.diff(np.r_[first, len(keys)])
        shard = _by_word(contexts, shards)
        for n in np.unique(shard).tolist():
            own = shard == n
            pack = lambda x: squeeze(x[own].astype("<u4").tobytes())  # noqa: B023, E731
            add(None, n, None, _pack_keys(contexts[own]), pack(totals), pack(types))
    trie.file.file.close()
    del trie, keys, counts
    give_back()
    return _table(out, ANSWERED)


def _table(columns: dict, schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.Table.from_pydict(columns, schema=pa.schema([(n, kinds[k]) for n, k in fields]))


def _word_shard(asked: pa.Table, stats: pa.Table) -> pa.Table:
    keys, counts = _summed(asked) if asked.num_rows else (np.empty(0, np.uint64), np.empty(0, np.int64))
    file = File()
    level = Monotone(keys, 1 << 64, file)
    contexts = [_unpack_keys(x.as_py()) for x in stats.column("contexts")]
    contexts = np.concatenate(contexts) if contexts else np.empty(0, np.uint64)
    names, place = np.unique(contexts, return_inverse=True)

    def add_up(column: str) -> np.ndarray:
        parts = [_counts(x.as_py()) for x in stats.column(column)]
        out = np.zeros(len(names) + 1, np.int64)
        np.add.at(out, place, np.concatenate(parts) if parts else np.empty(0, np.int64))
        return out

    totals, types = add_up("totals"), add_up("types")
    known = Monotone(names, 1 << 32, file)
    counts = np.r_[counts, 0]
    out = {name: [] for name in ("block", "shard", "counts", "totals", "types", "tokens", "distinct")}
    for i, row in enumerate(asked.select(["shard", "block", "keys"]).to_pylist()):
        sought = _unpack_keys(row["keys"])
        of = known.find(sought >> np.uint64(32))
        pack = lambda x: squeeze(x.astype("<u4").tobytes())
        values = (row["block"], row["shard"], pack(counts[level.find(sought)]), pack(totals[of]), pack(types[of]))
        # The shard's own sums go with its first row.
        sums = (int(counts.sum()), len(keys)) if i == 0 else (0, 0)
        for column, value in zip(out.values(), (*values, *sums)):
            column.append(value)
    file.file.close()
    give_back()
    return _table(out, WORDS)


def _score(
    blocks: pa.Table, words: pa.Table, answers: pa.Table, shards: int, tokens: int, distinct: int, discount: float
) -> Iterator[dict]:
    for row in blocks.to_pylist():
        block = _Block(row)
        parts = sorted(words.to_pylist(), key=lambda r: r["shard"])
        order = _ordered(block.hashes, _by_word(block.hashes >> np.uint64(32), shards))

        def of_word(name: str, order=order, parts=parts, block=block) -> np.ndarray:
            out = np.empty(len(block.hashes), np.int64)
            out[order] = np.concatenate([_counts(p[name]) for p in parts])
            return out

        count, total, types = of_word("counts"), of_word("totals"), of_word("types")
        parts = sorted(answers.to_pylist(), key=lambda r: r["shard"])
        codes = np.empty(len(block.keys), np.uint16)
        if len(codes):
            order = _ordered(block.keys, _by_bigram(block.keys, shards))
            codes[order] = np.concatenate([np.frombuffer(unsqueeze(p["codes"]), np.uint16) for p in parts])
        single = (count[block.tokens] + 0.5) / (tokens + 0.5 * (distinct + 1))
        given, kinds = total[block.before], types[block.before]
        shared = restored(codes)[block.place] + discount * kinds * single
        p = np.where(given > 0, shared / np.maximum(given, 1), single)
        of = np.repeat(np.arange(len(block.sizes)), block.sizes)
        add_up = lambda x, of=of, n=len(block.sizes): np.bincount(of, x, minlength=n)
        base, full = add_up(np.log10(single)), add_up(np.log10(p))
        seen = add_up((count[block.tokens] > 0).astype(np.float64)).astype(np.int64)
        for i, (key, flag) in enumerate(zip(row["ids"], row["flags"])):
            yield {
                "id": key,
                "held_out": flag is not True,
                "n_tokens": int(block.sizes[i]),
                "n_known": int(seen[i]),
                "base_score": float(base[i]),
                "score": float(full[i]),
            }
        give_back()


def lm_scores(
    df: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    discount: float = DISCOUNT,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per row: the key, ``held_out`` (``train`` is not true), ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score``, log10 probabilities of the whole text under the word and the bigram model of the training rows.

    Tokens are the A-Z lower-cased words (separated by ASCII white space) and one end; a NULL or empty text is an
    end alone. Equal rows are each counted and scored. Without training rows both models give every token
    the probability 1. Other columns are not read. Counts up to 2**32 are exact, quantised ones within 0.06 %.
    """
    stage = Staging(df.sparkSession, "lm")
    blocks = stage.table(packed(df, key, text, split, flag=train), "blocks").drop("marks", "name")
    volume = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0
    shards = int(max(df.sparkSession.sparkContext.defaultParallelism, volume // shard_bytes))

    def bigram_shard(asked: pa.Table) -> pa.Table:
        return _bigram_shard(asked, shards, discount)

    asked = blocks.mapInArrow(partial(_ask, shards=shards, bigrams=True), ASKED)
    answered = stage.table(asked.groupBy("shard").applyInArrow(bigram_shard, ANSWERED), "bigrams")
    stats = answered.where("block IS NULL").select("shard", "contexts", "totals", "types")
    asked = blocks.mapInArrow(partial(_ask, shards=shards, bigrams=False), ASKED)
    words = stage.table(
        asked.groupBy("shard").cogroup(stats.groupBy("shard")).applyInArrow(_word_shard, WORDS), "words"
    )
    sums = words.agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct = int(sums[0] or 0), int(sums[1] or 0)

    def score(packed_: pa.Table, both: pa.Table) -> pa.Table:
        of_words = both.filter(pa.compute.is_null(both.column("codes")))
        of_bigrams = both.filter(pa.compute.is_valid(both.column("codes")))
        rows = list(_score(packed_, of_words, of_bigrams, shards, tokens, distinct, discount))
        names = [f.split()[0] for f in SCORED.split(", ")]
        return pa.table({n: pa.array([r[n] for r in rows], KINDS[n]) for n in names})

    none = F.lit(None).cast("binary")
    both = words.select("block", "shard", "counts", "totals", "types", none.alias("codes")).unionByName(
        answered.where("block IS NOT NULL").select("block", "shard", "codes"), allowMissingColumns=True
    )
    scored = blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(score, SCORED)
    out = scored.withColumnRenamed("id", key).withColumn("train_tokens", F.lit(tokens).cast("long"))
    return stage.result(out)


KINDS = {
    "id": pa.int64(),
    "held_out": pa.bool_(),
    "n_tokens": pa.int64(),
    "n_known": pa.int64(),
    "base_score": pa.float64(),
    "score": pa.float64(),
}
