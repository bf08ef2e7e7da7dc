"""Byte-level BPE by a global shuffle of distinct words.

Documents are cut into pre-tokens, which are exploded with their positions and packed by block. Each distinct
pre-token goes to the bucket of its hash, is encoded there once, and its ids go back to the blocks that asked.
A block then puts the ids in place by position. Decoding joins the ids with the vocabulary's token-byte table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.llm.blocks import packed
from aforo.llm.common import give_back, pack_ints, pack_strings, unpack_ints, unpack_strings, tidied

# Text whose distinct words one bucket takes.
BUCKET_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
FINE = 1 << 16

ENCODED = "id long, n_tokens long, ids binary, decoded binary"
DIGESTED = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
REQUEST = "bucket int, block long, name long, words binary"
RESPONSE = "block long, name long, bucket int, sizes binary, ids binary"


class Ranks(dict):
    """Token bytes and ids of a rank file, which travels with the tasks compressed.

    A vocabulary has a fixed size, so tasks may carry it whole; encoder and token-byte table are made once in each task.
    """

    def __reduce__(self):
        tokens = list(self)
        return Ranks._loaded, (pack_strings(tokens), pack_ints(np.array([self[t] for t in tokens], np.uint32)))

    @classmethod
    def _loaded(cls, tokens: bytes, ids: bytes) -> Ranks:
        return cls(zip(unpack_strings(tokens), unpack_ints(ids).tolist()))

    def encoder(self, pattern: str) -> tiktoken.Encoding:
        made = self.__dict__.setdefault("encoders", {})
        if pattern not in made:
            made[pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self, special_tokens={})
        return made[pattern]

    @cached_property
    def pieces(self) -> list[bytes]:
        """The bytes of every id."""
        out = [b""] * (max(self.values(), default=-1) + 1)
        for token, i in self.items():
            out[i] = token
        return out

    @cached_property
    def names(self) -> list[str]:
        return [str(i) for i in range(len(self.pieces))]


def read_ranks(path: str) -> Ranks:
    """The rank file's token bytes and ids."""
    with open(path, "rb") as lines:
        return Ranks((base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, lines))


def _marks(words: list[bytes]) -> bytes:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return (hashes % np.uint64(FINE)).astype(np.uint16).tobytes()


def _grouped(marks: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's words in the order of their buckets, and the bucket of each."""
    bucket = np.frombuffer(marks, np.uint16).astype(np.int64) * buckets // FINE
    placed = np.argsort(bucket, kind="stable")
    return placed, bucket[placed]


@tidied
def _requests(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = unpack_strings(row["vocabulary"])
            placed, bucket = _grouped(row["marks"], buckets)
            cuts = (np.flatnonzero(np.diff(bucket)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(words)]):
                if b > a:
                    asked = pack_strings([words[i] for i in placed[a:b].tolist()])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([int(bucket[a])], pa.int32()),
                            "block": [row["block"]],
                            "name": [row["name"]],
                            "words": pa.array([asked], pa.binary()),
                        }
                    )


def _encode(table: pa.Table, ranks: Ranks, pattern: str) -> pa.Table:
    """All requests of a bucket: each distinct word is encoded once."""
    encoding = ranks.encoder(pattern)
    known: dict[bytes, list[int]] = {}
    out = {"block": [], "name": [], "bucket": [], "sizes": [], "ids": []}
    for row in _each(table):
        ids, sizes = [], []
        for word in unpack_strings(row["words"]):
            got = known.get(word)
            if got is None:
                got = known[word] = encoding._encode_single_piece(word)
            ids.extend(got)
            sizes.append(len(got))
        out["block"].append(row["block"])
        out["name"].append(row["name"])
        out["bucket"].append(row["bucket"])
        out["sizes"].append(pack_ints(np.array(sizes, np.uint32)))
        out["ids"].append(pack_ints(np.array(ids, np.uint32)))
    return pa.Table.from_pydict(
        out,
        schema=pa.schema(
            [
                ("block", pa.int64()),
                ("name", pa.int64()),
                ("bucket", pa.int32()),
                ("sizes", pa.binary()),
                ("ids", pa.binary()),
            ]
        ),
    )


def _each(table: pa.Table) -> Iterator[dict]:
    """The rows one by one: a group's compressed values are not all copied at once."""
    for i in range(table.num_rows):
        yield table.slice(i, 1).to_pylist()[0]


def _documents(blocks: pa.Table, answers: pa.Table, buckets: int) -> Iterator[tuple]:
    """(key, ids of the whole text) of each document of a block, in its order."""
    answers = answers.sort_by("bucket")
    sizes = [unpack_ints(b) for b in answers.column("sizes").to_pylist()]
    sizes = np.concatenate(sizes).astype(np.int64) if sizes else np.empty(0, np.int64)
    ids = [unpack_ints(b) for b in answers.column("ids").to_pylist()]
    ids = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    starts = np.cumsum(sizes) - sizes
    for row in _each(blocks):
        placed, _ = _grouped(row["marks"], buckets)
        answer = np.empty(len(placed), np.int64)
        if len(sizes) != len(placed):
            raise ValueError("the input changed between two reads; stage it as a table first")
        answer[placed] = np.arange(len(placed))
        sequence, at = answer[unpack_ints(row["sequence"])], 0
        for key, count in zip(row["ids"], unpack_ints(row["sizes"]).tolist()):
            words = sequence[at : at + count]
            at += count
            n = sizes[words]
            before = np.cumsum(n) - n
            total = int(n.sum())
            # Position by position: the word's first id, then the ids that follow it.
            yield key, ids[np.repeat(starts[words] - before, n) + np.arange(total)]


def _reassemble(blocks: pa.Table, answers: pa.Table, buckets: int, ranks: Ranks, digest: bool) -> pa.Table:
    pieces, names = ranks.pieces, ranks.names
    keys, counts, left, right = [], [], [], []
    for key, ids in _documents(blocks, answers, buckets):
        listed = ids.tolist()
        decoded = b"".join([pieces[i] for i in listed])
        keys.append(key)
        counts.append(len(listed))
        if digest:
            text = " ".join([names[i] for i in listed]).encode()
            left.append(hashlib.sha256(text).hexdigest())
            right.append(hashlib.sha256(decoded).hexdigest())
        else:
            left.append(pack_ints(ids))
            right.append(decoded)
    give_back()
    kind = pa.string() if digest else pa.binary()
    names_out = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")
    return pa.table(
        {
            "id": pa.array(keys, pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()),
            names_out[0]: pa.array(left, kind),
            names_out[1]: pa.array(right, kind),
        }
    )


def encode(
    df: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    digest: bool = False,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per input row: the key, ``n_tokens``, the ids (``common.unpack_ints`` reads them) and the
    bytes they decode to; with ``digest`` the SHA-256 of the decimal ids joined by a space and of those bytes.

    A NULL or empty text has no tokens. Repeated rows and keys, NULL keys among them, each give a row.
    Other columns are not read. An empty input gives no rows. The input is read twice, once for the distinct
    words and once for their positions, and must be a stable table; blocks that differ are noticed and raise.
    """
    compiled = regex.compile(pattern)

    def split(raw: bytes) -> list[str]:
        return compiled.findall(raw.decode("utf-8", "replace"))

    ranks = ranks if isinstance(ranks, Ranks) else Ranks(ranks)
    blocks = packed(df, key, text, split, str.encode, _marks, block_bytes=BLOCK_BYTES)
    volume = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0
    buckets = int(min(FINE, max(df.sparkSession.sparkContext.defaultParallelism, volume // bucket_bytes)))
    requests = blocks.select("block", "name", "vocabulary", "marks").mapInArrow(
        partial(_requests, buckets=buckets), REQUEST
    )

    def encode_bucket(requested: pa.Table) -> pa.Table:
        out = _encode(requested, ranks, pattern)
        give_back()
        return out

    answers = requests.groupBy("bucket").applyInArrow(encode_bucket, RESPONSE)
    def reassemble(asked: pa.Table, answered: pa.Table) -> pa.Table:
        return _reassemble(asked, answered, buckets, ranks, digest)

    out = (
        blocks.select("block", "name", "ids", "sizes", "marks", "sequence")
        .groupBy("block", "name")
        .cogroup(answers.groupBy("block", "name"))
        .applyInArrow(reassemble, DIGESTED if digest else ENCODED)
    )
    return out.withColumnRenamed("id", key)
