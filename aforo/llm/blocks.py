"""Documents packed into blocks: one row holds many documents, their distinct words once, and word positions.

A block is what one task has read until a bound of bytes is reached (one longer document makes a longer block).
Shuffles then carry a few large rows of compressed arrays instead of one row per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import give_back, id_and_text, pack_ints, pack_strings, tidied

BLOCK_BYTES = 8 << 20
SCHEMA = (
    "block long, name long, ids array<long>, sizes binary, vocabulary binary, marks binary, sequence binary, flags array<boolean>"
)
ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("name", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("sizes", pa.binary()),
        ("vocabulary", pa.binary()),
        ("marks", pa.binary()),
        ("sequence", pa.binary()),
        ("flags", pa.list_(pa.bool_())),
    ]
)


class _Numbers(dict):
    """Word -> its number, in the order of first appearance."""

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        return number


class _Block:
    def __init__(self) -> None:
        self.ids, self.sizes, self.flags, self.sequence, self.bytes = [], [], [], [], 0
        self.vocabulary = _Numbers()

    def add(self, key: int | None, words: list, size: int, flag: bool | None = None) -> None:
        self.ids.append(key)
        self.flags.append(flag)
        self.sizes.append(len(words))
        self.sequence.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.uint32, len(words)))
        self.bytes += size

    def row(self, number: int, as_bytes: Callable, mark: Callable | None) -> pa.RecordBatch:
        words = list(map(as_bytes, self.vocabulary))
        sequence = np.concatenate(self.sequence)
        counts = np.bincount(sequence, minlength=len(words))
        # Frequent words first, so that their numbers are small.
        placed = np.argsort(-counts, kind="stable")
        words = [words[i] for i in placed.tolist()]
        rank = np.empty(len(words), np.uint32)
        rank[placed] = np.arange(len(words), dtype=np.uint32)
        vocabulary, sequence = pack_strings(words), pack_ints(rank[sequence])
        row = {
            "block": number,
            # Tells this block from one with the same number that another run of the plan made differently.
            "name": xxhash.xxh3_64_intdigest(vocabulary + sequence) >> 1,
            "ids": self.ids,
            "sizes": pack_ints(np.array(self.sizes, np.uint32)),
            "vocabulary": vocabulary,
            "marks": mark(words) if mark else None,
            "sequence": sequence,
            "flags": self.flags,
        }
        return pa.RecordBatch.from_pylist([row], schema=ARROW)


def packed(
    df: DataFrame,
    key: str,
    text: str,
    split: Callable[[bytes], list],
    as_bytes: Callable = bytes,
    mark: Callable[[list[bytes]], bytes] | None = None,
    flag: Column | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per block. ``split`` makes a text's words, ``as_bytes`` a word's bytes, ``mark`` one
    more array about the block's words. A NULL text is split like an empty one. ``flag`` goes along with each document.

    Block numbers follow the input's partitions, so a stable table gives the same blocks whenever they are made;
    ``name`` is a hash of what a block holds.
    """

    @tidied
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        block = _Block()
        for batch in batches:
            for key_, value, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = value.as_py() or b""
                block.add(key_, split(raw), len(raw), own)
                if block.bytes >= block_bytes:
                    made, block = block.row(number, as_bytes, mark), _Block()
                    give_back()
                    yield made
                    number += 1
        if block.ids:
            made, block = block.row(number, as_bytes, mark), None
            give_back()
            yield made

    own = F.lit(None).cast("boolean") if flag is None else flag
    return id_and_text(df, key, text, own.alias("flag")).mapInArrow(pack, SCHEMA)
