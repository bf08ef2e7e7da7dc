"""BPE of a tokenizer file with reuse of content-defined chunks.

A rolling hash over bytes cuts every text where its content says so, hence shared passages give equal chunks in all
documents. The chunks are counted by digest; one that occurs in several blocks of documents is encoded by the first of
them only, and its ids are joined to the others. Chunks are encoded on their own, so their ids may be wrong around the
cuts: the text around each join is encoded again, from a stretch inside the left chunk to one inside the right, until the ids
of both stretches agree with those of the chunks. A join that does not agree swallows the chunks beside it, up to the whole text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aforo.llm.blocks import packed
from aforo.llm.common import Staging, give_back, pack_ints, pack_strings, squeeze, unpack_ints, unpack_strings, unsqueeze, tidied
from aforo.operators.joins import lookup_join

BLOCK_BYTES = 4 << 20
# Chunks: a cut where the hash of the last 2 ** WINDOW bytes ends in MASK's zeros, within these lengths.
WINDOW = 5
MASK = np.uint64(0x1FF << 40)
LEAST, MOST = 128, 8192
FACTOR = 0x9E3779B97F4A7C15
# A blank after a visible ASCII character begins a pre-token whatever stands further left: places to line up at.
BREAK = re.compile(rb"[!-~][ \n]")
# What byte-level tokenizer files split texts by.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LAST_BREAK = re.compile(rb"(?s).*[!-~][ \n]")

PART = (
    "kind int, block long, id long, n_tokens long, left binary, right binary, digest binary, ids binary, rest binary"
)
PART_ARROW = pa.schema(
    [("kind", pa.int32()), *[(c, pa.int64()) for c in ("block", "id", "n_tokens")],
     *[(c, pa.binary()) for c in ("left", "right", "digest", "ids", "rest")]]
)
DOCUMENT, SHARED, WAITING = 0, 1, 2


def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 characters for
    themselves, the other bytes in turn for the characters from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """A tokenizer file that travels with the tasks compressed and is loaded once in each task.

    The file must hold a byte-level BPE with its usual splitting pattern, without a normaliser and with added
    tokens that hold no blanks: the places where texts may be cut follow from these.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            content = file.read()
        parts = json.loads(content)
        first, last = (parts.get(p) or {} for p in ("pre_tokenizer", "decoder"))
        byte_level = first.get("type") == last.get("type") == "ByteLevel"
        plain = byte_level and first.get("use_regex") and not first.get("add_prefix_space") and not parts.get("normalizer")
        loose = [t for t in parts["added_tokens"] if set(t["content"]) & set(" \t\r\n") or t["lstrip"] or t["rstrip"] or t["single_word"]]
        if parts["model"]["type"] != "BPE" or not plain or loose:
            raise ValueError(f"{path} is no plain byte-level BPE")
        self.file = squeeze(content)
        self.same_merges = same_merges(self.tokenizer, parts)

    def __getstate__(self) -> dict:
        return {"file": self.file, "same_merges": self.same_merges}

    @cached_property
    def tokenizer(self) -> Tokenizer:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel unit
        loaded = Tokenizer.from_str(unsqueeze(self.file).decode())
        loaded.no_padding()
        loaded.no_truncation()
        return loaded

    @cached_property
    def pieces(self) -> list[bytes]:
        """The bytes of every id."""
        values, added = _byte_values(), self.tokenizer.get_added_tokens_decoder()
        out = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            out[i] = added[i].content.encode() if i in added else bytes(values[c] for c in token)
        return out

    @cached_property
    def names(self) -> list[str]:
        return [str(i) for i in range(len(self.pieces))]

    @cached_property
    def quick(self) -> tiktoken.Encoding:
        """A faster encoder with the same ids on plain text, where ``same_merges`` holds."""
        special = set(self.tokenizer.get_added_tokens_decoder())
        ranks = {piece: i for i, piece in enumerate(self.pieces) if piece and i not in special}
        return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def unplain(self) -> re.Pattern:
        """What keeps a text from the quicker encoder: an added token, or a character beyond the Latin blocks, whose
        class may differ between versions of Unicode."""
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        return re.compile("|".join(["[^\x00-\u024f]", *added]))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts, four bytes each."""
        decoded = [t.decode() for t in texts]
        out = [b""] * len(texts)
        slow = [i for i, t in enumerate(decoded) if not self.same_merges or self.unplain.search(t)]
        found = self.tokenizer.encode_batch_fast([decoded[i] for i in slow], add_special_tokens=False)
        for i, e in zip(slow, found):
            out[i] = array("I", e.ids).tobytes()
        if len(slow) < len(texts):
            left = set(slow)
            for i, t in enumerate(decoded):
                if i not in left:
                    out[i] = array("I", self.quick.encode_ordinary(t)).tobytes()
        return out


def same_merges(tokenizer: Tokenizer, parts: dict) -> bool:
    """True when merging the pair whose union has the least id is the same as following the file's list of merges.

    It is if ids rise along the list and every token's own text is encoded as that token. Then a pair whose union is a token but
    which is not listed never is the next to merge: all lesser merges inside it are done by then, and they
    have led to the listed pair.
    """
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in pairs]
    letters = [i for token, i in vocabulary.items() if len(token) == 1]
    rising = all(a < b for a, b in zip([max(letters, default=-1), *made], made))
    whole = set(letters) | set(made) == set(vocabulary.values()) and len(letters) == 256
    model = tokenizer.model
    return rising and whole and all([t.id for t in model.tokenize(token)] == [i] for token, i in vocabulary.items())


def chunks(raw: bytes) -> list[bytes]:
    """The text's chunks: valid UTF-8, together the text."""
    raw = raw.decode("utf-8", "replace").encode()
    if len(raw) <= LEAST:
        return [raw] if raw else []
    data = np.frombuffer(raw, np.uint8)
    rolled = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    factor = FACTOR
    for k in range(WINDOW):
        # After this step the hash at i covers the 2 ** (k + 1) bytes up to i.
        step = 1 << k
        rolled[step:] = rolled[step:] + rolled[:-step] * np.uint64(factor)
        factor = factor * factor % (1 << 64)
    marks = np.flatnonzero((rolled & MASK) == 0) + 1
    out, start = [], 0
    for mark in [*marks.tolist(), len(raw)]:
        if mark != len(raw) and mark - start < LEAST:
            continue
        while start < mark:
            end = mark if mark - start <= MOST else start + MOST
            while end < len(raw) and raw[end] & 0xC0 == 0x80:
                end += 1
            out.append(raw[start:end])
            start = end
    return out


def _digest(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _token_at(ids: memoryview, pieces: list[bytes], offset: int, size: int) -> int | None:
    """The token that begins ``offset`` bytes into ``size``; None where none does."""
    if offset * 2 <= size:
        at, place = 0, 0
        while place < offset:
            place += len(pieces[ids[at]])
            at += 1
    else:
        at, place = len(ids), size
        while place > offset:
            at -= 1
            place -= len(pieces[ids[at]])
    return at if place == offset else None


class _Chunk:
    """A chunk's ids, four bytes each, and the places where it lines up with what is encoded around it.

    ``head`` is the first stretch between two breaks, ``tail`` the last, each as (offset in the text, offset in the text,
    offset in the ids, offset in the ids); None where the chunk has no room for both.
    """

    def __init__(self, text: bytes, ids: bytes, pieces: list[bytes]):
        self.text, self.ids, self.head, self.tail = text, ids, None, None
        first = BREAK.search(text)
        second = BREAK.search(text, first.end()) if first else None
        last = LAST_BREAK.match(text)
        before = LAST_BREAK.match(text, 0, last.end() - 1) if last else None
        if not second or not before or second.end() > before.end():
            return
        offsets, numbers = [m.end() - 1 for m in (first, second, before, last)], memoryview(ids).cast("I")
        tokens = [_token_at(numbers, pieces, o, len(text)) for o in offsets]
        if None not in tokens:
            a, b, c, d = (4 * t for t in tokens)
            self.head, self.tail = (*offsets[:2], a, b), (*offsets[2:], c, d)


def _joined(document: list[_Chunk], whole: set[int]) -> list[tuple]:
    """What a document is put together from: (ids, None) for reused ids, and for a join (text, (ids it must begin with,
    ids it must end with, the chunks these are of)). ``whole`` chunks are not reused."""
    out, text, left, giver = [], b"", b"", None
    final = len(document) - 1
    for i, chunk in enumerate(document):
        if i in whole or (chunk.head is None and final):
            text += chunk.text
            continue
        start, stop = 0, len(chunk.ids)
        if i:
            _, end, first, start = chunk.head
            out.append((text + chunk.text[:end], (left, chunk.ids[first:start], {giver, i})))
            text, left, giver = b"", b"", None
        if i < final:
            begin, _, stop, last = chunk.tail
            text, left, giver = chunk.text[begin:], chunk.ids[stop:last], i
        out.append((chunk.ids[start:stop], None))
    if text:
        out.append((text, (left, b"", {giver})))
    return out


def _agrees(ids: bytes, left: bytes, right: bytes) -> bool:
    return len(ids) >= len(left) + len(right) and ids.startswith(left) and ids.endswith(right)


def assembled(documents: list[list[_Chunk]], codec: Codec) -> Iterator[bytes]:
    """The ids of each document, joins encoded together and again where they do not agree."""
    known: dict[bytes, bytes] = {}
    plans = [_joined(d, set()) for d in documents]
    whole: list[set[int]] = [set() for _ in documents]
    open_ = range(len(documents))
    while open_:
        asked = list({p[0]: None for i in open_ for p in plans[i] if p[1] and p[0] not in known})
        known.update(zip(asked, codec.encode(asked)))
        again = []
        for i in open_:
            failed = [p[1][2] for p in plans[i] if p[1] and not _agrees(known[p[0]], *p[1][:2])]
            if failed:
                # The chunks on both sides of the join are encoded along with it.
                whole[i] = whole[i].union(*failed)
                plans[i] = _joined(documents[i], whole[i])
                again.append(i)
        open_ = again
    for plan in plans:
        yield b"".join([known[part] if join else part for part, join in plan])


def _rows(keys: list, documents: list[list[int]], texts: list[bytes], known: dict[int, bytes], codec: Codec,
          digest: bool) -> Iterator[tuple]:
    """(key, number of tokens, ids or their digest, text or its digest); ``known`` are ids from elsewhere."""
    used = sorted({n for d in documents for n in d})
    missing = [n for n in used if n not in known]
    ids = dict(zip(missing, codec.encode([texts[n] for n in missing]))) | known
    pieces, names = codec.pieces, codec.names
    made = {n: _Chunk(texts[n], ids[n], pieces) for n in used}
    for key, found in zip(keys, assembled([[made[n] for n in d] for d in documents], codec)):
        listed = memoryview(found).cast("I").tolist()
        decoded = b"".join([pieces[i] for i in listed]).decode("utf-8", "replace").encode()
        if digest:
            told = ",".join([names[i] for i in listed]).encode()
            yield key, len(listed), hashlib.sha256(told).hexdigest().encode(), hashlib.sha256(decoded).hexdigest().encode()
        else:
            yield key, len(listed), pack_ints(np.array(listed, np.uint32)), decoded


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(PART_ARROW)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, PART_ARROW)], schema=PART_ARROW)


@tidied
def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, vocabulary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            digests = [_digest(c) for c in unpack_strings(vocabulary)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(digests), pa.int64()), pa.array(digests, pa.binary())], names=["block", "digest"]
            )


def _split(sequence: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    return [s.tolist() for s in np.split(sequence, np.cumsum(sizes, dtype=np.int64)[:-1])] if len(sizes) else []


def _first_pass(blocks: pa.Table, shared: pa.Table, codec: Codec, digest: bool) -> pa.Table:
    """A block's own shared chunks, its documents without chunks shared with other blocks, and the others packed again."""
    owner = dict(zip(shared.column("digest").to_pylist(), shared.column("own").to_pylist()))
    out = []
    for row in blocks.to_pylist():
        texts = unpack_strings(row["vocabulary"])
        documents = _split(unpack_ints(row["sequence"]), unpack_ints(row["sizes"]))
        named = {n: _digest(t) for n, t in enumerate(texts)} if owner else {}
        common = {n for n, d in named.items() if d in owner}
        own = [n for n in sorted(common) if owner[named[n]]]
        for n, ids in zip(own, codec.encode([texts[n] for n in own])):
            out.append((SHARED, row["block"], None, None, None, None, named[n], pack_ints(np.frombuffer(ids, np.uint32)), None))
        ready = [i for i, d in enumerate(documents) if common.isdisjoint(d)]
        keys = [row["ids"][i] for i in ready]
        for key, n, left, right in _rows(keys, [documents[i] for i in ready], texts, {}, codec, digest):
            out.append((DOCUMENT, row["block"], key, n, left, right, None, None, None))
        waiting = sorted(set(range(len(documents))) - set(ready))
        if waiting:
            out.append((WAITING, row["block"], None, None, None, None, None, None, _packed_again(row, documents, waiting, texts)))
    give_back()
    return _table(out)


def _packed_again(row: dict, documents: list[list[int]], waiting: list[int], texts: list[bytes]) -> bytes:
    """Some documents of a block in one value: keys, sizes, chunk numbers and the chunks they use."""
    used = sorted({n for i in waiting for n in documents[i]})
    place = {n: p for p, n in enumerate(used)}
    sequence = np.array([place[n] for i in waiting for n in documents[i]], np.uint32)
    sizes = np.array([len(documents[i]) for i in waiting], np.uint32)
    keys = json.dumps([row["ids"][i] for i in waiting]).encode()
    return pack_strings([keys, pack_ints(sizes), pack_ints(sequence), *[texts[n] for n in used]])


def _second_pass(waiting: pa.Table, answers: pa.Table, codec: Codec, digest: bool) -> pa.Table:
    """The documents that waited, with the ids of their shared chunks."""
    found = dict(zip(answers.column("digest").to_pylist(), answers.column("ids").to_pylist()))
    out = []
    for block, rest in zip(waiting.column("block").to_pylist(), waiting.column("rest").to_pylist()):
        keys, sizes, sequence, *texts = unpack_strings(rest)
        documents = _split(unpack_ints(sequence), unpack_ints(sizes))
        named = ((n, found.get(_digest(t))) for n, t in enumerate(texts))
        known = {n: unpack_ints(ids).tobytes() for n, ids in named if ids is not None}
        for key, n, left, right in _rows(json.loads(keys), documents, texts, known, codec, digest):
            out.append((DOCUMENT, block, key, n, left, right, None, None, None))
    give_back()
    return _table(out)


def encode(df: DataFrame, codec: Codec, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One row per input row: the key, ``n_tokens``, the ids (``common.unpack_ints`` reads them) and the bytes of the
    text they decode to; with ``digest`` the SHA-256 of the decimal ids joined by commas and of those bytes.

    Ids are those of the tokenizer file on the whole text without added special tokens; special tokens that a text spells
    out keep their ids. A NULL or empty text has no tokens. Repeated rows and keys, NULL keys among them, each give a
    row. Other columns are not read. An empty input gives no rows. The input is read twice; a change between the reads
    costs reuse only.
    """
    stage = Staging(df.sparkSession, "chunks")
    blocks = packed(df, key, text, chunks, block_bytes=BLOCK_BYTES)
    pairs = stage.table(blocks.select("block", "vocabulary").mapInArrow(_pairs, "block long, digest binary"), "pairs")
    common = pairs.groupBy("digest").agg(F.min("block").alias("owner"), F.count("*").alias("n")).where("n > 1")
    common = stage.table(common.select("digest", "owner"), "common")
    # A chunk that most blocks hold is a hot key here; both sides are staged, so its partition can be split.
    shared = lookup_join(pairs, common, [("digest", "digest")], "inner")
    shared = stage.table(shared.select("block", "digest", (F.col("owner") == F.col("block")).alias("own")), "shared")

    def first(asked: pa.Table, listed: pa.Table) -> pa.Table:
        return _first_pass(asked, listed, codec, digest)

    def second(asked: pa.Table, answered: pa.Table) -> pa.Table:
        return _second_pass(asked, answered, codec, digest)

    parts = (
        blocks.select("block", "ids", "sizes", "vocabulary", "sequence").groupBy("block")
        .cogroup(shared.groupBy("block")).applyInArrow(first, PART)
    )
    parts = stage.table(parts, "parts")
    answers = parts.where(F.col("kind") == SHARED).select("digest", "ids")
    answers = lookup_join(shared.select("block", "digest"), answers, [("digest", "digest")], "inner")
    waiting = parts.where(F.col("kind") == WAITING).select("block", "rest")
    late = waiting.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(second, PART)
    done = parts.where(F.col("kind") == DOCUMENT).unionByName(late)
    names, kind = (("ids_sha256", "decoded_sha256"), "string") if digest else (("ids", "decoded"), "binary")
    return stage.result(
        done.select(
            F.col("id").alias(key), "n_tokens", F.col("left").cast(kind).alias(names[0]), F.col("right").cast(kind).alias(names[1])
        )
    )
