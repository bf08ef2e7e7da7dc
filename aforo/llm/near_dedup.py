"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A sketch has a fixed number of coordinates. In each round every shingle is hashed to one coordinate; a coordinate
keeps the least value of the first round that reached it, and later rounds aim at one coordinate each, so all
fill after at most twice as many rounds as coordinates and the share of equal coordinates concentrates around
the Jaccard similarity. Equal bands of coordinates make candidates; links are confirmed on the full sets.

Documents with equal sets are one node. Each node is first verified against one pivot, the least member of its largest
bucket, which joins most of a family into one component. Then only members of different components meet, in the first
bucket they share, dealt to tasks of bounded size: pairs whose sketches allow it are verified there, most similar first, until
their components are one. A task hands on the links that joined two components and no other pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import Staging, WordHashes, id_and_text, mixed, squeeze, text_md5, tidied, unsqueeze, windows
from aforo.llm.components import components
from aforo.operators.joins import lookup_join

WORDS = 5
PERCENT = 75
COORDINATES = 128
ROWS = 4
# Sketches with a lower share of equal coordinates are not verified: over four standard deviations below 0.75.
SHARE = 0.59
SLOT = 1024
# Shingles that a task holds unpacked.
HELD = 4_000_000
VALUE = np.uint64((1 << 54) - 1)
EMPTY = np.uint64((1 << 64) - 1)
SIGNED = "id long, n long, node binary, bands binary, sketch binary, text_md5 string"


def shingles(raw: bytes | None, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """Distinct hashes of the text's runs of ``size`` words, sorted; a shorter text is one run."""
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(hashes.of(words), min(size, len(words))))


def sketch(elements: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes."""
    out = np.full(COORDINATES, EMPTY)
    for turn in range(2 * COORDINATES):
        h = mixed(elements + np.uint64((turn + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
        value = (np.uint64(turn) << np.uint64(54)) | (h & VALUE)
        if turn < COORDINATES:
            np.minimum.at(out, (h >> np.uint64(57)).astype(np.int64), value)
        else:
            at = turn - COORDINATES
            out[at] = min(out[at], value.min())
        if (out != EMPTY).all():
            break
    return out


def _name(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


@tidied
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, nodes, bands, sketches = [], [], [], []
        for value in batch.column(1):
            found = shingles(value.as_py(), hashes)
            sizes.append(len(found))
            if not len(found):
                nodes.append(None), bands.append(None), sketches.append(None)
                continue
            full = sketch(found)
            key = windows(full, ROWS)[::ROWS] + np.arange(0, COORDINATES, ROWS, dtype=np.uint64)
            nodes.append(_name(found))
            bands.append(mixed(key).tobytes())
            sketches.append(mixed(full).astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(nodes, pa.binary()),
                pa.array(bands, pa.binary()),
                pa.array(sketches, pa.binary()),
                batch.column(2),
            ],
            names=["id", "n", "node", "bands", "sketch", "text_md5"],
        )


@tidied
def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bands = [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
        if bands:
            nodes = batch.column(0).take(np.repeat(np.arange(len(bands)), [len(b) for b in bands]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(bands)), nodes], names=["bucket", "node"]
            )


@tidied
def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node and packed words of rows whose set is the node's."""
    hashes = WordHashes()
    for batch in batches:
        nodes, words = [], []
        for node, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = (value.as_py() or b"").lower()
            if _name(shingles(raw, hashes)) == node:
                nodes.append(node)
                words.append(squeeze(b" ".join(raw.split())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(words, pa.binary())], names=["node", "words"]
        )


@tidied
def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    hashes, last = WordHashes(), {}

    def of(node: bytes, words: bytes) -> np.ndarray:
        if node not in last:
            if len(last) >= 64:
                last.clear()
            last[node] = shingles(unsqueeze(words), hashes)
        return last[node]

    for batch in batches:
        linked = []
        for a, b, ta, tb in zip(*(batch.column(i).to_pylist() for i in range(4))):
            linked.append(similar(of(a, ta), of(b, tb), percent))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
        )


class _Sets:
    """The shingles of a task's members, unpacked when asked for and kept within a bound."""

    def __init__(self, words: list[bytes]):
        self.words, self.hashes, self.known, self.held = words, WordHashes(), {}, 0

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.known:
            if self.held > HELD:
                self.known.clear()
                self.held = 0
            self.known[i] = shingles(unsqueeze(self.words[i]), self.hashes)
            self.held += len(self.known[i])
        return self.known[i]


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """True when 100 * intersection >= ``percent`` * union of two sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _links(group: pa.Table, percent: int) -> pa.Table:
    """Links between members of slots x and y that join two components, as this task sees them."""
    rows, n = group.to_pydict(), group.num_rows
    bucket, x, y = rows["bucket"][0], rows["x"][0], rows["y"][0]
    slot, sets = np.array(rows["slot"]), _Sets(rows["words"])
    drawn = np.frombuffer(b"".join(rows["sketch"]), np.uint16).reshape(n, COORDINATES)
    # A pair is looked at in the first of the buckets it shares: these are a member's by band, 0 where there is none.
    bands = np.frombuffer(b"".join(rows["bands"]), np.int64).reshape(n, -1)
    kept = np.array([np.where(np.isin(b, k), b, 0) for b, k in zip(bands, rows["kept"])])
    number: dict[bytes, int] = {}
    part = np.array([number.setdefault(c, len(number)) for c in rows["part"]])
    left, right = np.flatnonzero(slot == x), np.flatnonzero(slot == y)
    a, b = [], []
    for i in left.tolist():
        others = right[part[right] != part[i]]
        if x == y:
            others = others[others < i]
        if not len(others):
            continue
        share = (drawn[others] == drawn[i]).mean(axis=1)
        near = others[share >= SHARE]
        near = near[np.argsort(-share[share >= SHARE], kind="stable")]
        shared = (kept[near] == kept[i]) & (kept[i] != 0)
        near = near[kept[i][shared.argmax(axis=1)] == bucket] if len(near) else near
        for j in near.tolist():
            if part[i] != part[j] and similar(sets[i], sets[j], percent):
                part[part == part[j]] = part[i]
                a.append(rows["node"][i])
                b.append(rows["node"][j])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _open_tasks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt to pairs of slots.

    The members of a bucket's largest component are never paired with each other.
    """
    placed = members.join(labels, "node", "left").withColumn("part", F.coalesce("label", "node"))
    parts = placed.groupBy("bucket", "part").agg(F.count("*").alias("size"))
    mains = (
        parts.groupBy("bucket")
        .agg(
            F.max(F.struct("size", "part")).alias("main"),
            F.sum("size").alias("all"),
            F.count("*").alias("parts"),
        )
        .where("parts > 1")
        .withColumn("minor_slots", F.ceil((F.col("all") - F.col("main.size")) / SLOT).cast("int"))
        .withColumn("main_slots", F.ceil(F.col("main.size") / SLOT).cast("int"))
        .select("bucket", F.col("main.part").alias("main"), "minor_slots", "main_slots")
    )
    spread = F.xxhash64("node")
    dealt = placed.join(mains, "bucket").withColumn(
        "slot",
        F.when(F.col("part") == F.col("main"), F.col("minor_slots") + F.pmod(spread, F.col("main_slots")))
        .otherwise(F.pmod(spread, F.col("minor_slots")))
        .cast("int"),
    )
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    slot, minor = F.col("slot"), F.col("minor_slots")
    up_to = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    as_right = F.transform(up_to(F.least(slot, minor)), lambda i: pair(i, slot))
    as_left = F.transform(
        up_to(F.when(slot < minor, minor + F.col("main_slots") - slot).otherwise(F.lit(0))),
        lambda i: pair(slot, slot + i),
    )
    return dealt.select("bucket", "node", "part", "slot", F.explode(F.concat(as_right, as_left)).alias("t")).select(
        "bucket", "node", "part", "slot", "t.x", "t.y"
    )


class NearDuplicates:
    """The nodes of a table and the links between them."""

    def __init__(self, df: DataFrame, key: str, text: str, percent: int):
        self.stage, self.percent = Staging(df.sparkSession, "near"), percent
        source = id_and_text(df, key, text, text_md5(text).alias("text_md5"))
        signed = self.stage.table(source.mapInArrow(_sign, SIGNED), "signed")
        self.documents = signed.select("id", "n", "node", "text_md5")
        # The first row of a node: the least key, NULL last, then the least digest.
        row = F.struct(F.col("id").isNull().alias("none"), "id", "text_md5")
        self.nodes = self.stage.table(
            signed.where("node IS NOT NULL")
            .groupBy("node")
            .agg(F.min(row).alias("least"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
            "nodes",
        )
        self.members = self.stage.table(self._members(), "members")
        asked = self.members.groupBy("node").agg(F.collect_list("bucket").alias("kept"))
        asked = self.stage.table(self.nodes.join(asked, "node").select("node", "least", "sketch", "bands", "kept"), "asked")
        self.known = asked.select("node", "sketch", "bands", "kept")
        # By key and digest, so that neither a repeated nor a NULL key brings its rows together with all nodes it has.
        rows = lookup_join(
            source.withColumn("k", F.struct("id")),
            asked.select("node", F.struct("least.id").alias("wanted"), F.col("least.text_md5").alias("digest")),
            [("k", "wanted"), ("text_md5", "digest")],
            "inner",
        )
        self.texts = self.stage.table(
            rows.select("node", "text").mapInArrow(_texts, "node binary, words binary").dropDuplicates(["node"]),
            "texts",
        )

    def _members(self) -> DataFrame:
        """(bucket, node) of buckets with several nodes; of buckets with the same nodes, one stays."""
        rows = self.nodes.select("node", "bands").mapInArrow(_spread, "bucket long, node binary")
        sums = rows.groupBy("bucket").agg(
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(20,0)")).alias("s"),
        )
        kept = sums.where("size > 1").groupBy("size", "x", "s").agg(F.min("bucket").alias("bucket"))
        return rows.join(self.stage.table(kept.select("bucket"), "buckets"), "bucket")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        texts = self.texts
        left = texts.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
        right = texts.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b")
        percent = self.percent
        return joined.mapInArrow(lambda it: _verify(it, percent), "a binary, b binary, linked boolean")

    def _pivots(self) -> DataFrame:
        """Each member with the least member of the largest of its buckets: one pair a node.

        Most copies of a family meet in one bucket, so these pairs leave few components of it for the rounds.
        """
        least = self.members.groupBy("bucket").agg(F.min("node").alias("b"), F.count("*").alias("size"))
        offers = self.members.join(least, "bucket").where("node != b")
        best = offers.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("size", "b")).alias("best"))
        return best.select("a", "best.b")

    def labels(self) -> DataFrame:
        """(node, label) of every linked node."""
        stage, percent = self.stage, self.percent
        links = stage.table(self._verified(self._pivots()).where("linked").select("a", "b"), "pivots")
        labels = components(links, stage)
        tasks = _open_tasks(self.members, labels).join(self.known, "node").join(self.texts, "node")

        def linked(group: pa.Table) -> pa.Table:
            return _links(group, percent)

        found = stage.table(tasks.groupBy("bucket", "x", "y").applyInArrow(linked, "a binary, b binary"), "links")
        return labels if found.isEmpty() else components(links.unionByName(found), stage)


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The columns of ``near_duplicates``, ``text_md5`` of the input text and ``first``.

    ``first`` holds for the least (key, digest) of each group, a NULL key last, and for rows without shingles. Rows
    of a repeated key and of NULL keys are told apart by their texts, so only rows equal in both are first together.
    """
    near = NearDuplicates(df, key, text, percent)
    labels = near.labels()
    nodes = near.nodes.select("node", "least")
    parts = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = near.stage.table(parts.groupBy("label").agg(F.min("least").alias("of")), "least")
    named = near.stage.table(parts.join(least, "label").select("node", "of"), "named")
    out = near.documents.join(named, "node", "left")
    alone = F.col("node").isNull()
    out = out.withColumn("component_id", F.when(alone, F.col("id")).otherwise(F.col("of.id")))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return near.stage.result(
        out.select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            "component_id",
            kept.alias("kept"),
            "text_md5",
            (alone | (kept & (F.col("text_md5") == F.col("of.text_md5")))).alias("first"),
        )
    )


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per row of ``df``: the key, ``n_shingles``, ``component_id`` (the least key it is linked to, over any number of
    links) and ``kept`` (the row has that key).

    Words are separated by ASCII white space and A-Z lower-cased; sets hold runs of five words. Two sets link
    when 100 * intersection >= ``percent`` * union. A NULL or empty text has no shingles and no links. Equal rows
    get equal results; a NULL key is greater than all others. Other columns are not read.
    """
    return groups(df, key, text, percent).drop("text_md5", "first")
