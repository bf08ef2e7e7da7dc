"""Trie of conversation prefixes: ternary search trees over numbered turns, one per range of sequences.

Every distinct turn (role, text) gets a number, and a conversation is its sequence of numbers, cut into segments of
bounded length. Equal segments after equal prefixes are one row with a count. The rows are sorted and dealt by range to
shards. A shard builds a ternary search tree, median first so that it is balanced, and one traversal without recursion
adds up members, leaves and savings. Nodes that a neighbouring shard may hold, too, are merged by key afterwards.

A node is named by its depth and two polynomial hashes of the numbers before it, modulo a prime of 61 bits. Sums of
that form can be added up over segments, so no task needs a whole conversation. Conversations longer than a segment
are chains of trees; the totals of lower trees reach the upper ones in a number of rounds that is logarithmic in the
length of the chain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aforo.llm.common import Staging, tidied
from aforo.operators.joins import lookup_join

SEGMENT = 64
SHARD_TURNS = 200_000
# Conversation ids of which one row of text holds a stretch.
STRETCH_BITS = 12
PRIME = (1 << 61) - 1
BASES = (1_152_921_504_606_846_883, 864_691_128_455_135_207)
OFFSETS = (612_489_549_322_387_457, 327_414_555_693_498_019)
NO_ENDS = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "k1", "k2"]


# Turns and their places


@tidied
def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, with this task's number and the row's place among the task's of a conversation."""
    part, last, before = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        local = np.arange(len(conv)) - np.repeat(starts, np.diff([*starts, len(conv)]))
        if conv[0] == last:
            local[: starts[1] if len(starts) > 1 else len(conv)] += before
        last, before = conv[-1], int(local[-1]) + 1
        columns = [*batch.columns, pa.array(np.full(len(conv), part, np.int32)), pa.array(local)]
        yield pa.RecordBatch.from_arrays(columns, names=["conv", "key", "bytes", "part", "local"])


def placed_turns(df: DataFrame, conv: str, turn: str, role: str, text: str, stage: Staging) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, id, bytes) of every turn and (conv, n) of every conversation.

    Rows are sorted by range, not by conversation, so a conversation with a third of all turns is spread over
    tasks; the places of its later parts are the sizes of the earlier ones further.
    """
    said, spoken = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, spoken).cast("binary")
    turns = df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        said.alias("role"),
        F.unhex(F.md5(told)).alias("key"),
        F.octet_length(spoken).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    turns = stage.table(turns, "turns")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key"), F.col("row")]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "key", "bytes")
    dealt = stage.table(dealt.mapInArrow(_numbered, "conv long, key binary, bytes long, part int, local long"), "dealt")
    spans = dealt.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A task goes on with one conversation of the task before it at most, so these are fewer rows than tasks.
    later = spans.withColumn("offset", F.sum("n").over(earlier)).where("offset > 0").select("conv", "part", "offset")
    names = dealt.select("key").distinct().withColumn("id", F.monotonically_increasing_id())
    rows = dealt.join(F.broadcast(later), ["conv", "part"], "left")
    rows = rows.withColumn("pos", F.col("local") + F.coalesce("offset", F.lit(0)))
    rows = lookup_join(rows, stage.table(names, "names"), [("key", "key")], "inner")
    counts = spans.groupBy("conv").agg(F.sum("n").alias("n"))
    return stage.table(rows.select("conv", "pos", "id", "bytes"), "placed"), stage.table(counts, "counts")


def rebuilt(placed: DataFrame, counts: DataFrame, group: int, heads: int, stage: Staging) -> tuple[DataFrame, DataFrame]:
    """Conversation c with its first h turns replaced by the first h of conversation ``c - c % group``.

    h is crc32 of c's decimal text modulo ``heads``. Returns (conv, pos, id, bytes) and (conv, n).
    """
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    plans = counts.select("conv", "n", head.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    bases = counts.select(F.col("conv").alias("base"), F.col("n").alias("there"))
    plans = plans.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("there", F.lit(0))))
    plans = stage.table(plans.withColumn("length", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "plans")
    own = lookup_join(placed, plans.select("conv", "h", "head"), [("conv", "conv")], "inner").where("pos >= h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "id", "bytes")
    first = placed.where(F.col("pos") < heads - 1).withColumnRenamed("conv", "base")
    taken = first.join(plans.select("conv", "base", "h"), "base").where("pos < h").select("conv", "pos", "id", "bytes")
    return own.unionByName(taken), plans.select("conv", F.col("length").alias("n"))


# Segments


def _value(number: int, i: int) -> int:
    """What a turn's number puts into hash ``i``."""
    return (number * OFFSETS[1 - i] + OFFSETS[i]) % PRIME


@tidied
def _hashed(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Adds each segment's part of the two hashes of its conversation."""
    powers = [[pow(base, j + 1, PRIME) for j in range(segment)] for base in BASES]
    for batch in batches:
        parts: tuple[list[int], list[int]] = ([], [])
        for number, ids in zip(batch.column("seg").to_pylist(), batch.column("ids").to_pylist()):
            for i, base in enumerate(BASES):
                inner = sum(_value(x, i) * p for x, p in zip(ids, powers[i]))
                parts[i].append(inner * pow(base, number * segment, PRIME) % PRIME)
        columns = [*batch.columns, *[pa.array(p, pa.int64()) for p in parts]]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "c1", "c2"])


def _segments(placed: DataFrame, counts: DataFrame, segment: int, stage: Staging) -> DataFrame:
    """(conv, seg, ids, sizes, last, p1, p2, q1, q2, e1, e2) of every segment; p, q and e are the hashes of what comes
    before it, before the segment before it, and up to its end."""
    seg = F.floor(F.col("pos") / segment).cast("int")
    turns = F.array_sort(F.collect_list(F.struct("pos", "id", "bytes")))
    rows = placed.groupBy("conv", seg.alias("seg")).agg(turns.alias("turns"))
    rows = rows.select("conv", "seg", F.col("turns.id").alias("ids"), F.col("turns.bytes").alias("sizes"))
    none = F.array().cast("array<long>")
    empty = counts.where("n = 0").select("conv", F.lit(0).alias("seg"), none.alias("ids"), none.alias("sizes"))
    rows = rows.unionByName(empty)
    schema = "conv long, seg int, ids array<long>, sizes array<long>, c1 long, c2 long"
    rows = stage.table(rows.mapInArrow(partial(_hashed, segment=segment), schema), "hashed")
    # Only conversations of several segments meet their parts again, each a row per segment.
    several = stage.table(rows.where("seg > 0").groupBy("conv").agg(F.max("seg").alias("final")), "several")
    zero = F.lit(0).cast("long")
    before = {"p1": zero, "p2": zero, "q1": zero, "q2": zero, "last": F.lit(True)}
    if several.isEmpty():
        joined = rows.withColumns(before)
    else:
        chain = Window.partitionBy("conv").orderBy("seg")
        sums = chain.rowsBetween(Window.unboundedPreceding, -1)
        parts = lookup_join(rows, several, [("conv", "conv")], "inner")
        for i in "12":
            total = F.sum(F.col(f"c{i}").cast("decimal(38,0)")).over(sums) % F.lit(PRIME)
            parts = parts.withColumn(f"p{i}", F.coalesce(total.cast("long"), zero))
        for i in "12":
            parts = parts.withColumn(f"q{i}", F.coalesce(F.lag(f"p{i}").over(chain), zero))
        parts = parts.withColumn("last", F.col("seg") == F.col("final")).drop("final")
        rest = lookup_join(rows, several, [("conv", "conv")], "left_anti")
        joined = parts.unionByName(rest.withColumns(before))
    ends = {f"e{i}": (F.col(f"p{i}") + F.col(f"c{i}")) % F.lit(PRIME) for i in "12"}
    return stage.table(joined.withColumns(ends).drop("c1", "c2"), "segments")


@tidied
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of ids sorted by node: one digest a node, read as a stream."""
    node, digest, done = None, None, []

    def made() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*done)]
        done.clear()
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["depth", "e1", "e2", "ends"]
        )

    for batch in batches:
        for *key, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if key != node:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield made()
    if node:
        done.append((*node, digest.hexdigest()))
        yield made()


def _ends(segments: DataFrame, segment: int, stage: Staging) -> DataFrame:
    """(depth, e1, e2, ends): the digest of the conversations that end at a node."""
    depth = (F.col("seg") * segment + F.size("ids")).cast("long")
    final = segments.where("last").select("conv", depth.alias("depth"), "e1", "e2")
    stretch = F.shiftright("conv", STRETCH_BITS)
    listed = final.groupBy("depth", "e1", "e2", stretch.alias("stretch")).agg(
        F.concat_ws(",", F.array_sort(F.collect_list("conv")).cast("array<string>")).alias("ids")
    )
    node = ["depth", "e1", "e2"]
    listed = listed.repartition(*node).sortWithinPartitions(*node, "stretch").select(*node, "ids")
    return stage.table(listed.mapInArrow(_digests, "depth long, e1 long, e2 long, ends string"), "ends")


# Trees


class Ternary:
    """A ternary search tree of number sequences; node 0 is the root, children of a node form a binary tree."""

    def __init__(self) -> None:
        self.number, self.low, self.high, self.down, self.size = [-1], [-1], [-1], [-1], [0]

    def _new(self, number: int, size: int) -> int:
        for column, value in zip((self.number, self.low, self.high, self.down, self.size), (number, -1, -1, -1, size)):
            column.append(value)
        return len(self.number) - 1

    def insert(self, ids: list[int], sizes: list[int]) -> list[int]:
        """The nodes on the way from the root to the sequence's last number; missing ones are made."""
        path = [0]
        for number, size in zip(ids, sizes):
            at, side, under = self.down[path[-1]], self.down, path[-1]
            while at >= 0 and self.number[at] != number:
                side, under = (self.low if number < self.number[at] else self.high), at
                at = side[at]
            if at < 0:
                at = side[under] = self._new(number, size)
            path.append(at)
        return path

    def traversed(self) -> list[tuple[int, int, int]]:
        """(node, parent, depth), a parent before its children."""
        out, waiting = [(0, -1, 0)], [(self.down[0], 0, 1)]
        while waiting:
            node, parent, depth = waiting.pop()
            if node >= 0:
                out.append((node, parent, depth))
                waiting += [(self.low[node], parent, depth), (self.high[node], parent, depth), (self.down[node], node, depth + 1)]
        return out


def _medians(n: int) -> Iterator[int]:
    """0 to n - 1, of every range its middle first."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            ranges += [(a, middle), (middle + 1, b)]


NODES = (
    "open boolean, top boolean, depth long, k1 long, k2 long, conv long, n_convs long, n_children long, "
    "n_leaves long, saved long, size long, below_leaves long, below_saved long, below_children long, ends string, "
    "u1 long, u2 long, parent_conv long, above array<struct<k1:long,k2:long,depth:long>>"
)
NODE_ARROW = pa.schema(
    [
        ("open", pa.bool_()), ("top", pa.bool_()),
        *[(c, pa.int64()) for c in ("depth", "k1", "k2", "conv", "n_convs", "n_children", "n_leaves", "saved", "size")],
        *[(c, pa.int64()) for c in ("below_leaves", "below_saved", "below_children")],
        ("ends", pa.string()), ("u1", pa.int64()), ("u2", pa.int64()), ("parent_conv", pa.int64()),
        ("above", pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64())]))),
    ]
)


def _tree(rows: list[dict], segment: int, first: bool, last: bool) -> Iterator[tuple]:
    """The nodes of the segments after one prefix. ``first`` and ``last`` tell that neighbouring shards may hold
    the same prefix; the nodes of the first or last segment are open then, and so is the root."""
    tree, n = Ternary(), len(rows)
    terminal, edge = {}, {0}
    for at in _medians(n):
        row = rows[at]
        path = tree.insert(row["ids"], row["sizes"])
        terminal[path[-1]] = row
        if (first and at == 0) or (last and at == n - 1):
            edge.update(path)
    order, total = tree.traversed(), len(tree.number)
    start = rows[0]["seg"] * segment
    members, children, leaves, saved = ([0] * total for _ in range(4))
    least = [None] * total
    keys = [(rows[0]["p1"], rows[0]["p2"])] * total
    powers = [[pow(base, start + j, PRIME) for j in range(segment + 1)] for base in BASES]
    for node, parent, depth in order[1:]:
        keys[node] = tuple(
            (keys[parent][i] + _value(tree.number[node], i) * powers[i][depth]) % PRIME for i in range(2)
        )
    for node, parent, _ in reversed(order):
        row = terminal.get(node)
        if row:
            members[node] += row["n"]
            least[node] = row["conv"] if least[node] is None else min(row["conv"], least[node])
        if node not in edge:
            if row:
                children[node] += row["below_children"]
                leaves[node] += row["below_leaves"]
                saved[node] += row["below_saved"]
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.size[node]
        if parent >= 0:
            members[parent] += members[node]
            least[parent] = least[node] if least[parent] is None else min(least[node], least[parent])
            children[parent] += node not in edge
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    above = {-1: []}
    for node, parent, depth in order:
        row, is_open = terminal.get(node), node in edge
        if is_open:
            above[node] = [*above[parent], {"k1": keys[node][0], "k2": keys[node][1], "depth": start + depth}]
        below = (row["below_leaves"], row["below_saved"], row["below_children"]) if row and is_open else (0, 0, 0)
        up = (None, None) if parent < 0 else keys[parent]
        yield (
            is_open, node == 0 and start > 0, start + depth, *keys[node], least[node], members[node], children[node],
            leaves[node], saved[node], tree.size[node], *below, row["ends"] if row else None, *up,
            None if parent < 0 or parent in edge else least[parent], above[node] if is_open else None,
        )


@tidied
def _shard(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """The trees of a shard's sorted segments, one prefix after the other."""
    done: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*done), NODE_ARROW)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, schema=NODE_ARROW)

    prefix, group, first = None, [], True
    for batch in batches:
        for row in batch.to_pylist():
            mark = (row["seg"], row["p1"], row["p2"])
            if group and mark != prefix:
                done.extend(_tree(group, segment, first, False))
                group, first = [], False
                if len(done) > 20_000:
                    yield made()
            prefix = mark
            group.append(row)
    if group:
        done.extend(_tree(group, segment, first, True))
    if done:
        yield made()


def _nodes(rows: DataFrame, below: DataFrame | None, segment: int, shards: int, stage: Staging) -> DataFrame:
    """All shards' nodes; ``below`` holds the totals of the trees that hang below full segments."""
    totals = ["below_leaves", "below_saved", "below_children"]
    if below is None:
        rows = rows.withColumns({c: F.lit(0).cast("long") for c in totals})
    else:
        on = [(F.col("seg") + 1, "seg"), ("e1", "p1"), ("e2", "p2")]
        rows = lookup_join(rows, below.select("seg", "p1", "p2", *totals), on, "left").fillna(0, totals)
    place = ["seg", "p1", "p2", "ids"]
    dealt = rows.repartitionByRange(shards, *place).sortWithinPartitions(*place)
    return stage.table(dealt.mapInArrow(partial(_shard, segment=segment), NODES), "nodes")


def _merged(nodes: DataFrame, stage: Staging) -> DataFrame:
    """Open nodes of all shards, each once, with the counts of the whole trie."""
    key = ["top", *KEY]
    total = lambda *names: [F.sum(c).alias(c) for c in names]
    once = nodes.where("open").groupBy(*key).agg(
        F.min("conv").alias("conv"),
        *total("n_convs", "n_children", "n_leaves", "saved", "below_leaves", "below_saved", "below_children"),
        *[F.max(c).alias(c) for c in ("size", "ends", "u1", "u2", "above")],
    )
    once = stage.table(once, "once")
    # The parent is the tree's root or a node below it: a root is a top where its tree hangs below another.
    parent = F.element_at("above", F.when(F.size("above") > 1, F.lit(-2)).otherwise(F.lit(1)))
    is_top = (F.size("above") == 2) & (F.col("above")[0]["depth"] > 0)
    children = once.where(F.size("above") > 1).select(is_top.alias("top"), parent.alias("up"))
    children = children.groupBy("top", *[F.col(f"up.{c}").alias(c) for c in KEY]).agg(F.count("*").alias("open_children"))
    once = once.join(children, key, "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0)) + F.col("below_children")
    )
    once = stage.table(once.drop("open_children"), "families")
    # Every open node adds its own leaf and savings to itself and to the nodes above it in its tree.
    own = once.select(
        (F.col("below_leaves") + (F.col("n_children") == 0).cast("long")).alias("own_leaves"),
        (F.col("below_saved") + (F.col("n_convs") - 1) * F.col("size")).alias("own_saved"),
        F.posexplode("above").alias("i", "at"),
    )
    own = own.groupBy(
        ((F.col("i") == 0) & (F.col("at.depth") > 0)).alias("top"), *[F.col(f"at.{c}").alias(c) for c in KEY]
    ).agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    out = once.join(own, key).withColumns(
        {"n_leaves": F.col("n_leaves") + F.col("own_leaves"), "saved": F.col("saved") + F.col("own_saved")}
    )
    return stage.table(out.drop("own_leaves", "own_saved", "above"), "merged")


def _below(rows: DataFrame, merged: DataFrame, segment: int, stage: Staging) -> DataFrame:
    """Totals of every tree that hangs below another: its own and, added in doubling steps, those further down."""
    trees = rows.where("seg > 0").groupBy("seg", "p1", "p2").agg(F.first("q1").alias("q1"), F.first("q2").alias("q2"))
    tops = merged.where("top").select(
        (F.col("depth") / segment).cast("int").alias("seg"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("n_children").alias("below_children"), F.col("n_leaves").alias("leaves"), "saved",
    )
    # A full segment with a tree below counted itself as a leaf.
    hanging = trees.groupBy((F.col("seg") - 1).alias("seg"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("hanging")
    )
    at = ["seg", "p1", "p2"]
    state = trees.join(tops, at).join(hanging, at, "left").select(
        *at, F.when(F.col("seg") > 1, F.col("seg") - 1).alias("up"), F.col("q1").alias("up1"), F.col("q2").alias("up2"),
        "below_children", (F.col("leaves") - F.coalesce("hanging", F.lit(0))).alias("leaves"), "saved",
    )
    state = stage.table(state, "chains")
    while not state.where("up IS NOT NULL").isEmpty():
        handed = state.where("up IS NOT NULL").groupBy(
            F.col("up").alias("seg"), F.col("up1").alias("p1"), F.col("up2").alias("p2")
        ).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = state.select(
            F.col("seg").alias("up"), F.col("p1").alias("up1"), F.col("p2").alias("up2"),
            F.col("up").alias("next"), F.col("up1").alias("next1"), F.col("up2").alias("next2"),
        )
        state = state.join(handed, at, "left").join(further, ["up", "up1", "up2"], "left").select(
            *at, F.col("next").alias("up"), F.col("next1").alias("up1"), F.col("next2").alias("up2"), "below_children",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        state = stage.table(state, "chains")
    return state.select(*at, F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"), "below_children")


def trie(placed: DataFrame, counts: DataFrame, stage: Staging, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of (conv, pos, id, bytes); ``counts`` (conv, n) names every conversation, turnless too."""
    segments = _segments(placed, counts, segment, stage)
    same = ["sizes", "q1", "q2", "e1", "e2"]
    rows = segments.groupBy("seg", "p1", "p2", "ids").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), *[F.first(c).alias(c) for c in same]
    )
    depth = (F.col("seg") * segment + F.size("ids")).cast("long")
    rows = stage.table(rows.withColumn("depth", depth), "rows")
    on = [(c, c) for c in ("depth", "e1", "e2")]
    rows = stage.table(lookup_join(rows, _ends(segments, segment, stage), on, "left"), "sequences")
    measured = rows.agg(F.sum(F.size("ids") + 1).alias("turns"), F.max("seg").alias("levels")).first()
    shards, chained = max(1, (measured["turns"] or 0) // shard_turns), (measured["levels"] or 0) > 0
    below = None
    if chained:
        upper = _merged(_nodes(rows, None, segment, shards, stage), stage)
        below = _below(rows, upper, segment, stage)
    nodes = _nodes(rows, below, segment, shards, stage)
    merged = _merged(nodes, stage).where("NOT top")
    inner = nodes.where("NOT open")
    known = merged.select(*KEY, "conv")
    if chained:  # the root of a tree below another is the last node of a full segment
        known = known.unionByName(inner.where((F.col("depth") > 0) & (F.col("depth") % segment == 0)).select(*KEY, "conv"))
    known = stage.table(known.withColumnRenamed("conv", "found"), "parents")
    columns = ["conv", "depth", "u1", "u2", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    rows = inner.select(*columns).unionByName(merged.withColumn("parent_conv", F.lit(None).cast("long")).select(*columns))
    on = [(F.col("depth") - 1, "depth"), ("u1", "k1"), ("u2", "k2")]
    asked = lookup_join(rows.where("parent_conv IS NULL AND depth > 0"), known, on, "left")
    asked = asked.withColumn("parent_conv", F.col("found")).drop("found")
    return rows.where("parent_conv IS NOT NULL OR depth = 0").unionByName(asked)


def _result(nodes: DataFrame, conv: str) -> list[Column]:
    return [
        F.col("conv").alias(conv), "depth", F.col("parent_conv").alias(f"parent_{conv}"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    ]


def prefix_trie(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    splice: tuple[int, int] | None = None,
    segment: int = SEGMENT,
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per distinct sequence of first turns of a conversation (a node), from the root of depth 0.

    Columns: the least member's key, ``depth``, the parent's key (root: NULL), ``n_convs`` members, ``n_children``,
    ``n_leaves`` (nodes without children in the subtree, the node included), ``saved_tokens`` (over the subtree, the
    members but one times the UTF-8 bytes of the node's last text) and ``ends_sha256`` (of the keys of the
    conversations that end here, ascending, joined by commas).

    Turns are ordered by ``turn``, NULL first, ties by role and then by the turn's digest; a repeated row is a
    repeated turn. NULL role and text count as empty. Rows with a NULL key are in no conversation. An empty table has no nodes.
    Turns are told apart by 128 bits, prefixes by 122 and their depth. ``splice`` (group, heads) rebuilds the
    conversations first, see ``rebuilt``. Other columns are not read.
    """
    stage = Staging(df.sparkSession, "trie")
    placed, counts = placed_turns(df, conv, turn, role, text, stage)
    if splice:
        placed, counts = rebuilt(placed, counts, *splice, stage)
    nodes = trie(placed, counts, stage, segment, shard_turns)
    return stage.result(nodes.select(*_result(nodes, conv)))
