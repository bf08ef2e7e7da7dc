import hashlib
import random
import zlib

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from aforo.llm import prefix_trie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, id long, pos string, conv string, depth int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "p", "c", 1) for r in rows], SCHEMA)


def digest(role, text):
    said = (role or "").encode()
    return hashlib.md5(str(len(said)).encode() + b":" + said + (text or "").encode()).digest()


def conversations(rows, splice=None):
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", digest(role, text), text or ""))
    whole = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in out.items()}
    if not splice:
        return whole
    group, heads = splice
    made = {}
    for c, own in whole.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % group if c >= 0 else -(-c % group))
        made[c] = whole.get(base, [])[:h] + own[h:]
    return made


def brute(rows, splice=None):
    members = {}
    for c, turns in conversations(rows, splice).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    whole = conversations(rows, splice)
    children, leaves, saved = ({node: 0 for node in members} for _ in range(3))
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        own = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += own
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(seed, convs, longest, words):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randint(1, longest)):
            rows.append((c * r.choice([1, 1, -1]) if c % 7 == 0 else c, t, r.choice(["user", "assistant"]) if t % 3 == 0 else "user",
                         "é" * r.randint(1, words)))
    return list({(c, t): (c, t, a, b) for c, t, a, b in rows}.values())


EDGE = [
    (1, None, "user", "first"), (1, 0, None, None), (1, 1, "", ""), (1, 1, "", ""), (None, 1, "user", "nobody"),
    (2, None, "user", "first"), (2, None, "user", "first"), (3, 5, "user", "x" * 200_000), (-4, 0, "a", "b"), (-5, 0, "a", "b"),
    (6, 0, "ab", "c"), (7, 0, "a", "bc"),
]


@pytest.mark.parametrize("splice", [None, (5, 9)])
@pytest.mark.parametrize("segment, shard", [(64, 100_000), (3, 40)])
def test_nodes_equal_brute_force(spark, splice, segment, shard):
    rows = random_rows(1, 60, 12, 2) + EDGE
    df = frame(spark, rows).repartition(5)
    assert got(prefix_trie.prefix_trie(df, splice=splice, segment=segment, shard_turns=shard)) == brute(rows, splice)


def test_long_chains_with_equal_heads(spark):
    """Trees that hang below each other, some shared by several conversations, over many shards."""
    long = [("user", f"t{i % 5}") for i in range(90)]
    rows = [(c, i, r, t) for c in range(4) for i, (r, t) in enumerate(long[: 60 + 10 * c])]
    rows += [(c, i, r, t) for c in (10, 11) for i, (r, t) in enumerate([*long[:47], ("user", "other"), *long[:30]])]
    df = frame(spark, rows)
    assert got(prefix_trie.prefix_trie(df, segment=4, shard_turns=30)) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = [(5, i, "user", f"x{i % 3}") for i in range(1500)] + random_rows(2, 20, 5, 2)
    rows = [r for r in rows if r[0] != 5 or r[3].startswith("x")]
    df = frame(spark, rows).repartition(6)
    found = {r[:2]: r for r in got(prefix_trie.prefix_trie(df, segment=16, shard_turns=400))}
    assert found == {r[:2]: r for r in brute(rows)}


def test_equal_conversations(spark):
    rows = [(c, t, "user", f"hello {t}") for c in range(-3000, 3000) for t in range(2)] + [(9000, 0, "user", "hello 0")]
    assert got(prefix_trie.prefix_trie(frame(spark, rows).repartition(4), shard_turns=10)) == brute(rows)


def test_empty_table(spark):
    assert got(prefix_trie.prefix_trie(frame(spark, []))) == []
    assert got(prefix_trie.prefix_trie(frame(spark, [(None, 1, "a", "b")]))) == []


def test_tree_is_balanced():
    tree = prefix_trie.Ternary()
    for i in prefix_trie._medians(1023):
        tree.insert([i], [1])
    depth = {0: 0}
    waiting = [(tree.down[0], 1)]
    while waiting:
        node, d = waiting.pop()
        if node >= 0:
            depth[node] = d
            waiting += [(tree.low[node], d + 1), (tree.high[node], d + 1)]
    assert max(depth.values()) == 10


def test_registered_query(spark):
    same, found, want = compare(spark, connect(SF), SF, contract.queries()["op11_prefix_trie"], contract.oracle_sql()["op11_prefix_trie"])
    assert same and found == want
    rows = connect(SF).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert got(contract.queries()["op11_prefix_trie"](spark, SF)) == brute(rows, (5, 9))
