import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
import xxhash
from llm_samples import EDGE, documents, prose  # noqa: F401
from pyspark.sql import functions as F

from aforo.llm import (
    blocks,
    byte_bpe,
    decontaminate,
    license_scan,
    lm_score,
    near_dedup,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    url_filter,
)
from aforo.llm.common import unpack_ints, unpack_strings
from aforo.llm.components import components
from aforo.llm.common import Staging
from aforo.llm.elias_fano import Trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 1 URL filters


def test_urls(spark):
    rules = [("allow", "org/"), ("block", "a.org/x/"), ("allow", "a.org/x/y"), ("block", "b.a.org/"), ("block", "noslash")]
    urls = [
        (1, "http://B.a.ORG/x/1"),
        (2, "https://a.org/x/yz?q#f"),
        (3, None),
        (4, "no scheme"),
        (5, "http://a.org"),
        (6, "http://xa.org/x/1"),
        (7, "http://" + "s." * 3000 + "org/" + "p" * 5000),
        (8, ""),
        (8, ""),
        (None, "http://a.org/x/"),
    ]
    df = spark.createDataFrame([(k, u, "old", "old") for k, u in urls], "page_id long, url string, host string, rule string")
    for small in (True, False):
        got = url_filter.filter_urls(df, spark.createDataFrame(rules, "action string, rule string"), small=small)
        found = {r.page_id: (r.rule, r.verdict) for r in got.collect()}
        assert got.count() == len(urls)
        assert found[1] == ("b.a.org/", "block")
        assert found[2] == ("a.org/x/y", "allow")
        assert found[5] == found[3] == found[4] == found[8] == (None, "allow")
        assert found[6] == ("org/", "allow")
        assert found[7] == ("org/", "allow")
        assert found[None] == ("a.org/x/", "block")
    none = url_filter.filter_urls(df.limit(0), spark.createDataFrame([], "action string, rule string"))
    assert none.count() == 0


# 2 licence scans


def test_licenses(spark):
    mit = "Released under the MIT License."
    rows = [
        ("a/LICENSE", mit),
        ("a/b/c/f.py", "x = 1"),
        ("a/b/LICENSE.txt", "intro text\nLicensed under the Apache License, Version 2.0.\nmore"),
        ("z/f", "nothing here is licensed to anyone under any version"),
        (None, None),
        ("a/g", ""),
        ("COPYING", "Licensed under CC BY-NC 4.0."),
        ("a/own", mit),
    ]
    df = spark.createDataFrame([(i, p, t, "old") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, license string")
    got = {r.doc_id: (r.license, r.origin, r.directory) for r in license_scan.scan_licenses(df).collect()}
    assert got[0] == ("MIT", "own", "a")
    assert got[1] == ("Apache-2.0", "inherited", "a/b")
    assert got[3] == ("CC-BY-NC-4.0", "inherited", "")
    assert got[4] == (None, None, None)
    assert got[5] == ("MIT", "inherited", "a")
    assert got[7] == ("MIT", "own", "a")
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


def test_licenses_under_null_and_repeated_keys(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [(None, "a/LICENSE", mit), (None, "a/f", "x = 1"), (None, "b/g", "y = 2"), (5, "c/LICENSE", apache), (5, "d/h", "z = 3"), (6, "a/i", "")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.path: (r.doc_id, r.license, r.origin, r.directory) for r in license_scan.scan_licenses(df).collect()}
    assert got == {
        "a/LICENSE": (None, "MIT", "own", "a"),
        "a/f": (None, "MIT", "inherited", "a"),
        "b/g": (None, None, None, None),
        "c/LICENSE": (5, "Apache-2.0", "own", "c"),
        "d/h": (5, None, None, None),
        "a/i": (6, "MIT", "inherited", "a"),
    }


# 3 decontamination


def test_leaks_equal_brute_force(spark, documents):
    r = random.Random(3)
    items = [(i, prose(100 + i, r.randint(5, 40), 3000)) for i in range(30)] + [(None, "x y z u v w"), (98, None), (99, "two words")]
    texts = []
    for n in range(150):
        w = prose(500 + n, 60, 3000).split()
        item = items[n % 30][1].split()
        for _ in range(n % 4):
            at = r.randrange(len(item))
            item[at : at + r.randint(0, 1)] = [f"new{r.randrange(99)}"]
        texts.append((n, " ".join(w[:30] + item + w[30:]).upper() if n % 5 == 0 else " ".join(w[:30] + item + w[30:])))
    frame = documents(texts + [(400, None), (401, ""), (None, items[0][1]), (0, texts[0][1])])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((x.doc_id, x.item_id) for x in decontaminate.leaks(frame, bench).collect())
    sliced = decontaminate.leaks(frame, bench, slice_bytes=400)
    assert Counter((x.doc_id, x.item_id) for x in sliced.collect()) == got
    want = Counter()
    for key, text in [*texts, (None, items[0][1]), (0, texts[0][1])]:
        own = decontaminate.words_of(text.encode())
        for item, body in items[:30]:
            sought = decontaminate.words_of(body.encode())
            number = {w: i for i, w in enumerate(sought, 1)}
            d, _ = decontaminate.distance(np.array([number[w] for w in sought]), np.array([number.get(w, 0) for w in own]))
            if d <= decontaminate.edits_of(len(sought)):
                want[key, item] += 1
    assert not got - want
    assert sum(got.values()) >= 0.97 * sum(want.values())
    assert decontaminate.leaks(frame, bench.limit(0)).count() == 0


# 4 quality classifier


def test_quality(spark, documents):
    good = [(i, prose(i, 60)) for i in range(200)]
    bad = [(1000 + i, " ".join(f"{w}###" for w in prose(i, 60).split())) for i in range(200)]
    frame = documents(good + bad + EDGE)
    labels = spark.createDataFrame(
        [(k, 1, 0) for k, _ in good] + [(k, 0, 0) for k, _ in bad] + [(None, 1, 0), (5, None, 0), (9999, 0, 0), (3, 1, 1)],
        "doc_id long, quality int, score int",
    )
    model = quality_classifier.fit(frame, labels.where("doc_id % 3 != 1"))
    rows = quality_classifier.score(frame, model).collect()
    assert len(rows) == len(good) + len(bad) + len(EDGE)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id % 3 == 1 and (r.doc_id >= 1000 or 20 < r.doc_id < 200)]
    assert np.mean([(r.score >= 0.5) == (r.doc_id < 1000) for r in held]) > 0.98
    kept = quality_classifier.passing(frame, model)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r.score >= 0.5 for r in rows)
    assert quality_classifier.fit(frame, labels.limit(0)) == 0.5
    assert quality_classifier.score(frame.limit(0), model).count() == 0


# 5 quality rules


def test_rule_counts_equal_brute_force(spark, documents):
    rows = EDGE + [(20, "a b c d e a b c d e f g h i j"), (21, "x " * 40), (22, "l m\nl m\n\n \nl m")]
    got = {}
    for r in quality_rules.judged(documents(rows)).collect():
        got.setdefault(r.doc_id, r)
    for key, text in rows:
        if key is None:
            continue
        w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        twice = {x for x, n in Counter(runs).items() if n > 1}
        covered = {i + j for i, x in enumerate(runs) if x in twice for j in range(5)}
        r = got[key]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules.judged(documents(rows).limit(0)).count() == 0


def test_divergence(spark, documents):
    common = "the of and to in a is that for it".split()
    r = random.Random(1)
    clean = [(i, " ".join(r.choice(common) if r.random() < 0.4 else f"word{chr(97 + r.randrange(26))}" for _ in range(200))) for i in range(40)]
    shouted = [(100, clean[0][1].upper()), (101, clean[1][1].replace(" ", "## ")), (102, " ".join(f"n{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)))]
    got = {x.doc_id: x for x in quality_rules.judged(documents(clean + shouted)).collect()}
    assert all(got[k].kept for k, _ in clean)
    assert not any(got[k].kept for k, _ in shouted)
    p, q = np.array([3, 1, 0, 4]), [2, 2, 3, 1]
    frame = spark.range(1).select(quality_rules._distance(F.array(*map(F.lit, p.tolist())).cast("array<long>"), q).alias("d"))
    a, b = p / p.sum(), np.array(q) / sum(q)
    part = lambda x, m: sum(u * math.log(u / v) for u, v in zip(x, m) if u)
    assert frame.first().d == pytest.approx(math.sqrt((part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2))


def test_languages_without_fixed_words(spark, documents):
    """Any language of the table is its own reference; a row without a language has none and passes."""
    r = random.Random(2)
    letters = {"ru": "абвгдежзиклмнопрстуф", "sw": "abcdefghijklmnopqrst"}
    rows, langs = [], {}
    for at, (lang, abc) in enumerate(letters.items()):
        frequent = [abc[i] + abc[i + 1] for i in range(10)]
        word = lambda: "".join(r.choice(abc) for _ in range(6))  # noqa: B023, E731
        for i in range(40):
            text = " ".join(r.choice(frequent) if r.random() < 0.4 else word() for _ in range(200))
            rows.append((1000 * at + i, text))
        rows.append((1000 * at + 100, rows[-1][1].replace(" ", "## ")))
        rows.append((1000 * at + 101, " ".join(word() for _ in range(300))))
        langs |= {k: lang for k, _ in rows if k >= 1000 * at}
    rows += [(5000, rows[0][1]), (5001, rows[45][1])]
    known = "the of and to in a is that for it".split()
    english = [(9000 + i, " ".join(r.choice(known) if r.random() < 0.4 else f"word{chr(97 + r.randrange(26))}" for _ in range(200))) for i in range(40)]
    rows += english
    langs |= {k: "en" for k, _ in english}
    lang = F.create_map(*[F.lit(x) for pair in langs.items() for x in pair])
    frame = documents(rows).withColumn("lang", F.element_at(lang, F.col("doc_id").cast("int")))
    assert {x.lang for x in frame.select("lang").distinct().collect()} == {"en", "ru", "sw", None}
    got = {x.doc_id: x for x in quality_rules.judged(frame).collect()}
    junk = {100, 101, 1100, 1101}
    assert {k for k, x in got.items() if not x.kept} == junk and len(got) == len(rows)
    assert all(got[k].js_chars is None and got[k].js_common is None for k in (5000, 5001))


# 6 token counts


def test_limits_equal_brute_force(spark, documents):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    counted = token_counts.lengths(documents(EDGE), RANKS, public_tokenizers.PATTERN)
    sizes = [len(encoding.encode_ordinary(t or "")) for _, t in EDGE]
    assert sorted(r.n_tokens for r in counted.collect()) == sorted(sizes)
    for r in token_counts.limits(counted, width=16).collect():
        limit = r.context_limit
        assert r.documents == sizes.count(limit) and r.longer == sum(n > limit for n in sizes)
        assert r.kept_tokens == sum(min(n, limit) for n in sizes) and r.total_tokens == sum(sizes)
        assert r.cut_tokens == r.total_tokens - r.kept_tokens
        assert r.whole_tokens == sum(n for n in sizes if n <= limit)
        assert r.share == pytest.approx(sum(n <= limit for n in sizes) / len(sizes))
    assert token_counts.limits(counted.limit(0)).count() == 0
    summed, wanted = token_counts.limits(counted, width=16), [0, 1, 2, 77, 2048, 10**6]
    for r in token_counts.at_limits(summed, wanted).collect():
        w = r.context_limit
        assert r.kept_tokens == sum(min(n, w) for n in sizes) and r.cut_tokens == sum(sizes) - r.kept_tokens
        assert r.whole_tokens == sum(n for n in sizes if n <= w)
        assert r.share == pytest.approx(sum(n <= w for n in sizes) / len(sizes))
    got = {r.share: r.length for r in token_counts.quantiles(summed, [0.1, 0.5, 0.9, 1.0]).collect()}
    assert got == {q: sorted(sizes)[math.ceil(q * len(sizes)) - 1] for q in got} and len(got) == 4
    empty = token_counts.limits(counted.limit(0))
    assert token_counts.at_limits(empty, [5]).count() == token_counts.quantiles(empty, [0.5]).count() == 0


# 7 language model


def test_lm_equals_brute_force(spark, documents):
    texts = EDGE + [(30 + i, prose(i, 50, 60)) for i in range(30)]
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(True))
    rows = lm_score.lm_scores(documents(texts), train, shard_bytes=20_000).collect()
    assert len(rows) == len(texts)
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 1
    tokens = [(k, [*words(lowered(t)), "\n"]) for k, t in texts]
    count, pairs = Counter(), Counter()
    for k, w in tokens:
        if not held(k):
            count.update(w), pairs.update(zip(["\t", *w], w))
    total, kinds = Counter(), Counter()
    for (v, _), n in pairs.items():
        total[v] += n
        kinds[v] += 1
    n, v = sum(count.values()), len(count)
    want = []
    for k, w in tokens:
        single = [(count[x] + 0.5) / (n + 0.5 * (v + 1)) for x in w]
        full = [
            (max(pairs[u, x] - 0.75, 0) + 0.75 * kinds[u] * p) / total[u] if total[u] else p
            for u, x, p in zip(["\t", *w], w, single)
        ]
        want.append((str(k), held(k), len(w), sum(count[x] > 0 for x in w), n, sum(map(math.log10, single)), sum(map(math.log10, full))))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows)
    for a, b in zip(got, sorted(want)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6], rel=3e-3)
    assert lm_score.lm_scores(documents(texts).limit(0), train).count() == 0


def test_trie():
    random_ = np.random.default_rng(1)
    for n in (0, 1, 5, 4000):
        keys = np.unique((random_.integers(0, 40, n, dtype=np.uint64) << np.uint64(32)) | random_.integers(0, 1 << 32, n, dtype=np.uint64))
        trie = Trie(keys, np.arange(1, len(keys) + 1).astype(np.uint16))
        other = random_.integers(0, 1 << 40, 500, dtype=np.uint64)
        known = {int(k): i + 1 for i, k in enumerate(keys)}
        sought = np.r_[keys, other]
        assert trie.codes_of(sought).tolist() == [known.get(int(k), 0) for k in sought]


def test_trie_with_one_hot_context():
    hot = (np.uint64(7) << np.uint64(32)) | (np.arange(20_000, dtype=np.uint64) * np.uint64(3))
    rare = np.arange(100, 400, dtype=np.uint64) << np.uint64(32)
    keys = np.r_[hot, rare]
    trie = Trie(keys, np.arange(1, len(keys) + 1).astype(np.uint16))
    assert trie.codes_of(keys).tolist() == list(range(1, len(keys) + 1))
    assert not trie.codes_of(np.r_[hot + np.uint64(1), rare + np.uint64(1)]).any()


# 8 byte-level BPE


def test_bpe_round_trip(spark, documents):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    frame = documents(EDGE)
    want = sorted((str(k), encoding.encode_ordinary(t or ""), (t or "").encode()) for k, t in EDGE)
    got = byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN, bucket_bytes=10_000).collect()
    assert sorted((str(r.doc_id), unpack_ints(r.ids).tolist(), bytes(r.decoded)) for r in got) == want
    digests = byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN, digest=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == [
        (k, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(d).hexdigest()) for k, i, d in want
    ]
    assert byte_bpe.encode(frame.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


# 9 near-duplicates


def shingle_set(text):
    w = words(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = [shingle_set(t) for _, t in texts]
    part = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    out = []
    for (key, _), s, p in zip(texts, sets, part):
        keys = [k for (k, _), q in zip(texts, part) if q == p and k is not None]
        out.append((key, len(s), min(keys, default=None), key == min(keys, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slot", [1024, 4])
def test_near_duplicates_equal_brute_force(spark, documents, monkeypatch, slot):
    monkeypatch.setattr(near_dedup, "SLOT", slot)
    r, base, family = random.Random(9), prose(50, 100, 5000).split(), []
    for n in range(40):  # near copies of a base that is itself absent: links on both sides of the threshold
        w = list(base)
        for _ in range(r.randint(1, 4)):
            w[r.randrange(len(w))] = f"edit{n}"
        family.append((100 + n, " ".join(w)))
    texts = EDGE + family
    assert sorted_rows(near_dedup.near_duplicates(documents(texts))) == brute_components(texts)
    assert near_dedup.near_duplicates(documents(texts).limit(0)).count() == 0


def test_sketch_estimates_similarity():
    r = np.random.default_rng(2)
    shared = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    for n in (1, 3, 100):
        a, b = (np.unique(np.r_[shared, r.integers(0, 1 << 63, n, dtype=np.uint64)]) for _ in range(2))
        assert np.mean(near_dedup.sketch(a) == near_dedup.sketch(b)) == pytest.approx(300 / (300 + 2 * n), abs=0.15)
    assert (near_dedup.sketch(shared[:1]) != near_dedup.EMPTY).all()


def test_components_of_a_path(spark):
    names = list(range(60))
    random.Random(4).shuffle(names)
    links = spark.createDataFrame([(a, b) for a, b in zip(names[:-1], names[1:])] + [(70, 71), (5, 5)], "a long, b long")
    got = components(links, Staging(spark, "path")).collect()
    assert len({r.label for r in got if r.node < 60}) == 1
    assert {r.node for r in got} == {*range(60), 70, 71}


# 10 repeated passages


def test_passages_equal_brute_force(spark, documents):
    passage = prose(60, 70, 9000)
    texts = EDGE + [
        (40, prose(61, 30) + " " + passage),
        (41, passage + " " + prose(62, 30)),
        (42, " ".join(passage.split()[:49])),
        (43, " ".join(passage.split()[:50])),
        (44, passage + " " + passage),
        (45, passage.upper()),
    ]
    first = {}
    for key, text in texts:
        w = words(text)
        for i in range(len(w) - 49):
            if key is not None:
                run = tuple(w[i : i + 50])
                first[run] = min(first.get(run, key), key)
    want = []
    for key, text in texts:
        w = words(text)
        gone = {
            i + j for i in range(len(w) - 49) if key is not None and first[tuple(w[i : i + 50])] < key for j in range(50)
        }
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((str(key), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substring_dedup.repeated_passages(documents(texts))
    assert sorted((str(r[0]), *r[1:4]) for r in got.collect()) == sorted(want)
    assert substring_dedup.repeated_passages(documents(texts).limit(0)).count() == 0


def test_automaton_finds_overlapping_phrases():
    w = [b"a", b"b", b"a", b"b", b"a", b"ab"]
    assert sorted(substring_dedup._occurrences(w, np.array([0, 1]), 3).tolist()) == [0, 1, 2]


def test_minimizers_cover_every_window():
    values = np.random.default_rng(3).integers(0, 50, 400, dtype=np.uint64)
    at = substring_dedup.minimizers(values, 41)
    for i in range(len(values) - 40):
        assert i + int(np.argmin(values[i : i + 41])) in at


def test_a_family_gives_one_pivot_a_node(spark, documents):  # noqa: F811
    """Pairs to verify stay below a few per node, whatever the number of copies."""
    for copies in (100, 400):
        r, base, rows = random.Random(copies), prose(70, 200, 5000).split(), []
        for n in range(copies):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"edit{n}"
            rows.append((n, " ".join(w)))
        near = near_dedup.NearDuplicates(documents(rows), "doc_id", "text", near_dedup.PERCENT)
        nodes = near.nodes.count()
        assert near._pivots().count() <= nodes
        made, table = {}, near.stage.table
        near.stage.table = lambda df, part: made.setdefault(part, []).append(table(df, part)) or made[part][-1]  # noqa: B023
        labels = near.labels()
        assert labels.select("label").distinct().count() == 1
        assert made["pivots"][0].count() + made["links"][0].count() <= 2 * nodes
        near.stage.drop()


def test_recall_of_planted_pairs():
    """Pairs just above the threshold that share a band and pass the sketch's bound."""
    r, found, share = np.random.default_rng(5), 0, []
    for n in range(600):
        size = int(r.integers(40, 400))
        apart = int(size * r.uniform(0.10, 0.1428))  # Jaccard (size - apart) / (size + apart) of 0.75 to 0.82
        both = r.integers(0, 1 << 63, size - apart, dtype=np.uint64)
        a, b = (near_dedup.sketch(np.unique(np.r_[both, r.integers(0, 1 << 63, apart, dtype=np.uint64)])) for _ in range(2))
        bands = (a == b).reshape(-1, near_dedup.ROWS).all(axis=1).any()
        share.append((a == b).mean())
        found += bands and share[-1] >= near_dedup.SHARE
    assert found == 600 and min(share) >= near_dedup.SHARE + 0.02


def test_quality_model_takes_a_repeated_key_once(spark, documents):  # noqa: F811
    """A labelled key on a third of the rows, and labels in a tie, give the model of one row a key."""
    good, bad = (lambda n: prose(n, 60, 300)), (lambda n: "!!! buy " + prose(n, 60, 3000).upper())
    rows = [(n, good(n) if n % 2 else bad(n)) for n in range(60)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(60)] + [(7, 0)], "doc_id long, quality int")
    once = quality_classifier.fit(documents(rows), labels)
    often = quality_classifier.fit(documents(rows + [rows[7]] * 30 + [(7, "\uffff" + rows[7][1])]), labels)
    assert np.array_equal(once.vectors, often.vectors)
    scored = quality_classifier.score(documents(rows), often).collect()
    assert np.mean([(r.score >= 0.5) == r.doc_id % 2 for r in scored]) > 0.9


def test_quality_model_brings_one_matrix_to_the_driver(spark, documents, monkeypatch):  # noqa: F811
    """Neighbour sums reach the driver once, however many tasks make them, and the model is the same."""
    frame = documents([(n, prose(n, 60, 300) if n % 2 else "!!! buy " + prose(n, 60, 3000).upper()) for n in range(90)])
    labels = spark.createDataFrame([(n, n % 2) for n in range(90)], "doc_id long, quality int")
    taken, collect = [], type(frame).collect

    def spy(df):
        rows = collect(df)
        taken.extend(len(r["sums"]) for r in rows if "sums" in df.columns)
        return rows

    models = []
    for tasks in (2, 40):
        monkeypatch.setattr(quality_classifier, "TASKS", tasks)
        monkeypatch.setattr(type(frame), "collect", spy)
        taken.clear()
        models.append(quality_classifier.fit(frame, labels))
        assert 0 < sum(taken) <= 8 * quality_classifier.BUCKETS * quality_classifier.WIDTH
    assert np.array_equal(models[0].vectors, models[1].vectors)


def test_a_block_numbers_words_and_marks_them():
    block = blocks._Block()
    block.add(3, ["b", "a", "b"], 3)
    block.add(None, [], 0)
    block.add(4, ["ñ", "a", "b"], 4)
    row = block.row(7, str.encode, byte_bpe._marks).to_pylist()[0]
    assert unpack_strings(row["vocabulary"]) == [b"b", b"a", "ñ".encode()]
    assert unpack_ints(row["sequence"]).tolist() == [0, 1, 0, 2, 1, 0] and unpack_ints(row["sizes"]).tolist() == [3, 0, 3]
    marks = [xxhash.xxh3_64_intdigest(w) % byte_bpe.FINE for w in (b"b", b"a", "ñ".encode())]
    assert np.frombuffer(row["marks"], np.uint16).tolist() == marks
