import hashlib
from collections import Counter

import tiktoken
from compare import compare, connect
from llm_samples import EDGE, documents, prose  # noqa: F401
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from aforo.llm import byte_bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    same, got, want = compare(spark, connect(SF), SF, contract.queries()[name], queries.ORACLE[name])
    assert same and got == want


@pytest.mark.parametrize("name", ["op2_license_scan", "op3_decontamination", "op4_quality", "op5_quality_rules", "op6_token_counts"])
def test_query_runs(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_stages(spark, documents, tmp_path):
    """Each stage's decision on planted rows, and the columns it returns."""
    item = prose(900, 20, 9000)
    passage = prose(901, 60, 9000)
    rows = [(500 + i, prose(700 + i, 120, 9000)) for i in range(40)]
    rows += [(600, rows[0][1] + " more"), (601, f"{prose(902, 80, 9000)} {item}"), (602, f"{prose(903, 300, 9000)} {passage}")]
    rows += [(603, f"{passage} {prose(904, 300, 9000)}")]
    rows += [(700 + i, " ".join(f"{w}###" for w in prose(800 + i, 60).split())) for i in range(40)]
    frame = documents(rows)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(k, int(k < 700), 0) for k, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={}
    )
    want = {}
    for key, text in rows:
        if key < 700 and key not in (600, 601):
            text = text[len(passage) + 1 :] if key == 603 else text
            ids = encoding.encode_ordinary(text)
            want[key] = (len(ids), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want
    docs = documents(EDGE)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def one_of_each_group(rows):
    """The least row of every group of near-duplicates by (key, NULL last, digest of the text); rows without words stay."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    part = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                part = [part[j] if p == part[i] else p for p in part]
    groups = {}
    for (key, text), p in zip(rows, part):
        groups.setdefault(p, []).append((key is None, key or 0, hashlib.md5((text or "").encode()).hexdigest(), key, text))
    return Counter(min(g)[3:] for g in groups.values())


def test_rows_kept_under_null_and_repeated_keys(spark, documents, tmp_path):
    """A key says nothing of the other rows that have it: what stays equals brute force row by row."""
    item, shared, pair = prose(910, 20, 9000), prose(911, 80, 9000), prose(912, 80, 9000)
    rows = EDGE + [(None, EDGE[0][1] + " more"), (None, shared), (None, shared + " more"), (None, shared)]
    rows += [(20, pair), (20, pair + " more"), (21, EDGE[0][1]), (21, prose(913, 80, 9000))]
    rows += [(22, f"{prose(914, 60, 9000)} {item}"), (22, prose(915, 60, 9000))]
    rows += [(None, f"{prose(916, 60, 9000)} {item}"), (None, prose(917, 60, 9000))]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(rows)
    kept = lambda stage: Counter((r.doc_id, r.text) for r in stage(spark, docs, str(tmp_path)).collect())
    assert kept(corpus_pipeline.near_duplicates) == one_of_each_group(rows)
    assert kept(corpus_pipeline.decontamination) == Counter(x for x in rows if item not in (x[1] or ""))
