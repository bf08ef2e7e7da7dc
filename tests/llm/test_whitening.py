import math

import numpy as np
import pytest
from compare import connect

import __spark_entry__ as contract
from aforo.llm import whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, id long, x string, component string"


def floats(v):
    return v if v is None else [c if c is None else float(c) for c in v]


def frame(spark, rows):
    return spark.createDataFrame([(k, floats(v), 1, 9, "x", "c") for k, v in rows], SCHEMA)


def brute(rows, components=4):
    """(key, component) -> (n, deviation, |whitened|, explained) by an eigendecomposition of the covariance."""
    kept = [(k, [math.floor(256 * c) for c in v]) for k, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for k, x in kept:
        away = [n * c - s for c, s in zip(x, sums)]
        for j in range(components):
            white = np.array(away) / n @ vectors[:, j] / math.sqrt(values[j])
            deviation = sum(a * a for a in away)
            out.append((k, j + 1, n, deviation if deviation < 1 << 63 else None, abs(white), values[j] / values.sum()))
    return sorted(out, key=repr)


def got(df):
    rows = df.collect()
    assert all(r["identity_error"] <= 1e-8 for r in rows)
    return sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"])
                   for r in rows), key=repr)


def same(found, want, close=1e-7):
    assert len(found) == len(want)
    for a, b in zip(found, want):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=close, abs=close)


def random_rows(seed, n, scales):
    r = np.random.default_rng(seed)
    return [(i, (r.standard_normal(len(scales)) * scales).tolist()) for i in range(n)]


EDGE = [(None, None), (900, None), (901, [1.0, None, 0, 0, 0, 0]), (902, [1.0, float("nan"), 0, 0, 0, 0]),
        (903, [1.0, float("inf"), 0, 0, 0, 0])]


def test_rows_equal_brute_force(spark):
    rows = random_rows(1, 300, [1, 2, 3, 4, 5, 6]) + [(7, [0.0, 1, 2, 3, 4, 5])] * 200 + [(None, [1.0] * 6)]
    same(got(whitening.whiten(frame(spark, rows + EDGE).repartition(7))), brute(rows))


def test_scales_far_apart(spark):
    rows = random_rows(2, 400, [1e7, 1e4, 30, 1, 0.02])
    same(got(whitening.whiten(frame(spark, rows))), brute(rows), close=1e-5)


def test_dependent_and_constant_dimensions(spark):
    rows = [(k, [v[0], 2 * math.floor(256 * v[0]) / 256, 5.0, v[1], v[2]]) for k, v in random_rows(3, 300, [1, 2, 3])]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    assert max(r["identity_error"] for r in found) < 1e-8
    shares = {r["component"]: r["explained"] for r in found}
    assert sum(shares.values()) == pytest.approx(1)


def test_nothing_to_whiten(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, EDGE)).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, []), (2, [])])).collect() == []


def test_other_lengths_are_left_out(spark):
    rows = random_rows(4, 50, [1, 2])
    found = whitening.whiten(frame(spark, [*rows, (77, [1.0, 2.0, 3.0]), (78, [1.0])]))
    same(got(found), brute(rows, 2))


def test_deviation_is_exact_or_null(spark):
    rows = [(1, [2.0**40, 1.0]), (2, [-(2.0**40) + 3, 2.0]), (3, [5.0, 1.0]), (4, [1e300, 0.0])]
    found = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows[:3])).where("component = 1").collect()}
    x = [[math.floor(256 * c) for c in v] for _, v in rows[:3]]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert [found[i] for i in (1, 2, 3)] == [e if e < 1 << 63 else None for e in exact]
    # Beside an entry at the end of a long's range the other dimension is below the rounding of a double.
    assert whitening.whiten(frame(spark, rows)).count() == 4


def test_registered_query(spark):
    rows = connect(SF).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    same(got(contract.queries()["op12_whitening"](spark, SF)), brute(rows))
