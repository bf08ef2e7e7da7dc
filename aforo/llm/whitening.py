"""Whitening of embeddings by shifted CholeskyQR.

The centred rows of the fit list are orthogonalised in passes. A pass solves every row against the triangular factors
found so far, adds up a Gram matrix per task and over the tasks, and takes its Cholesky factor, shifted while the
matrix is near singular. The factors multiplied give R of a QR decomposition of the centred rows; R's singular
vectors are the components. Only sums and matrices of dimension x dimension reach the driver, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import Staging, tidied

COMPONENTS = 4
SCALE = 256
PASSES = 8
EPS = float(np.finfo(np.float64).eps) / 2
# Shares of the greatest singular value: a direction below RANK holds nothing but rounding.
RANK = 1e-14
LONG, LARGE = 2.0**63, 1 << 61
ROWS = 20_000


@dataclass(frozen=True)
class Whitening:
    """``n`` fitted vectors with sums per dimension; column j of ``vectors`` is component j + 1.

    ``values`` are the components' variances, ``explained`` their shares of the total variance.
    """

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def _scaled(column: pa.Array, scale: float) -> list[bytes | None]:
    """Each vector's entries times ``scale``, rounded down, as 64-bit integers; None for unusable vectors."""
    out: list[bytes | None] = []
    for value in column:
        entries = value.values
        if entries is None or entries.null_count:
            out.append(None)
            continue
        numbers = entries.to_numpy(zero_copy_only=False).astype(np.float64)
        if not np.isfinite(numbers).all():
            out.append(None)
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            whole = np.floor(numbers * scale)
            longs = np.maximum(whole, -LONG).astype(np.int64)
        out.append(np.where(whole >= LONG, np.iinfo(np.int64).max, longs).tobytes())
    return out


@tidied
def _vectors(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [x for x in _scaled(batch.column(0), scale) if x is not None]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["x"])


def _matrix(rows: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.int64).reshape(-1, size)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """The fit list's rows in matrices of bounded height."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield _matrix(batch.column(0).slice(at, ROWS).to_pylist(), size)


@tidied
def _sum(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = [0] * size
    for x in _blocks(batches, size):
        # In two halves, so that no sum of a block leaves 64 bits.
        high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
        total = [t + (h << 32) + lo for t, h, lo in zip(total, high, low)]
    dims = pa.array(range(size), pa.int32())
    yield pa.RecordBatch.from_arrays(
        [dims, pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "total"]
    )


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - sums / n`` in doubles; the whole part is taken off in integers, so close numbers stay apart."""
    whole = [s // n for s in sums]
    part = np.array([(s - w * n) / n for s, w in zip(sums, whole)])
    if x.size and max(int(x.max()), -int(x.min())) >= LARGE:
        return (x.astype(object) - np.array(whole, object)).astype(np.float64) - part
    return (x - np.array(whole, np.int64)).astype(np.float64) - part


def _solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular matrix, by substitution."""
    out = np.empty_like(rows)
    for j in range(len(upper)):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


@tidied
def _products(
    batches: Iterator[pa.RecordBatch], size: int, turned: Callable[[np.ndarray], np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """This task's part of the product of the turned rows with themselves, a row per dimension."""
    total = None
    for x in _blocks(batches, size):
        rows = turned(x)
        total = rows.T @ rows if total is None else total + rows.T @ rows
    if total is not None:
        number = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(total)), pa.int32()),
                pa.array([number] * len(total), pa.int32()),
                pa.array([row.tobytes() for row in total], pa.binary()),
            ],
            names=["dim", "task", "row"],
        )


def _added(group: pa.Table) -> pa.Table:
    """One dimension's row over all tasks, added in the order of the tasks."""
    group = group.sort_by("task")
    total = sum(np.frombuffer(b, np.float64) for b in group.column("row").to_pylist())
    return pa.table({"dim": group.column("dim").slice(0, 1), "row": pa.array([total.tobytes()], pa.binary())})


def _gram(fit: DataFrame, size: int, turned: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    parts = fit.mapInArrow(partial(_products, size=size, turned=turned), "dim int, task int, row binary")
    rows = parts.groupBy("dim").applyInArrow(_added, "dim int, row binary").collect()
    return np.array([np.frombuffer(r["row"], np.float64) for r in sorted(rows, key=lambda r: r["dim"])])


def _triangular(gram: np.ndarray, n: int) -> np.ndarray:
    """The Cholesky factor, with a shift where the matrix is too close to a singular one."""
    size, values = len(gram), np.linalg.eigvalsh(gram)
    shift = 0.0
    if values[0] < 1e-8 * values[-1]:
        shift = min(11 * (n * size + size * (size + 1)) * EPS, 1e-6) * values[-1]
    return np.linalg.cholesky(gram + shift * np.eye(size)).T


def _settled(gram: np.ndarray) -> bool:
    """True when the turned rows are orthonormal, but for directions in which there are none."""
    if np.abs(gram - np.eye(len(gram))).max() <= 1e-11:
        return True
    values = np.linalg.eigvalsh(gram)
    empty = values < 1e-28
    return bool(empty.any() and (values[~empty] > 0.5).all())


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> Whitening | None:
    """Fit on each distinct scaled vector once; None where no direction varies.

    Vectors that are NULL or hold a NULL or non-finite entry are left out, and those of another length than the most
    frequent one (of equally frequent ones the greatest). The fit list is staged and read once per pass.
    """
    stage = Staging(df.sparkSession, "whitening")
    found = df.select(F.col(f"`{vector}`").cast("array<double>").alias("v")).mapInArrow(
        partial(_vectors, scale=scale), "x binary"
    )
    listed = stage.table(found.distinct(), "fit")
    try:
        lengths = listed.groupBy(F.octet_length("x").alias("bytes")).count()
        most = lengths.orderBy(F.desc("count"), F.desc("bytes")).first()
        if most is None or most["bytes"] == 0:
            return None
        n, size = most["count"], most["bytes"] // 8
        listed = listed.where(F.octet_length("x") == most["bytes"])
        totals = listed.mapInArrow(partial(_sum, size=size), "dim int, total decimal(38,0)")
        totals = totals.groupBy("dim").agg(F.sum("total").alias("total")).collect()
        sums = tuple(int(r["total"]) for r in sorted(totals, key=lambda r: r["dim"]))
        return _model(listed, n, sums, components)
    finally:
        stage.drop()


def _model(listed: DataFrame, n: int, sums: tuple[int, ...], components: int) -> Whitening | None:
    size, factors = len(sums), []

    def turned(x: np.ndarray) -> np.ndarray:
        rows = _centred(x, n, sums)
        for upper in factors:
            rows = _solved(rows, upper)
        return rows

    gram = _gram(listed, size, turned)
    if not gram.any():
        return None
    for _ in range(PASSES):
        factors.append(_triangular(gram, n))
        gram = _gram(listed, size, turned)
        if _settled(gram):
            break
    combined = np.linalg.multi_dot([*factors[::-1], np.eye(size)])
    # Rows without any share of a direction leave a zero in the last Gram matrix, which its root carries over.
    values, turns = np.linalg.eigh(gram)
    root = np.sqrt(np.maximum(values, 0))[:, None] * turns.T
    _, singular, vectors = np.linalg.svd(root @ combined)
    rank = int((singular > singular[0] * RANK * size).sum())
    kept = min(components, rank)
    variances = singular**2 / n
    vectors, values = np.ascontiguousarray(vectors[:kept].T), variances[:kept]

    def whitened(x: np.ndarray) -> np.ndarray:
        # A column of ones carries the sums along, so that the covariance is taken about the mean.
        rows = _centred(x, n, sums) @ vectors / np.sqrt(values)
        return np.hstack([rows, np.ones((len(rows), 1))])

    moments = _gram(listed, size, whitened) / n
    mean = moments[:kept, kept]
    error = np.abs(moments[:kept, :kept] - np.outer(mean, mean) - np.eye(kept)).max()
    return Whitening(n, sums, vectors, values, values / variances.sum(), float(error))


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - sums) ** 2``, exact; None beyond a long."""
    bound = n * max(int(x.max()), -int(x.min())) + max(abs(s) for s in sums) if x.size else 0
    if bound * bound * len(sums) < 1 << 63:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(axis=1).tolist()
    away = n * x.astype(object) - np.array(sums, object)
    exact = (away * away).sum(axis=1).tolist()
    return [e if e < 1 << 63 else None for e in exact]


@tidied
def _whiten(batches: Iterator[pa.RecordBatch], model: Whitening, scale: float) -> Iterator[pa.RecordBatch]:
    size, kept = model.vectors.shape
    for batch in batches:
        found = _scaled(batch.column(1), scale)
        usable = [i for i, x in enumerate(found) if x is not None and len(x) == 8 * size]
        x = _matrix([found[i] for i in usable], size)
        white = _centred(x, model.n, model.sums) @ model.vectors / np.sqrt(model.values)
        m = len(usable)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(np.repeat(usable, kept), pa.int64())),
                pa.array(np.tile(np.arange(1, kept + 1), m), pa.int32()),
                pa.array(np.full(m * kept, model.n), pa.int64()),
                pa.array([d for d in _deviations(x, model.n, model.sums) for _ in range(kept)], pa.int64()),
                pa.array(white.reshape(-1)),
                pa.array(np.tile(model.explained, m)),
                pa.array(np.full(m * kept, model.identity_error)),
            ],
            names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )


WHITENED = (
    "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
    model: Whitening | None = None,
) -> DataFrame:
    """Per usable row and component, numbered from 1 by falling variance: ``n`` vectors fitted, ``deviation`` (the sum
    over the dimensions of ``(n * x - sums) ** 2``), the whitened coordinate, the component's share of the variance,
    and the greatest entry of the whitened fit list's covariance less the identity.

    x is the vector times ``scale``, rounded down; an entry beyond a long takes the nearest end of its range, a
    deviation beyond it is NULL. Rows that ``fit`` leaves out have no result; repeated rows and NULL or repeated
    keys each have their own. Directions without variance are no components, so there may be fewer than
    ``components``, and none for an empty table or equal vectors. Other columns are not read.
    """
    model = model or fit(df, vector, components, scale)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    if model is None:
        empty = df.sparkSession.createDataFrame([], WHITENED)
        return empty.withColumnRenamed("id", key)
    return rows.mapInArrow(partial(_whiten, model=model, scale=scale), WHITENED).withColumnRenamed("id", key)
