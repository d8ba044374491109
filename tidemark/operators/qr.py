"""Least squares by QR: a triangle per partition, triangles merged up a tree, rank by singular values.

Co-moments (``regression.fit_ols``) square the condition of the features and so lose half of the
digits; features that are nearly collinear, or large against their spread, then give wrong
coefficients. Here each partition reduces its rows of (1, features, label) to a triangle of k + 2
rows, chunk by chunk; up to FAN triangles are stacked and reduced again until one is left. Only
triangles are shuffled, and none reaches the driver. The last one is solved by singular values of its
columns scaled to unit length; directions below RANK_TOL of the largest are left out (the least
coefficients, in that scale, that fit best) and ``rank`` counts the others, the intercept's included.

Rows with a null, NaN or infinite feature or label are left out. No rows give no row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col_
from tidemark.session import write_table

FAN = 64
RANK_TOL = 1e-13
_CHUNK = 1 << 14


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The square triangle of a QR factorisation, zero rows where there are too few."""
    r = np.linalg.qr(rows, mode="r")
    return np.concatenate([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def _solve(r: np.ndarray, n: int) -> dict:
    k = len(r) - 2
    a, c = r[:-1, :-1], r[:-1, -1]
    scale = np.sqrt((a * a).sum(axis=0))
    scale[scale == 0] = 1
    u, s, vt = np.linalg.svd(a / scale)
    rank = int((s > RANK_TOL * s[0]).sum())
    b = (vt[:rank].T @ ((u.T @ c)[:rank] / s[:rank])) / scale
    sse = float(r[-1, -1] ** 2 + ((c - a @ b) ** 2).sum())
    total = float((r[1:, -1] ** 2).sum())  # the first column is the intercept's: what is left is about the mean
    return {"n": n, "rank": rank, **{f"b{i}": float(b[i]) for i in range(k + 1)},
            "r2": 1 - sse / total if total > 0 else float("nan"), "rmse": float(np.sqrt(sse / n))}


def fit_qr(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row: n, rank, b0 (intercept), b1 ... bk, r2, rmse."""
    m = len(features) + 2
    names = [f"x{i}" for i in range(m - 1)]
    rows = df.select(*[col_(c).cast("double").alias(x) for c, x in zip([*features, label], names, strict=True)])
    for x in names:  # a null is dropped as well
        rows = rows.where(F.abs(x) <= float(np.finfo(float).max))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n, node = np.zeros((0, m)), 0, 0
        for b in batches:
            node = b.column(m - 1)[0].as_py() if len(b) else node
            x = np.column_stack([np.ones(len(b)), *(b.column(i).to_numpy() for i in range(m - 1))])
            for i in range(0, len(x), _CHUNK):
                r = _triangle(np.concatenate([r, x[i: i + _CHUNK]]))
            n += len(x)
        if n:
            yield pa.record_batch({"node": pa.array([node], pa.int32()), "n": pa.array([n], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    def merge(t: pa.Table) -> tuple[np.ndarray, int]:
        parts = [np.frombuffer(x, float).reshape(m, m) for x in t.column("r").to_pylist()]
        return _triangle(np.concatenate(parts)), sum(t.column("n").to_pylist())

    def up(key: tuple, t: pa.Table) -> pa.Table:
        r, n = merge(t)
        return pa.table({"node": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([n], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    def last(t: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_solve(*merge(t))])

    shape = "node int, n bigint, r binary"
    tree = write_table(rows.withColumn("node", F.spark_partition_id()).mapInArrow(reduce, shape), "qr")
    while (tree.agg(F.max("node")).first()[0] or 0) >= FAN:
        tree = write_table(tree.withColumn("node", F.expr(f"node DIV {FAN}")).groupBy("node").applyInArrow(up, shape), "qr")
    out = "n bigint, rank bigint, " + ", ".join(f"b{i} double" for i in range(m - 1)) + ", r2 double, rmse double"
    return tree.groupBy(F.lit(0).alias("all")).applyInArrow(last, out)  # at most FAN triangles
