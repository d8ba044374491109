"""Vectorised kernels for array<double> columns (Arrow batches + numpy inside Spark tasks).

Small vector sizes stay as plain Spark expressions (``functions.columns.dot``/``sq_dist``, compiled
by whole-stage codegen). High-dimensional products against a bounded set of literal vectors
(projection vectors, key vectors) are one matrix product per Arrow batch here: unrolled expressions
of that size overwhelm code generation, and higher-order lambdas are interpreted per element.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import dot, euclid

# dim x vectors above which the numpy kernel is used instead of an unrolled expression
EXPR_LIMIT = 64
_MOST = float(np.finfo(float).max)


def usable(vec: Column) -> Column:
    """False for a null vector and for one with a null, NaN or infinite element: none can be hashed or
    compared. (NaN is greater than any number here.)"""
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | (F.abs(x.cast("double")) > F.lit(_MOST)))


def _rows(s: pd.Series, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows hold a usable vector, their matrix)."""
    # a null element arrives as NaN
    ok = np.fromiter((v is not None and np.isfinite(np.asarray(v, dtype=float)).all() for v in s.values), bool, len(s))
    return ok, np.array([np.asarray(v, dtype=float) for v in s.values[ok]]).reshape(-1, dim)


def _per_row(ok: np.ndarray, values: np.ndarray) -> pd.Series:
    out = np.empty(len(ok), object)
    for i, v in zip(np.flatnonzero(ok), values, strict=True):
        out[i] = v
    return pd.Series(out)


def _whole(v: np.ndarray) -> np.ndarray:
    """Whole numbers as int64; beyond its range its ends, as Spark's cast gives."""
    out = np.clip(v, -(2.0**63), 2.0**62).astype(np.int64)
    high = v > 2.0**62
    out[high] = np.array([min(int(x), 2**63 - 1) if x < 2.0**63 else 2**63 - 1 for x in v[high]], np.int64)
    return out


def bucket_hashes(vec: Column, vectors: Sequence[Sequence[float]], bucket_length: float) -> Column:
    """array<bigint>: floor(x . v_t / bucket_length) for each projection vector v_t; null for a
    vector that is null or holds a null or NaN, whatever the size."""
    dim = len(vectors[0])
    if dim * len(vectors) <= EXPR_LIMIT:
        return F.when(usable(vec), F.array(*[
            F.floor(dot(vec, list(v)) / F.lit(float(bucket_length))).cast("bigint") for v in vectors]))
    mat = np.asarray(vectors, dtype=float).T  # dim x tables
    bl = float(bucket_length)

    @F.pandas_udf("array<bigint>")
    def _hash(s: pd.Series) -> pd.Series:
        ok, x = _rows(s, dim)
        return _per_row(ok, _whole(np.floor((x @ mat) / bl)))

    return _hash(vec)


def key_distances(vec: Column, keys: Sequence[Sequence[float]]) -> Column:
    """array<double>: Euclidean distance of ``vec`` to each key vector (a short literal list); null
    for a vector that is null or holds a null or NaN."""
    dim = len(keys[0])
    if dim * len(keys) <= EXPR_LIMIT:
        return F.when(usable(vec), F.array(*[euclid(vec, list(k)) for k in keys]))
    km = np.asarray(keys, dtype=float)  # n_keys x dim

    @F.pandas_udf("array<double>")
    def _dist(s: pd.Series) -> pd.Series:
        ok, x = _rows(s, dim)
        return _per_row(ok, np.sqrt(((x[:, None, :] - km[None, :, :]) ** 2).sum(axis=2)))

    return _dist(vec)
