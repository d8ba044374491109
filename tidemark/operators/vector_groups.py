"""Exact distances between two tables of vectors inside groups, and groups cut to size.

Both sides are rows (vk, vec, t, b, ...): a vector's hash, the vector, and the (table, bucket) it is
searched in. ``sliced`` cuts buckets that are too large on a side into a grid of slices, ``nearest``
is the kernel of one group; ``near_vectors`` does both and keeps the best over all groups.

The kernel sieves by a matrix product in single precision, whose error is bounded, and computes exact
distances only for the pairs that may be among a request's best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Target vectors per side of one (table, bucket, slice) group; hot buckets are split to this size.
GROUP_ROWS = 16_000
# numpy elements per distance chunk inside a group (bounds task memory)
CHUNK_ELEMS = 4_000_000
# buckets over GROUP_ROWS on a side are at most rows / GROUP_ROWS; up to so many are broadcast
HOT_BROADCAST = 100_000
_MINIMA = 256  # least distances per request that bound its kk-th, in the sieve
_UNIT = 2.0**-24  # relative rounding of single precision
_MOST = 1e15  # lengths up to which squares are far from the ends of single precision


def matrix(t: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The vectors of a group as a matrix, from the Arrow list buffers."""
    flat = t.column("vec")
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)


def _sieved(q: np.ndarray, m: np.ndarray, kk: np.ndarray, digits: int, far: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """(row, column) of all pairs that may be among a row's best ``kk`` or tie with the last, and few
    others; row by row. Pairs beyond a row's ``far`` are left out. None if the lengths are beyond what the bounds hold for."""
    qq, mm = (q * q).sum(axis=1), (m * m).sum(axis=1)
    most = np.sqrt(mm.max())
    if not max(most, np.sqrt(qq.max())) < _MOST:
        return None
    n = len(m)
    # error of a squared distance: the product's terms, the rounded vectors and the rounded sums
    slack = 4 * (q.shape[1] + 8) * _UNIT * (np.sqrt(qq) + most) ** 2 + 1e-30
    d = q.astype(np.float32) @ m.astype(np.float32).T
    d *= np.float32(-2)
    d += mm.astype(np.float32)[None, :]
    d += qq.astype(np.float32)[:, None]
    kk = np.minimum(kk, n)
    minima = max(_MINIMA, 4 * int(kk.max()))
    if n >= 2 * minima:  # so many different pairs are within the kk-th of the minima
        even = n // minima * minima
        least = d[:, :even].reshape(len(q), -1, minima).min(axis=1)
        least[:, : n - even] = np.minimum(least[:, : n - even], d[:, even:])
    else:
        least = d
    last = np.sort(least, axis=1)[np.arange(len(q)), kk - 1].astype(float)
    limit = np.sqrt(np.maximum(last + slack, 0))
    if far is not None:
        limit = np.minimum(limit, far)
    limit = (limit + 2 * 10.0**-digits) ** 2 + slack
    at = np.flatnonzero(d <= np.nextafter(limit.astype(np.float32), np.float32(np.inf))[:, None])
    return at // n, at % n


def _exact(q: np.ndarray, m: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    out = np.empty(len(row))
    step = max(1, CHUNK_ELEMS // max(1, q.shape[1]))
    for i in range(0, len(row), step):
        out[i: i + step] = np.sqrt(((q[row[i: i + step]] - m[col[i: i + step]]) ** 2).sum(axis=1))
    return out


def nearest(digits: int):
    """cogroup kernel: exact distances between the item and request vectors of one group, keeping
    per request vector the best ``kk`` and every tie of the last, of what is within ``far`` (a column
    of the requests, if they have it)."""

    def fn(items: pa.Table, reqs: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(items) and len(reqs):
            m, q = matrix(items), matrix(reqs)
            ik, qk, kk = items.column("vk").to_numpy(), reqs.column("vk").to_numpy(), reqs.column("kk").to_numpy()
            far = reqs.column("far").to_numpy() if "far" in reqs.column_names else None
            chunk = max(1, CHUNK_ELEMS // len(m))
            for at in range(0, len(q), chunk):
                some, most, limit = q[at: at + chunk], kk[at: at + chunk], None if far is None else far[at: at + chunk]
                pairs = _sieved(some, m, most, digits, limit)
                row, col = np.divmod(np.arange(len(some) * len(m)), len(m)) if pairs is None else pairs
                d = _exact(some, m, row, col)
                rd = np.round(d, digits)
                order = np.lexsort((rd, row))
                first, end = (np.searchsorted(row, np.arange(len(some)), side) for side in ("left", "right"))
                cut = np.full(len(some), np.inf)  # where fewer than asked for are within the limit, all are kept
                full = end - first >= most
                cut[full] = rd[order][first[full] + most[full] - 1]
                keep = rd <= cut[row]
                if limit is not None:
                    keep &= d <= (limit + 2 * 10.0**-digits)[row]
                out.append((qk[at + row[keep]], ik[col[keep]], d[keep]))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("qk", "ik", "dist"), cols, strict=True)))

    return fn


def sliced(it: DataFrame, rq: DataFrame, group_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with their slices: a bucket of n item and r request vectors becomes
    ceil(n/g) x ceil(r/g) groups; only buckets that exceed g on a side are looked up."""
    sizes = (it.groupBy("t", "b").agg(F.count(F.lit(1)).alias("ni"))
             .join(rq.groupBy("t", "b").agg(F.count(F.lit(1)).alias("nr")), ["t", "b"]))
    hot = (sizes.where((F.col("ni") > group_rows) | (F.col("nr") > group_rows))
           .select("t", "b", F.ceil(F.col("ni") / group_rows).cast("int").alias("si"),
                   F.ceil(F.col("nr") / group_rows).cast("int").alias("sr")))
    if hot.limit(HOT_BROADCAST + 1).count() <= HOT_BROADCAST:
        hot = F.broadcast(hot)

    def side(df: DataFrame, own: str, other: str, n_own: str, n_other: str) -> DataFrame:
        df = df.join(hot, ["t", "b"], "left")
        return (df.withColumn(own, F.pmod(F.xxhash64("vk"), F.coalesce(n_own, F.lit(1))).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(n_other, F.lit(1)) - 1))).drop("si", "sr"))

    return side(it, "islice", "rslice", "si", "sr"), side(rq, "rslice", "islice", "sr", "si")


def near_vectors(iv: DataFrame, rv: DataFrame, digits: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(qk, ik, dist): of every request vector (vk, vec, kk, t, b) the best ``kk`` item vectors
    (vk, vec, t, b) of each group it is in, and every tie of the last, each pair once. Where something
    nearer is known already, requests say so by ``far``, and what is beyond is left out."""
    iv, rv = sliced(iv, rv, group_rows)
    keys = ["t", "b", "islice", "rslice"]
    near = iv.groupBy(*keys).cogroup(rv.groupBy(*keys)).applyInArrow(nearest(digits), "qk bigint, ik bigint, dist double")
    # vectors that meet in several groups are found once in each, at the same distance; one shuffle by
    # request serves this and what callers rank by request
    return near.repartition("qk").groupBy("qk", "ik").agg(F.min("dist").alias("dist"))


def best_vectors(near: DataFrame, kk: int, digits: int) -> DataFrame:
    """Of (qk, ik, dist) per request vector the best ``kk`` and every tie of the last."""
    w = Window.partitionBy("qk").orderBy(F.round("dist", digits))
    return near.withColumn("_place", F.rank().over(w)).where(F.col("_place") <= kk).drop("_place")
