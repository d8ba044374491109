"""Multi-probe search over bucketed random projections: neighbouring buckets by distance to their edge.

A bucket is an interval of a projection, so the distance from a request's projection to the bucket's
edge is no more than the distance from the request to any item in it. A request

1. probes buckets, over all tables, in the order of that distance until they hold as many vectors as
   it asks for. The k-th distance found limits the rest: no neighbour is further away;
2. probes every further bucket that a neighbour at that distance is likely to be in. Along a random
   direction a distance d shows as about ``d * N(0, 1) / sqrt(dim)``, so an item is missed in each of
   T tables with probability ``(2 - 2 Phi(z))^T`` if buckets up to ``z * d / sqrt(dim)`` are probed;
   z follows from the recall asked for.

The plain form (``similarity.recommend``) looks at a request's own buckets alone. Windows of buckets
are widened, in few rounds, only for requests that have not found enough; empty buckets cost nothing
but their place in a window, and windows end where a table's items end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.vectors import bucket_hashes
from tidemark.operators.vector_groups import matrix, near_vectors
from tidemark.session import write_table

RECALL = 0.97  # expected share of the true neighbours that are found
_WIDEN = 8  # factor between the windows of two rounds
_ROWS = 1 << 18  # buckets of a batch of keys


def reach_factor(recall: float, tables: int) -> float:
    """z such that (2 - 2 Phi(z))^tables = 1 - recall."""
    return NormalDist().inv_cdf(1 - (1 - recall) ** (1 / tables) / 2)


def _buckets(keys: DataFrame, vectors: Sequence[Sequence[float]], bucket_length: float, ends: list[tuple[int, int]],
             window: int | None, factor: float = 0.0) -> DataFrame:
    """(vk, t, b, edge, beyond): buckets around each key with the distance to their edge, ``window`` on
    each side; ``beyond`` is the least distance to a bucket outside all windows. Without ``window``
    those up to ``factor * reach``."""
    mat = np.asarray(vectors, float).T
    unit = bucket_length / np.sqrt((mat * mat).sum(axis=0))  # distance that a bucket's width stands for
    lo, hi = (np.array(x, np.int64) for x in zip(*ends, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            at = (matrix(rows) @ mat) / bucket_length
            own = np.clip(np.floor(at), lo, hi).astype(np.int64)  # the items' nearest end for keys outside
            if window is None:
                wide = factor * rows.column(2).to_numpy(zero_copy_only=False)[:, None] / unit
                first, last = (np.clip(np.floor(at + s * wide), e, f).astype(np.int64) for s, e, f in ((-1, lo, hi + 1), (1, lo - 1, hi)))
            else:
                first, last = np.maximum(own - window, lo), np.minimum(own + window, hi)
            after = np.where(last < hi, (last + 1 - at) * unit, np.inf)
            before = np.where(first > lo, (at - first) * unit, np.inf)
            beyond = np.minimum(after, before).min(axis=1)
            n = np.maximum(last - first + 1, 0)
            key, total = rows.column(0).to_numpy(), np.concatenate([[0], n.sum(axis=1).cumsum()])
            i = 0
            while i < len(rows):  # keys of a bounded number of buckets, or a single one
                j = max(i + 1, int(np.searchsorted(total, total[i] + _ROWS, side="right")) - 1)
                m = n[i:j].ravel()
                row = np.repeat(np.repeat(np.arange(i, j), n.shape[1]), m)
                t = np.repeat(np.tile(np.arange(n.shape[1]), j - i), m)
                b = np.arange(len(t)) - np.repeat(np.cumsum(m) - m, m) + first[row, t]
                edge = np.maximum(np.maximum(b - at[row, t], at[row, t] - (b + 1)), 0) * unit[t]
                yield pa.record_batch({"vk": pa.array(key[row]), "t": pa.array(t.astype(np.int32)), "b": pa.array(b),
                                       "edge": pa.array(edge), "beyond": pa.array(beyond[row])})
                i = j

    cols = ["vk", "vec"] + (["reach"] if window is None else [])
    return keys.select(cols).mapInArrow(run, "vk bigint, t int, b bigint, edge double, beyond double")


def search(items: DataFrame, keys: DataFrame, vectors: Sequence[Sequence[float]], bucket_length: float,
           recall: float = RECALL, digits: int = 9) -> DataFrame:
    """(qk, ik, dist): near item vectors of each distinct key vector (vk, vec, kk), among which are its
    best ``kk`` with the expected ``recall``. ``items`` (vk, vec) are distinct."""
    spark = items.sparkSession
    hashed = write_table(items.select("vk", "vec", F.posexplode(bucket_hashes(F.col("vec"), vectors, bucket_length)).alias("t", "b")), "probe-items")
    sizes = write_table(hashed.groupBy("t", "b").agg(F.count("*").alias("n")), "probe-buckets")
    ends = {r.t: (r.lo, r.hi) for r in sizes.groupBy("t").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).collect()}  # a row per table
    if not ends:
        return spark.createDataFrame([], "qk bigint, ik bigint, dist double")
    ends = [ends[t] for t in range(len(vectors))]
    keys = write_table(keys.select("vk", "vec", F.col("kk").cast("int").alias("kk")), "probe-keys")
    order = Window.partitionBy("vk").orderBy(F.round("edge", digits), "t", "b")  # a key's window of buckets
    left, window, parts = keys, 1, []
    while left.take(1):
        got = _buckets(left, vectors, bucket_length, ends, window).join(sizes, ["t", "b"]).join(left.select("vk", "kk"), "vk")
        got = write_table(got.withColumn("upto", F.sum("n").over(order)), "probe-window")
        chosen = got.where("upto - n < kk")
        last = chosen.groupBy("vk").agg(F.max("edge").alias("edge"), F.max("upto").alias("upto"), F.max("kk").alias("kk"), F.max("beyond").alias("beyond"))
        done = last.where("beyond = double('Infinity') OR (upto >= kk AND edge <= beyond)").select("vk")
        parts.append(write_table(chosen.join(done, "vk").select("vk", "t", "b"), "probed"))
        left = left.join(done, "vk", "left_anti")
        window *= _WIDEN
    if not parts:
        return spark.createDataFrame([], "qk bigint, ik bigint, dist double")
    first = parts[0]
    for p in parts[1:]:
        first = first.unionByName(p)

    def found(probes: DataFrame, *more: str) -> DataFrame:
        return write_table(near_vectors(hashed, keys.join(probes, "vk").select("vk", "vec", "kk", *more, "t", "b"), digits), "probe-near")

    near = found(first)
    place = F.row_number().over(Window.partitionBy("qk").orderBy("dist", "ik"))
    reach = (near.withColumn("place", place).join(keys.select(F.col("vk").alias("qk"), "kk"), "qk").where("place = kk")
             .select(F.col("qk").alias("vk"), F.col("dist").alias("reach")))
    factor = reach_factor(recall, len(vectors)) / float(np.sqrt(len(vectors[0])))
    more = _buckets(keys.join(reach, "vk"), vectors, bucket_length, ends, None, factor).select("vk", "t", "b")
    # nothing beyond the distance that limits the probes is among the best
    more = more.join(first, ["vk", "t", "b"], "left_anti").join(reach.withColumnRenamed("reach", "far"), "vk")
    return near.unionByName(found(more, "far")).groupBy("qk", "ik").agg(F.min("dist").alias("dist"))
