"""Exact nearest vectors for many keys, by pivots and the triangle inequality.

Some item vectors, drawn by their hash, are pivots; each item vector belongs to the cell of its
nearest pivot, and a cell is cut by the distance to its pivot (the radius) into rings. Of a ring its
size and its smallest and largest radius are known. For a key q, a ring of the cell of pivot p can
hold nothing nearer than

* ``d(q, p) - largest radius`` and ``smallest radius - d(q, p)``,
* ``(d(q, p)^2 - d(q, h)^2) / (2 d(p, h))``, h being the pivot nearest to q.

1. Each key searches the rings of least bound that hold as many vectors as it asks for. Its k-th
   distance there, or the one that sizes and largest radii promise, limits the rest of the search.
2. It then searches every other ring whose bound is within that limit.

Nothing within the limit is left out, so the result is exact; how much is visited depends on the
data (vectors without any structure, in many dimensions, leave little to exclude). The bounds allow
for the rounding of distances. Rings and keys that are too many for one group are cut into slices.

The driver holds the pivots and the rings: at most MAX_PIVOTS vectors and MAX_PIVOTS x RINGS rows of
four numbers, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.vector_groups import CHUNK_ELEMS, matrix, near_vectors
from tidemark.session import write_table

MAX_PIVOTS = 512
RINGS = 64
RING_ROWS = 2_000  # vectors that a ring is meant to hold, as long as RINGS allow
_SLACK = 1e-6  # relative error allowed for a distance from a matrix product


@dataclass
class Cells:
    """Pivots, the radii that cut each cell, and the rings that hold vectors."""

    pivots: np.ndarray  # pivots x dim
    cuts: np.ndarray  # pivots x (RINGS - 1), infinite where a cell has fewer rings
    ring: np.ndarray  # pivot number * RINGS + number of the ring
    size: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Distances of rows to all pivots, up to ``slack``."""
        sq = (x * x).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1)[None, :] - 2 * (x @ self.pivots.T)
        return np.sqrt(np.maximum(sq, 0))

    def slack(self, x: np.ndarray) -> np.ndarray:
        far = np.sqrt((self.pivots * self.pivots).sum(axis=1).max())
        return _SLACK * (np.sqrt((x * x).sum(axis=1)) + far)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pivot, radius, ring) of each row."""
        cell = np.zeros(len(x), np.int64)
        step = max(1, CHUNK_ELEMS // len(self.pivots))
        for i in range(0, len(x), step):
            cell[i: i + step] = self.distances(x[i: i + step]).argmin(axis=1)
        radius = np.sqrt(((x - self.pivots[cell]) ** 2).sum(axis=1))
        return cell, radius, cell * RINGS + (radius[:, None] > self.cuts[cell]).sum(axis=1)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most): distances that no vector of a ring can be below or above, rows x rings."""
        d = self.distances(x)
        cell = self.ring // RINGS
        home = d.argmin(axis=1)
        gap = self.distances(self.pivots)[home]  # between the pivots of a row's home and all others
        apart = gap > 1e-3 * (d + gap)  # pivots that nearly coincide tell nothing
        plane = np.where(apart, (d * d - (d.min(axis=1) ** 2)[:, None]) / np.where(apart, 2 * gap, 1), 0)
        at = d[:, cell]
        least = np.maximum(np.maximum(at - self.high, self.low - at), np.maximum(plane[:, cell], 0))
        return least, at + self.high


def _pivot_count(n: int) -> int:
    return int(min(MAX_PIVOTS, max(1, np.ceil(np.sqrt(n)))))


def _placed(vectors: DataFrame, cells: Cells, vec: bool) -> DataFrame:
    """(vk, cell, radius, ring) of each vector, and the vector if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                cell, radius, ring = cells.place(matrix(b))
                cols = {"vk": b.column(0), "cell": pa.array(cell), "radius": pa.array(radius), "ring": pa.array(ring)}
                yield pa.record_batch(cols | ({"vec": b.column(1)} if vec else {}))

    schema = "vk bigint, cell bigint, radius double, ring bigint"
    return vectors.select("vk", "vec").mapInArrow(run, schema + (", vec array<double>" if vec else ""))


def fit_cells(vectors: DataFrame) -> Cells | None:
    """Cells of a written table (vk, vec); None if it is empty."""
    n = vectors.count()
    if not n:
        return None
    chosen = vectors.orderBy("vk").limit(_pivot_count(n)).select("vec").collect()
    pivots = np.array([r.vec for r in chosen], float)
    none = np.zeros(0)
    cells = Cells(pivots, np.full((len(pivots), RINGS - 1), np.inf), none, none, none, none)
    share = [i / RINGS for i in range(1, RINGS)]
    for r in _placed(vectors, cells, False).groupBy("cell").agg(
            F.count("*").alias("n"), F.percentile_approx("radius", share, 1000).alias("q")).collect():
        rings = int(min(RINGS, -(-r.n // RING_ROWS)))
        at = sorted({r.q[round(i * RINGS / rings) - 1] for i in range(1, rings)})
        cells.cuts[r.cell, : len(at)] = at
    held = _placed(vectors, cells, False).groupBy("ring").agg(
        F.count("*").alias("n"), F.min("radius").alias("low"), F.max("radius").alias("high")).orderBy("ring").collect()
    cells.ring, cells.size, cells.low, cells.high = (np.array([r[i] for r in held]) for i in range(4))
    return cells


def _rings(keys: DataFrame, cells: Cells, digits: int, rest: bool) -> DataFrame:
    """(vk, vec, kk, rings): the rings that each key searches first; with ``rest`` those that it has
    to search further, given ``rings`` (searched already) and ``reach`` (the k-th distance there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CHUNK_ELEMS // max(len(cells.ring), len(cells.pivots)))
        for whole in batches:
            for i in range(0, len(whole), step):
                b = whole.slice(i, step)
                x, kk = matrix(b), b.column(2).to_numpy(zero_copy_only=False)[:, None]
                least, most = cells.bounds(x)
                if rest:
                    # so many vectors are within the largest bound of the rings of least such bounds
                    order = most.argsort(axis=1, kind="stable")
                    enough = cells.size[order].cumsum(axis=1) >= kk
                    at = np.where(enough.any(axis=1), enough.argmax(axis=1), len(cells.ring) - 1)
                    promised = np.where(enough.any(axis=1), most[np.arange(len(x)), order[np.arange(len(x)), at]], np.inf)
                    reach = b.column(4).to_numpy(zero_copy_only=False).astype(float)
                    limit = np.fmin(promised, reach) + 2 * cells.slack(x) + 2 * 10.0 ** -digits
                    take = least <= limit[:, None]
                    done, row = b.column(3).flatten().to_numpy(), np.repeat(np.arange(len(b)), b.column(3).value_lengths().to_numpy())
                    take[row, np.searchsorted(cells.ring, done)] = False
                else:
                    order = least.argsort(axis=1, kind="stable")
                    before = cells.size[order].cumsum(axis=1) - cells.size[order]
                    take = np.zeros(least.shape, bool)
                    np.put_along_axis(take, order, before < kk, axis=1)
                off = np.concatenate([[0], take.sum(axis=1).cumsum()])
                rings = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(cells.ring[np.nonzero(take)[1]], pa.int64()))
                yield pa.record_batch({"vk": b.column(0), "vec": b.column(1), "kk": b.column(2), "rings": rings})

    cols = ["vk", "vec", "kk"] + (["rings", "reach"] if rest else [])
    return keys.select(cols).mapInArrow(run, "vk bigint, vec array<double>, kk int, rings array<bigint>")


def search(vectors: DataFrame, keys: DataFrame, digits: int = 9) -> tuple[DataFrame, DataFrame]:
    """(near, visits): near (qk, ik, dist) holds, for each distinct key vector (vk, vec, kk), its best
    ``kk`` of the distinct ``vectors`` (vk, vec) and every tie of the last (more may be in it);
    visits (qk, visited) tells with how many vectors each key was compared."""
    spark = vectors.sparkSession
    vectors = write_table(vectors.select("vk", "vec"), "pivot-vectors")
    cells = fit_cells(vectors)
    if cells is None:
        return (spark.createDataFrame([], "qk bigint, ik bigint, dist double"), spark.createDataFrame([], "qk bigint, visited bigint"))
    zero = F.lit(0).alias("t")
    iv = _placed(vectors, cells, True).select("vk", "vec", zero, F.col("ring").alias("b"))

    def found(rows: DataFrame, *more: str) -> DataFrame:
        return write_table(near_vectors(iv, rows.select("vk", "vec", "kk", *more, zero, F.explode("rings").alias("b")), digits), "pivot-near")

    first = write_table(_rings(keys.withColumn("kk", F.col("kk").cast("int")), cells, digits, False), "pivot-visits")
    near = found(first)
    # rows of one key here are those of the few rings that it searched first
    w = Window.partitionBy("qk").orderBy("dist", "ik")
    reach = (near.withColumn("place", F.row_number().over(w)).join(first.select(F.col("vk").alias("qk"), "kk"), "qk")
             .where("place = kk").select(F.col("qk").alias("vk"), F.col("dist").alias("reach")))
    rest = write_table(_rings(first.join(reach, "vk", "left"), cells, digits, True), "pivot-visits")
    # nothing beyond the k-th distance of the first rings is among the best
    far = F.coalesce("reach", F.lit(float("inf"))).alias("far")
    near = near.unionByName(found(rest.join(reach, "vk", "left").select(*rest.columns, far), "far"))
    sizes = spark.createDataFrame([(int(b), int(n)) for b, n in zip(cells.ring, cells.size)], "ring bigint, n bigint")
    visits = (first.unionByName(rest).select(F.col("vk").alias("qk"), F.explode("rings").alias("ring"))
              .join(F.broadcast(sizes), "ring").groupBy("qk").agg(F.sum("n").alias("visited")))  # rings: bounded, see above
    return near, visits
