"""k-means pieces expressed with built-in Spark expressions.

Centres are k x d numbers (bounded by the model, not the data) and are inlined as literal arrays;
assignment is a projection (no join), each Lloyd update is one aggregate pass with partial
aggregation: the same data flow as MLlib's k-means, which broadcasts its centres.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import sq_dist


def nearest_centre(vec: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre (squared Euclidean); ties go to the lowest index."""
    cands = [F.struct(sq_dist(vec, list(c)).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*cands))["i"]


def initial_centres_by_hash(pts: DataFrame, id_col: str, k: int, vec_col: str = "vec") -> list[list[float]]:
    """Deterministic seeding: the vectors of the k rows with the smallest md5(id) (a distributed top-k)."""
    rows = pts.orderBy(F.md5(F.col(id_col).cast("string"))).select(vec_col).limit(k).collect()
    return [list(map(float, r[0])) for r in rows]


def lloyd(pts: DataFrame, vec_col: str, centres: Sequence[Sequence[float]], iters: int
          ) -> tuple[list[list[float]], list[int]]:
    """``iters`` Lloyd steps from the given centres. An empty cluster keeps its centre.

    Returns the final centres and, per cluster, the row count of the last assignment."""
    cur = [list(map(float, c)) for c in centres]
    d = len(cur[0])
    counts = [0] * len(cur)
    for _ in range(iters):
        stats = (pts.select(nearest_centre(F.col(vec_col), cur).alias("cid"), F.col(vec_col).alias("v"))
                 .groupBy("cid")
                 .agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("v")[j]).alias(f"m{j}") for j in range(d)])
                 .collect())  # one row per cluster: bounded by k
        counts = [0] * len(cur)
        nxt = [list(c) for c in cur]
        for r in stats:
            counts[r["cid"]] = int(r["n"])
            nxt[r["cid"]] = [float(r[f"m{j}"]) for j in range(d)]
        cur = nxt
    return cur, counts


def centres_frame(spark: SparkSession, centres: Sequence[Sequence[float]], counts: Sequence[int],
                  digits: int = 6) -> DataFrame:
    d = len(centres[0])
    schema = T.StructType([T.StructField("cluster", T.LongType()), T.StructField("n", T.LongType())]
                          + [T.StructField(f"c{j}", T.DoubleType()) for j in range(d)])
    rows = [(i, int(counts[i]), *[float(v) for v in c]) for i, c in enumerate(centres)]
    df = spark.createDataFrame(rows, schema)
    return df.select("cluster", "n", *[F.round(f"c{j}", digits).alias(f"c{j}") for j in range(d)])
