"""Ordinary least squares (the reference's price regression: regParam 0, intercept, squared loss).

The fit is a one-pass aggregate of sufficient statistics (count, means, population co-moments via
Spark's numerically stable ``covar_pop``/``var_pop``) with partial aggregation before the shuffle;
the k x k system per group is solved in ``applyInPandas`` (one tiny row per group, so the solve is
distributed over groups and nothing passes through the driver). The result is a coefficient table
``(group..., n, b0, b1..bk, r2, rmse)``.

For categorical features (all the reference's features are label-map ordinals) the cumulative
"model i <- sets 1..i" fit pre-aggregates the data by (set, category combination) first, so only
that small table is replicated per model and label maps are refitted per model from its counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col_
from tidemark.operators.labels import INLINE_LABELS, rank_labels, stack_values
from tidemark.operators.ordinal import with_ntile
from tidemark.session import write_table


def _moment_names(k: int) -> list[str]:
    names = ["n"] + [f"mx{i}" for i in range(k)] + ["my"]
    names += [f"cxx{i}_{j}" for i in range(k) for j in range(i, k)]
    names += [f"cxy{i}" for i in range(k)] + ["vyy"]
    return names


def ols_moments(df: DataFrame, features: Sequence[str], label: str,
                group_cols: Sequence[str] = ()) -> DataFrame:
    """One aggregate pass: n, means, co-moments of features and label per group."""
    xs = [col_(c).cast("double") for c in features]
    y = col_(label).cast("double")
    k = len(xs)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(x).alias(f"mx{i}") for i, x in enumerate(xs)] + [F.avg(y).alias("my")]
    aggs += [F.covar_pop(xs[i], xs[j]).alias(f"cxx{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [F.covar_pop(x, y).alias(f"cxy{i}") for i, x in enumerate(xs)] + [F.var_pop(y).alias("vyy")]
    if group_cols:
        return df.groupBy(*[col_(g) for g in group_cols]).agg(*aggs)
    return df.agg(*aggs)


def _solve_row(r: pd.Series, k: int) -> dict:
    s = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            s[i, j] = s[j, i] = r[f"cxx{i}_{j}"]
    c = np.array([r[f"cxy{i}"] for i in range(k)], dtype=float)
    beta = np.linalg.lstsq(s, c, rcond=None)[0] if k else np.zeros(0)
    mx = np.array([r[f"mx{i}"] for i in range(k)], dtype=float)
    b0 = float(r["my"] - beta @ mx)
    sse_n = float(r["vyy"] - beta @ c)
    vyy = float(r["vyy"])
    out = {"n": int(r["n"]), "b0": b0}
    out.update({f"b{i + 1}": float(beta[i]) for i in range(k)})
    out["r2"] = (1.0 - sse_n / vyy) if vyy > 0 else float("nan")
    out["rmse"] = float(np.sqrt(max(sse_n, 0.0)))
    return out


def solve_ols(moments: DataFrame, k: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """Solve the normal equations per group (min-norm for a singular system: constant column -> 0)."""
    groups = list(group_cols)
    m = moments
    if not groups:
        m = m.withColumn("_g", F.lit(0))
        groups_eff = ["_g"]
    else:
        groups_eff = groups
    gtypes = {f.name: f.dataType.simpleString() for f in m.schema.fields}
    schema = ", ".join([f"`{g}` {gtypes[g]}" for g in groups_eff] + ["n bigint", "b0 double"]
                       + [f"b{i + 1} double" for i in range(k)] + ["r2 double", "rmse double"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            d = {g: r[g] for g in groups_eff}
            d.update(_solve_row(r, k))
            rows.append(d)
        return pd.DataFrame(rows, columns=groups_eff + ["n", "b0"] + [f"b{i + 1}" for i in range(k)] + ["r2", "rmse"])

    out = m.groupBy(*groups_eff).applyInPandas(solve, schema)
    return out.drop("_g") if not groups else out


def fit_ols(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return solve_ols(ols_moments(df, features, label, group_cols), len(features), group_cols)


@dataclass
class LinearModel:
    """Fitted coefficients (k + 1 numbers, so holding them on the driver is bounded)."""

    features: list[str]
    intercept: float
    coefficients: list[float]

    @classmethod
    def from_fit(cls, fit: DataFrame, features: Sequence[str]) -> "LinearModel":
        r = fit.first()
        return cls(list(features), float(r["b0"]), [float(r[f"b{i + 1}"]) for i in range(len(features))])

    def prediction(self) -> Column:
        e = F.lit(self.intercept)
        for c, b in zip(self.features, self.coefficients):
            e = e + F.lit(b) * col_(c).cast("double")
        return e

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction())


def cumulative_categorical_ols(df: DataFrame, cats: Sequence[str], label: str, order_col: str,
                               n_sets: int = 3, num_partitions: int | None = None) -> DataFrame:
    """Model m <- rows of equal-count sets 1..m (by ``order_col``), label maps refitted per model,
    features = ordinals of ``cats`` in that model's maps. Returns (model_id, n, b0, b1..bk, r2, rmse)."""
    k = len(cats)
    y = col_(label).cast("double")
    tiles = with_ntile(df.select(col_(order_col), *[col_(c) for c in cats], y.alias("_y")),
                       [order_col], n_sets, out="set_id", num_partitions=num_partitions)
    # pre-aggregate: one row per (set, category combination); nulls are kept as their own value
    combos = tiles.groupBy("set_id", *cats).agg(
        F.count(F.lit(1)).alias("cn"), F.avg("_y").alias("cy"), (F.var_pop("_y") * F.count(F.lit(1))).alias("cm2"))
    mc = combos.withColumn("model_id", F.explode(F.sequence(F.col("set_id"), F.lit(n_sets)))).drop("set_id")
    mc = write_table(mc, "set-combinations")  # read for the maps, the means and the moments
    # label maps per model from the combination counts: every column in one stacked aggregate
    cnt = write_table(stack_values(mc, cats, extra=["model_id", "cn"])
                      .groupBy("model_id", "column", "label").agg(F.sum("cn").alias("n")), "label-counts")
    sizes = {(int(r["model_id"]), r["column"]): int(r["k"])  # one row per (model, column)
             for r in cnt.groupBy("model_id", "column").agg(F.count(F.lit(1)).alias("k")).collect()}
    ranked = rank_labels(cnt, ["model_id"], largest=max(sizes.values(), default=0))
    models = range(1, n_sets + 1)
    if max(sizes.values(), default=0) <= INLINE_LABELS:
        maps: dict[tuple[int, str], dict[str, int]] = {}
        for r in ranked.select("model_id", "column", "label", "index").collect():  # bounded by the check
            maps.setdefault((int(r["model_id"]), r["column"]), {})[r["label"]] = int(r["index"])
        for c in cats:
            e = None
            for m in models:
                pairs = [x for lbl, i in maps.get((m, c), {}).items() for x in (F.lit(lbl), F.lit(float(i)))]
                hit = F.try_element_at(F.create_map(*pairs), col_(c).cast("string")) if pairs else F.lit(None)
                v = F.coalesce(hit.cast("double"), F.lit(float(sizes.get((m, c), 0))))
                e = F.when(F.col("model_id") == m, v) if e is None else e.when(F.col("model_id") == m, v)
            mc = mc.withColumn(f"x_{c}", e)
    else:
        ranked = write_table(ranked, "label-maps")
        for c in cats:
            m = ranked.where(F.col("column") == c).select(
                F.col("model_id").alias("_m"), F.col("label").alias(f"_l_{c}"), F.col("index").cast("double").alias(f"_x_{c}"))
            unseen = F.create_map(*[x for mid in models for x in (F.lit(mid), F.lit(float(sizes.get((mid, c), 0))))])
            mc = (mc.join(m, (F.col("model_id") == F.col("_m")) & (col_(c).cast("string") == F.col(f"_l_{c}")), "left")
                  .withColumn(f"x_{c}", F.coalesce(F.col(f"_x_{c}"), unseen[F.col("model_id")]))
                  .drop("_m", f"_l_{c}", f"_x_{c}"))
    xs = [f"x_{c}" for c in cats]
    # weighted means per model: a partial aggregate (one row per model, so the broadcast is bounded
    # by n_sets), not a window, which would put all combinations of a model in one task
    tot = F.sum("cn")
    means = mc.groupBy("model_id").agg(
        *[(F.sum(F.col("cn") * F.col(x)) / tot).alias(f"mx{i}") for i, x in enumerate(xs)],
        (F.sum(F.col("cn") * F.col("cy")) / tot).alias("my"))
    centered = mc.select("model_id", "cn", "cy", "cm2", *xs).join(F.broadcast(means), "model_id")
    dx = [F.col(x) - F.col(f"mx{i}") for i, x in enumerate(xs)]
    dy = F.col("cy") - F.col("my")
    aggs = [F.sum("cn").alias("n")] + [F.first(f"mx{i}").alias(f"mx{i}") for i in range(k)] + [F.first("my").alias("my")]
    aggs += [(F.sum(F.col("cn") * dx[i] * dx[j]) / F.sum("cn")).alias(f"cxx{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [(F.sum(F.col("cn") * dx[i] * dy) / F.sum("cn")).alias(f"cxy{i}") for i in range(k)]
    aggs += [((F.sum("cm2") + F.sum(F.col("cn") * dy * dy)) / F.sum("cn")).alias("vyy")]
    moments = centered.groupBy("model_id").agg(*aggs)
    return solve_ols(moments, k, ["model_id"])
