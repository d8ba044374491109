"""Catalogue: price regression (A4, A5, W7, S6/K4), k-means."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.columns import sq_dist
from tidemark.operators import kmeans as km
from tidemark.operators import models as mdl
from tidemark.operators import requests as rq
from tidemark.operators.labels import LabelMaps
from tidemark.operators.qr import fit_qr
from tidemark.operators.regression import LinearModel, cumulative_categorical_ols, fit_ols
from tidemark.plans import fixtures as fx
from tidemark.plans import q_requests as qr
from tidemark.plans.registry import TX_SQL, index_join_sql, register, tx_maps_sql
from tidemark.session import scratch_path, write_table

CATS = fx.TX_CATS
# The two-feature regression used by the SQL-checked queries.
LR_CATS = ["property_type", "duration"]
LR_X = [f"{c}_index" for c in LR_CATS]

_SEL, _JOIN = index_join_sql(LR_CATS, "tx")
_IX = f"""{TX_SQL}, {tx_maps_sql(LR_CATS)},
ix AS (SELECT tx.id, tx.price, {_SEL} FROM tx {_JOIN})"""
_MOM = """m AS (SELECT count(*) AS n, avg(property_type_index) AS mx1, avg(duration_index) AS mx2, avg(price) AS my,
  var_pop(property_type_index) AS a, covar_pop(property_type_index, duration_index) AS b, var_pop(duration_index) AS d,
  covar_pop(property_type_index, price) AS e, covar_pop(duration_index, price) AS f, var_pop(price) AS vyy FROM ix),
c AS (SELECT *, (e * d - b * f) / (a * d - b * b) AS b1, (a * f - b * e) / (a * d - b * b) AS b2 FROM m)"""


def _tx_indexed(spark, sf):
    t = fx.tx(spark, sf)
    return LabelMaps.fit(t, LR_CATS).transform(t)


@register("lr_fit_coefficients", sql=f"""WITH {_IX}, {_MOM}
SELECT n, round(my - b1 * mx1 - b2 * mx2, 4) AS b0, round(b1, 4) AS b1, round(b2, 4) AS b2 FROM c""")
def lr_fit_coefficients(spark, sf):
    fit = fit_ols(_tx_indexed(spark, sf), LR_X, "price")
    return fit.select("n", *[F.round(b, 4).alias(b) for b in ("b0", "b1", "b2")])


@register("lr_fit_quality", sql=f"""WITH {_IX}, {_MOM}
SELECT n, round(1 - (vyy - b1 * e - b2 * f) / vyy, 8) AS r2, round(sqrt(vyy - b1 * e - b2 * f), 4) AS rmse FROM c""")
def lr_fit_quality(spark, sf):
    fit = fit_ols(_tx_indexed(spark, sf), LR_X, "price")
    return fit.select("n", F.round("r2", 8).alias("r2"), F.round("rmse", 4).alias("rmse"))


@register("lr_fit_stable", sql=f"""WITH {_IX}, {_MOM}
SELECT n, CAST(3 AS BIGINT) AS rank, round(my - b1 * mx1 - b2 * mx2, 4) AS b0, round(b1, 4) AS b1, round(b2, 4) AS b2,
  round(1 - (vyy - b1 * e - b2 * f) / vyy, 8) AS r2, round(sqrt(vyy - b1 * e - b2 * f), 4) AS rmse FROM c""")
def lr_fit_stable(spark, sf):
    """The regression by QR per partition, triangles merged up a tree."""
    fit = fit_qr(_tx_indexed(spark, sf), LR_X, "price")
    return fit.select("n", "rank", *[F.round(c, d).alias(c) for c, d in (("b0", 4), ("b1", 4), ("b2", 4), ("r2", 8), ("rmse", 4))])


_PRED_SQL = f"""WITH {_IX}, {_MOM}
SELECT ix.id, round((SELECT my - b1 * mx1 - b2 * mx2 FROM c) + (SELECT b1 FROM c) * property_type_index
                    + (SELECT b2 FROM c) * duration_index, 2) AS prediction FROM ix"""


@register("lr_predict", sql=_PRED_SQL)
def lr_predict(spark, sf):
    ix = _tx_indexed(spark, sf)  # read twice (fit, score) rather than pinned in executor storage
    model = LinearModel.from_fit(fit_ols(ix, LR_X, "price"), LR_X)
    return model.transform(ix).select("id", F.round("prediction", 2).alias("prediction"))


@register("model_roundtrip_predict", sql=_PRED_SQL)
def model_roundtrip_predict(spark, sf):
    t = fx.tx(spark, sf)
    path = scratch_path(spark, "price-model")
    mdl.save(mdl.fit_price_pipeline(t, LR_CATS, "price"), f"{path}/pipeline")
    mdl.save_feature_list(spark, LR_CATS, f"{path}/feature_columns")
    cols = mdl.load_feature_list(spark, f"{path}/feature_columns")
    loaded = mdl.load(f"{path}/pipeline")
    return loaded.transform(t.select("id", *cols)).select("id", F.round("prediction", 2).alias("prediction"))


# the price endpoint over a table of requests: every transaction as a request row with some
# features null; a request missing a model feature is refused with the reference's message, the
# others are scored by the model fitted on the table (label maps + OLS)
_R_SEL, _R_JOIN = index_join_sql(LR_CATS, "v")
_MISSING_N = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in LR_CATS)
_MISSING_TXT = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in LR_CATS) + ")"


@register("predict_price_requests", sql=f"""WITH {_IX}, {_MOM}, {qr.request_rows_sql("tx")},
v AS (SELECT request_id, {', '.join(LR_CATS)}, {_MISSING_N} AS missing_n, {_MISSING_TXT} AS missing_txt FROM req),
rix AS (SELECT v.request_id, v.missing_n, v.missing_txt, {_R_SEL} FROM v {_R_JOIN})
SELECT request_id, CASE WHEN missing_n = 0 THEN 'ok' ELSE 'invalid' END AS status,
  CASE WHEN missing_n > 0 THEN '{rq.MISSING_PREFIX}' || missing_txt END AS error,
  CASE WHEN missing_n = 0 THEN round((SELECT my - b1 * mx1 - b2 * mx2 FROM c) + (SELECT b1 FROM c) * property_type_index
                                     + (SELECT b2 FROM c) * duration_index, 2) END AS prediction
FROM rix""")
def predict_price_requests(spark, sf):
    t = fx.tx(spark, sf)
    maps = LabelMaps.fit(t, LR_CATS)
    model = LinearModel.from_fit(fit_ols(maps.transform(t), LR_X, "price"), LR_X)
    checked = rq.validate(qr.request_rows(t).select("request_id", *LR_CATS), LR_CATS)
    scored = model.transform(maps.transform(checked))
    return scored.select("request_id", "status", "error",
                         F.when(F.col("status") == "ok", F.round("prediction", 2)).alias("prediction"))


def _cum_sql(cats: list[str]) -> str:
    long = "\n    UNION ALL ".join(f"SELECT model_id, '{c}' AS col, {c} AS label FROM mt" for c in cats)
    joins = "\n".join(
        f"JOIN maps m{i} ON m{i}.model_id = mt.model_id AND m{i}.col = '{c}' AND m{i}.label = mt.{c}"
        for i, c in enumerate(cats))
    return f"""WITH {TX_SQL},
t AS (SELECT *, ntile(3) OVER (ORDER BY id) AS set_id FROM tx),
mt AS (SELECT t.*, CAST(m.model_id AS BIGINT) AS model_id FROM t JOIN (SELECT unnest([1, 2, 3]) AS model_id) m ON t.set_id <= m.model_id),
maps AS (SELECT model_id, col, label, row_number() OVER (PARTITION BY model_id, col ORDER BY n DESC, label) - 1 AS idx
  FROM (SELECT model_id, col, label, count(*) AS n FROM (
    {long}) GROUP BY ALL)),
ix AS (SELECT mt.model_id, mt.price, m0.idx AS x1, m1.idx AS x2 FROM mt
{joins}),
m AS (SELECT model_id, count(*) AS n, avg(x1) AS mx1, avg(x2) AS mx2, avg(price) AS my,
  var_pop(x1) AS a, covar_pop(x1, x2) AS b, var_pop(x2) AS d, covar_pop(x1, price) AS e, covar_pop(x2, price) AS f
  FROM ix GROUP BY model_id),
c AS (SELECT *, (e * d - b * f) / (a * d - b * b) AS b1, (a * f - b * e) / (a * d - b * b) AS b2 FROM m)
SELECT model_id, n, round(my - b1 * mx1 - b2 * mx2, 4) AS b0, round(b1, 4) AS b1, round(b2, 4) AS b2 FROM c"""


def lr_fit_cumulative_df(spark, sf):
    fit = cumulative_categorical_ols(fx.tx(spark, sf), LR_CATS, "price", "id", n_sets=3)
    return fit.select(F.col("model_id").cast("bigint").alias("model_id"), "n",
                      *[F.round(b, 4).alias(b) for b in ("b0", "b1", "b2")])


register("lr_fit_cumulative", sql=_cum_sql(LR_CATS))(lr_fit_cumulative_df)


# ---- k-means ----------------------------------------------------------------------------------
# K-means features (three label ordinals and the price in units of 100,000),
# k = 3, 4 Lloyd iterations, and the centres used by the assignment query.
KM_CATS = ["property_type", "duration", "county"]
KM_K, KM_ITERS = 3, 4
KM_CENTRES = [[0.0, 0.0, 0.0, 1.0], [2.0, 2.0, 2.0, 2.5], [4.0, 4.0, 4.0, 4.0]]


def _km_points(spark, sf):
    t = fx.tx(spark, sf)
    ix = LabelMaps.fit(t, KM_CATS).transform(t)
    return ix.select("id", "price", F.array(*[F.col(f"{c}_index") for c in KM_CATS],
                                            (F.col("price") / 100000.0)).alias("vec"))


_KSEL, _KJOIN = index_join_sql(KM_CATS, "tx")
_KPTS = f"""{TX_SQL}, {tx_maps_sql(KM_CATS)},
pts AS (SELECT id, price, [{', '.join(f'{c}_index' for c in KM_CATS)}, price / 100000.0] AS vec FROM (
  SELECT tx.id, tx.price, {_KSEL} FROM tx {_KJOIN}))"""


def _lloyd_sql() -> str:
    parts = [f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR))) - 1 AS BIGINT) AS cid, vec
  FROM pts ORDER BY md5(CAST(id AS VARCHAR)) LIMIT {KM_K})"""]
    for t in range(1, KM_ITERS + 1):
        parts.append(f"""a{t} AS (SELECT p.id, p.vec, (SELECT c.cid FROM c{t - 1} c
    ORDER BY list_reduce(list_transform(range(1, 5), lambda i: (p.vec[i] - c.vec[i]) * (p.vec[i] - c.vec[i])), lambda x, y: x + y), c.cid LIMIT 1) AS cid
  FROM pts p)""")
        parts.append(f"""c{t} AS (SELECT c.cid, coalesce(g.vec, c.vec) AS vec FROM c{t - 1} c LEFT JOIN (
    SELECT cid, [avg(vec[1]), avg(vec[2]), avg(vec[3]), avg(vec[4])] AS vec FROM a{t} GROUP BY cid) g ON g.cid = c.cid)""")
    body = ",\n".join(parts)
    return f"""WITH {_KPTS},
{body}
SELECT c.cid AS cluster, coalesce(n.n, 0) AS n,
  round(c.vec[1], 6) AS c0, round(c.vec[2], 6) AS c1, round(c.vec[3], 6) AS c2, round(c.vec[4], 6) AS c3
FROM c{KM_ITERS} c LEFT JOIN (SELECT cid, count(*) AS n FROM a{KM_ITERS} GROUP BY cid) n ON n.cid = c.cid"""


@register("kmeans_lloyd_step", sql=_lloyd_sql())
def kmeans_lloyd_step(spark, sf):
    pts = write_table(_km_points(spark, sf), "points")  # read once per iteration
    init = km.initial_centres_by_hash(pts, "id", KM_K)
    centres, counts = km.lloyd(pts, "vec", init, KM_ITERS)
    return km.centres_frame(spark, centres, counts, digits=6)


_ASSIGN_CENTRES = ", ".join(f"({i}, {c})" for i, c in enumerate(KM_CENTRES))


@register("kmeans_assign", sql=f"""WITH {_KPTS},
cs AS (SELECT * FROM (VALUES {_ASSIGN_CENTRES}) v(cid, vec))
SELECT p.id, CAST((SELECT cs.cid FROM cs ORDER BY
  list_reduce(list_transform(range(1, 5), lambda i: (p.vec[i] - cs.vec[i]) * (p.vec[i] - cs.vec[i])), lambda x, y: x + y), cs.cid
  LIMIT 1) AS INTEGER) AS cluster FROM pts p""")
def kmeans_assign(spark, sf):
    pts = _km_points(spark, sf)
    return pts.select("id", km.nearest_centre(F.col("vec"), KM_CENTRES).cast("int").alias("cluster"))


@register("kmeans_fit_profile", sql=f"""WITH {TX_SQL}
SELECT count(*) AS n, CAST({KM_K} AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS off_centre FROM tx""")
def kmeans_fit_profile(spark, sf):
    """MLlib k-means (k-means||, explicit seed). The fit is random; every row is in one of k clusters
    and none is nearer to another centre than to its own."""
    model, assigned = mdl.fit_kmeans(_km_points(spark, sf), "vec", KM_K)
    centres = [[float(x) for x in c] for c in model.clusterCenters()]
    return assigned.agg(F.count("*").alias("n"), F.count_distinct("cluster").alias("clusters"),
                        _off_centre(assigned, centres).alias("off_centre"))


# the clustering endpoint over a table of requests: every transaction as a request row with some
# features null; as in the reference (indexers with handleInvalid="keep", no request check) a null
# feature takes the unseen index (the map size), then the nearest of fixed centres over the
# categorical ordinals. Those centres.
REQ_CENTRES = [[0.0, 0.0, 0.0], [2.0, 2.0, 2.0], [4.0, 4.0, 4.0]]
_RC_SEL, _RC_JOIN = index_join_sql(KM_CATS, "req")
_RC = ", ".join(f"({i}, {c})" for i, c in enumerate(REQ_CENTRES))


@register("assign_cluster_requests", sql=f"""WITH {TX_SQL}, {tx_maps_sql(KM_CATS)}, {qr.request_rows_sql("tx")},
p AS (SELECT req.request_id, [{', '.join(f'{c}_index' for c in KM_CATS)}] AS vec FROM (
  SELECT req.request_id, {_RC_SEL} FROM req {_RC_JOIN}) req),
cs AS (SELECT * FROM (VALUES {_RC}) v(cid, vec))
SELECT p.request_id, CAST((SELECT cs.cid FROM cs ORDER BY
  list_reduce(list_transform(range(1, 4), lambda i: (p.vec[i] - cs.vec[i]) * (p.vec[i] - cs.vec[i])), lambda x, y: x + y), cs.cid
  LIMIT 1) AS INTEGER) AS cluster FROM p""")
def assign_cluster_requests(spark, sf):
    t = fx.tx(spark, sf)
    maps = LabelMaps.fit(t, KM_CATS)
    ix = maps.transform(qr.request_rows(t).select("request_id", *KM_CATS))
    vec = F.array(*[F.col(f"{c}_index") for c in KM_CATS])
    return ix.select("request_id", km.nearest_centre(vec, REQ_CENTRES).cast("int").alias("cluster"))


# ---- saved pipelines and full answers -----------------------------------------------------------

def _off_centre(df, centres, vec: str = "vec", cluster: str = "cluster"):
    """Rows that are farther from their own centre than from another (ties aside)."""
    d = F.array(*[sq_dist(F.col(vec), c) for c in centres])
    return F.coalesce(F.sum((F.element_at(d, F.col(cluster) + 1) > F.array_min(d) + 1e-9).cast("long")), F.lit(0))


def raises(action) -> bool:
    """Whether ``action()`` fails; any error will do, silence would not."""
    try:
        action()
    except Exception:  # noqa: BLE001
        return True
    return False


@register("cluster_roundtrip", sql=f"""WITH {TX_SQL}
SELECT count(*) AS n, CAST({KM_K} AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS off_centre, CAST(0 AS BIGINT) AS bad_responses,
  TRUE AS missing_path_raises FROM tx""")
def cluster_roundtrip(spark, sf):
    """The clustering engine's life: index, assemble, k-means fit, save, load, assign, answer. The
    fit is random: what any fit must satisfy is reported."""
    t = fx.tx(spark, sf)
    path = scratch_path(spark, "cluster-model")
    mdl.save(mdl.fit_cluster_pipeline(t, KM_CATS), path)
    loaded = mdl.load(path)
    got = loaded.transform(t.select("id", *KM_CATS)).select("id", vector_to_array("features").alias("vec"), "cluster",
                                                             mdl.cluster_response("cluster").alias("response"))
    centres = [[float(x) for x in c] for c in loaded.stages[-1].clusterCenters()]
    text = F.concat(F.lit('{"cluster":'), F.col("cluster").cast("string"), F.lit("}"))
    out = got.agg(F.count("*").alias("n"), F.count_distinct("cluster").alias("clusters"), _off_centre(got, centres).alias("off_centre"),
                  F.sum((F.col("response") != text).cast("long")).alias("bad_responses"))
    return out.withColumn("missing_path_raises", F.lit(raises(lambda: mdl.load(f"{path}-absent"))))


@register("predict_price_response", sql=f"""WITH {_IX}, {_MOM}, {qr.request_rows_sql("tx")},
v AS (SELECT request_id, {', '.join(LR_CATS)}, {_MISSING_N} AS missing_n, {_MISSING_TXT} AS missing_txt FROM req),
rix AS (SELECT v.request_id, v.missing_n, v.missing_txt, {_R_SEL} FROM v {_R_JOIN})
SELECT request_id, CASE WHEN missing_n = 0 THEN '{{"predicted_price":' || CAST(round((SELECT my - b1 * mx1 - b2 * mx2 FROM c)
    + (SELECT b1 FROM c) * property_type_index + (SELECT b2 FROM c) * duration_index, 2) AS DECIMAL(18, 2)) || '}}'
  ELSE '{{"error":"{rq.MISSING_PREFIX}' || missing_txt || '"}}' END AS response FROM rix""")
def predict_price_response(spark, sf):
    """The price endpoint's JSON: a price, or the refusal's text."""
    scored = predict_price_requests(spark, sf).withColumn("prediction", F.col("prediction").cast("decimal(18,2)"))
    return scored.select("request_id", mdl.price_response("prediction", "error").alias("response"))


@register("assign_cluster_response", sql=f"""WITH {TX_SQL}, {tx_maps_sql(KM_CATS)}, {qr.request_rows_sql("tx")},
p AS (SELECT req.request_id, [{', '.join(f'{c}_index' for c in KM_CATS)}] AS vec FROM (
  SELECT req.request_id, {_RC_SEL} FROM req {_RC_JOIN}) req),
cs AS (SELECT * FROM (VALUES {_RC}) v(cid, vec))
SELECT p.request_id, '{{"cluster":' || (SELECT cs.cid FROM cs ORDER BY
  list_reduce(list_transform(range(1, 4), lambda i: (p.vec[i] - cs.vec[i]) * (p.vec[i] - cs.vec[i])), lambda x, y: x + y), cs.cid
  LIMIT 1) || '}}' AS response FROM p""")
def assign_cluster_response(spark, sf):
    return assign_cluster_requests(spark, sf).select("request_id", mdl.cluster_response("cluster").alias("response"))


# the eight feature columns under the reference's own names (spaces, slashes, dashes), from the
# transaction fixture and the order key
EIGHT = ["Property Type", "Old/New", "Duration", "Town/City", "District", "County", "PPDCategory Type",
         "Record Status - monthly file only"]


def _eight(spark, sf):
    t = fx.tx(spark, sf)
    town = F.concat(F.lit("T"), (F.col("id") * 7 % 31).cast("string"))
    return t.select("id", "price", F.col("property_type").alias(EIGHT[0]), F.col("old_new").alias(EIGHT[1]),
                    F.col("duration").alias(EIGHT[2]), town.alias(EIGHT[3]), F.col("district").alias(EIGHT[4]),
                    F.col("county").alias(EIGHT[5]), F.when(F.col("id") % 3 == 0, "B").otherwise("A").alias(EIGHT[6]),
                    F.when(F.col("id") % 11 == 0, "D").when(F.col("id") % 5 == 0, "C").otherwise("A").alias(EIGHT[7]))


@register("lr_eight_features", sql=f"""WITH {TX_SQL}
SELECT count(*) AS n, CAST({len(EIGHT)} AS INTEGER) AS features, round(avg(price), 2) AS mean_prediction, TRUE AS residuals_orthogonal,
  TRUE AS loaded_equals_moments FROM tx""")
def lr_eight_features(spark, sf):
    """Regression on eight real-named features: the saved and loaded pipeline against the moments
    fit. Checked by what defines least squares: the residuals sum to nothing (the mean prediction is
    the mean price) and are orthogonal to every feature."""
    t = _eight(spark, sf)
    path = scratch_path(spark, "price-model-8")
    mdl.save(mdl.fit_price_pipeline(t, EIGHT, "price"), f"{path}/pipeline")
    mdl.save_feature_list(spark, EIGHT, f"{path}/columns")
    cols = mdl.load_feature_list(spark, f"{path}/columns")
    got = mdl.load(f"{path}/pipeline").transform(t)
    x = [f"x{i}" for i in range(len(cols))]
    ix = got.select("price", F.col("prediction").alias("loaded"), *[F.col(f"`{c}_index`").alias(n) for c, n in zip(cols, x, strict=True)])
    own = LinearModel.from_fit(fit_ols(ix, x, "price"), x).transform(ix)
    residual = F.col("price") - F.col("loaded")
    out = own.agg(F.count("*").alias("n"), F.avg("loaded").alias("m"), F.stddev_pop("price").alias("sd"),
                  F.max(F.abs(F.col("loaded") - F.col("prediction"))).alias("apart"),
                  *[F.abs(F.covar_pop(residual, c)).alias(f"c{c}") for c in x])
    flat = F.greatest(*[F.col(f"c{c}") for c in x]) < F.col("sd") * 1e-6
    return out.select("n", F.lit(len(cols)).alias("features"), F.round("m", 2).alias("mean_prediction"),
                      flat.alias("residuals_orthogonal"), (F.col("apart") < F.col("sd") * 1e-6).alias("loaded_equals_moments"))
