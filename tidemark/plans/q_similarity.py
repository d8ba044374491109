"""Catalogue: LSH hashing, exact kNN, batched recommendation, responses."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import models as mdl
from tidemark.operators import payloads as pl
from tidemark.operators import probing
from tidemark.operators import requests as rq_ops
from tidemark.operators import rows
from tidemark.operators import similarity as sim
from tidemark.operators.labels import LabelMaps
from tidemark.plans import fixtures as fx
from tidemark.plans import q_requests as qr
from tidemark.plans.registry import EMB_SQL, TX_SQL, index_join_sql, register, tx_maps_sql
from tidemark.session import scratch_path, write_table

# Hashing settings. On the unit-norm 64-d embeddings a bucket of 2.0 only hashes by
# sign, so 0.1 is used there; the transaction recommender keeps the reference's 2.0 and 3 tables.
EMB_DIM, EMB_BUCKET, TABLES, TOP_K = 64, 0.1, 3, 5
TX_BUCKET = 2.0
KNN_K = 10
EMB_VECTORS = sim.projection_vectors(EMB_DIM, TABLES, mdl.LSH_SEED)
TX_CATS = fx.TX_CATS
TX_VECTORS = sim.projection_vectors(len(TX_CATS), TABLES, mdl.LSH_SEED)


def _sql_vec(v):
    return "[" + ", ".join(repr(float(x)) for x in v) + "]::DOUBLE[]"


def _sql_hashes(col: str, vectors, bucket: float) -> str:
    return "[" + ", ".join(f"CAST(floor(list_dot_product({col}, {_sql_vec(v)}) / {bucket!r}) AS BIGINT)"
                           for v in vectors) + "]"


def one_row(*parts):
    """One-row aggregates side by side, without a join."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def _emb(spark, sf):
    return fx.embeddings(spark, sf)


@register("lsh_bucket_hash", sql=f"""WITH {EMB_SQL},
h AS (SELECT id, {_sql_hashes('vec', EMB_VECTORS, EMB_BUCKET)} AS hs FROM emb)
SELECT id, CAST(t - 1 AS INTEGER) AS hash_table, hs[t] AS bucket FROM h, range(1, {TABLES + 1}) r(t)""")
def lsh_bucket_hash(spark, sf):
    e = _emb(spark, sf)
    return e.select("id", F.posexplode(sim.lsh_hashes(F.col("vec"), EMB_VECTORS, EMB_BUCKET)).alias("hash_table", "bucket"))


_MEAN = ", ".join(f"avg(vec[{i + 1}])" for i in range(EMB_DIM))


@register("knn_exact", sql=f"""WITH {EMB_SQL}, key AS (SELECT [{_MEAN}]::DOUBLE[] AS kv FROM emb)
SELECT id, round(list_distance(vec, (SELECT kv FROM key)), 6) AS dist FROM emb
ORDER BY round(list_distance(vec, (SELECT kv FROM key)), 9), id LIMIT {KNN_K}""")
def knn_exact(spark, sf):
    """Exact top-10 neighbours of the mean embedding (the key is derived from the table)."""
    e = _emb(spark, sf)
    key = list(e.agg(*[F.avg(F.col("vec")[i]) for i in range(EMB_DIM)]).first())  # 64 numbers
    return sim.knn_single(e, "vec", key, KNN_K).select("id", F.round("dist", 6).alias("dist"))


def _rec_sql(items: str, requests: str, hcol_vectors, bucket, exclude_self: bool, tail: str,
             per_request_k: bool = False) -> str:
    """Oracle of ``recommend`` by distinct vectors (an oracle over all pairs of rows would not end);
    with ``per_request_k`` the requests carry their own count ``k``."""
    excl = "WHERE self_id IS NULL OR id <> self_id" if exclude_self else ""
    k = "k" if per_request_k else str(TOP_K)
    most = f"(SELECT coalesce(max({k}), 0) + 1 FROM {requests})"
    return f"""iv AS (SELECT vec, {_sql_hashes('vec', hcol_vectors, bucket)} AS hs, min(id) AS least FROM {items} GROUP BY vec),
qv AS (SELECT DISTINCT vec, {_sql_hashes('vec', hcol_vectors, bucket)} AS hs FROM {requests}),
vp AS (SELECT q.vec AS qvec, i.vec AS ivec, i.least, list_distance(i.vec, q.vec) AS dist FROM qv q JOIN iv i
  ON (i.hs[1] = q.hs[1] OR i.hs[2] = q.hs[2] OR i.hs[3] = q.hs[3])),
vtop AS (SELECT * FROM vp QUALIFY row_number() OVER (PARTITION BY qvec ORDER BY round(dist, 9), least) <= {most}),
mem AS (SELECT vec, id FROM {items} QUALIFY row_number() OVER (PARTITION BY vec ORDER BY id) <= {most}),
cand AS (SELECT qvec, id, dist FROM vtop JOIN mem ON ivec = vec
  QUALIFY row_number() OVER (PARTITION BY qvec ORDER BY round(dist, 9), id) <= {most}),
pairs AS (SELECT q.request_id, {'q.k,' if per_request_k else ''} q.self_id, c.id, c.dist FROM {requests} q JOIN cand c ON c.qvec = q.vec),
ranked AS (SELECT request_id, {'k,' if per_request_k else ''} id, dist,
  CAST(row_number() OVER (PARTITION BY request_id ORDER BY round(dist, 9), id) AS INTEGER) AS rank FROM pairs {excl}),
recs AS (SELECT * FROM ranked WHERE rank <= {k})
{tail}"""


@register("recommend_topk", sql=f"""WITH {EMB_SQL},
rq AS (SELECT id AS request_id, CAST(NULL AS BIGINT) AS self_id, vec FROM emb),
{_rec_sql('emb', 'rq', EMB_VECTORS, EMB_BUCKET, False, 'SELECT request_id, rank, id, round(dist, 6) AS dist FROM recs')}""")
def recommend_topk(spark, sf):
    """Every embedding as a request: top-5 items sharing a bucket (itself included)."""
    e = _emb(spark, sf)
    req = e.select(F.col("id").alias("request_id"), "vec")
    r = sim.recommend(e, req, TOP_K, EMB_VECTORS, EMB_BUCKET)
    return r.select("request_id", F.col("rank").cast("int").alias("rank"), "id", F.round("dist", 6).alias("dist"))


@register("recommend_string_ids", sql=f"""WITH {EMB_SQL},
it AS (SELECT md5(CAST(id AS VARCHAR)) AS id, vec FROM emb),
rq AS (SELECT id AS request_id, id AS self_id, vec FROM it),
{_rec_sql('it', 'rq', EMB_VECTORS, EMB_BUCKET, True, 'SELECT request_id, rank, id, round(dist, 6) AS dist FROM recs')}""")
def recommend_string_ids(spark, sf):
    """Items and requests under text ids (the reference's row id is a GUID), own id excluded."""
    e = _emb(spark, sf).select(F.md5(F.col("id").cast("string")).alias("id"), "vec")
    req = e.select(F.col("id").alias("request_id"), F.col("id").alias("self_id"), "vec")
    r = sim.recommend(e, req, TOP_K, EMB_VECTORS, EMB_BUCKET, self_id="self_id")
    return r.select("request_id", F.col("rank").cast("int").alias("rank"), "id", F.round("dist", 6).alias("dist"))


# transaction recommender: every transaction asks for its neighbours, itself excluded
_SEL, _JOIN = index_join_sql(TX_CATS, "tx")
_TX_REC_BASE = f"""{TX_SQL}, {tx_maps_sql(TX_CATS)},
ix AS (SELECT tx.id, {_SEL} FROM tx {_JOIN}),
items AS (SELECT id, [{', '.join(f'{c}_index' for c in TX_CATS)}]::DOUBLE[] AS vec FROM ix),
rq AS (SELECT id AS request_id, id AS self_id, vec FROM items)"""


def _tx_items(spark, sf):
    """(label maps, indexed items), the items written once: several branches of a plan read them."""
    t = fx.tx(spark, sf)
    maps = LabelMaps.fit(t, TX_CATS)
    items = maps.transform(t).select("id", F.array(*[F.col(f"{c}_index") for c in TX_CATS]).alias("vec"))
    return maps, write_table(items, "indexed-items")


def _tx_recs(spark, sf):
    _, items = _tx_items(spark, sf)
    req = items.select(F.col("id").alias("request_id"), F.col("id").alias("self_id"), "vec")
    return sim.recommend(items, req, TOP_K, TX_VECTORS, TX_BUCKET, self_id="self_id")


# Fixed value: every element of a request that no item is near to; one such request per region.
FAR = 1e7
_FAR_REQUESTS = f"""far AS (SELECT * FROM rq UNION ALL
  SELECT -1 - CAST(r_regionkey AS BIGINT), NULL, [{", ".join(["1e7"] * len(TX_CATS))}]::DOUBLE[] FROM region)"""


def _tx_answers(spark, sf):
    """(recommendations, requests): every transaction asks, and requests far from all of them."""
    _, items = _tx_items(spark, sf)
    req = items.select(F.col("id").alias("request_id"), F.col("id").alias("self_id"), "vec")
    far = fx.table(spark, sf, "region").select((-1 - F.col("r_regionkey").cast("bigint")).alias("request_id"), F.lit(None).cast("bigint").alias("self_id"),
                                               F.array(*[F.lit(FAR)] * len(TX_CATS)).alias("vec"))
    req = req.unionByName(far)
    return sim.recommend(items, req, TOP_K, TX_VECTORS, TX_BUCKET, self_id="self_id"), req


@register("recommend_exclude_self", sql=f"""WITH {_TX_REC_BASE},
{_rec_sql('items', 'rq', TX_VECTORS, TX_BUCKET, True, 'SELECT request_id, rank, id, round(dist, 6) AS dist FROM recs')}""")
def recommend_exclude_self(spark, sf):
    r = _tx_recs(spark, sf)
    return r.select("request_id", F.col("rank").cast("int").alias("rank"), "id", F.round("dist", 6).alias("dist"))


@register("recommend_response_json", sql=f"""WITH {_TX_REC_BASE}, {_FAR_REQUESTS},
{_rec_sql('items', 'far', TX_VECTORS, TX_BUCKET, True, '''SELECT far.request_id, count(recs.id) AS n,
  coalesce(string_agg(CAST(recs.id AS VARCHAR), ',' ORDER BY rank), '') AS ids,
  '{"found":' || count(recs.id) || ',"recommendations":[' || coalesce(string_agg(CAST(recs.id AS VARCHAR), ',' ORDER BY rank), '') || ']}' AS response
FROM far LEFT JOIN recs USING (request_id) GROUP BY far.request_id''')}""")
def recommend_response_json(spark, sf):
    """An answer for every request; one that is far from all items finds none."""
    return sim.response_rows(*_tx_answers(spark, sf))


def _mllib_hashes(col: str = "_hashes"):
    return F.transform(col, lambda h: vector_to_array(h)[0].cast("bigint"))


def _shared_bucket(a: str, b: str):
    return F.exists(F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b")), lambda x: x["a"] == x["b"])


@register("lsh_recall", sql=f"""WITH {EMB_SQL}
SELECT count(DISTINCT label) AS requests, CAST(0 AS BIGINT) AS outside_buckets, CAST(0 AS BIGINT) AS wrong_distances,
  CAST(0 AS BIGINT) AS nearer_left_out, TRUE AS finds_some FROM emb""")
def lsh_recall(spark, sf):
    """MLlib LSH (fitted, seeded) for per-label centroid requests against exact search. The fit is
    random, so what is reported holds for any fit: every neighbour shares a bucket with its request,
    its distance is exact, and no item of the exact top ten that shares a bucket is left out."""
    e = _emb(spark, sf)
    cents = e.groupBy("label").agg(*[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in range(EMB_DIM)])
    cents = cents.select(F.col("label").alias("request_id"), F.array(*[f"m{i}" for i in range(EMB_DIM)]).alias("vec"))
    model, ev = mdl.fit_lsh(e, "vec", EMB_BUCKET, TABLES)
    items = model.transform(ev).select("id", "vec", _mllib_hashes().alias("h"))
    from pyspark.ml.functions import array_to_vector
    reqs = model.transform(cents.withColumn("_features", array_to_vector("vec")))
    reqs = write_table(reqs.select("request_id", "vec", _mllib_hashes().alias("h")), "centroid-requests")
    ann = sim.recommend(items, reqs, KNN_K, None, None, item_hashes="h", req_hashes="h")
    exact = sim.knn_many(e, "vec", reqs.select(F.col("request_id").alias("qid"), "vec"), KNN_K)
    both = (ann.withColumnRenamed("dist", "got").join(
        exact.select(F.col("qid").alias("request_id"), "id", F.col("dist").alias("best")), ["request_id", "id"], "full")
        .join(items.select("id", F.col("vec").alias("iv"), F.col("h").alias("ih")), "id")
        .join(reqs.select("request_id", F.col("vec").alias("qv"), F.col("h").alias("qh")), "request_id"))
    true = F.sqrt(F.aggregate(F.zip_with("iv", "qv", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x))
    shares = _shared_bucket("ih", "qh")
    found = F.col("got").isNotNull()

    def count(cond):
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0))

    sums = both.agg(count(found & ~shares).alias("outside_buckets"),
                    count(found & (F.abs(F.col("got") - true) > 1e-9)).alias("wrong_distances"),
                    count(~found & shares).alias("nearer_left_out"),
                    (count(found & F.col("best").isNotNull()) > 0).alias("finds_some"))
    return one_row(reqs.agg(F.count("*").alias("requests")), sums)


_DISPLAY = sim.display_columns(["id", "price", "ts", *TX_CATS])


@register("recommend_display", sql=f"""WITH {_TX_REC_BASE},
{_rec_sql('items', 'rq', TX_VECTORS, TX_BUCKET, True, f'''SELECT recs.request_id, recs.rank, recs.id, round(recs.dist, 6) AS dist,
  tx.price, strftime(tx.ts, '%Y-%m-%d %H:%M:%S') AS ts, {', '.join('tx.' + c for c in TX_CATS)}
FROM recs JOIN tx ON tx.id = recs.id''')}""")
def recommend_display(spark, sf):
    """Recommendations with the items' original columns (display projection, fixed order)."""
    from tidemark.functions.columns import ts_text

    t = fx.tx(spark, sf)
    recs = _tx_recs(spark, sf).withColumn("dist", F.round("dist", 6))
    shown = sim.with_display(recs, t.withColumn("ts", ts_text("ts")), "id", _DISPLAY)
    return shown.withColumn("rank", F.col("rank").cast("int"))


@register("recommend_response_objects", sql=f"""WITH {_TX_REC_BASE}, {_FAR_REQUESTS},
{_rec_sql('items', 'far', TX_VECTORS, TX_BUCKET, True, f'''SELECT far.request_id,
  '{{"message":"Found ' || count(recs.id) || ' similar properties.","recommendations":[' || coalesce(string_agg(
    '{{"id":' || recs.id || ',"county":"' || tx.county || '","duration":"' || tx.duration || '","distCol":' ||
    CAST(round(recs.dist, 6) AS DECIMAL(18, 6)) || '}}', ',' ORDER BY rank), '') || ']}}' AS response
FROM far LEFT JOIN recs USING (request_id) LEFT JOIN tx ON tx.id = recs.id GROUP BY far.request_id''')}""")
def recommend_response_objects(spark, sf):
    """The endpoint's full answer per request: a message and one object per row with its distance; a
    request that is far from all items is told that none was found."""
    t = fx.tx(spark, sf)
    recs, requests = _tx_answers(spark, sf)
    recs = recs.withColumn("dist", F.round("dist", 6).cast("decimal(18,6)"))
    return sim.response_objects(recs, t, "id", ["id", "county", "duration"], requests)


# the recommend endpoint over a table of requests: request rows with null features and a count as
# text -> validation (some feature given, count > 0, default 5) -> Unknown fill -> the items' label
# maps -> top-k with each request's own count, its own id excluded
_D_SEL, _D_JOIN = index_join_sql(TX_CATS, "d")
_K_PARSED = "CASE WHEN num_recommendations IS NULL THEN 5 ELSE TRY_CAST(num_recommendations AS INTEGER) END"
_GIVEN = " OR ".join(f"{c} IS NOT NULL" for c in TX_CATS)
_REQ_K_BASE = f"""{TX_SQL}, {tx_maps_sql(TX_CATS)},
ix AS (SELECT tx.id, {_SEL} FROM tx {_JOIN}),
items AS (SELECT id, [{', '.join(f'{c}_index' for c in TX_CATS)}]::DOUBLE[] AS vec FROM ix),
{qr.request_rows_sql("tx")},
v AS (SELECT *, {_K_PARSED} AS kp FROM req),
d AS (SELECT request_id, kp AS k, {', '.join(f"coalesce({c}, 'Unknown') AS {c}" for c in TX_CATS)} FROM v WHERE kp > 0 AND ({_GIVEN})),
dix AS (SELECT d.request_id, d.k, {_D_SEL} FROM d {_D_JOIN}),
rq AS (SELECT request_id, request_id AS self_id, k, [{', '.join(f'{c}_index' for c in TX_CATS)}]::DOUBLE[] AS vec FROM dix)"""


@register("recommend_request_k", sql=f"""WITH {_REQ_K_BASE},
{_rec_sql('items', 'rq', TX_VECTORS, TX_BUCKET, True, 'SELECT request_id, rank, id, round(dist, 6) AS dist FROM recs', per_request_k=True)}""")
def recommend_request_k(spark, sf):
    maps, items = _tx_items(spark, sf)
    ok = rq_ops.validate(qr.request_rows(fx.tx(spark, sf)), [], k_col="num_recommendations", known=TX_CATS,
                         any_feature=True).where(F.col("status") == "ok")
    d = rq_ops.with_defaults(ok.select("request_id", "k", *TX_CATS), TX_CATS)
    idx = F.array(*[F.col(f"{c}_index") for c in TX_CATS])
    q = maps.transform(d).select("request_id", F.col("request_id").alias("self_id"), "k", idx.alias("vec"))
    r = sim.recommend(items, write_table(q, "indexed-requests"), "k", TX_VECTORS, TX_BUCKET, self_id="self_id")
    return r.select("request_id", F.col("rank").cast("int").alias("rank"), "id", F.round("dist", 6).alias("dist"))


_KEYS = "keys AS (SELECT id AS qid, vec FROM emb WHERE id % 20 = 0)"
_EXACT = f"""exact AS (SELECT k.qid, e.id, list_distance(e.vec, k.vec) AS dist,
  CAST(row_number() OVER (PARTITION BY k.qid ORDER BY round(list_distance(e.vec, k.vec), 9), e.id) AS INTEGER) AS rank
  FROM keys k CROSS JOIN emb e QUALIFY rank <= {KNN_K})"""


def _keys(e):
    return e.where("id % 20 = 0").select(F.col("id").alias("qid"), "vec")


@register("knn_many_keys", sql=f"""WITH {EMB_SQL}, {_KEYS}, {_EXACT} SELECT qid, rank, id, round(dist, 6) AS dist FROM exact""")
def knn_many_keys(spark, sf):
    """Exact top ten of all embeddings for every twentieth of them, by pivots."""
    e = _emb(spark, sf)
    r = sim.knn_many(e, "vec", _keys(e), KNN_K)
    return r.select("qid", F.col("rank").cast("int").alias("rank"), "id", F.round("dist", 6).alias("dist"))


@register("knn_many_transactions", sql=f"""WITH {_TX_REC_BASE},
iv AS (SELECT vec, min(id) AS least FROM items GROUP BY vec), qv AS (SELECT DISTINCT vec FROM items WHERE id % 20 = 0),
vtop AS (SELECT q.vec AS qvec, i.vec AS ivec, list_distance(i.vec, q.vec) AS dist FROM qv q CROSS JOIN iv i
  QUALIFY row_number() OVER (PARTITION BY q.vec ORDER BY round(list_distance(i.vec, q.vec), 9), i.least) <= {TOP_K}),
mem AS (SELECT vec, id FROM items QUALIFY row_number() OVER (PARTITION BY vec ORDER BY id) <= {TOP_K}),
best AS (SELECT qvec, id, dist, CAST(row_number() OVER (PARTITION BY qvec ORDER BY round(dist, 9), id) AS INTEGER) AS rank
  FROM vtop JOIN mem ON ivec = vec QUALIFY rank <= {TOP_K})
SELECT items.id AS qid, rank, best.id, round(dist, 6) AS dist FROM items JOIN best ON qvec = vec WHERE items.id % 20 = 0""")
def knn_many_transactions(spark, sf):
    """Exact nearest transactions, of all, for every twentieth of them: few distinct vectors, many ties."""
    _, items = _tx_items(spark, sf)
    r = sim.knn_many(items, "vec", _keys(items), TOP_K)
    return r.select("qid", F.col("rank").cast("int").alias("rank"), "id", F.round("dist", 6).alias("dist"))


_Z = probing.reach_factor(probing.RECALL, TABLES) / EMB_DIM ** 0.5
_F = "[" + ", ".join(f"list_dot_product(vec, {_sql_vec(v)}) / {EMB_BUCKET!r}" for v in EMB_VECTORS) + "]"


@register("lsh_multi_probe", sql=f"""WITH {EMB_SQL}, {_KEYS}, {_EXACT},
h AS (SELECT id, vec, t, CAST(floor(f[t]) AS BIGINT) AS b FROM (SELECT id, vec, {_F} AS f FROM emb), range(1, {TABLES + 1}) r(t)),
q AS (SELECT qid, vec, t, f[t] AS f FROM (SELECT qid, vec, {_F} AS f FROM keys), range(1, {TABLES + 1}) r(t)),
sizes AS (SELECT t, b, count(*) AS n FROM h GROUP BY t, b),
e AS (SELECT qid, vec, t, b, f, n, greatest(b - f, f - (b + 1), 0) * {EMB_BUCKET!r} AS edge FROM q JOIN sizes USING (t)),
first AS (SELECT qid, vec, t, b FROM e QUALIFY sum(n) OVER (PARTITION BY qid ORDER BY round(edge, 9), t, b) - n < {KNN_K + 1}),
near AS (SELECT DISTINCT qid, h.id, list_distance(h.vec, first.vec) AS dist FROM first JOIN h USING (t, b)),
reach AS (SELECT qid, dist AS reach FROM near QUALIFY row_number() OVER (PARTITION BY qid ORDER BY dist, id) = {KNN_K + 1}),
more AS (SELECT qid, vec, t, b FROM e JOIN reach USING (qid)
  WHERE b BETWEEN floor(f - {_Z!r} * reach / {EMB_BUCKET!r}) AND floor(f + {_Z!r} * reach / {EMB_BUCKET!r})),
probed AS (SELECT * FROM near UNION SELECT qid, h.id, list_distance(h.vec, more.vec) FROM more JOIN h USING (t, b)),
plain AS (SELECT DISTINCT qid, h.id, list_distance(h.vec, q.vec) AS dist FROM q JOIN h ON h.t = q.t AND h.b = floor(q.f)),
ptop AS (SELECT qid, id FROM probed QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), id) <= {KNN_K}),
otop AS (SELECT qid, id FROM plain QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), id) <= {KNN_K}),
s AS (SELECT count(DISTINCT qid) AS requests, count(*) AS neighbours, count(otop.id) AS o, count(ptop.id) AS p
  FROM exact LEFT JOIN otop USING (qid, id) LEFT JOIN ptop USING (qid, id))
SELECT requests, neighbours, round(o / neighbours, 4) AS plain_recall, round(p / neighbours, 4) AS probed_recall, p >= 0.9 * neighbours AS enough FROM s""")
def lsh_multi_probe(spark, sf):
    """Recall at ten of a request's own buckets and of probed neighbouring buckets, against exact search;
    every twentieth embedding asks."""
    e = _emb(spark, sf)
    keys = _keys(e)
    req = keys.withColumnRenamed("qid", "request_id")
    exact = sim.knn_many(e, "vec", keys, KNN_K).select(F.col("qid").alias("request_id"), "id")
    plain = sim.recommend(e, req, KNN_K, EMB_VECTORS, EMB_BUCKET).select("request_id", "id", F.lit(1).alias("o"))
    probed = sim.recommend_probed(e, req, KNN_K, EMB_VECTORS, EMB_BUCKET).select("request_id", "id", F.lit(1).alias("p"))
    both = exact.join(plain, ["request_id", "id"], "left").join(probed, ["request_id", "id"], "left")
    s = both.agg(F.countDistinct("request_id").alias("requests"), F.count("*").alias("neighbours"), F.count("o").alias("o"), F.count("p").alias("p"))
    return s.select("requests", "neighbours", F.round(F.col("o") / F.col("neighbours"), 4).alias("plain_recall"),
                    F.round(F.col("p") / F.col("neighbours"), 4).alias("probed_recall"), F.expr("p >= 0.9 * neighbours").alias("enough"))


@register("refuse_requests", sql=f"""WITH {TX_SQL}, {qr.request_rows_sql("tx")},
v AS (SELECT *, {_K_PARSED} AS kp FROM req)
SELECT request_id, CASE WHEN NOT ({_GIVEN}) THEN '{rq_ops.FEATURES_ERROR.replace("'", "''")}'
  WHEN kp IS NULL OR kp <= 0 THEN '{rq_ops.K_ERROR.replace("'", "''")}' END AS error FROM v""")
def refuse_requests(spark, sf):
    """The recommend endpoint's refusals: no feature at all, or a bad count."""
    v = rq_ops.validate(qr.request_rows(fx.tx(spark, sf)), [], k_col="num_recommendations", known=TX_CATS, any_feature=True)
    return v.select("request_id", "error")


_B_SEL, _B_JOIN = index_join_sql(TX_CATS, "d")
_ANSWER_BASE = f"""{TX_SQL}, {tx_maps_sql(TX_CATS)},
ix AS (SELECT tx.id, {_SEL} FROM tx {_JOIN}),
items AS (SELECT id, [{', '.join(f'{c}_index' for c in TX_CATS)}]::DOUBLE[] AS vec FROM ix),
{qr.BODIES_SQL},
d AS (SELECT request_id, k, own_id, {', '.join(f"coalesce({c}, 'Unknown') AS {c}" for c in TX_CATS)} FROM parsed WHERE error IS NULL),
dix AS (SELECT d.request_id, d.k, d.own_id, {_B_SEL} FROM d {_B_JOIN}),
rq AS (SELECT request_id, CAST(own_id AS BIGINT) AS self_id, k, [{', '.join(f'{c}_index' for c in TX_CATS)}]::DOUBLE[] AS vec FROM dix)"""


@register("answer_bodies", sql=f"""WITH {_ANSWER_BASE},
{_rec_sql('items', 'rq', TX_VECTORS, TX_BUCKET, True, """SELECT parsed.request_id, CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status, count(recs.id) AS n,
  CASE WHEN error IS NOT NULL THEN '{"error":"' || error || '"}' ELSE
  '{"found":' || count(recs.id) || ',"recommendations":[' || coalesce(string_agg(CAST(recs.id AS VARCHAR), ',' ORDER BY rank), '') || ']}' END AS response
FROM parsed LEFT JOIN recs USING (request_id) GROUP BY parsed.request_id, error""", per_request_k=True)}""")
def answer_bodies(spark, sf):
    """The recommend endpoint from body to answer: refusals with their text, and what is found for the
    rest, own id excluded."""
    maps, items = _tx_items(spark, sf)
    asked = write_table(pl.parse_bodies(qr.body_rows(fx.tx(spark, sf)), "body", TX_CATS), "parsed-bodies")
    d = rq_ops.with_defaults(asked.where("error IS NULL").select("request_id", "k", "own_id", *TX_CATS), TX_CATS)
    idx = F.array(*[F.col(f"{c}_index") for c in TX_CATS])
    q = maps.transform(d).select("request_id", F.col("own_id").try_cast("bigint").alias("self_id"), "k", idx.alias("vec"))
    recs = sim.recommend(items, write_table(q, "indexed-requests"), "k", TX_VECTORS, TX_BUCKET, self_id="self_id")
    found = sim.response_rows(recs, asked.select("request_id")).select("request_id", "n", F.col("response").alias("found"))
    refusal = F.to_json(F.struct(F.col("error")))
    return asked.select("request_id", "error").join(found, "request_id").select(
        "request_id", F.when(F.col("error").isNull(), 200).otherwise(400).alias("status"), "n",
        F.when(F.col("error").isNull(), F.col("found")).otherwise(refusal).alias("response"))


@register("similarity_roundtrip", sql=f"""WITH {TX_SQL}
SELECT count(*) AS items, count(*) AS requests, CAST(0 AS BIGINT) AS own_rows, CAST(0 AS BIGINT) AS outside_buckets,
  CAST(0 AS BIGINT) AS wrong_distances, CAST(0 AS BIGINT) AS unanswered, CAST(0 AS BIGINT) AS too_many, TRUE AS missing_path_raises, 'id,price,{",".join(TX_CATS)}' AS shown FROM tx""")
def similarity_roundtrip(spark, sf):
    """The recommender's life: fill, index, assemble (skip), LSH fit, save model, column list and the
    indexed items with their vectors; load all three; answer every transaction (assembler keep, own
    id excluded) with the loaded parts. The fit is random, so what any fit must satisfy is reported."""
    from pyspark.ml.feature import VectorAssembler

    t = rows.fill_unknown(fx.tx(spark, sf).drop("ts"), TX_CATS)
    path = scratch_path(spark, "recommender")
    model = mdl.fit_similarity_pipeline(t, TX_CATS)
    mdl.save(model, f"{path}/model")
    mdl.save_feature_list(spark, TX_CATS, f"{path}/columns")
    made = sim.stage_outputs(model.stages)
    out = model.transform(t)
    out.write.parquet(f"{path}/items")  # source columns, label indexes, feature vector, hashes

    cols = mdl.load_feature_list(spark, f"{path}/columns")
    loaded = mdl.load(f"{path}/model")
    items = spark.read.parquet(f"{path}/items")
    shown = sim.display_columns(items.columns, made)
    asked = rows.fill_unknown(t.select(F.col("id").alias("request_id"), *cols), cols)
    stages = [VectorAssembler(inputCols=s.getInputCols(), outputCol=s.getOutputCol(), handleInvalid="keep")
              if isinstance(s, VectorAssembler) else s for s in loaded.stages]
    for s in stages:
        asked = s.transform(asked)

    def flat(df, *ids):
        return df.select(*ids, vector_to_array("features").alias("vec"), _mllib_hashes("hashes").alias("h"))

    q = write_table(flat(asked, "request_id").withColumn("self_id", F.col("request_id")), "indexed-requests")
    i = flat(items, "id")
    recs = sim.recommend(i, q, TOP_K, None, None, self_id="self_id", item_hashes="h", req_hashes="h")
    try:
        mdl.load(f"{path}/absent")
        raises = False
    except Exception:  # noqa: BLE001  any error will do, silence would not
        raises = True
    recs = write_table(recs, "recommendations")
    # what was recommended is looked up once per item: popular items are in many answers
    picked = write_table(i.join(recs.select("id").distinct(), "id").select("id", F.col("h").alias("ih"), F.col("vec").alias("iv")), "recommended-items")
    checked = recs.join(q.select("request_id", F.col("h").alias("qh"), F.col("vec").alias("qv")), "request_id").join(picked, "id")
    true = F.sqrt(F.aggregate(F.zip_with("iv", "qv", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x))
    # every transaction is an item as well: one that is not alone in each of its buckets has to be answered
    # (counted by distinct hashes, of which categories give few)
    kinds = write_table(i.groupBy("h").agg(F.count("*").alias("n")), "item-hashes")
    member = kinds.select("h", "n", F.posexplode("h").alias("t", "b"))
    crowded = member.groupBy("t", "b").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    due = i.join(write_table(member.join(crowded, ["t", "b"]).select("h").distinct(), "crowded-hashes"), "h").select(F.col("id").alias("request_id"))
    unanswered = due.join(recs.select("request_id").distinct(), "request_id", "left_anti").agg(F.count("*").alias("unanswered"))

    def count(cond):
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0))

    sums = checked.agg(count(F.col("id") == F.col("request_id")).alias("own_rows"),
                       count(~_shared_bucket("ih", "qh")).alias("outside_buckets"), count(F.abs(F.col("dist") - true) > 1e-9).alias("wrong_distances"),
                       count(F.col("rank") > TOP_K).alias("too_many"))
    n = one_row(items.agg(F.count("*").alias("items")), q.agg(F.count("*").alias("requests")), sums, unanswered)
    return n.withColumn("missing_path_raises", F.lit(raises)).withColumn("shown", F.lit(",".join(shown)))
