"""Exact and probed neighbours, request bodies, QR fits."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import payloads as pl
from tidemark.operators import pivots, probing, qr
from tidemark.operators import requests as rq
from tidemark.operators import similarity as sim
from tidemark.operators.regression import fit_ols


def table(spark, vectors, ids=None):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids or range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>")


def nearest(items, keys, k):
    out = {}
    for q, v in enumerate(keys):
        d = np.round(np.sqrt(((items - v) ** 2).sum(axis=1)), 9)
        out[q] = [int(i) for i in np.lexsort((np.arange(len(items)), d))[:k]]
    return out


def by_key(rows, key="qid"):
    out = {}
    for r in sorted(rows, key=lambda r: (r[key], r["rank"])):
        out.setdefault(r[key], []).append(r["id"])
    return out


def clusters(n, dim, seed, spread=0.02):
    rs = np.random.RandomState(seed)
    return rs.normal(size=(12, dim))[rs.randint(12, size=n)] * 5 + rs.normal(size=(n, dim)) * spread


@pytest.mark.parametrize("ring_rows, most", [(2000, 512), (10, 6)])
def test_pivot_search_equals_brute_force(spark, monkeypatch, ring_rows, most):
    monkeypatch.setattr(pivots, "RING_ROWS", ring_rows)
    monkeypatch.setattr(pivots, "MAX_PIVOTS", most)
    rs = np.random.RandomState(4)
    grid = rs.randint(0, 4, size=(150, 3)).astype(float)  # repeated vectors and many equal distances
    items = np.concatenate([grid, clusters(400, 3, 5), np.zeros((5, 3))])
    keys = np.concatenate([items[::40], [[1e6] * 3, [0.5] * 3, [-3.0, 1e-9, 2.0]]])
    got = by_key(sim.knn_many(table(spark, items), "vec", table(spark, keys).withColumnRenamed("id", "qid"), 7).collect())
    assert got == nearest(items, keys, 7)


def test_pivot_search_visits_little_of_clustered_vectors(spark):
    items = np.unique(clusters(3000, 8, 6), axis=0)
    iv = table(spark, items).withColumnRenamed("id", "vk")
    keys = iv.where("vk % 50 = 0").withColumn("kk", F.lit(6))
    _, visits = pivots.search(iv, keys)
    n, seen = visits.agg(F.count("*"), F.sum("visited")).first()
    assert n == len(range(0, len(items), 50)) and 6 * n <= seen <= 0.25 * n * len(items)


def test_pivot_search_of_few_or_no_items(spark):
    keys = table(spark, [[0.0, 1.0], [5.0, 5.0]]).withColumnRenamed("id", "qid")
    few = table(spark, [[1.0, 1.0], [1.0, 1.0], [2.0, 2.0]])
    assert by_key(sim.knn_many(few, "vec", keys, 9).collect()) == {0: [0, 1, 2], 1: [2, 0, 1]}
    assert sim.knn_many(few.limit(0), "vec", keys, 3).count() == 0
    assert sim.knn_many(few, "vec", keys.limit(0), 3).count() == 0


def test_probing_reaches_its_recall_and_answers_far_requests(spark):
    items = np.random.RandomState(8).normal(size=(1500, 16))
    keys = np.concatenate([items[::30], [[300.0] * 16]])
    vectors = sim.projection_vectors(16, 3, 11)
    it, req = table(spark, items), table(spark, keys).withColumnRenamed("id", "request_id")
    want = nearest(items, keys, 10)
    got = by_key(sim.recommend_probed(it, req, 10, vectors, 0.2).collect(), "request_id")
    plain = by_key(sim.recommend(it, req, 10, vectors, 0.2).collect(), "request_id")

    def recall(found):
        return sum(len(set(v) & set(found.get(q, []))) for q, v in want.items()) / sum(map(len, want.values()))

    assert recall(got) >= 0.9 > recall(plain)
    assert all(len(got[q]) == 10 for q in want)  # the far one too, which shares no bucket with any item
    assert len(keys) - 1 not in plain


def test_probing_finds_all_where_fewer_are_than_asked_for(spark):
    it = table(spark, [[0.0, 0.0], [3.0, 4.0], [-90.0, 7.0]])
    req = table(spark, [[0.1, 0.0]]).withColumnRenamed("id", "request_id")
    vectors = sim.projection_vectors(2, 2, 3)
    assert by_key(sim.recommend_probed(it, req, 5, vectors, 1.0).collect(), "request_id") == {0: [0, 1, 2]}
    assert sim.recommend_probed(it.limit(0), req, 5, vectors, 1.0).count() == 0
    assert sim.recommend_probed(it, req.limit(0), 5, vectors, 1.0).count() == 0


def test_reach_factor_is_the_quantile_of_all_tables_missing():
    z = probing.reach_factor(0.9, 2)
    draws = np.abs(np.random.RandomState(1).normal(size=(200_000, 2)))
    assert abs((draws.min(axis=1) > z).mean() - 0.1) < 0.005


KNOWN = ["old/new", "county", "it's"]


def body(features, **more):
    return json.dumps({"property_features": features, **more})


REFUSED = [
    (None, pl.BODY_ERROR), ("", pl.BODY_ERROR), ("{", pl.BODY_ERROR), ("null", pl.BODY_ERROR), ("0", pl.BODY_ERROR), ("[1]", pl.BODY_ERROR),
    ('"x"', pl.BODY_ERROR), ("{}", pl.BODY_ERROR), ('{"a": 1}', rq.FEATURES_ERROR), ('{"property_features": null}', rq.FEATURES_ERROR),
    ('{"property_features": []}', rq.FEATURES_ERROR), ('{"property_features": {}}', rq.FEATURES_ERROR),
    *[(body({"county": "a"}, num_recommendations=k), rq.K_ERROR) for k in (None, "x", "", "2.5", 0, -1, 0.9, False, [3], {"n": 3}, 2**40)],
]


def test_bodies_are_refused(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(REFUSED)], "i int, body string")
    rows = pl.parse_bodies(df, "body", KNOWN).orderBy("i").collect()
    assert [r["error"] for r in rows] == [error for _, error in REFUSED]
    assert all(r[c] is None for r in rows for c in ("k", "own_id", "absent", "nulls", *KNOWN))


def test_feature_names_that_no_path_can_name(spark):
    with pytest.raises(ValueError):
        pl.parse_bodies(spark.createDataFrame([("{}",)], "body string"), "body", ["what?"])


def test_bodies_tell_absent_and_null_apart(spark):
    rows = [body({"old/new": "N", "county": None}), body({"county": 7, "it's": [1, "b"]}, num_recommendations="3", input_property_id=12),
            body({"other": True}, num_recommendations=2.9, input_property_id=None), body({"it's": False}, num_recommendations=True, input_property_id="{x}"),
            body({"county": ""}, num_recommendations=" 4 ", input_property_id=["x"])]
    df = spark.createDataFrame(list(enumerate(rows)), "county int, body string")  # a column of a feature's name is replaced
    got = [tuple(r) for r in pl.parse_bodies(df.withColumnRenamed("county", "i").withColumn("county", F.lit(5)), "body", KNOWN).orderBy("i").collect()]
    assert got == [
        (0, None, 5, None, "N", None, None, "it's", "county"),
        (1, None, 3, "12", None, "7", '[1,"b"]', "old/new", ""),
        (2, None, 2, None, None, None, None, "old/new,county,it's", ""),
        (3, None, 1, "{x}", None, None, "false", "old/new,county", ""),
        (4, None, 4, None, None, "", None, "old/new,it's", "")]


def frame(spark, x, y):
    names = [f"f{i}" for i in range(x.shape[1])]
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "y"])), names


def nearly_collinear(n=3000, seed=2):
    """Eight columns around one direction, far from zero."""
    rs = np.random.RandomState(seed)
    base = rs.normal(size=n)
    x = 1000 + base[:, None] + 1e-6 * rs.normal(size=(n, 8))
    return x, x @ np.arange(1.0, 9.0) + 5


@pytest.mark.parametrize("fan", [64, 2])
def test_qr_fits_nearly_collinear_columns(spark, monkeypatch, fan):
    monkeypatch.setattr(qr, "FAN", fan)
    x, y = nearly_collinear()
    df, names = frame(spark, x, y)
    r = qr.fit_qr(df.repartition(7), names, "y").first()
    slopes = np.array([r[f"b{i}"] for i in range(1, 9)])
    assert (r["n"], r["rank"]) == (3000, 9)
    want = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
    assert np.abs(slopes - np.arange(1, 9)).max() < 1e-3 and np.abs(slopes - want[1:]).max() < 1e-3
    moments = fit_ols(df, names, "y").first()
    assert np.abs(np.array([moments[f"b{i}"] for i in range(1, 9)]) - np.arange(1, 9)).max() > 1e-3  # what it is for


def test_qr_detects_the_rank(spark):
    rs = np.random.RandomState(5)
    a = rs.normal(size=(200, 2))
    x = np.column_stack([a, a[:, 0] - 2 * a[:, 1], np.full(200, 3.0)])  # a combination and a constant
    y = 2 + a[:, 0] + rs.normal(size=200) * 0.1
    df, names = frame(spark, x, y)
    r = qr.fit_qr(df, names, "y").first()
    b = np.array([r[f"b{i}"] for i in range(5)])
    design = np.column_stack([np.ones(200), x])
    fitted = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    assert r["rank"] == 3 and np.abs(design @ b - fitted).max() < 1e-9
    assert abs(r["r2"] - (1 - ((y - fitted) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9


def test_qr_of_awkward_rows(spark):
    rows = [(1.0, 2.0), (None, 1.0), (3.0, None), (float("nan"), 1.0), (float("inf"), 1.0), (2.0, 4.0), (3.0, 6.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    r = qr.fit_qr(df, ["x"], "y").first()
    assert (r["n"], r["rank"]) == (3, 2) and abs(r["b1"] - 2) < 1e-12 and abs(r["b0"]) < 1e-12
    one = qr.fit_qr(df.limit(1), ["x"], "y").first()
    assert (one["n"], one["rank"]) == (1, 1) and abs(one["b0"] + one["b1"] - 2) < 1e-12
    assert qr.fit_qr(df.limit(0), ["x"], "y").count() == 0
