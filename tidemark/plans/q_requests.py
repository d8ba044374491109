"""Catalogue: request validation and defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import payloads as pl
from tidemark.operators import requests as rq
from tidemark.operators.labels import LabelMaps
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import TX_SQL, index_join_sql, register, tx_maps_sql

CATS = fx.TX_CATS
# Which request fields are null (by id divisor) and how the count text is derived.
_NULL_RULE = {"property_type": 11, "duration": 13, "county": 17}
_ALL_NULL = 23
_K_SQL = """CASE id % 6 WHEN 0 THEN 'abc' WHEN 1 THEN '0' WHEN 2 THEN '-1' WHEN 3 THEN NULL
  ELSE CAST(id % 9 + 1 AS STRING) END"""


def _requests(spark, sf):
    return request_rows(fx.tx(spark, sf))


def request_rows(t):
    """Transactions as request rows: some features null (by the rules above), count as text."""
    cols = [F.col("id").alias("request_id")]
    for c in CATS:
        cond = F.col("id") % _ALL_NULL == 0
        if c in _NULL_RULE:
            cond = cond | (F.col("id") % _NULL_RULE[c] == 0)
        cols.append(F.when(cond, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c))
    cols.append(F.expr(_K_SQL).alias("num_recommendations"))
    return t.select(*cols)


def _req_sql_cols() -> str:
    out = []
    for c in CATS:
        cond = f"id % {_ALL_NULL} = 0" + (f" OR id % {_NULL_RULE[c]} = 0" if c in _NULL_RULE else "")
        out.append(f"CASE WHEN {cond} THEN NULL ELSE {c} END AS {c}")
    return ", ".join(out)


def request_rows_sql(source: str = "tx", name: str = "req") -> str:
    return f"{name} AS (SELECT id AS request_id, {_req_sql_cols()}, {_K_SQL} AS num_recommendations FROM {source})"


_REQ_SQL = request_rows_sql()
_MISSING_N = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in CATS)
_MISSING_TXT = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in CATS) + ")"
_K = "CASE WHEN num_recommendations IS NULL THEN 5 ELSE TRY_CAST(num_recommendations AS INTEGER) END"


@register("validate_requests", sql=f"""WITH {TX_SQL}, {_REQ_SQL},
v AS (SELECT request_id, CAST({_MISSING_N} AS INTEGER) AS missing_n, {_MISSING_TXT} AS missing_txt, {_K} AS kp,
  ({' OR '.join(f'{c} IS NOT NULL' for c in CATS)}) AS has_known_feature FROM req),
e AS (SELECT *, CASE WHEN missing_n > 0 THEN '{rq.MISSING_PREFIX}' || missing_txt
  WHEN kp IS NULL OR kp <= 0 THEN '{rq.K_ERROR.replace("'", "''")}' END AS error FROM v)
SELECT request_id, missing_n, CAST(CASE WHEN kp > 0 THEN kp END AS INTEGER) AS k, has_known_feature,
  CASE WHEN error IS NULL THEN 'ok' ELSE 'invalid' END AS status, error FROM e""")
def validate_requests(spark, sf):
    v = rq.validate(_requests(spark, sf), CATS, k_col="num_recommendations")
    return v.select("request_id", "missing_n", "k", "has_known_feature", "status", "error")


# request_defaults: the request table lacks `county`; nulls and the absent column become Unknown,
# then the label maps fitted on tx index them (Unknown is unseen -> map size).
_DEF_SRC = [c for c in CATS if c != "county"]
_D_SEL, _D_JOIN = index_join_sql(CATS, "d")


@register("request_defaults", sql=f"""WITH {TX_SQL}, {_REQ_SQL}, {tx_maps_sql(CATS)},
d AS (SELECT request_id, {', '.join(f"coalesce({c}, 'Unknown') AS {c}" for c in _DEF_SRC)}, 'Unknown' AS county FROM req)
SELECT d.request_id, {', '.join(f'd.{c}' for c in CATS)}, {_D_SEL} FROM d {_D_JOIN}""")
def request_defaults(spark, sf):
    t = fx.tx(spark, sf)
    maps = LabelMaps.fit(t, CATS)
    req = _requests(spark, sf).select("request_id", *_DEF_SRC)
    d = rq.with_defaults(req, CATS)
    return maps.transform(d).select("request_id", *CATS, *[f"{c}_index" for c in CATS])


# bodies of the recommend endpoint: every kind of fault, by the id
_FEATS = ", ".join(f'"{c}": "\' || {c} || \'"' for c in CATS)
_SOME = ", ".join(f'"{c}": "\' || {c} || \'"' for c in CATS if c not in ("district", "county"))
_BODY_SQL = f"""CASE id % 16 WHEN 0 THEN '{{"property_features": ' WHEN 1 THEN 'null' WHEN 2 THEN '{{}}' WHEN 3 THEN '[1, 2]' WHEN 4 THEN NULL
  WHEN 5 THEN '{{"num_recommendations": 3}}' WHEN 6 THEN '{{"property_features": "' || county || '"}}' WHEN 7 THEN '{{"property_features": {{}}}}'
  WHEN 8 THEN '{{"property_features": {{{_FEATS}}}, "num_recommendations": null}}'
  WHEN 9 THEN '{{"property_features": {{{_FEATS}}}, "num_recommendations": "many"}}'
  WHEN 10 THEN '{{"property_features": {{{_FEATS}}}, "num_recommendations": ' || CAST(0 - id % 3 AS STRING) || '}}'
  WHEN 11 THEN '{{"property_features": {{{_SOME}, "county": null}}, "num_recommendations": "' || CAST(id % 7 + 1 AS STRING) || '"}}'
  WHEN 12 THEN '{{"property_features": {{{_SOME}, "district": [' || CAST(id AS STRING) || ']}}, "num_recommendations": 2.75}}'
  WHEN 13 THEN '{{"property_features": {{"county": 7, "other": true}}, "input_property_id": ' || CAST(id AS STRING) || '}}'
  ELSE '{{"property_features": {{{_FEATS}}}, "num_recommendations": ' || CAST(id % 4 + 1 AS STRING) || ', "input_property_id": "' || CAST(id AS STRING) || '"}}' END"""


def body_rows(t):
    """Transactions as request bodies."""
    return t.select(F.col("id").alias("request_id"), F.expr(_BODY_SQL).alias("body"))


BODIES_SQL = f"""bodies AS (SELECT id AS request_id, {_BODY_SQL} AS body FROM tx),
j AS (SELECT request_id, body, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS v FROM bodies),
f AS (SELECT *, json_extract(v, '$.property_features') AS pf, json_type(v, '$.num_recommendations') AS kt,
  json_extract_string(v, '$.num_recommendations') AS ks FROM j),
g AS (SELECT *, CASE WHEN kt IS NULL THEN 5 WHEN kt = 'VARCHAR' THEN TRY_CAST(ks AS INTEGER)
  WHEN kt IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(trunc(CAST(ks AS DOUBLE)) AS INTEGER) END AS kp FROM f),
body_errors AS (SELECT *, CASE WHEN v IS NULL OR json_type(v) <> 'OBJECT' OR CAST(v AS VARCHAR) = '{{}}' THEN '{pl.BODY_ERROR}'
  WHEN pf IS NULL OR json_type(pf) <> 'OBJECT' OR CAST(pf AS VARCHAR) = '{{}}' THEN '{rq.FEATURES_ERROR.replace("'", "''")}'
  WHEN kp IS NULL OR kp < 1 THEN '{rq.K_ERROR.replace("'", "''")}' END AS error FROM g),
parsed AS (SELECT request_id, error, CASE WHEN error IS NULL THEN kp END AS k, CASE WHEN error IS NULL THEN json_extract_string(v, '$.input_property_id') END AS own_id,
  {", ".join(f"CASE WHEN error IS NULL THEN json_extract_string(pf, '$.{c}') END AS {c}" for c in CATS)},
  CASE WHEN error IS NULL THEN concat_ws(',', {", ".join(f"CASE WHEN json_type(pf, '$.{c}') IS NULL THEN '{c}' END" for c in CATS)}) END AS absent,
  CASE WHEN error IS NULL THEN concat_ws(',', {", ".join(f"CASE WHEN json_type(pf, '$.{c}') = 'NULL' THEN '{c}' END" for c in CATS)}) END AS nulls FROM body_errors)"""


@register("parse_bodies", sql=f"""WITH {TX_SQL}, {BODIES_SQL} SELECT * FROM parsed""")
def parse_bodies(spark, sf):
    """JSON bodies to requests: bad JSON, wrong types, absent and null keys told apart."""
    return pl.parse_bodies(body_rows(fx.tx(spark, sf)), "body", CATS)
