"""Catalogue: label maps, index transform, feature assembly."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.columns import safe_double
from tidemark.operators.labels import LabelMaps, fit_label_maps
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import PARTS_SQL, TX_SQL, index_join_sql, register, tx_maps_sql

CATS = fx.TX_CATS
IDX = [f"{c}_index" for c in CATS]
_SEL, _JOIN = index_join_sql(CATS, "tx")


@register("index_labels", sql=f"""WITH {TX_SQL}, {tx_maps_sql(CATS)}
SELECT "column", label, n, "index" FROM tx_maps""")
def index_labels(spark, sf):
    return fit_label_maps(fx.tx(spark, sf), CATS).select("column", "label", "n", "index")


@register("index_transform", sql=f"""WITH {TX_SQL}, {tx_maps_sql(CATS)}
SELECT tx.id, {_SEL}
FROM tx
{_JOIN}""")
def index_transform(spark, sf):
    t = fx.tx(spark, sf)
    return LabelMaps.fit(t, CATS).transform(t).select("id", *IDX)


# Unseen and null values: maps fitted without one brand, applied to every part; ptype has nulls.
_UNSEEN_SRC = "(SELECT id, brand, nullif(ptype, 'ECONOMY') AS ptype FROM parts)"
_U_SEL, _U_JOIN = index_join_sql(["brand", "ptype"], "src", maps="pmaps")


@register("index_transform_unseen", sql=f"""WITH {PARTS_SQL},
src AS {_UNSEEN_SRC},
fitset AS (SELECT * FROM src WHERE brand <> 'Brand#1'),
{tx_maps_sql(["brand", "ptype"], source="fitset", name="pmaps")}
SELECT src.id, {_U_SEL}
FROM src
{_U_JOIN}""")
def index_transform_unseen(spark, sf):
    src = fx.parts(spark, sf).select("id", "brand", F.expr("nullif(ptype, 'ECONOMY')").alias("ptype"))
    maps = LabelMaps.fit(src.where(F.col("brand") != "Brand#1"), ["brand", "ptype"])
    return maps.transform(src).select("id", "brand_index", "ptype_index")


_UNPIVOT = "\n  UNION ALL ".join(
    f"SELECT id, {i} AS pos, {c} AS value FROM ix" for i, c in enumerate(IDX))


@register("assemble_features", sql=f"""WITH {TX_SQL}, {tx_maps_sql(CATS)},
ix AS (SELECT tx.id, {_SEL} FROM tx {_JOIN})
SELECT CAST(id AS BIGINT) AS id, CAST(pos AS INTEGER) AS pos, value FROM (
  {_UNPIVOT})""")
def assemble_features(spark, sf):
    t = fx.tx(spark, sf)
    ix = LabelMaps.fit(t, CATS).transform(t)
    v = VectorAssembler(inputCols=IDX, outputCol="features").transform(ix)
    return v.select("id", F.posexplode(vector_to_array("features")).alias("pos", "value"))


def _bad_price_tx(spark, sf):
    """tx with the price as text, every 10th id unparsable; parsed with a safe cast."""
    t = fx.tx(spark, sf)
    raw = F.when(F.col("id") % 10 == 0, F.lit("x")).otherwise(F.col("price").cast("string"))
    return t.withColumn("price_text", raw).withColumn("price_double", safe_double("price_text"))


_BAD_SQL = """bad AS (SELECT *, TRY_CAST(CASE WHEN id % 10 = 0 THEN 'x' ELSE CAST(price AS VARCHAR) END AS DOUBLE) AS price_double FROM tx)"""


@register("assemble_skip_invalid", sql=f"""WITH {TX_SQL}, {_BAD_SQL}
SELECT id FROM bad WHERE price_double IS NOT NULL""")
def assemble_skip_invalid(spark, sf):
    b = _bad_price_tx(spark, sf)
    v = VectorAssembler(inputCols=["price_double"], outputCol="features", handleInvalid="skip").transform(b)
    return v.select("id")


@register("assemble_keep_invalid", sql=f"""WITH {TX_SQL}, {tx_maps_sql(CATS)}, {_BAD_SQL},
ix AS (SELECT bad.id, bad.price_double, {_SEL.replace('tx.', 'bad.')} FROM bad {_JOIN.replace('tx.', 'bad.')})
SELECT id, CAST(0 AS INTEGER) AS pos, false AS is_nan FROM ix
UNION ALL SELECT id, CAST(1 AS INTEGER) AS pos, price_double IS NULL AS is_nan FROM ix""")
def assemble_keep_invalid(spark, sf):
    b = _bad_price_tx(spark, sf)
    ix = LabelMaps.fit(b, CATS).transform(b, cols=["property_type"])
    v = VectorAssembler(inputCols=["property_type_index", "price_double"], outputCol="features",
                        handleInvalid="keep").transform(ix)
    return v.select("id", F.posexplode(vector_to_array("features")).alias("pos", "value")) \
            .select("id", "pos", F.isnan("value").alias("is_nan"))


@register("assemble_error_invalid", sql=f"""WITH {TX_SQL}, {_BAD_SQL}
SELECT count(*) AS bad_rows, TRUE AS raises FROM bad WHERE price_double IS NULL""")
def assemble_error_invalid(spark, sf):
    """The assembler's default: a null feature stops the job."""
    from tidemark.plans.q_models import raises

    b = _bad_price_tx(spark, sf)
    v = VectorAssembler(inputCols=["price_double"], outputCol="features", handleInvalid="error").transform(b)
    failed = raises(lambda: v.select("features").write.format("noop").mode("overwrite").save())
    return b.where(F.col("price_double").isNull()).agg(F.count("*").alias("bad_rows")).withColumn("raises", F.lit(failed))
