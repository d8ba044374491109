"""Request bodies as JSON text: parsed into typed columns, refused where the endpoint would refuse.

Bodies are parsed once into VARIANT, which tells what plain columns cannot: bad JSON, a value of the
wrong type, a key that is absent and a key whose value is null. One projection for a whole table.

* body: null, bad JSON, no object, or an empty one -> BODY_ERROR
* ``property_features``: absent, null, no object, or an empty one -> FEATURES_ERROR
* ``num_recommendations``: absent -> the default; a whole number, a number cut to its whole part, a
  truth value as 1 or 0, or text of a whole number; null, other types, other text, numbers beyond 32
  bits and counts below 1 -> K_ERROR
* ``input_property_id``: text or number as text; absent, null or another type -> null
* features: text as it is, numbers and truth values as text, objects and lists as JSON text; absent
  and null -> null, told apart by ``absent`` and ``nulls``

The first fault of a body, in this order, is its error. Without one it is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col_
from tidemark.operators.requests import DEFAULT_K, FEATURES_ERROR, K_ERROR

# Fixed value: the error text of a body that is no JSON.
BODY_ERROR = "Request body must be JSON."
_OBJECT, _LIST = "OBJECT", "ARRAY"


def _path(*keys: str) -> str:
    """A VARIANT path. Keys may hold spaces, dots, slashes and one sort of quote; Spark has no way to
    write one with a question mark or with both sorts."""
    path = "$"
    for k in keys:
        quote = '"' if "'" in k else "'"
        if quote in k or "?" in k or not k:
            raise ValueError(f"no VARIANT path can name {k!r}")
        path += f"[{quote}{k}{quote}]"
    return path


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, VOID (JSON null), STRING, BOOLEAN or a number's type; null if there is no value."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _filled_object(v: Column) -> Column:
    return F.coalesce((_kind(v) == _OBJECT) & (F.to_json(v) != "{}"), F.lit(False))


def parse_bodies(df: DataFrame, body: str, known: Sequence[str], default_k: int = DEFAULT_K) -> DataFrame:
    """``df`` without ``body``, with ``error``, ``k``, ``own_id``, the ``known`` features (replacing
    columns of these names), and ``absent`` and ``nulls``: which of them (comma-joined) the body does
    not name, or names with null. All but ``error`` are null in a refused row."""
    parsed = "__body"
    while parsed in df.columns:
        parsed += "_"
    v, absent, nulls = F.col(parsed), [], []
    features = F.try_variant_get(v, _path("property_features"), "variant")
    count = F.try_variant_get(v, _path("num_recommendations"), "variant")
    number = (F.when(_kind(count) == "STRING", F.trim(F.try_variant_get(v, _path("num_recommendations"), "string")).try_cast("int"))
              .when(_kind(count) == "BOOLEAN", F.try_variant_get(v, _path("num_recommendations"), "boolean").cast("int"))
              .when(_kind(count).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
                    F.try_variant_get(v, _path("num_recommendations"), "double").try_cast("int")))
    k = F.when(count.isNull(), F.lit(default_k)).otherwise(number)
    error = (F.when(~_filled_object(v), F.lit(BODY_ERROR)).when(~_filled_object(features), F.lit(FEATURES_ERROR))
             .when(F.coalesce(k < 1, F.lit(True)), F.lit(K_ERROR)))
    ok = error.isNull()
    own = F.try_variant_get(v, _path("input_property_id"), "variant")
    own_text = F.when(~_kind(own).isin(_OBJECT, _LIST, "VOID"), F.try_variant_get(v, _path("input_property_id"), "string"))
    cols = []
    for c in known:
        at = F.try_variant_get(v, _path("property_features", c), "variant")
        kind = _kind(at)
        cols.append(F.when(ok, F.when(kind.isin(_OBJECT, _LIST), F.to_json(at)).otherwise(
            F.try_variant_get(v, _path("property_features", c), "string"))).alias(c))
        absent.append(F.when(at.isNull(), F.lit(c)))
        nulls.append(F.when(F.is_variant_null(at), F.lit(c)))
    made = {"error", "k", "own_id", "absent", "nulls", body, *known}
    keep = [col_(c) for c in df.columns if c not in made]
    rows = df.withColumn(parsed, F.try_parse_json(col_(body).cast("string")))
    return rows.select(*keep, error.alias("error"), F.when(ok, k).alias("k"), F.when(ok, own_text).alias("own_id"), *cols,
                       F.when(ok, F.concat_ws(",", *absent)).alias("absent"), F.when(ok, F.concat_ws(",", *nulls)).alias("nulls"))
