"""Requests as a table: validation and defaults (the reference's API checks, re-aimed at many rows).

A request row holds feature columns (possibly absent or null), an optional requested result count
as text, an optional own id. Checks become columns (``status``, ``error``, ``missing_n``, ``k``,
``has_known_feature``) so that a whole table of requests is validated in one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col_, safe_int
from tidemark.operators.rows import UNKNOWN

# Default result count and the error texts of the reference's checks.
DEFAULT_K = 5
K_ERROR = "'num_recommendations' must be a positive integer."
MISSING_PREFIX = "Missing columns in input: "
FEATURES_ERROR = "Missing or invalid 'property_features' in JSON payload. It should be a dictionary."


def with_defaults(df: DataFrame, cols: Sequence[str], default: str = UNKNOWN) -> DataFrame:
    """Every listed column present as string: absent -> ``default``; null -> ``default``."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(col_(c).cast("string"), F.lit(default)) if c in df.columns
                             else F.lit(default))
    return out


def validate(df: DataFrame, required: Sequence[str], k_col: str | None = None,
             known: Sequence[str] | None = None, default_k: int = DEFAULT_K, any_feature: bool = False) -> DataFrame:
    """Add validation columns. Required columns that are absent count as missing (null). With
    ``any_feature`` a request that gives none of the known features is refused."""
    present = set(df.columns)
    req_null = [(c, (col_(c).isNull() if c in present else F.lit(True))) for c in required]
    missing_n = sum((F.when(isnull, 1).otherwise(0) for _, isnull in req_null), F.lit(0))
    missing_txt = F.concat_ws(",", *[F.when(isnull, F.lit(c)) for c, isnull in req_null])
    if k_col is not None and k_col in present:
        k_parsed = F.when(col_(k_col).isNull(), F.lit(default_k)).otherwise(safe_int(k_col))
    else:
        k_parsed = F.lit(default_k)
    k_ok = k_parsed.isNotNull() & (k_parsed > 0)
    kn = [c for c in (known or required) if c in present]
    has_known = F.lit(False)
    for c in kn:
        has_known = has_known | col_(c).isNotNull()
    err = (F.when(F.lit(any_feature) & ~has_known, F.lit(FEATURES_ERROR))
           .when(missing_n > 0, F.concat(F.lit(MISSING_PREFIX), missing_txt))
           .when(~k_ok, F.lit(K_ERROR)))
    outs = ("missing_n", "k", "has_known_feature", "status", "error")
    keep = [col_(c) for c in df.columns if c not in outs]  # outputs replace same-named inputs
    return df.select(
        *keep,
        missing_n.cast("int").alias("missing_n"),
        F.when(k_ok, k_parsed).cast("int").alias("k"),
        has_known.alias("has_known_feature"),
        F.when(err.isNull(), F.lit("ok")).otherwise(F.lit("invalid")).alias("status"),
        err.alias("error"),
    )
