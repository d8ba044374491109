"""Row operators: presence projection, label cast/drop, Unknown fill, self exclusion, sampling."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col_, safe_double

log = logging.getLogger(__name__)

UNKNOWN = "Unknown"


def present_columns(df: DataFrame, wanted: Sequence[str], policy: str = "skip") -> list[str]:
    """The wanted columns that exist, in list order.

    policy ``require``: any absent column is an error; ``skip``: absent ones are dropped with a
    warning; ``nonempty``: like skip, but an empty result is an error.
    """
    have = set(df.columns)
    present = [c for c in wanted if c in have]
    missing = [c for c in wanted if c not in have]
    if missing:
        if policy == "require":
            raise ValueError(f"missing columns: {missing}")
        log.warning("columns not in the data, skipped: %s", missing)
    if policy == "nonempty" and not present:
        raise ValueError("none of the wanted columns is present")
    return present


def project_present(df: DataFrame, wanted: Sequence[str], policy: str = "skip") -> DataFrame:
    return df.select(*[col_(c) for c in present_columns(df, wanted, policy)])


def drop_bad_label(df: DataFrame, label: str, out: str | None = None) -> DataFrame:
    """Cast the label to double (bad text -> null) and drop rows whose cast is null."""
    out = out or f"{label}_double"
    return df.withColumn(out, safe_double(label)).na.drop(subset=[out])


def fill_unknown(df: DataFrame, cols: Sequence[str], value: str = UNKNOWN) -> DataFrame:
    """Cast categorical columns to string and replace nulls by ``value``."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(col_(c).cast("string"), F.lit(value)))
    return out


def exclude_id(df: DataFrame, id_col: str, value) -> DataFrame:
    """Drop the row(s) with the given id. SQL ``!=`` semantics: rows with a null id go too.
    No-op when the id is not given or the column is absent."""
    if value is None or id_col not in df.columns:
        return df
    return df.where(col_(id_col) != F.lit(value))


def sample_rows(df: DataFrame, n: int, id_col: str, seed: int | None = None) -> DataFrame:
    """``n`` rows in a pseudo-random order: by md5(id) (reproducible) or rand(seed).

    A distributed top-n (TakeOrderedAndProject: a local top-n per partition, then n rows per
    partition merged), not a full sort. Some projections laid over a limit make the planner fall
    back to a global range sort of the whole input; the one-partition repartition after the limit
    (it moves only the n sampled rows) keeps later projections off the top-n."""
    key = F.md5(col_(id_col).cast("string")) if seed is None else F.rand(seed)
    return df.orderBy(key, col_(id_col)).limit(n).repartition(1)
