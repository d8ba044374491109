"""Frequency-ordered label maps for categorical columns (the StringIndexer semantics).

Fit: count every (column, value) pair in ONE pass over all columns (values stacked to long form,
partial aggregation before the shuffle), order by count desc then label asc, ordinal from 0
(``rank_labels``: no column's labels are sorted in one task unless their number is checked).
Nulls are not labels. Apply: left join per column; null and unseen values get index = number of
labels of that column (``handleInvalid="keep"``).

The label table is exposed as a DataFrame ``(column, label, n, index)`` so it can be joined,
persisted and compared with SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col_
from tidemark.operators.ordinal import with_group_rank
from tidemark.session import write_table

# Maps with at most this many labels for a column are broadcast; larger ones use a shuffle join
# (AQE's skew-join splitting covers a hot label on the data side).
BROADCAST_LABELS = 500_000
# Maps with at most this many labels are applied as literal map lookups (a projection).
INLINE_LABELS = 64
# A (column, count) group with more labels than this is ranked by a distributed sort, not a window.
WINDOW_LABELS = 1_000_000


def stack_values(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Long form ``(extra..., column, label)`` of the listed columns, nulls removed."""
    kv = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col_(c).cast("string").alias("label")) for c in cols]))
    return (df.select(*[col_(e) for e in extra], kv.alias("_kv"))
            .select(*extra, "_kv.column", "_kv.label")
            .where(F.col("label").isNotNull()))


def rank_labels(counts: DataFrame, group_cols: Sequence[str] = (),
                max_window_labels: int = WINDOW_LABELS, largest: int | None = None) -> DataFrame:
    """``counts(group..., column, label, n)`` -> adds ``index`` = rank by (n desc, label asc) - 1.

    ``largest`` is the label count of the biggest map (collected by the caller, or here: one row
    per group and column). Up to ``max_window_labels`` one window per map sorts its labels in a
    task, a size that is checked. Beyond it nothing is sorted in one task:
    index = (labels of the map with a larger count) + (labels with the same count and a smaller
    label). The first term comes from the count histogram ``(column, n) -> labels`` (a column of
    N rows has at most sqrt(2N) distinct counts, so its window is bounded by that); the second
    from one distributed sort that ranks the labels inside every (column, count) group
    (``with_group_rank``): the long tail of a large map puts most labels on the same small count.
    """
    keys = [*group_cols, "column"]
    if largest is None:
        counts = write_table(counts, "label-counts")  # read by the check and the ranking
        largest = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 0
    if largest <= max_window_labels:
        w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("label"))
        return counts.withColumn("index", (F.row_number().over(w) - 1).cast("bigint"))
    hist = counts.groupBy(*keys, "n").agg(F.count(F.lit(1)).alias("_k"))
    higher = Window.partitionBy(*keys).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    above = hist.select(*keys, "n", F.coalesce(F.sum("_k").over(higher), F.lit(0)).alias("_above"))
    same = with_group_rank(counts, [*keys, "n"], [F.asc("label")], out="_within")
    return (same.join(above, [*keys, "n"])  # AQE broadcasts the histogram side when it is small
            .withColumn("index", (F.col("_above") + F.col("_within")).cast("bigint"))
            .drop("_above", "_within"))


def label_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, label, n)`` for all columns in one aggregate (partial counts before the shuffle)."""
    return stack_values(df, cols).groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))


def fit_label_maps(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return rank_labels(label_counts(df, cols))


@dataclass
class LabelMaps:
    """A fitted set of label maps: the label table plus per-column sizes (collected: one row per
    column). Maps of at most ``INLINE_LABELS`` labels are also held as ``{label: index}`` literals
    (one collect of at most INLINE_LABELS x columns rows), so applying them is a projection."""

    table: DataFrame
    cols: list[str]
    sizes: dict[str, int]
    inline: dict[str, dict[str, int]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "LabelMaps":
        counts = write_table(label_counts(df, cols), "label-counts")  # nothing stays in executor storage
        # one row per column: the map sizes (the unseen index) and the bound check of rank_labels
        sizes = {r["column"]: int(r["k"]) for r in counts.groupBy("column").agg(F.count(F.lit(1)).alias("k")).collect()}
        t = rank_labels(counts, largest=max(sizes.values(), default=0))
        small = [c for c in cols if sizes.get(c, 0) <= INLINE_LABELS]
        if len(small) < len(cols):  # joined once per remaining column
            t = write_table(t, "label-maps")
        return cls._with(t, cols, sizes)

    @classmethod
    def of(cls, table: DataFrame, cols: Sequence[str]) -> "LabelMaps":
        """Maps from a stored table (column, label, n, index)."""
        sizes = {r["column"]: int(r["k"]) for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("k")).collect()}  # one row per column
        return cls._with(table, cols, sizes)

    @classmethod
    def _with(cls, t: DataFrame, cols: Sequence[str], sizes: dict[str, int]) -> "LabelMaps":
        small = [c for c in cols if sizes.get(c, 0) <= INLINE_LABELS]
        inline: dict[str, dict[str, int]] = {c: {} for c in small}
        if small:
            for r in t.where(F.col("column").isin(small)).select("column", "label", "index").collect():
                inline[r["column"]][r["label"]] = int(r["index"])  # bounded by the size check
        return cls(t, list(cols), {c: sizes.get(c, 0) for c in cols}, inline)

    def transform(self, df: DataFrame, suffix: str = "_index", cols: Sequence[str] | None = None,
                  out: dict[str, str] | None = None) -> DataFrame:
        """Add ``{col}{suffix}`` (or the name that ``out`` gives) per column, a double; null/unseen -> size
        of that map.

        Inlined maps: a literal map lookup (a projection, no join, no broadcast job). Larger maps:
        a broadcast hash join up to ``BROADCAST_LABELS`` labels, a shuffle join beyond."""
        named, out = out or {}, df
        for c in (cols or self.cols):
            unseen, name = F.lit(float(self.sizes[c])), named.get(c, f"{c}{suffix}")
            if c in self.inline:
                pairs = [x for lbl, i in sorted(self.inline[c].items(), key=lambda kv: kv[1])
                         for x in (F.lit(lbl), F.lit(float(i)))]
                idx = F.try_element_at(F.create_map(*pairs), col_(c).cast("string")) if pairs else F.lit(None)
                out = out.withColumn(name, F.coalesce(idx.cast("double"), unseen))
                continue
            lbl, idx = f"_lbl_{self.cols.index(c)}", f"_idx_{self.cols.index(c)}"
            m = (self.table.where(F.col("column") == c)
                 .select(F.col("label").alias(lbl), F.col("index").cast("double").alias(idx)))
            if self.sizes[c] <= BROADCAST_LABELS:
                m = F.broadcast(m)
            out = (out.join(m, col_(c).cast("string") == F.col(lbl), "left")
                   .withColumn(name, F.coalesce(F.col(idx), unseen)).drop(lbl, idx))
        return out


def assemble(cols: Sequence[str], out: str = "features"):
    """Feature vector as array<double> in the given column order (the table-boundary vector form)."""
    return F.array(*[col_(c).cast("double") for c in cols]).alias(out)
