"""Global ordinals without a single-task window.

``row_number() over (order by k)`` with no partition moves every row into one task. Here one
distributed sort does it: range partitioning on the *whole* order key (Spark samples the composite
key, so a value that holds a third of the rows is split by the later columns), a sort inside each
partition, each row tagged with (partition, position), written once to the shared checkpoint folder
so that the sampled ranges are fixed, and per-partition counts prefix-summed and joined back.

So the input is evaluated for the sample and once for the sort, whatever the branches of the plan
that use the ordinal. The key may be of any orderable type (numbers, text, dates; a TIMESTAMP_NTZ is
ordered as it stands, without the session's zone) and may hold nulls, which come first. It should
be unique: rows with equal keys get different ordinals, in no particular order.

The same path ranks rows inside groups of any size (``with_group_rank``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID, _LOC, _CNT, _OFF, _TOT = "_tm_pid", "_tm_loc", "_tm_cnt", "_tm_off", "_tm_total"
_MID, _ORD, _START = "_tm_mid", "_tm_ord", "_tm_start"
_POS_BITS = 33  # monotonically_increasing_id: partition index above bit 33, position below


def _nulls_first(c: str | Column) -> Column:
    return F.col(f"`{c}`").asc_nulls_first() if isinstance(c, str) else c


def _offsets(counts: DataFrame) -> DataFrame:
    """``(_tm_pid, _tm_cnt)`` -> rows before each bucket and the total: one row per bucket, so the
    unpartitioned window and the broadcast that follows are bounded by the bucket count."""
    w = Window.orderBy(_PID)
    return counts.select(
        _PID,
        (F.sum(_CNT).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(_CNT)).alias(_OFF),
        F.sum(_CNT).over(Window.partitionBy(F.lit(0))).alias(_TOT),
    )


def sorted_positions(df: DataFrame, order: Sequence, num_partitions: int | None = None,
                     out: str = _ORD, with_total: bool = False) -> DataFrame:
    """Add a 0-based global position ``out`` by ``order`` (columns or sort expressions, unique
    together) through one distributed sort; a hot leading value is split by the later keys.

    The range-partitioned, sorted rows are written to the shared checkpoint folder once (Parquet):
    Spark re-samples range bounds on every evaluation, so both uses below must read the same copy;
    the per-partition counts read only the tag column."""
    from tidemark.session import write_table

    order = [_nulls_first(c) for c in order]
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged.sortWithinPartitions(*order)
              .withColumn(_MID, F.monotonically_increasing_id()))
    fixed = write_table(tagged, "sorted-positions")
    pos = (fixed.withColumn(_PID, F.shiftright(F.col(_MID), _POS_BITS).cast("int"))
           .withColumn(_LOC, F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1))).drop(_MID))
    counts = pos.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    res = (pos.join(F.broadcast(_offsets(counts)), _PID)
           .withColumn(out, (F.col(_OFF) + F.col(_LOC)).cast("bigint")).drop(_PID, _LOC, _CNT, _OFF))
    if with_total:
        return res.withColumnRenamed(_TOT, f"{out}_total")
    return res.drop(_TOT)


def with_group_rank(df: DataFrame, group_cols: Sequence[str], order: Sequence, out: str = "rank",
                    num_partitions: int | None = None) -> DataFrame:
    """0-based rank inside each group by ``order`` (unique within a group), for groups of any size:
    one distributed sort on (group, order), then position minus the group's first position. The
    starts table has one row per group (a partial min aggregate); the join lets AQE pick broadcast
    from its measured size."""
    pos = sorted_positions(df, [*group_cols, *order], num_partitions)
    starts = pos.groupBy(*group_cols).agg(F.min(_ORD).alias(_START))
    return (pos.join(starts, list(group_cols))
            .withColumn(out, (F.col(_ORD) - F.col(_START)).cast("bigint")).drop(_ORD, _START))


def with_ordinal(df: DataFrame, order_cols: Sequence[str], out: str = "ordinal",
                 num_partitions: int | None = None, with_total: bool = False) -> DataFrame:
    """Add a 0-based global position ``out`` by ``order_cols`` (ascending, nulls first)."""
    return sorted_positions(df, list(order_cols), num_partitions, out=out, with_total=with_total)


def ntile_expr(ordinal: str, total: str, n: int):
    """SQL ``ntile(n)`` from a 0-based ordinal and the row total: the first ``total % n`` tiles
    get one extra row."""
    o, t = F.col(ordinal), F.col(total)
    q = F.floor(t / n)
    rem = t - q * n
    big = rem * (q + 1)
    return (F.when(o < big, F.floor(o / (q + 1)) + 1)
            .otherwise(rem + F.floor((o - big) / F.greatest(q, F.lit(1))) + 1)).cast("bigint")


def with_ntile(df: DataFrame, order_cols: Sequence[str], n: int, out: str = "tile",
               num_partitions: int | None = None) -> DataFrame:
    """Equal-count tiles in order (``ntile(n) over (order by ...)``) without a single-task window."""
    o = with_ordinal(df, order_cols, out="_tm_ord", num_partitions=num_partitions, with_total=True)
    return o.withColumn(out, ntile_expr("_tm_ord", "_tm_ord_total", n)).drop("_tm_ord", "_tm_ord_total")


def with_count_batches(df: DataFrame, order_cols: Sequence[str], size: int, out: str = "batch_id",
                       limit: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Batch by record count: positions 0..size-1 -> 1, and so on. ``limit`` keeps batches <= limit."""
    o = with_ordinal(df, order_cols, out="_tm_ord", num_partitions=num_partitions)
    res = o.withColumn(out, (F.floor(F.col("_tm_ord") / size) + 1).cast("bigint")).drop("_tm_ord")
    if limit is not None:
        res = res.where(F.col(out) <= limit)
    return res
