"""Cutting an arrival-ordered table into training batches.

* elapsed time (the reference's consumer): a batch closes on the first record that arrives at
  least ``interval`` after the batch's anchor; that record belongs to the closing batch and its
  time is the next anchor. At most ``limit`` batches close; later records are never read; the open
  batch is lost unless ``emit_open``.
* record count: ordinal // size (distributed ordinal, no single-task window);
* event-time window: tumbling ``window(ts, width)``;
* training sets: disjoint (set i) or cumulative (sets 1..i) equal-count thirds.

Elapsed cuts: each cut is a scalar aggregate ``min(struct(ts, id))`` over a galloping ts window
past the anchor, compared with timestamp literals so that the range reaches the Parquet reader
(a test asserts the pushed filter). The job count grows with the number of closed batches (bounded
by ``limit``), not with the data; rows are then labelled by a projection against the cut keys, which
are collected (one (ts, id) pair per batch).

A record without a timestamp has not arrived at any time: it is in no batch, not even the open one,
by either method. Ids may be of any orderable type; a null id comes before all others of its time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col_, epoch_micros
from tidemark.operators.chains import chain_cuts
from tidemark.operators.ordinal import with_count_batches, with_ntile


def interval_micros(interval: dt.timedelta | str) -> int:
    """'7 days' / '10 minutes' / '2 hours' / '30 seconds' or a timedelta -> microseconds."""
    if isinstance(interval, dt.timedelta):
        return int(interval / dt.timedelta(microseconds=1))
    num, unit = interval.split()
    unit = unit.lower().rstrip("s")
    scale = {"day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000,
             "millisecond": 1_000, "microsecond": 1}[unit]
    return int(float(num) * scale)


def ts_literal(df: DataFrame, ts_col: str, us: int) -> Column:
    """A literal of the column's own timestamp type, so that comparisons can be pushed to a reader."""
    at = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)
    text = at.isoformat(sep=" ", timespec="microseconds")
    if df.schema[ts_col].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    return F.expr(f"TIMESTAMP '{text}+00:00'")


def _bounds(df: DataFrame, ts_col: str) -> tuple[int, int] | None:
    """(first, last) time in microseconds, or None without any."""
    span = df.agg(F.min(col_(ts_col)).alias("lo"), F.max(col_(ts_col)).alias("hi"))
    r = span.select(epoch_micros(span, "lo").alias("lo"), epoch_micros(span, "hi").alias("hi")).first()
    return None if r["lo"] is None else (int(r["lo"]), int(r["hi"]))


def elapsed_cuts(df: DataFrame, ts_col: str, id_col: str, interval, limit: int | None = None,
                 anchor_us: int | None = None) -> list[tuple[int, object]]:
    """The closing records ``(ts_micros, id)`` of the elapsed-time batches, in order.

    Each cut is the smallest (ts, id) with ts >= anchor + interval. It is searched in a galloping
    window [anchor + interval, anchor + interval + w) that widens x4 only while empty, so on
    time-ordered files each search reads a narrow range of row groups instead of everything after
    the anchor.
    """
    step = interval_micros(interval)
    bounds = _bounds(df, ts_col)
    if bounds is None:
        return []
    lo, hi = bounds
    anchor_us = lo if anchor_us is None else anchor_us
    ts = col_(ts_col)
    cuts: list[tuple[int, object]] = []
    while limit is None or len(cuts) < limit:
        start = anchor_us + step
        if start > hi:
            break
        width = max(step, 1)
        while True:
            r = _first_record(df.where((ts >= ts_literal(df, ts_col, start)) & (ts < ts_literal(df, ts_col, start + width))),
                              ts_col, id_col)
            if r is not None or start + width > hi:
                break
            width *= 4
        if r is None:
            break
        cuts.append(r)
        anchor_us = r[0]
    return cuts


def _first_record(df: DataFrame, ts_col: str, id_col: str) -> tuple[int, object] | None:
    least = df.agg(F.min(F.struct(col_(ts_col).alias("ts"), col_(id_col).alias("id"))).alias("m")).select("m.ts", "m.id")
    r = least.select(epoch_micros(least, "ts").alias("us"), "id").first()
    return None if r["us"] is None else (int(r["us"]), r["id"])


def _not_after(rid: Column, cut_id) -> Column:
    """Whether a record of the cut's own time comes no later than the cut (null ids first)."""
    if cut_id is None:
        return rid.isNull()
    return rid.isNull() | (rid <= (cut_id if isinstance(cut_id, Column) else F.lit(cut_id)))


def batch_of(us: Column, rid: Column, cuts: Sequence[tuple[int, object]]) -> Column:
    """1 + number of cuts strictly before (us, id): the batch of a row given the closing records;
    null for a record without a time."""
    e = F.when(us.isNull(), F.lit(None).cast("int"))
    for k, (cu, ci) in enumerate(cuts, start=1):
        e = e.when((us < F.lit(cu)) | ((us == F.lit(cu)) & _not_after(rid, ci)), F.lit(k))
    return e.otherwise(F.lit(len(cuts) + 1)).cast("bigint")


def batch_by_elapsed(df: DataFrame, ts_col: str, id_col: str, interval, limit: int | None = 3,
                     emit_open: bool = False, out: str = "batch_id", anchor_us: int | None = None,
                     method: str = "auto") -> DataFrame:
    """Elapsed-time batches. ``method``: ``scan`` (one narrow search job per cut, best for a small
    limit such as the reference's 3), ``many`` (for long chains) or ``auto``."""
    if method == "many" or (method == "auto" and (limit is None or limit > SCAN_LIMIT)):
        return batch_by_elapsed_many(df, ts_col, id_col, interval, limit, emit_open, out, anchor_us)
    cuts = elapsed_cuts(df, ts_col, id_col, interval, limit, anchor_us)
    labelled = df.withColumn(out, batch_of(epoch_micros(df, ts_col), col_(id_col), cuts))
    closed = len(cuts)
    if emit_open and (limit is None or closed < limit):
        return labelled.where(F.col(out).isNotNull())
    # rows after the last cut are never read: its time is a literal bound on ts
    if cuts:
        labelled = labelled.where(col_(ts_col) <= ts_literal(df, ts_col, cuts[-1][0]))
    return labelled.where(F.col(out) <= closed)


def batch_by_count(df: DataFrame, order_cols: Sequence[str], size: int, limit: int | None = None,
                   out: str = "batch_id") -> DataFrame:
    return with_count_batches(df, order_cols, size, out=out, limit=limit)


def batch_by_window(df: DataFrame, ts_col: str, width: str, out: str = "window") -> DataFrame:
    """Tumbling event-time window per row (struct start/end).

    A TIMESTAMP_NTZ column is windowed as is (boundaries independent of the session time zone);
    a zoned TIMESTAMP is aligned to the epoch in UTC terms."""
    return df.withColumn(out, F.window(F.col(ts_col), width))


def training_sets(df: DataFrame, order_cols: Sequence[str], n_sets: int = 3, cumulative: bool = False,
                  out: str = "model_id") -> DataFrame:
    """Rows tagged with the model(s) they train: disjoint -> set i; cumulative -> every model >= i.

    The cumulative form replicates rows (up to n_sets times); aggregates over it should prefer
    ``cumulative_aggregate``, which replicates per-set partial aggregates instead."""
    tiles = with_ntile(df, order_cols, n_sets, out="set_id")
    if not cumulative:
        return tiles.withColumnRenamed("set_id", out)
    return tiles.withColumn(out, F.explode(F.sequence(F.col("set_id"), F.lit(n_sets)))).drop("set_id")


def cumulative_sums(per_set: DataFrame, set_col: str, n_sets: int, sum_cols: Sequence[str],
                    out: str = "model_id") -> DataFrame:
    """Per-set additive aggregates -> per-model totals over sets 1..model (replicates only the
    n_sets partial rows, never the data)."""
    rep = per_set.withColumn(out, F.explode(F.sequence(F.col(set_col), F.lit(n_sets))))
    return rep.groupBy(out).agg(*[F.sum(c).alias(c) for c in sum_cols])


# ---- many batches ---------------------------------------------------------------------------------
# With no batch limit (or a large one) the cut chain can be long: one search job per cut would make
# the job count grow with the time span. Instead ranges of sorted times are functions on the chain
# that are composed up and down a tree (``chains.chain_cuts``), which takes a number of jobs that
# does not depend on the rows. Where a single interval holds more times than such a table may have,
# the chain is computed by pointer doubling, O(log) rounds of joins:
#   1. distinct timestamps D get ranks (distributed ordinal);
#   2. next(t) = rank of the first time >= t + interval, an as-of found with ONE ordinal over the
#      union of probes (t + interval) and values (probes sort first on ties);
#   3. jump tables J_k = next^(2^k) by pointer doubling (a self-join per level, each level written
#      to the shared checkpoint folder so the lineage stays flat);
#   4. the chain from the first cut is expanded top-down: S <- S u J_k(S) for k = K..0.
# Rows are labelled by the number of cuts before them (binary search over collected cut times when
# the cut count is checked to be small, else a distributed union ordinal).

MAX_COLLECTED_CUTS = 100_000
SCAN_LIMIT = 32


def _ckpt(df: DataFrame) -> DataFrame:
    from tidemark.session import write_table
    return write_table(df, "elapsed-level")


def elapsed_cut_table(df: DataFrame, ts_col: str, id_col: str, interval, limit: int | None = None,
                      anchor_us: int | None = None) -> DataFrame:
    """Closing records as a DataFrame ``(k, cut_us, cut_id)`` for chains of any length."""
    from tidemark.operators.ordinal import with_ordinal

    spark = df.sparkSession
    step = interval_micros(interval)
    keyed = df.where(col_(ts_col).isNotNull()).select(epoch_micros(df, ts_col).alias("_us"), col_(id_col).alias("_id"))
    empty = spark.createDataFrame([], f"k bigint, cut_us bigint, cut_id {df.schema[id_col].dataType.simpleString()}")
    bounds = _bounds(df, ts_col)
    if bounds is None:
        return empty
    lo, hi = bounds
    anchor = lo if anchor_us is None else int(anchor_us)
    # distinct times that the chain may cut at, each with its first id (a null id comes first)
    times = keyed.groupBy("_us").agg(F.min(F.struct("_id"))["_id"].alias("_cid"))
    later = _ckpt(times.where(F.col("_us") >= F.lit(anchor + step)))
    found = chain_cuts(later, step)
    if found is not None:
        out = found if limit is None else found.where(F.col("k") <= limit)
        return _ckpt(out.join(later, "_us").select("k", F.col("_us").alias("cut_us"), F.col("_cid").alias("cut_id")))
    ranked = _ckpt(with_ordinal(times, ["_us"], out="r", with_total=True))  # r, r_total
    probes = ranked.select((F.col("_us") + F.lit(step)).alias("time"), F.lit(0).alias("kind"), F.col("r").alias("pr"))
    values = ranked.select(F.col("_us").alias("time"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("pr"))
    union = with_ordinal(probes.unionByName(values), ["time", "kind"], out="o")
    total = ranked.select(F.max("r_total")).first()[0]
    # values before a probe = its union position minus the probes before it (= its own rank)
    nxt = union.where(F.col("kind") == 0).select(F.col("pr").alias("r"), (F.col("o") - F.col("pr")).alias("nr"))
    levels = [_ckpt(nxt.where(F.col("nr") < F.lit(total)))]
    max_chain = (hi - anchor) // max(step, 1) + 1
    while (1 << len(levels)) <= max_chain:
        a, b = levels[-1].alias("a"), levels[-1].alias("b")
        levels.append(_ckpt(a.join(b, F.col("a.nr") == F.col("b.r")).select(F.col("a.r"), F.col("b.nr"))))
    first = keyed.where(F.col("_us") >= F.lit(anchor + step)).agg(F.min("_us")).first()[0]
    if first is None:
        return empty
    s0 = ranked.where(F.col("_us") == F.lit(first)).select("r").first()[0]
    chain_schema = "m bigint, r bigint"
    if max_chain <= MAX_COLLECTED_CUTS:
        # the chain has at most max_chain members (checked): it stays a collected list, extended
        # each round by one broadcast join against the level table, with no table written per round
        members = [(0, int(s0))]
        for k in reversed(range(len(levels))):
            cur = F.broadcast(spark.createDataFrame(members, chain_schema))
            ext = cur.join(levels[k], "r").select((F.col("m") + F.lit(1 << k)).alias("m"), F.col("nr").alias("r"))
            members += [(int(x["m"]), int(x["r"])) for x in ext.collect()]
        chain = spark.createDataFrame(members, chain_schema)
    else:
        chain = spark.createDataFrame([(0, int(s0))], chain_schema)
        for k in reversed(range(len(levels))):
            j = levels[k]
            ext = chain.join(j, "r").select((F.col("m") + F.lit(1 << k)).alias("m"), F.col("nr").alias("r"))
            chain = _ckpt(chain.unionByName(ext))
    if limit is not None:
        chain = chain.where(F.col("m") < limit)
    return (chain.join(ranked, "r")
            .select((F.col("m") + 1).alias("k"), F.col("_us").alias("cut_us"), F.col("_cid").alias("cut_id")))


def label_by_cut_table(df: DataFrame, ts_col: str, id_col: str, cuts: DataFrame, out: str = "batch_id") -> DataFrame:
    """batch = 1 + number of cuts strictly before (ts, id)."""
    from pyspark.ml.feature import Bucketizer

    from tidemark.operators.ordinal import with_ordinal

    n_cuts = cuts.count()
    df = df.where(col_(ts_col).isNotNull())
    us = epoch_micros(df, ts_col)
    if n_cuts == 0:
        return df.withColumn(out, F.lit(1).cast("bigint"))
    if n_cuts <= MAX_COLLECTED_CUTS:
        # cut times are strictly increasing (>= interval apart): a binary search per row
        rows = cuts.orderBy("k").select("cut_us").collect()  # bounded by the check above
        splits = [float("-inf")] + [float(r[0]) for r in rows] + [float("inf")]
        keyed = df.withColumn("_us", us.cast("double"))
        b = Bucketizer(splits=splits, inputCol="_us", outputCol="_le").transform(keyed)  # cuts with cut_us <= us
        same = F.broadcast(cuts.select(F.col("cut_us").cast("double").alias("_cu"), F.col("cut_id").alias("_ci")))
        j = b.join(same, b["_us"] == same["_cu"], "left")
        # a null id comes first; a cut whose id is null is followed by every other id of its time
        no_later = col_(id_col).isNull() | F.coalesce(col_(id_col) <= F.col("_ci"), F.lit(False))
        before = F.col("_le") - F.when(F.col("_cu").isNotNull() & no_later, 1).otherwise(0)
        return j.withColumn(out, (before + 1).cast("bigint")).drop("_us", "_le", "_cu", "_ci")
    # many cuts: rows sort before their own cut; cuts before a row = union position - row position
    rows_k = df.withColumn("_us", us).withColumn("_kind", F.lit(0))
    cut_k = cuts.select(F.col("cut_us").alias("_us"), F.col("cut_id").alias(id_col), F.lit(1).alias("_kind"))
    u = with_ordinal(rows_k.select("_us", id_col, "_kind").unionByName(cut_k), ["_us", id_col, "_kind"], out="_o")
    u = u.where(F.col("_kind") == 0)
    r = with_ordinal(rows_k, ["_us", id_col], out="_or")
    u = u.select(F.col("_us").alias("_u"), col_(id_col).alias("_i"), "_o")
    lab = r.join(u, (r["_us"] == u["_u"]) & r[id_col].eqNullSafe(u["_i"])).drop("_u", "_i")
    return lab.withColumn(out, (F.col("_o") - F.col("_or") + 1).cast("bigint")).drop("_us", "_kind", "_o", "_or")


def batch_by_elapsed_many(df: DataFrame, ts_col: str, id_col: str, interval, limit: int | None = None,
                          emit_open: bool = False, out: str = "batch_id", anchor_us: int | None = None) -> DataFrame:
    """``batch_by_elapsed`` for long chains."""
    cuts = elapsed_cut_table(df, ts_col, id_col, interval, limit, anchor_us)
    closed = cuts.count()
    labelled = label_by_cut_table(df, ts_col, id_col, cuts, out)
    if emit_open and (limit is None or closed < limit):
        return labelled
    return labelled.where(F.col(out) <= closed)
