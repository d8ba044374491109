"""Catalogue: batch cutting and training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import ts_text
from tidemark.operators import batching as bt
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import EV_SQL, TX_SQL, register
from tidemark.session import scratch_path
from tidemark.sources import files

# Elapsed-batch settings (the reference closes 3 batches; 7 days closes all three on
# the test events, 10 days leaves the third open), count-batch size, window width.
CLOSED_DAYS, OPEN_DAYS, BATCH_LIMIT = 7, 10, 3
COUNT_SIZE = 2500
WINDOW = "1 day"


def elapsed_sql(days: int | None, limit: int | None, emit_open: bool, tail: str, hours: int | None = None) -> str:
    span = f"INTERVAL {days} DAY" if hours is None else f"INTERVAL {hours} HOUR"
    if limit is None:
        keep = "TRUE" if emit_open else "batch_id <= (SELECT count(*) FROM cuts)"
    else:
        keep = (f"batch_id <= (SELECT CASE WHEN count(*) < {limit} THEN count(*) + 1 ELSE count(*) END FROM cuts)"
                if emit_open else "batch_id <= (SELECT count(*) FROM cuts)")
    stop = f"WHERE c.k < {limit}" if limit is not None else ""
    return f"""WITH RECURSIVE {EV_SQL},
cuts(k, cts, cid) AS (
  SELECT 1, m.ts, m.event_id FROM (SELECT min(ts) AS t0 FROM ev) s,
    LATERAL (SELECT ts, event_id FROM ev WHERE ev.ts >= s.t0 + {span} ORDER BY ts, event_id LIMIT 1) m
  UNION ALL
  SELECT c.k + 1, m.ts, m.event_id FROM cuts c,
    LATERAL (SELECT ts, event_id FROM ev WHERE ev.ts >= c.cts + {span} ORDER BY ts, event_id LIMIT 1) m
  {stop}),
lab AS (SELECT e.*, CAST((SELECT count(*) FROM cuts c WHERE c.cts < e.ts OR (c.cts = e.ts AND c.cid < e.event_id)) + 1 AS BIGINT) AS batch_id
  FROM ev e),
kept AS (SELECT * FROM lab WHERE {keep})
{tail}"""


def _elapsed(spark, sf, days, emit_open):
    ev = fx.events(spark, sf)
    return bt.batch_by_elapsed(ev, "ts", "event_id", f"{days} days", limit=BATCH_LIMIT, emit_open=emit_open)


@register("batch_by_elapsed", sql=elapsed_sql(CLOSED_DAYS, BATCH_LIMIT, False, "SELECT event_id, batch_id FROM kept"))
def batch_by_elapsed(spark, sf):
    return _elapsed(spark, sf, CLOSED_DAYS, False).select("event_id", "batch_id")


@register("batch_by_elapsed_open", sql=elapsed_sql(OPEN_DAYS, BATCH_LIMIT, True, "SELECT event_id, batch_id FROM kept"))
def batch_by_elapsed_open(spark, sf):
    return _elapsed(spark, sf, OPEN_DAYS, True).select("event_id", "batch_id")


# Fixed value: the unlimited configuration (every batch closes every 6 hours, open batch kept).
MANY_HOURS = 6


@register("batch_by_elapsed_unlimited", sql=elapsed_sql(None, None, True, "SELECT event_id, batch_id FROM kept", hours=MANY_HOURS))
def batch_by_elapsed_unlimited(spark, sf):
    """No batch limit: about four batches a day, found by composing what ranges of times do to the chain."""
    ev = fx.events(spark, sf)
    return bt.batch_by_elapsed(ev, "ts", "event_id", f"{MANY_HOURS} hours", limit=None, emit_open=True) \
             .select("event_id", "batch_id")


@register("write_batches_csv", sql=elapsed_sql(CLOSED_DAYS, BATCH_LIMIT, False, """SELECT batch_id, count(*) AS n,
  min(event_id) AS first_event_id, max(event_id) AS last_event_id, round(sum(value), 2) AS sum_value
FROM kept GROUP BY batch_id"""))
def write_batches_csv(spark, sf):
    """Closed batches written as header-less CSV partitioned by batch_id, then re-read."""
    lab = _elapsed(spark, sf, CLOSED_DAYS, False).select("event_id", "ts", "user_id", "event_type", "value", "batch_id")
    path = scratch_path(spark, "batches")
    files.write_csv(lab, path, header=False, partition_by=["batch_id"])
    back = files.read_csv(spark, path, header=False,
                          schema="event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, batch_id BIGINT")
    return back.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event_id"),
                                        F.max("event_id").alias("last_event_id"),
                                        F.round(F.sum("value"), 2).alias("sum_value"))


@register("batch_by_count", sql=f"""SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // {COUNT_SIZE} + 1 AS BIGINT) AS batch_id
FROM events""")
def batch_by_count(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id")
    return bt.batch_by_count(ev, ["event_id"], COUNT_SIZE).select("event_id", "batch_id")


@register("batch_by_count_text_key", sql=f"""WITH k AS (SELECT event_id, CASE WHEN event_id % 7 > 0 THEN md5(CAST(event_id % 97 AS VARCHAR)) END AS key FROM events)
SELECT event_id, CAST((row_number() OVER (ORDER BY key NULLS FIRST, event_id) - 1) // {COUNT_SIZE} + 1 AS BIGINT) AS batch_id FROM k""")
def batch_by_count_text_key(spark, sf):
    """Count batches in the order of a text key with nulls and repeats; no row is lost."""
    key = F.when(F.col("event_id") % 7 > 0, F.md5((F.col("event_id") % 97).cast("string")))
    ev = fx.table(spark, sf, "events").select("event_id", key.alias("key"))
    return bt.batch_by_count(ev, ["key", "event_id"], COUNT_SIZE).select("event_id", "batch_id")


@register("batch_by_window", sql=f"""WITH {EV_SQL}
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
  round(sum(value), 2) AS sum_value FROM ev GROUP BY 1""")
def batch_by_window(spark, sf):
    w = bt.batch_by_window(fx.table(spark, sf, "events"), "ts", WINDOW)  # ts stays TIMESTAMP_NTZ
    return (w.groupBy(F.col("window.start").alias("ws"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("sum_value"))
            .select(ts_text("ws").alias("window_start"), "n", "sum_value"))


@register("train_sets_disjoint", sql=f"""WITH {TX_SQL}
SELECT batch_id, count(*) AS n, round(avg(price), 4) AS mean_price FROM (
  SELECT CAST(ntile(3) OVER (ORDER BY id) AS BIGINT) AS batch_id, price FROM tx) GROUP BY batch_id""")
def train_sets_disjoint(spark, sf):
    s = bt.training_sets(fx.tx(spark, sf).select("id", "price"), ["id"], 3, cumulative=False, out="batch_id")
    return s.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 4).alias("mean_price"))


@register("train_sets_cumulative", sql=f"""WITH {TX_SQL},
t AS (SELECT ntile(3) OVER (ORDER BY id) AS set_id, price FROM tx)
SELECT CAST(m.model_id AS BIGINT) AS model_id, count(*) AS n, round(avg(price), 4) AS mean_price
FROM t JOIN (SELECT unnest([1, 2, 3]) AS model_id) m ON t.set_id <= m.model_id GROUP BY m.model_id""")
def train_sets_cumulative(spark, sf):
    s = bt.training_sets(fx.tx(spark, sf).select("id", "price"), ["id"], 3, cumulative=False, out="set_id")
    per_set = s.groupBy("set_id").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("s"))
    cum = bt.cumulative_sums(per_set, "set_id", 3, ["n", "s"])
    return cum.select(F.col("model_id").cast("bigint").alias("model_id"), F.col("n").cast("bigint").alias("n"),
                      F.round(F.col("s") / F.col("n"), 4).alias("mean_price"))
