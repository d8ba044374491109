"""Catalogue: streaming forms (S1 S2 K1 W1 W5 W8), run with ``trigger(availableNow=True)``.

Inputs are staged from the test tables into a fresh folder under the shared checkpoint root (the
"producer" side: a line sink / record sink) and consumed as a file stream. Ordered inputs arrive in
slices of many files; the stream runs once per slice on one checkpoint, so each slice but the first
is a restart. Results are read back from the ``foreachBatch`` sink as batch DataFrames.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import epoch_micros
from tidemark.operators.ordinal import with_ntile
from tidemark.plans import fixtures as fx
from tidemark.plans.q_batches import BATCH_LIMIT, CLOSED_DAYS, elapsed_sql
from tidemark.plans.registry import EV_SQL, register
from tidemark.session import scratch_path
from tidemark.sources import lines
from tidemark.streaming.cutter import ElapsedCutter
from tidemark.streaming.keyed_cutter import KeyedCutter
from tidemark.streaming.sources import run_available_now, stream_files

# Fixed value: number of ordered slices (micro-batches) the staged event stream is cut into.
SLICES = 4
EV_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
EV_HEADER = ",".join(EV_COLS)


def ordered_slices(df, order_cols: list[str], path: str, slices: int = SLICES):
    """Append ``df`` to ``path`` in ``slices`` steps in the order of ``order_cols``, each step's rows in
    parallel; yields after each step. The order is computed once (a written distributed sort)."""
    tiled = with_ntile(df, order_cols, slices, out="_tm_slice")
    for i in range(1, slices + 1):
        tiled.where(F.col("_tm_slice") == i).drop("_tm_slice").write.mode("append").parquet(path)
        yield i


@register("stream_line_source", sql="SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_line_source(spark, sf):
    """Events as text lines (header record included) -> line sink -> line stream -> strip, drop
    header, split -> running count per event type (complete mode)."""
    ev = fx.table(spark, sf, "events")
    body = lines.to_lines(ev, EV_COLS)
    src = spark.createDataFrame([(EV_HEADER,)], "value string").unionByName(body)
    inp = scratch_path(spark, "line-stream-in")
    lines.write_lines(src, inp)  # as many files as the table has partitions; their order is irrelevant for a count
    stream = stream_files(spark, inp, "text", max_files_per_trigger=None)
    parsed = lines.split_naive(lines.clean_lines(stream, header=EV_HEADER), EV_COLS)
    counts = parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    out = scratch_path(spark, "line-stream-out")

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(out)

    run_available_now(counts, scratch_path(spark, "ckpt-lines"), sink, output_mode="complete")
    return spark.read.parquet(out)


def run_elapsed_stream(spark, sf, days: int, limit: int):
    ev = fx.events(spark, sf).select(*EV_COLS)
    inp, base, ckpt = (scratch_path(spark, x) for x in ("events-stream-in", "cutter", "ckpt-cutter"))
    cutter = None
    for _ in ordered_slices(ev, ["event_id"], inp):
        # a new cutter each time: it has only the written state to go on
        cutter = ElapsedCutter(spark, base, "ts", "event_id", f"{days} days", limit, schema=ev.schema)
        if cutter.done:
            break
        run_available_now(stream_files(spark, inp, "parquet", schema=ev.schema, max_files_per_trigger=None), ckpt, cutter)
    return cutter


@register("batch_by_elapsed_stream", sql=elapsed_sql(CLOSED_DAYS, BATCH_LIMIT, False, """SELECT batch_id, count(*) AS n,
  min(event_id) AS first_event_id, max(event_id) AS last_event_id FROM kept GROUP BY batch_id"""))
def batch_by_elapsed_stream(spark, sf):
    rows = run_elapsed_stream(spark, sf, CLOSED_DAYS, BATCH_LIMIT).result()
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event_id"),
                                        F.max("event_id").alias("last_event_id"))


# Each user's stream closes batches of at least a day, at most so many of them
KEYED_HOURS, KEYED_LIMIT = 24, 12


@register("batch_by_elapsed_per_key", sql=f"""WITH RECURSIVE {EV_SQL},
cuts(user_id, k, cut) AS (
  SELECT ev.user_id, 1, min({{'ts': ev.ts, 'id': ev.event_id}}) FROM ev
  JOIN (SELECT user_id, min(ts) AS t0 FROM ev GROUP BY user_id) s ON s.user_id IS NOT DISTINCT FROM ev.user_id
    AND ev.ts >= s.t0 + INTERVAL {KEYED_HOURS} HOUR GROUP BY ev.user_id
  UNION ALL
  SELECT c.user_id, c.k + 1, min({{'ts': ev.ts, 'id': ev.event_id}}) FROM cuts c
  JOIN ev ON c.user_id IS NOT DISTINCT FROM ev.user_id AND ev.ts >= c.cut.ts + INTERVAL {KEYED_HOURS} HOUR
  WHERE c.k < {KEYED_LIMIT} GROUP BY c.user_id, c.k)
SELECT e.user_id, c.k AS batch_id, count(*) AS n, min(e.event_id) AS first_event_id, max(e.event_id) AS last_event_id,
  c.cut.id AS closing_id
FROM cuts c LEFT JOIN cuts p ON p.user_id IS NOT DISTINCT FROM c.user_id AND p.k = c.k - 1
JOIN ev e ON e.user_id IS NOT DISTINCT FROM c.user_id AND (e.ts, e.event_id) <= (c.cut.ts, c.cut.id)
  AND (p.k IS NULL OR (e.ts, e.event_id) > (p.cut.ts, p.cut.id))
GROUP BY e.user_id, c.k, c.cut""")
def batch_by_elapsed_per_key(spark, sf):
    """One cutter per user, with its state in Spark's state store; a restart between the two slices."""
    ev = fx.events(spark, sf).select(*EV_COLS)
    inp, base = scratch_path(spark, "keyed-stream-in"), scratch_path(spark, "keyed-cutter")
    for _ in ordered_slices(ev, ["ts", "event_id"], inp, slices=2):
        cutter = KeyedCutter(spark, base, "user_id", "ts", "event_id", f"{KEYED_HOURS} hours", KEYED_LIMIT)
        cutter.run(stream_files(spark, inp, "parquet", schema=ev.schema, max_files_per_trigger=None))
    closing = F.max(F.when(F.col("closes"), F.col("event_id"))).alias("closing_id")
    return cutter.result(ev.schema).groupBy("user_id", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event_id"), F.max("event_id").alias("last_event_id"), closing)


WATERMARK_MINUTES = 10
_WINDOW_SQL = """WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, CAST(ts AS TIMESTAMP)) AS s,
  count(*) AS n, round(sum(value), 2) AS sum_value FROM events GROUP BY 1)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, n, sum_value FROM w"""


def _window_stream(spark, sf, mode: str):
    """Tumbling 1-day windows over the event stream, one run of the stream per slice on one checkpoint."""
    ev = fx.table(spark, sf, "events").select(*EV_COLS)
    # the instant that the zone-free time names in UTC: windows do not depend on the session's zone
    ev = ev.withColumn("at", F.timestamp_micros(epoch_micros(ev, "ts")))
    inp, out, ckpt = (scratch_path(spark, x) for x in ("window-stream-in", "window-stream-out", "ckpt-window"))

    def sink(batch, epoch):
        # in complete mode an epoch holds every window so far and takes the place of the one before
        part = "all" if mode == "complete" else f"epoch={epoch}"
        batch.select(F.unix_micros("w.start").alias("us"), "n", F.round("s", 2).alias("sum_value")) \
             .write.mode("overwrite").parquet(f"{out}/{part}")

    for _ in ordered_slices(ev, ["at", "event_id"], inp):
        stream = stream_files(spark, inp, "parquet", schema=ev.schema, max_files_per_trigger=None)
        if mode == "append":
            stream = stream.withWatermark("at", f"{WATERMARK_MINUTES} minutes")
        agg = stream.groupBy(F.window("at", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))
        run_available_now(agg, ckpt, sink, output_mode=mode)
    rows = spark.read.parquet(f"{out}/all" if mode == "complete" else out)
    start = F.expr("timestampadd(MICROSECOND, us, TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    return rows.select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "sum_value")


@register("batch_by_window_stream", sql=_WINDOW_SQL)
def batch_by_window_stream(spark, sf):
    """Every window of the stream, the open ones included: the state keeps one row a window."""
    return _window_stream(spark, sf, "complete")


@register("batch_by_window_stream_append", sql=f"""{_WINDOW_SQL}
WHERE s + INTERVAL 1 DAY <= (SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL {WATERMARK_MINUTES} MINUTE""")
def batch_by_window_stream_append(spark, sf):
    """A window is emitted once, when the watermark passes its end, and its state is freed; the windows
    that the watermark has not passed stay open, and are those that this form does not return."""
    return _window_stream(spark, sf, "append")
