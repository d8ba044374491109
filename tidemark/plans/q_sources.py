"""Catalogue: sources that keep order, quotes and offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.ordinal import with_ntile
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.sources import linelog, lines, records
from tidemark.streaming.sources import run_available_now

# Partitions and appended slices of the log, lines of a batch.
LOG_PARTITIONS, LOG_SLICES, LINES_PER_BATCH = 4, 3, 2500
EV_COLS = ["event_id", "user_id", "event_type", "value"]


@register("stream_log_offsets", sql=f"""WITH l AS (SELECT user_id % {LOG_PARTITIONS} AS p, event_id, event_type,
  row_number() OVER (PARTITION BY user_id % {LOG_PARTITIONS} ORDER BY event_id) - 1 AS o FROM events)
SELECT CAST(p AS INTEGER) AS partition, count(*) AS n, min(o) AS first_offset, max(o) AS last_offset, count(DISTINCT o) AS offsets,
  CAST(sum(o * (event_id % 1009)) AS BIGINT) AS order_sum, count(*) FILTER (event_type = 'click') AS clicks FROM l GROUP BY p""")
def stream_log_offsets(spark, sf):
    """Events appended as lines to a log of several partitions, slice by slice, and read after each slice by
    a stream on one checkpoint: two restarts. Each record comes once, at the offset of its place."""
    ev = fx.table(spark, sf, "events").select(*EV_COLS)
    path, out, ckpt = (scratch_path(spark, x) for x in ("line-log", "log-out", "ckpt-log"))
    tiled = with_ntile(ev, ["event_id"], LOG_SLICES, out="slice")

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    for i in range(1, LOG_SLICES + 1):
        part = lines.to_lines(tiled.where(F.col("slice") == i).withColumn("partition", (F.col("user_id") % LOG_PARTITIONS).cast("int")),
                              EV_COLS, keep=["partition", "event_id"])
        # a partition's records of one append in one task, in order
        linelog.append_lines(part.repartition(LOG_PARTITIONS, "partition").sortWithinPartitions("partition", "event_id"), path)
        run_available_now(linelog.stream_log(spark, path, group="catalogue"), ckpt, sink)
    got = lines.split_naive(spark.read.parquet(out), EV_COLS, keep=["partition", "offset"])
    return got.groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.countDistinct("offset").alias("offsets"), F.sum(F.col("offset") * (F.col("event_id").cast("long") % 1009)).alias("order_sum"),
        F.count(F.when(F.col("event_type") == "click", 1)).alias("clicks"))


@register("line_source_ordered", sql=f"""SELECT event_id, line_no, line_no // {LINES_PER_BATCH} + 1 AS batch_id
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS line_no FROM events)""")
def line_source_ordered(spark, sf):
    """Lines numbered in file order from byte offsets, and cut into batches by that number."""
    ev = fx.table(spark, sf, "events").select(*EV_COLS)
    path = scratch_path(spark, "ordered-lines")
    ranged = ev.repartitionByRange("event_id").sortWithinPartitions("event_id")
    lines.write_lines(lines.to_lines(ranged, EV_COLS), path)
    got = records.ordered_records(spark, path)
    ids = lines.split_naive(got, EV_COLS, keep=["line_no"])
    return ids.select(F.col("event_id").cast("long").alias("event_id"), "line_no",
                      (F.floor(F.col("line_no") / LINES_PER_BATCH) + 1).cast("long").alias("batch_id"))


@register("line_source_quoted_newlines", sql="""WITH d AS (SELECT doc_id, concat('a "b", ', chr(10), text, ',""', chr(10)) AS body FROM documents)
SELECT doc_id, length(body) AS n_chars, md5(body) AS body_md5 FROM d""")
def line_source_quoted_newlines(spark, sf):
    """Records with commas, doubled quotes and newlines inside quotes, cut by quote parity over blocks."""
    docs = fx.table(spark, sf, "documents")
    body = F.concat(F.lit('a "b", \n'), F.coalesce("text", F.lit("")), F.lit(',""\n'))
    quoted = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), F.replace(body, F.lit('"'), F.lit('""')), F.lit('"'))
    path = scratch_path(spark, "quoted-lines")
    lines.write_lines(docs.select(quoted.alias("value")), path)
    got = records.split_quoted(records.ordered_records(spark, path, quote='"'), ["doc_id", "body"])
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), F.length("body").cast("long").alias("n_chars"),
                      F.md5(F.col("body").cast("binary")).alias("body_md5"))
