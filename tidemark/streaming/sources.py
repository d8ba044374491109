"""Streaming sources and run helpers.

The reference consumes a Kafka topic from the earliest offset; here that is ``readStream`` with
``startingOffsets=earliest`` and offsets tracked in the query checkpoint instead of consumer-group
commits. The Kafka connector is not on this image's classpath, so tests drive the same code with
file sources (``text`` lines or ``parquet`` records), one file per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def stream_files(spark: SparkSession, path: str, fmt: str = "text", schema=None,
                 max_files_per_trigger: int | None = 1) -> DataFrame:
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as a line stream (``value`` decoded as UTF-8). Needs the Kafka connector."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().selectExpr("CAST(value AS STRING) AS value")


def run_available_now(df: DataFrame, checkpoint: str, handler: Callable[[DataFrame, int], None],
                      output_mode: str = "append", name: str | None = None,
                      until: Callable[[], bool] | None = None) -> None:
    """Process everything available now through ``foreachBatch(handler)`` and stop; earlier once
    ``until()`` is true. Restarting with the same checkpoint resumes after the last committed epoch."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(handler).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    if until is None:
        q.awaitTermination()
    else:
        while not q.awaitTermination(1):
            if until():
                q.stop()
                break
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
