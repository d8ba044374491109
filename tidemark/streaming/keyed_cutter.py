"""Elapsed-time batches of many independent streams: one cutter per stream key.

``ElapsedCutter`` cuts one stream, and each of its micro-batches runs jobs for the cuts. Here every key
has a cutter of its own, whose state (open batch, its anchor, batches closed) lives in Spark's
state store: records are shuffled by key once per micro-batch, and each key goes on from its state.
The rule is that of ``batch_by_elapsed``, per key: a batch closes on the first record at least
``interval`` after its anchor, which is the key's first record and then each closing one.

A micro-batch is taken to come after the ones before it; within it, records are ordered by (time,
id), a null id first. A record older than the open batch's anchor joins the open batch. Records
without a time are in no batch. A null key is a key like any other. What a key has in one micro-batch
is held as its times and ids while it is cut (a chain is sequential), so the source's limit per
trigger bounds memory, also where one key holds a third of the stream.

Result rows are labels (key, id, time in microseconds, batch, whether the record closes it); the
payload stays where it is and is joined by id. Keys and ids are texts or numbers. An epoch overwrites its own folder, so a replay after a
crash gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tidemark.functions.columns import col_, epoch_micros
from tidemark.operators.batching import interval_micros
from tidemark.streaming.sources import run_available_now

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the state store, which holds the states of many keys outside the heap
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT_ROWS = 1 << 16  # rows of one pandas frame that a task gives back


def chain(us: np.ndarray, step: int, anchor: int, most: int | None) -> list[int]:
    """Positions, in the ascending times ``us``, of the records that close a batch."""
    cuts: list[int] = []
    while most is None or len(cuts) < most:
        at = int(np.searchsorted(us, anchor + step))
        if at == len(us):
            break
        cuts.append(at)
        anchor = int(us[at])
    return cuts


def _cutter(step: int, limit: int | None):
    """The function of one key and micro-batch. There may be many keys of few records, so a call is a few
    numpy steps and one frame."""

    def cut(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        anchor, closed = state.getOption or (None, 0)
        if limit is not None and closed >= limit:
            for _ in frames:  # a key that has closed all its batches reads nothing more
                pass
            return
        us, has, ids = (np.concatenate(x) for x in zip(*((f["us"].to_numpy(np.int64), f["has_id"].to_numpy(bool), f["id"].to_numpy()) for f in frames), strict=True))
        order = np.arange(len(us))
        for by in (ids, has, us):  # the last one counts first
            order = order[np.argsort(by[order], kind="stable")]
        us, has, ids = us[order], has[order], ids[order]
        if anchor is None:
            anchor = int(us[0])
        cuts = chain(us, step, anchor, None if limit is None else limit - closed)
        if cuts:
            anchor = int(us[cuts[-1]])
        state.update((anchor, closed + len(cuts)))
        end = cuts[-1] + 1 if limit is not None and closed + len(cuts) >= limit else len(us)
        closes = np.zeros(len(us), bool)
        closes[cuts] = True
        batch = closed + 1 + np.cumsum(closes) - closes  # a closing record is in the batch that it closes
        for at in range(0, end, OUT_ROWS):
            to = min(end, at + OUT_ROWS)
            same = np.empty(to - at, object)
            same[:] = key[1]
            yield pd.DataFrame({"has_key": np.full(to - at, key[0], bool), "key": same, "has_id": has[at:to], "id": ids[at:to],
                                "us": us[at:to], "batch": batch[at:to], "closes": closes[at:to]}, copy=False)

    return cut


def _flagged(col: str, name: str, kind: str) -> list:
    return [col_(col).isNotNull().alias(f"has_{name}"), F.coalesce(col_(col), F.lit("" if kind == "string" else 0).cast(kind)).alias(name)]


class KeyedCutter:
    """Cuts the stream of each value of ``key_col``. ``run`` may be called again on the same folder,
    by another process too: it goes on after the last committed epoch."""

    def __init__(self, spark: SparkSession, base_dir: str, key_col: str, ts_col: str, id_col: str, interval,
                 limit: int | None = 3, out: str = "batch_id"):
        self.spark, self.base = spark, base_dir
        self.key_col, self.ts_col, self.id_col, self.out = key_col, ts_col, id_col, out
        self.step, self.limit = interval_micros(interval), limit

    def labels(self, stream: DataFrame) -> DataFrame:
        """The stream of labels, from a stream of records."""
        key, id_ = (stream.schema[c].dataType.simpleString() for c in (self.key_col, self.id_col))
        # pandas has no null in a column of integers, and would take each null key for another one: nulls
        # are flagged, and a null id sorts first by its flag
        rows = stream.select(epoch_micros(stream, self.ts_col).alias("us"), *_flagged(self.key_col, "key", key),
                             *_flagged(self.id_col, "id", id_))
        # states come and go with the records, many keys at a time; a stateful processor asks for each one
        return rows.where("us IS NOT NULL").groupBy("has_key", "key").applyInPandasWithState(
            _cutter(self.step, self.limit), f"has_key boolean, key {key}, has_id boolean, id {id_}, us long, batch long, closes boolean",
            "anchor long, closed long", "append", GroupStateTimeout.NoTimeout)

    def _write(self, batch: DataFrame, epoch: int) -> None:
        rows = batch.select(F.expr("IF(has_key, key, NULL)").alias(self.key_col), F.expr("IF(has_id, id, NULL)").alias(self.id_col),
                            F.col("us").alias("ts_us"), F.col("batch").alias(self.out), "closes")
        rows.write.mode("overwrite").parquet(f"{self.base}/rows/epoch={epoch}")

    def run(self, stream: DataFrame) -> None:
        """Process what the stream holds now. The number of shuffle partitions at the first run stays
        that of the state."""
        before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, _ROCKS)
        try:
            run_available_now(self.labels(stream), f"{self.base}/checkpoint", self._write)
        finally:
            self.spark.conf.set(_PROVIDER, before) if before else self.spark.conf.unset(_PROVIDER)

    def result(self, schema: StructType, emit_open: bool = False) -> DataFrame:
        """Labels of the closed batches, with ``emit_open`` of the open ones too. ``schema``: that of
        the records, which types the result when nothing has arrived."""
        key, id_ = (schema[c].dataType.simpleString() for c in (self.key_col, self.id_col))
        # the schema is given, so a folder of no rows reads as an empty table
        rows = self.spark.read.schema(f"`{self.key_col}` {key}, `{self.id_col}` {id_}, ts_us long, `{self.out}` long, closes boolean") \
            .option("recursiveFileLookup", "true").parquet(f"{self.base}/rows")
        if emit_open:
            return rows
        done = rows.where("closes").select(col_(self.key_col).alias("_key"), col_(self.out).alias("_batch"))
        return rows.join(done, col_(self.key_col).eqNullSafe(F.col("_key")) & (col_(self.out) == F.col("_batch")), "left_semi")
