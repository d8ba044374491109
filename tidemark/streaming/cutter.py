"""Elapsed-time batch cutter as a Structured Streaming ``foreachBatch`` handler.

Rows stay distributed: each micro-batch runs the same cut search as the batch form from the carried
anchor (``elapsed_cuts``: one scalar aggregate per cut for a small limit such as the reference's
3; ``elapsed_cut_table``: pointer doubling when there is no limit or a large one, so a micro-batch
holding many intervals costs O(log) rounds, not a job per cut), labels its rows with global batch
ids, and writes them to ``rows/epoch=N``. The carried state (next batch id, anchor, closed count)
is written per epoch to ``state/epoch=N`` under the query's folder on shared storage; only the last
two epochs are kept, since a replay is of the last epoch or the next. A replayed epoch reads the
state before it and overwrites its own output, so reprocessing after a failure between the rows and
the state, or a restart, gives the same rows and never duplicates. Once the limit is reached nothing
is written any more and ``done`` tells the runner to stop. Micro-batches are assumed to arrive in
arrival order (one topic partition, or one staged slice per run). Records without a timestamp are in
no batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import epoch_micros
from tidemark.operators.batching import (SCAN_LIMIT, batch_of, elapsed_cut_table, elapsed_cuts,
                                         label_by_cut_table)


_STATE_SCHEMA = "batch_id bigint, anchor_us bigint, closed bigint, epoch bigint"


@dataclass
class CutState:
    batch_id: int = 1          # id of the open batch
    anchor_us: int | None = None
    closed: int = 0


class ElapsedCutter:
    def __init__(self, spark: SparkSession, base_dir: str, ts_col: str, id_col: str, interval,
                 limit: int | None = 3, out: str = "batch_id", schema: StructType | None = None):
        """``schema``: of the records; lets ``result`` answer when nothing has arrived."""
        self.spark = spark
        self.rows_dir = f"{base_dir}/rows"
        self.state_dir = f"{base_dir}/state"
        self.ts_col, self.id_col, self.interval, self.limit, self.out = ts_col, id_col, interval, limit, out
        self.schema = schema
        self._last: tuple[int, CutState] | None = None  # (epoch, state) written by this process

    # -- state --------------------------------------------------------------------------------
    def load_state(self, before_epoch: int | None = None) -> CutState:
        if before_epoch is not None and self._last is not None and self._last[0] == before_epoch - 1:
            return self._last[1]  # the previous epoch was handled here: no storage round trip
        try:
            st = self.spark.read.schema(_STATE_SCHEMA).json(self.state_dir)
        except AnalysisException:
            return CutState()
        if before_epoch is not None:
            st = st.where(F.col("epoch") < before_epoch)
        r = st.orderBy(F.desc("epoch")).limit(1).collect()
        if not r:
            return CutState()
        r = r[0]
        return CutState(int(r["batch_id"]), None if r["anchor_us"] is None else int(r["anchor_us"]), int(r["closed"]))

    @property
    def done(self) -> bool:
        """Whether the limit is reached: no later record will be read."""
        if self.limit is None:
            return False
        return (self._last[1] if self._last else self.load_state()).closed >= self.limit

    def _save_state(self, epoch: int, s: CutState) -> None:
        df = self.spark.createDataFrame([(s.batch_id, s.anchor_us, s.closed)],
                                        "batch_id bigint, anchor_us bigint, closed bigint")
        df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{self.state_dir}/epoch={epoch}")
        self._last = (epoch, s)
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        old = jvm.org.apache.hadoop.fs.Path(f"{self.state_dir}/epoch={epoch - 2}")
        old.getFileSystem(conf).delete(old, True)

    # -- handler ------------------------------------------------------------------------------
    def __call__(self, df: DataFrame, epoch: int) -> None:
        s = self.load_state(before_epoch=epoch)
        if self.limit is not None and s.closed >= self.limit:
            self._last = (epoch, s)  # the consumer has stopped: later records are never read
            return
        batch = df.persist()
        table = None
        try:
            anchor = s.anchor_us
            if anchor is None:
                first = batch.agg(F.min(epoch_micros(batch, self.ts_col))).first()[0]
                if first is None:
                    self._save_state(epoch, s)
                    return
                anchor = int(first)
            remaining = None if self.limit is None else self.limit - s.closed
            if remaining is None or remaining > SCAN_LIMIT:
                # many cuts can fall in one micro-batch: O(log) distributed rounds, no job per cut
                table = elapsed_cut_table(batch, self.ts_col, self.id_col, self.interval, remaining,
                                          anchor_us=anchor).persist()
                n_cuts = table.count()
                last = table.where(F.col("k") == n_cuts).select("cut_us").first() if n_cuts else None
                batch_no = label_by_cut_table(batch, self.ts_col, self.id_col, table, "_b")
                labelled = batch_no.withColumn(self.out, F.col("_b") + F.lit(s.batch_id - 1)).drop("_b")
                new_anchor = int(last[0]) if last else anchor
            else:
                cuts = elapsed_cuts(batch, self.ts_col, self.id_col, self.interval, remaining, anchor_us=anchor)
                us = epoch_micros(batch, self.ts_col)
                labelled = batch.withColumn(self.out, batch_of(us, F.col(self.id_col), cuts) + F.lit(s.batch_id - 1)) \
                    .where(F.col(self.out).isNotNull())
                n_cuts = len(cuts)
                new_anchor = cuts[-1][0] if cuts else anchor
            closed = s.closed + n_cuts
            if self.limit is not None and closed >= self.limit:
                labelled = labelled.where(F.col(self.out) <= self.limit)
            labelled.write.mode("overwrite").parquet(f"{self.rows_dir}/epoch={epoch}")
            self._save_state(epoch, CutState(s.batch_id + n_cuts, new_anchor, closed))
        finally:
            batch.unpersist()
            if table is not None:
                table.unpersist()

    # -- result -------------------------------------------------------------------------------
    def result(self, emit_open: bool = False) -> DataFrame:
        """Rows of closed batches (plus the open one when ``emit_open`` and the limit was not hit)."""
        try:
            rows = self.spark.read.parquet(self.rows_dir).drop("epoch")
        except AnalysisException:
            if self.schema is None:
                raise
            return self.spark.createDataFrame([], self.schema).withColumn(self.out, F.lit(None).cast("bigint"))
        s = self.load_state()
        if emit_open:
            return rows
        return rows.where(F.col(self.out) <= s.closed)
