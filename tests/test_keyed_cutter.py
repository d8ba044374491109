"""The cutter per stream key: equal to the batch form per key, over restarts and crashes, odd records."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import batching as bt
from tidemark.plans import fixtures as fx
from tidemark.plans.q_streams import ordered_slices
from tidemark.session import scratch_path
from tidemark.streaming.keyed_cutter import KeyedCutter, chain
from tidemark.streaming.sources import stream_files


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def stream(spark, inp, schema):
    return stream_files(spark, inp, "parquet", schema=schema, max_files_per_trigger=None)


def cutter(spark, base, limit, hours=24, kind=KeyedCutter):
    return kind(spark, base, "user_id", "ts", "event_id", f"{hours} hours", limit)


def labels(df):
    return sorted(tuple(r) for r in df.select("user_id", "event_id", "batch_id").collect())


def by_batch_form(ev, limit, emit_open, hours=24):
    out = []
    for u in [r[0] for r in ev.select("user_id").distinct().collect()]:
        rows = ev.where(F.col("user_id").eqNullSafe(F.lit(u)))
        out += labels(bt.batch_by_elapsed(rows, "ts", "event_id", f"{hours} hours", limit, emit_open, method="scan"))
    return sorted(out)


class Crash(KeyedCutter):
    def _write(self, batch, epoch):
        super()._write(batch, epoch)
        raise RuntimeError("power cut")


def test_each_key_is_cut_as_on_its_own_over_a_crash_and_a_restart(spark):
    ev = fx.events(spark, SF_SMALL).select("event_id", "ts", "user_id").where("user_id <= 4")
    inp, base = scratch_path(spark, "k-in"), scratch_path(spark, "k-cut")
    for i in ordered_slices(ev, ["ts", "event_id"], inp, 2):
        if i == 2:  # rows are written, the epoch is not committed
            with pytest.raises(Exception, match="power cut"):
                cutter(spark, base, 5, kind=Crash).run(stream(spark, inp, ev.schema))
        c = cutter(spark, base, 5)
        c.run(stream(spark, inp, ev.schema))
    got = c.result(ev.schema)
    assert labels(got) == by_batch_form(ev, 5, False)
    assert got.where("closes").count() == got.select("user_id", "batch_id").distinct().count()


def test_open_batches_null_keys_null_ids_and_records_without_time(spark):
    rows = [(None, "2024-01-01 00:00:00", 1), (5, "2024-01-02 00:00:00", 1), (None, "2024-01-02 00:00:00", 1), (6, None, 1),
            (7, "2024-01-02 12:00:00", 1), (1 << 60, "2024-01-01 00:00:00", None), ((1 << 60) + 1, "2024-01-09 00:00:00", None),
            (3, None, 9)]
    ev = spark.createDataFrame(rows, "event_id long, ts string, user_id long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    inp, base = scratch_path(spark, "k-in"), scratch_path(spark, "k-cut")
    ev.write.parquet(inp)
    c = cutter(spark, base, None)
    c.run(stream(spark, inp, ev.schema))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    every = sorted((tuple(r) for r in c.result(ev.schema, emit_open=True).select("user_id", "event_id", "batch_id").collect()), key=key)
    # the null id comes first of its time and closes the batch; the large ids keep their last digit
    assert every == [(None, 1 << 60, 1), (None, (1 << 60) + 1, 1), (1, None, 1), (1, None, 1), (1, 5, 2), (1, 7, 2)]
    closed = c.result(ev.schema).select("user_id", "batch_id").distinct().collect()
    assert {tuple(r) for r in closed} == {(1, 1), (None, 1)}


def test_a_stream_of_no_records(spark):
    ev = fx.events(spark, SF_SMALL).select("event_id", "ts", "user_id")
    inp, base = scratch_path(spark, "k-in"), scratch_path(spark, "k-cut")
    ev.where("event_id < 0").write.parquet(inp)
    c = cutter(spark, base, 3)
    c.run(stream(spark, inp, ev.schema))
    assert c.result(ev.schema).count() == 0 and c.result(ev.schema).columns == ["user_id", "event_id", "ts_us", "batch_id", "closes"]


@pytest.mark.parametrize("most", [None, 2])
def test_chain_of_cuts(most):
    us = np.sort(np.random.default_rng(1).integers(0, 1000, 200))
    cuts, anchor = [], int(us[0])
    for i, t in enumerate(us.tolist()):
        if t >= anchor + 90 and (most is None or len(cuts) < most):
            cuts.append(i)
            anchor = t
    assert chain(us, 90, int(us[0]), most) == cuts
