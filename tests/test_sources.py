"""Line order, quoted newlines and the line log."""

from __future__ import annotations

import csv
import io

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.sources import linelog, records
from tidemark.session import scratch_path
from tidemark.streaming.sources import run_available_now


def plain_records(data: bytes, quote: int | None) -> list[bytes]:
    out, held, odd = [], bytearray(), False
    for c in data:
        odd ^= c == quote
        if c == 10 and not odd:
            out.append(bytes(held))
            held.clear()
        else:
            held.append(c)
    return [*out, bytes(held)] if held or odd else out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b",", b"\n", b'"', b'""', "é".encode(), b"xyz"]), max_size=40), st.integers(1, 20), st.booleans())
def test_blocks_cut_the_records_of_the_whole(parts, size, quoted):
    data, quote = b"".join(parts), 34 if quoted else None
    got: list[bytes] = []
    odd = ended = 0
    for start in range(0, len(data), size):
        stop = min(start + size, len(data))
        first, at = max(0, start - 1), stop

        def read_on(n, _data=data):
            nonlocal at
            at += 2  # in small steps
            return _data[at - 2: at]

        some, skipped = records.cut_records(data[first:stop], read_on, start, quote, odd)
        assert not some or len(got) == ended + skipped
        got += some
        block = np.frombuffer(data[start:stop], np.uint8)
        ended += len(records._ends(block, quote, odd))
        odd = (odd + (int((block == 34).sum()) if quoted else 0)) % 2
    assert got == plain_records(data, quote)


@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_records_of_several_files_are_numbered_in_order(spark, tmp_path, block):
    files = ['1,"a\n""b"",\n"\n2,plain\n', "", '3,"\n\n"\n\n4,no newline at the end', '5,"open\nto the end\n']
    for i, t in enumerate(files):
        (tmp_path / f"part-{i:05d}").write_text(t)
    got = sorted(tuple(r) for r in records.ordered_records(spark, str(tmp_path), '"', block).collect())
    assert got == list(enumerate(['1,"a\n""b"",\n"', "2,plain", '3,"\n\n"', "", "4,no newline at the end", '5,"open\nto the end\n']))
    if block == 64:
        got = sorted(tuple(r) for r in records.ordered_records(spark, str(tmp_path), None, block).collect())
        assert got == list(enumerate(x for t in files for x in t.removesuffix("\n").split("\n") if t))
        fields = records.split_quoted(records.ordered_records(spark, str(tmp_path), '"'), ["a", "b", "c"], keep=["line_no"])
        want = {n: (next(csv.reader(io.StringIO(v, newline="")), []) + [None] * 3)[:3] for n, v in enumerate(
            ['1,"a\n""b"",\n"', "2,plain", '3,"\n\n"', "", "4,no newline at the end", '5,"open\nto the end\n'])}
        assert {r.line_no: [r.a, r.b, r.c] for r in fields.collect()} == want


def test_no_files_give_no_records(spark, tmp_path):
    (tmp_path / "part-0").write_text("")
    assert records.ordered_records(spark, str(tmp_path)).collect() == []
    with pytest.raises(ValueError, match="one ASCII"):
        records.ordered_records(spark, str(tmp_path), "''")


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet='ab\\nrN\n\r"é', max_size=12)))
def test_log_values_come_back(value):
    assert linelog.unescaped(linelog.escaped(value)) == value and "\n" not in linelog.escaped(value)


def test_log_appends_once_resumes_and_leaves_failures_out(spark):
    path, ckpt, out = (scratch_path(spark, x) for x in ("t-log", "t-log-ckpt", "t-log-out"))
    rows = [(i % 3, f"v{i}") for i in range(30)] + [(1, None), (1, ""), (2, "two\nlines")]
    df = spark.createDataFrame(rows, "partition int, value string").coalesce(2)

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    def read():
        run_available_now(linelog.stream_log(spark, path, group="g"), ckpt, sink)
        return spark.read.parquet(out)

    linelog.append_lines(df, path)
    assert read().count() == 33
    bad = df.withColumn("value", F.when(F.col("value") == "v7", F.raise_error(F.lit("power cut"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="power cut"):
        linelog.append_lines(bad, path)
    linelog.append_lines(df.where("partition = 1"), path)
    got = read()
    want = {0: 10, 1: 24, 2: 11}
    assert {r.partition: (r.n, r.lo, r.hi, r.d) for r in got.groupBy("partition").agg(
        F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.countDistinct("offset").alias("d")).collect()} == \
        {p: (n, 0, n - 1, n) for p, n in want.items()}
    assert sorted((r.partition, r.value or "") for r in got.collect()) == sorted([(p, v or "") for p, v in rows] + [(p, v or "") for p, v in rows if p == 1])
    assert linelog.ends(linelog.manifest(path)) == {str(p): n for p, n in want.items()}
    assert linelog.committed(path, "g") == {"0": 10, "1": 12, "2": 11} and linelog.committed(path, "nobody") == {}
    # from the latest offsets there is nothing to read
    run_available_now(linelog.stream_log(spark, path, "latest"), scratch_path(spark, "t-log-ckpt2"), lambda b, e: b.write.parquet(f"{out}-late/{e}"))
    # a replayed micro-batch is appended once
    before = linelog.manifest(path)
    segment = linelog.Written([linelog.Segment(0, "seg", 5)])
    linelog.append(path, [segment], "w", 0)
    linelog.append(path, [segment], "w", 0)
    linelog.append(path, [segment], "other", 0)
    assert len(linelog.manifest(path)) == len(before) + 2


def test_stream_into_the_log(spark):
    """Log to log through writeStream, over a restart."""
    source, target, ckpt = (scratch_path(spark, x) for x in ("t-log-a", "t-log-b", "t-log-ckpt3"))
    df = spark.range(40).select((F.col("id") % 2).cast("int").alias("partition"), F.concat(F.lit("r"), "id").alias("value"))
    for _ in range(2):
        linelog.append_lines(df, source)
        copy = linelog.stream_log(spark, source).select("partition", "value")
        q = copy.writeStream.format("linelog").option("writer", "copy").option("checkpointLocation", ckpt).trigger(availableNow=True).start(target)
        q.awaitTermination()
    assert linelog.read_log(spark, target).groupBy("partition").count().orderBy("partition").collect() == [(0, 40), (1, 40)]
