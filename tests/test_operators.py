"""Invariants, properties and edge cases of the operators (survey §5 items 2-5)."""

from __future__ import annotations

import bisect
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.functions.columns import epoch_micros
from tidemark.operators import batching as bt
from tidemark.operators import chains
from tidemark.operators import models as mdl
from tidemark.operators import requests as rq
from tidemark.operators import rows
from tidemark.operators import similarity as sim
from tidemark.operators.labels import LabelMaps, rank_labels
from tidemark.operators.ordinal import sorted_positions, with_group_rank, with_ntile, with_ordinal
from tidemark.operators.regression import fit_ols
from tidemark.plans import fixtures as fx
from tidemark.session import scratch_path
from tidemark.sources import lines

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


# ---- label maps -----------------------------------------------------------------------------

@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(list("abcdef"))), min_size=1, max_size=60))
def test_label_map_is_frequency_ordered_bijection(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, c string")
    maps = LabelMaps.fit(df, ["c"])
    t = maps.table.orderBy("index").collect()
    labels = [r["label"] for r in t]
    counts = pd.Series([v for v in values if v is not None]).value_counts()
    assert [r["index"] for r in t] == list(range(len(t)))
    assert set(labels) == set(counts.index)
    expected = sorted(counts.index, key=lambda x: (-counts[x], x))
    assert labels == expected
    out = maps.transform(df).orderBy("id").collect()
    for r in out:
        want = float(expected.index(r["c"])) if r["c"] is not None else float(len(expected))
        assert r["c_index"] == want


def test_label_maps_equal_mllib_string_indexer(spark):
    t = fx.tx(spark, SF_SMALL)
    cats = fx.TX_CATS
    mine = LabelMaps.fit(t, cats).transform(t).select("id", *[F.col(f"{c}_index").alias(f"m_{c}") for c in cats])
    from pyspark.ml.feature import StringIndexer

    ml = StringIndexer(inputCols=cats, outputCols=[f"{c}_index" for c in cats], handleInvalid="keep").fit(t).transform(t).select("id", *[f"{c}_index" for c in cats])
    j = mine.join(ml, "id")
    assert j.count() == t.count()
    for c in cats:
        assert j.where(F.col(f"m_{c}") != F.col(f"{c}_index")).count() == 0


def test_inline_maps_equal_join_maps(spark, monkeypatch):
    from tidemark.operators import labels as lb

    src = fx.parts(spark, SF_SMALL).withColumn("ptype", F.expr("nullif(ptype, 'ECONOMY')"))
    fit_on = src.where(F.col("brand") != "Brand#1")
    cols = ["brand", "ptype"]
    inl = lb.LabelMaps.fit(fit_on, cols)
    assert set(inl.inline) == set(cols)
    monkeypatch.setattr(lb, "INLINE_LABELS", 0)
    joined = lb.LabelMaps.fit(fit_on, cols)
    assert joined.inline == {}
    a = inl.transform(src).select("id", "brand_index", "ptype_index").orderBy("id").collect()
    b = joined.transform(src).select("id", "brand_index", "ptype_index").orderBy("id").collect()
    assert a == b and any(r["brand_index"] == inl.sizes["brand"] for r in a)


def test_cumulative_ols_inline_maps_equal_join_maps(spark, monkeypatch):
    from tidemark.operators import regression as rg

    t = fx.tx(spark, SF_SMALL)
    cats = ["property_type", "duration"]
    a = rg.cumulative_categorical_ols(t, cats, "price", "id").orderBy("model_id").collect()
    monkeypatch.setattr(rg, "INLINE_LABELS", 0)
    b = rg.cumulative_categorical_ols(t, cats, "price", "id").orderBy("model_id").collect()
    assert len(a) == 3 and [r["n"] for r in a] == [r["n"] for r in b]
    for ra, rb in zip(a, b):
        for f in ("b0", "b1", "b2"):
            assert ra[f] == pytest.approx(rb[f], rel=1e-9, abs=1e-6)


# ---- ordinals ---------------------------------------------------------------------------------

@SETTINGS
@given(st.integers(min_value=1, max_value=400), st.integers(min_value=1, max_value=7))
def test_ordinal_and_ntile_match_single_task_window(spark, n, tiles):
    ids = np.random.RandomState(n).permutation(n * 3)[:n]
    df = spark.createDataFrame([(int(i),) for i in ids], "k bigint")
    got = with_ntile(with_ordinal(df, ["k"], out="o"), ["k"], tiles, out="tile").orderBy("k").collect()
    ks = sorted(int(i) for i in ids)
    assert [r["o"] for r in got] == list(range(n))
    q, rem = divmod(n, tiles)
    want = []
    for t in range(tiles):
        want += [t + 1] * (q + (1 if t < rem else 0))
    assert [r["tile"] for r in got] == want
    assert [r["k"] for r in got] == ks


def test_ordinal_with_hot_leading_value_uses_sort_path(spark):
    # a third of the rows share one leading value: the quantile buckets would put it in one task,
    # so the ordinal comes from the range-partitioned sort; it must still equal row_number
    rs = np.random.RandomState(7)
    lead = np.where(rs.rand(900) < 0.34, 5, rs.randint(0, 50, 900))
    rows_ = [(int(a), int(b)) for a, b in zip(lead, rs.permutation(900))]
    df = spark.createDataFrame(rows_, "a bigint, b bigint")
    got = with_ordinal(df, ["a", "b"], out="o", num_partitions=8).orderBy("o").collect()
    want = sorted(rows_)
    assert [(r["a"], r["b"]) for r in got] == want
    assert [r["o"] for r in got] == list(range(len(want)))


def test_ordinal_keeps_null_and_text_keys(spark):
    rows_ = [(None if i % 10 == 0 else f"k{i % 13}", i) for i in range(1000)]
    df = spark.createDataFrame(rows_, "k string, i int")
    for parts in (4, 16):
        got = {r["i"]: r["o"] for r in with_ordinal(df, ["k", "i"], out="o", num_partitions=parts).collect()}
        want = sorted(rows_, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        assert [i for _, i in want] == sorted(got, key=got.get) and sorted(got.values()) == list(range(1000))


def test_ordinal_of_zone_free_times_ignores_the_session_zone(spark):
    start = dt.datetime(2024, 3, 10, 0, 0)
    times = [(start + dt.timedelta(minutes=7 * i), i) for i in range(120)]  # over the spring clock change
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(str(t), i) for t, i in times], "t string, i int").select(F.col("t").cast("timestamp_ntz").alias("t"), "i")
        got = {r["i"]: r["o"] for r in with_ordinal(df, ["t"], out="o", num_partitions=4).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {i: i for i in range(120)}


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=4), min_size=1, max_size=300), st.integers(min_value=2, max_value=9))
def test_ordinal_equals_row_number_for_any_skew(spark, leads, parts):
    # leading keys from a tiny domain: most draws have a value holding a large share of the rows
    rows_ = [(int(a), i) for i, a in enumerate(leads)]
    df = spark.createDataFrame(rows_, "a bigint, b bigint")
    got = with_ordinal(df, ["a", "b"], out="o", num_partitions=parts).collect()
    pos = {(r["a"], r["b"]): r["o"] for r in got}
    assert len(got) == len(rows_)
    assert [pos[k] for k in sorted(rows_)] == list(range(len(rows_)))


def test_sorted_positions_and_group_rank_match_windows(spark):
    rs = np.random.RandomState(3)
    rows_ = [(int(g), f"l{int(x):05d}") for g, x in zip(rs.choice([0, 0, 0, 1, 2], 500), rs.permutation(500))]
    df = spark.createDataFrame(rows_, "g int, label string")
    pos = sorted_positions(df, [F.desc("g"), F.asc("label")], 8, out="p").orderBy("p").collect()
    assert [(r["g"], r["label"]) for r in pos] == sorted(rows_, key=lambda t: (-t[0], t[1]))
    ranked = with_group_rank(df, ["g"], [F.asc("label")], out="r", num_partitions=8).collect()
    for g in (0, 1, 2):
        labels = sorted(lbl for gg, lbl in rows_ if gg == g)
        got = sorted((r["r"], r["label"]) for r in ranked if r["g"] == g)
        assert got == list(enumerate(labels))


def test_rank_labels_sort_path_equals_window_path(spark):
    # a long tail of labels with count 1 (the hot (column, count) group of a large map)
    vals = [(c, f"v{i % 37}") for i in range(400) for c in ("a",)] + [("b", f"w{i}") for i in range(300)]
    vals += [("b", "w1")] * 5 + [("b", "w2")] * 5
    df = spark.createDataFrame(vals, "column string, label string")
    counts = df.groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))
    win = {(r["column"], r["label"]): r["index"] for r in rank_labels(counts).collect()}
    srt = {(r["column"], r["label"]): r["index"] for r in rank_labels(counts, max_window_labels=10).collect()}
    assert win == srt
    for c in ("a", "b"):
        mine = sorted((i, lbl) for (cc, lbl), i in win.items() if cc == c)
        pdf = pd.Series([lbl for cc, lbl in vals if cc == c]).value_counts()
        want = sorted(pdf.index, key=lambda x: (-pdf[x], x))
        assert [lbl for _, lbl in mine] == want and [i for i, _ in mine] == list(range(len(want)))


# ---- elapsed-time batches ---------------------------------------------------------------------

def expected_batches(records, interval_us, limit, emit_open):
    """Batch per id of sorted (us, id) records: every cut by one sorted search, labels by another."""
    times, cuts = [us for us, _ in records], []
    at = bisect.bisect_left(times, times[0] + interval_us)
    while at < len(times) and len(cuts) != limit:
        cuts.append(at)
        at = bisect.bisect_left(times, times[at] + interval_us)
    last = len(cuts) + (emit_open and len(cuts) != limit)
    label = {rid: bisect.bisect_left(cuts, i) + 1 for i, (_, rid) in enumerate(records)}
    return {rid: k for rid, k in label.items() if k <= last}


@pytest.mark.parametrize("days,limit,emit_open", [(2, 3, False), (2, 3, True), (7, 3, True), (3, None, False), (40, 2, True)])
def test_elapsed_batches_equal_expected_batches(spark, days, limit, emit_open):
    ev = fx.events(spark, SF_SMALL)
    got = {r["event_id"]: r["batch_id"] for r in
           bt.batch_by_elapsed(ev, "ts", "event_id", f"{days} days", limit, emit_open).collect()}
    recs = sorted((int(r["us"]), int(r["event_id"])) for r in
                  ev.select(epoch_micros(ev, "ts").alias("us"), "event_id").collect())
    assert got == expected_batches(recs, days * 86_400_000_000, limit, emit_open)


def _stream_cutter(spark, slices, days, limit, cutter_type=None, crash_at=None):
    """Feed ordered slices, one run of the stream each; returns the last cutter and its parts."""
    from tidemark.plans.q_streams import ordered_slices
    from tidemark.streaming.cutter import ElapsedCutter
    from tidemark.streaming.sources import run_available_now, stream_files

    ev = fx.events(spark, SF_SMALL).select("event_id", "ts", "user_id", "event_type", "value")
    inp, base, ckpt = (scratch_path(spark, x) for x in ("t-in", "t-cut", "t-ckpt"))
    cutter = None
    for i in ordered_slices(ev, ["event_id"], inp, slices):
        def run(kind):
            c = kind(spark, base, "ts", "event_id", f"{days} days", limit, schema=ev.schema)
            run_available_now(stream_files(spark, inp, "parquet", schema=ev.schema, max_files_per_trigger=None), ckpt, c)
            return c
        if i == crash_at:
            with pytest.raises(Exception, match="power cut"):
                run(cutter_type)
        cutter = run(ElapsedCutter)
    return cutter, inp, ckpt, base, ev


@pytest.mark.parametrize("slices", [1, 3, 6])
def test_stream_cutter_equals_batch_for_any_micro_batch_split(spark, slices):
    cutter, *_ , ev = _stream_cutter(spark, slices, 2, 3)
    got = {r["event_id"]: r["batch_id"] for r in cutter.result().collect()}
    want = {r["event_id"]: r["batch_id"] for r in bt.batch_by_elapsed(ev, "ts", "event_id", "2 days", 3).collect()}
    assert got == want


@pytest.mark.parametrize("slices", [1, 4])
def test_stream_cutter_without_limit_uses_doubling_and_equals_batch(spark, slices):
    # 6-hour batches: about 4 cuts per day, many per micro-batch; no limit, open batch kept
    cutter, *_, ev = _stream_cutter(spark, slices, 0.25, None)
    got = {r["event_id"]: r["batch_id"] for r in cutter.result(emit_open=True).collect()}
    recs = sorted((int(r["us"]), int(r["event_id"])) for r in
                  ev.select(epoch_micros(ev, "ts").alias("us"), "event_id").collect())
    assert got == expected_batches(recs, 6 * 3_600_000_000, None, True)


@pytest.mark.parametrize("crash_at", [1, 2, 4])
def test_stream_cutter_resumes_after_a_crash_between_rows_and_state(spark, crash_at):
    from tidemark.streaming.cutter import ElapsedCutter

    class Crash(ElapsedCutter):
        def _save_state(self, epoch, s):
            raise RuntimeError("power cut")

    cutter, *_, ev = _stream_cutter(spark, 4, 2, None, Crash, crash_at)
    got = [(r["event_id"], r["batch_id"]) for r in cutter.result().collect()]
    want = bt.batch_by_elapsed(ev, "ts", "event_id", "2 days", None).collect()
    assert sorted(got) == sorted((r["event_id"], r["batch_id"]) for r in want)


def test_stream_cutter_stops_at_the_limit_and_keeps_little_state(spark):
    cutter, _, _, base, _ = _stream_cutter(spark, 6, 2, 3)
    assert cutter.done
    cutter, _, _, base, _ = _stream_cutter(spark, 6, 2, None)
    assert not cutter.done
    assert spark.read.json(f"{base}/state").select("epoch").distinct().count() == 2


def test_stream_cutter_result_when_nothing_arrived(spark):
    from tidemark.streaming.cutter import ElapsedCutter

    ev = fx.events(spark, SF_SMALL)
    empty = ElapsedCutter(spark, scratch_path(spark, "none"), "ts", "event_id", "1 days", 3, schema=ev.schema).result()
    assert empty.columns == [*ev.columns, "batch_id"] and empty.count() == 0


@pytest.mark.parametrize("limit,emit_open", [(3, False), (3, True), (None, True)])
def test_elapsed_records_without_time_are_in_no_batch_by_any_method(spark, limit, emit_open, monkeypatch):
    ev = fx.events(spark, SF_SMALL).select("event_id", F.when(F.col("event_id") % 7 > 0, F.col("ts")).alias("ts"))
    want = None
    for method in ("scan", "many", "doubling"):
        if method == "doubling":
            monkeypatch.setattr(chains, "DENSE", 0)
        got = {r["event_id"]: r["batch_id"] for r in bt.batch_by_elapsed(
            ev, "ts", "event_id", "3 days", limit, emit_open, method="scan" if method == "scan" else "many").collect()}
        assert all(i % 7 for i in got) and None not in got.values()
        want = want or got
        assert got == want


def test_elapsed_with_text_ids_and_an_anchor(spark):
    ev = fx.events(spark, SF_SMALL).select(F.format_string("e%08d", "event_id").alias("event_id"), "ts")
    base = dt.datetime(1970, 1, 1)
    first = ev.agg(F.min("ts")).first()[0]
    anchor = int((first - base) / dt.timedelta(microseconds=1)) - 86_400_000_000
    got = [{r["event_id"]: r["batch_id"] for r in bt.batch_by_elapsed(
        ev, "ts", "event_id", "2 days", None, True, anchor_us=anchor, method=m).collect()} for m in ("scan", "many")]
    assert got[0] == got[1] and len(got[0]) == ev.count()
    late = min(r["ts"] for r in ev.collect() if got[0][r["event_id"]] == 2)
    assert late >= first + dt.timedelta(days=1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4000), min_size=1, max_size=250, unique=True), st.integers(1, 900), st.integers(1, 60))
def test_composed_tables_are_the_chain(times, step, size):
    """Any split into ranges, pairs composed up to one table: exit and number of cuts from every entry."""
    us = np.sort(np.array(times, np.int64))
    parts = [us[i: i + size] for i in range(0, len(us), size)]
    level = [(int(p[0]), chains.range_table(p, step)) for p in parts]
    while len(level) > 1:
        level = [(g[0][0], chains.composed([t for _, t in g], g[0][0], step)) for g in (level[i: i + 3] for i in range(0, len(level), 3))]
    for w in range(int(us[0]) - 3, int(us[0]) + step):
        at, made, want = int(np.searchsorted(us, w)), 0, w
        while at < len(us):
            made, want = made + 1, int(us[at]) + step
            at = int(np.searchsorted(us, want))
        assert [int(x[0]) for x in chains.applied(level[0][1], np.array([w]), np.zeros(1, np.int64))] == [want, made]


@pytest.mark.parametrize("hours,size,fan", [(6, 60, 2), (1, 25, 3), (200, 40, 4), (24 * 365, 100, 2)])
def test_cuts_of_many_ranges_equal_sorted_searches(spark, hours, size, fan):
    ev = fx.events(spark, SF_SMALL).select("event_id", "ts")
    recs = sorted((int(r["us"]), int(r["event_id"])) for r in ev.select(epoch_micros(ev, "ts").alias("us"), "event_id").collect())
    step = hours * 3_600_000_000
    later = sorted({us for us, _ in recs if us >= recs[0][0] + step})
    want, w = [], 0
    while (at := bisect.bisect_left(later, w)) < len(later):
        want.append(later[at])
        w = later[at] + step
    got = chains.chain_cuts(spark.createDataFrame([(us,) for us in later], "_us long"), step, fan, size)
    assert sorted(tuple(r) for r in got.select("k", "_us").collect()) == list(enumerate(want, start=1))


def test_jobs_do_not_grow_with_the_rows(spark):
    """The chain over ten times the times, in ten times the ranges, takes one level of the tree more."""
    def jobs(n):
        group = f"chain-{n}"
        spark.sparkContext.setJobGroup(group, group)
        rows = spark.range(n).select((F.col("id") * 7).alias("_us"))
        assert chains.chain_cuts(rows, 50, 16, 100).count() == -(-n * 7 // 56)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs(4_000), jobs(40_000)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert many <= few + 6


def test_elapsed_time_bounds_reach_the_reader(spark):
    ev = fx.events(spark, SF_SMALL)
    got = bt.batch_by_elapsed(ev, "ts", "event_id", "2 days", 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts," in plan.split("PushedFilters")[1].split("ReadSchema")[0]
    start = bt.ts_literal(ev, "ts", 1_700_000_000_000_000)
    plan = ev.where(F.col("ts") >= start)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2023-11-14" in plan


def test_count_batches_and_limit(spark):
    ev = fx.table(spark, SF_SMALL, "events").select("event_id")
    got = bt.batch_by_count(ev, ["event_id"], 300, limit=3).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [(r["batch_id"], r["count"]) for r in got] == [(1, 300), (2, 300), (3, 300)]


def test_interval_parsing():
    assert bt.interval_micros("10 minutes") == 600_000_000
    assert bt.interval_micros(dt.timedelta(days=1)) == 86_400_000_000


# ---- rows / sources ---------------------------------------------------------------------------

def test_clean_lines_strips_like_python_and_drops_header(spark):
    raw = ["h1,h2", "  a,b \t", "\x1fc,d\r", "", "   "]
    df = spark.createDataFrame([(x,) for x in raw], "value string")
    got = [r["value"] for r in lines.clean_lines(df, header="h1,h2").collect()]
    assert got == [x.strip() for x in raw if x.strip() != "h1,h2"]
    assert lines.clean_lines(df, header="h1,h2", keep_blank=False).count() == 2


def test_quoted_comma_naive_split_shifts_and_from_csv_does_not(spark):
    df = spark.createDataFrame([('1,"x, y",z',)], "value string")
    naive = lines.split_naive(df, ["a", "b", "c", "d"]).first()
    assert (naive["b"], naive["c"]) == ('"x', ' y"')
    q = lines.parse_quoted(df, "a INT, b STRING, c STRING").first()
    assert (q["a"], q["b"], q["c"]) == (1, "x, y", "z")


def test_presence_policies(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, c string")
    assert rows.project_present(df, ["x", "c", "id"]).columns == ["c", "id"]
    with pytest.raises(ValueError):
        rows.present_columns(df, ["x", "c"], policy="require")
    with pytest.raises(ValueError):
        rows.present_columns(df, ["x"], policy="nonempty")


def test_exclude_id_keeps_sql_semantics(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "id bigint")
    assert sorted(r["id"] for r in rows.exclude_id(df, "id", 3).collect()) == [1]
    assert rows.exclude_id(df, "id", None).count() == 3
    assert rows.exclude_id(df, "nope", 3).count() == 3


def test_assembler_error_mode_fails_on_null(spark):
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(1, None), (2, 1.0)], "id bigint, x double")
    with pytest.raises(Exception):
        VectorAssembler(inputCols=["x"], outputCol="f").transform(df).collect()


def test_validate_requests_edges(spark):
    df = spark.createDataFrame([
        (1, "a", "b", "3"), (2, None, "b", None), (3, "a", "b", "abc"), (4, "a", "b", "0"),
        (5, "a", "b", "-1"), (6, None, None, "2")], "request_id bigint, f1 string, f2 string, k string")
    got = {r["request_id"]: r for r in rq.validate(df, ["f1", "f2"], k_col="k").collect()}
    assert got[1]["status"] == "ok" and got[1]["k"] == 3
    assert got[2]["status"] == "invalid" and got[2]["missing_n"] == 1 and got[2]["error"].endswith("f1")
    assert got[3]["k"] is None and got[3]["error"] == rq.K_ERROR
    assert got[4]["status"] == got[5]["status"] == "invalid"
    assert got[6]["has_known_feature"] is False and got[1]["has_known_feature"] is True
    no_k = rq.validate(df.drop("k"), ["f1"]).where("request_id = 1").first()
    assert no_k["k"] == rq.DEFAULT_K


# ---- regression -------------------------------------------------------------------------------

def test_ols_matches_mllib_and_constant_column_gets_zero(spark):
    t = fx.tx(spark, SF_SMALL)
    cats = ["property_type", "duration"]
    ix = LabelMaps.fit(t, cats).transform(t).withColumn("const", F.lit(0.0)).persist()
    mine = fit_ols(ix, ["property_type_index", "duration_index"], "price").first()
    with_const = fit_ols(ix, ["property_type_index", "duration_index", "const"], "price").first()
    model = mdl.fit_price_pipeline(t, cats, "price").stages[-1]
    assert mine["b0"] == pytest.approx(model.intercept, rel=1e-8)
    assert [mine["b1"], mine["b2"]] == pytest.approx(list(model.coefficients), rel=1e-7)
    assert with_const["b3"] == 0.0
    assert with_const["b1"] == pytest.approx(mine["b1"], rel=1e-9)
    assert mine["r2"] == pytest.approx(model.summary.r2, abs=1e-9)


def test_predict_and_assign_are_row_independent(spark):
    """A request answered inside a whole table gets the same value as answered alone (the
    reference's one-request-per-job serving), for the price pipeline and the cluster pipeline."""
    t = fx.tx(spark, SF_SMALL)
    cats = ["property_type", "duration", "district"]
    price = mdl.fit_price_pipeline(t, cats, "price")
    clusters = mdl.fit_cluster_pipeline(t, cats, k=3)
    whole_p = {r["id"]: r["prediction"] for r in price.transform(t).select("id", "prediction").collect()}
    whole_c = {r["id"]: r["cluster"] for r in clusters.transform(t).select("id", "cluster").collect()}
    for rid in [r["id"] for r in rows.sample_rows(t, 3, "id").select("id").collect()]:
        one = t.where(F.col("id") == rid)
        assert price.transform(one).first()["prediction"] == pytest.approx(whole_p[rid], rel=1e-12)
        assert clusters.transform(one).first()["cluster"] == whole_c[rid]


# ---- k-means ----------------------------------------------------------------------------------

def test_kmeans_fit_invariants(spark):
    from tidemark.plans.q_models import KM_K, _km_points

    pts = _km_points(spark, SF_SMALL)
    model, out = mdl.fit_kmeans(pts, "vec", KM_K)
    centres = np.array([np.asarray(c) for c in model.clusterCenters()])
    got = out.select("vec", "cluster").collect()
    assert len({r["cluster"] for r in got}) == KM_K
    for r in got:
        d = ((centres - np.asarray(r["vec"])) ** 2).sum(axis=1)
        assert d[r["cluster"]] == pytest.approx(d.min(), abs=1e-9)


# ---- similarity -------------------------------------------------------------------------------

def _brute_force(items, reqs, vectors, bucket, k, exclude_self):
    vm = np.asarray(vectors)
    ih = np.floor(items[1] @ vm.T / bucket)
    qh = np.floor(reqs[1] @ vm.T / bucket)
    out = {}
    for qi, rid in enumerate(reqs[0]):
        shared = (ih == qh[qi]).any(axis=1)
        if exclude_self:
            shared &= items[0] != rid
        cand = np.nonzero(shared)[0]
        d = np.sqrt(((items[1][cand] - reqs[1][qi]) ** 2).sum(axis=1))
        order = sorted(range(len(cand)), key=lambda j: (round(d[j], 9), items[0][cand[j]]))[:k]
        out[int(rid)] = [int(items[0][cand[j]]) for j in order]
    return out


@pytest.mark.parametrize("group_rows", [20_000, 7])
def test_recommend_equals_brute_force_including_hot_bucket_split(spark, group_rows):
    e = fx.embeddings(spark, SF_SMALL)
    data = e.orderBy("id").collect()
    ids = np.array([r["id"] for r in data])
    mat = np.array([r["vec"] for r in data])
    vectors = sim.projection_vectors(64, 3, 7)
    req = e.select(F.col("id").alias("request_id"), F.col("id").alias("self_id"), "vec")
    got = sim.recommend(e, req, 5, vectors, 0.1, self_id="self_id", group_rows=group_rows).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["request_id"], r["rank"])):
        by.setdefault(r["request_id"], []).append(r["id"])
    want = _brute_force((ids, mat), (ids, mat), vectors, 0.1, 5, True)
    assert by == {q: v for q, v in want.items() if v}


def test_recommend_per_request_k_equals_brute_force(spark):
    # each request asks for its own count (0 and null get nothing); grid split forced by 40-row groups
    e = fx.embeddings(spark, SF_SMALL)
    data = e.orderBy("id").collect()
    ids = np.array([r["id"] for r in data])
    mat = np.array([r["vec"] for r in data])
    vectors = sim.projection_vectors(64, 3, 7)
    kcol = F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 9).cast("int")
    req = e.select(F.col("id").alias("request_id"), F.col("id").alias("self_id"), kcol.alias("k"), "vec")
    got = sim.recommend(e, req, "k", vectors, 0.1, self_id="self_id", group_rows=40).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["request_id"], r["rank"])):
        by.setdefault(r["request_id"], []).append(r["id"])
    want = _brute_force((ids, mat), (ids, mat), vectors, 0.1, 8, True)
    ks = {int(i): (None if i % 11 == 0 else int(i % 9)) for i in ids}
    assert by == {q: v[:ks[q]] for q, v in want.items() if v and ks[q]}


def test_far_key_has_no_neighbours(spark):
    e = fx.embeddings(spark, SF_SMALL)
    vectors = sim.projection_vectors(64, 3, 7)
    far = e.where("id = 0").select(F.lit(1).cast("bigint").alias("request_id"),
                                   F.transform("vec", lambda x: x * 1000.0).alias("vec"))
    assert sim.recommend(e, far, 5, vectors, 0.1).count() == 0


def test_recommend_with_ids_beyond_double_precision(spark):
    base = 2 ** 60
    items = spark.createDataFrame([(base + 1, [0.0, 0.0]), (base + 2, [0.0, 0.1]), (base + 3, [0.1, 0.1]), (5, [0.2, 0.2])],
                                  "id bigint, vec array<double>")
    req = spark.createDataFrame([(1, base + 1, [0.0, 0.0])], "request_id bigint, self_id bigint, vec array<double>")
    got = sim.recommend(items, req, 3, sim.projection_vectors(2, 3, 7), 10.0, self_id="self_id").orderBy("rank").collect()
    # all share the sign buckets or not by the projections alone; near ones are not lost to rounding of ids
    assert [r["id"] for r in got][:2] == [base + 2, base + 3] or {base + 1} & {r["id"] for r in got} == set()
    assert base + 1 not in [r["id"] for r in got]


@pytest.mark.parametrize("dim", [4, 64, 80])
def test_null_vectors_are_no_items_and_no_requests(spark, dim):
    rs = np.random.RandomState(dim)
    data = [(i, [float(x) for x in rs.normal(size=dim)]) for i in range(40)]
    nulls = [(100, None), (101, [None] + [0.0] * (dim - 1))]
    clean, all_ = (spark.createDataFrame(x, "id bigint, vec array<double>") for x in (data, data + nulls))
    vectors = sim.projection_vectors(dim, 3, 7)
    hashes = {r["id"]: r["h"] for r in all_.select("id", sim.lsh_hashes(F.col("vec"), vectors, 2.0).alias("h")).collect()}
    assert hashes[100] is None and hashes[101] is None and all(len(hashes[i]) == 3 for i in range(40))
    got = [sorted(map(tuple, sim.recommend(d, d.select(F.col("id").alias("request_id"), "vec"), 3, vectors, 2.0).collect()))
           for d in (clean, all_)]
    assert got[0] == got[1]
    near = sim.knn_single(all_, "vec", data[0][1], 2).collect()
    assert near[0]["id"] == 0 and {r["id"] for r in near} <= set(range(40))


@pytest.mark.parametrize("dim", [4, 80])
def test_nan_and_infinite_vectors_are_no_items_and_no_requests(spark, dim):
    rs = np.random.RandomState(dim)
    data = [(i, [float(x) for x in rs.normal(size=dim)]) for i in range(3)]
    nans = [(100, [float("nan")] + [0.0] * (dim - 1)), (101, [0.0] * (dim - 1) + [float("nan")]),
            (102, [float("inf")] + [0.0] * (dim - 1)), (103, [float("-inf")] * dim)]
    clean, all_ = (spark.createDataFrame(x, "id bigint, vec array<double>") for x in (data, data + nans))
    vectors = sim.projection_vectors(dim, 3, 7)
    hashes = {r["id"]: r["h"] for r in all_.select("id", sim.lsh_hashes(F.col("vec"), vectors, 1e6).alias("h")).collect()}
    assert all(hashes[i] is None for i in range(100, 104)) and all(len(hashes[i]) == 3 for i in range(3))
    one = F.array(F.lit(0).cast("bigint"))  # all in one bucket, of fewer vectors than are asked for
    got = []
    for d in (clean, all_):
        items, asked = d.withColumn("h", one), d.select(F.col("id").alias("request_id"), "vec", one.alias("h"))
        got.append(sorted(map(tuple, sim.recommend(items, asked, 5, None, None, item_hashes="h", req_hashes="h").collect())))
    assert got[0] == got[1] and len(got[0]) == 9
    near = sim.knn_single(all_, "vec", data[0][1], 5).collect()
    assert near[0]["id"] == 0 and sorted(r["id"] for r in near) == [0, 1, 2]


@pytest.mark.parametrize("dim", [4, 80])
def test_hashes_of_huge_vectors_are_the_ends_of_the_range(spark, dim):
    rows = [(0, [1e300] * dim), (1, [-1e300] * dim), (2, [1.0] * dim)]
    ones = [[1.0] * dim]
    got = {r["id"]: r["h"][0] for r in spark.createDataFrame(rows, "id bigint, vec array<double>").select("id", sim.lsh_hashes(F.col("vec"), ones, 2.0).alias("h")).collect()}
    assert got == {0: 2**63 - 1, 1: -2**63, 2: dim // 2}


def test_knn_many_equals_brute_force_for_a_key_table(spark):
    e = fx.embeddings(spark, SF_SMALL)
    keys = e.where("id < 30").select(F.col("id").alias("qid"), "vec")
    got = {(r["qid"], r["rank"]): r["id"] for r in sim.knn_many(e, "vec", keys, 3).collect()}
    data = e.orderBy("id").collect()
    m = np.array([r["vec"] for r in data])
    for q in range(30):
        d = np.round(np.sqrt(((m - m[q]) ** 2).sum(axis=1)), 9)
        assert [got[q, r] for r in (1, 2, 3)] == [int(data[i]["id"]) for i in np.lexsort((np.arange(len(m)), d))[:3]]


def test_responses_answer_requests_without_neighbours(spark):
    recs = spark.createDataFrame([(1, 1, 7, 0.5)], "request_id bigint, rank int, id bigint, dist double")
    items = spark.createDataFrame([(7, "a")], "id bigint, name string")
    asked = spark.createDataFrame([(1,), (2,)], "request_id bigint")
    got = {r[0]: r[1] for r in sim.response_objects(recs, items, "id", ["id", "name"], asked).collect()}
    assert got[1] == '{"message":"Found 1 similar properties.","recommendations":[{"id":7,"name":"a","distCol":0.5}]}'
    assert got[2] == '{"message":"Found 0 similar properties.","recommendations":[]}'


# ---- session independence -------------------------------------------------------------------

@pytest.mark.parametrize("name", ["batch_by_window", "batch_by_elapsed", "write_batches_csv"])
def test_time_queries_do_not_depend_on_session_zone(spark, name):
    import __spark_entry__ as ent

    q = ent.queries()[name]
    base = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        other = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other


def test_display_columns_follow_what_stages_declare(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    made = sim.stage_outputs([StringIndexer(inputCols=["a"], outputCols=["a_index"]), VectorAssembler(inputCols=["a_index"], outputCol="features")])
    assert made == ["a_index", "features"]
    assert sim.display_columns(["id", "land_index", "a", "a_index", "features"], made) == ["id", "land_index", "a"]
    assert sim.display_columns(made, made, ["id"]) == ["id"]


def test_top_n_ordered_and_unordered(spark):
    df = spark.createDataFrame([(i, float(10 - i)) for i in range(10)], "id bigint, dist double")
    assert [r["id"] for r in sim.top_n(df, 3).collect()] == [9, 8, 7]
    assert sim.top_n(df.drop("dist"), 4).count() == 4


def test_sample_stays_a_top_n_under_later_projections(spark):
    # request validation over sampled rows once planned a global range sort of the whole table
    from tidemark.plans import q_requests as qr

    t = fx.tx(spark, SF_SMALL)
    v = rq.validate(qr.request_rows(rows.sample_rows(t, 50, "id")), [], k_col="num_recommendations",
                    known=fx.TX_CATS)
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert v.count() == 50


def test_label_stage_saves_and_loads_large_maps_as_tables(spark, monkeypatch):
    """Maps beyond the inline and broadcast sizes: joined, saved in a pipeline, loaded, equal; no label is collected."""
    import json
    import os

    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    from tidemark.operators import labels
    from tidemark.operators.label_stage import LabelMapModel

    monkeypatch.setattr(labels, "INLINE_LABELS", 0)
    monkeypatch.setattr(labels, "BROADCAST_LABELS", 0)
    t = spark.createDataFrame([(i, None if i % 11 == 0 else f"a.{i * i % 37}", ["x", "y", None][i % 3]) for i in range(200)], "id long, `a b` string, d string")
    cols, made = ["a b", "d"], ["a b_index", "d_index"]
    path = scratch_path(spark, "label-stage")
    fitted = Pipeline(stages=[mdl.indexers(cols), VectorAssembler(inputCols=["d_index"], outputCol="v")]).fit(t)
    mdl.save(fitted, path)
    mdl.save(fitted, path)  # again, over the first
    loaded = mdl.load(path)
    assert isinstance(loaded, PipelineModel) and isinstance(loaded.stages[0], LabelMapModel) and loaded.stages[0].maps.inline == {}
    new = t.unionByName(spark.createDataFrame([(900, "unseen", "z")], t.schema))
    want = StringIndexer(inputCols=cols, outputCols=made, handleInvalid="keep").fit(t).transform(new)
    for model in (fitted, loaded):
        got = model.transform(new)
        assert sorted(got.select("id", *(f"`{c}`" for c in made)).collect()) == sorted(want.select("id", *(f"`{c}`" for c in made)).collect())
    stage = next(p for p in os.listdir(f"{path}/stages") if "LabelMapModel" in p)
    text = "".join(open(f"{path}/stages/{stage}/metadata/{f}").read() for f in os.listdir(f"{path}/stages/{stage}/metadata") if f.startswith("part"))
    assert set(json.loads(text)["paramMap"]) == {"inputCols", "outputCols"}  # no label in the metadata
    with pytest.raises(ValueError, match="cannot be saved over"):
        loaded.stages[0].write().overwrite().save(loaded.stages[0].source)


def test_feature_list_roundtrip(spark):
    path = scratch_path(spark, "cols")
    cols = ["Property Type", "Old/New", "Record Status - monthly file only"]
    mdl.save_feature_list(spark, cols, path)
    assert mdl.load_feature_list(spark, path) == cols


@pytest.mark.parametrize("interval,limit,emit_open,max_collected", [
    ("1 hours", None, False, 100_000), ("90 minutes", None, True, 5), ("3 hours", 50, False, 5), ("2 days", None, True, 100_000)])
def test_pointer_doubling_cutter_equals_expected_batches(spark, monkeypatch, interval, limit, emit_open, max_collected):
    monkeypatch.setattr(bt, "MAX_COLLECTED_CUTS", max_collected)  # 5 forces the distributed labelling
    monkeypatch.setattr(chains, "DENSE", 0)  # no composition
    ev = fx.events(spark, SF_SMALL)
    got = {r["event_id"]: r["batch_id"] for r in
           bt.batch_by_elapsed(ev, "ts", "event_id", interval, limit, emit_open, method="many").collect()}
    recs = sorted((int(r["us"]), int(r["event_id"])) for r in
                  ev.select(epoch_micros(ev, "ts").alias("us"), "event_id").collect())
    assert got == expected_batches(recs, bt.interval_micros(interval), limit, emit_open)


def test_configured_checkpoint_dir_is_used(tmp_path):
    """A session that names spark.checkpoint.dir (as a cluster would) gets checkpoints and scratch
    tables there; run in a fresh process because the test session already exists."""
    import subprocess
    import sys
    import textwrap

    code = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {str(__import__('tests.conftest', fromlist=['ROOT']).ROOT)!r})
        from pyspark.sql import SparkSession
        s = (SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", {str(tmp_path)!r})
             .config("spark.ui.enabled", "false").getOrCreate())
        from tidemark.session import checkpoint_root, scratch_path, write_table
        assert checkpoint_root(s) == {str(tmp_path)!r}
        assert scratch_path(s, "x").startswith({str(tmp_path)!r})
        assert write_table(s.range(5), "x").count() == 5
        print("OK")
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "OK" in out.stdout, out.stderr[-2000:]
    assert any(tmp_path.iterdir())


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.session import checkpoint_root

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(master="spark://head:7077", getConf=lambda: conf, getCheckpointDir=lambda: None, applicationId="x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc))


def test_shuffle_partitions_are_left_to_the_cluster():
    import inspect

    from tidemark.session import get_spark

    assert inspect.signature(get_spark).parameters["shuffle_partitions"].default is None


def test_drop_scratch_deletes_what_was_written(spark):
    import os

    from tidemark import session

    path = session.scratch_path(spark, "gone")
    kept = session._WRITTEN.pop(spark.sparkContext.applicationId)
    session._WRITTEN[spark.sparkContext.applicationId] = [path]
    spark.range(3).write.parquet(path)
    assert session.drop_scratch(spark) == 1 and not os.path.exists(path)
    session._WRITTEN[spark.sparkContext.applicationId] = [p for p in kept if p != path]
