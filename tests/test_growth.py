"""What keeps large tables in their limits: sieved distances, answers without a shuffle, small pieces of text."""

from __future__ import annotations

import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm import bpe, decontaminate, partenum, pfor, substrings
from tidemark.llm.library_ids import LibraryIds
from tidemark.operators import similarity as sim
from tidemark.operators import vector_groups as vg
from tidemark.sources import records
from tidemark.streaming import keyed_cutter


def _table(x: np.ndarray, first: int, kk: int | None = None) -> pa.Table:
    cols = {"vk": pa.array(np.arange(first, first + len(x))), "vec": pa.array(x.tolist(), pa.list_(pa.float64()))}
    return pa.table(cols | ({} if kk is None else {"kk": pa.array([kk] * len(x), pa.int32())}))


@pytest.mark.parametrize("scale", [1.0, 1e-12, 1e-25, 1e9, 1e30, 1e200])
@pytest.mark.parametrize("items, kk", [(3, 6), (700, 6), (5000, 3), (5000, 300)])
def test_sieved_group_equals_brute_force(scale, items, kk):
    rng = np.random.default_rng(items + kk)
    m = rng.normal(size=(items, 5)).round(1) * scale  # rounded: many equal distances
    q = np.concatenate([m[:20], rng.normal(size=(20, 5)) * scale])
    with np.errstate(over="ignore"):
        got = vg.nearest(9)(_table(m, 0), _table(q, 0, kk))
        d = np.sqrt(((q[:, None, :] - m[None, :, :]) ** 2).sum(axis=2))
    rd = np.round(d, 9)
    row, col = np.nonzero(rd <= np.sort(rd, axis=1)[:, min(kk, items) - 1][:, None])
    assert sorted(zip(*(got.column(c).to_pylist() for c in ("qk", "ik", "dist")), strict=True)) == \
        sorted(zip(row.tolist(), col.tolist(), d[row, col].tolist(), strict=True))


def test_few_pairs_of_a_group_get_an_exact_distance():
    x = np.random.default_rng(1).normal(size=(8000, 64))
    row, _ = vg._sieved(x[:200], x, np.full(200, 6), 9)
    assert 200 * 6 <= len(row) < 200 * 20


def test_requests_are_answered_without_shuffling_their_answers(spark):
    items = spark.range(3000).select("id", F.array((F.col("id") % 7).cast("double"), F.lit(1.0)).alias("vec"))
    req = items.select(F.col("id").alias("request_id"), F.col("id").alias("self_id"), "vec")
    recs = sim.recommend(items, req, 5, [[1.0, 0.0]], 2.0, self_id="self_id")
    assert "Window" not in recs._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.request_id, r["rank"]): r.id for r in recs.collect()}
    assert len(got) == 15000 and [got[14, i] for i in range(1, 6)] == [0, 7, 21, 28, 35]


def test_a_count_beyond_the_array_limit_is_ranked_as_rows(spark, monkeypatch):
    items = spark.range(300).select("id", F.array((F.col("id") % 7).cast("double"), F.lit(1.0)).alias("vec"))
    req = items.select(F.col("id").alias("request_id"), F.col("id").alias("self_id"), (F.col("id") % 9).cast("int").alias("k"), "vec")
    rows = []
    for most in (1, 1000):
        monkeypatch.setattr(sim, "MOST_ARRAY", most)
        rows.append(sorted(map(tuple, sim.recommend(items, req, "k", [[1.0, 0.0]], 2.0, self_id="self_id").collect())))
    assert rows[0] == rows[1] and rows[0]


def test_pieces_of_a_block_number_and_hold_its_records(tmp_path, monkeypatch):
    text = "".join(f'{i},"{"x" * (i * 37 % 50)}\n""{i}"\n' for i in range(200)) + '200,"open\nto the end\n'
    (tmp_path / "part-0").write_text(text)
    for piece in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(records, "PIECE_BYTES", piece)
        for quote in (ord('"'), None):
            odd = before = 0
            got = []
            for at in range(0, len(text), piece):
                some, odd, before = records.cut_piece(str(tmp_path / "part-0"), at, min(at + piece, len(text)), quote, odd, before)
                got += some
            if quote is None:
                want = text.encode().split(b"\n")[:-1]
            else:
                want = [f'{i},"{"x" * (i * 37 % 50)}\n""{i}"'.encode() for i in range(200)] + [b'200,"open\nto the end\n']
            assert got == list(enumerate(want))


def test_a_block_is_cut_and_split_within_little_memory(tmp_path):
    """Of a block of 24 MB neither the counts nor the records are held at once."""
    import tracemalloc

    name = str(tmp_path / "part-0")
    with open(name, "w") as f:
        for i in range(12_000):
            f.write(f'{i},"{"word, " * 330}\n"\n')
    kernels = []

    class Frame:
        schema = StructType()

        def select(self, *_):
            return self

        def mapInArrow(self, fn, _):  # noqa: N802
            kernels.append(fn)
            return self

    tracemalloc.start()
    records.split_quoted(Frame(), ["id", "body"])
    values = pa.array([f'{i},"{"word, " * 330}\n"' for i in range(12_000)])
    batch = pa.record_batch({"value": values})
    del values
    tracemalloc.reset_peak()
    base = tracemalloc.get_traced_memory()[0]
    assert sum(len(b) for b in kernels[0](iter([batch]))) == 12_000
    assert tracemalloc.get_traced_memory()[1] - base < 16 << 20
    odd = before = found = 0
    tracemalloc.reset_peak()
    base = tracemalloc.get_traced_memory()[0]
    size = (tmp_path / "part-0").stat().st_size
    for at in range(0, size, records.PIECE_BYTES):
        some, odd, before = records.cut_piece(name, at, min(at + records.PIECE_BYTES, size), ord('"'), odd, before)
        found += len(some)
    assert found == before == 12_000 and tracemalloc.get_traced_memory()[1] - base < 48 << 20
    tracemalloc.stop()


class _State:
    def __init__(self):
        self.getOption = None

    def update(self, value):
        self.getOption = value


@pytest.mark.parametrize("limit", [None, 3])
def test_a_key_goes_on_from_its_state_whatever_frames_its_records_come_in(limit):
    rng = np.random.default_rng(4)
    us, ids = np.sort(rng.integers(0, 900, 300)), np.array([f"r{i:03d}" for i in range(300)], object)
    cut = keyed_cutter._cutter(90, limit)

    def frame(at):
        return pd.DataFrame({"us": us[at], "has_id": np.ones(len(at), bool), "id": ids[at]})

    whole = pd.concat(list(cut((True, "k"), iter([frame(np.arange(300))]), _State())), ignore_index=True)
    state, parts = _State(), []
    for half in (np.arange(150), np.arange(150, 300)):
        mixed = rng.permutation(half)
        parts += list(cut((True, "k"), iter([frame(mixed[:40]), frame(mixed[40:])]), state))
    parts = pd.concat(parts, ignore_index=True)
    # within the same time records are ordered by id; the halves are cut at a record, so they agree
    pd.testing.assert_frame_equal(whole, parts)
    at = keyed_cutter.chain(us, 90, int(us[0]), limit)
    assert np.flatnonzero(whole["closes"]).tolist() == at and state.getOption == (int(us[at[-1]]), len(at))
    assert len(whole) == (300 if limit is None else at[-1] + 1) and whole["batch"].tolist() == \
        (1 + np.searchsorted(at, np.arange(len(whole)))).tolist()


def test_states_come_with_the_records_and_are_not_asked_for(spark, tmp_path):
    df = spark.range(3).select(F.col("id").alias("user_id"), F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    labels = keyed_cutter.KeyedCutter(spark, str(tmp_path / "out"), "user_id", "ts", "event_id", "1 hours").labels(stream)
    plan = labels._jdf.queryExecution().logical().toString()
    assert "TransformWithState" not in plan and "FlatMapGroupsInPandasWithState" in plan


def test_what_is_beyond_a_known_distance_leaves_no_group():
    rng = np.random.default_rng(2)
    m = rng.normal(size=(4000, 8)).round(1)
    q = np.concatenate([m[:30], rng.normal(size=(30, 8))])
    d = np.sqrt(((q[:, None, :] - m[None, :, :]) ** 2).sum(axis=2))
    far = np.sort(d, axis=1)[:, 5]
    far[:10] = 0.0
    far[10:20] = np.inf
    reqs = _table(q, 0, 9).append_column("far", pa.array(far))
    got = vg.nearest(9)(_table(m, 0), reqs)
    rd = np.round(d, 9)
    row, col = np.nonzero((rd <= np.sort(rd, axis=1)[:, 8][:, None]) & (d <= far[:, None] + 2e-9))
    assert sorted(zip(*(got.column(c).to_pylist() for c in ("qk", "ik")), strict=True)) == list(zip(row.tolist(), col.tolist(), strict=True))


def test_word_classes_are_single_characters_and_those_of_the_contract(spark):
    assert "-" not in decontaminate._GAP + decontaminate._WORD.removeprefix("[^")
    want = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
    rows = [(c, chr(c)) for c in (*range(0x180), 0x2028, 0x4E2D, 0x1F600)]
    df = spark.createDataFrame(rows, "c int, text string").select(
        "c", F.size(decontaminate.words_of("text")).alias("n"), F.regexp_count("text", F.lit(decontaminate._WORD)).alias("m"))
    for r in df.collect():
        n = len(want.findall(chr(r.c).lower() if r.c < 128 else chr(r.c)))
        assert (r.n, r.m) == (n, n), r.c


def test_a_full_word_cache_keeps_the_words_in_use(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 40 * bpe.WORD_BYTES)
    asked = []

    class Spelled(bpe.WordIds):
        def __init__(self):
            self.split = str.split
            self.clear()

        def resolve(self, words):
            asked.extend(words)
            return np.array([ord(c) for w in words for c in w], np.int32), np.concatenate([[0], np.cumsum([len(w) for w in words])])

    enc = Spelled()
    for i in range(60):
        texts = [f"often w{i} also x{i} often", None, "", f"y{i}"]
        ids, at = enc.encode(texts)
        assert ["".join(map(chr, ids[a:b])) for a, b in zip(at, at[1:], strict=False)] == ["".join((t or "").split()) for t in texts]
        assert enc.held <= 60 * bpe.WORD_BYTES and len(enc.slot) == len(enc.at) - 1 == len(enc.uses)
    assert asked.count("often") == asked.count("also") == 1 and len(asked) == 182


def _peak(f):
    """(result, bytes that numpy and Python held at most) of a call."""
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_block_of_texts_is_cut_a_piece_at_a_time():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 16, 500)) for _ in range(1400)]
    texts[7], texts[9], texts[11] = None, f"{texts[900]} tail", ""
    size = sum(len(t or "") for t in texts)
    t = pa.table({"id": pa.array(range(len(texts))), "text": pa.array(texts)})
    got, most = _peak(lambda: substrings.cut_block(t, pa.table({"names": pa.array([], pa.binary())}), ["id", "text"]))
    assert size > 3 << 20 and most < 10 * size  # 21 times the text when a block was held whole
    assert got.column("text").to_pylist() == texts and got.column("n_removed").to_pylist() == [500 if i in (9, 900) else 0 for i in range(1400)]
    assert got.column("kept").to_pylist() == ["tail" if i == 9 else "" if i == 900 else x or "" for i, x in enumerate(texts)]


def test_bitmaps_are_gathered_by_words():
    sizes = np.repeat([32, 64, 256], 8000)
    rows = [bytes([i % 251]) * n for i, n in enumerate(np.random.default_rng(3).permutation(sizes).tolist())]
    bits = pa.chunked_array([pa.array(rows, pa.binary())]).slice(1)
    maps, most = _peak(lambda: partenum.Bitmaps(bits))
    assert most < 6 * sizes.sum()  # 16 and more when each byte had its index
    assert [maps.rows[len(r)][p].tobytes() for r, p in zip(rows[1:], maps.place.tolist(), strict=True)] == rows[1:]


def test_packed_bits_equal_bit_by_bit_packing():
    rng = np.random.default_rng(4)
    for width in range(1, 33):
        v = rng.integers(0, 1 << 32, (5, pfor.BLOCK), dtype=np.uint64).astype(np.uint32) >> np.uint32(32 - width)
        bits = (v[:, :, None] >> np.arange(width, dtype=np.uint32) & 1).astype(np.uint8)
        raw = np.packbits(bits.reshape(5, -1), axis=1, bitorder="little")
        assert np.array_equal(pfor.pack_bits(v, width), raw) and np.array_equal(pfor.unpack_bits(raw, width), v)


def test_split_words_are_not_normalised_and_split_again():
    from tokenizers import Tokenizer

    path = bpe.tokenizer_path()
    library, enc = Tokenizer.from_file(path), LibraryIds(path)
    texts = ["Some words, it's 12 \x00\x1f\x7f", "été Straße ǅ İ", "日本語 😀 ''t", "x" * 500]
    words = list(dict.fromkeys(w for t in texts for w in enc.split(t)))
    enc.split.tok = None  # words go to the model itself
    ids, at = enc.resolve(words)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [library.encode(w, add_special_tokens=False).ids for w in words]
