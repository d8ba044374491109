"""Every operator against brute force, the public library or an exact round trip, on awkward rows."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import SF, odd_documents
from tidemark.llm import bpe, interpolation, partenum, pfor, quality, separators, spotsigs, substrings, warc
from tidemark.llm import common as C


def same(got, want):
    """Equal as multisets of rows, nulls included."""
    a, b = (sorted(map(repr, x)) for x in (got, want))
    assert a == b, ([x for x in a if x not in b][:3], [x for x in b if x not in a][:3])


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def odd_rows():
    return [(r[0], r[1]) for r in odd_documents()]


def sf_rows(spark):
    return rows_of(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op2_bpe_codec", "op3_quality", "op4_spotsigs", "op5_lm_scores", "op6_jaccard_join",
                                  "op7_pfor_ids", "op8_warc", "op9_token_counts", "op10_winnowing"])
def test_empty_tables_give_no_rows(spark, tables, queries, name):
    assert queries[name](spark, tables[1]).collect() == []


# ---- op1

@pytest.mark.parametrize("which", ["odd", "sf"])
def test_substrings_equal_brute_force(spark, tables, queries, which):
    folder, rows = (tables[0], odd_rows()) if which == "odd" else (SF, sf_rows(spark))
    got = rows_of(queries["op1_substring_dedup"](spark, folder), "doc_id", "n_words", "n_removed", "kept_sha256")
    same(got, brute.substrings(rows))


@pytest.mark.parametrize("block_bytes,bundle", [(2000, 4_000_000), (2000, 1), (1 << 20, 20)])
def test_substrings_do_not_depend_on_blocks_or_on_longer_prefixes(spark, odd, monkeypatch, block_bytes, bundle):
    monkeypatch.setattr(substrings, "BUNDLE_SUFFIXES", bundle)  # small bundles are dealt out by longer prefixes
    out = substrings.remove_repeats(odd, block_bytes)
    got = rows_of(out.withColumn("h", F.sha2(F.col("kept").cast("binary"), 256)), "doc_id", "n_words", "n_removed", "h")
    same(got, brute.substrings(odd_rows()))
    assert {"id", "block", "score", "lang"} <= set(out.columns)
    for n, spans in rows_of(out, "n_removed", "spans"):
        assert sum(s["end"] - s["start"] for s in spans) == n


# ---- op2

def codec(library, rows):
    out = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_codec_equals_the_library(spark, tables, queries, library, which):
    folder, rows = (tables[0], odd_rows()) if which == "odd" else (SF, sf_rows(spark))
    got = rows_of(queries["op2_bpe_codec"](spark, folder), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    same(got, codec(library, rows))


@pytest.mark.parametrize("size", [0, 1, 50])
def test_codec_does_not_depend_on_the_lexicon(spark, odd, library, size):
    out = bpe.digests(bpe.encode_decode(odd, bpe.build_lexicon(spark, odd, size=size)))
    same([tuple(r) for r in out.collect()], codec(library, odd_rows()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=8), max_size=60), st.lists(st.binary(max_size=8), max_size=20))
def test_automaton_numbers_its_words_and_no_others(words, others):
    words = sorted(set(words))
    t = bpe.automaton(words)
    assert bpe.ordinals(words, t).tolist() == list(range(len(words)))
    strange = [w for w in others if w not in words]
    assert (bpe.ordinals(strange, t) == -1).all()


def test_automaton_shares_suffixes():
    words = sorted(f"{a}{b}ing".encode() for a in "abcdefgh" for b in "xyz")
    # one start, one state after the first letters, one chain for the endings
    assert len(bpe.automaton(words)["ends"]) == 6


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abcdeinrstx'!", min_size=1, max_size=30), min_size=1, max_size=30))
def test_vectorised_merging_equals_the_heap(words):
    t = bpe.merge_tables(bpe.tokenizer_path())
    raw = [w.encode() for w in words]
    ids, at = bpe.merge_words(raw, t)
    for i, w in enumerate(raw):
        assert ids[at[i]: at[i + 1]].tolist() == bpe.merge_long(w, t).tolist()


# ---- op3

def test_quality_scores_every_row(spark, tables, queries):
    got = rows_of(queries["op3_quality"](spark, tables[0]), "doc_id", "held_out", "score", "predicted")
    assert len(got) == len(odd_documents())
    for d, held, score, predicted in got:
        assert 0 <= score <= 1 and predicted == int(score >= 0.7)
        assert held == (d is None or zlib.crc32(str(d).encode()) % 4 == 2)


def test_quality_is_right_on_held_out_rows(spark, queries):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = rows_of(queries["op3_quality"](spark, sf).where("held_out").join(labels, "doc_id"), "predicted", "quality")
    assert np.mean([p == q for p, q in got]) > 0.97
    assert np.mean([p for p, q in got if q == 1]) > 0.97


def test_quality_scores_equal_brute_force(spark, queries):
    sf = "/root/testdata/sf0.01"
    rows = quality.vectors(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    at = {r.doc_id: i for i, r in enumerate(rows)}
    known = {(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()}
    labels = [(at[d], y) for d, y in known if d in at and y in (0, 1) and zlib.crc32(str(d).encode()) % 4 != 2]
    want = brute.discriminant(np.array([r.x for r in rows]), labels)
    got = {r.doc_id: r.score for r in queries["op3_quality"](spark, sf).collect()}
    assert len(got) == len(rows) and len({y for _, y in labels}) == 2
    assert max(abs(got[r.doc_id] - w) for r, w in zip(rows, want, strict=True)) < 1e-6


def test_quality_without_a_class_scores_the_prior(spark, none, odd):
    rows = quality.vectors(odd)
    model = quality.train(rows, spark.createDataFrame([(i, 1) for i in range(20)], "doc_id bigint, quality int"))
    assert not model.trained
    scores = {r.score for r in quality.score(odd, model).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


# ---- op4

def words_of(text):
    import regex

    spaced = regex.sub(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])", r" \1 ", text.lower())
    return [x for x in regex.split(r"[^\p{L}\p{N}]+", spaced) if x]


def spots(text):
    w, common, out = words_of(text), set(spotsigs.ANCHORS), set()
    for i, x in enumerate(w):
        if x in common or not any(y in common for y in w[max(0, i - spotsigs.GAP): i]):
            c = [y for y in w[i + 1: i + 1 + spotsigs.REACH] if y not in common][: spotsigs.CHAIN]
            if len(c) == spotsigs.CHAIN:
                out.add((x, *c))
    return out or ({tuple(w)} if w else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


@pytest.mark.parametrize("range_bytes", [8 << 20, 30_000])
def test_spotsigs_equal_brute_force(spark, queries, monkeypatch, range_bytes):
    monkeypatch.setattr(spotsigs, "RANGE_BYTES", range_bytes)
    rows = sorted(sf_rows(spark))
    got = {r.doc_id: r for r in queries["op4_spotsigs"](spark, SF).collect()}
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].near_edited == pytest.approx(jaccard(spots(t), spots(edited)), abs=1e-9)
        assert got[d].near_next == pytest.approx(jaccard(spots(t), spots(after)), abs=1e-9)


def test_spotsigs_of_awkward_rows(spark, tables, queries):
    got = queries["op4_spotsigs"](spark, tables[0]).collect()
    assert len(got) == len(odd_documents())
    by_text = {}
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").select("doc_id", "text").collect()
    texts = {d: t for d, t in docs if d not in (None, 7)}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id in texts:
            assert by_text.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint


def test_spotsigs_near_duplicates_equal_brute_force(spark):
    rows = [(d, t) for d, t in sf_rows(spark)]
    rows += [(10_000 + d, t.replace(" the ", " the zz ", 1)) for d, t in rows[:40]] + [(20_000, ""), (20_001, None)]
    got = rows_of(spotsigs.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")), "doc_id", "n_signatures", "component_id")
    sets = [spots(t or "") for _, t in rows]
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and jaccard(a, sets[j]) >= 0.8:
                at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    same(got, [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))])


def test_spotsigs_of_one_document_is_its_own_next(spark):
    df = spark.createDataFrame([(3, "abcdefgh the one two")], "doc_id bigint, text string")
    assert spotsigs.with_next(df, ["text"], 4).first()["next_text"] == "abcdefgh the one two"


def test_spotsigs_compare_texts_without_anchors(spark, queries, tmp_path):
    """Near copies in other scripts, list-like, repeated and short texts, next to a text full of anchors."""
    import random

    rnd = random.Random(3)
    greek = [" ".join(rnd.choices([f"λέξη{i}" for i in range(200)], k=80)) for _ in range(2)]
    han = ["".join(rnd.choices("日月火水木金土山川田人口車門大小中上下左右", k=200)) + "。" for _ in range(2)]
    menu = " | ".join(f"Item{i}" for i in range(60))
    english = " ".join(f"the word{i} and thing{i}" for i in range(60))
    texts = [greek[0], greek[1], han[0], han[1], menu, english, "Nd, " * 90, english + " tail", "one two three four five six seven", english,
             menu + " " + english[:300], "", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries["op4_spotsigs"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        after, cut = texts[(i + 1) % len(texts)], len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        assert got[i].near_edited == pytest.approx(jaccard(spots(t), spots(edited)), abs=1e-9)
        assert got[i].near_next == pytest.approx(jaccard(spots(t), spots(after)), abs=1e-9)
        if t:
            assert got[i].near_edited > 0
    assert all(got[i].near_edited > 0.4 for i in (0, 2, 4)) and got[5].near_next < 0.1 and got[11].near_next == 1


def test_no_long_text_loses_its_edited_copy(spark, queries):
    got = [r.near_edited for r in queries["op4_spotsigs"](spark, "/root/testdata/sf0.1").select("n_chars", "near_edited").collect() if r.n_chars >= 200]
    assert min(got) > 0 and len(got) > 5000


# ---- op5

@pytest.mark.parametrize("which", ["odd", "sf"])
def test_counts_and_base_scores_equal_brute_force(spark, tables, queries, which, monkeypatch):
    monkeypatch.setattr(interpolation, "BLOCK_BYTES", 20_000)  # many blocks, many bundles
    monkeypatch.setattr(interpolation, "BUNDLE_BYTES", 10_000)
    folder, rows = (tables[0], odd_rows()) if which == "odd" else (SF, sf_rows(spark))
    got = queries["op5_lm_scores"](spark, folder).collect()
    want = brute.unigram_scores(rows)
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], [(*x[:5], round(x[5], 6)) for x in want])
    assert all(np.isfinite(r.score) and r.score <= 0 for r in got)
    if which == "sf":
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_mixture_scores_equal_brute_force(spark, tables, queries, which):
    folder, rows = (tables[0], odd_rows()) if which == "odd" else (SF, sf_rows(spark))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    got = sorted(((r.doc_id, r.score) for r in queries["op5_lm_scores"](spark, folder).collect()), key=key)
    want = sorted(brute.mixture_scores(rows), key=key)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert [x[1] for x in got] == pytest.approx([x[1] for x in want], rel=1e-9, abs=1e-9)


def test_mixture_sums_to_one_over_the_vocabulary():
    # contexts a, b over four known words and the unknown one
    c2 = np.array([[5, 3, 0, 0, 0], [0, 1, 1, 0, 0]])
    c1 = np.array([6, 5, 3, 2, 0])
    weights = interpolation.learn_weights([(4, 240, 250, 7), (4, 245, 0, 3), (2, 244, 260, 2)])
    for row in c2:
        context = np.full(5, row.sum())
        p = (weights[interpolation.bucket(context)].T * interpolation._estimates(c1, row, context, c1.sum(), 4)).sum(axis=0)
        assert p.sum() == pytest.approx(1)


def test_weights_follow_the_estimate_that_predicts():
    # in bucket 3 the bigram estimate is far better than the others, in bucket 1 it is nothing
    w = interpolation.learn_weights([(3, 241, 241 + 40, 1000), (1, 241 + 20, 0, 1000)])
    assert w[3][2] > 0.95 and w[1][1] > 0.95 and w[0][2] == 0


# ---- op6

@pytest.mark.parametrize("which", ["odd", "sf"])
def test_jaccard_components_equal_brute_force(spark, tables, queries, which):
    folder, rows = (tables[0], odd_rows()) if which == "odd" else (SF, sf_rows(spark))
    got = rows_of(queries["op6_jaccard_join"](spark, folder), "doc_id", "n_shingles", "component_id")
    same(got, brute.components(rows))


def near_copies(n=70, words=200, seed=3):
    """A base and copies of it with a few words changed: most pairs of copies are not linked."""
    import random

    rnd = random.Random(seed)
    base = [f"v{rnd.randrange(5000)}" for _ in range(words)]
    rows = [(1000, " ".join(base))]
    for i in range(n):
        w = list(base)
        for k in rnd.sample(range(words), rnd.choice([1, 2, 3, 4])):
            w[k] = f"e{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("base", [True, False])
@pytest.mark.parametrize("rounds,block", [(2, 1024), (0, 16)])
def test_groups_of_near_copies_equal_brute_force(spark, monkeypatch, base, rounds, block):
    monkeypatch.setattr(partenum, "HUB_ROUNDS", rounds)  # 0: the search by bitmaps has to find all links
    monkeypatch.setattr(partenum, "GROUP_BLOCK", block)
    rows = near_copies()[0 if base else 1:]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = rows_of(partenum.jaccard_components(df), "doc_id", "n_shingles", "component_id")
    same(got, brute.components(rows))


def test_bands_with_too_few_partitions_fall_back_to_single_elements(spark, monkeypatch):
    original = partenum.signatures

    def failing(hashes, first, fine):
        row, sig, failed = original(hashes, first, fine)
        return row, sig, failed | ({1, 2} - set(fine))

    monkeypatch.setattr(partenum, "signatures", failing)
    rows = near_copies(30)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(rows_of(partenum.jaccard_components(df), "doc_id", "n_shingles", "component_id"), brute.components(rows))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 900), st.integers(0, 900), st.integers(0, 900), st.integers(0, 2**32))
def test_linked_sets_share_enough_signatures(common, only_a, only_b, seed):
    """The guarantee that candidates rest on."""
    rs = np.random.default_rng(seed)
    if 100 * common < 80 * (common + only_a + only_b):
        only_a, only_b = only_a * common // 9000, only_b * common // 9000
    pool = np.unique(rs.integers(0, 2**63, common + only_a + only_b).astype(np.uint64))
    rs.shuffle(pool)
    a, b = pool[: common + only_a], np.concatenate([pool[:common], pool[common + only_a:]])
    if not 100 * common >= 80 * len(pool) or not len(a) or not len(b):
        return
    row, sig, failed = partenum.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), frozenset())
    shared = set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())
    by_band = {t: sum(1 for s in shared if s & 31 == t) for t in {s & 31 for s in shared}}
    assert failed or max(by_band.values(), default=0) >= 1 + max(len(a), len(b)) // 20 or len(shared) >= 1 + min(len(a), len(b)) // 20


# ---- op7, op9

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700))
def test_packed_blocks_come_back(values):
    a = np.array(values, np.uint32)
    raw = pfor.pack(a)
    assert pfor.packed_size(memoryview(raw)) == len(raw)
    assert (pfor.unpack(raw) == a).all()
    for i in range(-(-len(a) // pfor.BLOCK)):
        assert (pfor.unpack(raw, i, i + 1) == a[i * pfor.BLOCK: (i + 1) * pfor.BLOCK]).all()


@pytest.mark.parametrize("which,size", [("odd", 4_000_000), ("sf", 4_000_000), ("sf", 5000)])
def test_id_files_equal_the_library(spark, tables, queries, library, monkeypatch, which, size):
    monkeypatch.setattr(pfor, "FILE_TOKENS", size)
    folder, rows = (tables[0], odd_rows()) if which == "odd" else (SF, sf_rows(spark))
    got = queries["op7_pfor_ids"](spark, folder).orderBy("start").collect()
    ids = {}
    for d, t in rows:
        x = [*library.encode(t or "", add_special_tokens=False).ids, pfor.END_ID]
        ids.setdefault(d, []).append((len(x), pfor.crc(x)))
    start = 0
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in ids[r.doc_id]
        ids[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert not any(ids.values())
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


@pytest.mark.parametrize("which,block", [("odd", 4 << 20), ("sf", 64), ("sf", 4096)])
def test_separator_scan_equals_the_library(spark, tables, queries, library, monkeypatch, which, block):
    monkeypatch.setattr(separators.scan, "__defaults__", (block,))
    library.encode_special_tokens = True
    folder, rows = (tables[0], odd_rows()) if which == "odd" else (SF, sf_rows(spark))
    want = [(d, len(library.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in rows]
    library.encode_special_tokens = False
    out = queries["op9_token_counts"](spark, folder)
    same(rows_of(out, "doc_id", "n_tokens"), want)
    for shard in {r.shard for r in out.collect()}:
        at = 0
        for r in out.where(F.col("shard") == shard).orderBy("ordinal").collect():
            assert r.start == at
            at += r.n_tokens


def test_separator_scan_reports_what_follows_the_last_end(spark, tmp_path):
    ids = np.array([5, 6, 9, 9, 7, 7, 7], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    files = spark.createDataFrame([("a.bin", 14, 2)], "file string, bytes long, item int")
    for block in (2, 4, 8, 100):
        got = sorted(tuple(r) for r in separators.scan(files, str(tmp_path), 9, block).select("ordinal", "start", "n_tokens", "ended").collect())
        assert got == [(0, 0, 3, True), (1, 3, 1, True), (2, 4, 3, False)]


# ---- op8

def test_archives_of_awkward_pages(spark, tables, queries, monkeypatch):
    monkeypatch.setattr(warc.write_warc, "__defaults__", (600, warc.REVISIT_BYTES, 3000))  # several files
    pages = rows_of(spark.read.parquet(f"{tables[0]}/pages.parquet"), "page_id", "html")
    got = rows_of(queries["op8_warc"](spark, tables[0]), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want, first = [], set()
    for p, h in sorted(pages, key=lambda x: (x[0] is None, x[0] or 0)):
        raw = (h or "").encode()
        top = max((q for q, g in pages if g == h and q is not None), default=None)
        head = len(raw) < 1000 or (p == top and (p, h) not in first)
        first.add((p, h))
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "response" if head else "revisit", None if head else top))
    same(got, want)
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tables[0]}/pages.parquet/*.parquet')")
    same(con.sql(warc.OP8_SQL).fetchall(), want)


def test_archives_do_not_depend_on_the_input_s_partitions(spark, tmp_path):
    """Many more pages than a sample would hold, in ids of uneven density, dealt in two ways."""
    ids = F.expr("IF(id % 3 = 0, id, IF(id % 3 = 1, 9000000000000000000 - id * id, -id * 1000003))")
    pages = spark.range(60_000).select(ids.alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("html"))
    sums = []
    for run, parts in (("a", 3), ("b", 17)):
        got = warc.write_warc(pages.repartition(parts), f"file://{tmp_path}/{run}", 200_000, range_bytes=3_000_000)
        sums.append(sorted((r.file, r.n_records, r.sha256) for r in got.collect()))
    assert sums[0] == sums[1] and len(sums[0]) > 20 and sum(n for _, n, _ in sums[0]) == 60_000


def test_key_ranges_hold_about_the_limit(spark):
    rows = spark.createDataFrame([(i if i % 2 else 2**62 + i, 10) for i in range(3000)] + [(7, 5000), (None, 99), (-2**63, 1), (2**63 - 1, 1)], "k long, w long")
    firsts = C.key_ranges(rows, "k", "w", 1000)
    assert firsts == sorted(firsts) and firsts == C.key_ranges(rows.repartition(5), "k", "w", 1000)
    sums = {r.part: (r.s, r.n) for r in C.range_number(rows, "k", firsts, "part").groupBy("part").agg(F.sum("w").alias("s"), F.countDistinct("k").alias("n")).collect()}
    assert all(s <= 1000 or n == 1 or part == 0 for part, (s, n) in sums.items()) and len(sums) > 25
    assert C.key_ranges(rows.where("k IS NULL"), "k", "w", 10) == []


def test_archives_are_the_same_bytes_each_time(spark, tables, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    sums = []
    for run in ("a", "b"):
        folder = f"file://{tmp_path}/{run}"
        sums.append(sorted((r.file, r.sha256) for r in warc.write_warc(pages, folder, 40_000).collect()))
        names = sorted(p.name for p in (tmp_path / run).iterdir())
        assert names == [f for f, _ in sums[-1]]  # no temporary file is left
    assert sums[0] == sums[1] and len(sums[0]) > 1


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string")
    manifest = warc.write_warc(pages, str(tmp_path)).persist()
    (name,) = [r.file for r in manifest.collect()]
    (tmp_path / name).write_bytes((tmp_path / name).read_bytes()[:-3] + b"abc")
    with pytest.raises(Exception, match="differs from its manifest"):
        warc.read_warc(manifest, str(tmp_path)).collect()
    manifest.unpersist()


def test_other_tools_can_read_the_archives(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame([(1, "http://a/", "é" * 700), (2, "http://b/", "é" * 700)], "page_id bigint, url string, html string")
    (r,) = warc.write_warc(pages, str(tmp_path)).collect()
    text = gzip.decompress((tmp_path / r.file).read_bytes()).decode()
    assert text.count("WARC/1.1\r\n") == 3 and "WARC-Type: revisit" in text and text.count("é" * 700) == 1


# ---- op10

def test_winnowing_equals_brute_force(spark, tables, queries, monkeypatch):
    from tidemark.llm import decontaminate

    items = rows_of(spark.read.parquet(f"{tables[0]}/benchmark.parquet"), "item_id", "text")
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.contaminated(odd_rows(), items)
    same(rows_of(queries["op10_winnowing"](spark, tables[0]), *cols), want)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)  # the shuffled form
    same(rows_of(queries["op10_winnowing"](spark, tables[0]), *cols), want)


def test_winnowing_of_long_items(spark, queries, tmp_path, monkeypatch):
    """A fingerprint's row does not grow with its item, and bytes count as well as rows."""
    import random

    from tidemark.llm import decontaminate

    rnd = random.Random(4)
    w = rnd.choices([f"w{i}" for i in range(900)], k=3000) + ["loop"] * 40 + [f"t{i}" for i in range(14)]
    items = [(1, " ".join(w)), (2, " ".join(w[:10])), (3, " ".join(w[-11:])), (4, "one two"), (5, " ".join(w[500:800] + w[100:130]))]
    cuts = [(0, 10), (0, 9), (1, 11), (700, 760), (2990, 3054), (3035, 3054), (3044, 3054), (3045, 3054), (3, 3000)]
    rows = [(i, " ".join(["x", *w[a:b], "y", *w[a + 2: b]])) for i, (a, b) in enumerate(cuts)] + [(90, " ".join(w)), (91, "one two"), (92, "loop " * 12)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sizes = decontaminate.item_prints(spark.read.parquet(f"{tmp_path}/benchmark.parquet")).select(F.max(F.size("iw"))).first()[0]
    assert sizes == 2 * decontaminate.WINDOW - decontaminate.GRAM
    cols, want = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"), brute.contaminated(rows, items)

    def broadcast(df):
        return "BroadcastHashJoin [fp" in df._jdf.queryExecution().sparkPlan().toString()

    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, is_broadcast in ((decontaminate.BROADCAST_BYTES, True), (0, False)):
            monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
            got = queries["op10_winnowing"](spark, str(tmp_path))
            assert broadcast(got) == is_broadcast
            same(rows_of(got, *cols), want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


# ---- shared kernels

@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=12))
def test_words_are_those_of_the_pattern(texts):
    import pyarrow as pa

    buf, off = C.text_buffers(pa.array(texts, pa.string()))
    start, end, first = C.word_spans(buf, off)
    got = [[bytes(buf[a:b]) for a, b in zip(start[i:j], end[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
    assert got == [brute.SPACED.findall((t or "").encode()) for t in texts]
    h = C.word_hashes(buf, start, end)
    flat = [w for ws in got for w in ws]
    assert len(set(h.tolist())) == len(set(flat))
