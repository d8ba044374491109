"""Spelling variants, conversation repair and the mix of sources against brute force, on awkward rows."""

from __future__ import annotations

import collections
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import SF, odd_conversations, odd_documents
from tests.llm.test_operators import odd_rows, rows_of, same, sf_rows
from tidemark.llm import mixing, repair, variants


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_structure_repair", "op13_pivotal_mix"])
def test_empty_tables_give_no_rows(spark, tables, queries, name):
    df = queries[name](spark, tables[1])
    assert df.collect() == [] and len(df.columns) >= 5


# ---- op11

VARIANTS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_of_awkward_texts_equal_brute_force(spark, tables, queries):
    same(rows_of(queries["op11_spelling_variants"](spark, tables[0]), *VARIANTS), brute.variants(brute.damaged_words(odd_rows())))


def test_word_counts_equal_brute_force(spark):
    counts = variants.word_counts(spark.read.parquet(f"{SF}/documents.parquet")).where("n > 1")
    same(rows_of(counts, "word", "n"), list(brute.damaged_words(sf_rows(spark)).items()))


@pytest.mark.parametrize("group", [64, 2, 1])
def test_variants_do_not_depend_on_the_size_of_groups(spark, group):
    """Small groups deal words out again by finer chunks, down to one open code point. Runs of one letter,
    shared fronts and ends, accents, edits at every place."""
    rnd = random.Random(6)
    base = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aabaaaa", "ababababab", "bababababa", "éééàààé", "prefixed", "prefixes", "ÀÀÀÀÀÀÀ"]
    base += ["".join(rnd.choices("abé", k=rnd.randrange(7, 12))) for _ in range(60)] + ["commonstem" + "".join(rnd.choices("xyz", k=4)) for _ in range(30)]
    words = {}
    for w in base:
        words[w] = rnd.choice([2, 3, 25, 400, 4000])
        for _ in range(3):
            i, c = rnd.randrange(len(w)), rnd.choice("abzÿ")
            v = rnd.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w + c])
            words.setdefault(v, rnd.choice([2, 20, 30]))
    words["x" * 3000] = 5
    words["x" * 1500 + "y" + "x" * 1500] = 50
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    same(rows_of(variants.near_pairs(df, group).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")), "a", "b"),
         [tuple(sorted((a, b))) for i, a in enumerate(words) for b in list(words)[:i] if brute.one_edit(a, b)])
    if group == 64:
        same(rows_of(variants.spelling_variants(df), *VARIANTS), brute.variants(words))


def test_long_chains_of_forms_end_at_the_root(spark):
    words = [("abcdefg"[:7] + "h" * k, 10**k * 2) for k in range(9)]
    got = variants.spelling_variants(spark.createDataFrame(words, "word string, n long"))
    assert {r.root for r in got.collect()} == {words[-1][0]}


# ---- op12

REPAIRS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_repairs_equal_brute_force(spark, tables, queries, which):
    folder = tables[0] if which == "odd" else SF
    rows = odd_conversations() if which == "odd" else rows_of(spark.read.parquet(f"{SF}/conversations.parquet"), "conv_id", "turn", "role", "text")
    same(rows_of(queries["op12_structure_repair"](spark, folder), *REPAIRS), brute.repairs(rows))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.sampled_from(["", "blank", "duplicate", "truncated"])), max_size=14))
def test_search_finds_the_cheapest_least_audit(rows):
    marks = ["", "blank", "duplicate", "truncated"]
    codes = bytes("suat".index(c) + 4 * marks.index(m) for c, m in rows)
    assert repair.search(codes) == brute.cheapest(tuple(c for c, _ in rows), tuple(m for _, m in rows))


def test_search_opens_few_nodes_in_long_conversations(monkeypatch):
    rnd = random.Random(2)
    codes = bytes(rnd.choices(range(16), k=20_000))
    opened = 0
    children = repair._children

    def counted(*args):
        nonlocal opened
        opened += 1
        return children(*args)

    monkeypatch.setattr(repair, "_children", counted)
    cost, audit = repair.search(codes)
    assert sum(e != "I" for e in audit) == len(codes) and opened < 30 * len(codes)


def test_repaired_rows_are_alternating_and_keep_texts(spark):
    rows = repair.damaged(spark.read.parquet(f"{SF}/conversations.parquet"))
    found = repair.audits(rows).persist()
    out = collections.defaultdict(list)
    for r in repair.repaired_rows(rows, found).collect():
        out[r.conv_id].append((r.place, r.role, r.text))
    for a in found.collect():
        got = sorted(out[a.conv_id])
        assert [p for p, _, _ in got] == list(range(len(got))) and len(got) == sum(e != "D" for e in a.audit)
        initials = "".join(role[0] for _, role, _ in got)
        rest = initials.removeprefix("s")
        assert rest == "ua" * (len(rest) // 2) and (not initials or rest)
    found.unpersist()


# ---- op13

def check_mix(got, sizes, slack=1.0):
    """Targets by the rule, whole copies up to three, each source within half its largest document."""
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    total = {s: sum(r.size for r in rows) for s, rows in by.items()}
    assert total == {s: x for s, x in sizes.items()}
    want = brute.targets(total)
    for s, rows in by.items():
        for r in rows:
            assert r.source_size == total[s] and r.target == pytest.approx(want[s])
            assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        assert abs(sum(r.taken for r in rows) - want[s]) <= slack * max(r.size for r in rows) / 2 + 1e-6


def words_in(t):
    return len(brute.SPACED.findall((t or "").encode()))


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_mix_meets_targets(spark, tables, queries, which):
    folder = tables[0] if which == "odd" else SF
    rows = [(r[1], r[3]) for r in odd_documents()] if which == "odd" else rows_of(spark.read.parquet(f"{SF}/documents.parquet"), "text", "source")
    sizes = collections.Counter()
    for t, s in rows:
        sizes[s] += words_in(t)
    got = queries["op13_pivotal_mix"](spark, folder).collect()
    assert sum(r.taken for r in got) > 0 and len(got) == len(rows)
    check_mix(got, sizes)


def mixed_input(spark, parts):
    rnd = random.Random(8)
    rows = [(i, "w " * rnd.choice([1, 3, 10, 40]), f"s{'ab'[i % 3 > 0]}") for i in range(900)]
    rows += [(7000, "copy " * 5, "sb")] * 400 + [(None, "x y", None)] * 3 + [(8000 + i, "a b", None) for i in range(60)] + [(9000, "tiny", "sz"), (9001, "", "sz")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)


@pytest.mark.parametrize("block,fan", [(8192, 32), (10, 2), (64, 4)])
def test_mix_by_blocks_and_tree(spark, monkeypatch, block, fan):
    """Many blocks and levels; repeated rows count as one item; any partitioning gives the same mix."""
    monkeypatch.setattr(mixing, "FAN", fan)
    runs = []
    for parts in (1, 7):
        docs = mixed_input(spark, parts)
        items = mixing.mix_items(docs, block=block)
        got = mixing.each_row(items).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")).collect()
        sizes = collections.Counter()
        for t, s in rows_of(docs, "text", "source"):
            sizes[s] += words_in(t)
        check_mix(got, sizes)
        copies = [r.copies for r in got if r.doc_id == 7000]
        assert len(copies) == 400 and max(copies) - min(copies) <= 1
        runs.append(sorted(map(repr, got)))
    assert runs[0] == runs[1]


def test_mixed_documents_repeat_texts_by_their_copies(spark):
    docs = mixed_input(spark, 3).withColumn("copies", F.lit("own")).withColumn("__mix", F.lit(1))
    items = mixing.mix_items(docs)
    out = mixing.mixed_documents(docs, items)
    assert out.columns == docs.columns
    got = collections.Counter((r.source, r.doc_id) for r in out.select("source", "doc_id").collect())
    assert got == {(r.source, r.doc_id): r.copies for r in items.groupBy("source", "doc_id").agg(F.sum("copies").alias("copies")).where("copies > 0").collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 500), st.floats(0.01, 0.99), st.integers(-2**63, 2**63 - 1)), max_size=40))
def test_pivotal_steps_keep_the_words(rows):
    sizes, parts, hashes = ([r[i] for r in rows] for i in range(3))
    out, held = mixing.pivotal(sizes, parts, hashes)
    assert sum(a * b for a, b in zip(sizes, out, strict=True)) == pytest.approx(sum(a * b for a, b in zip(sizes, parts, strict=True)), abs=1e-6)
    assert all(x in (0.0, 1.0) for i, x in enumerate(out) if i != held)


def test_pivotal_keeps_expectations():
    n, parts = 4000, [0.2, 0.7, 0.45, 0.9]
    sums = [0.0] * 4
    for k in range(n):
        out, _ = mixing.pivotal([50, 30, 20, 7], parts, [k * 7919 + i * 104729 for i in range(4)])
        sums = [a + b for a, b in zip(sums, out, strict=True)]
    assert all(abs(s / n - p) < 0.03 for s, p in zip(sums, parts, strict=True))
