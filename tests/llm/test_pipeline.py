"""The pipeline's stages: columns, decisions, awkward and empty tables, each against brute force."""

from __future__ import annotations

import pytest

import corpus_pipeline as P
from tests.llm import brute
from tests.llm.conftest import SF, odd_documents


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stages_keep_the_columns(spark, tables, odd):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, tables[0])
        assert [(c, t) for c, t in out.dtypes] == [(c, t) for c, t in docs.dtypes], name
        assert out.collect() is not None


@pytest.mark.parametrize("empty", [False, True])
def test_run(spark, tables, empty):
    rows = P.run(spark, tables[1] if empty else tables[0]).collect()
    assert (rows == []) == empty


def test_jaccard_stage_keeps_one_of_each_group(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    rows = [(r[0], r[1]) for r in odd_documents()]
    got = P.jaccard_join(spark, docs, tables[0]).select("doc_id", "text").collect()
    wordless = [x for x in rows if not brute.shingles(x[1])]
    assert sum(1 for r in got if not brute.shingles(r.text)) == len(wordless)
    sets = [brute.shingles(r.text) for r in got if brute.shingles(r.text)]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert 100 * len(a & b) < 80 * len(a | b)
    # every document is linked to a kept one, over links of dropped ones
    kept = {brute.shingles(r.text) for r in got}
    reached, more = set(kept), True
    every = {brute.shingles(t) for _, t in rows}
    while more:
        new = {a for a in every - reached if any(a and 100 * len(a & b) >= 80 * len(a | b) for b in reached)}
        reached |= new
        more = bool(new)
    assert reached >= every
    ids = {r.doc_id for r in got}
    assert {2**61 + 1, -5} <= ids and None not in {r.doc_id for r in got if r.text and r.text in (rows[7][1], rows[10][1])}


def test_jaccard_stage_takes_the_smallest_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted({c for _, _, c in brute.components(rows)})
    assert sorted(r.doc_id for r in P.jaccard_join(spark, docs, SF).select("doc_id").collect()) == want


def test_substring_stage_cuts_repeats_and_leaves_the_rest_untouched(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    rows = [(r[0], r[1]) for r in odd_documents()]
    out = P.substring_dedup(spark, docs, tables[0])
    want = []
    for (d, t), (_, n, gone, _) in zip(rows, brute.substrings(rows), strict=True):
        if not gone:
            want.append((d, t))
    got = texts(out)
    for x in want:
        assert x in got
    for r in out.select("text", "n_chars", "kept").collect():
        assert r.kept == "own kept"
        if r.text == "":
            assert r.n_chars == 0
    assert out.count() == len(rows)


def test_decontamination_stage_drops_hits_only(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables[0]}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r[0], r[1]) for r in odd_documents()]
    want = sorted((x for x, hit in zip(rows, brute.contaminated(rows, items), strict=True) if not hit[5]), key=repr)
    assert texts(P.decontamination(spark, docs, tables[0])) == want


def test_quality_stage_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in P.quality_classifier(spark, docs, sf).select("doc_id").collect()}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in good) / len(good) > 0.97
    assert sum(d in kept for d in bad) / len(bad) < 0.1


def test_last_stage_gives_the_librarys_ids(spark, tables):
    from tokenizers import Tokenizer

    from tidemark.llm import bpe

    import numpy as np

    tok = Tokenizer.from_file(bpe.tokenizer_path())
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    want = sorted((d, len(x := tok.encode(t or "", add_special_tokens=False).ids), np.array(x, "<u4").tobytes()) for d, t in
                  [(r[0], r[1]) for r in odd_documents()] if d is not None)
    got = P.bpe_codec(spark, docs, tables[0]).where("doc_id IS NOT NULL").collect()
    assert sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in got) == want
