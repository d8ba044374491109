"""Small tables with every awkward case, and helpers that compare frames with brute force."""

from __future__ import annotations

import random
import zlib

import pytest

SF = "/root/testdata/sf0.001"


def odd_documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty texts, ties, repeats, long texts, other
    scripts, separators of all kinds."""
    rnd = random.Random(5)
    vocab = ["the", "of", "and", "der", "la"] + [f"w{i}x" for i in range(400)]
    base = [" ".join(rnd.choices(vocab, k=90)) for _ in range(8)]
    passage = " ".join(rnd.choices(vocab, k=60))
    texts = [
        None, "", " \t\n\r\x0b\x0c ", "one", "one two three four", "A B C D E", "a b c d e",
        base[0], base[0], base[0].upper(), base[1], base[1].replace("w1", "q1", 1),
        base[2] + " " + passage + " " + base[3], base[4] + "\n" + passage, passage + " tail",
        "loop " * 300, "loop " * 40 + "end", "ab " * 36, "\xa0nbsp em​zero é é İSTANBUL ΣΑΣ ﬁ ½ 日本語 😀" * 3,
        "x" * 5000, "<|endoftext|> mid <|startoftext|> 'S 'LL don't \"\"", "\x00nul\x1c\x1f\x85 sep", " ".join(rnd.choices(vocab, k=12_000)),
    ]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(7, base[0], "en", "s1", len(base[0])), (7, base[5], None, None, None), (None, base[6], "en", "s1", 5), (None, base[6], "en", "s1", 5),
             (None, None, None, None, None), (2**61 + 1, base[7], "fr", "s2", 1), (-5, base[7][:300], "de", "s0", None)]
    return rows


def odd_conversations() -> list[tuple]:
    """(conv_id, turn, role, text): nulls everywhere, gaps, ties, strange roles, all turns dropped, a long one."""
    rnd = random.Random(9)
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "tool", "User", "", None, "unknown"]), rnd.choice(["Yes.", "No", "", " ", None, "Why?\n", "ok!\t", "a.b", "é…"]))
            for c in range(60) for t in rnd.sample(range(12), rnd.randrange(1, 9))]
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (None, 4, "assistant", "Hm."), (900, None, "user", "A."), (900, None, "user", "A."), (900, 2, "user", "B.")]
    rows += [(901, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(120)] + [(902, 5, "user", "x."), (902, 5, "assistant", "y."), (2**60, -4, "user", "x" * 9000)]
    gone = next(c for c in range(1000, 3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "Dropped.")]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """The awkward documents, with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_documents(), SCHEMA).repartition(4)
    for name in ("id", "n", "block", "bucket", "h", "tk", "kept", "n_words", "sig", "score", "ids", "spans"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory, odd, none):
    """Two folders with all tables: the awkward one, and one of empty tables."""
    from pyspark.sql import functions as F

    out = []
    for name, docs in (("odd", odd), ("empty", none)):
        d = str(tmp_path_factory.mktemp(name))
        docs.write.parquet(f"{d}/documents.parquet")
        pages = [(1, "http://a/", "x" * 1500), (2, None, "x" * 1500), (3, "http://c/ d\r\n", "x" * 1500), (3, "u", "x" * 1500), (4, "u", None),
                 (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", "x" * 1500), (8, "u", "é" * 600), (9, "u", "é" * 600)]
        spark.createDataFrame(pages if name == "odd" else [], "page_id bigint, url string, html string").withColumn("digest", F.lit(1)) \
            .write.parquet(f"{d}/pages.parquet")
        texts = [r[1] for r in odd_documents()]
        items = [(1, texts[7][:200]), (1, texts[10][:150]), (2, "one two three four"), (3, None), (4, "..."), (None, " ".join(texts[22].split()[100:130])),
                 (10, texts[7].split(" ", 3)[3])]
        spark.createDataFrame(items if name == "odd" else [], "item_id bigint, text string").withColumn("words", F.lit(0)) \
            .write.parquet(f"{d}/benchmark.parquet")
        spark.createDataFrame(odd_conversations() if name == "odd" else [], "conv_id bigint, turn bigint, role string, text string") \
            .withColumn("code", F.lit(0)).withColumn("audit", F.lit("own")).write.parquet(f"{d}/conversations.parquet")
        labels = [(i, i % 2, 0) for i in range(20)] + [(7, 0, 0), (None, 1, 0), (3, None, 0), (4, 9, 0)]
        spark.createDataFrame(labels if name == "odd" else [], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        out.append(d)
    return tuple(out)


@pytest.fixture(scope="session")
def queries():
    from tidemark.llm.queries import queries

    return queries()
