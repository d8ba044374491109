"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Take two words that one inserted, deleted or replaced code point parts; let ``length`` be that of
the longer one (of either, for a replacement). The longer word is cut into two disjoint chunks that
cover it. The edit lies in one of them, so the other chunk is a positional gram of the other word:
the first chunk at its own place, the second at its own place or, behind a deletion, one place to
the left. Hence each word sends its chunks under its own length, and its positional grams under its
own length and the next; of all its grams only those are sent that can meet a chunk within shift
one, the gram at the front and the gram at the end. Equal keys (length, place, hash of the chunk)
make a group; inside, every word whose length is the key's is compared with the others.

A common chunk would make a large group ("tion" ends thousands of words) and a group's pairs grow
with its square. So a group of more than ``GROUP`` words is not compared but dealt out again: what
the chunk does not cover is cut into two chunks the same way, and the key then holds both. That
repeats until a group is small or one code point is left open, when every pair in it is near. So
candidates grow with the words and nothing is capped.

A pair's first difference lies in exactly one part of every such cut; a pair is taken from the group
whose open part holds it, so each comes up once, and is verified by its edit distance.

Defined results: null and empty texts have no words; rows of one doc_id are rows of their own; a
null doc_id counts as empty text in the hash that damages words; equal words of any number of rows
are one word. Columns other than doc_id and text are not read, whatever their names. A run may be
of any length. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.session import write_table

LEAST = 7  # code points of a word
TIMES = 2  # occurrences of a word
FACTOR = 10  # how much more often a word's form occurs
DAMAGED = 31  # one run in so many, by its hash, loses a code point
GROUP = 64  # words of a group that are compared with each other
HELD = 100_000  # words that a task counts before it passes them on
LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8
# A-Z, a-z, and both bytes of U+00C0 to U+00FF are no gaps once the second byte is set to the first
GAPS = np.ones(256, bool)
GAPS[[*range(65, 91), *range(97, 123), LEAD]] = False


def runs_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, code points, index of each row's first) of the runs of letters in UTF-8 texts."""
    flat = buf.copy()
    flat[1:][buf[:-1] == LEAD] = LEAD
    start, end, first = C.word_spans(flat, off, GAPS)
    leads = np.concatenate([[0], np.cumsum(buf == LEAD)])
    return start, end, end - start - (leads[end] - leads[start]), first


def damaged(run: bytes, crc: int) -> bytes:
    """``run`` without the code point that its hash names, if the hash damages it."""
    if crc % DAMAGED:
        return run
    text = run.decode()
    at = crc % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, n): how often each word of at least ``least`` code points occurs in the texts. A task
    counts its words before it passes them on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.record_batch({"word": pa.array(list(held), pa.binary()).cast(pa.string()), "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return made

        for b in batches:
            ids = b.column(0).to_pylist()
            buf, off = C.text_buffers(b.column(1))
            for i, j in C.pieces(off):
                part = C.LOWER[buf[off[i]: off[j]]]
                start, end, size, first = runs_of(part, off[i: j + 1] - off[i])
                data = part.tobytes()
                keep = np.flatnonzero(size >= least)
                bounds = np.searchsorted(keep, first).tolist()
                spans = list(zip(start[keep].tolist(), end[keep].tolist(), strict=True))
                for k in range(j - i):
                    runs = Counter([data[x:y] for x, y in spans[bounds[k]: bounds[k + 1]]])
                    seed = zlib.crc32(f"{'' if ids[i + k] is None else ids[i + k]}:".encode())
                    for run, n in runs.items():
                        crc = zlib.crc32(run, seed)
                        if crc % DAMAGED:
                            held[run] += n
                        elif len((word := damaged(run, crc)).decode()) >= least:
                            held[word] += n
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    return docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def cut(rows: DataFrame) -> DataFrame:
    """Members of groups, with the part of the word from ``s`` to ``e`` open, under both chunks of
    that part. ``s`` and ``e`` are places in the longer word of a pair, ``size`` code points long;
    a word with ``shorter`` 1 stands for pairs with a word of one more."""
    q = "(e - s) DIV 2"
    parts = f"filter(array(struct(s + {q} AS s, e), struct(s, s + {q} AS e)), x -> x.e > x.s)"
    rows = rows.withColumn("p", F.explode(F.expr(parts))).select("word", "n", "size", "shorter", "p.s", "p.e")
    behind = "substring(word, e - shorter + 1, size - e)"
    return rows.withColumn("key", F.expr(f"xxhash64(size, s, e, substring(word, 1, s), {behind})"))


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(u, un, v, vn): every unordered pair of words one edit apart, once, with their counts. ``words``
    (word, n) holds each word once."""
    both = words.withColumn("shorter", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = cut(both.withColumn("size", F.char_length("word") + F.col("shorter")).withColumn("s", F.lit(0)).withColumn("e", F.col("size")))
    found = None
    while True:
        rows = write_table(rows, "chunks")
        sizes = rows.groupBy("key").agg(F.sum(1 - F.col("shorter")).alias("own"), F.count("*").alias("members")).where("own > 0 AND members > 1")
        level = write_table(rows.join(sizes.select("key", "members"), "key"), "chunk-groups")
        small = level.where(f"members <= {group} OR e - s = 1")
        a = small.where("shorter = 0").select("key", "e", F.col("word").alias("u"), F.col("n").alias("un"))
        b = small.select("key", "shorter", F.col("word").alias("v"), F.col("n").alias("vn"))
        # equal up to the open part by the key; the first difference has to lie inside it
        near = (a.join(b, "key").where("(shorter = 1 OR u < v) AND left(u, e) <> left(v, e) AND levenshtein(u, v, 1) = 1")
                .select("u", "un", "v", "vn"))
        found = near if found is None else found.unionByName(near)
        large = level.where(f"members > {group} AND e - s > 1")
        if large.isEmpty():
            return found
        rows = cut(large.drop("key", "members"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from each word that has one, by pointer doubling. A
    form occurs more often than its word, so chains end, after the logarithm of the largest count."""
    now = write_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = write_table(now.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "roots")
        if now.where("more").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of ``words`` (word, n): the most frequent word one
    edit apart if it occurs at least ``factor`` times as often, and the end of that chain."""
    pairs = near_pairs(words)
    sides = F.explode(F.expr("array(struct(u AS word, un AS n, v AS other, vn AS m), struct(v AS word, vn AS n, u AS other, un AS m))"))
    near = pairs.select(sides.alias("x")).select("x.*").groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    near = write_table(near.select("word", "n_near", F.expr(f"IF(-best.m >= {factor} * n, best.other, NULL)").alias("form"),
                                   F.expr(f"IF(-best.m >= {factor} * n, -best.m, NULL)").alias("form_n")), "near-words")
    roots = last_forms(near.where("form IS NOT NULL"))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling_variants(write_table(counts.where(F.col("n") >= TIMES), "words"))


OP11_SQL = rf"""
WITH RECURSIVE runs AS (
         SELECT doc_id, run, count(*) AS times FROM (
             SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[a-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY 1, 2),
     keyed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS raw FROM runs),
     {C.crc32_sql("run, times")},
     res AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
     w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM res WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
     gap AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
             FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
     near AS (SELECT x.word, x.n, y.word AS other, y.n AS m FROM gap x JOIN gap y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
              UNION SELECT gap.word, gap.n, w.word, w.n FROM gap JOIN w ON w.word = a || b
              UNION SELECT w.word, w.n, gap.word, gap.n FROM gap JOIN w ON w.word = a || b),
     best AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
                     row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place FROM near),
     formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
                FROM w LEFT JOIN best ON best.word = w.word AND place = 1),
     chain AS (SELECT word, word AS root FROM formed UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = root WHERE form IS NOT NULL),
     ends AS (SELECT chain.word, root FROM chain JOIN formed ON formed.word = root WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""
