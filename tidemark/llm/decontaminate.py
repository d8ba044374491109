"""Benchmark decontamination by winnowing, in DataFrame expressions only.

A text's words are hashed in runs of ``GRAM``; of every ``WINDOW - GRAM + 1`` neighbouring runs the
smallest hash is a fingerprint. Two texts that share ``WINDOW`` words share a fingerprint, wherever
the span begins. Document fingerprints are joined with benchmark fingerprints, and each meeting is
extended: every window of the item around the shared run is compared with the document's words, so
that hash collisions add nothing. A meeting names the place of the run and looks at the words around
it only, so a text costs its words, however much of it is benchmark. An item shorter than ``WINDOW`` is one window of its own length,
whose only run is the whole item.

A fingerprint carries the item's words around its run, at most ``2 * WINDOW - GRAM``, and not the
item, so that its size does not grow with the item. The benchmark's fingerprints are broadcast while
their number is at most ``BROADCAST_ROWS`` and their bytes at most ``BROADCAST_BYTES`` (both counted
first, as words may be long); beyond that both sides are shuffled. Hits are gathered per distinct
text, already merged in each task, so that copies of a text cost one group.

Defined results: null text has no words. Rows with equal doc_id are rows of their own. An item
without an id counts under the empty name; items of one id count once. Texts of any length take time in
proportion to their words. Columns other than doc_id (or item_id) and text are not read, whatever
their names; an empty table of documents gives no rows, one of items no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.session import write_table

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 128 << 20
# characters one by one: a class of single ones is looked up in a table, one of ranges asks each range
_APART = "".join(f"\\x{c:02X}" for c in (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)))
_CAPITALS = "".join(f"\\x{c:02X}" for c in range(0x41, 0x5B))
_GAP = f"[{_APART}{_CAPITALS}]+"  # what separates words, after lower-casing
_WORD = f"[^{_APART}]+"  # a word before lower-casing
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(col: str) -> Column:
    """A-Z in lower case, all else unchanged. ``lower`` does that for pure ASCII, much faster."""
    c = F.col(col)
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def words_of(col: str) -> Column:
    return F.array_remove(F.split(F.coalesce(lower_ascii(col), F.lit("")), _GAP), "")


def _grams(words: str, k: int, tag: int) -> str:
    run = ", ".join(f"get({words}, i + {j})" for j in range(k))
    return f"IF(size({words}) < {k}, array(), transform(sequence(0, size({words}) - {k}), i -> xxhash64({tag}, {run})))"


RUNS = WINDOW - GRAM + 1  # runs in a window


def _mins(grams: str) -> str:
    run = ", ".join(f"get({grams}, i + {j})" for j in range(RUNS))
    return f"IF(size({grams}) < {RUNS}, CAST(array() AS ARRAY<BIGINT>), transform(sequence(0, size({grams}) - {RUNS}), i -> least({run})))"


def item_prints(items: DataFrame) -> DataFrame:
    """(fp, item, win, q, iw): the fingerprints of every item, with the item's window length, the
    item's words that windows with the run can hold, and the run's position among these."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of("text").alias("iw")) \
        .where("size(iw) > 0").distinct().withColumn("win", F.least(F.size("iw"), F.lit(WINDOW)))
    # by single elements, as a slice copies its whole array: linear in the item's length
    before = WINDOW - GRAM
    least = f"get(g, i) IN ({', '.join(f'get(mins, i - {j})' for j in range(RUNS))})"
    around = f"filter(array({', '.join(f'get(iw, i + {j})' for j in range(-before, WINDOW))}), x -> x IS NOT NULL)"
    prints = (f"transform(filter(sequence(0, size(g) - 1), i -> {least}),"
              f" i -> struct(get(g, i) AS fp, least(i, {before}) AS q, {around} AS iw))")
    long = words.where(f"win = {WINDOW}").withColumn("g", F.expr(_grams("iw", GRAM, WINDOW))).withColumn("mins", F.expr(_mins("g"))) \
        .select("item", "win", F.explode(F.expr(prints)).alias("p")).select("p.fp", "item", "win", "p.q", "p.iw").distinct()
    # a hash leaves nulls out: what lies beyond the item's last word adds nothing
    run = ", ".join(f"get(iw, {j})" for j in range(WINDOW - 1))
    short = words.where(f"win < {WINDOW}").select(F.expr(f"xxhash64(win, {run})").alias("fp"), "item", "win", F.lit(0).alias("q"), "iw")
    return long.unionByName(short)


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(tk, item, start, win): every place where a window of an item occurs in a document's text,
    ``tk`` being the md5 of the text and ``start`` a word position. Distinct within each task at
    least."""
    prints = write_table(item_prints(items), "item-prints")
    # what a row holds besides the text of its words is about 16 bytes a word and 64 bytes
    row_bytes = F.sum(F.octet_length(F.array_join("iw", "")) + F.octet_length("item") + 16 * F.size("iw") + 64)
    sizes = {r.win: (r.n, r.b) for r in prints.groupBy("win").agg(F.count("*").alias("n"), row_bytes.alias("b")).collect()}  # at most WINDOW rows
    if not sizes:
        sizes = {WINDOW: (0, 0)}
    small = sum(n for n, _ in sizes.values()) <= BROADCAST_ROWS and sum(b for _, b in sizes.values()) <= BROADCAST_BYTES
    d = docs.select(F.md5(F.col("text").cast("binary")).alias("tk"), words_of("text").alias("w")).where(f"size(w) >= {min(sizes)}")
    d = d.withColumn("g", F.expr(_grams("w", GRAM, WINDOW) if WINDOW in sizes else "CAST(array() AS ARRAY<BIGINT>)"))
    # of every window one smallest run, the leftmost; a window that has the same one as the window before adds nothing
    picks = ("transform(filter(sequence(0, size(m) - 1), i -> i < size(m) AND (i = 0 OR get(m, i) <> get(m, i - 1) OR get(g, i - 1) = get(m, i))),"
             " i -> struct(get(m, i) AS fp, i AS at))")
    every = [f"IF(size(m) = 0, array(), {picks})"] if WINDOW in sizes else []
    every += [f"transform({_grams('w', n, n)}, (x, i) -> struct(x AS fp, i AS at))" for n in sorted(sizes) if n < WINDOW]
    d = d.withColumn("m", F.expr(_mins("g")))
    runs = F.explode(F.expr(f"concat({', '.join(every)})")).alias("x")
    if small:  # the words ride along: one stage explodes, joins and drops what met nothing
        met = d.select("tk", "w", "g", runs).select("tk", "w", "g", "x.fp", "x.at").join(F.broadcast(prints), "fp")
    else:  # only hashes are shuffled; the words of the texts that met something come back by key
        met = d.select("tk", runs).select("tk", "x.fp", "x.at").distinct().join(prints, "fp")
        met = d.dropDuplicates(["tk"]).select("tk", "w", "g").join(met, "tk")
    # where the run is, and the document's words that lie against the item's: by single elements, as other
    # array functions copy the whole text for each meeting
    near = ", ".join(f"get(g, at + {j})" for j in range(RUNS))
    met = met.withColumn("p", F.expr(f"IF(win = {WINDOW}, at + CAST(array_position(array({near}), fp) AS INT) - 1, at)"))
    met = met.withColumn("dw", F.expr("transform(iw, (x, j) -> get(w, p - q + j))")).select("tk", "item", "win", "p", "q", "iw", "dw")
    # windows of the item that hold the run
    around = f"sequence(greatest(0, q - IF(win = {WINDOW}, {WINDOW - GRAM}, 0)), least(q, size(iw) - win))"
    same = "slice(dw, s + 1, win) = slice(iw, s + 1, win)"
    starts = f"transform(filter({around}, s -> {same}), s -> p - q + s)"
    return met.select("tk", "item", "win", F.explode(F.expr(starts)).alias("start"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(tk, n_hit, items): per distinct text with a hit, the words inside any occurrence and the
    sorted ids of the items."""
    found = hits(docs, items).groupBy("tk").agg(F.collect_set(F.struct("start", "win")).alias("at"), F.collect_set("item").alias("items"))
    covered = "size(array_distinct(flatten(transform(at, x -> sequence(x.start, x.start + x.win - 1)))))"
    return found.select("tk", F.expr(covered).cast("long").alias("n_hit"), F.array_sort("items").alias("items"))


def text_key() -> Column:
    return F.md5(F.col("text").cast("binary"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark")
    found = contaminated(docs, items)
    rows = docs.select("doc_id", text_key().alias("tk"),
                       F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"))
    out = rows.join(found, "tk", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                      F.greatest(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


OP10_SQL = r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS rid FROM documents),
     it AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     win AS (SELECT DISTINCT item, len(w[s : s + 9]) AS l, array_to_string(w[s : s + 9], ' ') AS t
             FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM it WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT l FROM win),
     pos AS (SELECT rid, l, s, array_to_string(w[s : s + l - 1], ' ') AS t
             FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM low, sizes WHERE len(w) >= l)),
     hit AS (SELECT p.rid, p.s, p.l, item FROM pos p JOIN win USING (l, t)),
     cov AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(s, s + l)) AS x FROM hit) GROUP BY rid),
     ids AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN cov USING (rid) LEFT JOIN ids USING (rid)"""
