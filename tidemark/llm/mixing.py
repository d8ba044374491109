"""Mixing sources to target weights, by pivotal dependent rounding.

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the words of all
documents; a target stops at ``MOST`` times its source's size, and what it leaves is shared again by
weight until none is above. That is target = min(MOST * size, level * weight) for one level, which
a few sums over the table of sources find.

A document of a source is wanted target / source size times: some whole copies and a fraction. The
fractions are rounded by the pivotal method, in words: of two open documents, a random one gives the
other as many words as one of them needs to become whole (none or one copy more), with the odds
that keep both expectations. So each step settles a document and keeps the source's words. Documents
are dealt by their hash to blocks of about ``BLOCK`` of one source, each block settles all but one,
and those residuals meet in a tree of ``FAN`` blocks a node until a source has one left, which is
rounded to the nearest. A source thus misses its target by half a document at most. In a block large
documents come first, so that what stays open at the end is small.

Rows of one (source, doc_id, text) are one item of several copies, which are dealt evenly to the
rows: so repeated rows make no large block, and a document has its ``MOST`` copies at most. Every
random number is a hash of the two items, so that a rerun, on any partitioning, gives the same mix.

Defined results: a null or wordless text has size 0 and is taken 0 times; null sources are one source
of their own; documents with null ids are items by their text. Columns other than doc_id, text and
source are not read, whatever their names; a text of any length is one size. An empty table gives
no rows.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.operators.ordinal import with_ordinal
from tidemark.session import write_table

WEIGHTS = (5, 2, 1)
MOST = 3  # copies of a document, and target of a source over its size
BLOCK = 8192  # items that one task settles at a time
FAN = 32  # blocks whose residuals meet
KNOWN_SOURCES = 100_000  # up to so many sources are broadcast to the items
_WORD = r"[^\x20\x09-\x0D]+"
_MASK = (1 << 64) - 1
_STEP = 1 << 16  # rows that one array makes


def items_of(docs: DataFrame) -> DataFrame:
    """(source, doc_id, tk, size, rows): documents by source, id and hash of their text, with their
    number of words and of rows. Texts are read once and not shuffled."""
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    return docs.select("source", "doc_id", F.xxhash64("text").alias("tk"), size.alias("size")).groupBy("source", "doc_id", "tk", "size") \
        .agg(F.count("*").alias("rows"))


def source_targets(items: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, items, weight, target) per source. The shares are found by sums over this
    table, one row a source; only sums reach the driver."""
    sources = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("items"))
    sources = with_ordinal(sources.withColumn("last", F.col("source").isNull()), ["last", "source"], out="rank").drop("last")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    sources = write_table(sources.withColumn("weight", w), "sources")
    level, capped = 0.0, -1
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while True:  # a source that the level passes stays passed: the level only rises
        over = F.col("source_size") * most <= F.col("weight") * level
        r = sources.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, F.col("source_size") * most)).alias("full"),
                        F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if r["n"] == capped or not r["weight"]:
            break
        capped, level = r["n"], (total - (r["full"] or 0)) / r["weight"]
    target = F.least((F.col("source_size") * most).cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.withColumn("target", target)


def _uniform(a: int, b: int) -> float:
    """A number from 0 to 1 by the hashes of two items."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & _MASK
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _MASK
    return ((x ^ x >> 31) >> 11) / (1 << 53)


def pivotal(sizes: list[int], parts: list[float], hashes: list[int]) -> tuple[list[float], int | None]:
    """The fractions ``parts`` rounded to 0 or 1 one after another, and the index of the item that is
    still open, if any. The sum of size times fraction stays as it is."""
    p, held = list(parts), None
    for i, q in enumerate(p):
        if q <= 0.0 or q >= 1.0:
            continue
        if held is None:
            held = i
            continue
        a, b, f = sizes[held], sizes[i], p[held]
        up, down = min((1 - f) * a, q * b), min(f * a, (1 - q) * b)  # words that the held item can gain and lose
        if _uniform(hashes[held], hashes[i]) * (up + down) < down:
            p[held], p[i] = (1.0 if up == (1 - f) * a else f + up / a), (0.0 if up == q * b else q - up / b)
        else:
            p[held], p[i] = (0.0 if down == f * a else f - down / a), (1.0 if down == (1 - q) * b else q + down / b)
        for k in (held, i):  # what is left of a fraction by rounding errors is none
            p[k] = float(round(p[k])) if abs(p[k] - round(p[k])) < 1e-12 else p[k]
        held = next((k for k in (held, i) if 0.0 < p[k] < 1.0), None)
    return p, held


def settled(rows: DataFrame, last: bool) -> DataFrame:
    """One level of the tree: in each group of (rank, block) all open items but one are settled; in the
    last level that one as well."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("size", "descending"), ("h", "ascending"), ("doc_id", "ascending"), ("tk", "ascending")])
        sizes, hashes = t.column("size").to_pylist(), t.column("h").to_pylist()
        p, held = pivotal(sizes, t.column("part").to_pylist(), hashes)
        if last and held is not None:
            p[held] = float(p[held] >= 0.5)
        return t.set_column(t.schema.get_field_index("part"), "part", pa.array(p, pa.float64()))

    return rows.groupBy("rank", "block").applyInArrow(run, rows.schema)


def mix_items(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(source, doc_id, tk, size, rows, source_size, target, copies) per item: ``copies`` of all its rows
    together. ``docs`` has doc_id, text and source."""
    items = write_table(items_of(docs), "mix-items")
    sources = source_targets(items, weights, most)
    few = sources.limit(KNOWN_SOURCES + 1).count() <= KNOWN_SOURCES
    info = sources.select(F.col("source").alias("of"), "rank", "source_size", "target", F.expr(f"CAST((items - 1) DIV {block} + 1 AS INT)").alias("blocks"))
    rows = items.join(F.broadcast(info) if few else info, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    wanted = F.when(F.col("size") > 0, F.col("target") * F.col("rows") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("whole", F.floor(wanted)).withColumn("part", wanted - F.floor(wanted))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "tk", "size")).withColumn("block", F.pmod("h", "blocks").cast("int"))
    widest = sources.agg(F.max("items")).first()[0]
    levels = 1 + max(0, math.ceil(math.log(max(1, -(-(widest or 1) // block)), FAN) - 1e-9))
    done, now = rows.where("part = 0"), rows.where("part > 0")
    for k in range(levels):
        now = write_table(settled(now, k == levels - 1), "mix-level")
        done = done.unionByName(now.where("part = 0 OR part = 1"))
        now = now.where("part > 0 AND part < 1").withColumn("block", F.expr(f"block DIV {FAN}"))
    return done.select("source", "doc_id", "tk", "size", "rows", "source_size", "target", (F.col("whole") + F.col("part").cast("long")).alias("copies"))


def _times(n: str, name: str) -> list:
    """Two generators, one after another, that make ``n`` rows with arrays of a bounded length."""
    return [F.explode(F.expr(f"sequence(0, ({n} - 1) DIV {_STEP})")).alias("__run"),
            F.explode(F.expr(f"sequence(__run * {_STEP}, least({n}, (__run + 1) * {_STEP}) - 1)")).alias(name)]


def each_row(items: DataFrame) -> DataFrame:
    """``items`` with one row per document row and its own ``copies``: an item's copies dealt evenly."""
    parts = F.explode(F.expr("filter(array(struct(copies DIV rows + 1 AS copies, copies % rows AS rows),"
                             " struct(copies DIV rows AS copies, rows - copies % rows AS rows)), x -> x.rows > 0)"))
    cols = [c for c in items.columns if c not in ("copies", "rows")]
    dealt = items.select(*cols, parts.alias("p")).select(*cols, "p.copies", F.col("p.rows").alias("__rows"))
    runs, each = _times("__rows", "__row")
    return dealt.select("*", runs).select("*", each).drop("__rows", "__run", "__row")


def mixed_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each item's text as many times as its copies."""
    name = "__mix"
    while name in docs.columns:
        name += "_"
    wanted = items.where("copies > 0").select(F.struct("source", "doc_id", "tk").alias(name), "copies")
    key = F.struct("source", "doc_id", F.xxhash64("text").alias("tk"))
    first = docs.withColumn(name, key).dropDuplicates([name])
    got = first.join(wanted.withColumnRenamed("copies", f"{name}n"), first[name].eqNullSafe(wanted[name])).drop(wanted[name])
    runs, each = _times(f"`{name}n`", f"{name}i")
    return got.select(*(F.col(f"`{c}`") for c in [*docs.columns, f"{name}n"]), runs).select("*", each).select(*(F.col(f"`{c}`") for c in docs.columns))


def op13_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = mix_items(C.table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return each_row(items).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")
