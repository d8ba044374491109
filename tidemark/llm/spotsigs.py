"""SpotSigs document fingerprints, in DataFrame expressions only.

An anchor is a common word of the language (``ANCHORS``); its signature is the anchor with the next
``CHAIN`` content words, common words between them being skipped (at most ``REACH`` words are looked
at). A document's fingerprint is the set of its signatures, hashed to 32 bits. Boilerplate with few
common words gives few signatures, running text many.

Where no common word stands among the ``GAP`` words before it, a word is an anchor itself: so lists,
menus, other languages and the first words of a text have signatures from every word. The rule looks
at nearby words only, so an edit changes the signatures around it and no others, and two versions of
a text are always measured alike. Characters of scripts that are written without spaces are words of
their own.

Defined results: null text is empty text. A text with words but no signature (under ``CHAIN`` + 1
words) has one, the hash of its whole word sequence, so that equal texts are alike; a text without
words has none. Two empty fingerprints are alike (1.0), an empty and another one are not (0.0). "The
next document" follows the order (doc_id with nulls first, then the text's hash); the first follows
the last. Texts of any length take time in proportion to their words; columns other than doc_id and
text are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C

CHAIN = 2
LIKE = 0.8  # Jaccard similarity of near duplicates
REACH = 8
GAP = 16  # words without a common one after which every word is an anchor
RANGE_BYTES = 8 << 20  # text bytes in one range of ids, about
MOST_RANGES = 1 << 16

# fixed values: common words that carry no topic
ANCHORS = """
the a an of and to in is was that it for on with as by at be this are from or
le la les de des du un une et en est que qui dans pour
der die das und ist ein eine den dem des von zu mit auf nicht
el los las y del una por con para se
""".split()
_COMMON = ", ".join(f"'{w}'" for w in sorted(set(ANCHORS)))
_BETWEEN = r"[^\p{L}\p{N}]+"
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def spot_words(col: str) -> Column:
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    spaced = F.when(F.length(col) == F.octet_length(col), text).otherwise(F.regexp_replace(text, _UNSPACED, " $1 "))
    return F.array_remove(F.split(spaced, _BETWEEN), "")


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sorted set of signatures of ``text`` as ``out`` (array of int)."""
    words, at = f"__{out}_words", f"__{out}_at"
    df = df.withColumn(words, spot_words(text))
    df = df.withColumn(at, F.expr(f"filter(sequence(0, size({words}) - 1), i -> get({words}, i) IN ({_COMMON}))"))
    # bounds of the stretches between common words; before the text there is no common word within reach
    df = df.withColumn(at, F.expr(f"concat(array(-{GAP} - 1), {at}, array(size({words})))"))
    bare = (f"flatten(transform(filter(sequence(0, size({at}) - 2), k -> get({at}, k + 1) - get({at}, k) > {GAP} + 1),"
            f" k -> sequence(get({at}, k) + {GAP} + 1, get({at}, k + 1) - 1)))")
    # by single elements: a slice would copy the whole text for each anchor
    after = ", ".join(f"get({words}, i + {j})" for j in range(1, REACH + 1))
    chain = f"slice(filter(array({after}), x -> x IS NOT NULL AND x NOT IN ({_COMMON})), 1, {CHAIN})"
    spots = (f"filter(transform(concat(slice({at}, 2, size({at}) - 2), {bare}), i -> concat(array(get({words}, i)), {chain})),"
             f" s -> size(s) = {CHAIN + 1})")
    some = f"array_sort(array_distinct(transform({spots}, s -> hash(s))))"
    df = df.withColumn(out, F.expr(f"IF(size({words}) = 0, CAST(array() AS ARRAY<INT>), {some})"))
    return df.withColumn(out, F.expr(f"IF(size({out}) = 0 AND size({words}) > 0, array(hash({words})), {out})")).drop(words, at)


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two signature sets."""
    common = f"size(array_intersect({a}, {b}))"
    return F.expr(f"CASE WHEN size({a}) + size({b}) = 0 THEN 1D WHEN size({a}) = 0 OR size({b}) = 0 THEN 0D"
                  f" ELSE CAST({common} AS DOUBLE) / (size({a}) + size({b}) - {common}) END")


def text_of(sigs: str) -> Column:
    return F.array_join(F.col(sigs).cast("array<string>"), ",")


def id_ranges(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` with ``part``: which of about ``n`` ranges of ascending doc_id a row is in (null ids
    in the first). The bounds, at most ``n``, are approximate percentiles; a binary search over
    them is written out as a chain of columns."""
    at = [i / n for i in range(1, n)]
    bounds = []
    if at:
        found = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * n))).first()[0]
        bounds = sorted(set(found or []))
    docs = docs.withColumn("part", F.lit(0))
    if not bounds:
        return docs
    docs = docs.withColumn("__bounds", F.lit(bounds).cast("array<bigint>"))
    step = 1 << max(0, math.ceil(math.log2(len(bounds) + 1)) - 1)
    while step:
        docs = docs.withColumn("part", F.expr(f"IF(doc_id >= get(__bounds, part + {step - 1}), part + {step}, part)"))
        step //= 2
    return docs.drop("__bounds")


def with_next(docs: DataFrame, columns: list[str], n: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``next_<column>`` from the next document. Ranges of ids are
    sorted apart; the first document of each range is also sent to the range before it (the very
    first to the last), where it only serves as a next one."""
    rows = id_ranges(docs.withColumn("h", F.xxhash64("text")), n)
    heads = [r.asDict() for r in rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("set"), "doc_id", "h")).alias("m"))
             .select("part", "m.doc_id", "m.h").collect()]  # one row per range
    heads.sort(key=lambda r: r["part"])
    if not heads:
        return docs.select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    to = [(h["doc_id"], h["h"], heads[i - 1]["part"], i == 0) for i, h in enumerate(heads)]
    also = spark.createDataFrame(to, f"first_id {kind}, first_h long, also int, wraps boolean")
    rows = rows.join(F.broadcast(also), F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h")), "left")
    places = "IF(also IS NULL, array(struct(part AS at, 0 AS guest)), array(struct(part AS at, 0 AS guest), struct(also AS at, IF(wraps, 2, 1) AS guest)))"
    rows = rows.withColumn("place", F.explode(F.expr(places))).select(*docs.columns, "h", "place.at", "place.guest")
    w = Window.partitionBy("at").orderBy((F.col("guest") == 2).asc(), F.col("doc_id").asc_nulls_first(), F.col("h").asc(), "guest")
    rows = rows.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in columns))
    return rows.where("guest = 0").drop("h", "at", "guest")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose signature sets are alike enough, by exact intersection."""
    a = sets.select(F.col("id").alias("u"), F.col("sigs").alias("x"))
    b = sets.select(F.col("id").alias("v"), F.col("sigs").alias("y"))
    both = pairs.join(a, "u").join(b, "v")
    return both.withColumn("like", likeness("x", "y")).where(F.col("like") >= LIKE).select("u", "v")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_signatures, component_id): documents joined by fingerprints whose Jaccard similarity
    is ``LIKE`` or more, over chains of such links; component_id is the smallest doc_id.

    Equal fingerprints are one set. Sets are partitioned by their length (octaves of 1 / LIKE; a set
    also enters the next partition, whose sets it may be alike). In a partition two sets can only be
    alike if they share one of their rarest ``n - ceil(LIKE * n) + 1`` signatures and their lengths
    differ by no more than that factor; what is left is compared exactly. Members of a shared
    signature are first compared with its smallest set; only where several components remain are
    they compared with each other, across components. Texts without words are alike to nothing."""
    from tidemark.llm.graph import components
    from tidemark.session import write_table

    rows = with_signatures(docs.select("doc_id", "text"), "text", "sigs").select("doc_id", "sigs", F.xxhash64("sigs").alias("id"))
    rows = write_table(rows.withColumn("n", F.size("sigs")), "spot-signatures")
    sets = write_table(rows.where("n > 0").dropDuplicates(["id"]).select("id", "n", "sigs"), "spot-sets")
    each = sets.select("id", "n", F.explode("sigs").alias("sig"))
    rare = Window.partitionBy("id").orderBy("c", "sig")
    each = each.join(each.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1"), "sig")
    # signatures of no other set come first in that order: count them in
    own = Window.partitionBy("id")
    each = each.withColumn("alone", F.col("n") - F.count("*").over(own)).withColumn("place", F.row_number().over(rare) + F.col("alone"))
    kept = each.where(F.col("place") <= F.col("n") - F.ceil(LIKE * F.col("n")) + 1)
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / LIKE) + 1e-9).cast("int")
    groups = kept.withColumn("band", F.explode(F.array(band, band + 1))).select(F.xxhash64("sig", "band").alias("sig"), "id", "n")
    groups = write_table(groups, "spot-groups")
    near = f"n <= {1 / LIKE + 1e-9} * m AND m <= {1 / LIKE + 1e-9} * n"
    heads = groups.groupBy("sig").agg(F.min(F.struct("n", "id")).alias("h"), F.count("*").alias("c")).where("c > 1")
    star = groups.join(heads, "sig").select("id", "n", F.col("h.id").alias("o"), F.col("h.n").alias("m")).where(f"id <> o AND {near}")
    star = star.select(F.least("id", "o").alias("u"), F.greatest("id", "o").alias("v")).distinct()
    links = write_table(_linked(star, sets), "links")
    roots = components(links)
    rooted = groups.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    open_ = rooted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("sig")
    rooted = write_table(rooted.join(open_, "sig"), "spot-open")
    other = rooted.select("sig", F.col("id").alias("o"), F.col("n").alias("m"), F.col("root").alias("other"))
    cross = rooted.join(other, "sig").where(f"id < o AND root <> other AND {near}").select(F.col("id").alias("u"), F.col("o").alias("v")).distinct()
    more = write_table(_linked(cross, sets), "links")
    roots = components(links.unionByName(more)) if more.take(1) else roots
    out = rows.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = out.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return out.where("n > 0").join(least, "root").select("doc_id", F.col("n").alias("n_signatures"), "component_id").unionByName(
        out.where("n = 0").select("doc_id", F.col("n").alias("n_signatures"), F.col("doc_id").alias("component_id")))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = max(1, min(MOST_RANGES, C.text_bytes(docs) // RANGE_BYTES))
    docs = with_next(with_signatures(docs, "text", "sigs"), ["text", "sigs"], n)
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    docs = docs.withColumn("edited", F.expr("concat(left(text, CAST(n_chars - n_chars DIV 4 AS INT)), left(next_text, CAST(n_chars DIV 4 AS INT)))"))
    docs = with_signatures(docs, "edited", "edited_sigs")
    return docs.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       text_of("sigs").alias("fingerprint"), text_of("edited_sigs").alias("edited_fingerprint"),
                       likeness("sigs", "edited_sigs").alias("near_edited"), likeness("sigs", "next_sigs").alias("near_next"))
