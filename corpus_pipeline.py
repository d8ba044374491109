"""The corpus pipeline: documents in, token ids of clean, distinct documents out.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept.
All but the last return the columns of ``docs``; columns that a stage does not know stay as they
are. Nulls and empty texts pass each stage as its operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, decontaminate, partenum, quality, substrings
from tidemark.session import scratch_path, ship_package, write_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score under the threshold go. The model is learnt from the labelled
    rows among them; without labels of both classes nothing is rejected."""
    ship_package(spark)
    rows = write_table(quality.vectors(docs), "quality-vectors")
    model = quality.train(rows, common.table(spark, sf_dir, "labels"))
    if not model.trained:
        return docs
    name = _free("__score", docs)
    return quality.score(docs, model, name).where(F.col(name) >= quality.THRESHOLD).select(docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays: that with the smallest doc_id, of several texts
    with this id the one with the smallest hash, of identical rows one. Rows without an id come
    last in that order. Documents without words are linked with nothing and stay."""
    ship_package(spark)
    found = partenum.jaccard_components(docs.select("doc_id", "text")).where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = found.groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    key = _free("__tk", docs)
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = docs.where(words).withColumn(key, F.xxhash64("text"))
    kept = kept.join(first, kept["doc_id"].eqNullSafe(first["first_id"]) & (kept[key] == first["first_key"]), "left_semi")
    return kept.dropDuplicates(["doc_id", key]).select(docs.columns).unionByName(docs.where(~words))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that repeat go from the texts; n_chars follows a changed text. A document
    without such words keeps its text as it is."""
    ship_package(spark)
    # the operator's own columns would replace those of the same names: set such columns aside
    aside = {c: _free(f"__{c}", docs) for c in docs.columns if c in ("n_words", "n_removed", "kept", "spans", "__block")}
    out = substrings.remove_repeats(docs.withColumnsRenamed(aside))
    changed = F.col("n_removed") > 0
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"))
        elif c == "n_chars":
            cols.append(F.when(changed, F.length("kept")).otherwise(F.col("n_chars")).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(aside.get(c, c)).alias(c))
    return out.select(cols)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    ship_package(spark)
    key = _free("__tk", docs)
    hit = decontaminate.hits(docs.select("text"), common.table(spark, sf_dir, "benchmark")).select(F.col("tk").alias(key)).distinct()
    # a null text has no key and no hit: an anti join keeps it
    return docs.withColumn(key, decontaminate.text_key()).join(hit, key, "left_anti").select(docs.columns)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the text they decode to."""
    ship_package(spark)
    out = bpe.encode_decode(docs, bpe.build_lexicon(spark, docs))
    return out.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe_codec", bpe_codec),
]

# no stage but the join's components and the repeats could be put in SQL, and the classifier and the
# tokenizer not at all; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the table ``documents``; each stage is written and read back."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
