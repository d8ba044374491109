"""Spark ML model surface: the reference's three engines as fit / save / load / transform functions.

One ``Pipeline`` (multi-column label maps -> VectorAssembler -> estimator) replaces the
reference's separate indexer directories, so a model is one directory written with
``write().overwrite()`` and read with ``PipelineModel.load``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.label_stage import LabelMapIndexer

# Seeds. The k-means seed is the one stored in the reference's saved k-means metadata
# (PySpark's default seed rule); the LSH seed follows the same rule for the LSH class name.
KMEANS_SEED = -6641708911384315134
LSH_SEED = 8357294788820904367
LSH_BUCKET_LENGTH = 2.0
LSH_TABLES = 3


def indexers(cats: Sequence[str], suffix: str = "_index") -> LabelMapIndexer:
    """Most frequent label first; null and unseen values get the map's size. The maps stay a table."""
    return LabelMapIndexer(inputCols=list(cats), outputCols=[f"{c}{suffix}" for c in cats])


def fit_price_pipeline(df: DataFrame, cats: Sequence[str], label: str,
                       handle_invalid: str = "error") -> PipelineModel:
    """Label maps + assembler + OLS (regParam 0, intercept) on ``label``; rows with a null label
    must be removed first (see ``drop_bad_label``)."""
    idx = [f"{c}_index" for c in cats]
    stages = [indexers(cats),
              VectorAssembler(inputCols=idx, outputCol="features", handleInvalid=handle_invalid),
              LinearRegression(featuresCol="features", labelCol=label, solver="normal")]
    return Pipeline(stages=stages).fit(df)


def fit_cluster_pipeline(df: DataFrame, cats: Sequence[str], k: int = 3, seed: int = KMEANS_SEED) -> PipelineModel:
    idx = [f"{c}_index" for c in cats]
    stages = [indexers(cats), VectorAssembler(inputCols=idx, outputCol="features"),
              KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")]
    return Pipeline(stages=stages).fit(df)


def fit_similarity_pipeline(df: DataFrame, cats: Sequence[str], bucket_length: float = LSH_BUCKET_LENGTH,
                            tables: int = LSH_TABLES, seed: int = LSH_SEED) -> PipelineModel:
    idx = [f"{c}_index" for c in cats]
    stages = [indexers(cats), VectorAssembler(inputCols=idx, outputCol="features", handleInvalid="skip"),
              BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                          numHashTables=tables, seed=seed)]
    return Pipeline(stages=stages).fit(df)


def save_feature_list(spark, cols: Sequence[str], path: str) -> None:
    """The active feature columns, one per line (written through Spark, so any shared filesystem works)."""
    spark.createDataFrame([(c,) for c in cols], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_feature_list(spark, path: str) -> list[str]:
    """Feature columns back from text: stripped, blank lines dropped, file order kept."""
    df = spark.read.text(path).select(F.trim("value").alias("c"), F.monotonically_increasing_id().alias("o"))
    return [r["c"] for r in df.where(F.col("c") != "").orderBy("o").collect()]  # one line per column


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_kmeans(pts: DataFrame, vec_col: str, k: int, seed: int = KMEANS_SEED, max_iter: int = 20):
    """MLlib k-means on an array<double> column; returns (model, rows with int ``cluster``)."""
    v = pts.withColumn("_features", array_to_vector(F.col(vec_col)))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(v)
    out = model.transform(v).drop("_features").withColumn("cluster", F.col("cluster").cast("int"))
    return model, out


def fit_lsh(items: DataFrame, vec_col: str, bucket_length: float, tables: int = LSH_TABLES, seed: int = LSH_SEED):
    v = items.withColumn("_features", array_to_vector(F.col(vec_col)))
    model = BucketedRandomProjectionLSH(inputCol="_features", outputCol="_hashes", bucketLength=bucket_length,
                                        numHashTables=tables, seed=seed).fit(v)
    return model, v


def price_response(prediction: str, error: str | None = None) -> Column:
    """The price endpoint's JSON; with a refusal's text, that instead."""
    ok = F.to_json(F.struct(F.col(prediction).alias("predicted_price")))
    return ok if error is None else F.when(F.col(error).isNotNull(), F.to_json(F.struct(F.col(error).alias("error")))).otherwise(ok)


def cluster_response(cluster: str) -> Column:
    """The clustering endpoint's JSON."""
    return F.to_json(F.struct(F.col(cluster).alias("cluster")))
