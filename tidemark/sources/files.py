"""CSV / Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
             infer: bool = False, **options) -> DataFrame:
    """CSV scan. An explicit schema is preferred (inference costs an extra pass and types vary per
    file); ``infer=True`` reproduces ``header=True, inferSchema=True``."""
    r = spark.read.option("header", header).options(**options)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = False, partition_by: Sequence[str] = (),
              mode: str = "overwrite", **options) -> None:
    """CSV sink. RFC-style quoting of fields holding the separator or quotes (Spark's default)."""
    w = df.write.mode(mode).option("header", header).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
