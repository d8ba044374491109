"""Fixture views over the driver's tables (Spark side).

Every fixture is a query on the given parquet tables, so the Spark plan and the DuckDB oracle read
the same rows and the work grows with the tables. The SQL text of the same views lives in
``tidemark.plans.registry``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The categorical feature columns of the transaction fixture, in feature order.
TX_CATS = ["property_type", "old_new", "duration", "district", "county"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: orders joined to customer, nation and region.

    nation (25 rows) and region (5 rows) are fixed-size dimension tables, so broadcasting them is
    size-bounded by construction. customer grows with the data: that join is left to the planner
    (sort-merge at scale, AQE may switch it to broadcast from runtime sizes).
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    j = o.join(cust, o.o_custkey == cust.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").cast("double").alias("price"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("property_type"),
        F.col("o_orderstatus").alias("old_new"),
        F.col("c_mktsegment").alias("duration"),
        F.col("n_name").alias("district"),
        F.col("r_name").alias("county"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with two categorical columns and a numeric one."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_retailprice").cast("double").alias("price"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("ptype"),
        F.col("p_size").cast("bigint").alias("size"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-d unit vectors as array<double> (float -> double is exact)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.col("label").cast("bigint").alias("label"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival-ordered records; ts kept as TIMESTAMP_NTZ (zone-free elapsed times and windows)."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
