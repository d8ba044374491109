"""Registry of catalogue queries: name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

# SQL text of the fixture views (DuckDB dialect). Used as CTEs in the oracle queries.
TX_SQL = """tx AS (
  SELECT o.o_orderkey AS id, CAST(o.o_totalprice AS DOUBLE) AS price, o.o_orderdate AS ts,
         o.o_orderpriority AS property_type, o.o_orderstatus AS old_new, c.c_mktsegment AS duration,
         n.n_name AS district, r.r_name AS county
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

PARTS_SQL = """parts AS (
  SELECT p_partkey AS id, CAST(p_retailprice AS DOUBLE) AS price, p_brand AS brand, p_type AS ptype,
         CAST(p_size AS BIGINT) AS size FROM part)"""

EMB_SQL = """emb AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS BIGINT) AS label FROM embeddings)"""

EV_SQL = """ev AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events)"""


def tx_maps_sql(cols: list[str], source: str = "tx", name: str = "tx_maps") -> str:
    """Label maps in SQL: count per (column, label), rank by count desc, label asc."""
    union = "\n    UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS label FROM {source}" for c in cols)
    return f"""{name} AS (
  SELECT "column", label, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, label) - 1 AS "index"
  FROM (SELECT "column", label, count(*) AS n FROM (
    {union}) WHERE label IS NOT NULL GROUP BY 1, 2))"""


def index_join_sql(cols: list[str], source: str, maps: str = "tx_maps") -> tuple[str, str]:
    """(select list of *_index columns, join clauses) mapping null/unseen to the map size."""
    sel, joins = [], []
    for i, c in enumerate(cols):
        sel.append(f"CAST(coalesce(m{i}.\"index\", (SELECT count(*) FROM {maps} WHERE \"column\" = '{c}')) AS DOUBLE) AS {c}_index")
        joins.append(f"LEFT JOIN {maps} m{i} ON m{i}.\"column\" = '{c}' AND m{i}.label = CAST({source}.{c} AS VARCHAR)")
    return ",\n       ".join(sel), "\n".join(joins)


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that its queries register themselves."""
    from tidemark.plans import (q_batches, q_features, q_models, q_requests, q_rows,  # noqa: F401
                                q_similarity, q_sources, q_streams)
