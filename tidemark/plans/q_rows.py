"""Catalogue: sources, sinks, casts, fills, projections, filters, sampling (S1 S3 S4 K2 K3 P F X T5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import safe_double, ts_text, utf8_decode, utf8_encode
from tidemark.operators import rows
from tidemark.operators.labels import LabelMaps
from tidemark.operators.similarity import top_n
from tidemark.plans import fixtures as fx
from tidemark.plans.registry import TX_SQL, index_join_sql, register, tx_maps_sql
from tidemark.session import scratch_path
from tidemark.sources import files, lines

CATS = fx.TX_CATS
TX_COLS = ["id", "price", "ts", *CATS]
HEADER = ",".join(TX_COLS)
_TX_OUT = "SELECT id, price, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, " + ", ".join(CATS) + " FROM tx"


def _typed_tx(df):
    """Typed transaction columns from text columns (safe casts)."""
    return df.select(F.col("id").try_cast("bigint").alias("id"), safe_double("price").alias("price"),
                     ts_text(F.col("ts").try_cast("timestamp_ntz")).alias("ts"), *CATS)


@register("line_source_split", sql=f"WITH {TX_SQL} {_TX_OUT}")
def line_source_split(spark, sf):
    """tx rendered as text lines (with padding whitespace and a header record), written to a
    file, read back as a line source, stripped, header dropped, split on ','."""
    t = fx.tx(spark, sf)
    body = lines.to_lines(t, TX_COLS)
    padded = body.select(F.when(F.length("value") % 3 == 0, F.concat(F.lit(" \t"), "value", F.lit(" \r")))
                         .otherwise(F.col("value")).alias("value"))
    src = spark.createDataFrame([(HEADER,)], "value string").unionByName(padded)
    path = scratch_path(spark, "lines")
    lines.write_lines(src, path)
    got = lines.clean_lines(lines.read_lines(spark, path), header=HEADER)
    return _typed_tx(lines.split_naive(got, TX_COLS))


@register("line_source_quoted", sql=f"""WITH {TX_SQL}
SELECT id, price, district || ', ' || county AS location, CAST(4 AS INTEGER) AS naive_fields FROM tx""")
def line_source_quoted(spark, sf):
    """A quoted field holding the separator: from_csv keeps it whole, the naive split cuts it."""
    t = fx.tx(spark, sf)
    src = t.select(F.concat_ws(",", F.col("id").cast("string"), F.col("price").cast("string"),
                               F.concat(F.lit('"'), "district", F.lit(", "), "county", F.lit('"'))).alias("value"))
    path = scratch_path(spark, "quoted")
    lines.write_lines(src, path)
    got = lines.clean_lines(lines.read_lines(spark, path))
    parsed = got.select(F.from_csv("value", "id BIGINT, price DOUBLE, location STRING").alias("r"),
                        F.size(F.split("value", ",", -1)).alias("naive_fields"))
    return parsed.select("r.id", "r.price", "r.location", "naive_fields")


@register("csv_roundtrip", sql=f"WITH {TX_SQL} {_TX_OUT}")
def csv_roundtrip(spark, sf):
    t = fx.tx(spark, sf)
    path = scratch_path(spark, "csv")
    files.write_csv(t, path, header=True)
    schema = "id BIGINT, price DOUBLE, ts TIMESTAMP_NTZ, " + ", ".join(f"{c} STRING" for c in CATS)
    back = files.read_csv(spark, path, schema=schema, header=True)
    return back.select("id", "price", ts_text("ts").alias("ts"), *CATS)


_SEL, _JOIN = index_join_sql(CATS, "tx")


@register("parquet_roundtrip", sql=f"""WITH {TX_SQL}, {tx_maps_sql(CATS)}
SELECT tx.id, tx.price, {_SEL} FROM tx {_JOIN}""")
def parquet_roundtrip(spark, sf):
    t = fx.tx(spark, sf)
    ix = LabelMaps.fit(t, CATS).transform(t)
    path = scratch_path(spark, "indexed")
    files.write_parquet(ix, path)
    return files.read_parquet(spark, path).select("id", "price", *[f"{c}_index" for c in CATS])


@register("utf8_roundtrip", sql="""SELECT doc_id, octet_length(encode(text)) AS n_bytes,
  decode(encode(text)) = text AS same FROM documents""")
def utf8_roundtrip(spark, sf):
    d = fx.table(spark, sf, "documents")
    enc = utf8_encode("text")
    return d.select("doc_id", F.octet_length(enc).cast("bigint").alias("n_bytes"), (utf8_decode(enc) == F.col("text")).alias("same"))


WANTED = ["id", "county", "town_city", "property_type", "ppd_category", "duration"]


@register("project_present", sql=f"WITH {TX_SQL} SELECT id, county, property_type, duration FROM tx")
def project_present(spark, sf):
    return rows.project_present(fx.tx(spark, sf), WANTED, policy="skip")


@register("label_cast_drop", sql=f"""WITH {TX_SQL}
SELECT id, price_double FROM (
  SELECT id, TRY_CAST(CASE WHEN id % 10 = 0 THEN 'x' ELSE CAST(price AS VARCHAR) END AS DOUBLE) AS price_double FROM tx)
WHERE price_double IS NOT NULL""")
def label_cast_drop(spark, sf):
    t = fx.tx(spark, sf)
    raw = t.select("id", F.when(F.col("id") % 10 == 0, F.lit("x")).otherwise(F.col("price").cast("string")).alias("price"))
    return rows.drop_bad_label(raw, "price", "price_double").select("id", "price_double")


_NULLED = {"old_new": 4, "county": 6, "district": 9}


def _nulled_tx(spark, sf):
    t = fx.tx(spark, sf)
    for c, m in _NULLED.items():
        t = t.withColumn(c, F.when(F.col("id") % m == 0, F.lit(None).cast("string")).otherwise(F.col(c)))
    return t


_NULLED_SQL = ", ".join(
    f"CASE WHEN id % {_NULLED[c]} = 0 THEN NULL ELSE {c} END AS {c}" if c in _NULLED else c for c in CATS)


@register("fill_unknown", sql=f"""WITH {TX_SQL}, nt AS (SELECT id, {_NULLED_SQL} FROM tx)
SELECT id, {', '.join(f"coalesce({c}, 'Unknown') AS {c}" for c in CATS)} FROM nt""")
def fill_unknown(spark, sf):
    return rows.fill_unknown(_nulled_tx(spark, sf), CATS).select("id", *CATS)


# Fixed value: the id excluded by the self-exclusion filter.
EXCLUDED_ID = 3


@register("exclude_id_filter", sql=f"""WITH {TX_SQL}
SELECT id, price FROM (SELECT CASE WHEN id % 7 = 0 THEN NULL ELSE id END AS id, price FROM tx) WHERE id <> {EXCLUDED_ID}""")
def exclude_id_filter(spark, sf):
    t = fx.tx(spark, sf).select(F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).alias("id"), "price")
    return rows.exclude_id(t, "id", EXCLUDED_ID)


@register("sample_query_rows", sql=f"""WITH {TX_SQL}
SELECT id, {', '.join(CATS)} FROM tx ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT 5""")
def sample_query_rows(spark, sf):
    """Draw 5 query rows (reproducible order by md5(id)) and keep only id + categorical columns."""
    return rows.sample_rows(fx.tx(spark, sf), 5, "id").select("id", *CATS)


# lines that are not tidy: by id, a short line, one with a field too many, a blank one, a null field
_RAGGED = """CASE id % 5 WHEN 0 THEN CAST(id AS STRING) WHEN 1 THEN CAST(id AS STRING) || ',' || county || ',' || duration || ',extra'
  WHEN 2 THEN CASE WHEN id % 2 = 0 THEN '' ELSE '   ' END WHEN 3 THEN CAST(id AS STRING) || ',NULL,' || duration
  ELSE CAST(id AS STRING) || ',' || county || ',' || duration END"""


@register("line_source_ragged", sql=f"""WITH {TX_SQL}, l AS (SELECT string_split(trim({_RAGGED.replace("STRING", "VARCHAR")}), ',') AS p FROM tx)
SELECT TRY_CAST(p[1] AS BIGINT) AS id, nullif(p[2], 'NULL') AS county, p[3] AS duration, len(p[1]) = 0 AS blank FROM l""")
def line_source_ragged(spark, sf):
    """Short, long and blank lines are records; missing fields and the null token are null."""
    t = fx.tx(spark, sf)
    path = scratch_path(spark, "ragged")
    lines.write_lines(t.select(F.expr(_RAGGED).alias("value")), path)
    got = lines.split_naive(lines.clean_lines(lines.read_lines(spark, path)), ["id", "county", "duration"], null_token="NULL")
    return got.select(F.col("id").try_cast("bigint").alias("id"), "county", "duration", (F.col("id") == "").alias("blank"))


@register("null_fields_roundtrip", sql=f"""WITH {TX_SQL} SELECT id, CASE WHEN id % 3 > 0 THEN county END AS county,
  CASE WHEN id % 2 > 0 THEN duration END AS duration FROM tx""")
def null_fields_roundtrip(spark, sf):
    """Null fields through the line sink and source."""
    t = fx.tx(spark, sf).select("id", F.when(F.col("id") % 3 > 0, F.col("county")).alias("county"),
                                F.when(F.col("id") % 2 > 0, F.col("duration")).alias("duration"))
    path = scratch_path(spark, "null-fields")
    lines.write_lines(lines.to_lines(t, t.columns, null_token="NULL"), path)
    got = lines.split_naive(lines.clean_lines(lines.read_lines(spark, path)), t.columns, null_token="NULL")
    return got.withColumn("id", F.col("id").try_cast("bigint"))


@register("csv_infer_schema", sql=f"""WITH {TX_SQL} SELECT 'bigint,double,string,string' AS types, count(*) AS n, round(sum(price), 2) AS total FROM tx""")
def csv_infer_schema(spark, sf):
    """CSV with a header and inferred types."""
    t = fx.tx(spark, sf).select(F.col("id") + 10 ** 10, F.round(F.col("price") + 0.005, 3), "county", "duration").toDF("id", "price", "county", "duration")
    path = scratch_path(spark, "csv-infer")
    files.write_csv(t, path, header=True)
    back = files.read_csv(spark, path, header=True, infer=True)
    types = ",".join(f.dataType.simpleString() for f in back.schema.fields)
    return back.agg(F.lit(types).alias("types"), F.count("*").alias("n"), F.round(F.sum(F.round(F.col("price") - 0.005, 3)), 2).alias("total"))


@register("unordered_limit", sql=f"WITH {TX_SQL} SELECT least(count(*), 100) AS n FROM tx")
def unordered_limit(spark, sf):
    """Without a distance column the first n rows come in any order."""
    return top_n(fx.tx(spark, sf).select("id"), 100).agg(F.count("*").alias("n"))


@register("empty_result_schema", sql="SELECT 'id:bigint,price:double,rank:int' AS columns, CAST(0 AS BIGINT) AS n, TRUE AS empty")
def empty_result_schema(spark, sf):
    """A filter that no row passes: no rows, the columns as ever, and the emptiness test."""
    none = fx.tx(spark, sf).where("price < 0").select("id", "price", F.lit(1).alias("rank"))
    cols = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in none.schema.fields)
    return none.agg(F.lit(cols).alias("columns"), F.count("*").alias("n")).withColumn("empty", F.lit(none.isEmpty()))
