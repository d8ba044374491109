"""Line records: the producer/consumer side of the reference re-expressed as Spark sources/sinks.

A line source yields ``value: string`` per line. ``clean_lines`` strips whitespace like Python's
``str.strip`` and drops the header record; ``split_naive`` cuts on the separator ignoring quotes
(the reference's ``line.split(',')``), ``parse_quoted`` is the quote-aware alternative (``from_csv``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import col_, strip_ws


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def clean_lines(df: DataFrame, header: str | None = None, value: str = "value", keep_blank: bool = True) -> DataFrame:
    """Strip each line and drop the header record (if given). A line that is empty after the strip
    is a record like any other, as for the reference's producer; ``keep_blank=False`` drops it."""
    out = df.select(strip_ws(value).alias("value"))
    if header is not None:
        out = out.where(F.col("value") != F.lit(header))
    return out if keep_blank else out.where(F.col("value") != "")


def split_naive(df: DataFrame, names: Sequence[str], sep: str = ",", value: str = "value",
                keep: Sequence[str] = (), null_token: str | None = None) -> DataFrame:
    """Split on ``sep`` ignoring quotes (a quoted separator shifts later fields, as in the reference).
    Fields that a short line lacks are null, fields beyond ``names`` are left out; a field equal to
    ``null_token`` is null."""
    parts = F.split(F.col(value), _regex_escape(sep), -1)
    fields = [F.get(parts, F.lit(i)) for i in range(len(names))]
    if null_token is not None:
        fields = [F.nullif(f, F.lit(null_token)) for f in fields]
    return df.select(*[col_(k) for k in keep], *[f.alias(n) for f, n in zip(fields, names, strict=True)])


def parse_quoted(df: DataFrame, schema_ddl: str, value: str = "value", options: dict | None = None) -> DataFrame:
    """Quote-aware CSV parse of each line into typed columns (permissive: bad fields -> null)."""
    opts = {"mode": "PERMISSIVE"}
    opts.update(options or {})
    return df.select(F.from_csv(F.col(value), schema_ddl, opts).alias("_r")).select("_r.*")


def to_lines(df: DataFrame, cols: Sequence[str], sep: str = ",", null_token: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """Render rows as unquoted delimited lines (``value`` column). A null field is ``null_token``, so
    that every line has as many fields as there are columns."""
    return df.select(*[col_(k) for k in keep], F.concat_ws(sep, *[F.coalesce(col_(c).cast("string"), F.lit(null_token)) for c in cols]).alias("value"))


def write_lines(df: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite", **options) -> None:
    """Line sink. ``fmt="kafka"`` needs ``kafka.bootstrap.servers`` and ``topic`` options and the
    connector on the classpath; ``"text"`` writes one file per partition."""
    w = df.select(F.col("value").cast("string").alias("value")).write.format(fmt).options(**options)
    if fmt == "kafka":
        w.save()
    else:
        w.mode(mode).save(path)


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?{}[]\\|()" else ch for ch in s)
