"""Column-level helpers. All are built-in Spark expressions (JVM side, whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters Python's str.strip() removes that Java's Unicode \s does not cover.
_STRIP_EXTRA = "\\x1c-\\x1f"
STRIP_PATTERN = f"(?U)^[\\s{_STRIP_EXTRA}]+|[\\s{_STRIP_EXTRA}]+$"


def col_(name: str | Column) -> Column:
    """Column by name; names may hold spaces, '/' or '-', so never parse them as expressions."""
    return name if isinstance(name, Column) else F.col(f"`{name}`")


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing whitespace like Python's ``str.strip()`` (SQL ``trim`` only removes spaces)."""
    return F.regexp_replace(col_(c), STRIP_PATTERN, "")


def safe_double(c: str | Column) -> Column:
    """Cast to double, bad text -> null (Spark 4 ANSI ``cast`` would raise)."""
    return col_(c).cast("string").try_cast("double")


def safe_int(c: str | Column) -> Column:
    return col_(c).cast("string").try_cast("int")


def utf8_encode(c: str | Column) -> Column:
    return F.encode(col_(c), "UTF-8")


def utf8_decode(c: str | Column) -> Column:
    return F.decode(col_(c), "UTF-8")


def epoch_micros(df, c: str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp column. TIMESTAMP_NTZ is measured without any
    time zone (so elapsed times are not bent by the session zone's DST changes)."""
    if df.schema[c].dataType.typeName() == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col_(c))
    return F.unix_micros(col_(c).cast("timestamp"))


def ts_text(c: str | Column) -> Column:
    """Timestamp as 'yyyy-MM-dd HH:mm:ss' text (engine-neutral result form)."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss")


def lit_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _fold(terms: list[Column]) -> Column:
    acc = terms[0]
    for t in terms[1:]:
        acc = acc + t
    return acc


def dot(a: Column, b: Column | Sequence[float], dim: int | None = None) -> Column:
    """Inner product summed left to right.

    With a known dimension (or a literal vector) the sum is unrolled into element arithmetic,
    which whole-stage codegen compiles; otherwise a higher-order ``aggregate`` (interpreted)."""
    if not isinstance(b, Column):
        return _fold([a.getItem(i) * F.lit(float(v)) for i, v in enumerate(b)])
    if dim:
        return _fold([a.getItem(i) * b.getItem(i) for i in range(dim)])
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def sq_dist(a: Column, b: Column | Sequence[float], dim: int | None = None) -> Column:
    if not isinstance(b, Column):
        return _fold([(a.getItem(i) - F.lit(float(v))) * (a.getItem(i) - F.lit(float(v))) for i, v in enumerate(b)])
    if dim:
        return _fold([(a.getItem(i) - b.getItem(i)) * (a.getItem(i) - b.getItem(i)) for i in range(dim)])
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def euclid(a: Column, b: Column | Sequence[float], dim: int | None = None) -> Column:
    return F.sqrt(sq_dist(a, b, dim))
