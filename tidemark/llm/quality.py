"""Document quality by regularised quadratic discriminant analysis.

Each text gives a vector of statistics (shares of character classes, word and line shapes, how much
of it repeats), each transformed towards a normal shape. A class is a normal density over that
vector with a shrinkage covariance: its own mixed with the pooled one and with the pooled diagonal.
The score is the posterior of label 1 from the difference of the two log densities (Mahalanobis
distances through Cholesky factors that are computed once, log determinants) and the log odds of
the classes.

Only the statistics of the text enter the score. Class moments are sums over all labelled training
rows, added up by Spark; the driver sees a few hundred numbers.

Defined results: a null or empty text gives the vector of an empty text and is scored like any
other. A label other than 0 or 1 is left out; a document with several labels counts once with each.
If a class has no training rows, every score is the prior's. A text of any length is read whole by one
task. ``score`` keeps all columns but one of its result's name; elsewhere only the key and the text are
read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.session import write_table

SHRINK_POOLED = 0.1  # share of the pooled covariance in a class's own
SHRINK_DIAGONAL = 0.05  # share of the pooled diagonal in the result
RIDGE = 1e-4
THRESHOLD = 0.7

# byte classes
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _HIGH, _STOP, _SYMBOL = range(8)
CLASS = np.full(256, _SYMBOL, np.uint8)
CLASS[65:91], CLASS[97:123], CLASS[48:58], CLASS[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
CLASS[[32, 9, 11, 12, 13]] = _SPACE
CLASS[10] = _LINE
CLASS[list(b".,;:?!'\"()-")] = _STOP
LINE = np.zeros(256, bool)
LINE[10] = True

NAMES = ["bytes", "words", "word_bytes", "word_bytes_var", "upper", "digit", "high", "stop", "symbol",
         "line_words", "short_words", "long_words", "distinct_words", "repeat_words", "repeat_grams",
         "repeat_lines", "ends_symbol", "top_word", "plain_ends", "symbol_words"]


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    s = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return s[first[1:]] - s[first[:-1]]


def _repeated(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: distinct values, occurrences of values that occur more than once, the most frequent."""
    if not len(hashes):
        z = np.zeros(n_rows)
        return z, z, z
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])]))
    count = np.diff(np.append(start, len(h)))
    owner = r[start]
    top = np.zeros(n_rows)
    np.maximum.at(top, owner, count)
    return (np.bincount(owner, minlength=n_rows).astype(float),
            np.bincount(owner, np.where(count > 1, count, 0), minlength=n_rows), top)


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One vector per text, as named in ``NAMES``."""
    rows = len(off) - 1
    size = np.diff(off).astype(float)
    kind = CLASS[buf]
    per_class = np.zeros((rows, 8))
    owner = np.repeat(np.arange(rows), np.diff(off))
    if len(buf):
        per_class = np.bincount(owner * 8 + kind, minlength=rows * 8).reshape(rows, 8).astype(float)
    share = per_class / np.maximum(size, 1)[:, None]
    start, end, first = C.word_spans(buf, off)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    length = (end - start).astype(float)
    w_row = np.repeat(np.arange(rows), np.diff(first))
    mean = _per_row(length, first) / some
    var = np.maximum(_per_row(length ** 2, first) / some - mean ** 2, 0)
    h = C.word_hashes(buf, start, end)
    distinct, repeat, top = _repeated(h, w_row, rows)
    g_at, g_row = C.window_starts(first, 3)
    grams = C.gram_hashes(h, 3)[g_at] if len(g_at) else np.zeros(0, np.uint64)
    _, g_repeat, _ = _repeated(grams, g_row, rows)
    l_start, l_end, l_first = C.word_spans(buf, off, LINE)
    l_row = np.repeat(np.arange(rows), np.diff(l_first))
    lines = np.diff(l_first).astype(float)
    _, l_repeat, _ = _repeated(C.word_hashes(buf, l_start, l_end), l_row, rows)
    last, head = (kind[end - 1], kind[start]) if len(end) else (kind[:0], kind[:0])
    odd = np.concatenate([[0], np.cumsum(kind == _SYMBOL)])
    odd_words = (odd[end] - odd[start]) > 0
    letters = (kind == _UPPER) | (kind == _LOWER) | (kind == _HIGH)
    f = {
        "bytes": np.log1p(size), "words": np.log1p(words), "word_bytes": np.log1p(mean),
        "word_bytes_var": np.log1p(var), "upper": share[:, _UPPER], "digit": share[:, _DIGIT],
        "high": share[:, _HIGH], "stop": share[:, _STOP], "symbol": share[:, _SYMBOL],
        "line_words": np.log1p(words / np.maximum(lines, 1)),
        "short_words": _per_row(length <= 2, first) / some, "long_words": _per_row(length >= 12, first) / some,
        "distinct_words": distinct / some, "repeat_words": repeat / some,
        "repeat_grams": g_repeat / np.maximum(words - 2, 1), "repeat_lines": l_repeat / np.maximum(lines, 1),
        "ends_symbol": _per_row((last == _SYMBOL) | (last == _STOP), first) / some, "top_word": top / some,
        "plain_ends": _per_row(letters[end - 1] if len(end) else last, first) / some,
        "symbol_words": _per_row(odd_words, first) / some,
    }
    del head
    # shares: the square root's arcsine evens out the variance near 0 and 1
    logs = {"bytes", "words", "word_bytes", "word_bytes_var", "line_words"}
    return np.stack([f[k] if k in logs else np.arcsin(np.sqrt(np.clip(f[k], 0, 1))) for k in NAMES], axis=1)


def _vectors(col: pa.Array) -> np.ndarray:
    buf, off = C.text_buffers(col)
    out = [statistics(buf[off[i]: off[j]], off[i: j + 1] - off[i]) for i, j in C.pieces(off)]
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


@dataclass
class Model:
    """Means, inverse Cholesky factors, log determinants and the log odds of the classes."""

    mean: np.ndarray
    factor: np.ndarray
    logdet: np.ndarray
    odds: float
    trained: bool

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(x), 1 / (1 + np.exp(-self.odds)))
        dens = [-0.5 * (((x - self.mean[c]) @ self.factor[c].T) ** 2).sum(axis=1) - 0.5 * self.logdet[c] for c in (0, 1)]
        z = np.clip(dens[1] - dens[0] + self.odds, -60, 60)
        return 1 / (1 + np.exp(-z))


def vectors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x): the statistics of each text; one pass over the texts, no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(NAMES), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), flat], names=["k", "x"])

    return docs.select(F.col(key).alias("k"), text).mapInArrow(run, f"k {kind}, x array<double>").withColumnRenamed("k", key)


def moments(rows: DataFrame) -> DataFrame:
    """(label, at, value) from ``x`` and ``label``: per label the number of rows (at 0), the sums of
    the vectors and of their products. Each task adds up its rows before anything is sent."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            if not len(b):
                continue
            x, label = b.column(0).flatten().to_numpy().reshape(-1, d), b.column(1).to_numpy()
            for c in (0, 1):
                v = x[label == c]
                total[c] += np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v).ravel()])
        yield pa.record_batch({"label": pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()),
                               "at": pa.array(np.tile(np.arange(total.shape[1]), 2), pa.int32()),
                               "value": pa.array(total.ravel())})

    parts = rows.select("x", "label").mapInArrow(run, "label int, at int, value double")
    return parts.groupBy("label", "at").agg(F.sum("value").alias("value"))


def fit(rows: DataFrame) -> Model:
    """Fit on rows (x, label) with labels 0 and 1. A few hundred sums per label reach the driver."""
    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d))
    for r in moments(rows).collect():
        total[r.label, r.at] = r.value
    n = total[:, 0]
    odds = float(np.log((n[1] + 1) / (n[0] + 1)))
    if n.min() == 0:
        return Model(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), odds, False)
    mean = total[:, 1: 1 + d] / n[:, None]
    scatter = [total[c, 1 + d:].reshape(d, d) - n[c] * np.outer(mean[c], mean[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / max(1, n.sum() - 2)
    # a floor under each variance keeps constant statistics from dividing by zero
    diagonal = np.diag(np.maximum(np.diag(pooled), RIDGE))
    factor, logdet = np.zeros((2, d, d)), np.zeros(2)
    for c in (0, 1):
        own = scatter[c] / max(1, n[c] - 1)
        mixed = (1 - SHRINK_POOLED) * own + SHRINK_POOLED * pooled
        cov = (1 - SHRINK_DIAGONAL) * mixed + SHRINK_DIAGONAL * diagonal + RIDGE * np.eye(d)
        low = np.linalg.cholesky(cov)
        factor[c], logdet[c] = np.linalg.inv(low), 2 * np.log(np.diag(low)).sum()
    return Model(mean, factor, logdet, odds, True)


def score_vectors(rows: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score) from ``vectors``."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["k", "score"])

    return rows.select(F.col(key).alias("k"), "x").mapInArrow(run, f"k {kind}, score double").withColumnRenamed("k", key)


def score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of each text as a further column; one pass, no shuffle. A column of
    that name is replaced."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = [c for c in docs.columns if c != out]
    at = kept.index(text)
    schema = StructType([*(docs.schema[c] for c in kept), StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(_vectors(b.column(at))))],
                                             names=[*kept, out])

    return docs.select(*kept).mapInArrow(run, schema)


def held_out(col: str = "doc_id"):
    """The rows that no label may be learnt from. A row without an id is one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def train(rows: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows (doc_id, x) of the training folds. Vectors are joined with
    labels, not texts."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label IN (0, 1)").distinct()
    return fit(rows.where(~held_out()).join(known, "doc_id").select("x", "label"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = write_table(vectors(C.table(spark, sf_dir, "documents")), "quality-vectors")
    model = train(rows, C.table(spark, sf_dir, "labels"))
    return score_vectors(rows, model).select("doc_id", held_out().alias("held_out"), "score",
                                             (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
