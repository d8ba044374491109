"""Language-model scores by deleted interpolation.

The model mixes three estimates of a token after its context (the token before it, or the text's
begin): the bigram's and the unigram's maximum-likelihood estimates and the uniform one,

    p(w | u) = l2 * c(u, w) / c(u) + l1 * c(w) / N + l0 / (V + 1),

with weights that depend on the bucket of c(u), an octave wide. The weights are learnt by
expectation-maximisation on held-out counts: each training token is taken out of the counts
(c(u, w) - 1, c(u) - 1, c(w) - 1, N - 1) and the mixture of what is left has to predict it. For the
maximisation, tokens with nearly equal ratios of the three estimates (a quarter of an octave) are
counted together, over all training tokens.

Counts are exact and cover the whole training set. Documents come in blocks; a block asks once for
each distinct unigram and bigram that it holds and says how often it holds it in training text;
bundles of n-grams add up and answer. Hot n-grams cost one request per block. Unigrams are named by 64
bits; bigrams by 48 and their bundle, whose size does not grow with the corpus (about one bigram in
10^8 shares its name with another). The answers are
written as two numbers per token, from which weights and scores follow without a shuffle.

Defined results: null or empty text is the end token alone; a row without an id is held out; rows
with equal doc_id count each for itself. With no training text every score is the uniform one's. A
text of any length is one document of its block, which a task holds whole. Columns other than doc_id
and text are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.session import scratch_path

BLOCK_BYTES = 8 << 20
BUNDLE_BYTES = 4 << 20  # text bytes whose n-grams one bundle counts, about
BUCKETS = 64  # octaves of the context's count, and one for unseen contexts
BIGRAM_DROP = 2  # low bytes of a bigram's hash that are not sent: 48 bits and the bundle name it
STEPS = 4  # per octave, of the ratios that EM counts together
ROUNDS = 50
U8 = np.uint64
_END = U8(0x6C62272E07BB0142)
_PAIR = U8(0xD6E8FEB86659FD93)


def held_out(col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(True))


def tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unigram keys, bigram keys, first): the tokens of all texts with an end token each."""
    buf, off = C.text_buffers(texts)
    buf = C.LOWER[buf]
    _, _, first, h = C.hashed_words(buf, off)
    h = np.insert(h, first[1:], _END)
    first = first + np.arange(len(first))
    context = np.roll(h, 1)
    context[first[:-1]] = _END  # a text's begin
    return h, C.mix(context * _PAIR + h), first


def requests(keys: np.ndarray, train: np.ndarray, bundles: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, training counts, bounds, inverse) of a block's distinct n-grams in the order of bundle
    and key; ``inverse`` gives the place of each token's n-gram."""
    names, inverse = np.unique(keys, return_inverse=True)
    counts = np.bincount(inverse, train, minlength=len(names)).astype(np.uint32)
    order, bounds = C.spread((names % U8(bundles)).astype(np.int64), bundles)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    return names[order], counts[order], bounds, place[inverse]


def _planes(values: np.ndarray, drop: int = 0) -> bytes:
    """Bytes of equal weight together, without the ``drop`` lowest: the upper bytes of sorted keys and
    of small counts repeat and are compressed on the way."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize)[:, drop:].T).tobytes()


def _from_planes(raw: bytes, dtype: type, drop: int = 0) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    n = len(raw) // (width - drop)
    out = np.zeros((n, width), np.uint8)
    out[:, drop:] = np.frombuffer(raw, np.uint8).reshape(width - drop, n).T
    return out.view(dtype).ravel()


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per request the total of each of its n-grams; and how many n-grams with a total each request
    was the first to name."""
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    every = np.concatenate(keys)
    names, one, inverse = np.unique(every, return_index=True, return_inverse=True)
    total = np.zeros(len(names), U8)
    np.add.at(total, inverse, np.concatenate(counts).astype(U8))
    new = np.zeros(len(every) + 1, np.int64)
    new[one[total > 0] + 1] = 1
    at = np.concatenate([[0], np.cumsum(size)])
    seen = np.diff(np.cumsum(new)[at])
    back = total[inverse]
    return [back[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], seen


def counted(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, first_seen (n-gram types of the training text that
    this block was the first to ask for, on one row per block), c1 and c2 (the training counts of
    each token and of each bigram, little-endian integers of ``width`` bytes)."""
    total = C.text_bytes(docs)
    bundles = max(1, -(-total // BUNDLE_BYTES))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    blocks, _ = C.blocks_of(rows, total, BLOCK_BYTES, "block")

    def block_requests(t: pa.Table) -> tuple:
        uni, bi, first = tokens(t.column("text"))
        train = np.repeat(~t.column("held_out").to_numpy().astype(bool), np.diff(first))
        return requests(uni, train, bundles), requests(bi, train, bundles), first

    def ask(key: tuple, t: pa.Table) -> pa.Table:
        one, two, _ = block_requests(t)
        full = np.flatnonzero(np.diff(one[2]) + np.diff(two[2]))
        cols = {"bundle": pa.array(full, pa.int32()), "block": pa.array(np.full(len(full), key[0].as_py()), pa.int32())}
        for name, (keys, counts, at, _), drop in (("1", one, 0), ("2", two, BIGRAM_DROP)):
            cols["k" + name] = pa.array([_planes(keys[at[i]: at[i + 1]], drop) for i in full], pa.binary())
            cols["c" + name] = pa.array([_planes(counts[at[i]: at[i + 1]]) for i in full], pa.binary())
        return pa.table(cols)

    def answer(key: tuple, t: pa.Table) -> pa.Table:
        cols = {"block": t.column("block"), "bundle": pa.array(np.full(len(t), key[0].as_py()), pa.int32())}
        for name, drop in (("1", 0), ("2", BIGRAM_DROP)):
            keys = [_from_planes(x, U8, drop) for x in t.column("k" + name).to_pylist()]
            counts = [_from_planes(x, np.uint32) for x in t.column("c" + name).to_pylist()]
            totals, seen = _summed(keys, counts)
            cols["t" + name] = pa.array([_planes(x) for x in totals], pa.binary())
            if name == "1":
                cols["first_seen"] = pa.array(seen)
        return pa.table(cols)

    by = blocks.groupBy("block")
    asked = by.applyInArrow(ask, "bundle int, block int, k1 binary, c1 binary, k2 binary, c2 binary")
    answers = asked.groupBy("bundle").applyInArrow(answer, "block int, bundle int, first_seen long, t1 binary, t2 binary")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def fill(key: tuple, t: pa.Table, got: pa.Table) -> pa.Table:
        one, two, first = block_requests(t)
        got = got.sort_by("bundle")
        c1, c2 = (np.concatenate([_from_planes(x, U8) for x in got.column(name).to_pylist()])[asked[3]] for name, asked in (("t1", one), ("t2", two)))
        totals = np.concatenate([c1, c2])
        width = 8 if len(totals) and totals.max() > 0xFFFFFFFF else 4
        c1, c2 = c1.astype(f"<u{width}"), c2.astype(f"<u{width}")
        seen = np.zeros(len(t), np.int64)
        seen[0] = sum(got.column("first_seen").to_pylist())
        cut = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
        return pa.table({"doc_id": t.column("doc_id"), "held_out": t.column("held_out"), "first_seen": seen,
                         "width": pa.array(np.full(len(t), width), pa.int32()),
                         "c1": pa.array([c1[a:b].tobytes() for a, b in cut], pa.binary()),
                         "c2": pa.array([c2[a:b].tobytes() for a, b in cut], pa.binary())})

    return by.cogroup(answers.groupBy("block")).applyInArrow(
        fill, f"doc_id {kind}, held_out boolean, first_seen long, width int, c1 binary, c2 binary")


def _tokens_of(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, counts of tokens, of bigrams, of contexts, bounds) for pieces of a batch."""
    width = b.column("width").to_numpy()
    for r0, r1 in _runs(width):
        part = b.slice(r0, r1 - r0)
        raw1, off = C.text_buffers(part.column("c1"))
        raw2, _ = C.text_buffers(part.column("c2"))
        w = int(width[r0])
        for i, j in C.pieces(off):
            c1 = np.frombuffer(raw1[off[i]: off[j]].tobytes(), f"<u{w}").astype(np.int64)
            c2 = np.frombuffer(raw2[off[i]: off[j]].tobytes(), f"<u{w}").astype(np.int64)
            first = (off[i: j + 1] - off[i]) // w
            context = np.roll(c1, 1)
            context[first[:-1]] = c1[first[1:] - 1]  # a begin is counted as often as an end
            yield r0 + i, r0 + j, c1, c2, context, first


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else []
    yield from zip(start, [*start[1:], len(values)], strict=True)


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the octave of its count."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


def _estimates(c1, c2, context, n, v) -> np.ndarray:
    """The three estimates per token."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p2 = np.where(context > 0, c2 / np.maximum(context, 1), 0.0)
        p1 = c1 / max(n, 1)
    return np.stack([np.full(len(c1), 1 / (v + 1)), p1, p2])


def cells(rows: DataFrame, n: int, v: int) -> DataFrame:
    """(bucket, r1, r2, tokens): the training tokens, each taken out of the counts, by context bucket
    and by the ratios of their unigram and bigram estimates to the uniform one (-1: zero)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for b in batches:
            held = b.column("held_out").to_numpy(zero_copy_only=False)
            for i, j, c1, c2, context, first in _tokens_of(b):
                use = np.repeat(~held[i:j], np.diff(first))
                p0, p1, p2 = _estimates(c1[use] - 1, c2[use] - 1, context[use] - 1, n - 1, v)
                with np.errstate(divide="ignore"):
                    q1, q2 = (np.where(p > 0, np.rint(STEPS * np.log2(np.maximum(p / p0, 2.0 ** -60))) + 60 * STEPS + 1, 0).astype(np.int64)
                              for p in (p1, p2))
                key = bucket(context[use] - 1) << 40 | q1 << 20 | q2
                for k, c in zip(*(x.tolist() for x in np.unique(key, return_counts=True)), strict=True):
                    found[k] = found.get(k, 0) + c
        k = np.fromiter(found, np.int64, len(found))
        yield pa.record_batch({"bucket": k >> 40, "r1": (k >> 20 & 0xFFFFF), "r2": k & 0xFFFFF,
                               "tokens": np.fromiter(found.values(), np.int64, len(found))})

    return rows.mapInArrow(run, "bucket long, r1 long, r2 long, tokens long") \
        .groupBy("bucket", "r1", "r2").agg(F.sum("tokens").alias("tokens"))


def learn_weights(found: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Weights (bucket, estimate) by expectation-maximisation. An unseen context has no bigram
    estimate. One token's worth of each estimate keeps a weight from vanishing in thin buckets."""
    out = np.tile([1 / 3, 1 / 3, 1 / 3], (BUCKETS + 1, 1))
    out[0] = [0.5, 0.5, 0]
    cell = np.array(found, np.int64).reshape(-1, 4)
    ratio = np.stack([np.ones(len(cell)), *(np.where(cell[:, i] > 0, 2.0 ** ((cell[:, i] - 60 * STEPS - 1) / STEPS), 0) for i in (1, 2))])
    for k in np.unique(cell[:, 0]):
        mine = cell[:, 0] == k
        r, weight = ratio[:, mine], cell[mine, 3].astype(float)
        lam = out[k]
        for _ in range(ROUNDS):
            part = lam[:, None] * r
            part = part / part.sum(axis=0) * weight
            gain = part.sum(axis=1) + (lam > 0)
            lam = gain / gain.sum()
        out[k] = lam
    return out


def scores(rows: DataFrame, weights: np.ndarray, n: int, v: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, c1, c2, context, first in _tokens_of(b):
                p = (weights[bucket(context)].T * _estimates(c1, c2, context, n, v)).sum(axis=0)
                sums = [np.add.reduceat(x, first[:-1]) for x in (
                    np.log10((c1 + 0.5) / (n + 0.5 * (v + 1))), np.log10(p), (c1 > 0).astype(np.int64))]
                yield pa.record_batch({"doc_id": b.column("doc_id").slice(i, j - i), "held_out": b.column("held_out").slice(i, j - i),
                                       "n_tokens": np.diff(first), "n_known": sums[2],
                                       "train_tokens": pa.array(np.full(j - i, n, np.int64)), "base_score": sums[0], "score": sums[1]})

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "token-counts")
    counted(docs).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    width = F.octet_length("c1") / F.col("width")
    n, v = rows.agg(F.sum(F.when(~F.col("held_out"), width).otherwise(0)).cast("long"), F.sum("first_seen")).first()
    n, v = n or 0, v or 0
    table = [tuple(r) for r in cells(rows, n, v).collect()]  # buckets x ratio steps, bounded
    return scores(rows, learn_weights(table), n, v)


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
