"""Token-id files of patched frame-of-reference blocks.

A stream of unsigned 32-bit integers is cut into blocks of 128. Each block stores its minimum and
the differences to it, packed at the width that holds ``PERCENTILE`` of them; a difference that
needs more bits leaves its upper bits in the block's exception list (position, upper bits). An
index holds the byte where each block starts, so that any block can be read alone.

File: ``TOKPFOR1``, the number of documents, then four streams: document lengths and token ids
(packed blocks), document ids (64-bit) and a flag for null ids. Documents are written in ascending
doc_id over all files; file names sort in the same order. Rows without an id come first; rows with
one id are ordered by their text's hash. A null or empty text is one end id; a text of any length is
one document of one file. Columns other than doc_id and text are not read, whatever their names; an
empty table gives no files and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.bpe import kept, text_pieces, tokenizer_path
from tidemark.llm.library_ids import LibraryIds

BLOCK = 128
PERCENTILE = 0.9
END_ID = 1
FILE_TOKENS = 4_000_000  # a file is closed after the piece of documents that reaches this
MAGIC = b"TOKPFOR1"


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _shapes(width: np.ndarray, excess: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(width, exceptions, blocks): blocks of one shape are handled together, some at a time."""
    shape = width << 8 | excess
    order = np.argsort(shape, kind="stable")
    if not len(order):
        return
    start = np.flatnonzero(np.concatenate([[True], np.diff(shape[order]) != 0]))
    for a, b in zip(start, [*start[1:], len(order)], strict=True):
        for i in range(a, b, 2048):
            rows = order[i: min(i + 2048, b)]
            yield int(width[rows[0]]), int(excess[rows[0]]), rows


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values, the lowest ``width`` bits of each, one behind the other (lowest first) in
    bytes: 64 values fill ``width`` numbers of 64 bits, which all rows get at once."""
    n = len(values)
    v = (values.reshape(n, -1, 64) & np.uint32((1 << width) - 1)).astype(np.uint64)
    out = np.zeros((n, v.shape[1], width + 1), np.uint64)
    for i in range(64):
        at, shift = divmod(i * width, 64)
        out[:, :, at] |= v[:, :, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, at + 1] |= v[:, :, i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out[:, :, :width]).astype("<u8", copy=False).view(np.uint8).reshape(n, -1)


def unpack_bits(raw: np.ndarray, width: int) -> np.ndarray:
    """The rows of values that ``pack_bits`` made ``raw`` of."""
    n = len(raw)
    words = np.ascontiguousarray(raw).view("<u8").reshape(n, -1, width)
    out = np.empty((n, words.shape[1], 64), np.uint32)
    for i in range(64):
        at, shift = divmod(i * width, 64)
        x = words[:, :, at] >> np.uint64(shift)
        if shift + width > 64:
            x = x | words[:, :, at + 1] << np.uint64(64 - shift)
        out[:, :, i] = x & np.uint64((1 << width) - 1)
    return out.reshape(n, -1)


def pack(values: np.ndarray) -> bytes:
    """``values`` (unsigned 32-bit) as: count, index of block starts, blocks."""
    n = len(values)
    blocks = -(-n // BLOCK)
    v = np.zeros(blocks * BLOCK, np.uint32)
    v[:n] = values
    if n % BLOCK:
        v[n:] = v[n - 1]  # the filling adds no width and no exception of its own
    v = v.reshape(blocks, BLOCK)
    low = v.min(axis=1) if blocks else np.zeros(0, np.uint32)
    d = v - low[:, None]
    rank = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _bits(np.partition(d, rank, axis=1)[:, rank]) if blocks else np.zeros(0, np.int64)
    over = d >> width[:, None].astype(np.uint32)  # none is left of 32 bits
    excess = (over > 0).sum(axis=1) if blocks else np.zeros(0, np.int64)
    sizes = 6 + excess * 5 + width * (BLOCK // 8)
    at = np.concatenate([[0], np.cumsum(sizes)])
    body = np.zeros(int(at[-1]), np.uint8)
    for w, e, rows in _shapes(width, excess):
        out = np.zeros((len(rows), 6 + 5 * e + w * (BLOCK // 8)), np.uint8)
        out[:, :4] = low[rows].astype("<u4")[:, None].view(np.uint8).reshape(len(rows), 4)
        out[:, 4], out[:, 5] = w, e
        if e:
            r, c = np.nonzero(over[rows])
            out[:, 6: 6 + e] = c.reshape(len(rows), e)
            out[:, 6 + e: 6 + 5 * e] = over[rows][r, c].astype("<u4").view(np.uint8).reshape(len(rows), 4 * e)
        if w:
            out[:, 6 + 5 * e:] = pack_bits(d[rows], w)
        body[(at[rows][:, None] + np.arange(out.shape[1])).ravel()] = out.ravel()
    return np.uint64(n).tobytes() + at.astype("<u8").tobytes() + body.tobytes()


def packed_size(raw: memoryview) -> int:
    n = int(np.frombuffer(raw[:8], "<u8")[0])
    blocks = -(-n // BLOCK)
    return 16 + 8 * blocks + int(np.frombuffer(raw[8 + 8 * blocks: 16 + 8 * blocks], "<u8")[0])


def unpack(raw: bytes | memoryview, first: int = 0, last: int | None = None) -> np.ndarray:
    """Blocks ``first`` to ``last`` (default: all) of a packed stream."""
    n = int(np.frombuffer(raw[:8], "<u8")[0])
    blocks = -(-n // BLOCK)
    last = blocks if last is None else min(last, blocks)
    at = np.frombuffer(raw[8: 16 + 8 * blocks], "<u8").astype(np.int64)
    body = np.frombuffer(raw, np.uint8)[16 + 8 * blocks:]
    at = at[first: last + 1]
    out = np.zeros((max(0, last - first), BLOCK), np.uint32)
    if last <= first:
        return out.ravel()
    width, excess = body[at[:-1] + 4].astype(np.int64), body[at[:-1] + 5].astype(np.int64)
    for w, e, rows in _shapes(width, excess):
        got = body[at[rows][:, None] + np.arange(6 + 5 * e + w * (BLOCK // 8))]
        d = np.zeros((len(rows), BLOCK), np.uint32)
        if w:
            d = unpack_bits(got[:, 6 + 5 * e:], w)
        if e:
            upper = np.ascontiguousarray(got[:, 6 + e: 6 + 5 * e]).view("<u4")
            np.put_along_axis(d, got[:, 6: 6 + e].astype(np.int64),
                              np.take_along_axis(d, got[:, 6: 6 + e].astype(np.int64), 1) | upper << np.uint32(w), 1)
        low = np.ascontiguousarray(got[:, :4]).view("<u4")
        out[rows] = d + low
    return out.ravel()[: n - first * BLOCK]


def file_bytes(doc_ids: np.ndarray, null: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    return MAGIC + np.uint64(len(lengths)).tobytes() + pack(lengths) + pack(ids) \
        + doc_ids.astype("<i8").tobytes() + null.astype(np.uint8).tobytes()


def read_file(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, null flags, lengths, ids) of one file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token-id file")
    n, rest = int(np.frombuffer(raw[8:16], "<u8")[0]), memoryview(raw)[16:]
    size = packed_size(rest)
    lengths, rest = unpack(rest[:size]), rest[size:]
    size = packed_size(rest)
    ids, rest = unpack(rest[:size]), rest[size:]
    return np.frombuffer(rest[: 8 * n], "<i8"), np.frombuffer(rest[8 * n: 9 * n], np.uint8) > 0, lengths, ids


def write_ids(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Encode every text, append ``END_ID`` and write the files. Lazy: the files appear when the
    returned manifest (file, n_docs, n_tokens; one row per file) is computed. File names carry the
    range partition and a number within it, so that a repeated task replaces the same files."""
    path = path or tokenizer_path()
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, tag = kept(LibraryIds, path), TaskContext.get().partitionId(), C.attempt_name()
        held: list[tuple] = []
        made = 0

        def close() -> pa.RecordBatch:
            nonlocal made
            doc, null, lengths, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            name = f"ids-{part:06d}-{made:06d}.pfor"
            made += 1
            C.put_file(f"{folder}/{name}", file_bytes(doc, null, lengths, ids), tag)
            return pa.record_batch({"file": [name], "n_docs": [len(doc)], "n_tokens": [len(ids)]})

        for b in batches:
            done = 0
            for texts in text_pieces(b.column(1)):
                doc = b.column(0).slice(done, len(texts))
                done += len(texts)
                ids, at = enc.encode(texts)
                out = np.insert(ids, at[1:], END_ID)
                held.append((doc.fill_null(0).to_numpy(), np.asarray(doc.is_null()), np.diff(at) + 1, out))
                if sum(len(x[3]) for x in held) >= FILE_TOKENS:
                    yield close()
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("doc_id", "text").mapInArrow(run, "file string, n_docs long, n_tokens long"))


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids (little-endian unsigned
    32-bit integers). ``start`` needs the running sum over the manifest, one row per file."""
    base = manifest.withColumn("base", F.sum("n_tokens").over(Window.orderBy("file")) - F.col("n_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                doc, null, lengths, ids = read_file(C.get_file(f"{folder}/{name}"))
                at = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
                raw = ids.astype("<u4")
                for i, j in C.pieces(at * 4):
                    yield pa.record_batch({
                        "doc_id": pa.array(doc[i:j], pa.int64(), mask=null[i:j]),
                        "start": pa.array(at[i:j] + start), "n_tokens": pa.array(lengths[i:j].astype(np.int64)),
                        "ids": pa.array([raw[at[r]: at[r + 1]].tobytes() for r in range(i, j)], pa.binary())})

    return C.one_task_each(base.select("file", "base"), manifest.count()).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def op7_pfor_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = C.shared(spark, "token-ids")
    write_ids(C.table(spark, sf_dir, "documents"), folder).write.parquet(f"{folder}/manifest")
    out = read_ids(spark.read.parquet(f"{folder}/manifest"), folder)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
