"""Shared helpers: numpy word kernels over Arrow text, document blocks, packed shuffle records,
files in the shared folder.

The kernels run inside tasks on bounded pieces (``PIECE_BYTES`` of text at a time); Spark does the
partitioning and the shuffles. Words are maximal runs of non-separator *bytes* of the UTF-8 text,
hashed to 64 bits; a hash stands for its word or n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

U8 = np.uint64
PIECE_BYTES = 1 << 20  # text bytes that a kernel holds as numpy arrays at once
_ROOT = U8(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = U8(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# [\x20\x09-\x0D]: what separates the words of the word contracts
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# A-Z to a-z, every other byte unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> U8(30))
    x = x * U8(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U8(27))
    x = x * U8(0x94D049BB133111EB)
    return x ^ (x >> U8(31))


_TABLES: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept per process and grown on demand."""
    if not _TABLES or len(_TABLES[0]) < n:
        size = -(-n // (1 << 18)) << 18
        _TABLES.clear()
        for base in (_ROOT, _INV):
            p = np.full(size, base, U8)
            p[0] = 1
            _TABLES.append(np.multiply.accumulate(p))
    return _TABLES[0][:n], _TABLES[1][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial of ``values`` modulo 2**64; ``range_hash`` takes hashes of ranges from it."""
    p, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, U8)
    np.cumsum(values * p[:-1], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, q = powers(len(sums))
    return mix((sums[end] - sums[start]) * q[start] + (end - start).astype(U8))


_LEAN = False


def lean() -> None:
    """Keep a Python worker small between tasks and batches: Arrow takes its buffers from the system's
    allocator, and a thread gives freed memory back every second, also while the worker idles. A
    no-op in the driver and where the C library has no such call."""
    global _LEAN
    if _LEAN:
        return
    _LEAN = True
    from pyspark import TaskContext

    if TaskContext.get() is None:
        return
    import ctypes
    import threading
    import time

    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return
    pa.set_memory_pool(pa.system_memory_pool())

    def run() -> None:
        while True:
            time.sleep(1)
            trim(0)

    threading.Thread(target=run, daemon=True).start()


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null counts as empty text."""
    lean()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)
    off = off[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a single longer row is a range of its own) and at
    most ``rows`` rows."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1), i + rows)
        yield i, j
        i = j


def word_spans(buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of every word and, per row, the index of its first word (plus
    the total at the end). No word crosses a row boundary."""
    word = ~sep[buf]
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | cut[1:-1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash per word, from one running sum over the bytes."""
    return range_hash(prefix_sums(buf.astype(U8) + U8(1)), start, end)


def hashed_words(buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACE
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``word_spans`` and ``word_hashes`` of many rows, a piece of the bytes at a time."""
    parts = []
    for i, j in pieces(offsets):
        part = buf[offsets[i]: offsets[j]]
        start, end, first = word_spans(part, offsets[i: j + 1] - offsets[i], sep)
        parts.append((start + offsets[i], end + offsets[i], np.diff(first), word_hashes(part, start, end)))
    if not parts:
        return (*word_spans(buf, offsets, sep), np.zeros(0, U8))
    start, end, counts, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    return start, end, np.concatenate([[0], np.cumsum(counts)]), h


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position (len(words) - k + 1 of them, row bounds ignored)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U8)
    at = np.arange(n)
    return range_hash(prefix_sums(words), at, at + k)


def window_starts(word_first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions from which ``k`` words of one row follow, and the row of each."""
    counts = np.diff(word_first)
    n = np.maximum(counts - (k - 1), 0)
    rows = np.repeat(np.arange(len(counts)), n)
    base = np.repeat(word_first[:-1] - (np.cumsum(n) - n), n)
    return base + np.arange(int(n.sum())), rows


def spread(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): records sorted by bucket, and where each of ``n`` buckets starts."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """Bytes of text in the table (one aggregate over the column)."""
    return int(df.agg(F.sum(F.octet_length(col))).first()[0] or 0)


def blocks_of(docs: DataFrame, total: int, block_bytes: int, name: str = "__block") -> tuple[DataFrame, int]:
    """Documents with, as ``name``, the number of a block of about ``block_bytes`` of text. The number depends
    only on the row, so that each pass over the table forms the same blocks; rows without an id are
    dealt out by their text. Blocks stay this size as the table grows."""
    n = max(1, -(-total // block_bytes))
    # a null doc_id adds nothing to xxhash64, so such rows fall back to their text
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return docs.withColumn(name, F.pmod(key, F.lit(n)).cast("int")), n


def one_task_each(rows: DataFrame, n: int) -> DataFrame:
    """Rows that each stand for much work (files, blocks), dealt out evenly; Spark would otherwise
    merge such small partitions into one task."""
    return rows.repartition(max(1, min(n, 50_000)))


def shared(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (shared by the driver and all executors)."""
    return scratch_path(spark, name)


def open_fs(uri: str):
    """(filesystem, path) of a location in shared storage, usable in tasks: a plain path or any
    scheme that pyarrow knows (file, hdfs, s3, gs, viewfs)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, data: bytes, attempt: str) -> None:
    """Write through a temporary name of this attempt, then rename: a reader sees a whole file or
    none, and a repeated task replaces the file with the same bytes."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{attempt}.tmp"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, path)


def get_file(uri: str, start: int = 0, length: int | None = None) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        length = size - start if length is None else min(length, size - start)
        return f.read_at(length, start)


def attempt_name() -> str:
    from pyspark import TaskContext

    tc = TaskContext.get()
    return f"{tc.partitionId()}-{tc.taskAttemptId()}" if tc else "local"


def key_ranges(rows: DataFrame, key: str, weight: str, limit: int, most: int = 1 << 16) -> list[int]:
    """The first keys of ranges of about ``limit`` of the summed ``weight`` each, in order, from the data
    alone: the same for any partitioning of ``rows`` and any run. ``key`` is a bigint; nulls are left
    out. Keys are counted by their leading bits, bins over the limit by further bits, down to single
    keys; at most a few times ``most`` bins reach the driver."""
    span = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.sum(weight).alias("all")).first()
    if span["lo"] is None:
        return []
    limit = max(limit, -(-int(span["all"] or 0) // most))
    shift = 0
    while (span["hi"] >> shift) - (span["lo"] >> shift) >= 4096:
        shift += 1
    leaves: list[tuple[int, int]] = []
    part = rows.select(F.col(key).alias("__key"), F.col(weight).alias("__w")).where(F.col("__key").isNotNull())
    while True:
        bins = part.groupBy(F.shiftright("__key", shift).alias("bin")).agg(F.sum("__w").alias("w")).collect()
        heavy = [b["bin"] for b in bins if (b["w"] or 0) > limit and shift]
        leaves += [(b["bin"] << shift, int(b["w"] or 0)) for b in bins if not ((b["w"] or 0) > limit and shift)]
        if not heavy:
            break
        known = rows.sparkSession.createDataFrame([(b,) for b in heavy], "__bin long")  # at most ``most`` bins are over the limit
        part = part.join(F.broadcast(known), F.shiftright("__key", shift) == F.col("__bin"), "left_semi")
        shift = max(0, shift - 4)
    out: list[int] = []
    held = limit
    for first, w in sorted(leaves):
        if held + w > limit:
            out.append(first)
            held = 0
        held += w
    return out


def range_number(df: DataFrame, key: str, firsts: list[int], name: str) -> DataFrame:
    """``df`` with, as ``name``, how many of the ascending ``firsts`` are at most ``key`` (0 for a null): a
    binary search over literals, written out as a chain of columns."""
    df = df.withColumn(name, F.lit(0))
    if not firsts:
        return df
    df = df.withColumn("__firsts", F.lit(firsts).cast("array<bigint>"))
    step = 1 << max(0, len(firsts).bit_length() - 1)
    while step:
        df = df.withColumn(name, F.expr(f"IF({key} >= get(__firsts, {name} + {step - 1}), {name} + {step}, {name})"))
        step //= 2
    return df.drop("__firsts")


# DuckDB has no crc32: its table, and the steps over the bytes of the hexadecimal column ``raw`` of a
# table ``keyed``, as members of a WITH RECURSIVE list; ``hashed`` has the unsigned value as ``h``
def crc32_sql(columns: str) -> str:
    return f"""
     crc_bits AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i)
                  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
     crc_table AS (SELECT i, c FROM crc_bits WHERE k = 8),
     crc_steps AS (SELECT {columns}, raw, 0 AS place, CAST(4294967295 AS BIGINT) AS crc FROM keyed
                   UNION ALL SELECT {columns}, raw, place + 2, xor(crc >> 8, t.c) FROM crc_steps JOIN crc_table t
                       ON t.i = xor(crc, CAST('0x' || substr(raw, place + 1, 2) AS BIGINT)) & 255 WHERE place < length(raw)),
     hashed AS (SELECT {columns}, xor(crc, 4294967295) AS h FROM crc_steps WHERE place = length(raw))"""
