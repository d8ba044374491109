"""Records of text files in file order: line ordinals, and records with newlines inside quotes.

Files are read in byte blocks, one task each, without a sort and without a file in one task.

1. Each block counts its newlines. Whether a newline ends a record depends on the quotes before it, so
   with a quote character a block reports both outcomes, for an even and for an odd number of quotes
   before it, and its own parity (a doubled quote inside a field is two quotes: no change).
2. Parities and counts are combined along the blocks of each file: one small row per block.
3. Each block, now told its parity and the number of records before it, cuts out the records that
   begin in it, reading on past its end for the last one.

A task goes through its block in pieces, so that it holds a piece and the longest record, and gives its
records back in batches of about a piece.

Files count in the order of their names, as a folder of ``part-`` files that a sorted table was written
to. A last record may lack its newline; an empty file has no record; a blank line is one.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources import store

BLOCK_BYTES = 32 << 20
PIECE_BYTES = 2 << 20  # bytes of a block, or of records to split, that are handled at a time
READ_ON = 64 << 10  # bytes read at a time behind a block for its last record
BATCH_ROWS = 10_000
MOST_TASKS = 50_000


def file_blocks(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    """(path, size, start, stop) of every block; only names and sizes of the files are read."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    blocks = files.withColumn("start", F.explode(F.expr(f"sequence(0L, size - 1, {block_bytes}L)")))
    return blocks.withColumn("stop", F.least(F.col("start") + F.lit(block_bytes), F.col("size")))


def _ends(data: np.ndarray, quote: int | None, odd: int) -> np.ndarray:
    """Places of the newlines that end a record, ``odd`` being the parity of the quotes before."""
    at = np.flatnonzero(data == 10)
    if quote is None:
        return at
    parity = np.searchsorted(np.flatnonzero(data == quote), at) + odd
    return at[parity % 2 == 0]


def _flips(data: np.ndarray, quote: int | None) -> int:
    """Whether the quotes change the parity."""
    return 0 if quote is None else int(np.count_nonzero(data == quote)) % 2


def _quote(quote: str | None) -> int | None:
    if quote is not None and (len(quote) != 1 or not quote.isascii()):
        raise ValueError("a quote is one ASCII character")
    return None if quote is None else ord(quote)


def counted_blocks(blocks: DataFrame, quote: str | None = None) -> DataFrame:
    """``blocks`` with ``odd``, the parity of the quotes before, and ``before``, the records that end before."""
    q = _quote(quote)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path, size, start, stop in zip(*(c.to_pylist() for c in b.columns), strict=True):
                flips, found, last = 0, [0, 0], 10  # ``found``: ends if the quotes before the block are even, odd
                for at in range(start, stop, PIECE_BYTES):
                    data = np.frombuffer(store.get(path, at, min(PIECE_BYTES, stop - at)), np.uint8)
                    found = [n + len(_ends(data, q, odd ^ flips)) for odd, n in enumerate(found)]
                    flips ^= _flips(data, q)
                    last = data[-1]
                rows.append((path, size, start, stop, flips, *found, int(stop == size and last != 10)))
            yield pa.record_batch([pa.array(x) for x in zip(*rows, strict=True)],
                                  ["path", "size", "start", "stop", "flips", "even", "odd_ends", "open_end"]) if rows else _no_counts()

    def _no_counts() -> pa.RecordBatch:
        return pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("size", "start", "stop", "flips", "even", "odd_ends", "open_end"))]) \
            .empty_table().to_batches()[0]

    counts = blocks.mapInArrow(count, "path string, size long, start long, stop long, flips long, even long, odd_ends long, open_end long")
    counts = _written(counts)
    along = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("odd", F.coalesce(F.sum("flips").over(along), F.lit(0)) % 2)
    counts = counts.withColumn("ends", F.when(F.col("odd") == 0, F.col("even")).otherwise(F.col("odd_ends")))
    # the last record of a file may end with the file: without a newline, or inside open quotes
    shut = (F.col("stop") == F.col("size")) & ((F.col("open_end") == 1) | ((F.col("odd") + F.col("flips")) % 2 == 1))
    counts = counts.withColumn("within", F.coalesce(F.sum("ends").over(along), F.lit(0)))
    files = counts.groupBy("path").agg((F.sum("ends") + F.max(shut.cast("int"))).alias("records"))
    order = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.select(F.col("path").alias("of"), F.coalesce(F.sum("records").over(order), F.lit(0)).alias("files_before"))
    counts = counts.join(files, F.col("path") == F.col("of")).drop("of")
    return counts.select("path", "size", "start", "stop", "odd", (F.col("within") + F.col("files_before")).alias("before"))


def _written(df: DataFrame) -> DataFrame:
    from tidemark.session import write_table

    return write_table(df, "file-blocks")


def cut_records(data: bytes, read_on, start: int, quote: int | None, odd: int) -> tuple[list[bytes], int]:
    """(records, how many ends come before the first): the records that begin in a block. ``data`` begins a
    byte before the block unless that begins its file; ``read_on(n)`` gives n more bytes, or none."""
    lead = 1 if start else 0
    buf = np.frombuffer(data, np.uint8)
    ends = _ends(buf[lead:], quote, odd) + lead
    # a newline just before the block ended a record if the quotes were even there
    fresh = not start or (data[0] == 10 and odd == 0)
    begins = [lead] if fresh else []
    begins += [e + 1 for e in ends.tolist() if e + 1 < len(data)]
    skipped = 0 if fresh else 1
    if not begins:
        return [], skipped
    stops = [e for e in ends.tolist() if e >= begins[0]]
    out = [data[a:b] for a, b in zip(begins, stops, strict=False)]
    if len(out) < len(begins):  # the last one goes on behind the block
        tail = [data[begins[-1]:]]
        parity = (odd + int((buf[lead:] == quote).sum())) % 2 if quote is not None else 0
        while more := read_on(READ_ON):
            at = _ends(np.frombuffer(more, np.uint8), quote, parity)
            if len(at):
                tail.append(more[: int(at[0])])
                break
            tail.append(more)
            parity = (parity + more.count(quote)) % 2 if quote is not None else 0
        out.append(b"".join(tail))
    return out, skipped


def cut_piece(name: str, start: int, stop: int, quote: int | None, odd: int, before: int) -> tuple[list[tuple[int, bytes]], int, int]:
    """(numbered records that begin in a piece of a file, parity behind it, records that end before its end)."""
    first = max(0, start - 1)
    data, at = store.get(name, first, stop - first), stop

    def read_on(n: int) -> bytes:
        nonlocal at
        more = store.get(name, at, n)
        at += len(more)
        return more

    records, skipped = cut_records(data, read_on, start, quote, odd)
    own = np.frombuffer(data, np.uint8)[start - first:]
    numbered = list(enumerate(records, before + skipped))
    return numbered, odd ^ _flips(own, quote), before + len(_ends(own, quote, odd))


def _pieces(col: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``PIECE_BYTES``, at least one row each."""
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + PIECE_BYTES, side="right")))
        yield i, j
        i = j


def ordered_records(spark: SparkSession, path: str, quote: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(line_no, value): every record with its place in file order, from 0. With ``quote`` a newline inside
    quotes belongs to the record, without it every newline ends one."""
    q = _quote(quote)
    blocks = file_blocks(spark, path, block_bytes)
    blocks = blocks.repartition(max(1, min(MOST_TASKS, blocks.count())), "path", "start")
    known = counted_blocks(blocks, quote)
    known = known.repartition(max(1, min(MOST_TASKS, known.count())), "path", "start")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, _, start, stop, odd, before in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for at in range(start, stop, PIECE_BYTES):
                    records, odd, before = cut_piece(name, at, min(at + PIECE_BYTES, stop), q, odd, before)
                    for i in range(0, len(records), BATCH_ROWS):
                        some = records[i: i + BATCH_ROWS]
                        yield pa.record_batch({"line_no": pa.array([n for n, _ in some], pa.int64()),
                                               "value": pa.array([x.decode("utf-8", "replace") for _, x in some], pa.string())})

    return known.mapInArrow(cut, "line_no long, value string")


def split_quoted(df: DataFrame, names: Sequence[str], value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The fields of each record as text columns: a quoted field may hold separators, newlines and doubled
    quotes. Fields that a record lacks are null, further ones are left out."""
    fields = ", ".join(f"`{n}` string" for n in names)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keep), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 30)
        for whole in batches:
            for i, j in _pieces(whole.column(len(keep))):
                b = whole.slice(i, j - i)
                rows = [next(csv.reader(io.StringIO(v, newline="")), []) if v is not None else [] for v in b.column(len(keep)).to_pylist()]
                cols = [pa.array([r[n] if n < len(r) else None for r in rows], pa.string()) for n in range(len(names))]
                yield pa.record_batch([*b.columns[: len(keep)], *cols], [*keep, *names])

    return df.select(*keep, value).mapInArrow(run, schema)
