"""Token counts of documents in flat token files that have no index.

A file is a bare run of token ids (unsigned 16-bit where the vocabulary allows it, else 32-bit);
every document ends with the end-of-document id. Files are cut into blocks of bytes, each block is
searched for the end id as one vector, and a prefix scan over the blocks' summaries (how many ends,
where the last one is) gives the ordinal and the start of a document that began in an earlier block.

``write_flat`` makes such files from documents without a shuffle, with a table of (file, ordinal,
doc_id). The texts of special tokens in a document are ordinary text there, so that the end id
occurs only at ends. A null or empty text is one end id. Tokens behind a file's last end id belong
to no document; ``scan`` reports them as a row without an end (``ended`` false). A document may span
any number of blocks. Columns other than the key and the text are not read, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.bpe import kept, text_pieces, tokenizer_path
from tidemark.llm.library_ids import LibraryIds

END = "<|endoftext|>"
FILE_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20


def write_flat(docs: DataFrame, folder: str, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """Write the token files. Lazy; returns one row per document (file, ordinal, key) and one per
    file (ordinal null, bytes, item: bytes of a token id)."""
    path = path or tokenizer_path()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, tag = kept(LibraryIds, path, False), TaskContext.get().partitionId(), C.attempt_name()
        tok = enc.split.tok
        end, item = tok.token_to_id(END), 2 if tok.get_vocab_size() <= 1 << 16 else 4
        held: list[bytes] = []
        made = rows = 0

        def close() -> pa.RecordBatch:
            nonlocal made, rows
            data, name = b"".join(held), f"tokens-{part:06d}-{made:06d}.bin"
            C.put_file(f"{folder}/{name}", data, tag)
            held.clear()
            made, rows = made + 1, 0
            return pa.record_batch({"file": pa.array([name]), "ordinal": pa.array([None], pa.int64()),
                                    "k": pa.nulls(1, keys), "bytes": pa.array([len(data)], pa.int64()),
                                    "item": pa.array([item], pa.int32())})

        for b in batches:
            keys, done = b.column(0).type, 0
            for texts in text_pieces(b.column(1)):
                ids, at = enc.encode(texts)
                held.append(np.insert(ids, at[1:], end).astype(f"<u{item}").tobytes())
                n, name = len(texts), f"tokens-{part:06d}-{made:06d}.bin"
                yield pa.record_batch({"file": pa.array([name] * n), "ordinal": pa.array(range(rows, rows + n), pa.int64()),
                                       "k": b.column(0).slice(done, n), "bytes": pa.nulls(n, pa.int64()),
                                       "item": pa.nulls(n, pa.int32())})
                done, rows = done + n, rows + n
                if sum(map(len, held)) >= FILE_BYTES:
                    yield close()
        if held:
            yield close()

    return docs.select(F.col(key).alias("k"), "text").mapInArrow(
        run, f"file string, ordinal long, k {kind}, bytes long, item int").withColumnRenamed("k", key)


def scan(files: DataFrame, folder: str, end: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) for every document of the files (file, bytes, item):
    ``start`` counts token ids from the file's begin, ``n_tokens`` includes the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, block, size, item in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = np.frombuffer(C.get_file(f"{folder}/{name}", block * block_bytes, block_bytes), f"<u{item}")
                at = np.flatnonzero(ids == end) + block * block_bytes // item
                yield pa.record_batch({
                    "file": pa.array([name]), "block": pa.array([block], pa.int64()),
                    "ends": pa.array([at], pa.list_(pa.int64())),
                    "n": pa.array([len(at)], pa.int64()),
                    "last": pa.array([int(at[-1]) if len(at) else None], pa.int64()),
                    # what follows the last end of the file's last block
                    "size": pa.array([size // item], pa.int64()),
                    "final": pa.array([(block + 1) * block_bytes >= size])})

    blocks = (files.where("bytes > 0").select("file", F.explode(F.sequence(F.lit(0), F.expr(f"(bytes - 1) DIV {block_bytes}"))).alias("block"),
                                              "bytes", "item"))
    n = files.agg(F.sum(F.expr(f"(bytes + {block_bytes - 1}) DIV {block_bytes}"))).first()[0] or 0
    found = C.one_task_each(blocks.select("file", F.col("block").cast("long"), "bytes", "item"), n).mapInArrow(
        run, "file string, block long, ends array<long>, n long, last long, size long, final boolean")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = (found.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .withColumn("carry", F.coalesce(F.max("last").over(before), F.lit(-1))))
    tail = F.col("size") - 1
    whole = F.when(F.col("final") & (F.coalesce("last", "carry") < tail), F.concat("ends", F.array(tail))).otherwise(F.col("ends"))
    rows = scanned.select("file", "base", "carry", "n", whole.alias("ends")).select(
        "file", "base", "carry", "n", "ends", F.posexplode("ends").alias("i", "stop"))
    start = F.when(F.col("i") == 0, F.col("carry")).otherwise(F.try_element_at("ends", F.col("i"))) + 1
    return rows.select("file", (F.col("base") + F.col("i")).alias("ordinal"), start.alias("start"),
                       (F.col("stop") - start + 1).alias("n_tokens"), (F.col("i") < F.col("n")).alias("ended"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, shard (file), ordinal in it, start, n_tokens (with the end id)."""
    from tokenizers import Tokenizer

    folder = C.shared(spark, "flat-tokens")
    write_flat(C.table(spark, sf_dir, "documents"), folder).write.parquet(f"{folder}/order")
    order = spark.read.parquet(f"{folder}/order")
    end = Tokenizer.from_file(tokenizer_path()).token_to_id(END)
    counts = scan(order.where("ordinal IS NULL").select("file", "bytes", "item"), folder, end)
    docs = order.where("ordinal IS NOT NULL").select("file", "ordinal", "doc_id")
    return docs.join(counts, ["file", "ordinal"]).select(
        "doc_id", F.col("file").alias("shard"), "ordinal", "start", "n_tokens")
