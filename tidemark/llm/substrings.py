"""Substring deduplication with prefix-partitioned suffix trees.

A suffix is the text from one word on, of which the first ``WINDOW`` words matter: two suffixes that
agree on them begin a repeat. A subtree holds the suffixes of one prefix. Its edges are blocks of
words (12, 12 and 11 of the 35), each named by a 64-bit hash, so a suffix is three numbers and its
depths are 12, 24 and 35 words. Sorting a subtree's suffixes lays the tree out; neighbours that
agree on all blocks meet in an internal node of depth ``WINDOW``, and all suffixes below such a node
repeat. Overlapping repeated windows join to the maximal repeated spans.

Prefixes have variable lengths. Suffixes are first dealt out by their first block, many prefixes to
a memory-sized bundle; a bundle over ``BUNDLE_SUFFIXES`` is not built but dealt out again by the
first two blocks, and at last by all three.

What is not sent: documents come in blocks of a few MB; within a block repeats are found at once and
one suffix of each distinct window goes on, so a window that fills a third of the corpus costs one
suffix per block. And a window goes on only if its screen value, the smallest hash of its 8-word
runs, occurs in another block; equal windows have equal screen values, so nothing is lost.

Defined results: null or empty text has no words, keeps none and becomes empty text; windows are
judged on the input; repeated rows repeat each other's windows like any two documents. A text of any
length is one document of its block, which a task holds whole. ``remove_repeats`` keeps all columns but
those named as its own (n_words, n_removed, kept, spans, __block). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.bpe import gather

WINDOW = 35
EDGES = (12, 12, 11)  # words on the edges of a path of WINDOW words
RUN = 8  # words in a run of the screen
BLOCK_BYTES = 4 << 20  # text bytes in a block of documents
PIECE_BYTES = 1 << 18  # text bytes of a block that are held as words and windows at once
BUNDLE_SUFFIXES = 4_000_000
U8 = np.uint64
SUFFIX = np.dtype([("a", "<u8"), ("b", "<u8"), ("c", "<u8")])


def _pieces(texts: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, ...]]:
    """(bytes, starts, ends, first words, word hashes) of a block's texts, ``PIECE_BYTES`` of them at a
    time; a longer text is a piece of its own."""
    buf, off = C.text_buffers(texts)
    for i, j in C.pieces(off, PIECE_BYTES):
        part = buf[off[i]: off[j]]
        start, end, first = C.word_spans(part, off[i: j + 1] - off[i])
        yield part, start, end, first, C.word_hashes(part, start, end)


def window_names(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(three edge hashes, one hash of all three) of the windows that begin at ``at``."""
    sums, edges, place = C.prefix_sums(h), [], at
    for n in EDGES:
        edges.append(C.range_hash(sums, place, place + n))
        place = place + n
    return np.stack(edges), name_of(*edges)


def name_of(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return C.mix(a + C.mix(b + C.mix(c)))


def screen(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The smallest hash of the runs in each window: minima over 2, 4, 8, 16 runs, then two of those."""
    least = C.gram_hashes(h, RUN)
    runs, span = WINDOW - RUN + 1, 1
    while 2 * span <= runs:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    return np.minimum(least[at], least[at + runs - span])


def _several(names: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(names, kind="stable")
    s = names[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(names), bool)
    out[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(s) else False
    return out


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values occur among ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def repeated_windows(blocks: DataFrame, bundles: int) -> DataFrame:
    """(__block, names): per block the hashes of its windows that occur in another block, from
    ``blocks`` (any columns with text and __block)."""

    def values(key: tuple, t: pa.Table) -> pa.Table:
        found = [np.zeros(0, U8)]
        for _, _, _, first, h in _pieces(t.column("text")):
            at, _ = C.window_starts(first, WINDOW)
            if len(at):
                found.append(np.unique(screen(h, at)))
        m = np.unique(np.concatenate(found))
        return pa.table({"__block": pa.array(np.full(len(m), key[0].as_py(), np.int32)), "m": m.view(np.int64)})

    by = blocks.groupBy("__block")
    screened = by.applyInArrow(values, "__block int, m long")
    elsewhere = screened.withColumn("n", F.count("*").over(Window.partitionBy("m"))).where("n > 1").select("__block", "m")

    def suffixes(key: tuple, t: pa.Table, known: pa.Table) -> pa.Table:
        empty = pa.table({"bundle": pa.array([], pa.int32()), "__block": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})
        if not len(known) or not len(t):
            return empty
        m = np.sort(known.column("m").to_numpy().view(U8))
        parts = []
        for _, _, _, first, h in _pieces(t.column("text")):
            at, _ = C.window_starts(first, WINDOW)
            at = at[_in(screen(h, at), m)] if len(at) else at
            if len(at):
                edges, names = window_names(h, at)
                names, one = np.unique(names, return_index=True)
                parts.append((names, edges[:, one]))
        if not parts:
            return empty
        _, one = np.unique(np.concatenate([names for names, _ in parts]), return_index=True)
        rec = np.zeros(len(one), SUFFIX)
        for k, name in enumerate(SUFFIX.names):
            rec[name] = np.concatenate([edges[k] for _, edges in parts])[one]
        del parts
        return _dealt(rec, key[0].as_py(), 1, bundles)

    found = by.cogroup(elsewhere.groupBy("__block")).applyInArrow(suffixes, "bundle int, __block int, data binary")
    done = None
    for depth in (1, 2, 3):
        level = found.groupBy("bundle").applyInArrow(_subtrees(depth, bundles), "bundle int, __block int, data binary")
        part = level.where("bundle < 0").select("__block", F.col("data").alias("names"))
        done = part if done is None else done.unionByName(part)
        found = level.where("bundle >= 0")
    return done


def _dealt(rec: np.ndarray, block: int, depth: int, bundles: int) -> pa.Table:
    """Suffixes of one block by the bundle of their first ``depth`` edges."""
    key = rec["a"]
    if depth > 1:
        key = C.mix(key + C.mix(rec["b"]))
    if depth > 2:
        key = C.mix(key + C.mix(rec["c"]))
    order, at = C.spread((key % U8(bundles)).astype(np.int64), bundles)
    rec, full = rec[order], np.flatnonzero(np.diff(at))
    return pa.table({"bundle": pa.array(full, pa.int32()), "__block": pa.array(np.full(len(full), block), pa.int32()),
                     "data": pa.array([rec[at[i]: at[i + 1]].tobytes() for i in full], pa.binary())})


def _subtrees(depth: int, bundles: int):
    """Builds a bundle's subtrees: per block the names of the windows below deep nodes (bundle -1),
    or, if the bundle is too large and its prefixes can grow, its suffixes for the next depth."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        size, over = 0, False
        for b in batches:
            for block, data in zip(b.column("__block").to_pylist(), b.column("data").to_pylist(), strict=True):
                held.append((block, data))
                size += len(data) // SUFFIX.itemsize
            if depth < 3 and (over or size > BUNDLE_SUFFIXES):
                over = True
                for block, data in held:
                    yield from _dealt(np.frombuffer(data, SUFFIX), block, depth + 1, bundles).to_batches()
                held.clear()
        if over or not held:
            return
        rec = np.frombuffer(b"".join(d for _, d in held), SUFFIX)
        owner = np.repeat(np.arange(len(held)), [len(d) // SUFFIX.itemsize for _, d in held])
        order = np.lexsort((rec["c"], rec["b"], rec["a"]))
        rec, owner = rec[order], owner[order]
        # words that neighbours in the tree's leaf order have in common
        agree = rec["a"][1:] == rec["a"][:-1]
        lcp = agree * EDGES[0]
        agree = agree & (rec["b"][1:] == rec["b"][:-1])
        lcp = lcp + agree * EDGES[1]
        lcp = lcp + (agree & (rec["c"][1:] == rec["c"][:-1])) * EDGES[2]
        deep = np.concatenate([[False], lcp >= WINDOW]) | np.concatenate([lcp >= WINDOW, [False]])
        rec, owner = rec[deep], owner[deep]
        names = name_of(rec["a"], rec["b"], rec["c"])
        order, at = C.spread(owner, len(held))
        names, full = names[order], np.flatnonzero(np.diff(at))
        yield pa.record_batch({"bundle": pa.array(np.full(len(full), -1), pa.int32()),
                               "__block": pa.array([held[i][0] for i in full], pa.int32()),
                               "data": pa.array([names[at[i]: at[i + 1]].tobytes() for i in full], pa.binary())})

    return build


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` with n_words, n_removed, kept (the words that stay, joined by one
    space) and spans (array of (start, end) word positions of the maximal repeated spans). Columns
    of these names are replaced."""
    cols = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept", "spans", "__block")]
    blocks, n = C.blocks_of(docs.select(cols), C.text_bytes(docs), block_bytes)
    found = repeated_windows(blocks, n)
    schema = docs.select(*cols, *(F.lit(None).cast(kind).alias(name) for name, kind in (
        ("n_words", "long"), ("n_removed", "long"), ("kept", "string"), ("spans", "array<struct<start:int,end:int>>")))).schema

    def cut(key: tuple, t: pa.Table, known: pa.Table) -> pa.Table:
        return cut_block(t, known, cols)

    return blocks.groupBy("__block").cogroup(found.groupBy("__block")).applyInArrow(cut, schema)


def cut_block(t: pa.Table, found: pa.Table, cols: list[str]) -> pa.Table:
    """``cols`` of a block's documents with n_words, n_removed, kept and spans; ``found`` has the names of the
    block's windows that occur in another block. Words and bytes are held a piece at a time."""
    if not len(t):
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.schema([(c, t.schema.field(c).type) for c in cols] + [
            ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", span)]).empty_table()
    known = np.sort(np.frombuffer(b"".join(found.column("names").to_pylist()), U8))
    places, named, n_words = [np.zeros(0, np.int64)], [np.zeros(0, U8)], 0
    for _, _, _, first, h in _pieces(t.column("text")):
        at, _ = C.window_starts(first, WINDOW)
        if len(at):
            places.append(at + n_words)
            named.append(window_names(h, at)[1])
        n_words += len(h)
    places, named = np.concatenate(places), np.concatenate(named)
    again = places[_several(named) | _in(named, known)]
    del places, named, known
    # each repeated window adds one where it begins and takes it back behind its end
    gone = np.bincount(again, minlength=n_words + 1) - np.bincount(again + WINDOW, minlength=n_words + 1)
    gone = np.cumsum(gone)[:-1] > 0
    parts, base = [], 0
    for buf, start, end, first, h in _pieces(t.column("text")):
        parts.append(_cut(buf, start, end, first, gone[base: base + len(h)]))
        base += len(h)
    out = {c: t.column(c) for c in cols}
    return pa.table(out | {name: pa.chunked_array([p[k] for p in parts]) for k, name in enumerate(("n_words", "n_removed", "kept", "spans"))})


def _cut(buf: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, gone: np.ndarray) -> tuple[pa.Array, ...]:
    """(n_words, n_removed, kept, spans) of the texts of a piece without the words that are ``gone``."""
    total = np.concatenate([[0], np.cumsum(gone)])
    stay = np.flatnonzero(~gone)
    length = end[stay] - start[stay] + 1  # with a space behind each word
    raw = gather(np.append(buf, np.uint8(32)), start[stay], length)
    stop = np.cumsum(length)
    raw[stop - 1] = 32
    last = np.concatenate([[0], stop])[np.searchsorted(stay, first)]
    data = raw.tobytes()
    kept = [data[a: b - 1] if b > a else b"" for a, b in zip(last[:-1].tolist(), last[1:].tolist(), strict=True)]
    # spans: runs of removed words, cut at document bounds
    mark = np.concatenate([[0], gone.astype(np.int8), [0]])
    edge = np.zeros(len(gone) + 1, bool)
    edge[first] = True
    begins = np.flatnonzero((mark[1:] == 1) & ((mark[:-1] == 0) | edge))
    ends = np.flatnonzero((mark[:-1] == 1) & ((mark[1:] == 0) | edge))
    row = np.searchsorted(first, begins, "right") - 1
    pairs = pa.StructArray.from_arrays([pa.array((begins - first[row]).astype(np.int32)), pa.array((ends - first[row]).astype(np.int32))], ["start", "end"])
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(first))), pa.int32()), pairs)
    return (pa.array(np.diff(first)), pa.array(total[first[1:]] - total[first[:-1]]), pa.array(kept, pa.binary()).cast(pa.string()), spans)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     win AS (SELECT rid, s, array_to_string(w[s : s + 34], ' ') AS t
             FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
     again AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
     gone AS (SELECT DISTINCT rid, unnest(range(s, s + 35)) AS p FROM win JOIN again USING (t)),
     kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n
              FROM (SELECT rid, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d) ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""
