"""Jaccard join of documents on word shingles, by PartEnum signatures.

A document's set holds its distinct 5-word shingles as 64-bit hashes (equal sets form one class,
named by a 64-bit hash of the set). Two sets are linked when ``100 * |A and B| >= 80 * |A or B|``.

Candidates. The size bands (up to 64, 128, 256, ... shingles) each partition the hash domain. A set
signs in its own band, and in the next one if it can be linked with a set there. The content of a
partition, hashed, is a signature. Sets of sizes a and b that are linked differ in at most
``min(a, b) / 4`` elements, hence in at most as many partitions; so of a set's partitions, ordered
by their content (fullest first), the first ``a/4 + 1 + a/16`` always hold ``1 + a/20`` that both
sets have in common and both sign. Two prunings follow without loss:

* a set with fewer than ``1 + a/20`` signatures that occur elsewhere has no link in that band;
* of its n signatures that occur elsewhere, the rarest ``n - a/20`` suffice.

A set whose shingles fill too few partitions for this to hold (chance makes it possible) names its
band; such a band is partitioned down to single elements, where it always holds.

Verification is exact, on the sets. First every member of a signature group is compared with one
hub only, the member that shares signatures with most sets (the text that near copies were made
from, if it is there); links are joined to components, and groups that span several get another hub,
a few times. Groups that still span several components are then searched in blocks by bitmaps of
element parities: two sets whose bitmaps differ in more bits than linked sets may differ in elements
cannot be linked. What remains, between components, is verified. So copies are not expanded into
pairs, and no link that joins two components is lost.

Defined results: null or wordless text has an empty set and links with nothing; a text of one to
four words has one shingle, the whole; rows with equal doc_id are rows of their own; the smallest
id of a component disregards nulls. A text of any length is one set, made by one task. Columns other
than doc_id and text are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.bpe import gather
from tidemark.llm.graph import components
from tidemark.session import write_table

SHINGLE = 5
FIRST_BAND = 64
BUCKET_BYTES = 4 << 20  # text bytes whose signatures one reducing group gets, about
GROUP_BLOCK = 1024  # members of a signature group that are searched together
KNOWN_KEYS = 1_000_000  # up to so many keys (8 bytes each) are broadcast to pick texts
PIECE_ROWS = 1 << 12
HUB_ROUNDS = 1
U8 = np.uint64
RECORD = np.dtype([("sig", "<u8"), ("id", "<u8")])


def shingle_sets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of each text, sorted, and where each text's begin. At
    most PIECE_ROWS texts: text number and 52 bits of hash are sorted as one integer."""
    low = C.LOWER[buf]
    start, end, first = C.word_spans(low, off)
    h = C.word_hashes(low, start, end)
    count = np.diff(first)
    at, rows = C.window_starts(first, SHINGLE)
    sums = C.prefix_sums(h)
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    grams = np.concatenate([C.range_hash(sums, at, at + SHINGLE), C.range_hash(sums, first[few], first[few + 1])])
    key = np.concatenate([rows, few]).astype(U8) << U8(52) | grams >> U8(12)
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return C.mix(key & U8((1 << 52) - 1)), np.searchsorted(key >> U8(52), np.arange(len(off), dtype=U8))


def set_ids(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, from its elements and its size."""
    s = np.concatenate([np.zeros(1, U8), np.cumsum(C.mix(hashes ^ U8(0x51ED27A3C0FFEE11)), dtype=U8)])
    return C.mix((s[first[1:]] - s[first[:-1]]) ^ C.mix(np.diff(first).astype(U8)))


def band(sizes: np.ndarray) -> np.ndarray:
    """Band 0 holds sizes up to FIRST_BAND, each further band twice as much."""
    over = np.maximum(-(-sizes // FIRST_BAND), 1)
    return np.ceil(np.log2(over)).astype(np.int64)


def signatures(hashes: np.ndarray, first: np.ndarray, fine: frozenset[int]) -> tuple[np.ndarray, np.ndarray, set[int]]:
    """(set number, signature) of all sets, and the bands that must be partitioned to single
    elements because some set fills too few partitions. A signature's low 5 bits are its band."""
    sizes = np.diff(first)
    own = band(sizes)
    reaches = sizes * 100 >= 80 * ((FIRST_BAND << own) + 1)
    failed: set[int] = set()
    out_row, out_sig = [], []
    for step in (0, 1):
        rows = np.flatnonzero((sizes > 0) & (reaches if step else True))
        if not len(rows):
            continue
        n = sizes[rows]
        h = gather(hashes, first[rows], n)
        row, tag = np.repeat(rows, n), np.repeat(own[rows] + step, n)
        top = (FIRST_BAND << tag).astype(np.float64)
        # partitions hold 1.5 elements of the largest sets in band 1, 2.2 above; in band 0 hardly two
        # elements meet in one
        parts = np.where(tag == 0, 1 << 20, np.minimum(top / np.where(tag == 1, 1.5, 2.2), 1 << 20)).astype(U8)
        m = C.mix(h + tag.astype(U8) * U8(0xA24BAED4963EE407))
        single = np.isin(tag, list(fine)) if fine else np.zeros(1, bool)
        if single.any():  # whole hashes as partitions: each element its own
            order = np.lexsort((np.where(single, m, (m >> U8(32)) % parts), row))
            part, row, tag, m = np.where(single, m, (m >> U8(32)) % parts)[order], row[order], tag[order], m[order] & U8(0xFFFFFFFF)
            new = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (row[1:] != row[:-1])]))
            row, tag, part = row[new], tag[new], part[new]
        else:  # row, partition and 32 bits of the element sorted as one integer
            key = row.astype(U8) << U8(52) | (m >> U8(32)) % parts << U8(32) | m & U8(0xFFFFFFFF)
            key.sort()
            place, m = key >> U8(32), key & U8(0xFFFFFFFF)
            new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            row, part = (place[new] >> U8(20)).astype(np.int64), place[new] & U8((1 << 20) - 1)
            tag = own[row] + step
        fill = np.diff(np.append(new, len(m)))
        content = np.add.reduceat(C.mix(m), new)
        sig = C.mix(content ^ C.mix(part + U8(1)) ^ fill.astype(U8)) & ~U8(31) | tag.astype(U8)
        # fullest partitions first; equal contents stand at equal places in any set
        order = np.argsort(row.astype(U8) << U8(52) | U8(255) - np.minimum(fill, 255).astype(U8) << U8(44) | sig >> U8(20))
        row, sig, tag = row[order], sig[order], tag[order]
        begin = np.searchsorted(row, rows)
        place = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
        size = sizes[row]
        need = size // 4 + 1 + size // 16
        filled = np.diff(np.append(begin, len(row)))
        short = filled < n // 4 + 1 + n // 16
        failed |= set((own[rows[short]] + step).tolist())
        keep = place < need
        out_row.append(row[keep])
        out_sig.append(sig[keep])
    if not out_row:
        return np.zeros(0, np.int64), np.zeros(0, U8), failed
    return np.concatenate(out_row), np.concatenate(out_sig), failed


def _sets_of(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    buf, off = C.text_buffers(col)
    for i, j in C.pieces(off, rows=PIECE_ROWS):
        yield i, j, *shingle_sets(buf[off[i]: off[j]], off[i: j + 1] - off[i])


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, n, id): size and name of each document's set; ``tk`` is a hash of the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, h, first in _sets_of(b.column(2)):
                yield pa.record_batch({"doc_id": b.column(0).slice(i, j - i), "tk": b.column(1).slice(i, j - i),
                                       "n": pa.array(np.diff(first).astype(np.int64)),
                                       "id": pa.array(set_ids(h, first).view(np.int64))})

    return docs.select("doc_id", F.xxhash64("text").alias("tk"), "text").mapInArrow(
        run, f"doc_id {kind}, tk long, n long, id long")


def shared_signatures(docs: DataFrame, buckets: int, fine: frozenset[int]) -> DataFrame:
    """(sig, id, freq) for every signature that several classes have; rows without an id name, in
    ``sig``, a band to be partitioned to single elements."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, h, first in _sets_of(b.column(0)):
                ids = set_ids(h, first)
                _, one = np.unique(ids, return_index=True)  # copies in a piece sign once
                n = np.diff(first)[one]
                row, sig, failed = signatures(gather(h, first[one], n), np.concatenate([[0], np.cumsum(n)]), fine)
                rec = np.zeros(len(sig), RECORD)
                rec["sig"], rec["id"] = sig, ids[one][row]
                order, at = C.spread((C.mix(sig) % U8(buckets)).astype(np.int64), buckets)
                rec = rec[order]
                full = np.flatnonzero(np.diff(at))
                # one group of its own per failed band, so that every reducer sees plain records
                yield pa.record_batch({
                    "bucket": pa.array([*full.tolist(), *(-1 - t for t in sorted(failed))], pa.int32()),
                    "data": pa.array([*(rec[at[i]: at[i + 1]].tobytes() for i in full), *[b""] * len(failed)], pa.binary())})

    def reduce(key: tuple, t: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket < 0:
            return pa.table({"sig": pa.array([-1 - bucket], pa.int64()), "id": pa.nulls(1, pa.int64()), "freq": pa.nulls(1, pa.int64())})
        rec = np.frombuffer(b"".join(t.column("data").to_pylist()), RECORD)
        sig, ids = rec["sig"], rec["id"]
        order = np.lexsort((ids, sig))
        sig, ids = sig[order], ids[order]
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])])
        sig, ids = sig[new], ids[new]
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        freq = np.repeat(np.diff(np.append(start, len(sig))), np.diff(np.append(start, len(sig))))
        keep = freq > 1
        return pa.table({"sig": sig[keep].view(np.int64), "id": ids[keep].view(np.int64), "freq": freq[keep].astype(np.int64)})

    return (docs.select("text").mapInArrow(sign, "bucket int, data binary")
            .groupBy("bucket").applyInArrow(reduce, "sig long, id long, freq long"))


def rarest(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(sig, id, n, known): the signatures that candidates must be sought by; ``known`` tells how
    many sets share signatures with this one, in all."""
    w = Window.partitionBy("id", "tag")
    rows = shared.join(classes, "id").withColumn("tag", F.expr("sig & 31"))
    rows = rows.withColumn("have", F.count("*").over(w)).withColumn("known", F.sum("freq").over(w)) \
        .withColumn("place", F.row_number().over(w.orderBy("freq", "sig")))
    return rows.where("have > n DIV 20 AND place <= have - n DIV 20").select("sig", "id", "n", "known")


def parity_bitmaps(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Per set a bitmap of four to eight bits per element (a power of two, 256 at least): bit i tells
    whether an odd number of elements fall on i. Halving a bitmap by exclusive or is the bitmap of
    half as many bits, so that bitmaps of different lengths can be compared."""
    sizes = np.diff(first)
    bits = 256 << np.maximum(np.ceil(np.log2(np.maximum(sizes, 1) / 64)), 0).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(bits)])
    where = (C.mix(hashes) % np.repeat(bits, sizes).astype(U8)).astype(np.int64) + np.repeat(at[:-1], sizes)
    odd = (np.bincount(where, minlength=int(at[-1])) & 1).astype(np.uint8)
    raw = np.packbits(odd, bitorder="little").tobytes()
    return [raw[a // 8: b // 8] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def pick_sets(docs: DataFrame, sets: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, elements, bits) of the classes named in ``ids``, from one text of each."""
    keys = write_table(sets.join(ids, "id").groupBy("id").agg(F.min("tk").alias("tk")).select("tk").distinct(), "text-keys")
    small = keys.count() <= KNOWN_KEYS  # a size check, not a cap: the join follows either way
    texts = docs.select("text", F.xxhash64("text").alias("tk")).join(F.broadcast(keys) if small else keys, "tk", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, h, first in _sets_of(b.column(0)):
                names, one = np.unique(set_ids(h, first), return_index=True)
                n = np.diff(first)[one]
                h, at = gather(h, first[one], n), np.concatenate([[0], np.cumsum(n)])
                yield pa.record_batch({"id": pa.array(names.view(np.int64)), "n": pa.array(n.astype(np.int64)),
                                       "elements": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64))),
                                       "bits": pa.array(parity_bitmaps(h, at), pa.binary())})

    found = texts.select("text").mapInArrow(run, "id long, n long, elements array<long>, bits binary")
    return found.dropDuplicates(["id"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that are linked, by exact intersection."""
    a = sets.select(F.col("id").alias("u"), F.col("elements").alias("x"))
    b = sets.select(F.col("id").alias("v"), F.col("elements").alias("y"))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", F.size("x").alias("nx"), F.size("y").alias("ny"),
                                                  F.size(F.array_intersect("x", "y")).alias("common"))
    return both.where("100 * common >= 80 * (nx + ny - common)").select("u", "v")


def rooted(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """``groups`` with the component of each member, and only the groups that span several."""
    rows = groups.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    spans = rows.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c")).where("lo <> hi")
    return rows.join(spans.select("sig", "c"), "sig")


def star_pairs(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Each member of a signature group with the best connected member that has not been a hub of
    the group yet (``hubs``: sig, id) and is of another component."""
    fresh = rows.join(hubs, ["sig", "id"], "left_anti")
    heads = fresh.groupBy("sig").agg(F.max(F.struct("known", "id", "n", "root")).alias("head"))
    met = rows.join(heads, "sig").where("root <> head.root AND 80 * n <= 100 * head.n AND 80 * head.n <= 100 * n")
    return met.select("sig", F.col("head.id").alias("hub"), F.least("id", "head.id").alias("u"), F.greatest("id", "head.id").alias("v"))


def cross_pairs(groups: DataFrame, sets: DataFrame, roots: DataFrame, buckets: int) -> DataFrame:
    """Pairs of one signature group in different components that sizes and bitmaps allow. Large
    groups are cut into blocks; each pair of blocks is a group of its own."""
    rows = rooted(groups, roots).withColumn("blocks", F.expr(f"CAST((c - 1) DIV {GROUP_BLOCK} + 1 AS INT)"))
    rows = rows.withColumn("b", F.expr("pmod(hash(id), blocks)")).withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select("sig", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), "b", "id", "root", "n")
    rows = rows.join(sets.select("id", "bits"), "id").withColumn("key", F.xxhash64("sig", "bi", "bj"))
    # a task handles many groups in one call
    rows = rows.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))

    def compare(t: pa.Table) -> pa.Table:
        key = t.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        key, ids, root, block, n = (t.column(c).to_numpy()[order] for c in ("key", "id", "root", "b", "n"))
        apart = (t.column("bi").to_numpy() != t.column("bj").to_numpy())[order]  # a pair of blocks: members meet across
        maps = Bitmaps(t.column("bits").take(pa.array(order)))
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        left = np.repeat(start + size, size) - np.arange(len(key))  # members of the group from here on
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
        i, step = np.arange(len(key)), 1
        while len(i := i[left[i] > step]):  # each member with the one ``step`` places on
            j = i + step
            ok = (root[i] != root[j]) & (80 * n[i] <= 100 * n[j]) & (80 * n[j] <= 100 * n[i]) & (~apart[i] | (block[i] != block[j]))
            a, b = i[ok], j[ok]
            if len(a):
                near = 9 * maps.differ(a, b) <= n[a] + n[b]
                out.append((ids[a[near]], ids[b[near]]))
            step += 1
        u, v = (np.concatenate(x) for x in zip(*out, strict=True))
        pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
        return pa.table({"u": pairs[0], "v": pairs[1]})

    return rows.groupBy("bucket").applyInArrow(compare, "u long, v long").distinct()


class Bitmaps:
    """Parity bitmaps of several lengths, one matrix per length."""

    def __init__(self, bits: pa.ChunkedArray):
        raw, off = C.text_buffers(bits)
        self.size = np.diff(off)
        self.place = np.zeros(len(self.size), np.int64)
        self.rows = {}
        for s in np.unique(self.size).tolist():
            at = np.flatnonzero(self.size == s)
            self.place[at] = np.arange(len(at))
            # whole numbers of 8 bytes, each eight of which need one index
            self.rows[s] = gather(raw.view(U8), off[at] // 8, self.size[at] // 8).reshape(len(at), -1)

    def _take(self, at: np.ndarray, own: int, to: int) -> np.ndarray:
        rows = self.rows[own][self.place[at]]
        while own > to:
            own //= 2
            rows = rows[:, : own // 8] ^ rows[:, own // 8:]
        return rows

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many bits the maps of ``a`` and ``b`` differ, at the shorter length of the two."""
        out = np.zeros(len(a), np.int64)
        kind = self.size[a] << 32 | self.size[b]
        for k in np.unique(kind).tolist():
            x, y, to = k >> 32, k & 0xFFFFFFFF, min(k >> 32, k & 0xFFFFFFFF)
            every = np.flatnonzero(kind == k)
            for i in range(0, len(every), max(1, (1 << 23) // to)):  # a bounded number of bytes at a time
                at = every[i: i + max(1, (1 << 23) // to)]
                out[at] = np.bitwise_count(self._take(a[at], x, to) ^ self._take(b[at], y, to)).sum(axis=1)
        return out


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, class_id, root) per document: component_id is
    the smallest doc_id of the documents that links reach from it, root names the component (null
    without words), class_id the document's set, text_key is a hash of its text."""
    spark = docs.sparkSession
    sets = write_table(document_sets(docs), "shingle-sets")
    classes = sets.where("n > 0").select("id", "n").distinct()
    buckets = max(1, -(-C.text_bytes(docs) // BUCKET_BYTES))
    fine: frozenset[int] = frozenset()
    while True:
        shared = write_table(shared_signatures(docs, buckets, fine), "shared-signatures")
        failed = {r.sig for r in shared.where("id IS NULL").select("sig").distinct().collect()}  # bands, a few dozen at most
        if failed <= fine:
            break
        fine |= failed
    groups = write_table(rarest(shared.where("id IS NOT NULL"), classes), "signature-groups")
    picked = write_table(pick_sets(docs, sets, groups.select("id").distinct()), "candidate-sets")
    none = spark.range(0).where("false")  # known to be empty: no plan keeps a join with it
    links, hubs = none.selectExpr("id AS u", "id AS v"), none.selectExpr("id AS sig", "id")
    roots = none.selectExpr("id AS node", "id AS root")
    for _ in range(HUB_ROUNDS):
        met = write_table(star_pairs(rooted(groups, roots), hubs), "hub-pairs")
        found = write_table(verified(met.select("u", "v").distinct(), picked), "links")
        links = links.unionByName(found)
        hubs = hubs.unionByName(met.select("sig", F.col("hub").alias("id")).distinct())
        if found.take(1):
            roots = components(links)
        elif not met.take(1):
            break
    more = write_table(verified(cross_pairs(groups, picked, roots, buckets), picked), "links")
    roots = components(links.unionByName(more)) if more.take(1) else roots
    rows = sets.where("n > 0").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = rows.groupBy("root").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "root").select("doc_id", "tk", "n", F.col("least").alias("component_id"), "id", "root")
    wordless = sets.where("n = 0").select("doc_id", "tk", "n", F.col("doc_id").alias("component_id"), "id", F.lit(None).cast("long").alias("root"))
    return out.unionByName(wordless).withColumnsRenamed({"tk": "text_key", "n": "n_shingles", "id": "class_id"})


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     sh AS (SELECT DISTINCT rid, array_to_string(w[s : s + 4], ' ') AS t
            FROM (SELECT rid, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS s FROM d WHERE len(w) > 0)),
     size AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
     common AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b ON a.t = b.t AND a.rid < b.rid GROUP BY 1, 2),
     link AS (SELECT x, y FROM common JOIN size a ON a.rid = x JOIN size b ON b.rid = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
     edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
     reach AS (SELECT rid, rid AS r FROM d UNION SELECT reach.rid, edge.y FROM reach JOIN edge ON reach.r = edge.x)
SELECT a.doc_id, CAST(coalesce(any_value(size.n), 0) AS BIGINT) AS n_shingles, min(b.doc_id) AS component_id
FROM reach JOIN d a ON a.rid = reach.rid JOIN d b ON b.rid = reach.r LEFT JOIN size ON size.rid = a.rid GROUP BY a.rid, a.doc_id"""
