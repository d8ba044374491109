"""Deterministic sharded WARC archives.

Pages are range-sorted by (page_id, payload digest) and each range streams its records into files
that are closed by compressed size. The ranges come from exact sums of bytes over the page_ids, not
from a sample, and a file is named by its range and its place in it, so that any run over the same
pages, from any number of partitions, writes the same files. Headers and digests are made anew from
the payload; nothing in a record depends on the clock, the attempt or the machine.
A file is written under a temporary name of its attempt and renamed; the manifest, a table that
Spark commits when all files are there, is what readers go by.

Records are WARC/1.1, each its own gzip member: a ``response`` holds the payload, a ``revisit`` (the
identical-payload-digest profile) only its headers. Of the pages with equal payloads of at least
``REVISIT_BYTES``, that with the largest page_id is the response.

Defined results: null html is an empty payload; null page_ids come first and are smaller than any
other; of rows with one page_id and one payload the first is the response if that page_id is the
group's largest, and the others revisit it. The url is a header; a null url leaves it out. A payload
of any length is one record. Columns other than page_id, url and html are not read, whatever their
names; an empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

REVISIT_BYTES = 1000
FILE_BYTES = 16 << 20  # compressed size that closes a file
RANGE_BYTES = 32 << 20  # payload bytes of a range of page_ids, about
RECORD_BYTES = 512  # what a record has besides its payload, about
DATE = "1970-01-01T00:00:00Z"  # the tables carry no crawl time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tidemark:warc")


def gzip_member(data: bytes) -> bytes:
    """One gzip member without time or name, so that equal data give equal bytes."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, record_id: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *fields,
            ("WARC-Block-Digest", _digest(block)), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip_member(text.encode() + block + b"\r\n\r\n")


def _one_line(s: str) -> str:
    return " ".join(s.split())


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, target: int | None) -> bytes:
    digest = _digest(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    fields = [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")]
    if url is not None and (target_url := _one_line(url)):
        fields.append(("WARC-Target-URI", target_url))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if not revisit:
        return _record("response", record_id(page_id, digest), fields, http + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(target, digest))]
    if target is not None:
        fields.append(("X-Refers-To-Page-Id", str(target)))
    # a page that repeats its own id needs a record id of its own
    return _record("revisit", record_id(page_id, f"{digest}/revisit/{target}"), fields, http)


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, target): the rows whose payload an equal one with a larger page_id holds.
    Copies are pre-aggregated per digest; only ids and digests are shuffled."""
    light = pages.select("page_id", "digest").where(F.col("bytes") >= least)
    heads = light.groupBy("digest").agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1")
    return (light.join(heads, "digest").where(~F.col("page_id").eqNullSafe(F.col("target")))
            .select("page_id", "digest", "target"))


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, least: int = REVISIT_BYTES,
               range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the archives. Lazy; returns the manifest (file, n_records, bytes, sha256)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    sizes = pages.select(F.col("page_id").cast("long").alias("page_id"), (F.coalesce(F.octet_length("html"), F.lit(0)) + RECORD_BYTES).cast("long").alias("w"))
    firsts = C.key_ranges(sizes, "page_id", "w", range_bytes)
    marks = revisits(rows, least).select("page_id", "digest", F.lit(True).alias("mark"), "target",
                                         F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    both = rows.select("page_id", "digest", F.lit(False).alias("mark"), F.lit(None).cast("long").alias("target"), "url", "html") \
        .unionByName(marks)
    key = [F.col("page_id").asc_nulls_first(), F.col("digest").asc()]
    # marks come before the pages they speak of; equal page_ids share a range, and a range a task: which
    # one does not matter
    both = C.range_number(both, "page_id", firsts, "part").select("part", *both.columns)
    both = both.repartition(len(firsts) + 1, "part").sortWithinPartitions("part", *key, F.desc("mark"), F.asc_nulls_first("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag, held = C.attempt_name(), []
        part = made = size = count = 0
        mark: tuple | None = None  # (page_id, digest) and target of the last mark
        last: tuple | None = None  # (page_id, digest) of the last page

        def close() -> pa.RecordBatch:
            nonlocal made, size, count
            name = f"pages-{part:06d}-{made:06d}.warc.gz"
            info = _record("warcinfo", f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>",
                           [("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                           b"format: WARC File Format 1.1\r\n")
            data = info + b"".join(held)
            C.put_file(f"{folder}/{name}", data, tag)
            out = pa.record_batch({"file": [name], "n_records": [count], "bytes": [len(data)],
                                   "sha256": [hashlib.sha256(data).hexdigest()]})
            held.clear()
            made, size, count = made + 1, 0, 0
            return out

        for b in batches:
            for of, page, digest, is_mark, target, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if of != part:
                    if held:
                        yield close()
                    part, made = of, 0
                if is_mark:
                    mark = ((page, digest), target)
                    continue
                payload = html.encode()
                again = last == (page, digest) and len(payload) >= least
                marked = mark is not None and mark[0] == (page, digest)
                raw = page_record(page, url, payload, marked or again, mark[1] if marked else page)
                last = (page, digest)
                held.append(raw)
                size, count = size + len(raw), count + 1
                if size >= file_bytes:
                    yield close()
        if held:
            yield close()

    return both.mapInArrow(run, "file string, n_records long, bytes long, sha256 string")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive, one gzip member at a time."""
    at = 0
    while at < len(data):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:  # in small pieces: what is left behind a member is copied by the decompressor
            piece = data[at: at + (1 << 15)]
            if not piece:
                raise ValueError("the archive ends within a record")
            parts.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        raw = b"".join(parts)
        head, _, tail = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC/1.1 record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        block = tail[: int(fields["Content-Length"])]
        if fields["WARC-Block-Digest"] != _digest(block):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        yield fields, block


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per page record of the manifest's files: page_id, url, record_type, payload_bytes,
    payload_digest (hexadecimal), refers_to, payload (null for revisits). A file that differs from
    its manifest entry, or a response whose payload differs from its digest, is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, sha in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = C.get_file(f"{folder}/{name}")
                if hashlib.sha256(data).hexdigest() != sha:
                    raise ValueError(f"{name} differs from its manifest")
                rows, size = [], 0
                for f, block in parse_records(data):
                    if f["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
                    digest = base64.b32decode(f["WARC-Payload-Digest"][5:]).hex()
                    full = f["WARC-Type"] == "response"
                    if full and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"damaged payload in {f['WARC-Record-ID']}")
                    page, target = f.get("X-Page-Id"), f.get("X-Refers-To-Page-Id")
                    rows.append((int(page) if page else None, f.get("WARC-Target-URI"), f["WARC-Type"], length, digest,
                                 int(target) if target else None, payload.decode() if full else None))
                    size += len(payload)
                    if size > C.PIECE_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return C.one_task_each(manifest.select("file", "sha256"), manifest.count()).mapInArrow(run, SCHEMA)


SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload string")
TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = C.shared(spark, "warc")
    write_warc(C.table(spark, sf_dir, "pages"), folder).write.parquet(f"{folder}/manifest")
    out = read_warc(spark.read.parquet(f"{folder}/manifest"), folder)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest,
                  CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS bytes FROM pages),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS head, row_number() OVER (PARTITION BY digest, page_id) AS nth FROM p),
     r AS (SELECT *, bytes >= 1000 AND (nth > 1 OR page_id IS DISTINCT FROM head) AS again FROM m)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN head END AS refers_to
FROM r"""
