"""An append-only line log in shared storage as a Spark data source: partitions, offsets, resume.

``spark.read`` / ``readStream`` / ``write`` / ``writeStream`` with ``format("linelog")`` and a path. The log
takes the place of a topic where there is no broker: records have a partition and an offset in it,
readers start at the earliest or latest offset and go on from the offsets in their checkpoint, and
what a consumer group has processed is committed under its name.

Layout: tasks write segments (a line per record) under names of their own; a commit on the driver gives
each segment the next offsets of its partition and lists it in a numbered manifest, written under a
temporary name and renamed. What no manifest names is not in the log, so a failed task or job leaves
nothing behind in it. A micro-batch is appended once: its manifest holds the writer's name and the
batch id, and a replayed batch finds them. One driver writes at a time; any number read.

A record's newline and backslash are escaped, a null value is kept, an empty value is a record.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter,
                                    InputPartition, WriterCommitMessage)

from tidemark.sources import store

SCHEMA = "partition int, offset bigint, value string"
SEGMENT_LINES = 250_000  # records after which a task begins another segment
BATCH_ROWS = 10_000
_NULL = "\\N"


def escaped(value: str | None) -> str:
    return _NULL if value is None else value.replace("\\", "\\\\").replace("\n", "\\n").replace("\r", "\\r")


def unescaped(line: str) -> str | None:
    if "\\" not in line:
        return line
    if line == _NULL:
        return None
    return "\\".join(x.replace("\\n", "\n").replace("\\r", "\r") for x in line.split("\\\\"))


@dataclass
class Segment(WriterCommitMessage):
    partition: int
    file: str
    lines: int


@dataclass
class Written(WriterCommitMessage):
    segments: list[Segment]


@dataclass
class Slice(InputPartition):
    """Records ``start`` to ``end`` of a partition, all in one segment that begins at ``base``."""

    file: str
    partition: int
    base: int
    start: int
    end: int

    def __post_init__(self):
        super().__init__(None)


def manifest(path: str) -> list[dict]:
    """The log's commits, in order."""
    return [json.loads(store.get(f"{path}/_log/{n}")) for n in store.names(f"{path}/_log")]


def ends(commits: list[dict]) -> dict[str, int]:
    """Partition -> the offset that the next record gets."""
    out: dict[str, int] = {}
    for c in commits:
        for s in c["segments"]:
            out[str(s["partition"])] = s["base"] + s["lines"]
    return out


def slices(path: str, commits: list[dict], start: dict[str, int], end: dict[str, int]) -> list[Slice]:
    out = []
    for c in commits:
        for s in c["segments"]:
            p = str(s["partition"])
            lo, hi = max(s["base"], start.get(p, 0)), min(s["base"] + s["lines"], end.get(p, 0))
            if lo < hi:
                out.append(Slice(f"{path}/data/{s['file']}", s["partition"], s["base"], lo, hi))
    return out


def read_slice(part: Slice) -> Iterator[pa.RecordBatch]:
    lines = store.get(part.file).decode().split("\n")
    for at in range(part.start, part.end, BATCH_ROWS):
        to = min(part.end, at + BATCH_ROWS)
        values = [unescaped(x) for x in lines[at - part.base: to - part.base]]
        yield pa.record_batch({"partition": pa.array([part.partition] * len(values), pa.int32()),
                               "offset": pa.array(range(at, to), pa.int64()), "value": pa.array(values, pa.string())})


def append(path: str, messages: list[WriterCommitMessage | None], writer: str | None = None, batch: int | None = None) -> None:
    """Give the segments their offsets and list them; a batch that is in the log already is left out."""
    commits = manifest(path)
    if batch is not None and any(c["writer"] == writer and c["batch"] is not None and c["batch"] >= batch for c in commits):
        return
    end, segments = ends(commits), []
    for s in (s for m in messages if m is not None for s in m.segments):
        base = end.get(str(s.partition), 0)
        segments.append({"partition": s.partition, "file": s.file, "base": base, "lines": s.lines})
        end[str(s.partition)] = base + s.lines
    store.put(f"{path}/_log/{len(commits):020d}.json", json.dumps({"writer": writer, "batch": batch, "segments": segments}).encode())


class _Writes:
    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> Written:
        """Rows (partition, value); a partition's records keep their order in the task."""
        held: dict[int, list[str]] = {}
        done: list[Segment] = []

        def close(p: int) -> None:
            lines = held.pop(p)
            name = f"{p:05d}-{uuid.uuid4().hex}.log"
            store.put(f"{self.path}/data/{name}", ("\n".join(lines) + "\n").encode())
            done.append(Segment(p, name, len(lines)))

        for row in rows:
            p = int(row["partition"] or 0)
            held.setdefault(p, []).append(escaped(row["value"]))
            if len(held[p]) >= SEGMENT_LINES:
                close(p)
        for p in sorted(held):
            close(p)
        return Written(done)

    def abort(self, *_) -> None:
        """Segments without a manifest are not in the log."""


class LineLogWriter(_Writes, DataSourceWriter):
    def commit(self, messages: list) -> None:
        append(self.path, messages)


class LineLogStreamWriter(_Writes, DataSourceStreamWriter):
    def __init__(self, path: str, writer: str):
        super().__init__(path)
        self.writer = writer

    def commit(self, messages: list, batchId: int) -> None:
        append(self.path, messages, self.writer, batchId)


class LineLogReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Slice]:
        commits = manifest(self.path)
        return slices(self.path, commits, {}, ends(commits)) or [Slice("", 0, 0, 0, 0)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        return read_slice(part) if part.file else iter(())


class LineLogStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str, group: str | None):
        self.path, self.starting, self.group = path, starting, group

    def initialOffset(self) -> dict:
        if self.starting == "latest":
            return ends(manifest(self.path))
        return committed(self.path, self.group) if self.starting == "committed" and self.group else {}

    def latestOffset(self) -> dict:
        return ends(manifest(self.path))

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return slices(self.path, manifest(self.path), start, end) or [Slice("", 0, 0, 0, 0)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        return read_slice(part) if part.file else iter(())

    def commit(self, end: dict) -> None:
        if self.group:
            store.put(f"{self.path}/_groups/{self.group}.json", json.dumps(end).encode())


def committed(path: str, group: str) -> dict[str, int]:
    """What a consumer group has committed: partition -> next offset. Spark commits a micro-batch when it
    plans the next one, so this trails the query's checkpoint, which is what a restart goes by."""
    return json.loads(store.get(f"{path}/_groups/{group}.json")) if f"{group}.json" in store.names(f"{path}/_groups") else {}


class LineLog(DataSource):
    """Options: path; for streams startingOffsets (earliest, latest or committed), group; for stream
    writers writer, a name that stays the same over restarts."""

    @classmethod
    def name(cls) -> str:
        return "linelog"

    def schema(self) -> str:
        return SCHEMA

    def _path(self) -> str:
        return self.options["path"].rstrip("/")

    def reader(self, schema) -> LineLogReader:
        return LineLogReader(self._path())

    def streamReader(self, schema) -> LineLogStreamReader:
        return LineLogStreamReader(self._path(), self.options.get("startingOffsets", "earliest"), self.options.get("group"))

    def writer(self, schema, overwrite: bool) -> LineLogWriter:
        if overwrite:
            raise ValueError("a line log is only appended to")
        return LineLogWriter(self._path())

    def streamWriter(self, schema, overwrite: bool) -> LineLogStreamWriter:
        return LineLogStreamWriter(self._path(), self.options.get("writer", "stream"))


def register(spark: SparkSession) -> None:
    """Make ``format("linelog")`` known to the session."""
    spark.dataSource.register(LineLog)


def append_lines(df: DataFrame, path: str) -> None:
    """Append rows (partition, value)."""
    register(df.sparkSession)
    df.select("partition", "value").write.format("linelog").mode("append").save(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("linelog").load(path)


def stream_log(spark: SparkSession, path: str, starting: str = "earliest", group: str | None = None) -> DataFrame:
    register(spark)
    r = spark.readStream.format("linelog").option("startingOffsets", starting)
    return (r.option("group", group) if group else r).load(path)
