"""Structure repair of conversations by depth-first branch-and-bound.

A row's first fault counts: blank (no word), duplicate (role and text seen earlier in the
conversation), truncated (its last character that is no space ends no sentence). A repair keeps,
reroles or deletes each row and may insert empty turns, so that role initials read
``(s?(ua)+)?``; of all cheapest repairs that with the least audit, in ASCII order, is taken.

The search. A node is (rows done, last initial). An explicit stack holds open nodes; the children of a
node are pushed so that audits are visited in ASCII order, hence a prefix that comes later to a node
at the same cost has a larger audit, and one table of costs per node tells which prefixes are
dominated. Suffix bounds, taken backwards once, are the cheapest repair of the rows still to come
for a conversation whose last initial is u or a; for one that has no output yet it is the bound
behind an a less one deletion (a system row kept first), which no repair can beat. A first dive along
the bounds gives the incumbent (cost, audit). The stack runs empty when optimality is proved. Bounds
are within a few units of the truth, so a node is opened a few times at most and the work is linear
in the rows.

Two passes, so that texts are never held. The first shuffles a row's key, role and faults, marks
duplicates inside each conversation and streams one byte a row into the search. The second streams
the texts behind the audit that it meets first, and emits repaired rows or their digest. A task keeps
for one conversation some 24 bytes a row while it searches, a byte a row while it writes; a digest
over a conversation's rows is taken in one stream by its nature.

Defined results. Nulls: a null role or text is one space, a null conv_id or turn is one space in the
hash that damages rows; null conv_ids are one conversation. Rows of equal turn are ordered by role,
then by the md5 of their text. A role's initial is its first character; a role without characters,
or with another initial, has no legal place. Repeated rows are duplicates; texts of any length
stream; columns other than conv_id, turn, role and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.session import write_table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs
INITIALS = "sua"
NONE, S, U, A = range(4)  # last initial of the rows put out so far
GOOD, BLANK, DUPLICATE, CUT = range(4)  # faults
GHOST = 255  # code of a row that the damage drops: it only names its conversation
SHORT = 64  # rows up to which equal conversations are searched once
OUT_ROWS = 4096
_SPACES = " \t\n\x0b\x0c\r"
_NAMES = {U: "user", A: "assistant"}


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, ghost) after the damage that the hash of ``conv_id:turn`` names; a
    dropped row stays as a ghost without role and text."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    rows = rows.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").when(F.col("kind") != 0, F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).when(F.col("kind") != 0, F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("ghost"), F.explode(F.expr("IF(kind = 3, array(0, 1), array(0))")).alias("again")).drop("again")


def _order(*first: str) -> list[Column]:
    return [*(F.col(c).asc_nulls_first() for c in (*first, "turn", "role", "tk"))]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("tk", F.md5(F.col("text").cast("binary")))


def coded(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, code) in each conversation's order, conversations whole in a partition: the code
    is initial + 4 * fault, or GHOST."""
    end = F.rtrim("text", F.lit(_SPACES))
    light = _keyed(rows).select("conv_id", "turn", "role", "tk", "ghost", (end == "").alias("blank"),
                                (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # one shuffle: what is dealt by conversation is also dealt by conversation, role and text
    light = light.repartition("conv_id")
    seen = Window.partitionBy("conv_id", "ghost", "role", "tk").orderBy(F.col("turn").asc_nulls_first())
    light = light.withColumn("again", F.row_number().over(seen) > 1)
    fault = F.when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE).when(F.col("cut"), CUT).otherwise(GOOD)
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    return light.sortWithinPartitions(*_order("conv_id")).select(
        "conv_id", "turn", F.when(F.col("ghost"), GHOST).otherwise(initial + 4 * fault).cast("int").alias("code"))


def suffix_bounds(codes: bytes) -> tuple[array, array]:
    """Cheapest repair of the rows from each place on, behind a u and behind an a."""
    n = len(codes)
    behind_u, behind_a = array("q", bytes(8 * (n + 1))), array("q", bytes(8 * (n + 1)))
    u, a = INSERT, 0
    behind_u[n], behind_a[n] = u, a
    for i in range(n - 1, -1, -1):
        fault, initial = codes[i] >> 2, codes[i] & 3
        x, y = DELETE + u, DELETE + a
        if fault != BLANK and fault != DUPLICATE:
            extra = TRUNCATED if fault == CUT else 0
            x = min(x, extra + a + (0 if initial == 2 else REROLE))
            y = min(y, extra + u + (0 if initial == 1 else REROLE))
        u, a = min(x, INSERT + y), min(y, INSERT + x)
        behind_u[i], behind_a[i] = u, a
    return behind_u, behind_a


def _children(codes: bytes, i: int, last: int) -> list[tuple[str, int, int, int]]:
    """(edit, rows done, last initial, cost) of a node, in ASCII order of the edits."""
    after = A if last == U else U  # what may follow besides a system row at the very start
    out = []
    if i < len(codes):
        out.append(("D", i + 1, last, DELETE))
    out.append(("I", i, after, INSERT))
    if i < len(codes):
        fault, initial = codes[i] >> 2, codes[i] & 3
        if fault != BLANK and fault != DUPLICATE:
            extra = TRUNCATED if fault == CUT else 0
            if initial == 0 and last == NONE:
                out.append(("K", i + 1, S, extra))
            elif initial < 3 and initial + 1 == after:
                out.append(("K", i + 1, after, extra))
            out.append(("R", i + 1, after, REROLE + extra))
    return out


def search(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair with the least audit."""
    n = len(codes)
    behind_u, behind_a = suffix_bounds(codes)

    def bound(i: int, last: int) -> int:
        return behind_u[i] if last == U else behind_a[i] if last else max(0, behind_a[i] - DELETE)

    def ends(i: int, last: int) -> bool:
        return i == n and (last == NONE or last == A)

    i, last, cost, path = 0, NONE, 0, []
    while not ends(i, last):  # the first dive; without output yet it goes by the bound behind an a
        edit, i, last, more = min(_children(codes, i, last), key=lambda c: (c[3] + bound(c[1], c[2] or A), c[1] == i, c[0]))
        cost += more
        path.append(edit)
    best, found = (cost, "".join(path)), False
    table = array("q", [best[0] + 1]) * (4 * (n + 1))  # per node the least cost of a prefix so far
    path, stack = [], [("", 0, NONE, 0, 0)]
    while stack:
        edit, i, last, cost, depth = stack.pop()
        least = cost + bound(i, last)
        if least > best[0] or (found and least == best[0]) or table[4 * i + last] <= cost:
            continue
        table[4 * i + last] = cost
        del path[max(0, depth - 1):]
        if edit:
            path.append(edit)
        if ends(i, last) and ((cost, audit := "".join(path)) < best or not found):
            best, found = min(best, (cost, audit)), True  # later ones of this cost have larger audits
        for e, j, after, more in reversed(_children(codes, i, last)):
            stack.append((e, j, after, cost + more, depth + 1))
    return best


@functools.lru_cache(1 << 14)
def _short(codes: bytes) -> tuple[int, str]:
    return search(codes)


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation of ``rows``
    (conv_id, turn, role, text, ghost)."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        known, conv = False, None
        codes, low, high, turns, before = bytearray(), None, None, 0, None

        def close() -> None:
            raw = bytes(codes)
            faults = [x >> 2 for x in raw]
            legal = {(0, 1), (1, 2), (2, 1)}
            illegal = sum((x & 3, y & 3) not in legal for x, y in zip(raw, raw[1:], strict=False))
            cost, audit = (_short if len(raw) <= SHORT else search)(raw)
            gaps = 0 if low is None else high - low + 1 - turns
            made.append((conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit))

        def out() -> pa.RecordBatch:
            cols = list(zip(*made, strict=True))
            made.clear()
            return pa.record_batch([pa.array(cols[0], conv_type), *(pa.array(c, pa.int64()) for c in cols[1:7]), pa.array(cols[7], pa.string())],
                                   ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

        for b in batches:
            conv_type = b.schema.field(0).type
            for c, turn, code in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if not known or c != conv:
                    if known:
                        close()
                        if len(made) >= OUT_ROWS:
                            yield out()
                    known, conv = True, c
                    codes, low, high, turns, before = bytearray(), None, None, 0, None
                if code == GHOST:
                    continue
                codes.append(code)
                if turn is not None:
                    low, high = turn if low is None else low, turn
                    turns, before = turns + (turn != before), turn
        if known:
            close()
        if made:
            yield out()

    return coded(rows).mapInArrow(run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Writer:
    """The repaired rows of one conversation, from its audit and its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, NONE

    def _put(self, role: str | None, text: str) -> tuple[str, str]:
        if role is None:
            self.last = A if self.last == U else U
            return _NAMES[self.last], text
        self.last = 1 + INITIALS.index(role[0])
        return role, text

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put(None, "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(role if edit == "K" else None, text)


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, audit, role, text): each conversation's audit, then its rows in order, whole in a
    partition."""
    marks = found.select("conv_id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("tk"), F.lit(None).cast("string").alias("text"), "audit", F.lit(0).alias("is_row"))
    texts = _keyed(rows.where("NOT ghost")).select("conv_id", "turn", "role", "tk", "text", F.lit(None).cast("string").alias("audit"), F.lit(1).alias("is_row"))
    both = marks.unionByName(texts).repartition("conv_id").sortWithinPartitions(*_order("conv_id", "is_row"))
    return both.select("conv_id", "audit", "role", "text")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the conversations after repair."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, conv, place = _Writer(""), None, 0
        for b in batches:
            out: list[tuple] = []

            def put(made: Iterator[tuple[str, str]], out: list = out) -> None:
                nonlocal place
                for role, text in made:
                    out.append((conv, place, role, text))
                    place += 1

            for c, audit, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if audit is not None:
                    put(writer.inserted())
                    writer, conv, place = _Writer(audit), c, 0
                else:
                    put(writer.row(role, text))
            yield _table(out, b.schema.field(0).type)
            conv_type = b.schema.field(0).type
        if rest := [(conv, place + i, *x) for i, x in enumerate(writer.inserted())]:
            yield _table(rest, conv_type)

    def _table(out: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [[]] * 4
        return pa.record_batch([pa.array(cols[0], conv_type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
                               ["conv_id", "place", "role", "text"])

    return _stream(rows, found).mapInArrow(run, f"conv_id {kind}, place long, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the hash of a conversation's repaired ``role:text`` lines."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, conv, sha, lines = None, None, hashlib.sha256(), 0

        def put(made: Iterator[tuple[str, str]]) -> None:
            nonlocal lines
            for role, text in made:
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1

        conv_type = None
        for b in batches:
            conv_type = b.schema.field(0).type
            done: list[tuple] = []
            for c, audit, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if audit is None:
                    put(writer.row(role, text))
                    continue
                if writer:
                    put(writer.inserted())
                    done.append((conv, sha.hexdigest()))
                writer, conv, sha, lines = _Writer(audit), c, hashlib.sha256(), 0
            if done:
                yield _pairs(done, conv_type)
        if writer:
            put(writer.inserted())
            yield _pairs([(conv, sha.hexdigest())], conv_type)

    def _pairs(done: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        return pa.record_batch([pa.array([x[0] for x in done], conv_type), pa.array([x[1] for x in done], pa.string())], ["conv_id", "repaired_sha256"])

    return _stream(rows, found).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(C.table(spark, sf_dir, "conversations"))
    found = write_table(audits(rows), "audits")
    digests = repaired_digests(rows, found).withColumnRenamed("conv_id", "of")
    return found.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


# edits as a table of state changes; ``ins`` empty turns before an edit are never more than two
OP12_SQL = rf"""
WITH RECURSIVE src AS (SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
     keyed AS (SELECT *, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS raw FROM src),
     {C.crc32_sql("rid, conv_id, turn, role, text")},
     hurt AS (SELECT rid, conv_id, turn, CASE WHEN h % 20 = 4 THEN 'user' ELSE role END AS role,
                     CASE h % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(CASE WHEN h % 20 = 3 THEN [0, 1] ELSE [0] END) AS again FROM hashed WHERE h % 20 <> 0),
     placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
                       row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen,
                       regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM hurt),
     faulty AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN tail = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                       WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'good' END AS fault,
                       substr(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1, 1) AS before FROM placed),
     facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                      count(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faulty GROUP BY conv_id),
     ins(st, k, added, lines, to_st) AS (VALUES ('0', 0, '', '', '0'), ('0', 1, 'I', 'user:' || chr(10), 'u'), ('0', 2, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 'a'),
         ('s', 0, '', '', 's'), ('s', 1, 'I', 'user:' || chr(10), 'u'), ('s', 2, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 'a'),
         ('u', 0, '', '', 'u'), ('u', 1, 'I', 'assistant:' || chr(10), 'a'), ('u', 2, 'II', 'assistant:' || chr(10) || 'user:' || chr(10), 'u'),
         ('a', 0, '', '', 'a'), ('a', 1, 'I', 'user:' || chr(10), 'u'), ('a', 2, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 'a')),
     edit(st, op, initial, to_st, cost) AS (VALUES ('0', 'K', 's', 's', 0), ('0', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('a', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0),
         ('0', 'R', NULL, 'u', 3), ('s', 'R', NULL, 'u', 3), ('a', 'R', NULL, 'u', 3), ('u', 'R', NULL, 'a', 3),
         ('0', 'D', NULL, '0', 4), ('s', 'D', NULL, 's', 4), ('a', 'D', NULL, 'a', 4), ('u', 'D', NULL, 'u', 4)),
     walk AS (SELECT conv_id, n, 0 AS pos, '0' AS st, 0 AS cost, '' AS audit, '' AS lines FROM facts
              UNION ALL
              SELECT conv_id, n, pos, st, cost, audit, lines FROM (
                  SELECT w.conv_id, w.n, w.pos + 1 AS pos, e.to_st AS st,
                         w.cost + 3 * i.k + e.cost + CASE WHEN e.op <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
                         w.audit || i.added || e.op AS audit,
                         w.lines || i.lines || CASE WHEN e.op = 'D' THEN ''
                             ELSE CASE WHEN e.op = 'K' THEN f.role WHEN e.to_st = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text || chr(10) END AS lines,
                         row_number() OVER (PARTITION BY w.conv_id, e.to_st ORDER BY w.cost + 3 * i.k + e.cost
                             + CASE WHEN e.op <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END, w.audit || i.added || e.op) AS place
                  FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1
                  JOIN ins i ON i.st = w.st JOIN edit e ON e.st = i.to_st AND (e.initial IS NULL OR e.initial = f.initial)
                      AND (e.op = 'D' OR f.fault IN ('good', 'truncated'))) WHERE place = 1),
     done AS (SELECT w.conv_id, w.cost + 3 * i.k AS cost, w.audit || i.added AS audit, w.lines || i.lines AS lines,
                     row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 3 * i.k, w.audit || i.added) AS place
              FROM walk w JOIN ins i ON i.st = w.st WHERE w.pos = w.n AND i.to_st IN ('0', 'a')),
     every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(left(lines, greatest(length(lines) - 1, 0)), '')) AS repaired_sha256
FROM every LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM every.conv_id AND place = 1"""
