"""Chains of cuts over sorted times, by composing functions instead of walking them.

A chain cuts at the first time that is at least ``step`` after its last cut. What a range of times
does to a chain is a function: it takes the earliest moment at which the next cut may be (``w``) and
gives that moment behind the range, with the number of cuts made. Whatever came before, ``w`` is less
than the range's first time + step, so a range's function is a table over the times of its first
interval and the one after; equal neighbours are one piece. Functions of neighbouring ranges compose
to one table of the same kind, so:

1. distinct times are range-sorted once, into ranges of about ``RANGE_TIMES``;
2. each range makes its table, from pointers to the next cut, doubled until they leave the range;
3. tables are composed up a tree of ``FAN`` children a node, each node in one call;
4. entries go down the tree, each node telling its children the ``w`` that they see and the number
   of cuts before them;
5. each range follows its own cuts.

The number of jobs grows with the logarithm of the number of ranges, nothing but that number reaches
the driver, and a call holds one range, or tables with at most the times of one interval each. Times
so dense that an interval has more than ``DENSE`` of them are left to the caller's other method.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import write_table

RANGE_TIMES = 500_000
FAN = 16
DENSE = 1_000_000
NODE_PIECES = 4_000_000  # rows of all tables that one call composes
_PIECES = "node long, upto long, exit long, cuts long, first long"
_ENTRIES = "node long, w long, before long"


def range_table(times: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(upto, exit, cuts) of the function of a sorted range: an entry up to ``upto`` (and over the piece
    before) leaves with ``exit`` after ``cuts`` cuts."""
    n = len(times)
    hop, out, cuts = np.searchsorted(times, times + step), times + step, np.ones(n, np.int64)
    while len(go := np.flatnonzero(hop < n)):
        to = hop[go]
        cuts[go], out[go], hop[go] = cuts[go] + cuts[to], out[to], hop[to]
    k = min(int(np.searchsorted(times, times[0] + step)) + 1, n)
    return pieces(times[:k], out[:k], cuts[:k])


def pieces(upto: np.ndarray, out: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keep = np.concatenate([(out[1:] != out[:-1]) | (cuts[1:] != cuts[:-1]), [True]])
    return upto[keep], out[keep], cuts[keep]


def applied(table: tuple[np.ndarray, np.ndarray, np.ndarray], w: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(w, cuts) behind the range of ``table``; a ``w`` past its end is left as it is."""
    upto, out, cuts = table
    at = np.searchsorted(upto, w)
    inside = at < len(upto)
    at = np.minimum(at, len(upto) - 1)
    return np.where(inside, out[at], w), made + np.where(inside, cuts[at], 0)


def composed(tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]], first: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table of neighbouring ranges, in order; ``first`` is their first time."""
    upto = np.concatenate([t[0] for t in tables])
    upto = upto[: int(np.searchsorted(upto, first + step)) + 1]
    w, made = upto, np.zeros(len(upto), np.int64)
    for t in tables:
        w, made = applied(t, w, made)
    return pieces(upto, w, made)


def _by_node(t: pa.Table) -> tuple[list[int], list[tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """(child numbers, their tables, first time) of the children of one node."""
    t = t.sort_by([("node", "ascending"), ("upto", "ascending")])
    node, *cols = (t.column(c).to_numpy() for c in ("node", "upto", "exit", "cuts"))
    start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    bounds = [*start.tolist(), len(node)]
    tables = [tuple(c[i:j] for c in cols) for i, j in zip(bounds, bounds[1:], strict=False)]
    return node[start].tolist(), tables, int(t.column("first").to_numpy()[0])


def _follow(step: int):
    """Each range's own cuts, from its entry."""

    def follow(key: tuple, t: pa.Table, entries: pa.Table) -> pa.Table:
        cuts: list[int] = []
        if len(t) and len(entries):
            us = np.sort(t.column("_us").to_numpy())
            after = np.searchsorted(us, us + step)
            i = int(np.searchsorted(us, entries.column("w")[0].as_py()))
            while i < len(us):
                cuts.append(i)
                i = int(after[i])
            at = us[cuts]
            return pa.table({"k": entries.column("before")[0].as_py() + 1 + np.arange(len(at)), "_us": at})
        return pa.table({"k": pa.array([], pa.int64()), "_us": pa.array([], pa.int64())})

    return follow


def chain_cuts(times: DataFrame, step: int, fan: int = FAN, range_times: int = RANGE_TIMES) -> DataFrame | None:
    """(k, _us): the cuts, numbered from 1, of the chain whose first cut is the first of ``times`` (_us
    long, distinct). None if the times are too dense for this method."""
    n = max(1, -(-times.count() // range_times))
    ranged = times.select("_us").repartitionByRange(n, "_us").withColumn("node", F.spark_partition_id().cast("long"))
    ranged = write_table(ranged, "ranged-times")
    if n == 1:  # one range: the chain enters at its first time
        entries = ranged.groupBy("node").agg(F.min("_us").alias("w")).withColumn("before", F.lit(0).cast("long"))
        return ranged.groupBy("node").cogroup(entries.groupBy("node")).applyInArrow(_follow(step), "k long, _us long")
    dense = ranged.groupBy(F.floor(F.col("_us") / F.lit(step))).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if 2 * dense > DENSE:
        return None
    fan = max(2, min(fan, NODE_PIECES // (2 * dense + 2)))

    def leaf(key: tuple, t: pa.Table) -> pa.Table:
        us = np.sort(t.column("_us").to_numpy())
        upto, out, cuts = range_table(us, step)
        return pa.table({"node": np.full(len(upto), key[0].as_py()), "upto": upto, "exit": out, "cuts": cuts, "first": np.full(len(upto), us[0])})

    def compose(key: tuple, t: pa.Table) -> pa.Table:
        _, tables, first = _by_node(t)
        upto, out, cuts = composed(tables, first, step)
        return pa.table({"node": np.full(len(upto), key[0].as_py()), "upto": upto, "exit": out, "cuts": cuts, "first": np.full(len(upto), first)})

    def enter(key: tuple, t: pa.Table, entries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(t) and len(entries):
            w, made = entries.column("w").to_numpy(), entries.column("before").to_numpy()
            for child, table in zip(*_by_node(t)[:2], strict=True):
                if w[0] <= table[0][-1]:
                    out.append((child, int(w[0]), int(made[0])))
                w, made = applied(table, w, made)
        return pa.table({c: pa.array([x[i] for x in out], pa.int64()) for i, c in enumerate(("node", "w", "before"))})

    by_part = ranged.groupBy("node")
    levels = [write_table(by_part.applyInArrow(leaf, _PIECES), "chain-level")]
    for _ in range(math.ceil(math.log(n, fan) - 1e-9)):
        up = levels[-1].groupBy(F.expr(f"node DIV {fan}").alias("parent")).applyInArrow(compose, _PIECES)
        levels.append(write_table(up, "chain-level"))
    entries = levels[-1].groupBy("node").agg(F.min("first").alias("w")).withColumn("before", F.lit(0).cast("long"))
    for level in reversed(levels[:-1]):
        entries = level.groupBy(F.expr(f"node DIV {fan}").alias("parent")).cogroup(entries.groupBy("node")).applyInArrow(enter, _ENTRIES)
    return by_part.cogroup(entries.groupBy("node")).applyInArrow(_follow(step), "k long, _us long")
