"""Plans of the operators: of the frame a query returns, and of every frame that is written on the way."""

from __future__ import annotations

import pytest
from pyspark.sql.readwriter import DataFrameWriter

import corpus_pipeline
from tests.llm.conftest import SF
from tidemark.llm import decontaminate
from tidemark.llm.queries import BUILDERS

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "rangepartitioning", "BatchEvalPython")
# files in ascending order of ids need a sort by ranges; op13 ranks the sources, a table of one row each
ALLOWED = {name: {"rangepartitioning"} for name in ("op7_pfor_ids", "op9_token_counts", "op13_pivotal_mix")}
NATIVE = ("op4_spotsigs", "op10_winnowing")
PYTHON = ("MapInArrow", "MapInPandas", "FlatMapGroups", "FlatMapCoGroups", "ArrowEvalPython", "BatchEvalPython", "PythonUDTF")


@pytest.fixture
def written(monkeypatch):
    """The plans of all frames written as Parquet, before they are written."""
    plans: list[str] = []
    parquet = DataFrameWriter.parquet

    def spy(self, *args, **kw):
        plans.append(plan(self._df))
        return parquet(self, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    return plans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [*sorted(BUILDERS), "pipeline"])
def test_no_plan_pairs_all_rows_or_sorts_them_in_one_order(spark, queries, written, name):
    df = corpus_pipeline.run(spark, SF) if name == "pipeline" else queries[name](spark, SF)
    for p in [*written, plan(df)]:
        found = [x for x in FORBIDDEN if x in p and x not in ALLOWED.get(name, ())]
        assert not found, (found, p)
        if name in NATIVE:
            assert not [x for x in PYTHON if x in p]


@pytest.mark.parametrize(("name", "scans"), [("op6_jaccard_join", 16), ("op10_winnowing", 3)])
def test_plans_that_the_driver_holds_stay_small(spark, queries, written, name, scans):
    df = queries[name](spark, SF)
    for p in [*written, plan(df)]:
        assert "ExistingRDD" not in p, p  # a join with a table known to be empty is left out
        assert p.count("FileScan parquet") <= scans, p  # no branch for each length of an item


def test_prints_of_short_items_hash_their_words_alone(spark):
    items = spark.createDataFrame([(f"i{n}", " ".join(f"w{j}" for j in range(n))) for n in range(14)], "item_id string, text string")
    prints = decontaminate.item_prints(items)
    assert plan(prints).count("ExistingRDD") == 2  # long items and short ones, not each length by itself
    got = {(r.item, r.fp, r.win, r.q) for r in prints.where("win < 10").collect()}
    hashed = [spark.sql(f"SELECT xxhash64({n}, {', '.join(repr(f'w{j}') for j in range(n))}) AS h").first().h for n in range(1, 10)]
    assert got == {(f"i{n}", h, n, 0) for n, h in enumerate(hashed, 1)}
