"""The queries of this subpackage and their SQL (DuckDB), for the driver's contract."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (bpe, decontaminate, interpolation, mixing, partenum, pfor, quality, repair, separators, spotsigs, substrings,
                          variants, warc)
from tidemark.session import ship_package

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op10_winnowing": decontaminate.op10_winnowing,
    "op11_spelling_variants": variants.op11_spelling_variants,
    "op12_structure_repair": repair.op12_structure_repair,
    "op13_pivotal_mix": mixing.op13_pivotal_mix,
    "op1_substring_dedup": substrings.op1_substring_dedup,
    "op2_bpe_codec": bpe.op2_bpe_codec,
    "op3_quality": quality.op3_quality,
    "op4_spotsigs": spotsigs.op4_spotsigs,
    "op5_lm_scores": interpolation.op5_lm_scores,
    "op6_jaccard_join": partenum.op6_jaccard_join,
    "op7_pfor_ids": pfor.op7_pfor_ids,
    "op8_warc": warc.op8_warc,
    "op9_token_counts": separators.op9_token_counts,
}

SQL: dict[str, str] = {"op1_substring_dedup": substrings.OP1_SQL, "op6_jaccard_join": partenum.OP6_SQL,
                       "op10_winnowing": decontaminate.OP10_SQL, "op8_warc": warc.OP8_SQL,
                       "op11_spelling_variants": variants.OP11_SQL, "op12_structure_repair": repair.OP12_SQL}


def _shipped(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(fn) for name, fn in BUILDERS.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
