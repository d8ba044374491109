"""Public view of the query catalogue used by ``__spark_entry__``."""

from __future__ import annotations

import functools

from tidemark.plans.registry import ORACLE, QUERIES, Builder, load_all
from tidemark.session import ship_package


def _shipped(fn: Builder) -> Builder:
    """The builder, run after the package is shipped to the Python workers of the caller's session."""

    @functools.wraps(fn)
    def run(spark, sf_dir):
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Builder]:
    load_all()
    return {name: _shipped(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
