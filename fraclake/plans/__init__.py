"""Registered queries: each a Spark plan over the given tables and, where SQL can say
it, the equivalent DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> tuple[dict[str, Query], dict[str, str]]:
    from fraclake.plans import archives, comparisons, ledger, listings, loads, sketches, streams, storage

    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for module in (sketches, comparisons, storage, loads, archives, listings, ledger, streams):
        queries.update(module.QUERIES)
        oracles.update(module.ORACLES)
    return queries, oracles
