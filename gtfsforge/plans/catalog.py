"""Registry of every query: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_checks, q_demand, q_iff, q_increment, q_kv1, q_parse, q_pas

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, tuple[Query, str | None]]:
    out: dict[str, tuple[Query, str | None]] = {}
    for mod in (q_kv1, q_demand, q_increment, q_iff, q_pas, q_checks, q_parse):
        out.update(mod.QUERIES)
    return out
