"""First row per key (E-9, E-10, F-8, G-6, D-18).

``DISTINCT ON (k) … ORDER BY o`` is expressed as a grouped ``min`` over a
struct whose leading fields are the sort keys.  Unlike a
``row_number() over (partition by k)`` window this aggregates partially on
the map side, so a hot key (one pattern holding a third of the rows) never
lands whole in a single task: only one candidate per key and map task is
shuffled.  The struct comparison is lexicographic, so the order fields plus
a full tiebreak make the pick deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    payload: Sequence[str] | None = None,
    descending: bool = False,
) -> DataFrame:
    """One row per ``keys``: the row with the smallest (or largest) ``order``.

    ``order`` must end in a tiebreak that is unique within a key when a
    deterministic answer is required.  ``payload`` defaults to every other
    column.  NULL order values sort first in ascending order (Spark rule);
    callers that need PostgreSQL's NULLS LAST pass ``nulls_last(col)``.
    """
    if payload is None:
        payload = [c for c in df.columns if c not in keys]
    fields = [(_o if isinstance(_o, Column) else F.col(_o)).alias(f"__o{i}") for i, _o in enumerate(order)]
    fields += [F.col(p).alias(p) for p in payload]
    agg = F.max if descending else F.min
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("__first"))
    return picked.select(*keys, *[F.col(f"__first.{p}").alias(p) for p in payload])


def nulls_last(c: str | Column) -> Column:
    """Sort helper: ascending with NULLs after all values."""
    col = F.col(c) if isinstance(c, str) else c
    return F.struct(col.isNull().alias("n"), col.alias("v"))
