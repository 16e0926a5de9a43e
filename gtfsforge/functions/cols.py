"""Small Column helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c) -> Column:
    return as_col(c).cast("string")


def pipe_id(*cols, sep: str = "|") -> Column:
    """Composite id ``a|b|c`` (I-1): NULL if any part is NULL, like ``||``."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(as_text(c))
    return F.concat(*parts)


def null_of(type_name: str) -> Column:
    """Typed NULL literal (C-1)."""
    return F.lit(None).cast(type_name)


def keys_equal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns that a dialect leaves out as typed NULLs (§1.4)."""
    for name, type_name in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, null_of(type_name))
    return df


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[n for n in names if n in df.columns])
