"""The timetable's clock functions as SQL functions, for ``spark.sql`` users (M-2, M-3).

``CREATE TEMPORARY FUNCTION … RETURN <expr>`` defines SQL functions that
Catalyst inlines like any built-in expression (no Python at run time):

* ``toseconds(text)``: ``H:M[:S]`` -> seconds (hours may exceed 23);
* ``add32time(text, seconds)``: clock text plus seconds -> ``HH:MM:SS``
  with hours past 24 kept (the function the reference calls but never defines);
* ``clocktext(seconds)``: seconds -> ``HH:MM:SS``;
* ``timediff(low, high)``: seconds from ``low`` to ``high``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_TOSECONDS = ("try_cast(split_part(t, ':', 1) as int) * 3600 + try_cast(split_part(t, ':', 2) as int) * 60 "
              "+ CASE WHEN size(split(t, ':')) >= 3 THEN try_cast(split_part(t, ':', 3) as int) ELSE 0 END")
_CLOCK = ("CASE WHEN s IS NULL THEN NULL ELSE format_string('%02d:%02d:%02d', cast(floor(s / 3600) as bigint), "
          "cast(floor((s % 3600) / 60) as bigint), cast(s % 60 as bigint)) END")

DEFINITIONS = {
    "toseconds": f"(t STRING) RETURNS INT RETURN {_TOSECONDS}",
    "clocktext": f"(s BIGINT) RETURNS STRING RETURN {_CLOCK}",
    "add32time": "(t STRING, d BIGINT) RETURNS STRING RETURN clocktext(toseconds(t) + d)",
    "timediff": "(lo STRING, hi STRING) RETURNS INT RETURN toseconds(hi) - toseconds(lo)",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in the session; returns their names."""
    for name in ("toseconds", "clocktext", "add32time", "timediff"):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{DEFINITIONS[name]}")
    return list(DEFINITIONS)
