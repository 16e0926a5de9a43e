"""Clock-time Column functions (I-8, I-21…I-27, M-2, M-3).

Timetable clock times may pass 24:00 (a trip after midnight belongs to the
previous service day), so they are kept as integer seconds since service-day
midnight and only formatted to ``HH:MM:SS`` text at the GTFS boundary.
All functions take and return Columns and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.cols import as_col

DAY = 86400


def _tc(c):
    """try_cast to int: NULL instead of an error for text that is not a number."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("int")


def to_seconds(text) -> Column:
    """``H:M[:S]`` (hours may exceed 23) -> seconds; NULL/blank -> NULL.

    Same rule as the reference's SQL function: hours*3600 + minutes*60 and
    the seconds part only when a third field is present.
    """
    t = F.trim(as_col(text))
    parts = F.split(t, ":")
    h = _tc(parts.getItem(0))
    m = _tc(parts.getItem(1))
    s = F.when(F.size(parts) >= 3, _tc(parts.getItem(2))).otherwise(F.lit(0))
    # most texts are HH:MM:SS, whose fields lie where they are without a split; a field with a colon is no number
    plain = (F.length(t) == 8) & (F.substring(t, 3, 1) == ":") & (F.substring(t, 6, 1) == ":")
    at = [_tc(F.substring(t, k, 2)) for k in (1, 4, 7)]
    return F.coalesce(F.when(plain, at[0] * 3600 + at[1] * 60 + at[2]),
                      F.when((t.isNull()) | (t == ""), F.lit(None).cast("int")).otherwise(h * 3600 + m * 60 + s))


def hhmm_to_seconds(text) -> Column:
    """IFF/PAS ``hhmm`` -> seconds (the reference's parse_time gives hh:mm:00)."""
    t = F.trim(as_col(text))
    return F.when((t.isNull()) | (t == ""), F.lit(None).cast("int")).otherwise(
        _tc(F.substring(t, 1, 2)) * 3600 + _tc(F.substring(t, 3, 2)) * 60
    )


def _two(n: Column) -> Column:
    """A number as ``%02d`` writes it, without a formatter per row."""
    return F.concat(F.when(n.between(0, 9), F.lit("0")).otherwise(F.lit("")), n.cast("string"))


def format_clock(seconds) -> Column:
    """Seconds -> ``HH:MM:SS``; hours keep counting past 24 (I-22)."""
    s = as_col(seconds).cast("long")
    colon = F.lit(":")
    return F.concat(_two(F.floor(s / 3600)), colon, _two(F.floor((s % 3600) / 60)), colon, _two(s % 60))


def add_seconds_to_clock(clock_seconds, delta_seconds) -> Column:
    """``add32time``: a clock time plus seconds, as text (M-3, I-22)."""
    return format_clock(as_col(clock_seconds) + as_col(delta_seconds))


def timediff(low, high) -> Column:
    """Seconds from clock text ``low`` to ``high`` (I-23); ``H:M`` accepted."""
    return to_seconds(high) - to_seconds(low)


def pad_seconds(text) -> Column:
    """5-character ``HH:MM`` -> ``HH:MM:00`` (I-8); other values unchanged."""
    c = as_col(text)
    return F.when(F.length(c) == 5, F.concat(c, F.lit(":00"))).otherwise(c)


def parse_ddmmyyyy(text) -> Column:
    """IFF/PAS ``ddmmyyyy`` -> date (I-24)."""
    return F.to_date(F.trim(as_col(text)), "ddMMyyyy")


def gtfs_date(d) -> Column:
    """date -> ``yyyymmdd`` (I-3)."""
    return F.date_format(as_col(d), "yyyyMMdd")


def weekday_mon1(d) -> Column:
    """ISO weekday, Monday=1 … Sunday=7 (I-20)."""
    return F.weekday(as_col(d)) + 1


def weekday_sun1(d) -> Column:
    """Weekday with Sunday=1 … Saturday=7 (I-19)."""
    return F.dayofweek(as_col(d))
