"""Validity rules and day bitmaps expanded to service dates (N-9, N-10, N-12, N-24).

Date expansion is a per-row ``explode(sequence(...))``: it needs no shuffle
and its output is exactly the calendar the feed describes.  Ranges are
clipped (``as_of``) *before* the expansion so no day that a later filter
would drop is ever generated.  Exception tables are keyed by date, a small
domain; they are reduced to their distinct dates before any join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import as_text, pipe_id
from ..functions.first import first_per_key
from ..functions.times import gtfs_date, weekday_mon1, weekday_sun1

SCHED = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode"]


def date_range(start, end) -> Column:
    """Array of the dates start..end; empty when end < start or either is NULL.

    ``sequence`` would count down for end < start (and fail on NULL), unlike
    PostgreSQL's ``generate_series``, so the range is guarded.
    """
    s, e = F.col(start) if isinstance(start, str) else start, F.col(end) if isinstance(end, str) else end
    return F.when(s.isNotNull() & e.isNotNull() & (s <= e), F.sequence(s, e, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))


def _as_date(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, str)):
        return F.lit(str(v)).cast("date")
    raise TypeError(v)


# --------------------------------------------------------------------------
# N-9 schedule versions (L2 -> schedvers)
# --------------------------------------------------------------------------

def schedule_versions(tive: DataFrame, pegrval: DataFrame, pujo: DataFrame, require_distinct_from: bool = True) -> DataFrame:
    """schedvers rows from timetable versions, period validities and journeys (N-9).

    One row per (version, owner, timetable version, unit, period group,
    specific day, day type) that journeys use.  ``validthru`` falls back to
    the period's ``validthru``.  ``require_distinct_from`` keeps the
    reference's ``tive.validfrom != pegrval.validfrom`` condition (§8-D12).
    When several period validities match, the earliest one is taken.
    """
    svc_keys = ["version", "dataownercode", "timetableversioncode", "organizationalunitcode", "periodgroupcode",
                "specificdaycode", "daytype"]
    pj = pujo.select(*svc_keys).distinct()
    t = tive.select("version", "dataownercode", "organizationalunitcode", "timetableversioncode", "periodgroupcode",
                    "specificdaycode", F.col("validfrom").alias("tv_from"), F.col("validthru").alias("tv_thru"))
    p = pegrval.select("version", "dataownercode", "organizationalunitcode", "periodgroupcode",
                       F.col("validfrom").alias("pv_from"), F.col("validthru").alias("pv_thru"))
    tp = t.join(p, on=["version", "dataownercode", "organizationalunitcode", "periodgroupcode"])
    if require_distinct_from:
        tp = tp.filter(F.col("tv_from") != F.col("pv_from"))
    j = tp.join(pj, on=["version", "dataownercode", "organizationalunitcode", "periodgroupcode", "specificdaycode",
                        "timetableversioncode"])
    j = j.select(*svc_keys, F.col("tv_from").alias("validfrom"),
                 F.coalesce("tv_thru", "pv_thru").alias("validthru"), "pv_from")
    picked = first_per_key(j, svc_keys, ["pv_from", "validfrom", "validthru"], ["validfrom", "validthru"])
    return picked.select(
        "version", "dataownercode", "organizationalunitcode",
        F.col("periodgroupcode").alias("schedulecode"), F.col("daytype").alias("scheduletypecode"),
        "validfrom", "validthru", pipe_id(*svc_keys, sep="-").alias("description"),
    )


# --------------------------------------------------------------------------
# N-10 operating days
# --------------------------------------------------------------------------

def expand_operating_days(schedvers: DataFrame, clip_from=None) -> DataFrame:
    """operday rows: every date of [validfrom, validthru] whose weekday digit
    (Sunday=1 … Saturday=7) occurs in the schedule type code (N-10)."""
    start = F.col("validfrom")
    if clip_from is not None:
        start = F.greatest(start, _as_date(clip_from))
    days = schedvers.select(*SCHED, F.explode(date_range(start, F.col("validthru"))).alias("validdate"))
    return days.filter(F.instr(F.col("scheduletypecode"), weekday_sun1("validdate").cast("string")) > 0)


# --------------------------------------------------------------------------
# N-12 calendar with exceptional days
# --------------------------------------------------------------------------

def calendar_with_exceptions(
    pegrval: DataFrame,
    pujo: DataFrame,
    tive: DataFrame,
    excopday: DataFrame,
    version: DataFrame,
    as_of,
    exclude_units: DataFrame | None = None,
) -> DataFrame:
    """calendar_dates.txt of the validity lineage (N-12, §2.4).

    1. services: period validity x timetable version x the day types that
       journeys use; range [period from, coalesce(tive thru, period thru)].
    2. regular dates: weekday (Monday=1) in the day type, inside the
       import's validity, not before ``as_of - 1``, and not an exceptional
       date whose substitute day differs from the weekday.
    3. substituted dates: on an exceptional date inside the range, the
       service's day type that contains the substitute digit.
    4. distinct union.

    ``excopday`` (excopdate date, daytypeason string) is reduced to distinct
    (date, first digit) pairs; how it and the import ledger are joined is
    left to the planner's byte thresholds.
    ``exclude_units`` drops units listed there (the variant feed).
    """
    yesterday = F.date_sub(_as_date(as_of), 1)
    tv = tive.select("version", "dataownercode", "organizationalunitcode", "timetableversioncode", "periodgroupcode",
                     "specificdaycode", F.col("validthru").alias("tv_thru"))
    pv = pegrval.select("version", "dataownercode", "organizationalunitcode", "periodgroupcode",
                        F.col("validfrom").alias("pv_from"), F.col("validthru").alias("pv_thru"))
    if exclude_units is not None:
        pv = pv.join(exclude_units.select(F.col(exclude_units.columns[0]).alias("organizationalunitcode")),
                     on="organizationalunitcode", how="left_anti")
    pj = pujo.select("version", "dataownercode", "timetableversioncode", "periodgroupcode", "specificdaycode",
                     F.col("organizationalunitcode").alias("pj_unit"), "daytype").distinct()
    svc = pv.join(tv, on=["version", "dataownercode", "organizationalunitcode", "periodgroupcode"]) \
        .join(pj, on=["version", "dataownercode", "timetableversioncode", "periodgroupcode", "specificdaycode"]) \
        .select("version", "dataownercode", "timetableversioncode", "pj_unit", "periodgroupcode", "specificdaycode",
                "daytype", F.col("pv_from").alias("d_from"), F.coalesce("tv_thru", "pv_thru").alias("d_thru"))
    ver = version.select("version", F.col("validfrom").alias("v_from"), F.col("validthru").alias("v_thru"))
    svc = svc.join(ver, on="version")
    # clip the range to what can survive the filters before expanding it
    # (greatest/least skip NULLs; a NULL bound means "no date", as in SQL)
    bounds_known = F.col("v_from").isNotNull() & F.col("v_thru").isNotNull() & F.col("d_from").isNotNull()
    lo = F.when(bounds_known, F.greatest("d_from", "v_from", yesterday))
    hi = F.when(bounds_known & F.col("d_thru").isNotNull(), F.least("d_thru", "v_thru"))
    # services are few and short, their dates are not: the services are dealt out to a fixed number of tasks before they
    # are expanded, and the dates before they are made distinct, as tasks sized by the bytes of the former hold too many
    n = int(svc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = svc.repartition(n, "version", "dataownercode", "timetableversioncode", "pj_unit", "periodgroupcode", "specificdaycode")
    dated = dealt.select("*", F.explode(date_range(lo, hi)).alias("date"))
    exc = excopday.select(F.col("excopdate").cast("date").alias("date"),
                          F.substring(as_text("daytypeason"), 1, 1).alias("ason")).distinct()
    wd = weekday_mon1("date").cast("string")
    sid_cols = ["version", "dataownercode", "timetableversioncode", "pj_unit", "periodgroupcode", "specificdaycode",
                "daytype"]
    exc_days = exc.withColumnRenamed("date", "exc_date")
    regular = dated.filter(F.instr("daytype", wd) > 0).join(
        exc_days, (F.col("date") == F.col("exc_date")) & (F.instr(F.col("ason"), wd) == 0), "left_anti")
    regular = regular.select(pipe_id(*sid_cols).alias("service_id"), "date")
    # substituted: one row per service date that is exceptional, for every
    # day type of the same service that contains the substitute digit
    svc_dates = dated.select("version", "dataownercode", "timetableversioncode", "pj_unit", "periodgroupcode",
                             "specificdaycode", "date").distinct().join(exc, on="date")
    types = pj.select("version", "dataownercode", "timetableversioncode", "pj_unit", "periodgroupcode",
                      "specificdaycode", "daytype")
    subst = svc_dates.join(types, on=["version", "dataownercode", "timetableversioncode", "pj_unit",
                                      "periodgroupcode", "specificdaycode"]) \
        .filter(F.instr("daytype", F.col("ason")) > 0) \
        .select(pipe_id(*sid_cols).alias("service_id"), "date")
    out = regular.unionByName(subst).repartition(n, "service_id", "date").distinct()
    return out.select("service_id", gtfs_date("date").alias("date"), F.lit(1).alias("exception_type"))


# --------------------------------------------------------------------------
# N-24 validity bitmaps
# --------------------------------------------------------------------------

def bitmap_dates(bitmaps: DataFrame, first_day, key: str = "footnote", bits: str = "bits") -> DataFrame:
    """(key, bitmap) -> one (key, servicedate) row per '1' bit (J-3).

    Bit i (0-based) is ``first_day + i``.
    """
    return bitmaps.select(key, F.posexplode(F.split(F.col(bits), "")).alias("pos", "bit")) \
        .filter(F.col("bit") == "1") \
        .select(key, F.date_add(_as_date(first_day), F.col("pos")).alias("servicedate"))


def gtfs_calendar_dates_footnotes(footnote: DataFrame, prefix: str = "NS:", exception_type: str = "1",
                                  key: str = "footnote", date_col: str = "servicedate") -> DataFrame:
    """calendar_dates.txt of the rail / metro lineages (N-24, N-34)."""
    return footnote.select(F.concat(F.lit(prefix), as_text(key)).alias("service_id"),
                           gtfs_date(date_col).alias("date"), F.lit(exception_type).alias("exception_type"))


# --------------------------------------------------------------------------
# N-38 calendar.txt weekday flags (optional export)
# --------------------------------------------------------------------------

# ---- fixed values: Dutch day codes of the schedule-type rule ----
DAY_CODES = ("MA", "DI", "WO", "DO", "VR", "ZA", "ZO")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
# ---- end of fixed values ----


def weekday_flags(schedvers: DataFrame, rule: str = "range") -> DataFrame:
    """calendar.txt rows per schedule version (N-38).

    ``rule='description'``: the English day name occurs in the description;
    ``'type_code'``: the schedule type is the day's Dutch code, or ``WE``
    (working day) for Monday–Friday; ``'range'``: the weekday occurs in
    [validfrom, validthru] (decided from the range length and the first
    day's weekday, without expanding the range).
    """
    flags = []
    for i, day in enumerate(WEEKDAYS):
        if rule == "description":
            f = F.instr(F.col("description"), day.capitalize()) > 0
        elif rule == "type_code":
            f = F.col("scheduletypecode") == DAY_CODES[i]
            if i < 5:
                f = f | (F.col("scheduletypecode") == "WE")
        elif rule == "range":
            n_days = F.datediff("validthru", "validfrom") + 1
            offset = F.pmod(F.lit(i) - F.weekday("validfrom"), F.lit(7))
            f = (n_days >= 7) | (offset < n_days)
        else:
            raise ValueError(f"unknown weekday rule {rule!r}")
        flags.append(F.coalesce(f, F.lit(False)).cast("int").alias(day))
    return schedvers.select(pipe_id(*SCHED).alias("service_id"), *flags,
                            gtfs_date("validfrom").alias("start_date"), gtfs_date("validthru").alias("end_date"))
