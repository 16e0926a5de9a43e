"""GTFS tables from KV1 passing-time feeds (N-13…N-19, N-21, N-22, N-36, N-37).

Inputs are KV1 tables as DataFrames (column names of the KV1 schema; clock
times as integer seconds ``arr_s`` / ``dep_s``).  Outputs are GTFS tables as
DataFrames; nothing is collected.

Plan shape: the large relation is ``pujopass`` (journeys x stops).  Every
per-pattern attribute it needs (first destination, product formula, the
stop headsigns) is folded into ONE pattern-level table first
(:func:`pattern_info`), so the passes meet pattern data in a single join
(a broadcast when the pattern table is small, one shuffle otherwise) instead
of one join per attribute.  Stop attributes come from a second join keyed by
stop.  Lookup constants are literal tables and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cols import as_text, null_of, pipe_id
from ..functions.first import first_per_key
from ..functions.rank import nested_rank
from ..functions.geo import rd_lat, rd_lon
from ..functions.times import format_clock, gtfs_date
from . import mappings as M

SCHED = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode"]
PATTERN = ["version", "dataownercode", "lineplanningnumber", "journeypatterncode"]
JOURNEY = SCHED + ["lineplanningnumber", "journeynumber"]


def _spark(df: DataFrame):
    return df.sparkSession


# --------------------------------------------------------------------------
# N-22 / N-36 / N-37: pre-export clean-ups
# --------------------------------------------------------------------------

def prune_unscheduled(df: DataFrame, operday: DataFrame) -> DataFrame:
    """Keep rows whose schedule version has at least one operating day (N-22).

    A semi-join on the five schedule-key columns (no string building).  The
    distinct schedule keys of ``operday`` are few (schedules, not days), so
    the build side stays small even when ``operday`` is large.
    """
    keys = operday.select(*SCHED).distinct()
    return df.join(keys, on=SCHED, how="left_semi")


def product_formula_fixes(jopatili: DataFrame, fixes: DataFrame | None = None) -> DataFrame:
    """Set the product formula from deprecated codes per owner (N-36)."""
    if "deprecated" not in jopatili.columns:
        return jopatili
    fixes = M.formula_fixes(_spark(jopatili)) if fixes is None else fixes
    cols = jopatili.columns
    j = jopatili.join(fixes, on=["dataownercode", "deprecated"], how="left")
    return j.withColumn(
        "productformulatype", F.coalesce(F.col("fixed_formula"), F.col("productformulatype"))
    ).select(*cols)


def pad_seconds_text(pujopass: DataFrame, arr: str = "targetarrivaltime", dep: str = "targetdeparturetime") -> DataFrame:
    """``HH:MM`` -> ``HH:MM:00`` on both times where the arrival has 5 characters (N-37)."""
    short = F.length(F.col(arr)) == 5
    return pujopass.withColumn(dep, F.when(short, F.concat(F.col(dep), F.lit(":00"))).otherwise(F.col(dep))) \
        .withColumn(arr, F.when(short, F.concat(F.col(arr), F.lit(":00"))).otherwise(F.col(arr)))


def default_transport_type(line: DataFrame) -> DataFrame:
    """B-5: absent/NULL mode becomes BOAT for public number ``FF`` else BUS."""
    if "transporttype" not in line.columns:
        line = line.withColumn("transporttype", null_of("string"))
    return line.withColumn(
        "transporttype",
        F.coalesce(F.col("transporttype"),
                   F.when(as_text("linepublicnumber") == "FF", F.lit("BOAT")).otherwise(F.lit("BUS"))),
    )


def train_lines(line: DataFrame) -> DataFrame:
    """(owner, line) pairs of rail lines, which the bus/tram export leaves out."""
    return line.filter(F.col("transporttype") == "TRAIN").select("dataownercode", "lineplanningnumber").distinct()


# --------------------------------------------------------------------------
# pattern-level attributes
# --------------------------------------------------------------------------

def pattern_info(jopatili: DataFrame, dest: DataFrame) -> DataFrame:
    """One row per journey pattern with everything the pass-level exports use.

    Columns: PATTERN keys, ``first_tlo``, ``first_stop`` (begin of the first
    link), ``trip_destcode`` / ``trip_headsign`` (destination of the first
    link), ``productformulatype`` (of the first link whose formula is set and
    is not 18), ``headsigns`` (map stoporder -> destination name for the
    stops whose destination differs from the trip's: link begins at
    ``stoporder = timinglinkorder`` plus the end of the last link).
    Sizes are bounded by links per pattern; no pass rows are involved.
    """
    links = jopatili.select(*PATTERN, "timinglinkorder", "userstopcodebegin", "userstopcodeend", "destcode",
                            "productformulatype")
    # first link, last link, first link with a usable formula and the
    # destination of every stop position: one aggregation per pattern
    usable = F.col("productformulatype").isNotNull() & (F.col("productformulatype") != M.IGNORED_FORMULA)
    ends = links.groupBy(*PATTERN).agg(
        F.min(F.struct("timinglinkorder", "userstopcodebegin", "destcode")).alias("f"),
        F.max(F.struct("timinglinkorder", "userstopcodeend", "destcode")).alias("l"),
        F.min(F.when(usable, F.struct("timinglinkorder", "productformulatype"))).alias("pf"),
        F.collect_list(F.struct(F.col("timinglinkorder").alias("stoporder"), "destcode")).alias("stops"))
    first = ends.select(*PATTERN, F.col("f.timinglinkorder").alias("first_tlo"),
                        F.col("f.userstopcodebegin").alias("first_stop"), F.col("f.destcode").alias("trip_destcode"),
                        F.col("pf.productformulatype").alias("productformulatype"))
    # link begins at stoporder = timinglinkorder, plus the end of the last link
    all_stops = F.concat("stops", F.array(F.struct((F.col("l.timinglinkorder") + 1).alias("stoporder"),
                                                   F.col("l.destcode").alias("destcode"))))
    other = ends.select(*PATTERN, F.explode(F.filter(all_stops, lambda x: x["destcode"] != F.col("f.destcode")))
                        .alias("s")).select(*PATTERN, "s.stoporder", "s.destcode")
    names = dest.select("version", "dataownercode", "destcode", "destnamefull")
    named = other.join(names, on=["version", "dataownercode", "destcode"]) \
        .groupBy(*PATTERN).agg(F.array_sort(F.collect_list(F.struct("stoporder", F.col("destnamefull").alias("name"))))
                               .alias("hs"))
    # one entry per stop position (the smallest name if a position repeats)
    dedup = F.filter("hs", lambda x, i: (i == 0) | (x["stoporder"] != F.get(F.col("hs"), i - 1)["stoporder"]))
    differing = named.select(*PATTERN, F.map_from_entries(dedup).alias("headsigns"))
    trip_names = names.withColumnRenamed("destcode", "trip_destcode").withColumnRenamed("destnamefull", "trip_headsign")
    return (
        first.join(trip_names, on=["version", "dataownercode", "trip_destcode"], how="left")
        .join(differing, on=PATTERN, how="left")
    )


# --------------------------------------------------------------------------
# N-17 calendar_dates, N-13 feed_info, N-14 agency
# --------------------------------------------------------------------------

def gtfs_calendar_dates(operday: DataFrame) -> DataFrame:
    return operday.select(
        pipe_id(*SCHED).alias("service_id"),
        gtfs_date("validdate").alias("date"),
        F.lit(1).alias("exception_type"),
    )


def gtfs_feed_info(df: DataFrame, start_col: str, end_col: str | None = None, feed_version: str = "1",
                   publisher: tuple[str, str, str] | None = None) -> DataFrame:
    """Publisher (name, url, language) + min(start)/max(end) date (N-13); one row."""
    end_col = end_col or start_col
    name, url, lang = publisher or M.FEED_PUBLISHER
    return df.agg(F.min(start_col).alias("s"), F.max(end_col).alias("e")).select(
        F.lit(name).alias("feed_publisher_name"),
        F.lit(url).alias("feed_publisher_url"),
        F.lit(lang).alias("feed_lang"),
        gtfs_date("s").alias("feed_start_date"),
        gtfs_date("e").alias("feed_end_date"),
        F.lit(feed_version).alias("feed_version"),
    )


def gtfs_agency_kv1(in_use: DataFrame, agencies: DataFrame | None = None, owner_col: str = "dataownercode") -> DataFrame:
    """Agency rows of the KV1 exports for the owners present in ``in_use`` (N-14).

    Owners without a known agency still get a row (name/url NULL).
    """
    agencies = M.kv1_agencies(in_use.sparkSession) if agencies is None else agencies
    owners = in_use.select(F.col(owner_col).alias("agency_id")).distinct()
    return owners.join(agencies, on="agency_id", how="left").select(
        "agency_id", "agency_name", "agency_url",
        F.lit(M.AGENCY_TIMEZONE).alias("agency_timezone"), F.lit(M.AGENCY_LANG).alias("agency_lang"))


# --------------------------------------------------------------------------
# N-18 trips, N-19 stop_times
# --------------------------------------------------------------------------

def gtfs_trips_kv1(
    pujopass: DataFrame,
    jopa: DataFrame,
    jopatili: DataFrame,
    dest: DataFrame,
    line: DataFrame,
    operday: DataFrame | None = None,
    bikes: DataFrame | None = None,
) -> DataFrame:
    """trips.txt from passing times (N-18): one row per journey's first pass."""
    spark = _spark(pujopass)
    p = pujopass if operday is None else prune_unscheduled(pujopass, operday)
    p = p.filter(F.col("stoporder") == 1).join(train_lines(default_transport_type(line)),
                                                on=["dataownercode", "lineplanningnumber"], how="left_anti")
    info = pattern_info(jopatili, dest).filter(F.col("trip_headsign").isNotNull())
    bikes = M.bikes_allowed(spark) if bikes is None else bikes
    wc = M.wheelchair(spark).withColumnRenamed("wheelchairaccessible", "wc_key")
    t = (
        p.join(jopa.select(*PATTERN, "direction"), on=PATTERN)
        .join(info.select(*PATTERN, "trip_headsign"), on=PATTERN)
        .withColumn("wc_key", F.coalesce(F.col("wheelchairaccessible"), F.lit("UNKNOWN")))
        .join(wc, on="wc_key")
        .withColumn("line_text", as_text("lineplanningnumber"))
        .join(bikes.withColumnRenamed("lineplanningnumber", "line_text"),
              on=["dataownercode", "line_text"], how="left")
    )
    return t.select(
        pipe_id("dataownercode", "lineplanningnumber").alias("route_id"),
        pipe_id(*SCHED).alias("service_id"),
        pipe_id(*JOURNEY).alias("trip_id"),
        F.col("journeynumber").alias("trip_short_name"),
        F.col("trip_headsign"),
        (F.col("direction").cast("int") - 1).alias("direction_id"),
        pipe_id(*PATTERN).alias("shape_id"),
        F.col("wheelchair_accessible"),
        F.col("trip_bikes_allowed"),
    )


def pickup_dropoff(formula, flag) -> F.Column:
    """3 for on-demand product formulas, else ``not flag`` as 0/1 (C-8, I-13)."""
    return F.when(formula.isin(*M.ON_DEMAND_FORMULAS), F.lit(3)).otherwise((~flag).cast("int"))


def gtfs_stop_times_kv1(
    pujopass: DataFrame,
    usrstop: DataFrame,
    jopatili: DataFrame,
    dest: DataFrame,
    line: DataFrame,
    operday: DataFrame | None = None,
) -> DataFrame:
    """stop_times.txt from passing times (N-19).

    Times are filled both ways (``coalesce``); the headsign is set only where
    the stop's destination differs from the trip's; pickup/drop-off are 3
    for on-demand formulas else ``not getin`` / ``not getout``.  Stops must
    allow boarding or alighting.  Rail lines are left out.
    """
    p = pujopass if operday is None else prune_unscheduled(pujopass, operday)
    p = p.join(train_lines(default_transport_type(line)), on=["dataownercode", "lineplanningnumber"], how="left_anti")
    stops = usrstop.filter(F.col("getin") | F.col("getout")).select(
        "version", "dataownercode", "userstopcode", "getin", "getout")
    info = pattern_info(jopatili, dest).select(*PATTERN, "productformulatype", "headsigns")
    j = p.join(stops, on=["version", "dataownercode", "userstopcode"]).join(info, on=PATTERN, how="left")
    formula = F.col("productformulatype")
    return j.select(
        pipe_id(*JOURNEY).alias("trip_id"),
        format_clock(F.coalesce("arr_s", "dep_s")).alias("arrival_time"),
        format_clock(F.coalesce("dep_s", "arr_s")).alias("departure_time"),
        pipe_id("dataownercode", "userstopcode").alias("stop_id"),
        F.element_at(F.col("headsigns"), F.col("stoporder").cast("int")).alias("stop_headsign"),
        F.col("stoporder").alias("stop_sequence"),
        pickup_dropoff(formula, F.col("getin")).alias("pickup_type"),
        pickup_dropoff(formula, F.col("getout")).alias("drop_off_type"),
    )


# --------------------------------------------------------------------------
# N-15 stops
# --------------------------------------------------------------------------

def gtfs_stops_kv1(
    usrstop: DataFrame,
    usrstar: DataFrame,
    point: DataFrame,
    jopatili: DataFrame,
    mode: str = "filter_then_latest",
) -> DataFrame:
    """stops.txt (N-15): parent stations per stop area plus served stops.

    Parent: mean RD position of the area's stops (per version), named after
    the newest version of the area, emitted for that version only.  Child:
    newest version of each stop that allows boarding or alighting
    (``mode='latest_then_filter'`` takes the newest version first, then
    filters), that some link begins or ends at.
    """
    pts = point.select("version", "dataownercode", F.col("pointcode").alias("userstopcode"),
                       "locationx_ew", "locationy_ns")
    members = usrstop.filter(F.col("userstopareacode").isNotNull()).select(
        "version", "dataownercode", "userstopcode", "userstopareacode").join(
        pts, on=["version", "dataownercode", "userstopcode"])
    centres = members.groupBy("version", "dataownercode", "userstopareacode").agg(
        F.avg("locationx_ew").alias("x"), F.avg("locationy_ns").alias("y"))
    newest_area = first_per_key(usrstar, ["dataownercode", "userstopareacode"], ["version"], ["version", "name"],
                                descending=True)
    parents = centres.join(newest_area, on=["version", "dataownercode", "userstopareacode"]).select(
        F.concat(pipe_id("dataownercode", "userstopareacode"), F.lit("|parent")).alias("stop_id"),
        F.col("name").alias("stop_name"),
        rd_lat("x", "y").alias("stop_lat"),
        rd_lon("x", "y").alias("stop_lon"),
        F.lit(1).alias("location_type"),
        null_of("string").alias("parent_station"),
    )
    boarding = F.col("getin") | F.col("getout")
    cols = ["version", "name", "userstopareacode", "getin", "getout"]
    if mode == "latest_then_filter":
        u = first_per_key(usrstop, ["dataownercode", "userstopcode"], ["version"], cols, descending=True).filter(boarding)
    else:
        u = first_per_key(usrstop.filter(boarding), ["dataownercode", "userstopcode"], ["version"], cols,
                          descending=True)
    served = jopatili.select("dataownercode", F.col("userstopcodebegin").alias("userstopcode")).unionByName(
        jopatili.select("dataownercode", F.col("userstopcodeend").alias("userstopcode"))).distinct()
    children = u.join(pts, on=["version", "dataownercode", "userstopcode"]) \
        .join(served, on=["dataownercode", "userstopcode"], how="left_semi").select(
        pipe_id("dataownercode", "userstopcode").alias("stop_id"),
        F.col("name").alias("stop_name"),
        rd_lat("locationx_ew", "locationy_ns").alias("stop_lat"),
        rd_lon("locationx_ew", "locationy_ns").alias("stop_lon"),
        F.lit(0).alias("location_type"),
        F.concat(pipe_id("dataownercode", "userstopareacode"), F.lit("|parent")).alias("parent_station"),
    )
    return parents.unionByName(children).distinct()


# --------------------------------------------------------------------------
# N-16 routes
# --------------------------------------------------------------------------

def gtfs_routes_kv1(line: DataFrame, jopatili: DataFrame, agency_rule: str = "kv1") -> DataFrame:
    """routes.txt (N-16): newest version of each line, rail lines left out.

    ``agency_rule='kv1'``: WATERBUS for ARR lines ``150__``, HTMBUZZ for HTM
    lines with a link of concession ``SGHB``, else the owner; the long name
    is dropped when equal to the public number.  ``agency_rule='prefix'``
    (the L2 feed): agency from the first letter of the line code (U -> GVU,
    A/X -> BRENG, L -> HERMES), long name kept.  Ties inside the newest
    version (a line with several product formulas) go to the smallest
    formula, NULL last.
    """
    spark = _spark(line)
    ln = default_transport_type(line).filter(F.col("transporttype") != "TRAIN")
    ln = ln.join(M.route_types(spark), on="transporttype")
    pf = jopatili.select("version", "dataownercode", "lineplanningnumber", "productformulatype").distinct() \
        .join(M.product_formulas(spark), on="productformulatype", how="left")
    j = ln.join(pf, on=["version", "dataownercode", "lineplanningnumber"])
    line_text = as_text("lineplanningnumber")
    if agency_rule == "prefix":
        first = F.substring(line_text, 1, 1)
        agency = (F.when(first == "U", F.lit("GVU")).when(first.isin("A", "X"), F.lit("BRENG"))
                  .when(first == "L", F.lit("HERMES")).otherwise(F.col("dataownercode")))
        long_name = F.col("linename")
    else:
        if "confinrelcode" in jopatili.columns:
            buzz = jopatili.filter(F.col("confinrelcode") == "SGHB").select(
                "lineplanningnumber").distinct().withColumn("is_buzz", F.lit(True))
            j = j.join(buzz, on="lineplanningnumber", how="left")
        else:
            j = j.withColumn("is_buzz", F.lit(None).cast("boolean"))
        agency = (F.when((F.col("dataownercode") == "ARR") & line_text.like("150__"), F.lit("WATERBUS"))
                  .when((F.col("dataownercode") == "HTM") & F.col("is_buzz"), F.lit("HTMBUZZ"))
                  .otherwise(F.col("dataownercode")))
        long_name = F.when(as_text("linepublicnumber") != F.col("linename"), F.col("linename"))
    j = j.select(
        "dataownercode", "lineplanningnumber", "version", "productformulatype",
        pipe_id("dataownercode", "lineplanningnumber").alias("route_id"),
        agency.alias("agency_id"),
        as_text("linepublicnumber").alias("route_short_name"),
        long_name.alias("route_long_name"),
        F.col("route_type"),
        F.col("localized_route_type"),
    )
    # newest version first; then smallest formula, NULL last
    tiebreak = F.coalesce(-F.col("productformulatype").cast("long"), F.lit(-(2 ** 62)))
    out_cols = ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type", "localized_route_type"]
    picked = first_per_key(j, ["dataownercode", "lineplanningnumber"], [F.col("version"), tiebreak], out_cols,
                           descending=True)
    return picked.select(*out_cols)


# --------------------------------------------------------------------------
# N-21 shapes
# --------------------------------------------------------------------------

def gtfs_shapes(
    jopatili: DataFrame,
    pool: DataFrame,
    line: DataFrame,
    point: DataFrame | None = None,
    rank_mode: str = "rank",
    exclude_train: bool = True,
    match_transport: bool = False,
    tiebreak: tuple[str, ...] = ("pointcode",),
) -> DataFrame:
    """shapes.txt (N-21): the pool points of every pattern's links, numbered.

    ``rank_mode='rank'`` numbers with ``rank()`` over (link order, distance
    along the link) so equal distances share a number; ``'row_number'``
    numbers every point (ties broken by ``tiebreak``) and keeps the first
    point per (link order, distance, link validity).  ``pool`` either carries
    ``locationx_ew/locationy_ns`` itself or is joined to ``point``.  Points are
    numbered within their link, and the points of earlier links added, so a
    pattern with a huge geometry is no single window partition.
    """
    j = jopatili.select(*PATTERN, "timinglinkorder", "userstopcodebegin", "userstopcodeend")
    pl = pool
    if point is not None:
        pts = point.select(F.col("version"), F.col("dataownercode").alias("pointdataownercode"), "pointcode",
                           "locationx_ew", "locationy_ns")
        pl = pl.join(pts, on=["version", "pointdataownercode", "pointcode"])
    lines = default_transport_type(line)
    s = j.join(pl, on=["version", "dataownercode", "userstopcodebegin", "userstopcodeend"])
    lkeys = lines.select("version", "dataownercode", "lineplanningnumber",
                         F.col("transporttype").alias("line_transporttype")).distinct()
    s = s.join(lkeys, on=["version", "dataownercode", "lineplanningnumber"])
    if match_transport and "transporttype" in pl.columns:
        s = s.filter(F.col("transporttype") == F.col("line_transporttype"))
    if exclude_train:
        s = s.join(train_lines(lines), on=["dataownercode", "lineplanningnumber"], how="left_anti")
    if rank_mode == "rank":
        s = nested_rank(s, PATTERN, "timinglinkorder", ["distancesincestartoflink"], "shape_pt_sequence", "rank")
    else:
        ties = [c for c in tiebreak if c in s.columns] + ["locationx_ew", "locationy_ns"]
        s = nested_rank(s, PATTERN, "timinglinkorder", ["distancesincestartoflink", *ties], "shape_pt_sequence", "row_number")
        dedup = PATTERN + ["timinglinkorder", "distancesincestartoflink"]
        if "linkvalidfrom" in s.columns:
            dedup.append("linkvalidfrom")
        s = first_per_key(s, dedup, ["shape_pt_sequence"], ["shape_pt_sequence", "locationx_ew", "locationy_ns"])
    return s.select(
        pipe_id(*PATTERN).alias("shape_id"),
        rd_lat("locationx_ew", "locationy_ns").alias("shape_pt_lat"),
        rd_lon("locationx_ew", "locationy_ns").alias("shape_pt_lon"),
        F.col("shape_pt_sequence"),
    ).distinct()
