"""GTFS from PAS metro/tram/bus timetables (N-23, N-34, N-35).

Inputs (see ``sources/pas.py``): ``pujo`` (modaliteit, vervoerdercode,
lijnsysteemnr, richting, ritnummer, voetnoot), ``pujopass`` (vervoerdercode,
lijnsysteemnr, richting, ritnummer, voetnoot, stopsequentie, halteid,
arr_s, dep_s), ``stops`` (halteid, naam, x, y, ...), ``voetnoot``
(voetnoot, datum) and an optional line-number lookup (lijnsysteemnr,
linepublicnumber).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import as_text, null_of, pipe_id
from ..functions.first import first_per_key
from ..functions.geo import rd_lat, rd_lon
from ..functions.times import DAY, format_clock
from . import mappings as M

TRIP = ["vervoerdercode", "lijnsysteemnr", "richting", "ritnummer", "voetnoot"]

# ---- fixed values (clean-up rules of the metro feed) ----
DEPOT_PATTERNS = ("%Remise%", "%Garage%", "%Opstelspoor%")
COORDINATE_FIXES = [("HA3914", 99999, 65869, 442059)]  # (halteid, wrong x, x, y)
PAS_AGENCY = ("000024", "RET", "http://www.ret.nl")
# ---- end of fixed values ----


# --------------------------------------------------------------------------
# N-23 midnight rollover
# --------------------------------------------------------------------------

def normalise_midnight(passes: DataFrame, trip_keys=TRIP, order: str = "stopsequentie",
                       arr: str = "arr_s", dep: str = "dep_s") -> DataFrame:
    """Add 24 h to every time after the clock drops within a trip (N-23).

    Arrivals and departures are read as one interleaved sequence
    (arr1, dep1, arr2, dep2, …), so a wrap between a departure and the next
    arrival is seen (§8-D4).  Each drop below the previous known time adds
    one day to it and to everything after it.  Two window passes over the
    same per-trip partition; every row keeps its other columns.
    """
    w = Window.partitionBy(*trip_keys).orderBy(order)
    last_of_row = F.coalesce(F.col(dep), F.col(arr))
    prev = F.last(last_of_row, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    p = passes.withColumn("__prev", prev)
    d_arr = F.coalesce((F.col(arr) < F.col("__prev")).cast("int"), F.lit(0))
    d_dep = F.coalesce((F.col(dep) < F.coalesce(F.col(arr), F.col("__prev"))).cast("int"), F.lit(0))
    p = p.withColumn("__da", d_arr).withColumn("__dd", d_dep)
    before = F.coalesce(F.sum(F.col("__da") + F.col("__dd")).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    p = p.withColumn("__c", before)
    return p.withColumn(arr, F.col(arr) + DAY * (F.col("__c") + F.col("__da"))) \
        .withColumn(dep, F.col(dep) + DAY * (F.col("__c") + F.col("__da") + F.col("__dd"))) \
        .drop("__prev", "__da", "__dd", "__c")


# --------------------------------------------------------------------------
# N-35 clean-ups
# --------------------------------------------------------------------------

def pas_clean_stops(stops: DataFrame, pujopass: DataFrame, patterns=DEPOT_PATTERNS,
                    fixes=COORDINATE_FIXES) -> tuple[DataFrame, DataFrame]:
    """Drop depot/siding stops and, by cascade, their passes; fix known
    wrong coordinates (N-35, B-6)."""
    depot = None
    for pat in patterns:
        c = F.col("naam").like(pat)
        depot = c if depot is None else depot | c
    kept = stops.filter(~F.coalesce(depot, F.lit(False)))
    for halte, wrong_x, x, y in fixes:
        hit = (F.col("halteid") == halte) & (F.col("x") == wrong_x)
        kept = kept.withColumn("y", F.when(hit, F.lit(y)).otherwise(F.col("y"))) \
            .withColumn("x", F.when(hit, F.lit(x)).otherwise(F.col("x")))
    passes = pujopass.join(kept.select("halteid"), on="halteid", how="left_semi")
    return kept, passes


# --------------------------------------------------------------------------
# N-34 GTFS tables
# --------------------------------------------------------------------------

def gtfs_agency_pas(spark) -> DataFrame:
    aid, name, url = PAS_AGENCY
    return spark.createDataFrame([(aid, name, url, M.AGENCY_TIMEZONE, M.AGENCY_LANG)],
                                 "agency_id string, agency_name string, agency_url string, agency_timezone string, "
                                 "agency_lang string")


def gtfs_calendar_dates_pas(voetnoot: DataFrame) -> DataFrame:
    from .calendars import gtfs_calendar_dates_footnotes
    return gtfs_calendar_dates_footnotes(voetnoot, prefix="", key="voetnoot", date_col="datum")


def gtfs_stops_pas(stops: DataFrame) -> DataFrame:
    return stops.select(F.col("halteid").alias("stop_id"), F.col("naam").alias("stop_name"),
                        rd_lat("x", "y", 9, 6).alias("stop_lat"), rd_lon("x", "y", 8, 5).alias("stop_lon"))


def gtfs_routes_pas(pujo: DataFrame, linepublicnumber: DataFrame | None = None) -> DataFrame:
    """One route per line system number; modes without a route type drop out.
    Where a line has several operators or modes, the smallest (operator,
    route type) is kept."""
    spark = pujo.sparkSession
    j = pujo.select("lijnsysteemnr", "vervoerdercode", "modaliteit").distinct() \
        .join(M.pas_route_types(spark), on="modaliteit")
    if linepublicnumber is not None:
        j = j.join(linepublicnumber.select("lijnsysteemnr", "linepublicnumber"), on="lijnsysteemnr", how="left")
    else:
        j = j.withColumn("linepublicnumber", null_of("string"))
    j = first_per_key(j, ["lijnsysteemnr"], ["vervoerdercode", "route_type"],
                      ["vervoerdercode", "route_type", "linepublicnumber"])
    return j.select(
        as_text("lijnsysteemnr").alias("route_id"), F.col("vervoerdercode").alias("agency_id"),
        F.coalesce(F.col("linepublicnumber"), as_text("lijnsysteemnr")).alias("route_short_name"),
        null_of("string").alias("route_long_name"), F.col("route_type"))


def gtfs_trips_pas(pujo: DataFrame, pujopass: DataFrame, stops: DataFrame) -> DataFrame:
    """trips.txt: headsign = name of the trip's last stop, one trip per
    journey (the last stop is ``max_by`` per journey, §8-D20)."""
    last = pujopass.groupBy(*TRIP).agg(F.max_by("halteid", "stopsequentie").alias("halteid"))
    names = stops.select("halteid", "naam")
    j = pujo.join(last, on=TRIP).join(names, on="halteid")
    return j.select(
        as_text("lijnsysteemnr").alias("route_id"), as_text("voetnoot").alias("service_id"),
        pipe_id("voetnoot", "ritnummer").alias("trip_id"), F.col("naam").alias("trip_headsign"),
        (F.col("richting") - 1).alias("direction_id"), as_text("ritnummer").alias("tripcode"))


def gtfs_stop_times_pas(pujopass: DataFrame) -> DataFrame:
    return pujopass.select(
        pipe_id("voetnoot", "ritnummer").alias("trip_id"),
        format_clock(F.coalesce("arr_s", "dep_s")).alias("arrival_time"),
        format_clock(F.coalesce("dep_s", "arr_s")).alias("departure_time"),
        as_text("halteid").alias("stop_id"), F.col("stopsequentie").alias("stop_sequence"))

