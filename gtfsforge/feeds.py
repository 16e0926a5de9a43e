"""One call per lineage: parsed feed tables -> the GTFS tables (N-40).

Each builder returns a dict of lazy DataFrames (``agency``, ``feed_info``,
``stops``, ``routes``, ``calendar_dates``, ``trips``, ``stop_times``,
``shapes``, ``transfers`` where the lineage has them); ``sinks.write_feed``
writes them.  Tables that several GTFS outputs read (the pruned passes, the
run-time offsets) are written once to the session's checkpoint folder when
``materialize`` is set, so each output plan starts from stored Parquet
instead of recomputing them.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import calendars as C
from .operators import checks as K
from .operators import gtfs_demand as D
from .operators import gtfs_iff as I
from .operators import gtfs_kv1 as G
from .operators import gtfs_pas as P
from .operators import profiles as R
from .session import scratch_path, shuffles_released
from .sinks import empty_table


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that several outputs read, and read it back."""
    path = scratch_path(df.sparkSession, f"feeds/{name}-{uuid.uuid4().hex}")
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# ---- fixed values: how owners' shapes differ (default: rank, any transport type) ----
FEED_OPTIONS = {
    "GVB": {"rank_mode": "row_number", "match_transport": True},
    "SYNTUS": {"rank_mode": "row_number"},
    "VTN": {"rank_mode": "row_number"},
    "EBS": {"match_transport": True},
    "HTM": {"match_transport": True},
}
# the feeds of a full run, in order
FEED_OWNERS = ("GVB", "ARR", "QBUZZ", "VTN", "EBS", "HTM", "SYNTUS")
# ---- end of fixed values ----


def store_feed(feed: dict[str, DataFrame], side_by_side: bool = True) -> dict[str, DataFrame]:
    """Every table of a built feed written once to the shared folder and read back.  The tables
    are written side by side: a small one does not wait for a large one's last tasks.  Written one
    after the other, they need the disk for the shuffles of one table at a time."""
    with ThreadPoolExecutor(max_workers=len(feed) or 1 if side_by_side else 1) as pool:
        done = {name: pool.submit(store, df, name) for name, df in feed.items()}
        return {name: job.result() for name, job in done.items()}


def of_owner(t: dict[str, DataFrame], owner: str) -> dict[str, DataFrame]:
    """The tables' rows of one data owner."""
    return {name: df.filter(F.col("dataownercode") == owner) if "dataownercode" in df.columns else df for name, df in t.items()}


def build_all_kv1(t: dict[str, DataFrame], owners: tuple[str, ...] = FEED_OWNERS, **options) -> dict[str, dict[str, DataFrame]]:
    """One passing-time feed per owner, each with its own options (N-40)."""
    return {o: build_kv1(of_owner(t, o), owner=o, **options) for o in owners}


def build_kv1(t: dict[str, DataFrame], agency_ids: DataFrame | None = None, feed_version: str = "1",
              materialize: bool = False, owner: str | None = None) -> dict[str, DataFrame]:
    """Passing-time feeds (L1): pujopass, operday, jopa, jopatili, dest, line,
    usrstop, usrstar, point, pool.  ``owner`` chooses the options of FEED_OPTIONS.
    Agencies are those that the routes name (WATERBUS, which no agency list has,
    gets a row without name)."""
    how = {"rank_mode": "rank", **FEED_OPTIONS.get(owner, {})}
    routes = G.gtfs_routes_kv1(t["line"], G.product_formula_fixes(t["jopatili"]))
    jopatili = G.product_formula_fixes(t["jopatili"])
    passes = G.prune_unscheduled(t["pujopass"], t["operday"])
    if materialize:
        passes = store(passes, "pujopass")
    return {
        "agency": G.gtfs_agency_kv1(routes, owner_col="agency_id") if agency_ids is None else G.gtfs_agency_kv1(agency_ids),
        "feed_info": G.gtfs_feed_info(t["operday"], "validdate", feed_version=feed_version),
        "stops": G.gtfs_stops_kv1(t["usrstop"], t["usrstar"], t["point"], jopatili),
        "routes": routes,
        "calendar_dates": G.gtfs_calendar_dates(t["operday"]),
        "trips": G.gtfs_trips_kv1(passes, t["jopa"], jopatili, t["dest"], t["line"]),
        "stop_times": G.gtfs_stop_times_kv1(passes, t["usrstop"], jopatili, t["dest"], t["line"]),
        "shapes": G.gtfs_shapes(jopatili, t["pool"], t["line"], point=t.get("point_for_pool"), **how),
    }


def build_kv1_demand(t: dict[str, DataFrame], version: DataFrame, as_of: _dt.date, feed_version: str = "1",
                     materialize: bool = False, exclude_lines: DataFrame | None = None,
                     exclude_units: DataFrame | None = None) -> dict[str, DataFrame]:
    """Validity + time-demand feeds (L2): pujo, timdemrnt, link, tive,
    pegrval, excopday, jopa, jopatili, dest, line, usrstop, usrstar, point, pool.
    ``exclude_lines`` and ``exclude_units`` leave out the stop times of some lines and
    the calendar of some units (the variant feed)."""
    routes = G.gtfs_routes_kv1(t["line"], t["jopatili"], agency_rule="prefix")
    timdempass = R.pass_offsets(R.redistribute_drive_time(t["timdemrnt"], t.get("link")))
    if materialize:
        timdempass = store(timdempass, "timdempass")
    return {
        "agency": G.gtfs_agency_kv1(routes, owner_col="agency_id"),
        "feed_info": G.gtfs_feed_info(version, "validfrom", "validthru", feed_version=feed_version),
        "stops": G.gtfs_stops_kv1(t["usrstop"], t["usrstar"], t["point"], t["jopatili"], mode="latest_then_filter"),
        "routes": routes,
        "calendar_dates": C.calendar_with_exceptions(t["pegrval"], t["pujo"], t["tive"], t["excopday"], version, as_of,
                                                  exclude_units=exclude_units),
        "trips": D.gtfs_trips_demand(t["pujo"], t["jopa"], t["jopatili"], t["dest"]),
        "stop_times": D.gtfs_stop_times_demand(t["pujo"], timdempass, t["jopatili"], t["usrstop"], t["dest"],
                                               exclude_lines=exclude_lines),
        "shapes": G.gtfs_shapes(t["jopatili"], t["pool"], t["line"], point=t.get("point_for_pool"),
                                rank_mode="row_number", exclude_train=False),
    }


def build_iff(t: dict[str, DataFrame], first_day, version: int = 3, positioned: DataFrame | None = None,
              feed_version: str = "1") -> dict[str, DataFrame]:
    """Rail feeds (L3) from ``sources.iff.read_iff`` tables."""
    spark = t["stop"].sparkSession
    prepared = I.prepare(t, version)
    return {
        "agency": I.gtfs_agency_iff(prepared["company"], prepared["service"], version=version),
        "feed_info": G.gtfs_feed_info(t["delivery"], "firstday", "lastday", feed_version=feed_version),
        "calendar_dates": C.gtfs_calendar_dates_footnotes(C.bitmap_dates(t["footnote_bits"], first_day)),
        "stops": I.gtfs_stops_iff(t["station"], t["stop"], t["platform"], positioned, version=version),
        **I.exports(t, version),
        "shapes": empty_table(spark, "shape_id string, shape_pt_lat double, shape_pt_lon double, "
                                     "shape_pt_sequence int"),
    }


def build_pas(t: dict[str, DataFrame], linepublicnumber: DataFrame | None = None,
              feed_version: str = "1") -> dict[str, DataFrame]:
    """Metro feeds (L4): stops, pujo, pujopass, voetnoot."""
    stops, passes = P.pas_clean_stops(t["stops"], t["pujopass"])
    return {
        "agency": P.gtfs_agency_pas(stops.sparkSession),
        "feed_info": G.gtfs_feed_info(t["voetnoot"], "datum", feed_version=feed_version),
        "calendar_dates": P.gtfs_calendar_dates_pas(t["voetnoot"]),
        "stops": P.gtfs_stops_pas(stops),
        "routes": P.gtfs_routes_pas(t["pujo"], linepublicnumber),
        "trips": P.gtfs_trips_pas(t["pujo"], passes, stops),
        "stop_times": P.gtfs_stop_times_pas(passes),
    }


def validate(feed: dict[str, DataFrame]) -> DataFrame:
    """N-39 over a built feed."""
    return K.validate_gtfs(feed)
