"""Queries over the PAS metro lineage (L4) and the midnight rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gtfs_pas as G
from .fixtures import Fixtures, duckdb_with
from .sqltext import clock, lat, lon

_J = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode", "lineplanningnumber",
      "journeynumber"]
_JK = ", ".join(_J)
_TRIP = ", ".join(G.TRIP)


def _clean(fx: Fixtures):
    return G.pas_clean_stops(fx.pas_stops, fx.pas_pujopass)


# ---- q_midnight (N-23) ------------------------------------------------------

def q_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Fixtures(spark, sf_dir).passes.select(*_J, "stoporder", (F.col("arr_s") % 86400).alias("arr_s"),
                                              (F.col("dep_s") % 86400).alias("dep_s"))
    return G.normalise_midnight(p, trip_keys=_J, order="stoporder")


SQL_MIDNIGHT = duckdb_with(["passes"], f"""
, m as (select {_JK}, stoporder, arr_s % 86400 as arr_s, dep_s % 86400 as dep_s from passes),
ev as (select {_JK}, stoporder, 0 as kind, arr_s as v from m where arr_s is not null
   union all select {_JK}, stoporder, 1 as kind, dep_s as v from m where dep_s is not null),
ev2 as (select *, case when v < lag(v) over (partition by {_JK} order by stoporder, kind) then 1 else 0 end as dropped from ev),
ev3 as (select *, v + 86400 * sum(dropped) over (partition by {_JK} order by stoporder, kind rows between unbounded preceding and current row) as nv from ev2),
piv as (select {_JK}, stoporder, max(case when kind = 0 then nv end) as arr_s, max(case when kind = 1 then nv end) as dep_s from ev3 group by all)
select {', '.join('m.' + c for c in _J)}, m.stoporder, p.arr_s, p.dep_s
from m left join piv p on {' and '.join(f'p.{c} = m.{c}' for c in _J)} and p.stoporder = m.stoporder
""")


# ---- q_pas_stops / q_pas_routes / q_pas_trips / q_pas_stop_times (N-34, N-35) -

def q_pas_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops, _ = _clean(Fixtures(spark, sf_dir))
    return G.gtfs_stops_pas(stops)


_CLEAN = """
, st as (select * from pas_stops where not (naam like '%Remise%' or naam like '%Garage%' or naam like '%Opstelspoor%')),
pp as (select * from pas_pujopass where halteid in (select halteid from st))"""

SQL_PAS_STOPS = duckdb_with(["pas_stops", "pas_pujopass"], _CLEAN + f"""
select halteid as stop_id, naam as stop_name, {lat('x', 'y', 9, 6)} as stop_lat, {lon('x', 'y', 8, 5)} as stop_lon from st
""")


def q_pas_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return G.gtfs_routes_pas(fx.pas_pujo, fx.pas_lines)


SQL_PAS_ROUTES = duckdb_with(["pas_pujo", "pas_lines"], """
, rt(modaliteit, route_type) as (values ('T', 0), ('M', 1), ('B', 3), ('H', 3), ('F', 4)),
r as (select p.lijnsysteemnr, p.vervoerdercode, rt.route_type, l.linepublicnumber,
   row_number() over (partition by p.lijnsysteemnr order by p.vervoerdercode, rt.route_type) as rn
   from (select distinct lijnsysteemnr, vervoerdercode, modaliteit from pas_pujo) p join rt on rt.modaliteit = p.modaliteit
   left join pas_lines l on l.lijnsysteemnr = p.lijnsysteemnr)
select lijnsysteemnr as route_id, vervoerdercode as agency_id, coalesce(linepublicnumber, lijnsysteemnr) as route_short_name,
 cast(null as varchar) as route_long_name, route_type from r where rn = 1
""")


def q_pas_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    stops, passes = _clean(fx)
    return G.gtfs_trips_pas(fx.pas_pujo, passes, stops)


SQL_PAS_TRIPS = duckdb_with(["pas_stops", "pas_pujopass", "pas_pujo"], _CLEAN + f"""
, last as (select {_TRIP}, arg_max(halteid, stopsequentie) as halteid from pp group by all)
select p.lijnsysteemnr as route_id, p.voetnoot as service_id, p.voetnoot || '|' || p.ritnummer as trip_id, st.naam as trip_headsign,
 p.richting - 1 as direction_id, p.ritnummer as tripcode
from pas_pujo p join last e on {' and '.join(f'e.{c} = p.{c}' for c in G.TRIP)}
join st on st.halteid = e.halteid
""")


def q_pas_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, passes = _clean(Fixtures(spark, sf_dir))
    return G.gtfs_stop_times_pas(G.normalise_midnight(passes))


SQL_PAS_STOP_TIMES = duckdb_with(["pas_stops", "pas_pujopass"], _CLEAN + f"""
select voetnoot || '|' || ritnummer as trip_id, {clock('coalesce(arr_s, dep_s)')} as arrival_time,
 {clock('coalesce(dep_s, arr_s)')} as departure_time, halteid as stop_id, stopsequentie as stop_sequence from pp
""")


# ---- q_pas_calendar_dates / q_pas_feed_info (N-34) -------------------------

PAS_FIRST_DAY = "2024-01-01"


def _voetnoot(fx: Fixtures) -> DataFrame:
    from ..operators.calendars import bitmap_dates

    b = fx.bitmaps.select(F.lpad(F.col("footnote").cast("string"), 5, "0").alias("voetnoot"), "bits")
    return bitmap_dates(b, PAS_FIRST_DAY, key="voetnoot").withColumnRenamed("servicedate", "datum")


def q_pas_calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gtfs_calendar_dates_pas(_voetnoot(Fixtures(spark, sf_dir)))


_VTN = f"""
, vt as (select lpad(cast(footnote as varchar), 5, '0') as voetnoot, date '{PAS_FIRST_DAY}' + cast(i - 1 as integer) as datum
   from bitmaps, generate_series(1, 14) as t(i) where substr(bits, cast(i as integer), 1) = '1')"""

SQL_PAS_CALENDAR_DATES = duckdb_with(["bitmaps"], _VTN + """
select voetnoot as service_id, strftime(datum, '%Y%m%d') as date, '1' as exception_type from vt
""")


def q_pas_feed_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.gtfs_kv1 import gtfs_feed_info

    return gtfs_feed_info(_voetnoot(Fixtures(spark, sf_dir)), "datum", feed_version="1")


SQL_PAS_FEED_INFO = duckdb_with(["bitmaps"], _VTN + f"""
select 'feed publisher' as feed_publisher_name, 'http://example.org/' as feed_publisher_url, 'nl' as feed_lang,
 strftime(min(datum), '%Y%m%d') as feed_start_date, strftime(max(datum), '%Y%m%d') as feed_end_date, '1' as feed_version from vt
""")


QUERIES = {
    "q_pas_calendar_dates": (q_pas_calendar_dates, SQL_PAS_CALENDAR_DATES),
    "q_pas_feed_info": (q_pas_feed_info, SQL_PAS_FEED_INFO),
    "q_midnight": (q_midnight, SQL_MIDNIGHT),
    "q_pas_stops": (q_pas_stops, SQL_PAS_STOPS),
    "q_pas_routes": (q_pas_routes, SQL_PAS_ROUTES),
    "q_pas_trips": (q_pas_trips, SQL_PAS_TRIPS),
    "q_pas_stop_times": (q_pas_stop_times, SQL_PAS_STOP_TIMES),
}
