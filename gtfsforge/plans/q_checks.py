"""Integrity checks and feed validation over driver tables and derived feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..feeds import store_feed
from ..operators import checks as K
from ..operators import constraints as G
from ..operators import gtfs_iff as I
from ..operators.gtfs_kv1 import SCHED
from . import q_iff, q_kv1
from .fixtures import Fixtures, duckdb_with, render


def q_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.check_primary_key(Fixtures(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


SQL_PK = """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1
"""


def q_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return K.check_foreign_key(fx.manifest, fx.ledger, ["feedkey"])


SQL_FK = duckdb_with(["manifest", "ledger"], """
select feedkey, count(*) as n from manifest m
where feedkey is not null and not exists (select 1 from ledger l where l.feedkey = m.feedkey) group by feedkey
""")


def q_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.check_not_null(Fixtures(spark, sf_dir).passes)


_PASS_COLS = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode",
              "lineplanningnumber", "journeynumber", "stoporder", "journeypatterncode", "userstopcode", "arr_s",
              "dep_s", "wheelchairaccessible"]
SQL_NOT_NULL = duckdb_with(["passes"], "\n" + "\nunion all\n".join(
    f"select '{c}' as column, cast(count(*) - count({c}) as bigint) as nulls from passes" for c in _PASS_COLS))


def kv1_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The feed of the passing-time queries.  The schedules that prune the passes are stored first: the planner sees
    from their size whether the passes must be shuffled to meet them."""
    t = q_kv1.kv1_tables(Fixtures(spark, sf_dir))
    t.update(store_feed({"operday": t["operday"].select(*SCHED).distinct()}))
    return {
        "stop_times": q_kv1.q_stop_times(spark, sf_dir, t), "trips": q_kv1.q_trips(spark, sf_dir, t),
        "stops": q_kv1.q_stops(spark, sf_dir), "routes": q_kv1.q_routes(spark, sf_dir),
        "calendar_dates": q_kv1.q_calendar_dates(spark, sf_dir), "agency": q_kv1.q_agency(spark, sf_dir),
    }


# Violations planted into the feed, one text for both engines: rows twice, times that run backwards, unknown trips
# and stops, unknown routes and services, days twice, a stop abroad.  Routes without agency are there already.
PLANTED = {
    "stop_times": """
select trip_id, case when trip_id like '%7' and stop_sequence = 3 then '00:00:01' else arrival_time end as arrival_time, departure_time, stop_id, stop_sequence from {stop_times}
union all select trip_id, arrival_time, departure_time, stop_id, stop_sequence from {stop_times} where trip_id like '%3' and stop_sequence = 2
union all select concat('lost|', trip_id), arrival_time, departure_time, stop_id, stop_sequence from {stop_times} where trip_id like '%11'
union all select concat(trip_id, ''), arrival_time, departure_time, 'nowhere', stop_sequence + 100 from {stop_times} where trip_id like '%13' and stop_sequence = 1""",
    "trips": """
select route_id, service_id, trip_id from {trips}
union all select concat(route_id, '|gone'), service_id, concat(trip_id, '|a') from {trips} where trip_id like '%17'
union all select route_id, concat(service_id, '|gone'), concat(trip_id, '|b') from {trips} where trip_id like '%19'""",
    "calendar_dates": """
select service_id, date from {calendar_dates} union all select service_id, date from {calendar_dates} where date like '%05'""",
    "stops": """
select stop_id, stop_lat, stop_lon from {stops}
union all select concat(stop_id, '|abroad'), stop_lat, stop_lon + 20 from {stops} where stop_id like '%1'""",
}


# The same rows in one pass: a union derives its table anew for every part.  Copy 0 is the table itself.
PLANTED_AT_ONCE = {
    "stop_times": """
select case when copy = 2 then concat('lost|', trip_id) else trip_id end as trip_id,
 case when copy = 0 and trip_id like '%7' and stop_sequence = 3 then '00:00:01' else arrival_time end as arrival_time, departure_time,
 case when copy = 3 then 'nowhere' else stop_id end as stop_id, case when copy = 3 then stop_sequence + 100 else stop_sequence end as stop_sequence
from (select trip_id, arrival_time, departure_time, stop_id, stop_sequence, @EXPLODE(0, 1, 2, 3)@ as copy from {stop_times}) x
where copy = 0 or (copy = 1 and trip_id like '%3' and stop_sequence = 2) or (copy = 2 and trip_id like '%11') or (copy = 3 and trip_id like '%13' and stop_sequence = 1)""",
    "trips": """
select case when copy = 1 then concat(route_id, '|gone') else route_id end as route_id, case when copy = 2 then concat(service_id, '|gone') else service_id end as service_id,
 case when copy = 1 then concat(trip_id, '|a') when copy = 2 then concat(trip_id, '|b') else trip_id end as trip_id
from (select route_id, service_id, trip_id, @EXPLODE(0, 1, 2)@ as copy from {trips}) x
where copy = 0 or (copy = 1 and trip_id like '%17') or (copy = 2 and trip_id like '%19')""",
    "calendar_dates": """
select service_id, date from (select service_id, date, @EXPLODE(0, 1)@ as copy from {calendar_dates}) x where copy = 0 or date like '%05'""",
    "stops": """
select case when copy = 1 then concat(stop_id, '|abroad') else stop_id end as stop_id, stop_lat, case when copy = 1 then stop_lon + 20 else stop_lon end as stop_lon
from (select stop_id, stop_lat, stop_lon, @EXPLODE(0, 1)@ as copy from {stops}) x where copy = 0 or stop_id like '%1'""",
}


def q_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = kv1_feed(spark, sf_dir)
    for t, text in PLANTED_AT_ONCE.items():
        feed[t] = spark.sql(render(text, "spark"), **{t: feed[t]})
    return K.validate_gtfs(store_feed(feed))


# ---- q_stops_too_close, q_fast_travel, q_block_overlaps (N-39) ----------------

CLOSE_M = 400.0
FAST_KMH = 120.0


def q_stops_too_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.stops_too_close(q_kv1.q_stops(spark, sf_dir), CLOSE_M)


def q_fast_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.fast_travel(q_kv1.q_stop_times(spark, sf_dir), q_kv1.q_stops(spark, sf_dir), FAST_KMH).select("trip_id", "stop_sequence", F.round("metres").cast("long").alias("metres"), "seconds")


def q_block_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rail trips; a vehicle (block) runs every 50th service."""
    feed = I.exports(q_iff.iff_tables(Fixtures(spark, sf_dir)))
    trips = feed["trips"].withColumn("block_id", F.col("block_id") % 50)
    return K.block_overlaps(trips, feed["stop_times"], q_iff.q_bitmap(spark, sf_dir))


_METRES = "2 * 6371008.8 * asin(sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))"
_POINTS = f"""with sp as ({q_kv1.SQL_STOPS}), pt as (select stop_id, cast(stop_lat as double) as lat, cast(stop_lon as double) as lon from sp)"""

SQL_STOPS_TOO_CLOSE = f"""{_POINTS}
select a.stop_id, count(*) as n_close from pt a join pt b on a.stop_id <> b.stop_id and {_METRES.format(a='a.lat', b='a.lon', c='b.lat', d='b.lon')} <= {CLOSE_M} group by a.stop_id
"""

def _to_s(col: str) -> str:
    return (f"(cast(split_part({col}, ':', 1) as integer) * 3600 + cast(split_part({col}, ':', 2) as integer) * 60 "
            f"+ cast(split_part({col}, ':', 3) as integer))")


_PLANTED = {t: text.format(**{t: f"{t}_0"}) for t, text in PLANTED.items()}
SQL_VALIDATE = f"""
with stop_times_0 as ({q_kv1.SQL_STOP_TIMES}), trips_0 as ({q_kv1.SQL_TRIPS}), stops_0 as ({q_kv1.SQL_STOPS}),
rt as ({q_kv1.SQL_ROUTES}), calendar_dates_0 as ({q_kv1.SQL_CALENDAR_DATES}), ag as ({q_kv1.SQL_AGENCY}),
st as ({_PLANTED["stop_times"]}), tr as ({_PLANTED["trips"]}), sp as ({_PLANTED["stops"]}), cd as ({_PLANTED["calendar_dates"]}),
tm as (select trip_id, {_to_s('arrival_time')} as a, {_to_s('departure_time')} as d,
   lag({_to_s('departure_time')}) over (partition by trip_id order by stop_sequence, {_to_s('arrival_time')}, {_to_s('departure_time')}) as prev_d from st),
r as (
 select 'stop_times_duplicate_key' as rule, count(*) as violations from (select trip_id, stop_sequence from st group by all having count(*) > 1)
 union all select 'stop_times_time_decreases', count(*) from tm where a < prev_d or d < a
 union all select 'stop_times_unknown_trip', count(*) from st where trip_id not in (select trip_id from tr where trip_id is not null)
 union all select 'stop_times_unknown_stop', count(*) from st where stop_id not in (select stop_id from sp where stop_id is not null)
 union all select 'trips_unknown_route', count(*) from tr where route_id not in (select route_id from rt where route_id is not null)
 union all select 'trips_unknown_service', count(*) from tr where service_id not in (select service_id from cd where service_id is not null)
 union all select 'routes_unknown_agency', count(*) from rt where agency_id not in (select agency_id from ag where agency_id is not null)
 union all select 'calendar_dates_duplicate', count(*) from (select service_id, date from cd group by all having count(*) > 1)
 union all select 'stops_out_of_bounds', count(*) from sp where not (cast(stop_lat as double) between 50.5 and 53.8
   and cast(stop_lon as double) between 3.2 and 7.3))
select rule, violations from r where violations > 0
"""

SQL_FAST_TRAVEL = f"""{_POINTS}, st as ({q_kv1.SQL_STOP_TIMES}),
t as (select trip_id, stop_sequence, lat, lon, {_to_s('arrival_time')} as a, {_to_s('departure_time')} as d from st join pt using (stop_id)),
l as (select *, lag(lat) over w as p_lat, lag(lon) over w as p_lon, lag(d) over w as p_d from t window w as (partition by trip_id order by stop_sequence))
select trip_id, stop_sequence, cast(round(m) as bigint) as metres, s as seconds
from (select trip_id, stop_sequence, {_METRES.format(a='p_lat', b='p_lon', c='lat', d='lon')} as m, a - p_d as s from l) x where m is not null and m * 3.6 > greatest(s, 1) * {FAST_KMH}
"""

SQL_BLOCK_OVERLAPS = f"""
with tr as ({q_iff.SQL_IFF_TRIPS}), st as ({q_iff.SQL_IFF_STOP_TIMES}), cd as ({q_iff.SQL_BITMAP}),
tm as (select trip_id, min({_to_s('departure_time')}) as start_s, max({_to_s('arrival_time')}) as end_s from st where trip_id is not null group by trip_id),
run as (select distinct block_id % 50 as block_id, date, trip_id, start_s, end_s from tr join tm using (trip_id) join cd using (service_id))
select b.block_id, b.date, b.trip_id, b.start_s, max(a.end_s) as busy_until_s
from run b join run a on a.block_id = b.block_id and a.date = b.date and (a.start_s, a.end_s, a.trip_id) < (b.start_s, b.end_s, b.trip_id)
group by all having max(a.end_s) > b.start_s
"""


# ---- q_constraints, q_cascade_graph (B-2, B-3, B-4, B-6) ----------------------

def delivery_tables(fx: Fixtures) -> dict[str, DataFrame]:
    return {"version": fx.c_version, "dest": fx.c_dest, "line": fx.c_line, "jopa": fx.c_jopa, "usrstop": fx.c_usrstop, "jopatili": fx.c_jopatili,
            "schedvers": fx.c_schedvers, "operday": fx.operday, "pujopass": fx.passes}


def q_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.check(delivery_tables(Fixtures(spark, sf_dir)), G.kv1_constraints())


_DELIVERY = {"version": "c_version", "dest": "c_dest", "line": "c_line", "jopa": "c_jopa", "usrstop": "c_usrstop", "jopatili": "c_jopatili",
             "schedvers": "c_schedvers", "operday": "operday", "pujopass": "passes"}
_VO = ["version", "dataownercode"]
_SCHED5 = [*_VO, "organizationalunitcode", "schedulecode", "scheduletypecode"]
_PATTERN4 = [*_VO, "lineplanningnumber", "journeypatterncode"]
# what the delivery is held to: keys, further columns without NULL, references
_HELD_KEYS = {
    "version": _VO, "dest": [*_VO, "destcode"], "line": [*_VO, "lineplanningnumber"], "jopa": _PATTERN4, "usrstop": [*_VO, "userstopcode"],
    "jopatili": [*_PATTERN4, "timinglinkorder"], "schedvers": _SCHED5, "operday": [*_SCHED5, "validdate"],
    "pujopass": [*_SCHED5, "lineplanningnumber", "journeynumber", "stoporder"],
}
_HELD_COLUMNS = {
    "version": ["validfrom", "filename", "dataownerversion"], "dest": ["destnamefull"], "line": ["linepublicnumber", "linename"], "jopa": ["direction"],
    "usrstop": ["getin", "getout", "name"], "jopatili": ["userstopcodebegin", "userstopcodeend", "destcode"], "schedvers": ["validfrom"], "operday": [],
    "pujopass": ["journeypatterncode", "userstopcode"],
}
_HELD_REFERENCES = [
    ("jopa", [*_VO, "lineplanningnumber"], "line"), ("jopatili", [*_VO, "destcode"], "dest"), ("jopatili", _PATTERN4, "jopa"), ("operday", _SCHED5, "schedvers"),
    ("pujopass", _SCHED5, "schedvers"), ("pujopass", [*_VO, "userstopcode"], "usrstop"), ("pujopass", _PATTERN4, "jopa"),
    *[(t, _VO, "version") for t in ("dest", "line", "jopa", "usrstop", "jopatili", "schedvers", "operday", "pujopass")],
]


def _constraints_sql() -> str:
    parts = []
    for t, key in _HELD_KEYS.items():
        k = ", ".join(key)
        parts.append(f"select 'key' as kind, '{t}({k})' as \"constraint\", count(*) as violations from (select {k} from {_DELIVERY[t]} group by {k} having count(*) > 1) x")
        parts += [f"select 'required', '{t}.{c}', count(*) from {_DELIVERY[t]} where {c} is null" for c in [*key, *_HELD_COLUMNS[t]]]
    for child, cols, parent in _HELD_REFERENCES:
        same = " and ".join(f"p.{c} = c.{c}" for c in cols)
        named = " and ".join(f"c.{c} is not null" for c in cols)
        parts.append(f"select 'reference', '{child}({', '.join(cols)}) -> {parent}', count(*) from {_DELIVERY[child]} c where {named} and not exists (select 1 from {_DELIVERY[parent]} p where {same})")
    return duckdb_with(sorted(set(_DELIVERY.values())), "\n" + "\nunion all ".join(parts))


SQL_CONSTRAINTS = _constraints_sql()


def q_cascade_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after version 1 of ARR is withdrawn (ledger cascade), and after lines are
    withdrawn along all references."""
    t = delivery_tables(Fixtures(spark, sf_dir))
    g = G.kv1_constraints()
    unpublished = t["version"].filter("version = 1 and dataownercode = 'ARR'").select("version", "dataownercode")
    lines = t["line"].filter("lineplanningnumber % 8 = 3").select("version", "dataownercode", "lineplanningnumber")
    out = None
    for name, left in (("version", G.delete(t, g, {"version": unpublished})), ("lines", G.delete(t, g, {"line": lines}, follow_all=True))):
        for table, df in left.items():
            part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("deleted"), F.lit(table).alias("of_table"), "n")
            out = part if out is None else out.unionByName(part)
    return out


_GONE_LINE = "lineplanningnumber % 8 = 3 and (version, dataownercode, lineplanningnumber) in (select version, dataownercode, lineplanningnumber from c_line)"
_GONE_PATTERN = f"(version, dataownercode, lineplanningnumber, journeypatterncode) in (select version, dataownercode, lineplanningnumber, journeypatterncode from c_jopa where {_GONE_LINE})"
_GONE = {"line": _GONE_LINE, "jopa": _GONE_LINE, "jopatili": _GONE_PATTERN, "pujopass": _GONE_PATTERN}
SQL_CASCADE_GRAPH = duckdb_with(sorted(set(_DELIVERY.values())), "\n" + "\nunion all ".join(
    [f"select 'version' as deleted, '{t}' as of_table, count(*) as n from {src} where not (version = 1 and dataownercode = 'ARR')" for t, src in _DELIVERY.items()]
    + [f"select 'lines', '{t}', count(*) from {src} where not ({_GONE.get(t, 'false')})" for t, src in _DELIVERY.items()]))


QUERIES = {
    "q_stops_too_close": (q_stops_too_close, SQL_STOPS_TOO_CLOSE),
    "q_fast_travel": (q_fast_travel, SQL_FAST_TRAVEL),
    "q_block_overlaps": (q_block_overlaps, SQL_BLOCK_OVERLAPS),
    "q_constraints": (q_constraints, SQL_CONSTRAINTS),
    "q_cascade_graph": (q_cascade_graph, SQL_CASCADE_GRAPH),
    "q_pk": (q_pk, SQL_PK),
    "q_fk": (q_fk, SQL_FK),
    "q_not_null": (q_not_null, SQL_NOT_NULL),
    "q_validate": (q_validate, SQL_VALIDATE),
}
