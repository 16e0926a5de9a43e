"""Queries over the KV1 passing-time lineage (L1) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cols import pipe_id
from ..functions.geo import rd_to_wgs84
from ..functions.times import format_clock
from ..operators import gtfs_kv1 as G
from ..operators import shape_match as S
from ..operators.gtfs_iff import Tables
from .fixtures import Fixtures, duckdb_with
from .sqltext import JOURNEY, PATTERN, SCHED, clock, lat, lon, on, pipe, rd_degrees, ymd

FEED_VERSION = "1"


# ---- glue: adapter tables -> KV1 tables --------------------------------------

def kv1_tables(fx: Fixtures) -> dict[str, DataFrame]:
    links = fx.links
    lines = fx.lines
    stops = fx.stops
    jopa = links.select(*G.PATTERN).distinct().join(
        lines.select("version", "dataownercode", "lineplanningnumber", "direction"),
        on=["version", "dataownercode", "lineplanningnumber"])
    point = stops.select("version", "dataownercode", F.col("userstopcode").alias("pointcode"),
                         "locationx_ew", "locationy_ns")
    made = {
        "pujopass": fx.passes, "operday": fx.operday, "jopatili": links, "dest": fx.destinations,
        "line": lines, "jopa": jopa, "usrstop": stops, "point": point, "usrstar": fx.areas,
    }
    # the largest of the small tables, which only shapes read
    return Tables({name: lambda df=df: df for name, df in made.items()} | {"pool": lambda: fx.pool.withColumnRenamed("pointno", "pointcode")})


# DuckDB: the same pattern-level attributes as gtfs_kv1.pattern_info
def _pattern_ctes() -> str:
    pk = ", ".join(PATTERN)
    return f"""
ln as (select *, coalesce(transporttype, case when cast(linepublicnumber as varchar) = 'FF' then 'BOAT' else 'BUS' end) as tt from lines),
train as (select distinct dataownercode, lineplanningnumber from ln where tt = 'TRAIN'),
first_link as (select * from (select l.*, row_number() over (partition by {pk} order by timinglinkorder) as rn from links l) where rn = 1),
last_link as (select * from (select l.*, row_number() over (partition by {pk} order by timinglinkorder desc) as rn from links l) where rn = 1),
pf as (select {pk}, productformulatype from (select l.*, row_number() over (partition by {pk} order by timinglinkorder) as rn
       from links l where productformulatype is not null and productformulatype <> 18) where rn = 1),
sd as (select {pk}, timinglinkorder as stoporder, destcode from links
       union select {pk}, timinglinkorder + 1 as stoporder, destcode from last_link),
hs as (select {', '.join('sd.' + c for c in PATTERN)}, sd.stoporder, min(d.destnamefull) as stop_headsign
       from sd join first_link f on {on('sd', 'f', PATTERN)}
       join destinations d on d.version = sd.version and d.dataownercode = sd.dataownercode and d.destcode = sd.destcode
       where sd.destcode <> f.destcode group by all),
p as (select * from passes x where exists (select 1 from operday o where {on('o', 'x', SCHED)}))"""


def _with(adapters, ctes: str, body: str) -> str:
    sql = duckdb_with(adapters, "")
    return sql.rstrip() + ",\n" + ctes.strip() + "\n" + body


# ---- q_stop_times (N-19 + N-22) ---------------------------------------------

def q_stop_times(spark: SparkSession, sf_dir: str, t: Mapping[str, DataFrame] | None = None) -> DataFrame:
    t = t or kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_stop_times_kv1(t["pujopass"], t["usrstop"], t["jopatili"], t["dest"], t["line"], t["operday"])


def _pick(flag: str) -> str:
    return f"case when pf.productformulatype in (2, 35, 36) then 3 else cast(not u.{flag} as integer) end"


SQL_STOP_TIMES = _with(
    ["passes", "links", "operday", "stops", "destinations", "lines"], _pattern_ctes(), f"""
select {pipe(*JOURNEY, prefix='p.')} as trip_id,
 {clock('coalesce(p.arr_s, p.dep_s)')} as arrival_time,
 {clock('coalesce(p.dep_s, p.arr_s)')} as departure_time,
 {pipe('dataownercode', 'userstopcode', prefix='p.')} as stop_id,
 hs.stop_headsign, p.stoporder as stop_sequence,
 {_pick('getin')} as pickup_type, {_pick('getout')} as drop_off_type
from p join stops u on u.version = p.version and u.dataownercode = p.dataownercode and u.userstopcode = p.userstopcode
left join pf on {on('pf', 'p', PATTERN)}
left join hs on {on('hs', 'p', PATTERN)} and hs.stoporder = p.stoporder
where (u.getin or u.getout)
 and not exists (select 1 from train t where t.dataownercode = p.dataownercode and t.lineplanningnumber = p.lineplanningnumber)
""")


# ---- q_trips (N-18) ---------------------------------------------------------

def q_trips(spark: SparkSession, sf_dir: str, t: Mapping[str, DataFrame] | None = None) -> DataFrame:
    t = t or kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_trips_kv1(t["pujopass"], t["jopa"], t["jopatili"], t["dest"], t["line"], t["operday"])


SQL_TRIPS = _with(
    ["passes", "links", "operday", "destinations", "lines"], _pattern_ctes(), f"""
, wc(k, wheelchair_accessible) as (values ('UNKNOWN', 0), ('ACCESSIBLE', 1), ('NOTACCESSIBLE', 2)),
bike(owner, line) as (values ('ARR', '15020'), ('ARR', '15021'), ('ARR', '15022'), ('ARR', '15023'), ('ARR', '15024'), ('ARR', '17090'), ('ARR', '17194'), ('ARR', '17196'),
  ('GVB', '26'), ('GVB', '50'), ('GVB', '51'), ('GVB', '52'), ('GVB', '53'), ('GVB', '54'), ('GVB', '900'), ('GVB', '901'), ('GVB', '902'), ('GVB', '904'), ('GVB', '905'), ('GVB', '906'), ('GVB', '907'))
select {pipe('dataownercode', 'lineplanningnumber', prefix='p.')} as route_id,
 {pipe(*SCHED, prefix='p.')} as service_id,
 {pipe(*JOURNEY, prefix='p.')} as trip_id,
 p.journeynumber as trip_short_name, d.destnamefull as trip_headsign,
 cast(l.direction as integer) - 1 as direction_id,
 {pipe(*PATTERN, prefix='p.')} as shape_id,
 wc.wheelchair_accessible, case when bike.line is not null then 2 end as trip_bikes_allowed
from p left join bike on bike.owner = p.dataownercode and bike.line = cast(p.lineplanningnumber as varchar)
join (select distinct version, dataownercode, lineplanningnumber, direction from lines) l
  on l.version = p.version and l.dataownercode = p.dataownercode and l.lineplanningnumber = p.lineplanningnumber
join (select distinct {', '.join(PATTERN)} from links) jp on {on('jp', 'p', PATTERN)}
join first_link f on {on('f', 'p', PATTERN)}
join destinations d on d.version = f.version and d.dataownercode = f.dataownercode and d.destcode = f.destcode
join wc on wc.k = coalesce(p.wheelchairaccessible, 'UNKNOWN')
where p.stoporder = 1
 and not exists (select 1 from train t where t.dataownercode = p.dataownercode and t.lineplanningnumber = p.lineplanningnumber)
""").replace(",\n, wc", ",\nwc")


# ---- q_calendar_dates (N-17) ------------------------------------------------

def q_calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gtfs_calendar_dates(Fixtures(spark, sf_dir).operday)


SQL_CALENDAR_DATES = duckdb_with(["operday"], f"""
select {pipe(*SCHED)} as service_id, {ymd('validdate')} as date, 1 as exception_type from operday
""")


# ---- q_feed_info / q_agency (N-13, N-14) ------------------------------------

def q_feed_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gtfs_feed_info(Fixtures(spark, sf_dir).operday, "validdate", feed_version=FEED_VERSION)


SQL_FEED_INFO = duckdb_with(["operday"], f"""
select 'feed publisher' as feed_publisher_name, 'http://example.org/' as feed_publisher_url, 'nl' as feed_lang,
 {ymd('min(validdate)')} as feed_start_date, {ymd('max(validdate)')} as feed_end_date, '{FEED_VERSION}' as feed_version
from operday
""")


def q_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gtfs_agency_kv1(Fixtures(spark, sf_dir).passes)


# ---- fixed values: agencies that the fixtures' owners and lines can name ----
_AGENCY_VALUES = ("('ARR', 'Arriva', 'http://www.arriva.nl/'), ('GVB', 'GVB', 'http://www.gvb.nl/'), ('HTM', 'HTM', 'http://www.htm.nl/'), "
                  "('HTMBUZZ', 'HTMbuzz', 'http://www.htm.nl/'), ('GVU', 'GVU', 'http://www.gvu.nl/'), "
                  "('BRENG', 'Breng', 'http://www.breng.nl/'), ('HERMES', 'Hermes', 'http://www.hermes.nl/')")
# ---- end of fixed values ----

SQL_AGENCY = duckdb_with(["passes"], f"""
select o.agency_id, a.agency_name, a.agency_url, 'Europe/Amsterdam' as agency_timezone, 'nl' as agency_lang
from (select distinct dataownercode as agency_id from passes) o
left join (values {_AGENCY_VALUES}) a(agency_id, agency_name, agency_url) on a.agency_id = o.agency_id
""")


def q_agency_of_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agencies of the routes in use, with the number of routes that each has (no route is left over)."""
    t = kv1_tables(Fixtures(spark, sf_dir))
    routes = G.gtfs_routes_kv1(t["line"], t["jopatili"])
    n = routes.groupBy("agency_id").agg(F.count(F.lit(1)).alias("n_routes"))
    return n.join(G.gtfs_agency_kv1(routes, owner_col="agency_id"), "agency_id", "left").select("agency_id", "agency_name", "n_routes")


# ---- q_stops (N-15) ---------------------------------------------------------

def q_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_stops_kv1(t["usrstop"], t["usrstar"], t["point"], t["jopatili"])


SQL_STOPS = duckdb_with(["stops", "areas", "links"], f"""
, centres as (select version, dataownercode, userstopareacode, avg(locationx_ew) as x, avg(locationy_ns) as y
   from stops where userstopareacode is not null group by all),
newest_area as (select * from (select a.*, row_number() over (partition by dataownercode, userstopareacode order by version desc) as rn from areas a) where rn = 1),
newest_stop as (select * from (select s.*, row_number() over (partition by dataownercode, userstopcode order by version desc) as rn
   from stops s where getin or getout) where rn = 1),
served as (select dataownercode, userstopcodebegin as userstopcode from links union select dataownercode, userstopcodeend from links)
select {pipe('dataownercode', 'userstopareacode', prefix='c.')} || '|parent' as stop_id, a.name as stop_name,
 {lat('c.x', 'c.y')} as stop_lat, {lon('c.x', 'c.y')} as stop_lon, 1 as location_type, cast(null as varchar) as parent_station
from centres c join newest_area a on a.version = c.version and a.dataownercode = c.dataownercode and a.userstopareacode = c.userstopareacode
union
select {pipe('dataownercode', 'userstopcode', prefix='s.')} as stop_id, s.name as stop_name,
 {lat('s.locationx_ew', 's.locationy_ns')} as stop_lat, {lon('s.locationx_ew', 's.locationy_ns')} as stop_lon, 0 as location_type,
 {pipe('dataownercode', 'userstopareacode', prefix='s.')} || '|parent' as parent_station
from newest_stop s
where exists (select 1 from served v where v.dataownercode = s.dataownercode and v.userstopcode = s.userstopcode)
""").replace(",\n, centres", ",\ncentres")


# ---- q_routes (N-16) --------------------------------------------------------

def q_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_routes_kv1(t["line"], t["jopatili"])


def _formula_values() -> str:
    from ..operators.mappings import PRODUCT_FORMULAS
    return ", ".join(f"({k}, '{v}')" for k, v in PRODUCT_FORMULAS)


SQL_ROUTES = duckdb_with(["lines", "links"], f"""
, ln as (select *, coalesce(transporttype, case when cast(linepublicnumber as varchar) = 'FF' then 'BOAT' else 'BUS' end) as tt from lines),
rt(tt, route_type) as (values ('TRAM', 0), ('METRO', 1), ('TRAIN', 2), ('BUS', 3), ('BOAT', 4)),
pfm(productformulatype, localized_route_type) as (values {_formula_values()}),
pf as (select x.*, pfm.localized_route_type from (select distinct version, dataownercode, lineplanningnumber, productformulatype from links) x
   left join pfm on pfm.productformulatype = x.productformulatype),
j as (select {pipe('dataownercode', 'lineplanningnumber', prefix='l.')} as route_id,
   case when l.dataownercode = 'ARR' and cast(l.lineplanningnumber as varchar) like '150__' then 'WATERBUS'
        when l.dataownercode = 'HTM' and l.lineplanningnumber in (select lineplanningnumber from links where confinrelcode = 'SGHB') then 'HTMBUZZ'
        else l.dataownercode end as agency_id,
   cast(l.linepublicnumber as varchar) as route_short_name,
   case when cast(l.linepublicnumber as varchar) <> l.linename then l.linename else null end as route_long_name,
   rt.route_type, pf.localized_route_type,
   row_number() over (partition by l.dataownercode, l.lineplanningnumber order by l.version desc, pf.productformulatype asc nulls last) as rn
   from ln l join rt on rt.tt = l.tt
   join pf on pf.version = l.version and pf.dataownercode = l.dataownercode and pf.lineplanningnumber = l.lineplanningnumber
   where l.tt <> 'TRAIN')
select route_id, agency_id, route_short_name, route_long_name, route_type, localized_route_type from j where rn = 1
""").replace(",\n, ln", ",\nln")


SQL_AGENCY_OF_ROUTES = f"""
select r.agency_id, a.agency_name, count(*) as n_routes from ({SQL_ROUTES}) r
left join (values {_AGENCY_VALUES}) a(agency_id, agency_name, agency_url) on a.agency_id = r.agency_id group by all
"""


# ---- q_shapes_rank / q_shapes_seq (N-21) ------------------------------------

def q_shapes_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_shapes(t["jopatili"], t["pool"], t["line"], rank_mode="rank")


def q_shapes_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_shapes(t["jopatili"], t["pool"], t["line"], rank_mode="row_number", exclude_train=False)


def _shapes_sql(rank_mode: str) -> str:
    pk = ", ".join("j." + c for c in PATTERN)
    train = ("and not exists (select 1 from train t where t.dataownercode = j.dataownercode "
             "and t.lineplanningnumber = j.lineplanningnumber)") if rank_mode == "rank" else ""
    if rank_mode == "rank":
        seq = f"rank() over (partition by {pk} order by j.timinglinkorder, o.distancesincestartoflink)"
        body = f"""
s as (select {pk}, o.locationx_ew, o.locationy_ns, {seq} as shape_pt_sequence
  from links j join pool o on o.version = j.version and o.dataownercode = j.dataownercode
   and o.userstopcodebegin = j.userstopcodebegin and o.userstopcodeend = j.userstopcodeend
  where exists (select 1 from ln where ln.version = j.version and ln.dataownercode = j.dataownercode and ln.lineplanningnumber = j.lineplanningnumber) {train})"""
    else:
        seq = (f"row_number() over (partition by {pk} order by j.timinglinkorder, o.distancesincestartoflink, o.pointno, "
               f"o.locationx_ew, o.locationy_ns)")
        body = f"""
s0 as (select {pk}, j.timinglinkorder, o.distancesincestartoflink, o.locationx_ew, o.locationy_ns, {seq} as shape_pt_sequence
  from links j join pool o on o.version = j.version and o.dataownercode = j.dataownercode
   and o.userstopcodebegin = j.userstopcodebegin and o.userstopcodeend = j.userstopcodeend
  where exists (select 1 from ln where ln.version = j.version and ln.dataownercode = j.dataownercode and ln.lineplanningnumber = j.lineplanningnumber)),
s as (select * from (select s0.*, row_number() over (partition by {', '.join(PATTERN)}, timinglinkorder, distancesincestartoflink
   order by shape_pt_sequence) as k from s0) where k = 1)"""
    return duckdb_with(["links", "pool", "lines"], f"""
, ln as (select *, coalesce(transporttype, case when cast(linepublicnumber as varchar) = 'FF' then 'BOAT' else 'BUS' end) as tt from lines),
train as (select distinct dataownercode, lineplanningnumber from ln where tt = 'TRAIN'),
{body.strip()}
select distinct {pipe(*PATTERN)} as shape_id, {lat('locationx_ew', 'locationy_ns')} as shape_pt_lat,
 {lon('locationx_ew', 'locationy_ns')} as shape_pt_lon, shape_pt_sequence from s
""").replace(",\n, ln", ",\nln")


# ---- q_shapes_points (N-21: points joined, the line's mode matched) ----------

def q_shapes_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return G.gtfs_shapes(fx.links, fx.pool_by_mode, fx.lines, point=fx.points, exclude_train=False, match_transport=True)


SQL_SHAPES_POINTS = duckdb_with(["links", "pool_by_mode", "points", "lines"], f"""
, drawn as (
 select j.*, pt.locationx_ew, pt.locationy_ns, o.distancesincestartoflink
 from links j join lines l using (version, dataownercode, lineplanningnumber)
 join pool_by_mode o using (version, dataownercode, userstopcodebegin, userstopcodeend)
 join points pt on pt.version = o.version and pt.dataownercode = o.pointdataownercode and pt.pointcode = o.pointcode
 where o.transporttype = coalesce(l.transporttype, if(cast(l.linepublicnumber as varchar) = 'FF', 'BOAT', 'BUS')))
select distinct {pipe(*PATTERN)} as shape_id, {lat('locationx_ew', 'locationy_ns')} as shape_pt_lat, {lon('locationx_ew', 'locationy_ns')} as shape_pt_lon,
 cast(rank() over (partition by {", ".join(PATTERN)} order by timinglinkorder, distancesincestartoflink) as integer) as shape_pt_sequence
from drawn
""")


# ---- q_shape_distances, q_stops_along_shapes (N-21, N-39) --------------------

def q_shape_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shape_distances(q_shapes_seq(spark, sf_dir)).withColumn("shape_dist_traveled", F.round("shape_dist_traveled", 1))


SQL_SHAPE_DISTANCES = """
with shapes as (SHAPES),
legs as (select *, lag(shape_pt_lat) over w as p_lat, lag(shape_pt_lon) over w as p_lon from shapes window w as (partition by shape_id order by shape_pt_sequence, shape_pt_lat, shape_pt_lon)),
metres as (select *, 2 * 6371008.8 * asin(sqrt(pow(sin(radians(shape_pt_lat - p_lat) / 2), 2)
  + cos(radians(shape_pt_lat)) * cos(radians(p_lat)) * pow(sin(radians(shape_pt_lon - p_lon) / 2), 2))) as m from legs)
select shape_id, shape_pt_lat, shape_pt_lon, shape_pt_sequence,
 round(sum(coalesce(m, 0)) over (partition by shape_id order by shape_pt_sequence, shape_pt_lat, shape_pt_lon rows unbounded preceding), 1) as shape_dist_traveled
from metres
"""


def q_stops_along_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops of every pattern (the beginnings of its links and the last end) along its shape."""
    fx = Fixtures(spark, sf_dir)
    links = fx.links.select(*G.PATTERN, "timinglinkorder", "userstopcodebegin", "userstopcodeend")
    ends = links.groupBy(*G.PATTERN).agg(F.max_by(F.struct("timinglinkorder", "userstopcodeend"), "timinglinkorder").alias("e"))
    calls = links.select(*G.PATTERN, F.col("timinglinkorder").alias("stop_sequence"), F.col("userstopcodebegin").alias("userstopcode")) \
        .unionByName(ends.select(*G.PATTERN, (F.col("e.timinglinkorder") + 1).alias("stop_sequence"), F.col("e.userstopcodeend").alias("userstopcode")))
    at = rd_to_wgs84("locationx_ew", "locationy_ns")
    stops = fx.stops.select("version", "dataownercode", "userstopcode", at["lat"].alias("stop_lat"), at["lon"].alias("stop_lon")).dropDuplicates(["version", "dataownercode", "userstopcode"])
    calls = calls.join(stops, ["version", "dataownercode", "userstopcode"], "left").select(pipe_id(*G.PATTERN).alias("shape_id"), "stop_sequence", "stop_lat", "stop_lon")
    found = S.stops_along_shapes(calls, q_shapes_seq(spark, sf_dir))
    return found.select("shape_id", "stop_sequence", F.round("shape_dist_traveled").alias("shape_dist_traveled"), F.round("off_m", 1).alias("off_m"), "off_line")


SQL_SHAPES_RANK = _shapes_sql("rank")
SQL_SHAPES_SEQ = _shapes_sql("row_number")
SQL_SHAPE_DISTANCES = SQL_SHAPE_DISTANCES.replace("SHAPES", SQL_SHAPES_SEQ)

# the cheapest ways stop by stop, forward over all segments, then back from the cheapest end
_DISTANCES = SQL_SHAPE_DISTANCES.replace("round(sum(", "(sum(").replace(" rows unbounded preceding), 1) as", " rows unbounded preceding)) as")
_CALLS = duckdb_with(["links", "stops"], f"""
, calls as (select {", ".join(PATTERN)}, timinglinkorder as stop_sequence, userstopcodebegin as userstopcode from links
  union all select {", ".join(PATTERN)}, max(timinglinkorder) + 1, arg_max(userstopcodeend, timinglinkorder) from links group by {", ".join(PATTERN)}),
place as (select version, dataownercode, userstopcode, any_value(locationx_ew) as x, any_value(locationy_ns) as y from stops group by all)
select {pipe(*PATTERN, prefix='c.')} as shape_id, stop_sequence, {rd_degrees('lat', 'x', 'y')} as lat, {rd_degrees('lon', 'x', 'y')} as lon
from calls c left join place using (version, dataownercode, userstopcode)
""")
SQL_STOPS_ALONG_SHAPES = f"""
with recursive line as materialized (select shape_id, shape_pt_lat as lat, shape_pt_lon as lon, shape_dist_traveled as dist,
   row_number() over (partition by shape_id order by shape_pt_sequence, shape_pt_lat, shape_pt_lon) as k from ({_DISTANCES}) x),
plane as (select *, 6371008.8 * radians(lat) as x, 6371008.8 * cos(radians(first(lat) over (partition by shape_id order by k))) * radians(lon) as y from line),
seg as materialized (select a.shape_id, a.k, a.x as ax, a.y as ay, b.x - a.x as dx, b.y - a.y as dy, a.dist as da, b.dist - a.dist as dd
   from plane a join plane b on b.shape_id = a.shape_id and b.k = a.k + 1),
stop as materialized (select *, row_number() over (partition by shape_id order by stop_sequence) as i from ({_CALLS}) x where lat is not null),
spot as (select t.shape_id, t.i, s.*, 6371008.8 * radians(t.lat) as x, 6371008.8 * cos(radians(o.lat)) * radians(t.lon) as y
   from stop t join seg s on s.shape_id = t.shape_id join line o on o.shape_id = t.shape_id and o.k = 1),
part as (select *, case when dx * dx + dy * dy > 0 then greatest(0, least(1, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy))) else 0 end as t from spot),
off as materialized (select shape_id, i, k, sqrt(pow(ax + t * dx - x, 2) + pow(ay + t * dy - y, 2)) as m, da + t * dd as along from part),
way(shape_id, i, k, cost, came) as (
 select shape_id, i, k, m * m, 0 from off where i = 1
 union all
 select o.shape_id, o.i, o.k, p.best + o.m * o.m, p.came from off o join (
   select shape_id, i, k, min(cost) over w as best, arg_min(k, cost) over w as came from way window w as (partition by shape_id order by k)) p
 on p.shape_id = o.shape_id and p.i + 1 = o.i and p.k = o.k),
ways as materialized (select * from way),
back(shape_id, i, k) as (
 select shape_id, i, arg_min(k, cost) from ways where (shape_id, i) in (select shape_id, max(i) from ways group by shape_id) group by shape_id, i
 union all select b.shape_id, b.i - 1, w.came from back b join ways w on w.shape_id = b.shape_id and w.i = b.i and w.k = b.k where b.i > 1)
select c.shape_id, c.stop_sequence, round(max(o.along) over (partition by c.shape_id order by s.i)) as shape_dist_traveled, round(o.m, 1) as off_m, o.m > 100 as off_line
from ({_CALLS}) c left join stop s on s.shape_id = c.shape_id and s.stop_sequence = c.stop_sequence
left join back b on b.shape_id = s.shape_id and b.i = s.i left join off o on o.shape_id = b.shape_id and o.i = b.i and o.k = b.k
"""


# ---- q_stops_latest (N-15, newest version first, then filter) ---------------

def q_stops_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_stops_kv1(t["usrstop"], t["usrstar"], t["point"], t["jopatili"], mode="latest_then_filter")


SQL_STOPS_LATEST = SQL_STOPS.replace(
    "row_number() over (partition by dataownercode, userstopcode order by version desc) as rn\n   from stops s where getin or getout) where rn = 1)",
    "row_number() over (partition by dataownercode, userstopcode order by version desc) as rn\n   from stops s) where rn = 1 and (getin or getout))")


# ---- q_routes_prefix (N-16, agency from the line-code prefix) --------------

def _lettered(df: DataFrame) -> DataFrame:
    """Line codes as text, most with a leading letter (as the L2 feed has them)."""
    n = F.col("lineplanningnumber")
    letter = F.element_at(F.array(*map(F.lit, "UAXL")), (n % 4 + 1).cast("int"))
    return df.withColumn("lineplanningnumber", F.concat(F.when(n % 5 != 0, letter).otherwise(F.lit("")), n.cast("string")))


def q_routes_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = kv1_tables(Fixtures(spark, sf_dir))
    return G.gtfs_routes_kv1(_lettered(t["line"]), _lettered(t["jopatili"]), agency_rule="prefix")


SQL_ROUTES_PREFIX = duckdb_with(["lines", "links"], f"""
, code as (select distinct lineplanningnumber as n, case when n % 5 <> 0 then substr('UAXL', cast(n % 4 + 1 as integer), 1) else '' end as letter from lines),
newest as (select dataownercode, lineplanningnumber, arg_max(l, version) as l from (select dataownercode, lineplanningnumber, version, lines as l from lines) x
   where coalesce(l.transporttype, 'BUS') <> 'TRAIN' group by all),
formula as (select version, dataownercode, lineplanningnumber, min(productformulatype) as f from links group by all)
select dataownercode || '|' || letter || cast(lineplanningnumber as varchar) as route_id,
 coalesce(map {{'U': 'GVU', 'A': 'BRENG', 'X': 'BRENG', 'L': 'HERMES'}}[letter], dataownercode) as agency_id, l.linepublicnumber as route_short_name,
 l.linename as route_long_name, map {{'TRAM': 0, 'METRO': 1, 'BUS': 3, 'BOAT': 4}}[coalesce(l.transporttype, 'BUS')] as route_type, name as localized_route_type
from newest join code on n = lineplanningnumber join formula using (dataownercode, lineplanningnumber)
left join (values {_formula_values()}) pf(f, name) using (f) where formula.version = l.version
""")


# ---- q_formula_fixes (N-36), q_pad_seconds (N-37) ---------------------------

def q_formula_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = Fixtures(spark, sf_dir).links
    code = F.when(F.col("timinglinkorder") % 2 == 0, F.lit("Bubu")).when(F.col("timinglinkorder") % 3 == 0, F.lit("belb"))
    fixed = G.product_formula_fixes(links.withColumn("deprecated", code))
    return fixed.select(*G.PATTERN, "timinglinkorder", "productformulatype")


SQL_FORMULA_FIXES = duckdb_with(["links"], f"""
select {', '.join(PATTERN)}, timinglinkorder, case when dataownercode = 'ARR' and timinglinkorder % 2 = 0 then 1 else productformulatype end as productformulatype
from links
""")


def q_pad_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Fixtures(spark, sf_dir).passes.filter(F.col("arr_s").isNotNull() & F.col("dep_s").isNotNull())
    long = F.col("journeynumber") % 3 == 0

    def text(c: str):
        full = format_clock(F.col(c))
        return F.when(long, full).otherwise(F.substring(full, 1, 5))

    t = p.select("journeynumber", "stoporder", text("arr_s").alias("targetarrivaltime"), text("dep_s").alias("targetdeparturetime"))
    return G.pad_seconds_text(t)


SQL_PAD_SECONDS = duckdb_with(["passes"], f"""
, t as (select journeynumber, stoporder, {clock('arr_s')} as a, {clock('dep_s')} as d from passes where arr_s is not null and dep_s is not null)
select journeynumber, stoporder, if(journeynumber % 3 = 0, a, a[1:5] || ':00') as targetarrivaltime, if(journeynumber % 3 = 0, d, d[1:5] || ':00') as targetdeparturetime
from t
""")


QUERIES = {
    "q_stops_latest": (q_stops_latest, SQL_STOPS_LATEST),
    "q_routes_prefix": (q_routes_prefix, SQL_ROUTES_PREFIX),
    "q_stop_times": (q_stop_times, SQL_STOP_TIMES),
    "q_trips": (q_trips, SQL_TRIPS),
    "q_calendar_dates": (q_calendar_dates, SQL_CALENDAR_DATES),
    "q_feed_info": (q_feed_info, SQL_FEED_INFO),
    "q_agency": (q_agency, SQL_AGENCY),
    "q_agency_of_routes": (q_agency_of_routes, SQL_AGENCY_OF_ROUTES),
    "q_formula_fixes": (q_formula_fixes, SQL_FORMULA_FIXES),
    "q_pad_seconds": (q_pad_seconds, SQL_PAD_SECONDS),
    "q_stops": (q_stops, SQL_STOPS),
    "q_routes": (q_routes, SQL_ROUTES),
    "q_shapes_rank": (q_shapes_rank, SQL_SHAPES_RANK),
    "q_shapes_seq": (q_shapes_seq, SQL_SHAPES_SEQ),
    "q_shapes_points": (q_shapes_points, SQL_SHAPES_POINTS),
    "q_shape_distances": (q_shape_distances, SQL_SHAPE_DISTANCES),
    "q_stops_along_shapes": (q_stops_along_shapes, SQL_STOPS_ALONG_SHAPES),
}
