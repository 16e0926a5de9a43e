"""Queries over the KV1 validity / time-demand lineage (L2) and their oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calendars as C
from ..operators import gtfs_demand as D
from ..operators import profiles as P
from .fixtures import Fixtures, duckdb_with
from .q_kv1 import kv1_tables
from .sqltext import PATTERN, clock, on, pipe, ymd

DEMAND = PATTERN + ["timedemandgroupcode"]
# ledger validity of both versions and the run date used by the calendar query
LEDGER_FROM, LEDGER_THRU, AS_OF = dt.date(1998, 1, 10), dt.date(1998, 3, 20), dt.date(1998, 2, 1)


def runtimes(fx: Fixtures) -> DataFrame:
    return fx.runtimes.withColumnRenamed("drivetime", "totaldrivetime")


def l2_tables(fx: Fixtures) -> dict[str, DataFrame]:
    s = fx.services
    tive = s.select("version", "dataownercode", "organizationalunitcode", "timetableversioncode", "periodgroupcode",
                    "specificdaycode", F.col("tv_from").alias("validfrom"), F.col("tv_thru").alias("validthru"))
    pegrval = s.select("version", "dataownercode", "organizationalunitcode", "periodgroupcode",
                       F.col("pv_from").alias("validfrom"), F.col("pv_thru").alias("validthru")).distinct()
    spark = s.sparkSession
    version = spark.createDataFrame([(1, LEDGER_FROM, LEDGER_THRU), (2, LEDGER_FROM, LEDGER_THRU)],
                                    "version int, validfrom date, validthru date")
    return {"tive": tive, "pegrval": pegrval, "pujo": fx.journeys, "excopday": fx.exceptions, "version": version}


# ---- q_profiles (N-5) -------------------------------------------------------

def q_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    sp = P.compress_journeys(Fixtures(spark, sf_dir).passes)["schedpujo"]
    return sp.select("version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode",
                     "lineplanningnumber", "journeynumber", "journeypatterncode", "departure_s", "timedemandgroupcode")


_J = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode", "lineplanningnumber",
      "journeynumber"]
_JK = ", ".join(_J)
_G = ", ".join(PATTERN)

SQL_PROFILES = duckdb_with(["passes"], f"""
, s as (select *, coalesce(dep_s, arr_s) as dep, coalesce(arr_s, dep_s) as arr from passes),
pr as (select {_JK}, journeypatterncode, stoporder, userstopcode, dep, arr,
   lead(stoporder) over w as nso, lead(userstopcode) over w as nstop, lead(dep) over w as ndep, lead(arr) over w as narr,
   first_value(dep) over w as departure_s
   from s window w as (partition by {_JK} order by stoporder)),
prof as (select {_JK}, journeypatterncode, min(departure_s) as departure_s,
   coalesce(string_agg(case when nso is not null then concat_ws(',', stoporder, userstopcode, nstop,
     coalesce(cast(ndep - dep as varchar), '~'), coalesce(cast(narr - dep as varchar), '~')) end, ';' order by stoporder), '') as profile
   from pr group by all),
ranked as (select *, row_number() over (partition by {_G} order by organizationalunitcode, schedulecode, scheduletypecode, journeynumber) as jr from prof),
codes as (select {_G}, profile, dense_rank() over (partition by {_G} order by min(jr)) - 1 as timedemandgroupcode from ranked group by {_G}, profile)
select {', '.join('r.' + c for c in _J)}, r.journeypatterncode, r.departure_s, c.timedemandgroupcode
from ranked r join codes c on {on('r', 'c', PATTERN)} and r.profile = c.profile
""")


# ---- q_profile_codes (N-5, L-1) ----------------------------------------------

def q_profile_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes after the delivery of version 1, then version 2, then version 1 once more."""
    passes = Fixtures(spark, sf_dir).passes
    known, _ = P.lasting_codes(passes.filter("version = 1"))
    known, second = P.lasting_codes(passes.filter("version = 2"), known)
    known, again = P.lasting_codes(passes.filter("version = 1"), known)
    return second["schedpujo"].unionByName(again["schedpujo"]).select(*_J, "journeypatterncode", "timedemandgroupcode")


def _profile_codes_sql() -> str:
    """A profile's code is the number of its pattern's profiles that appeared before it, version 1 first."""
    lasting = ", ".join(c for c in PATTERN if c != "version")
    text = SQL_PROFILES[:SQL_PROFILES.index("ranked as (")]
    return text + f"""
ranked as (select *, row_number() over (partition by {lasting} order by version, organizationalunitcode, schedulecode, scheduletypecode, journeynumber) as jr from prof),
codes as (select {lasting}, profile, cast(dense_rank() over (partition by {lasting} order by min(jr)) - 1 as integer) as timedemandgroupcode from ranked group by {lasting}, profile)
select {", ".join(_J)}, journeypatterncode, timedemandgroupcode from ranked join codes using ({lasting}, profile)
"""


SQL_PROFILE_CODES = _profile_codes_sql()


# ---- q_redistribute (N-6), q_timdempass (N-6 + N-7) -------------------------

def stop_links(fx: Fixtures) -> DataFrame:
    """LINK: each stop pair two or three times, at growing distances; some pairs are missing."""
    pairs = fx.runtimes.filter(F.col("userstopcodebegin") % 11 != 0).select("version", "userstopcodebegin", "userstopcodeend", "distance").distinct()
    return pairs.withColumn("k", F.explode(F.sequence(F.lit(0), 1 + (F.col("userstopcodebegin") % 2).cast("int")))) \
        .select("version", "userstopcodebegin", "userstopcodeend", (F.col("distance") + F.col("k") * 25).alias("distance"))


def q_redistribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return P.redistribute_drive_time(runtimes(fx).drop("distance"), stop_links(fx))


def q_timdempass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pass_offsets(P.redistribute_drive_time(runtimes(Fixtures(spark, sf_dir))))


def _settled_sql(source: str, body: str) -> str:
    """Run times redistributed stretch by stretch: each step of the recursion finds the next
    stretch of a pattern (``a`` to ``z``) at or after ``since`` and writes its new times."""
    text = duckdb_with(["runtimes"], f"""
, rt as ({source}),
pattern as (select {', '.join(DEMAND)}, list(cast(drivetime as bigint) order by timinglinkorder) as t,
   list(cast(distance as bigint) order by timinglinkorder) as d from rt group by all),
step as (
 select {', '.join(DEMAND)}, 0 as k, 1 as since, t, d from pattern
 union all
 select {', '.join(DEMAND)}, k + 1, case when z = len(t) then z + 1 else z end,
  list_concat(list_concat(t[1:a - 1], early), list_concat([total - coalesce(list_sum(early), 0)], t[z + 1:len(t)])), d
 from (select *, list_transform(range(a, z), lambda i: case when share(i, t, d, a, z) = 0 then 4 else share(i, t, d, a, z) end) as early,
        list_sum(t[a:z]) as total
  from (select *, coalesce(list_min(list_filter(range(a + 1, len(t) + 1), lambda j: t[j] <> 0)), len(t)) as z
   from (select *, list_min(list_filter(range(since, len(t) + 1), lambda i: t[i] = 0 or (i < len(t) and t[i + 1] = 0))) as a
    from step where since <= len(t)) where a is not null))),
settled as (select {', '.join(DEMAND)}, arg_max(t, k) as t from step group by all),
nth as (select {', '.join(DEMAND)}, unnest(t) as totaldrivetime, unnest(range(1, len(t) + 1)) as pos from settled),
link_pos as (select *, row_number() over (partition by {', '.join(DEMAND)} order by timinglinkorder) as pos from rt),
red as (select {', '.join('l.' + c for c in DEMAND)}, l.timinglinkorder, l.userstopcodebegin, l.userstopcodeend,
   cast(n.totaldrivetime as bigint) as totaldrivetime, cast(l.stopwaittime as bigint) as stopwaittime, cast(l.distance as bigint) as distance
   from link_pos l join nth n on {on('l', 'n', DEMAND)} and l.pos = n.pos)
{body}
""").replace("WITH ", "WITH RECURSIVE ", 1)
    import re

    share = r"(case when list_sum(d[\4:\5]) > 0 then (list_sum(t[\4:\5]) * d[\1]) // list_sum(d[\4:\5]) else list_sum(t[\4:\5]) // (\5 - \4 + 1) end)"
    return re.sub(r"share\((\w), (\w), (\w), (\w), (\w)\)", share, text)


SQL_REDISTRIBUTE = _settled_sql("""select r.* exclude (distance), x.distance from runtimes r join (
   select version, userstopcodebegin, userstopcodeend, min(distance) as distance from runtimes where userstopcodebegin % 11 <> 0 group by all) x
   on x.version = r.version and x.userstopcodebegin = r.userstopcodebegin and x.userstopcodeend = r.userstopcodeend""", "select * from red")

SQL_TIMDEMPASS = _settled_sql("select * from runtimes", f"""
select {', '.join(DEMAND)}, timinglinkorder, userstopcodebegin, userstopcodeend,
 cast(sum(totaldrivetime + stopwaittime) over (partition by {', '.join(DEMAND)} order by timinglinkorder) - stopwaittime as bigint) as totaldrivetime,
 stopwaittime from red
""")


# ---- q_offsets (N-7) --------------------------------------------------------

def q_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pass_offsets(runtimes(Fixtures(spark, sf_dir)))


_DK = ", ".join(DEMAND)
_OFFSETS_CTE = f"""
off as (select {_DK}, timinglinkorder, userstopcodebegin, userstopcodeend,
   cast(sum(drivetime) over w1 + coalesce(sum(stopwaittime) over w2, 0) as bigint) as totaldrivetime,
   cast(stopwaittime as bigint) as stopwaittime
   from runtimes
   window w1 as (partition by {_DK} order by timinglinkorder rows between unbounded preceding and current row),
          w2 as (partition by {_DK} order by timinglinkorder rows between unbounded preceding and 1 preceding))"""

SQL_OFFSETS = duckdb_with(["runtimes"], f", {_OFFSETS_CTE.strip()}\nselect * from off")


# ---- q_expand_passes (N-11) -------------------------------------------------

def q_expand_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return D.expand_passes(fx.journeys, fx.links, P.pass_offsets(runtimes(fx)))


_FIRST_CTE = f"""first as (select * from (select l.*, row_number() over (partition by {_G} order by timinglinkorder) as rn from links l) where rn = 1)"""
_PASSES_BODY = f"""
passes2 as (
select j.version, j.dataownercode, j.organizationalunitcode, j.periodgroupcode as schedulecode, j.daytype as scheduletypecode,
 j.lineplanningnumber, j.journeynumber, 1 as stoporder, j.journeypatterncode, f.userstopcodebegin as userstopcode,
 j.departure_s as arr_s, j.departure_s as dep_s, j.wheelchairaccessible, j.dataownerisoperator, j.timedemandgroupcode
from journeys j join first f on {on('j', 'f', PATTERN)}
union all
select j.version, j.dataownercode, j.organizationalunitcode, j.periodgroupcode, j.daytype,
 j.lineplanningnumber, j.journeynumber, cast(o.timinglinkorder - f.timinglinkorder + 2 as integer), j.journeypatterncode, o.userstopcodeend,
 j.departure_s + o.totaldrivetime, j.departure_s + o.totaldrivetime + o.stopwaittime, j.wheelchairaccessible, j.dataownerisoperator,
 j.timedemandgroupcode
from journeys j join off o on {on('j', 'o', DEMAND)} join first f on {on('j', 'f', PATTERN)})"""

SQL_EXPAND_PASSES = duckdb_with(["journeys", "links", "runtimes"], f"""
, {_OFFSETS_CTE.strip()},
{_FIRST_CTE},
{_PASSES_BODY.strip()}
select version, dataownercode, organizationalunitcode, schedulecode, scheduletypecode, lineplanningnumber, journeynumber,
 stoporder, journeypatterncode, userstopcode, arr_s, dep_s, wheelchairaccessible, dataownerisoperator from passes2
""")


# ---- q_stop_times_demand (N-20) ---------------------------------------------

def q_stop_times_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    t = kv1_tables(fx)
    return D.gtfs_stop_times_demand(fx.journeys, P.pass_offsets(runtimes(fx)), t["jopatili"], t["usrstop"], t["dest"])


def _pick(flag: str) -> str:
    return (f"case when sl.productformulatype in (2, 35, 36) then 3 when sl.final then 0 "
            f"else cast(not u.{flag} as integer) end")


SQL_STOP_TIMES_DEMAND = duckdb_with(["journeys", "links", "runtimes", "stops", "destinations"], f"""
, {_OFFSETS_CTE.strip()},
{_FIRST_CTE},
last as (select * from (select l.*, row_number() over (partition by {_G} order by timinglinkorder desc) as rn from links l) where rn = 1),
sl0 as (select {', '.join('l.' + c for c in PATTERN)}, cast(l.timinglinkorder - f.timinglinkorder + 1 as integer) as stoporder,
   l.timinglinkorder as stop_sequence, l.destcode, l.productformulatype, false as final
   from links l join first f on {on('l', 'f', PATTERN)}
   union all
   select {', '.join('l.' + c for c in PATTERN)}, cast(l.timinglinkorder - f.timinglinkorder + 2 as integer),
   l.timinglinkorder + 1, l.destcode, l.productformulatype, true
   from last l join first f on {on('l', 'f', PATTERN)}),
sl as (select sl0.*, f.destcode as trip_destcode, d.destnamefull from sl0 join first f on {on('sl0', 'f', PATTERN)}
   left join destinations d on d.version = sl0.version and d.dataownercode = sl0.dataownercode and d.destcode = sl0.destcode),
{_PASSES_BODY.strip()}
select {pipe('version', 'dataownercode', 'schedulecode', 'scheduletypecode', 'lineplanningnumber', 'journeynumber', prefix='p.')} as trip_id,
 sl.stop_sequence, {pipe('dataownercode', 'userstopcode', prefix='p.')} as stop_id,
 case when sl.destcode <> sl.trip_destcode then sl.destnamefull else null end as stop_headsign,
 {clock('p.arr_s')} as arrival_time, {clock('p.dep_s')} as departure_time,
 {_pick('getin')} as pickup_type, {_pick('getout')} as drop_off_type
from passes2 p join sl on {on('p', 'sl', PATTERN)} and p.stoporder = sl.stoporder
left join stops u on u.version = p.version and u.dataownercode = p.dataownercode and u.userstopcode = p.userstopcode
where p.dataownerisoperator and (sl.final or u.getin is not null)
""")


# ---- q_trips_demand ---------------------------------------------------------

def q_trips_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    t = kv1_tables(fx)
    return D.gtfs_trips_demand(fx.journeys, t["jopa"], t["jopatili"], t["dest"])


SQL_TRIPS_DEMAND = duckdb_with(["journeys", "links", "destinations", "lines"], f"""
, {_FIRST_CTE}
select {pipe('dataownercode', 'lineplanningnumber', prefix='p.')} as route_id,
 {pipe('version', 'dataownercode', 'timetableversioncode', 'organizationalunitcode', 'periodgroupcode', 'specificdaycode', 'daytype', prefix='p.')} as service_id,
 {pipe('version', 'dataownercode', 'periodgroupcode', 'daytype', 'lineplanningnumber', 'journeynumber', prefix='p.')} as trip_id,
 d.destnamefull as trip_headsign, cast(l.direction as integer) - 1 as direction_id,
 {pipe(*PATTERN, prefix='p.')} as shape_id
from journeys p
join (select distinct version, dataownercode, lineplanningnumber, direction from lines) l
  on l.version = p.version and l.dataownercode = p.dataownercode and l.lineplanningnumber = p.lineplanningnumber
join first f on {on('p', 'f', PATTERN)}
join destinations d on d.version = f.version and d.dataownercode = f.dataownercode and d.destcode = f.destcode
where p.dataownerisoperator and p.wheelchairaccessible in ('UNKNOWN', 'ACCESSIBLE', 'NOTACCESSIBLE')
""")


# ---- q_schedvers (N-9) / q_operdays (N-10) ----------------------------------

def q_schedvers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = l2_tables(Fixtures(spark, sf_dir))
    return C.schedule_versions(t["tive"], t["pegrval"], t["pujo"])


_SVC_KEYS = ["version", "dataownercode", "timetableversioncode", "organizationalunitcode", "periodgroupcode",
             "specificdaycode", "daytype"]
_SCHEDVERS_CTE = f"""
t as (select version, dataownercode, organizationalunitcode, timetableversioncode, periodgroupcode, specificdaycode, tv_from, tv_thru from services),
p as (select distinct version, dataownercode, organizationalunitcode, periodgroupcode, pv_from, pv_thru from services),
pj as (select distinct {', '.join(_SVC_KEYS)} from journeys),
sv0 as (select {', '.join('pj.' + c for c in _SVC_KEYS)}, t.tv_from as validfrom, coalesce(t.tv_thru, p.pv_thru) as validthru,
   row_number() over (partition by {', '.join('pj.' + c for c in _SVC_KEYS)} order by p.pv_from, t.tv_from, coalesce(t.tv_thru, p.pv_thru)) as rn
   from t join p on t.version = p.version and t.dataownercode = p.dataownercode and t.organizationalunitcode = p.organizationalunitcode
     and t.periodgroupcode = p.periodgroupcode
   join pj on pj.version = t.version and pj.dataownercode = t.dataownercode and pj.organizationalunitcode = t.organizationalunitcode
     and pj.periodgroupcode = t.periodgroupcode and pj.specificdaycode = t.specificdaycode and pj.timetableversioncode = t.timetableversioncode
   where t.tv_from <> p.pv_from),
sv as (select version, dataownercode, organizationalunitcode, periodgroupcode as schedulecode, daytype as scheduletypecode,
   validfrom, validthru, {' || \'-\' || '.join(f'cast({c} as varchar)' for c in _SVC_KEYS)} as description from sv0 where rn = 1)"""

SQL_SCHEDVERS = duckdb_with(["services", "journeys"], f", {_SCHEDVERS_CTE.strip()}\nselect * from sv")


def q_operdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.expand_operating_days(q_schedvers(spark, sf_dir))


SQL_OPERDAYS = duckdb_with(["services", "journeys"], f""", {_SCHEDVERS_CTE.strip()},
days as (select version, dataownercode, organizationalunitcode, schedulecode, scheduletypecode,
   cast(unnest(generate_series(validfrom, validthru, interval 1 day)) as date) as validdate from sv where validthru is not null)
select * from days where instr(scheduletypecode, cast(dayofweek(validdate) + 1 as varchar)) > 0
""")


# ---- q_calendar_exceptions (N-12) ------------------------------------------

def q_calendar_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = l2_tables(Fixtures(spark, sf_dir))
    return C.calendar_with_exceptions(t["pegrval"], t["pujo"], t["tive"], t["excopday"], t["version"], AS_OF)


_SID = ["version", "dataownercode", "timetableversioncode", "pj_unit", "periodgroupcode", "specificdaycode", "daytype"]
SQL_CALENDAR_EXCEPTIONS = duckdb_with(["services", "journeys", "exceptions"], f"""
, tv as (select version, dataownercode, organizationalunitcode, timetableversioncode, periodgroupcode, specificdaycode, tv_thru from services),
pv as (select distinct version, dataownercode, organizationalunitcode, periodgroupcode, pv_from, pv_thru from services),
pj as (select distinct version, dataownercode, timetableversioncode, periodgroupcode, specificdaycode, organizationalunitcode as pj_unit, daytype from journeys),
ver(version, v_from, v_thru) as (values (1, date '{LEDGER_FROM}', date '{LEDGER_THRU}'), (2, date '{LEDGER_FROM}', date '{LEDGER_THRU}')),
svc as (select pv.version, pv.dataownercode, tv.timetableversioncode, pj.pj_unit, pv.periodgroupcode, tv.specificdaycode, pj.daytype,
   pv.pv_from as d_from, coalesce(tv.tv_thru, pv.pv_thru) as d_thru
   from pv join tv on tv.version = pv.version and tv.dataownercode = pv.dataownercode and tv.organizationalunitcode = pv.organizationalunitcode
     and tv.periodgroupcode = pv.periodgroupcode
   join pj on pj.version = tv.version and pj.dataownercode = tv.dataownercode and pj.timetableversioncode = tv.timetableversioncode
     and pj.periodgroupcode = tv.periodgroupcode and pj.specificdaycode = tv.specificdaycode),
dated0 as (select s.*, cast(unnest(generate_series(s.d_from, s.d_thru, interval 1 day)) as date) as date from svc s),
dated as (select d.* from dated0 d join ver v on v.version = d.version
   where d.date between v.v_from and v.v_thru and d.date >= date '{AS_OF}' - interval 1 day),
exc as (select distinct excopdate as date, substr(daytypeason, 1, 1) as ason from exceptions),
regular as (select {pipe(*_SID, prefix='d.')} as service_id, d.date from dated d
   where instr(d.daytype, cast(isodow(d.date) as varchar)) > 0
   and not exists (select 1 from exc e where e.date = d.date and instr(e.ason, cast(isodow(d.date) as varchar)) = 0)),
sd as (select distinct version, dataownercode, timetableversioncode, pj_unit, periodgroupcode, specificdaycode, date from dated),
subst as (select {pipe(*_SID[:-1], prefix='sd.')} || '|' || cast(t.daytype as varchar) as service_id, sd.date
   from sd join exc e on e.date = sd.date
   join pj t on t.version = sd.version and t.dataownercode = sd.dataownercode and t.timetableversioncode = sd.timetableversioncode
     and t.pj_unit = sd.pj_unit and t.periodgroupcode = sd.periodgroupcode and t.specificdaycode = sd.specificdaycode
   where instr(t.daytype, e.ason) > 0)
select service_id, {ymd('date')} as date, 1 as exception_type from (select * from regular union select * from subst)
""")


# ---- q_weekday_flags (N-38) ------------------------------------------------

def q_weekday_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.weekday_flags(q_schedvers(spark, sf_dir), rule="range")


_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
SQL_WEEKDAY_FLAGS = duckdb_with(["services", "journeys"], f", {_SCHEDVERS_CTE.strip()}\nselect " + (
    "cast(version as varchar) || '|' || dataownercode || '|' || organizationalunitcode || '|' || "
    "cast(schedulecode as varchar) || '|' || scheduletypecode as service_id, "
    + ", ".join(
        f"cast(coalesce((validthru - validfrom + 1) >= 7 or (({i} - (isodow(validfrom) - 1)) % 7 + 7) % 7 < "
        f"(validthru - validfrom + 1), false) as integer) as {d}" for i, d in enumerate(_DAYS))
    + ", strftime(validfrom, '%Y%m%d') as start_date, strftime(validthru, '%Y%m%d') as end_date from sv"))


QUERIES = {
    "q_weekday_flags": (q_weekday_flags, SQL_WEEKDAY_FLAGS),
    "q_profiles": (q_profiles, SQL_PROFILES),
    "q_profile_codes": (q_profile_codes, SQL_PROFILE_CODES),
    "q_redistribute": (q_redistribute, SQL_REDISTRIBUTE),
    "q_timdempass": (q_timdempass, SQL_TIMDEMPASS),
    "q_offsets": (q_offsets, SQL_OFFSETS),
    "q_expand_passes": (q_expand_passes, SQL_EXPAND_PASSES),
    "q_stop_times_demand": (q_stop_times_demand, SQL_STOP_TIMES_DEMAND),
    "q_trips_demand": (q_trips_demand, SQL_TRIPS_DEMAND),
    "q_schedvers": (q_schedvers, SQL_SCHEDVERS),
    "q_operdays": (q_operdays, SQL_OPERDAYS),
    "q_calendar_exceptions": (q_calendar_exceptions, SQL_CALENDAR_EXCEPTIONS),
}
