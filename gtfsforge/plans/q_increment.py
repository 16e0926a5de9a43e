"""Queries over feed deliveries: merge policies, purge, import planning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import increment as I
from .fixtures import Fixtures, duckdb_with

PURGE_AS_OF = dt.date(1999, 6, 1)
_OD = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode", "validdate"]
_SK = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode"]


def merge_inputs(fx: Fixtures) -> dict[str, DataFrame]:
    """Base = schedules 0-11, delta = schedules 8-19 stamped as versions 3/4."""
    od = fx.operday
    base = od.filter(F.col("schedulecode") < 12)
    delta = od.filter(F.col("schedulecode") >= 8).withColumn("version", F.col("version") + 2)
    sv = delta.groupBy(*_SK).agg(F.date_add(F.min("validdate"), 30).alias("validfrom"),
                                 F.date_sub(F.max("validdate"), 30).alias("validthru"))
    ledger = base.select("version").unionByName(delta.select("version")).distinct().withColumn(
        "unitcode", F.when(F.col("version") % 2 == 1, F.lit("SGHR")).otherwise(F.lit("SGHB")))
    return {"base": base, "delta": delta, "schedvers": sv, "ledger": ledger}


_MERGE_CTES = f"""
, base as (select * from operday where schedulecode < 12),
delta as (select version + 2 as version, dataownercode, organizationalunitcode, schedulecode, scheduletypecode, validdate
   from operday where schedulecode >= 8),
sv as (select {', '.join(_SK)}, min(validdate) + 30 as validfrom, max(validdate) - 30 as validthru from delta group by all),
led as (select distinct version, case when version % 2 = 1 then 'SGHR' else 'SGHB' end as unitcode
   from (select version from base union select version from delta))"""


def _merge_sql(policy: str) -> str:
    cols = ", ".join(_OD)
    same_day = ("not exists (select 1 from dd where dd.organizationalunitcode = b.organizationalunitcode "
                "and dd.dataownercode = b.dataownercode and dd.validdate = b.validdate)")
    delta_src = "delta"
    extra = ""
    from_min = ("not coalesce(b.validdate >= (select min(d.validdate) from {src} d where d.organizationalunitcode = "
                "b.organizationalunitcode and d.dataownercode = b.dataownercode), false)")
    if policy in ("clip_delta", "clip_full"):
        extra = f""",
dc as (select d.* from delta d left join sv on sv.version = d.version and sv.organizationalunitcode = d.organizationalunitcode
   and sv.dataownercode = d.dataownercode
   and sv.schedulecode = d.schedulecode and sv.scheduletypecode = d.scheduletypecode
   where not coalesce(d.validdate < sv.validfrom, false))"""
        delta_src = "dc"
        keep = same_day if policy == "clip_delta" else from_min.format(src="dc")
    elif policy == "range":
        keep = ("not exists (select 1 from sv where sv.organizationalunitcode = b.organizationalunitcode "
                "and sv.dataownercode = b.dataownercode and b.validdate between sv.validfrom and sv.validthru)")
    elif policy == "range_unit":
        keep = ("not exists (select 1 from sv join led dv on dv.version = sv.version, led ov "
                "where ov.version = b.version and ov.unitcode = dv.unitcode "
                "and sv.organizationalunitcode = b.organizationalunitcode "
                "and sv.dataownercode = b.dataownercode and b.validdate between sv.validfrom and sv.validthru)")
    elif policy == "same_day":
        keep = same_day
    elif policy == "from_min":
        keep = from_min.format(src="delta")
    else:
        keep = "true"
    return duckdb_with(["operday"], f"""{_MERGE_CTES}{extra},
dd as (select distinct organizationalunitcode, dataownercode, validdate from {delta_src})
select {cols} from base b where {keep}
union all
select {cols} from {delta_src}
""")


def _merge_query(policy: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = merge_inputs(Fixtures(spark, sf_dir))
        return I.merge_operday(m["base"], m["delta"], policy, m["schedvers"], m["ledger"])

    q.__name__ = f"q_merge_{policy}"
    return q


# ---- q_merge_sequence (N-4, L-2) ---------------------------------------------

# delivery -> policy; delivery 0 is what was there before
SEQUENCE = [(0, "append"), (1, "same_day"), (2, "range"), (3, "clip_delta"), (4, "range_unit"), (5, "from_min"), (6, "append"), (7, "clip_full")]


def sequence_inputs(fx: Fixtures) -> dict[str, DataFrame]:
    """Each delivery takes every third schedule and 600 days of the calendar, 250 days after the one before."""
    n = F.explode(F.array(*[F.lit(k) for k, _ in SEQUENCE])).alias("delivery")
    start = F.date_add(F.lit("1992-01-01").cast("date"), 250 * F.col("delivery"))
    days = fx.operday.select("*", n).filter(((F.col("schedulecode") + F.col("delivery")) % 3 == 0) & (F.col("validdate") >= start) & (F.col("validdate") < F.date_add(start, 600)))
    days = days.withColumn("version", F.col("version") + 2 * F.col("delivery")).select(*_OD, "delivery")
    sv = days.groupBy(*_SK, "delivery").agg(F.date_add(F.min("validdate"), 30).alias("validfrom"), F.date_sub(F.max("validdate"), 30).alias("validthru"))
    ledger = days.select("version", F.when(F.col("version") % 4 < 2, "SGHR").otherwise("SGHB").alias("unitcode")).distinct()
    return {"days": days, "deliveries": fx.spark.createDataFrame(SEQUENCE, "delivery int, policy string"), "schedvers": sv, "ledger": ledger}


def q_merge_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = sequence_inputs(Fixtures(spark, sf_dir))
    return I.merge_many(m["days"], m["deliveries"], m["schedvers"], m["ledger"])


def _merge_sequence_sql() -> str:
    """A day stays unless there is a later delivery whose rule names it."""
    same_unit = "x.organizationalunitcode = b.organizationalunitcode and x.dataownercode = b.dataownercode and x.delivery > b.delivery"
    return duckdb_with(["operday"], f"""
, how(delivery, policy) as (values {", ".join(f"({k}, '{p}')" for k, p in SEQUENCE)}),
taken as (select o.version + 2 * delivery as version, {", ".join(_OD[1:])}, delivery, policy from operday o, how
   where (schedulecode + delivery) % 3 = 0 and validdate >= date '1992-01-01' + 250 * delivery and validdate < date '1992-01-01' + 250 * delivery + 600),
sv as (select {", ".join(_SK)}, delivery, policy, min(validdate) + 30 as validfrom, max(validdate) - 30 as validthru from taken group by all),
d as (select t.* from taken t join sv using ({", ".join(_SK)}, delivery) where not starts_with(t.policy, 'clip') or t.validdate >= sv.validfrom),
one as (select distinct organizationalunitcode, dataownercode, delivery, validdate from d where policy in ('same_day', 'clip_delta')),
first as (select organizationalunitcode, dataownercode, delivery, min(validdate) as validdate from d where policy in ('from_min', 'clip_full') group by all)
select {", ".join(_OD)}, delivery from d b
where not exists (select 1 from one x where {same_unit} and x.validdate = b.validdate)
 and not exists (select 1 from first x where {same_unit} and b.validdate >= x.validdate)
 and not exists (select 1 from sv x where {same_unit} and b.validdate between x.validfrom and x.validthru
   and (x.policy = 'range' or x.policy = 'range_unit' and (x.version % 4 < 2) = (b.version % 4 < 2)))
""")


SQL_MERGE_SEQUENCE = _merge_sequence_sql()


# ---- q_purge (N-8) ----------------------------------------------------------

def q_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return I.purge_expired(fx.versions, fx.version_days, PURGE_AS_OF).select(
        "version", "dataownercode", "filename", "validfrom", "validthru", "purged")


SQL_PURGE = duckdb_with(["versions", "version_days"], f"""
, last as (select version, max(validdate) as validthru from version_days group by version)
select v.version, v.dataownercode, v.filename, v.validfrom, l.validthru,
 coalesce(l.validthru < date '{PURGE_AS_OF}' - interval 1 day, true) as purged
from versions v left join last l on l.version = v.version
""")


# ---- q_plan_imports (N-2, L-1, L-4) -----------------------------------------

def q_plan_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    ledger = I.drop_unpublished(fx.ledger, fx.manifest)
    return I.import_positions(I.plan_imports(fx.manifest, ledger))


SQL_PLAN_IMPORTS = duckdb_with(["manifest", "ledger"], """
, live as (select * from ledger l where not exists (select 1 from manifest m where m.feedkey = l.feedkey and not m.ispublished))
select m.*, cast(row_number() over (order by m.isbaseline desc, m.idx, m.publishorder, m.feedkey) as integer) as position from manifest m
where m.ispublished and not exists (select 1 from live l where l.feedkey = m.feedkey and l.dataownerversion = m.dataownerversion)
""")


# ---- q_stamp_version, q_cascade (N-3, K-5, K-6) -----------------------------

def q_stamp_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    stamped = I.stamp_version({"operday": fx.operday.select(*_OD)}, I.next_version(fx.versions))
    return stamped["operday"]


SQL_STAMP_VERSION = duckdb_with(["operday", "versions"], f"""
select cast((select max(version) + 1 from versions) as integer) as version, {', '.join(_OD[1:])} from operday
""")


def q_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    ledger = I.purge_expired(fx.versions, fx.version_days, PURGE_AS_OF)
    return I.cascade_live(fx.version_days, ledger.filter(~F.col("purged"))).select("version", "validdate")


SQL_CASCADE = duckdb_with(["versions", "version_days"], f"""
, alive as (select version from version_days group by version having max(validdate) >= date '{PURGE_AS_OF}' - interval 1 day)
select d.version, d.validdate from version_days d join alive a on a.version = d.version
where d.version in (select version from versions)
""")


# ---- q_manifest_diff (L-3) --------------------------------------------------

def q_manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return I.manifest_diff(fx.manifest, fx.ledger)


SQL_MANIFEST_DIFF = duckdb_with(["manifest", "ledger"], """
, old as (select feedkey, max(dataownerversion) as v from ledger group by feedkey)
select m.* from manifest m left join old o on o.feedkey = m.feedkey where o.v is null or m.dataownerversion > o.v
""")


# ---- q_feed_metadata (N-1) --------------------------------------------------

def q_feed_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.feed_metadata(Fixtures(spark, sf_dir).operday, as_of=PURGE_AS_OF)


SQL_FEED_METADATA = duckdb_with(["operday"], f"""
select dataownercode, min(validdate) as valid_from, max(validdate) as valid_thru,
 max(validdate) < date '{PURGE_AS_OF}' - interval 1 day as expired
from operday group by dataownercode
""")


QUERIES = {f"q_merge_{p}": (_merge_query(p), _merge_sql(p)) for p in I.POLICIES}
QUERIES["q_merge_sequence"] = (q_merge_sequence, SQL_MERGE_SEQUENCE)
QUERIES.update({
    "q_purge": (q_purge, SQL_PURGE),
    "q_plan_imports": (q_plan_imports, SQL_PLAN_IMPORTS),
    "q_stamp_version": (q_stamp_version, SQL_STAMP_VERSION),
    "q_cascade": (q_cascade, SQL_CASCADE),
    "q_manifest_diff": (q_manifest_diff, SQL_MANIFEST_DIFF),
    "q_feed_metadata": (q_feed_metadata, SQL_FEED_METADATA),
})
