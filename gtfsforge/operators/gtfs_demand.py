"""GTFS from KV1 validity + time-demand groups (L2: N-11, N-20 and L2 trips).

A journey (pujo) is a departure time plus a time-demand group.  Everything
that depends only on the stop position — the stop, its offsets, its
product formula, headsign and boarding flags — is resolved first on a
per-(pattern, group) template built from pattern-level tables.  The
journeys then meet the template in one join keyed by (pattern, group),
which emits the pass rows: the journeys are shuffled once and the large
output never is.  A hot pattern is a skewed key on the journey side only,
which AQE's skew-join splitting handles (the template side of one key is
just that pattern's stops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cols import pipe_id
from ..functions.first import first_per_key
from ..functions.times import add_seconds_to_clock, format_clock
from . import mappings as M
from .gtfs_kv1 import PATTERN

DEMAND = PATTERN + ["timedemandgroupcode"]
PUJO_OUT = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode",
            "lineplanningnumber", "journeynumber", "stoporder", "journeypatterncode", "userstopcode",
            "arr_s", "dep_s", "wheelchairaccessible", "dataownerisoperator"]


def _first_links(jopatili: DataFrame) -> DataFrame:
    return first_per_key(jopatili, PATTERN, ["timinglinkorder"], ["timinglinkorder", "userstopcodebegin"]) \
        .withColumnRenamed("timinglinkorder", "first_tlo").withColumnRenamed("userstopcodebegin", "first_stop")


def pass_template(pujo: DataFrame, jopatili: DataFrame, timdempass: DataFrame) -> DataFrame:
    """The stops of every (pattern, time-demand group) that journeys use,
    with offsets from the departure: stop 1 = begin of the first link at
    offset 0; stop k+1 = end of the k-th link at its drive offset, left after
    its wait.  Built from pattern-level tables only (no journey rows)."""
    first = _first_links(jopatili)
    groups = pujo.select(*DEMAND).distinct()
    head = groups.join(first, on=PATTERN).select(
        *DEMAND, F.lit(1).alias("stoporder"), F.col("first_stop").alias("userstopcode"),
        F.lit(0).cast("long").alias("arr_off"), F.lit(0).cast("long").alias("dep_off"))
    rest = timdempass.select(*DEMAND, "timinglinkorder", "userstopcodeend", "totaldrivetime", "stopwaittime") \
        .join(first.select(*PATTERN, "first_tlo"), on=PATTERN).select(
        *DEMAND, (F.col("timinglinkorder") - F.col("first_tlo") + 2).cast("int").alias("stoporder"),
        F.col("userstopcodeend").alias("userstopcode"), F.col("totaldrivetime").cast("long").alias("arr_off"),
        (F.col("totaldrivetime") + F.col("stopwaittime")).cast("long").alias("dep_off"))
    return head.unionByName(rest)


def expand_passes(pujo: DataFrame, jopatili: DataFrame, timdempass: DataFrame) -> DataFrame:
    """pujopass rows from journeys (N-11).

    The per-(pattern, group) stop template is built first; the journeys then
    meet it in a single join keyed by (pattern, group), which produces the
    pass rows — the large output is never shuffled.  Later stops use the
    link's *end* stop (§8-D11).
    """
    tmpl = pass_template(pujo, jopatili, timdempass)
    base = pujo.select(
        "version", "dataownercode", "organizationalunitcode", F.col("periodgroupcode").alias("schedulecode"),
        F.col("daytype").alias("scheduletypecode"), "lineplanningnumber", "journeynumber", "journeypatterncode",
        "timedemandgroupcode", "departure_s", "wheelchairaccessible", "dataownerisoperator")
    return base.join(tmpl, on=DEMAND).select(
        *PUJO_OUT[:7], "stoporder", "journeypatterncode", "userstopcode",
        (F.col("departure_s") + F.col("arr_off")).alias("arr_s"),
        (F.col("departure_s") + F.col("dep_off")).alias("dep_s"), "wheelchairaccessible", "dataownerisoperator")


def stop_links(jopatili: DataFrame, dest: DataFrame) -> DataFrame:
    """Per pattern stop position: the link that starts there (or the last link
    for the final stop), with its product formula and destination name."""
    links = jopatili.select(*PATTERN, "timinglinkorder", "userstopcodebegin", "userstopcodeend", "destcode",
                            "productformulatype")
    # first and last link of every pattern in one aggregation
    ends = links.groupBy(*PATTERN).agg(
        F.min(F.struct("timinglinkorder", "destcode")).alias("f"),
        F.max(F.struct("timinglinkorder", "userstopcodeend", "destcode", "productformulatype")).alias("l")) \
        .select(*PATTERN, F.col("f.timinglinkorder").alias("first_tlo"), F.col("f.destcode").alias("trip_destcode"),
                F.col("l.timinglinkorder").alias("last_tlo"), F.col("l.destcode").alias("last_destcode"),
                F.col("l.productformulatype").alias("last_formula"))
    begins = links.join(ends, on=PATTERN).select(
        *PATTERN, (F.col("timinglinkorder") - F.col("first_tlo") + 1).cast("int").alias("stoporder"),
        F.col("timinglinkorder").alias("stop_sequence"), "destcode", "productformulatype", "trip_destcode",
        F.lit(False).alias("final"))
    finals = ends.select(
        *PATTERN, (F.col("last_tlo") - F.col("first_tlo") + 2).cast("int").alias("stoporder"),
        (F.col("last_tlo") + 1).alias("stop_sequence"), F.col("last_destcode").alias("destcode"),
        F.col("last_formula").alias("productformulatype"), "trip_destcode", F.lit(True).alias("final"))
    names = dest.select("version", "dataownercode", "destcode", "destnamefull")
    return begins.unionByName(finals).join(names, on=["version", "dataownercode", "destcode"], how="left")


def gtfs_stop_times_demand(
    pujo: DataFrame,
    timdempass: DataFrame,
    jopatili: DataFrame,
    usrstop: DataFrame,
    dest: DataFrame,
    exclude_lines: DataFrame | None = None,
) -> DataFrame:
    """stop_times.txt of the validity lineage (N-20).

    First stop at the departure time, every link end at departure + offset
    (``add32time``), hours past 24 kept.  The headsign is the destination of
    the link leaving the stop where it differs from the trip's.  Stops other
    than the final one must exist in usrstop (of type PASSENGER where the
    dialect has a type); pickup/drop-off come from their getin/getout, 3
    for on-demand formulas; the final stop is 0 (or 3).  Only journeys run
    by the data owner itself are exported.
    """
    pj = pujo.filter(F.col("dataownerisoperator"))
    if exclude_lines is not None:
        pj = pj.join(exclude_lines.select("lineplanningnumber").distinct(), on="lineplanningnumber", how="left_anti")
    # everything per stop position is resolved on the (pattern, group)
    # template; the journeys join it once and emit the stop rows
    stops = usrstop
    if "userstoptype" in stops.columns:
        stops = stops.filter(F.col("userstoptype") == "PASSENGER")
    stops = stops.select("version", "dataownercode", "userstopcode", "getin", "getout")
    tmpl = pass_template(pj, jopatili, timdempass) \
        .join(stop_links(jopatili, dest), on=PATTERN + ["stoporder"]) \
        .join(stops, on=["version", "dataownercode", "userstopcode"], how="left") \
        .filter(F.col("final") | F.col("getin").isNotNull())
    j = pj.select("version", "dataownercode", "lineplanningnumber", "journeypatterncode", "timedemandgroupcode",
                  F.col("periodgroupcode").alias("schedulecode"), F.col("daytype").alias("scheduletypecode"),
                  "journeynumber", "departure_s").join(tmpl, on=DEMAND) \
        .withColumn("arr_s", F.col("departure_s") + F.col("arr_off")) \
        .withColumn("dep_s", F.col("departure_s") + F.col("dep_off"))
    on_demand = F.col("productformulatype").isin(*M.ON_DEMAND_FORMULAS)

    def pick(flag: str):
        return F.when(on_demand, F.lit(3)).when(F.col("final"), F.lit(0)).otherwise((~F.col(flag)).cast("int"))

    return j.select(
        pipe_id("version", "dataownercode", "schedulecode", "scheduletypecode", "lineplanningnumber",
                "journeynumber").alias("trip_id"),
        F.col("stop_sequence"),
        pipe_id("dataownercode", "userstopcode").alias("stop_id"),
        F.when(F.col("destcode") != F.col("trip_destcode"), F.col("destnamefull")).alias("stop_headsign"),
        format_clock("arr_s").alias("arrival_time"),
        format_clock("dep_s").alias("departure_time"),
        pick("getin").alias("pickup_type"),
        pick("getout").alias("drop_off_type"),
    )


def gtfs_trips_demand(pujo: DataFrame, jopa: DataFrame, jopatili: DataFrame, dest: DataFrame) -> DataFrame:
    """trips.txt of the validity lineage: journeys run by the owner itself."""
    spark = pujo.sparkSession
    first = first_per_key(jopatili, PATTERN, ["timinglinkorder"], ["destcode"])
    names = dest.select("version", "dataownercode", "destcode", F.col("destnamefull").alias("trip_headsign"))
    wc = M.wheelchair(spark)
    j = (pujo.filter(F.col("dataownerisoperator"))
         .join(jopa.select(*PATTERN, "direction"), on=PATTERN)
         .join(first, on=PATTERN)
         .join(names, on=["version", "dataownercode", "destcode"])
         .join(wc, on="wheelchairaccessible"))
    return j.select(
        pipe_id("dataownercode", "lineplanningnumber").alias("route_id"),
        pipe_id("version", "dataownercode", "timetableversioncode", "organizationalunitcode", "periodgroupcode",
                "specificdaycode", "daytype").alias("service_id"),
        pipe_id("version", "dataownercode", "periodgroupcode", "daytype", "lineplanningnumber",
                "journeynumber").alias("trip_id"),
        F.col("trip_headsign"),
        (F.col("direction").cast("int") - 1).alias("direction_id"),
        pipe_id(*PATTERN).alias("shape_id"),
    )


__all__ = ["expand_passes", "gtfs_stop_times_demand", "gtfs_trips_demand", "stop_links", "add_seconds_to_clock"]
