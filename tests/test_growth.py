"""What must not grow with the input: what the driver collects, what a task holds, what is sorted and derived in vain."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gtfsforge.operators import calendars as C
from gtfsforge.operators import checks as K
from gtfsforge.operators import gtfs_iff as G
from gtfsforge.operators import shape_match as S
from gtfsforge.functions import format_clock, to_seconds
from gtfsforge.feeds import store, store_feed
from gtfsforge.plans import q_checks, q_iff, q_kv1, q_parse
from gtfsforge.plans.fixtures import ADAPTERS, BY_POSITION, Fixtures, render
from gtfsforge.session import RELEASE, shuffles_released
from gtfsforge.sources import iff as IFF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rail(spark):
    """A feed of a few services, nulls and repeats included."""
    rnd = random.Random(3)
    ids = [*range(40), 7, None]
    part = [(i, 100 + (i or 0) % 3, None if i == 5 else i, None, None, 1, 3) for i in ids]
    return {
        "stop": spark.createDataFrame([(i, k, f"s{k}", 600 * k, 600 * k + rnd.randrange(500)) for i in range(40) for k in (1, 2, 3)], "serviceid int, idx int, station string, arr_s int, dep_s int"),
        "platform": spark.createDataFrame([(i, k, f"s{k}", f"{i % 3}a", None if i == 9 else f"{i % 2}a") for i in range(40) for k in (1, 2, 3)], "serviceid int, idx int, station string, arrival string, departure string"),
        "service": spark.createDataFrame(part, "serviceid int, companynumber int, servicenumber int, variant string, servicename string, firststop int, laststop int"),
        "validity": spark.createDataFrame([(i, None if i == 8 else i % 4, 0, 999) for i in range(40) if i != 11], "serviceid int, footnote int, firststop int, laststop int"),
        "transport": spark.createDataFrame([(i, "IC", 1, 3) for i in range(38)], "serviceid int, transmode string, firststop int, laststop int"),
        "attribute": spark.createDataFrame([(12, "NIIN", 1, 2), (13, "GEFI", 1, 2)], "serviceid int, code string, firststop int, laststop int"),
        "station": spark.createDataFrame([(f"s{k}", f"S{k}", 1, 120, None, None, 0) for k in (1, 2, 3)], "shortname string, name string, trainchanges int, layovertime int, x int, y int, timezone int"),
        "trnsmode": spark.createDataFrame([("IC", "Intercity")], "code string, description string"),
        "company": spark.createDataFrame([(100 + k, f"c{k}", f"C{k}") for k in range(3)], "company int, code string, name string"),
        "changes": spark.createDataFrame([("s2", i, (i + 1) % 40, i % 4) for i in range(40)] * 2, "station string, fromservice int, toservice int, possiblechange int"),
    }


def _broadcast_keys(df) -> list[str]:
    return [line for line in _plan(df).splitlines() if "BroadcastHashJoin" in line and ("serviceid" in line or "trip_id" in line or "service_id" in line)]


def test_tables_of_services_are_not_collected_to_be_broadcast(spark, rail):
    """however small their files look."""
    for version in (1, 3):
        feed = G.exports(rail, version)
        for df in [*feed.values(), K.feed_orphans(feed)]:
            assert not _broadcast_keys(df)
    days = spark.createDataFrame([("NS:1", "20240101")], "service_id string, date string")
    assert not _broadcast_keys(K.block_overlaps(G.exports(rail)["trips"], G.exports(rail)["stop_times"], days))


def test_orphans_count_trips_once_per_rule(spark):
    feed = {
        "trips": spark.createDataFrame([("r", "a"), ("r", "a"), (None, "b"), ("x", None), ("r", "c")], "route_id string, trip_id string"),
        "stop_times": spark.createDataFrame([("a",), ("a",), (None,)], "trip_id string"),
        "routes": spark.createDataFrame([("r",), ("r",)], "route_id string"), "transfers": spark.createDataFrame([("a", "b")], "from_stop_id string, to_stop_id string"),
    }
    got = {r["rule"]: r["violations"] for r in K.feed_orphans(feed).collect()}
    assert got == {"trips_without_id": 1, "trips_without_route": 2, "trips_without_stop_times": 2, "stop_times_without_trip_id": 1}


def test_connections_are_those_of_all_calls(spark, rail):
    """calls that no record names are left out early; the result is that of joining all of them."""
    t = G.prepare(rail)
    args = [t[k] for k in ("changes", "platform", "stop", "station", "service", "validity", "attribute")]
    rows = {k: [r.asDict() for r in t[k].collect()] for k in t if k in ("changes", "platform", "stop", "service", "validity")}
    calls = [(p["serviceid"], p["station"], p, s, v, f) for p in rows["platform"] for s in rows["stop"] if (p["serviceid"], p["idx"], p["station"]) == (s["serviceid"], s["idx"], s["station"])
             for v in rows["service"] if v["serviceid"] == p["serviceid"] and v["firststop"] <= p["idx"] <= v["laststop"]
             for f in rows["validity"] if f["serviceid"] == p["serviceid"] and p["serviceid"] != 12]
    trip = lambda c: None if c[5]["footnote"] is None else f"{c[0]}|{c[5]['footnote']}|{c[4]['servicenumber']}"
    v1, v3 = {}, set()
    for c in rows["changes"]:
        for a in calls:
            for d in calls if a[:2] == (c["fromservice"], c["station"]) else []:
                if d[:2] != (c["toservice"], c["station"]) or d[2]["departure"] is None or a[2]["arrival"] is None or a[2]["arrival"] == d[2]["departure"]:
                    continue
                ends = tuple(None if x[2]["departure"] is None else f"{x[1]}|{x[2]['departure']}" for x in (a, d))
                if c["possiblechange"] in (1, 2) and d[3]["dep_s"] > a[3]["dep_s"]:
                    v1[ends] = min(v1.get(ends, 1 << 30), d[3]["dep_s"] - a[3]["arr_s"] - 30)
                if d[3]["dep_s"] > a[3]["arr_s"]:
                    v3.add((*ends, trip(a), trip(d), {0: 3, 1: 0, 2: 1}.get(c["possiblechange"], 99)))
    assert v1 and v3
    assert {(r["from_stop_id"], r["to_stop_id"]): r["min_transfer_time"] for r in G.connections_v1(*args).collect()} == v1
    assert {tuple(r)[:5] for r in G.connections_v3(*args).collect()} == v3
    for made in (G.connections_v1(*args), G.connections_v3(*args)):
        made.collect()
        assert "ReusedExchange" in _plan(made)


def test_rail_tables_are_derived_when_they_are_read():
    """an export of stations and stops derives no changes, modes or attributes."""

    class Counting:
        def __init__(self):
            self.read = set()

        def __getattr__(self, name):
            self.read.add(name)
            raise LookupError(name)

    fx = Counting()
    t = G.prepare(q_iff.iff_tables(fx), 3)
    assert len(t) == 10 and not fx.read
    with pytest.raises(LookupError):
        t["stop"]
    assert fx.read == {"iff_stops"}


def test_records_are_stored_without_a_sort_by_table(spark, tmp_path):
    """and the session's setting is as before."""
    body = ["%100,00012,      ,001,002,", "-00007,001,002", "&IC  ,001,002", "*NIIN,001,002,00000", ">a      ,0810", "?1    ,1    ,00007", "<b      ,0910"]
    sections = spark.createDataFrame([(f"{i:08d}", body) for i in range(50)], "head string, body array<string>")
    t = IFF.store_timetable(sections, str(tmp_path / "r"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert {k: df.count() for k, df in t.items()} == {"service": 50, "validity": 50, "transport": 50, "attribute": 50, "platform": 50, "stop": 100}
    # one task met its tables in turn, over and over, and wrote one file for each
    files = sum(len(list(d.glob("*.parquet"))) for d in (tmp_path / "r").glob("kind=*"))
    assert files <= 6 * sections.rdd.getNumPartitions()


def test_one_delivery_is_packed_at_a_time(spark):
    """F8: archives come out while lines still go in."""
    import pyarrow as pa

    taken = []

    def lines():
        for k in range(4):
            taken.append(k)
            yield pa.RecordBatch.from_pydict({"delivery": [f"{k}", f"{k}"], "member": ["PUJOPASSX.csv"] * 2, "line": ["a", "b"]})

    first = next(iter(q_parse._zipped(lines())))
    assert first.column(0).to_pylist() == ["delivery0.zip"] and taken == [0, 1]


def test_dates_are_dealt_out_before_they_are_made(spark):
    """neither the expansion nor the distinct dates run in tasks sized by the bytes of the services."""
    tive = spark.createDataFrame([(1, "A", "U", 1, 1, 1, None, None)], "version int, dataownercode string, organizationalunitcode string, timetableversioncode int, periodgroupcode int, specificdaycode int, validfrom date, validthru date")
    pegr = tive.select("version", "dataownercode", "organizationalunitcode", "periodgroupcode", F.to_date(F.lit("2024-01-01")).alias("validfrom"), F.to_date(F.lit("2024-01-14")).alias("validthru"))
    pujo = tive.select("version", "dataownercode", "timetableversioncode", "periodgroupcode", "specificdaycode", "organizationalunitcode", F.lit("12").alias("daytype"))
    exc = spark.createDataFrame([], "excopdate date, daytypeason string")
    ver = pegr.select("version", "validfrom", "validthru")
    df = C.calendar_with_exceptions(pegr, pujo, tive, exc, ver, "2024-01-01")
    assert _plan(df).count("REPARTITION_BY_NUM") >= 2
    assert sorted(r["date"] for r in df.collect()) == ["20240101", "20240102", "20240108", "20240109"]


def test_patterns_are_matched_many_at_a_time(spark):
    """no Python call per pattern; stops without order, position or line come through."""
    shapes = spark.createDataFrame([("s", 52.0, 5.0, 1), ("s", 52.0, 5.01, 2), ("gap", None, 5.0, 1), (None, 52.0, 5.0, 1)], "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int")
    stops = spark.createDataFrame([("s", 2, 52.0, 5.01), ("s", 1, 52.0, 5.0), ("s", None, 52.0, 5.01), ("s", 3, None, 5.0), ("gap", 1, 52.0, 5.0), (None, 1, 52.0, 5.0)], "shape_id string, stop_sequence int, stop_lat double, stop_lon double")
    df = S.stops_along_shapes(stops, shapes)
    assert "FlatMapCoGroups" not in _plan(df) and "MapInArrow" in _plan(df)
    got = {(r["shape_id"], r["stop_sequence"]): r["shape_dist_traveled"] for r in df.collect()}
    assert len(got) == 6 and got["s", 1] == 0 and got["s", 2] == got["s", None] == pytest.approx(684.6, abs=0.5)
    assert got["s", 3] is None and got["gap", 1] is None and got[None, 1] is None


PLANTED_INTO = {
    "stop_times": ([(f"t|{k}" if k else None, "08:00:00", None if k == 3 else "08:01:00", f"s{k}", s) for k in (0, 3, 7, 11, 13, 13, 111, 113, 117) for s in (1, 2, 3, None)],
                   "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int"),
    "trips": ([(f"r{k % 2}" if k else None, None if k == 19 else "wk", f"t|{k}" if k else None) for k in (0, 3, 17, 17, 19, 117, 119)], "route_id string, service_id string, trip_id string"),
    "calendar_dates": ([("wk", "20240105"), ("wk", "20240105"), ("wk", "20240106"), (None, "20240205"), ("wk", None)], "service_id string, date string"),
    "stops": ([("s1", 52.0, 5.0), ("s1", 52.0, 5.0), ("s2", 52.0, 5.0), ("s11", None, None), (None, 52.0, 5.0)], "stop_id string, stop_lat double, stop_lon double"),
}


@pytest.mark.parametrize("table", sorted(PLANTED_INTO))
def test_violations_are_planted_in_one_pass(spark, table):
    """the rows are those of the union, which derived its table once for every part."""
    rows, schema = PLANTED_INTO[table]
    df = spark.createDataFrame(rows, schema)
    made = spark.sql(render(q_checks.PLANTED_AT_ONCE[table], "spark"), **{table: df})
    union = spark.sql(q_checks.PLANTED[table], **{table: df})
    assert made.dtypes == union.dtypes and made.exceptAll(union).isEmpty() and union.exceptAll(made).isEmpty() and made.count() > df.count()
    assert _plan(made).count("Scan") == 1 and "Union" not in _plan(made)


def test_stop_times_are_shuffled_once_to_be_validated(spark):
    """sums of trips and counts of stops meet the ids; ids that are NULL or repeated count as before."""
    feed = {
        "stop_times": spark.createDataFrame([("a", 1, "s", "08:00:00", "08:00:00"), ("a", 1, "s", "08:00:00", "08:00:00"), ("a", 1, "x", "08:05:00", "08:05:00"), ("a", 2, None, "07:00:00", "07:00:00"),
                                             ("b", 1, "s", "9:00:10", "09:00:00"), ("lost", None, "s", None, "09:00:00"), ("lost", None, "x", None, None), (None, 1, "s", "10:00:00", "10:00:00"), (None, 1, "s", "11:00:00", "11:00:00")],
                                            "trip_id string, stop_sequence int, stop_id string, arrival_time string, departure_time string"),
        "trips": spark.createDataFrame([("a", "r", "wk"), ("a", "r", "wk"), ("b", "gone", None), (None, None, "gone")], "trip_id string, route_id string, service_id string"),
        "stops": spark.createDataFrame([("s", 52.0, 5.0), ("s", 52.0, 5.0), (None, 52.0, 5.0), ("far", 10.0, 5.0)], "stop_id string, stop_lat double, stop_lon double"),
        "routes": spark.createDataFrame([("r", "A"), ("r", "B"), ("q", None)], "route_id string, agency_id string"),
        "agency": spark.createDataFrame([("A",), (None,)], "agency_id string"),
        "calendar_dates": spark.createDataFrame([("wk", "20240101"), ("wk", "20240101")], "service_id string, date string"),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = K.validate_gtfs(feed)
        assert _plan(out).count("Exchange hashpartitioning(trip_id") == 2  # the stop times and the ids of trips
        stops = [line for line in _plan(out).splitlines() if "Exchange hashpartitioning(stop_id" in line]
        got = {r["rule"]: r["violations"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(stops) == 2
    assert got == {"stop_times_duplicate_key": 3, "stop_times_time_decreases": 2, "stop_times_unknown_trip": 4, "stop_times_unknown_stop": 3, "trips_unknown_route": 2, "trips_unknown_service": 2,
                   "routes_unknown_agency": 2, "calendar_dates_duplicate": 1, "stops_out_of_bounds": 1}


def test_timetables_are_read_from_stop_positions(spark, tmp_path):
    """the passes are shuffled once for links, lines and stops, and points of links are made for shapes only."""
    rnd = random.Random(5)
    keys = [*range(120), *range(4000, 4100), None]
    lines = [(k, n, rnd.randrange(9), None if k == 7 else 1, 1.0) for k in keys for n in range(1, 2 + rnd.randrange(5)) for _ in range(1 + (n == 3))]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("select id as o_orderkey, timestamp '1995-01-01' + make_interval(0, 0, 0, cast(id % 9 as int)) as o_orderdate from range(200)").write.parquet(str(tmp_path / "orders.parquet"))
    fx = Fixtures(spark, str(tmp_path))
    t = q_kv1.kv1_tables(fx)
    assert "pool" in list(t) and "pool" not in fx._cache and t["pool"].count() > 0 and "pool" in fx._cache
    for name in BY_POSITION:
        want = spark.sql(render(ADAPTERS[name], "spark"), passes=fx.passes)
        got = fx[name]
        assert got.dtypes == want.dtypes and got.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert "select distinct" in ADAPTERS[name]


def test_clock_texts_are_those_of_the_formatter(spark):
    """neither a formatter nor a split for every plain time."""
    n = [None, 0, 59, 60, 3599, 3600, 86399, 86400, 359999, 360000, -1, -60, -3600, -3601, -86400, 10 ** 12]
    df = spark.createDataFrame([(k,) for k in n], "s long").withColumn("made", format_clock("s"))
    old = F.format_string("%02d:%02d:%02d", F.floor(F.col("s") / 3600), F.floor((F.col("s") % 3600) / 60), F.col("s") % 60)
    assert "format_string" not in _plan(df)
    assert df.filter(~F.col("made").eqNullSafe(F.when(F.col("s").isNotNull(), old))).count() == 0
    texts = {"08:05:09": 29109, " 08:05:09 ": 29109, "8:05:09": 29109, "24:00:00": 86400, "100:00:01": 360001, "08:05": 29100, "12:34:5:": 45245, "12:34::5": None, "12:3::45": None, "ab:cd:ef": None, "": None, None: None}
    got = {r["t"]: r["s"] for r in spark.createDataFrame([(x,) for x in texts], "t string").withColumn("s", to_seconds("t")).collect()}
    assert got == texts


def test_rail_exports_shuffle_by_service_alone(spark, rail):
    """r04 F1: a table is shuffled once for all its joins, and what is joined is not shuffled again for the next."""
    for version in (1, 3):
        feed = G.exports(rail, version)
        # trips: service, validity, transport, stop, attribute, in v3 also the trains of 960 and the stops for the first of a part; stop times: platform, not transport
        for name, n in (("trips", 5 if version == 1 else 7), ("stop_times", 5)):
            keys = [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", _plan(feed[name])) if "dest_station" not in k]  # names of stations
            assert len(keys) == n and all(re.fullmatch(r"\w+#\d+", k) for k in keys), (version, name, keys)
    # small tables that have been stored are broadcast, also the companies, to which some are added
    rail = {k: store(df, k) for k, df in rail.items()}
    for name, n in (("trips", 7), ("routes", 8)):  # trains and buses alike: service, transport, stop, the trains of 960
        keys = [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", _plan(G.exports(rail, 3)[name])) if "," not in k]
        assert [k.split("#")[0] for k in keys] == ["serviceid"] * n, keys
    trips = G.exports(rail, 3)["trips"]
    trips.collect()
    assert "ReusedExchange" in _plan(trips)  # the stops of the ends of a part
    mode = G.open_single_transport(rail["transport"])
    assert _plan(mode).count("Exchange") == 1
    odd = spark.createDataFrame([(1, "A", 1), (1, "B", 2), (2, "A", 3), (None, "A", 4), (None, "B", 5)], "serviceid int, transmode string, laststop int")
    assert {tuple(r) for r in G.open_single_transport(odd).collect()} == {(1, "A", 1), (1, "B", 2), (2, "A", 999), (None, "A", 999), (None, "B", 999)}


def test_stop_times_and_trips_are_those_of_all_joins(spark, rail):
    """r04 F1: ranges, indexes and modes compared within the service; NULL, reversed and repeated rows as before."""
    rail = dict(rail)
    add = {"stop": [(3, None, "s1", 1, 2), (None, 1, "s1", 1, 2), (4, 2, "s9", 3, 4)], "platform": [(4, 2, "s2", "x", "y"), (5, None, "s2", "x", "y"), (None, 1, "s1", "x", "y")],
           "service": [(6, 100, 77, None, None, 3, 1), (12, 100, 78, None, None, 2, 3), (14, 100, 79, None, None, None, 3)],
           "validity": [(14, 9, 2, 3), (14, 9, 0, 999), (None, 1, 0, 999)], "transport": [(14, "IC", 2, 3), (15, "NSB", 2, 2), (15, "IC", 1, 3), (None, "IC", 1, 3)],
           "attribute": [(12, "NUIT", 3, 1), (13, "RESV", 2, 999), (13, "NUIT", 3, 3), (14, "IRES", None, 3), (14, None, 1, 3), (16, "NIIN", 1, 1), (16, "RESV", 1, 2), (None, "NIIN", 1, 3)]}
    for name, more in add.items():
        rail[name] = rail[name].unionByName(spark.createDataFrame(more, rail[name].schema))
    t = G.prepare(rail)
    rows = {k: [r.asDict() for r in t[k].collect()] for k in ("stop", "platform", "service", "validity", "transport", "attribute")}

    def of(name, service, where=lambda r: True):
        return [r for r in rows[name] if service is not None and r["serviceid"] == service and where(r)]

    def within(i, r):
        return None not in (i, r["firststop"], r["laststop"]) and r["firststop"] <= i <= r["laststop"]

    want = Counter()
    for s in rows["stop"]:
        i, k = s["serviceid"], s["idx"]
        codes = {a["code"] for a in of("attribute", i, lambda a: within(k, a))}
        for p in of("service", i, lambda p: within(k, p)) or [{}]:
            for q in of("platform", i, lambda q: k is not None and q["idx"] == k) or [{}]:
                for v in of("validity", i) or [{}]:
                    parts = (i, v.get("footnote"), p.get("servicenumber"))
                    arrival = q.get("arrival") if None not in (q.get("arrival"), q.get("departure")) and q["arrival"] != q["departure"] else None
                    reserved = 2 if codes & {"RESV", "IRES"} else 0
                    want["|".join(map(str, parts)) if None not in parts else None, f"{s['station']}|{q.get('departure') or '0'}", arrival and f"{s['station']}|{arrival}",
                         1 if "NIIN" in codes else reserved, 1 if "NUIT" in codes else reserved] += 1
    made = G.gtfs_stop_times_iff(t["stop"], t["attribute"], t["service"], t["validity"], t["platform"])
    assert Counter((r["trip_id"], r["stop_id"], r["arrival_stop_id"], r["pickup_type"], r["drop_off_type"]) for r in made.collect()) == want
    known = {r["shortname"] for r in rail["station"].collect()}
    trips = Counter()
    for p in rows["service"]:
        for v in of("validity", p["serviceid"], lambda v: v["footnote"] is not None and (v["laststop"] == 999 or (v["firststop"], v["laststop"]) == (p["firststop"], p["laststop"]))):
            for m in of("transport", p["serviceid"], lambda m: m["laststop"] == 999 or m["firststop"] == p["firststop"] is not None):
                for s in of("stop", p["serviceid"], lambda s: s["idx"] == p["laststop"] is not None and s["station"] in known):
                    trips[f"{p['companynumber']}-{m['transmode']}", f"{p['serviceid']}|{v['footnote']}|{p['servicenumber']}", s["station"].upper()] += 1
    made = G.gtfs_trips_iff(t["service"], t["validity"], t["transport"], t["attribute"], t["stop"], t["station"])
    assert Counter((r["route_id"], r["trip_id"], r["trip_headsign"]) for r in made.collect()) == trips


def test_orphans_of_stored_names_are_those_of_the_feed(spark, rail):
    """r04 F1: calls, then one export after the other, are stored; the rules find what they find in the feed."""
    made = []

    def keep(calls):
        made.append(calls)
        return store(calls, "calls")

    feed, stored = G.exports(rail, 3), G.exports(rail, 3, keep)
    assert len(made) == 2  # the platforms that are named, and their calls
    for name, df in feed.items():
        assert df.dtypes == stored[name].dtypes and df.exceptAll(stored[name]).isEmpty() and stored[name].exceptAll(df).isEmpty()
    names = {name: stored[name].select(*read) for name, read in q_iff._NAMES.items()}
    want = {r["rule"]: r["violations"] for r in K.feed_orphans(feed).collect()}
    assert set(names) == set(feed) and want["stop_times_without_trip_id"] and want["trips_without_id"]
    assert {r["rule"]: r["violations"] for r in K.feed_orphans({**stored, **store_feed(names, side_by_side=False)}).collect()} == want


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    """r04 F1: neither tables of a feed nor those derived from the driver's."""
    def files() -> set:
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f.rsplit("/", 1)[-1] for f in blocks.split("\n") if "/shuffle_" in f}

    dealt = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = files()
    assert store(dealt, "dealt").count() == 7 and store_feed({"a": dealt, "b": dealt}, side_by_side=False)["b"].count() == 7
    assert Fixtures(spark, str(tmp_path)).stored("dealt", lambda: dealt).count() == 7
    kept = files() - before
    # the three counts read them back, which are queries of their own: one row a count is shuffled
    assert sum(1 for f in kept if f.endswith(".data")) <= 4
    assert spark.conf.get(RELEASE) == "false"
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        with shuffles_released(spark):
            assert spark.conf.get(RELEASE) == "true"
        assert spark.conf.get(RELEASE) == "true"
        1 / 0
    assert spark.conf.get(RELEASE) == "false"
