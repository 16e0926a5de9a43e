"""Column functions and edge cases of the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gtfsforge.functions import first_per_key, format_clock, pad_seconds, to_seconds
from gtfsforge.functions.geo import rd_to_wgs84
from gtfsforge.operators import calendars as C
from gtfsforge.operators import gtfs_pas, increment, profiles


def test_clock_times_past_midnight(spark):
    df = spark.createDataFrame([("24:04:30",), ("7:05",), ("",), (None,), ("25:00:00",)], "t string")
    got = [r[0] for r in df.select(to_seconds("t")).collect()]
    assert got == [86670, 25500, None, None, 90000]
    back = [r[0] for r in spark.createDataFrame([(86670,), (59,), (None,)], "s long").select(format_clock("s")).collect()]
    assert back == ["24:04:30", "00:00:59", None]
    assert [r[0] for r in spark.createDataFrame([("12:30",), ("12:30:15",)], "t string")
            .select(pad_seconds("t")).collect()] == ["12:30:00", "12:30:15"]


def test_rd_origin_maps_to_amersfoort(spark):
    r = spark.createDataFrame([(155000, 463000)], "x long, y long").select(rd_to_wgs84("x", "y").alias("p")).first()["p"]
    assert abs(r["lat"] - 52.15517440) < 1e-9 and abs(r["lon"] - 5.38720621) < 1e-9


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "q")], "k string, o int, v string")
    got = {r["k"]: r["v"] for r in first_per_key(df, ["k"], ["o", "v"], ["v"]).collect()}
    assert got == {"a": "y", "b": "q"}
    got = {r["k"]: r["v"] for r in first_per_key(df, ["k"], ["o", "v"], ["v"], descending=True).collect()}
    assert got == {"a": "x", "b": "q"}


def test_empty_and_single_day_ranges(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3), dt.date(2024, 1, 1)), (dt.date(2024, 1, 1), dt.date(2024, 1, 1)),
                                (dt.date(2024, 1, 1), None)], "a date, b date")
    got = [r[0] for r in df.select(F.size(C.date_range("a", "b"))).collect()]
    assert got == [0, 1, 0]


def test_operating_days_weekday_digits(spark):
    sv = spark.createDataFrame([(1, "O", "U", "S", "17", dt.date(2024, 1, 1), dt.date(2024, 1, 14))],
                               "version int, dataownercode string, organizationalunitcode string, schedulecode string, "
                               "scheduletypecode string, validfrom date, validthru date")
    days = sorted(r["validdate"] for r in C.expand_operating_days(sv).collect())
    # digit 1 = Sunday, 7 = Saturday
    assert days == [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 13), dt.date(2024, 1, 14)]


def test_midnight_wrap_between_departure_and_next_arrival(spark):
    # The wrap happens between dep of stop 1 and arr of stop 2
    rows = [("t", 1, None, 86000), ("t", 2, 100, 160), ("t", 3, 200, None)]
    df = spark.createDataFrame(rows, "trip string, seq int, arr_s long, dep_s long")
    got = sorted((r["seq"], r["arr_s"], r["dep_s"]) for r in
                 gtfs_pas.normalise_midnight(df, ["trip"], "seq").collect())
    assert got == [(1, None, 86000), (2, 86500, 86560), (3, 86600, None)]


def test_single_stop_journey_keeps_empty_profile(spark):
    # A journey with one stop is kept with an empty profile
    cols = ("version int, dataownercode string, organizationalunitcode string, schedulecode string, "
            "scheduletypecode string, lineplanningnumber string, journeynumber int, stoporder int, "
            "journeypatterncode string, userstopcode string, arr_s long, dep_s long")
    df = spark.createDataFrame([(1, "O", "U", "S", "T", "L", 7, 1, "P", "s1", None, 600)], cols)
    c = profiles.compress_journeys(df)
    sp = c["schedpujo"].first()
    assert sp["journeynumber"] == 7 and sp["timedemandgroupcode"] == 0 and sp["departure_s"] == 600
    assert c["timdemrnt"].count() == 0


def test_merge_policy_null_validthru_deletes_nothing(spark):
    cols = ("version int, dataownercode string, organizationalunitcode string, schedulecode string, "
            "scheduletypecode string, validdate date")
    base = spark.createDataFrame([(1, "O", "U", "A", "T", dt.date(2024, 1, 2))], cols)
    delta = spark.createDataFrame([(2, "O", "U", "B", "T", dt.date(2024, 1, 5))], cols)
    sv = spark.createDataFrame([(2, "O", "U", "B", "T", dt.date(2024, 1, 1), None)],
                               cols.replace("validdate date", "validfrom date, validthru date"))
    assert increment.merge_operday(base, delta, "range", sv).count() == 2
    assert increment.merge_operday(base, delta, "from_min").count() == 2  # base day is before the delta's first
    assert increment.merge_operday(base, delta, "append").count() == 2
    with pytest.raises(ValueError):
        increment.merge_operday(base, delta, "nope")


def test_merge_same_day_is_idempotent(spark):
    cols = ("version int, dataownercode string, organizationalunitcode string, schedulecode string, "
            "scheduletypecode string, validdate date")
    base = spark.createDataFrame([(1, "O", "U", "A", "T", dt.date(2024, 1, d)) for d in (1, 2, 3)], cols)
    delta = spark.createDataFrame([(2, "O", "U", "A", "T", dt.date(2024, 1, d)) for d in (2, 3, 4)], cols)
    once = increment.merge_operday(base, delta, "same_day")
    twice = increment.merge_operday(once, delta, "same_day")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_purge_moves_expired_and_unused_versions(spark):
    ledger = spark.createDataFrame([(1, "a.zip"), (2, "b.zip"), (3, "c.zip")], "version int, filename string")
    od = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 6, 1))], "version int, validdate date")
    got = {r["version"]: r["purged"] for r in increment.purge_expired(ledger, od, dt.date(2024, 3, 1)).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_unit_code_rule(spark):
    df = spark.createDataFrame([("HTM", "HTMbuzz-2024"), ("HTM", "htm-rail"), ("ARR", "x")], "o string, k string")
    got = [r[0] for r in df.select(increment.unit_code(F.col("o"), F.col("k"))).collect()]
    assert got == ["SGHB", "SGHR", "ARR"]


def test_grouped_rank_matches_window_rank_on_a_hot_key(spark):
    from pyspark.sql import Window

    from gtfsforge.functions.rank import grouped_rank

    # key 'hot' holds most rows and spans every range partition; ties included
    rows = [("hot", i // 3, i) for i in range(3000)] + [("cold", i % 5, i) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, o int, u int")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy("o")))
    got = grouped_rank(df, ["k"], ["o"], "r", method="rank", partitions=8)
    assert sorted(map(tuple, got.select("k", "o", "u", "r").collect())) == \
        sorted(map(tuple, want.select("k", "o", "u", "r").collect()))
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("o", "u")))
    got = grouped_rank(df, ["k"], ["o", "u"], "r", method="row_number", partitions=8)
    assert sorted(map(tuple, got.select("k", "o", "u", "r").collect())) == \
        sorted(map(tuple, want.select("k", "o", "u", "r").collect()))
    pids = got.select("k").filter("k = 'hot'").count()
    assert pids == 3000


def test_sql_functions(spark):
    from gtfsforge.functions.sql import register_sql_functions

    register_sql_functions(spark)
    r = spark.sql("select toseconds('24:05:10') a, toseconds('7:05') b, add32time('23:58:00', 420) c, "
                  "timediff('23:50', '24:10') d, clocktext(59) e").first()
    assert (r.a, r.b, r.c, r.d, r.e) == (86710, 25500, "24:05:00", 1200, "00:00:59")


def test_formula_fixes_pad_seconds_and_reassign(spark):
    from gtfsforge.operators import gtfs_iff, gtfs_kv1

    jt = spark.createDataFrame([("VTN", "buur", 7), ("VTN", None, 7), ("ARR", "Bubu", None), ("XYZ", "belb", 5)],
                               "dataownercode string, deprecated string, productformulatype int")
    got = sorted(((r[0], r[1] or "", r[2]) for r in gtfs_kv1.product_formula_fixes(jt).collect()))
    assert got == [("ARR", "Bubu", 1), ("VTN", "", 7), ("VTN", "buur", 1), ("XYZ", "belb", 5)]
    pp = spark.createDataFrame([("12:30", "12:31"), ("12:30:00", "12:31")],
                               "targetarrivaltime string, targetdeparturetime string")
    got = [tuple(r) for r in gtfs_kv1.pad_seconds_text(pp).collect()]
    assert got == [("12:30:00", "12:31:00"), ("12:30:00", "12:31")]  # only the arrival's length is tested
    svc = spark.createDataFrame([(1, 960), (2, 960), (3, 960), (4, 100)], "serviceid int, companynumber int")
    tr = spark.createDataFrame([(1, "TGV"), (2, "THA"), (3, "IC"), (4, "TGV")], "serviceid int, transmode string")
    got = dict(map(tuple, gtfs_iff.reassign_company(svc, tr).select("serviceid", "companynumber").collect()))
    assert got == {1: 980, 2: 300, 3: 960, 4: 100}


def test_purge_changed_flag(spark):
    ledger = spark.createDataFrame([(1, False), (2, True)], "version int, purged boolean")
    assert increment.any_purged(ledger).first()["changed"] is True
    assert increment.any_purged(ledger.filter("version = 1")).first()["changed"] is False


def test_iff_stop_outside_parts_keeps_a_row_per_footnote(spark):
    from gtfsforge.operators import gtfs_iff

    stop = spark.createDataFrame([(1, 1, "a", None, 600), (1, 2, "b", 700, 720), (1, 3, "c", 800, None)],
                                 "serviceid int, idx int, station string, arr_s long, dep_s long")
    service = spark.createDataFrame([(1, 100, 12, None, 1, 2, None)],
                                    "serviceid int, companynumber int, servicenumber int, variant string, "
                                    "firststop int, laststop int, servicename string")
    validity = spark.createDataFrame([(1, 7, 0, 999), (1, 8, 0, 999)],
                                     "serviceid int, footnote int, firststop int, laststop int")
    attribute = spark.createDataFrame([], "serviceid int, code string, firststop int, laststop int")
    platform = spark.createDataFrame([], "serviceid int, idx int, station string, arrival string, departure string")
    rows = gtfs_iff.gtfs_stop_times_iff(stop, attribute, service, validity, platform).collect()
    trips = sorted((r["trip_id"] or "-", r["stop_sequence"]) for r in rows)
    assert trips == [("-", 1), ("-", 1), ("1|7|12", 1), ("1|7|12", 2), ("1|8|12", 1), ("1|8|12", 2)]


def test_no_fixed_ends_and_no_scratch_folder_on_a_cluster():
    import pathlib

    from gtfsforge import session

    code = "".join(p.read_text() for p in pathlib.Path(session.__file__).parent.rglob("*.py"))
    assert "10 ** 6" not in code and "coalesce(1)" not in code

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_rail_v3_numbers_and_companies_agree_between_trips_and_routes(spark):
    from gtfsforge.operators import gtfs_iff as G

    def frame(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    t = G.prepare({
        "service": frame([(1, 960, None, "1234", 1, 2, None), (2, 960, 70, None, 1, 2, None), (3, 960, 80, None, 1, 2, None)],
                         "serviceid int, companynumber int, servicenumber int, variant string, firststop int, laststop int, servicename string"),
        "transport": frame([(1, "IC", 1, 2), (2, "ES", 1, 2), (3, "THA", 1, 2), (3, "TGV", 1, 2)], "serviceid int, transmode string, firststop int, laststop int"),
        "company": frame([(960, "int", "International"), (980, "sncf", "SNCF")], "company int, code string, name string"),
        "trnsmode": frame([("IC", "Intercity"), ("ES", "Eurostar"), ("TGV", "stoptrein"), ("THA", "Thalys")], "code string, description string")}, version=3)
    assert {r["serviceid"]: (r["companynumber"], r["servicenumber"]) for r in t["service"].collect()} == {1: (960, 1234), 2: (999, 70), 3: (980, 80)}
    assert {r["company"] for r in t["company"].collect()} == {960, 980, 999}
    stop = frame([(s, i, n, 0, 0) for s in (1, 2, 3) for i, n in ((1, "a"), (2, "b"))], "serviceid int, idx int, station string, arr_s int, dep_s int")
    station = frame([("a", "A"), ("b", "B")], "shortname string, name string")
    validity = frame([(1, 7, 1, 2), (2, None, 0, 999), (3, 8, 0, 999)], "serviceid int, footnote int, firststop int, laststop int")
    attribute = frame([], "serviceid int, code string, firststop int, laststop int")
    trips = G.gtfs_trips_iff(t["service"], validity, t["transport"], attribute, stop, station, version=3)
    routes = G.gtfs_routes_iff_v3(t["transport"], t["trnsmode"], t["service"], t["company"], stop, station)
    assert trips.join(routes, "route_id", "left_anti").count() == 0
    got = {(r["route_id"], r["trip_short_name"]) for r in trips.collect()}
    assert ("960-IC-1200", 1234) in got and ("999-ES-0", 70) in got
    assert {r["route_short_name"] for r in routes.filter("route_id = '980-TGV-0'").collect()} == {"Stoptrein"}


def test_every_rail_v3_trip_has_its_route(spark):
    from conftest import SF_SMALL
    from gtfsforge.plans import q_iff

    trips, routes = q_iff.q_iff_trips_v3(spark, SF_SMALL), q_iff.q_iff_routes_v3(spark, SF_SMALL)
    assert trips.join(routes, "route_id", "left_anti").count() == 0
    assert {r["m"] for r in trips.selectExpr("split(route_id, '-')[1] as m").distinct().collect()} >= {"NSB", "BNS", "X", "U", "Y"}
    for query in (q_iff.q_iff_orphans_v1, q_iff.q_iff_orphans_v3):
        assert {r["violations"] for r in query(spark, SF_SMALL).collect()} == {0}
