"""Feed rules on hand-made rows: distances, travel and blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gtfsforge.functions.geo import EARTH, great_circle_m, grid_cell
from gtfsforge.operators import checks as K
from gtfsforge.plans import q_checks

from conftest import SF_SMALL


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * EARTH * math.asin(math.sqrt(min(1, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def test_distance_and_cells(spark):
    rows = [(52.0, 5.0, 52.0, 5.0), (0.0, 0.0, 0.0, 180.0), (52.37, 4.9, 51.92, 4.47), (89.9, 0.0, 89.9, 180.0), (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(great_circle_m("a", "b", "c", "d")).collect()]
    assert got[4] is None and got[:4] == pytest.approx([metres(*r) for r in rows[:4]], rel=1e-6) and 57_000 < got[2] < 59_000
    rnd = random.Random(3)
    near = [(p, q, p + rnd.uniform(-1, 1) * 0.002, q + rnd.uniform(-1, 1) * 0.02) for p, q in ((rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for _ in range(400))]
    df = spark.createDataFrame(near, "a double, b double, c double, d double").withColumn("m", great_circle_m("a", "b", "c", "d"))
    cells = df.withColumn("u", grid_cell("a", "b", 250.0)).withColumn("v", grid_cell("c", "d", 250.0)).filter("m <= 250")
    assert cells.count() > 50
    assert cells.filter(F.greatest(*[F.abs(F.col(f"u.{x}") - F.col(f"v.{x}")) for x in "xyz"]) > 1).count() == 0


def test_stops_too_close_counts_all_others(spark):
    rnd = random.Random(4)
    stops = [(f"s{k}", 52 + rnd.random() / 500, 5 + rnd.random() / 300) for k in range(150)] + [(f"same{k}", 52.5, 5.5) for k in range(4)] + [("x", None, 5.0), ("y", 52.0, None), ("far", -80.0, 179.99999), ("far2", -80.0, -179.99999)]
    df = spark.createDataFrame(stops, "stop_id string, stop_lat double, stop_lon double")
    want = {}
    for a in stops:
        n = sum(1 for b in stops if a is not b and None not in a + b and metres(a[1], a[2], b[1], b[2]) <= 40)
        if n:
            want[a[0]] = n
    got = {r["stop_id"]: r["n_close"] for r in K.stops_too_close(df, 40.0).collect()}
    assert got == want and got["same0"] == 3 and got["far"] == 1
    assert K.stops_too_close(df.limit(0), 40.0).count() == 0


def test_fast_travel(spark):
    stops = spark.createDataFrame([("a", 52.0, 5.0), ("b", 52.01, 5.0), ("c", None, 5.0), ("b", 52.01, 5.0)], "stop_id string, stop_lat double, stop_lon double")
    st = spark.createDataFrame([("slow", 1, "a", "08:00:00", "08:00:00"), ("slow", 2, "b", "08:05:00", "08:05:00"), ("fast", 1, "a", "23:59:50", "23:59:50"), ("fast", 2, "b", "24:00:05", "24:00:05"),
                                ("now", 5, "a", "09:00:00", "09:00:00"), ("now", 9, "b", "09:00:00", "09:00:00"), ("lost", 1, "a", "09:00:00", "09:00:00"), ("lost", 2, "c", "09:00:01", "09:00:01"), (None, 1, "a", "09:00:00", None)],
                               "trip_id string, stop_sequence int, stop_id string, arrival_time string, departure_time string")
    got = {(r["trip_id"], r["stop_sequence"]): (round(r["metres"]), r["seconds"]) for r in K.fast_travel(st, stops, 120).collect()}
    assert got == {("fast", 2): (1112, 15), ("now", 9): (1112, 0)}


def test_block_overlaps(spark):
    trips = spark.createDataFrame([("v1", "wk", "t1"), ("v1", "wk", "t2"), ("v1", "sa", "t3"), ("v1", "wk", "t4"), ("v2", "wk", "t5"), (None, "wk", "t6")], "block_id string, service_id string, trip_id string")
    times = [("t1", 8, 12), ("t2", 9, 10), ("t3", 8, 9), ("t4", 11, 13), ("t5", 8, 9), ("t6", 8, 9)]
    st = spark.createDataFrame([(t, k, f"{h:02d}:00:00", f"{h:02d}:00:00") for t, a, b in times for k, h in enumerate((a, b))], "trip_id string, stop_sequence int, arrival_time string, departure_time string")
    days = spark.createDataFrame([("wk", "20240101"), ("wk", "20240102"), ("sa", "20240102"), ("wk", "20240101")], "service_id string, date string")
    got = sorted((r["date"], r["trip_id"], r["start_s"] // 3600, r["busy_until_s"] // 3600) for r in K.block_overlaps(trips, st, days).collect())
    # t4 starts after t2 ended, but t1 is still under way; t3 runs on the second day only, and t1 starts with it
    assert got == [("20240101", "t2", 9, 12), ("20240101", "t4", 11, 12), ("20240102", "t1", 8, 9), ("20240102", "t2", 9, 12), ("20240102", "t4", 11, 12)]


def test_every_rule_of_the_validation_fires(spark):
    rules = {r["rule"] for r in q_checks.q_validate(spark, SF_SMALL).collect()}
    assert rules == {"stop_times_duplicate_key", "stop_times_time_decreases", "stop_times_unknown_trip", "stop_times_unknown_stop", "trips_unknown_route", "trips_unknown_service",
                     "routes_unknown_agency", "calendar_dates_duplicate", "stops_out_of_bounds"}
