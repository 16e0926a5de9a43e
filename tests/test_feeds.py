"""Whole-lineage builds (N-40): parse -> GTFS -> write -> validate."""

import datetime as dt

from gtfsforge import feeds, sinks
from gtfsforge.plans.fixtures import Fixtures
from gtfsforge.plans.q_kv1 import kv1_tables
from gtfsforge.sources import iff, pas

from conftest import SF_SMALL
from test_sources import _iff_dir


def test_build_kv1_feed_and_write(spark, tmp_path):
    feed = feeds.build_kv1(kv1_tables(Fixtures(spark, SF_SMALL)), materialize=True)
    assert set(feed) == {"agency", "feed_info", "stops", "routes", "calendar_dates", "trips", "stop_times", "shapes"}
    sinks.write_feed(feed, str(tmp_path / "gtfs"))
    back = spark.read.option("header", True).csv(str(tmp_path / "gtfs" / "stop_times"))
    assert back.count() == feed["stop_times"].count() > 0
    rules = {r["rule"] for r in feeds.validate(feeds.store_feed(feed)).collect()}
    assert "stop_times_duplicate_key" not in rules and "stop_times_time_decreases" not in rules
    assert "routes_unknown_agency" not in rules
    # tables are written in order, in any number of parts
    routes = spark.read.option("header", True).csv(str(tmp_path / "gtfs" / "routes"))
    assert routes.count() == feed["routes"].count()


def test_every_owner_has_its_options(spark):
    t = kv1_tables(Fixtures(spark, SF_SMALL))
    built = feeds.build_all_kv1(t, ("ARR", "SYNTUS"))
    assert set(built) == {"ARR", "SYNTUS"}
    own = built["ARR"]["routes"]
    assert {r["agency_id"] for r in built["ARR"]["agency"].collect()} == {r["agency_id"] for r in own.select("agency_id").distinct().collect()} == {"ARR", "WATERBUS"}
    assert built["SYNTUS"]["trips"].count() == 0
    assert feeds.FEED_OPTIONS["GVB"] == {"rank_mode": "row_number", "match_transport": True}


def test_build_iff_feed_from_files(spark, tmp_path):
    t = iff.read_iff(spark, _iff_dir(tmp_path))
    first = t["delivery"].first()["firstday"]
    for version in (1, 3):
        feed = feeds.build_iff(t, first, version=version)
        rows = [(r["trip_id"], r["stop_sequence"], r["stop_id"], r["arrival_time"], r["departure_time"],
                 r["pickup_type"]) for r in feed["stop_times"].collect()]
        # the 4th stop of service 1 lies outside its only service part (1..3): no trip, as in the source
        assert sum(1 for x in rows if x[0] is None) == 1
        st = sorted(x for x in rows if x[0] is not None)
        assert st[0] == ("1|7|1234", 1, "aaa|5a", "23:50:00", "23:50:00", 0)
        # the attribute NIIN on stop 2 means no boarding there
        assert ("1|7|1234", 2, "xxx|0", None, None, 1) in st
        trips = {r["trip_id"]: r for r in feed["trips"].collect()}
        assert trips["1|7|1234"]["trip_headsign"] == "Bbb"  # station at the part's last stop (3)
        assert feed["calendar_dates"].count() == 4
        assert feed["shapes"].count() == 0


def test_build_pas_feed_from_files(spark, tmp_path):
    hlt = tmp_path / "RET.HLT"
    hlt.write_bytes(("0,HA1   ,0,0,NL,0,0,92000,437000,Centraal,,,,1,,,\r\n"
                     "0,HA2   ,0,0,NL,0,0,93000,438000,Beurs,,,,1,,,\r\n"
                     "0,HA9   ,0,0,NL,0,0,93000,438000,Remise Oost,,,,1,,,\r\n").encode("cp1252"))
    p = tmp_path / "RET.PAS"
    p.write_bytes(("!RETPAS1\r\n&01012024-31012024\r\n#M,RET,001,1,12345\r\n-00001\r\n>HA9   ,2340\r\n"
                   ">HA1   ,2350\r\n<HA2   ,0010\r\n").encode("cp1252"))
    v = tmp_path / "RET.VTN"
    v.write_bytes("@00001,11\r\n".encode("cp1252"))
    j = pas.read_journeys(spark, str(p))
    t = {"stops": pas.read_stops(spark, str(hlt)), "pujo": j["pujo"], "pujopass": j["pujopass"],
         "voetnoot": pas.read_footnotes(spark, str(v), dt.date(2024, 1, 1))}
    feed = feeds.build_pas(t)
    assert {r["stop_id"] for r in feed["stops"].collect()} == {"HA1", "HA2"}  # depot dropped
    st = sorted((r["stop_sequence"], r["stop_id"], r["arrival_time"]) for r in feed["stop_times"].collect())
    assert st == [(2, "HA1", "23:50:00"), (3, "HA2", "24:10:00")]  # cascade + midnight rollover
    assert feed["trips"].first()["trip_headsign"] == "Beurs"
    fi = feed["feed_info"].first()
    assert fi["feed_start_date"] == "20240101" and fi["feed_end_date"] == "20240102"
