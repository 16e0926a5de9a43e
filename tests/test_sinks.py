"""Published feeds: sorted parts of bounded size, visible all at once."""

import os

import pytest

from gtfsforge import sinks


def _feed(spark, n, tag):
    st = spark.range(n).selectExpr(f"concat('{tag}', lpad(cast(id * 7919 % {n} as string), 8, '0')) as trip_id", "cast(id % 40 as int) as stop_sequence", "repeat('x', 20) as stop_id", "date_add(date'2024-01-01', cast(id % 3 as int)) as day")
    return {"stop_times": st, "agency": spark.createDataFrame([(tag, None)], "agency_id string, agency_url string")}


def test_parts_are_sorted_and_sized(spark, tmp_path):
    path = str(tmp_path / "pub")
    assert sinks.publish_feed(_feed(spark, 40_000, "a"), path, part_bytes=100_000) == 1
    got = sinks.read_feed(spark, path)
    assert got["stop_times"].count() == 40_000 and got["agency"].first()["agency_url"] is None
    files = sorted(f for d, _, names in os.walk(path) for f in (os.path.join(d, x) for x in names) if f.endswith(".parquet") and "stop_times" in f)
    assert len(files) >= 3
    ends = [spark.read.parquet(f).selectExpr("min(trip_id)", "max(trip_id)").first() for f in files]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))  # ranges in order of the files
    one = [r["trip_id"] for r in spark.read.parquet(files[0]).collect()]
    assert one == sorted(one)


def test_large_tables_are_filed_under_columns(spark, tmp_path):
    path = str(tmp_path / "pub")
    sinks.publish_feed(_feed(spark, 300, "a"), path, partition_by={"stop_times": ["day"]})
    st = sinks.read_feed(spark, path)["stop_times"]
    assert st.count() == 300 and st.filter("day = date'2024-01-02'").count() == 100
    assert "PartitionFilters: [isnotnull(day" in st.filter("day = date'2024-01-02'")._jdf.queryExecution().toString()


def test_a_failed_write_leaves_the_old_feed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "pub")
    with pytest.raises(FileNotFoundError):
        sinks.read_feed(spark, path)
    sinks.publish_feed(_feed(spark, 100, "a"), path)
    broken = _feed(spark, 100, "b")
    broken["agency"] = broken["agency"].selectExpr("raise_error('lost') as agency_id")
    with pytest.raises(Exception, match="lost"):
        sinks.publish_feed(broken, path)
    old = sinks.read_feed(spark, path)
    assert old["stop_times"].first()["trip_id"].startswith("a") and old["agency"].count() == 1
    # the job is run again; a reader of the feed before still finds it, the one before that goes
    assert [sinks.publish_feed(_feed(spark, 100, t), path) for t in "bc"] == [2, 3]
    assert sinks.read_feed(spark, path)["agency"].first()["agency_id"] == "c" and sinks.read_feed(spark, path, 2)["agency"].first()["agency_id"] == "b"
    assert sorted(os.listdir(tmp_path / "pub" / "manifests"))[-2:] == ["2.json", "3.json"] and not (tmp_path / "pub" / "manifests" / "1.json").exists()


def test_two_jobs_cannot_publish_one_number(spark, tmp_path):
    path = str(tmp_path / "pub")
    sinks.publish_feed(_feed(spark, 10, "a"), path)
    with pytest.raises(FileExistsError):
        sinks._commit(spark, path, 1, "{}")
    assert sinks.read_feed(spark, path)["stop_times"].count() == 10
