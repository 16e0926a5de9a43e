"""Physical-plan properties that must hold at any scale."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for b in BAD:
        assert b not in plan, f"{name} plans a {b}"


def test_scans_are_pruned(spark):
    """A query that needs four lineitem columns reads only those."""
    df = E.queries()["q_pk"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_constant_lookups_are_broadcast(spark):
    plan = _plan(E.queries()["q_trips"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_range_merges_are_equi_joins(spark):
    """Schedule ranges are expanded to days: no residual date condition, no nested loop."""
    for name in ("q_merge_range", "q_merge_range_unit"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        anti = [line for line in plan.splitlines() if "LeftAnti" in line]
        assert anti and all("validdate" in line for line in anti), name
        assert not any(">=" in line or "<=" in line for line in anti), name


def test_shapes_plan_without_running_a_job(spark):
    from gtfsforge.operators import gtfs_kv1 as G
    from gtfsforge.plans.fixtures import Fixtures
    from gtfsforge.plans.q_kv1 import kv1_tables

    t = kv1_tables(Fixtures(spark, SF_SMALL))
    t["pool"].count()
    sc = spark.sparkContext
    sc.setJobGroup("shapes", "plan only")
    try:
        plan = _plan(G.gtfs_shapes(t["jopatili"], t["pool"], t["line"]))
        assert not sc.statusTracker().getJobIdsForGroup("shapes")
    finally:
        sc.setJobGroup("", "")
    # points are numbered within a link, never within a whole pattern
    points = [line for line in plan.splitlines() if "Window [rank" in line]
    assert points and all(line.count("timinglinkorder") >= 1 for line in points)


def test_a_stored_feed_is_validated_from_its_files(spark):
    from gtfsforge import feeds
    from gtfsforge.operators import checks

    feed = {"stop_times": E.queries()["q_stop_times"](spark, SF_SMALL), "trips": E.queries()["q_trips"](spark, SF_SMALL)}
    plan = _plan(checks.validate_gtfs(feeds.store_feed(feed)))
    assert plan.count("Window [") == plan.count("Window [lag") and "fixtures" not in plan


def test_ranks_plan_without_running_a_job(spark):
    """Import positions and profile codes are numbered when they are read, and never over a whole group."""
    from gtfsforge.operators import increment as I
    from gtfsforge.operators import profiles
    from gtfsforge.plans.fixtures import Fixtures

    fx = Fixtures(spark, SF_SMALL)
    passes, manifest, ledger = fx.passes, fx.manifest, fx.ledger
    sc = spark.sparkContext
    sc.setJobGroup("ranks", "plan only")
    try:
        plans = [_plan(I.import_positions(I.plan_imports(manifest, I.drop_unpublished(ledger, manifest)))), _plan(profiles.compress_journeys(passes)["timdemgrp"])]
        assert not sc.statusTracker().getJobIdsForGroup("ranks")
    finally:
        sc.setJobGroup("", "")
    assert "__part" in plans[0] and "first_schedule" in plans[1]
    for plan in plans:
        numbered = [line for line in plan.splitlines() if "row_number" in line and "Window" in line]
        assert numbered and all("__part" in line or "first_schedule" in line for line in numbered)


def test_both_ends_of_a_connection_read_the_same_calls(spark):
    """The calls of trains are shuffled once for the two joins with the change records."""
    df = E.queries()["q_iff_connections_v3"](spark, SF_SMALL)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
