"""Keys, references and deletions over a graph of tables."""

import pytest

from gtfsforge.operators import constraints as G
from gtfsforge.plans import q_checks
from gtfsforge.sources import schemas

from conftest import SF_SMALL


def _tables(spark):
    return {
        "a": spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, name string"),
        "b": spark.createDataFrame([(10, 1), (11, 2), (12, None), (13, 99)], "id int, a int"),
        "c": spark.createDataFrame([(100, 10), (101, 11), (102, 12), (102, 13)], "id int, b int"),
        "d": spark.createDataFrame([(7, 100, 2), (8, 101, 1), (9, None, 3)], "id int, c int, a int"),
    }


def _graph(cascade=True):
    keys = {t: ["id"] for t in "abcd"}
    return G._graph(keys, [("b", "a", "a", "id", cascade), ("c", "b", "b", "id", cascade), ("d", "c", "c", "id", cascade), ("d", "a", "a", "id", False)], {"a": ["name"]})


def _ids(tables):
    return {t: sorted(r["id"] for r in df.collect()) for t, df in tables.items()}


def test_every_kind_of_violation_is_counted(spark):
    got = {(r["kind"], r["constraint"]): r["violations"] for r in G.check(_tables(spark), _graph()).collect()}
    assert got[("required", "a.name")] == 1 and got[("key", "c(id)")] == 1 and got[("key", "a(id)")] == 0
    assert got[("reference", "b(a) -> a")] == 1  # the NULL names nothing
    assert got[("reference", "d(c) -> c")] == 0 and got[("required", "d.id")] == 0
    empty = {t: df.limit(0) for t, df in _tables(spark).items()}
    assert {r["violations"] for r in G.check(empty, _graph()).collect()} == {0}


def test_deletions_follow_references_transitively(spark):
    t = _tables(spark)
    one = spark.createDataFrame([(1,)], "id int")
    assert _ids(G.delete(t, _graph(), {"a": one})) == {"a": [2, 3], "b": [11, 12, 13], "c": [101, 102, 102], "d": [8, 9]}
    # d(a) does not cascade by itself; following all references it does
    assert _ids(G.delete(t, _graph(), {"a": one}, follow_all=True))["d"] == [9]
    # without cascading references only the listed rows go
    assert _ids(G.delete(t, _graph(False), {"a": one}))["b"] == [10, 11, 12, 13]
    # rows whose parent never was stay, and nothing listed deletes nothing
    assert _ids(G.delete(t, _graph(), {"a": one.limit(0)}, follow_all=True)) == _ids(t)


def test_order_and_circles(spark):
    g = G.kv1_constraints()
    order = g.parents_first([*schemas.KV1_TABLES, "version"])
    assert order[0] == "version" and order.index("line") < order.index("jopa") < order.index("jopatili") < order.index("timdemrnt")
    assert all(order.index(r.parent) < order.index(r.child) for r in g.references)
    circle = G._graph({}, [("a", "x", "b", "x"), ("b", "x", "a", "x")])
    with pytest.raises(ValueError):
        circle.parents_first(["a", "b"])
    # every constraint names columns that the tables have
    for r in g.references:
        if r.parent != "version":
            assert set(r.columns) <= {n for n, _ in schemas.full_columns(r.child)} and list(r.parent_columns) and set(r.parent_columns) <= set(schemas.keys(r.parent))


def test_planted_violations_are_found(spark):
    rows = q_checks.q_constraints(spark, SF_SMALL).collect()
    found = {r["constraint"] for r in rows if r["violations"]}
    assert {r["kind"] for r in rows if r["violations"]} == {"key", "required", "reference"}
    assert {"dest.destnamefull", "jopatili.destcode", "line(version, dataownercode, lineplanningnumber)", "pujopass(version, dataownercode, userstopcode) -> usrstop",
            "jopatili(version, dataownercode, destcode) -> dest", "operday(version, dataownercode) -> version"} <= found


def test_metro_passes_go_with_their_stop(spark):
    t = {"stops": spark.createDataFrame([("A", 1, 1), ("B", 1, 1)], "halteid string, x int, y int"),
         "pujopass": spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "halteid string, richting int")}
    left = G.delete(t, G.pas_constraints(), {"stops": spark.createDataFrame([("A",)], "halteid string")})
    assert [r["halteid"] for r in left["pujopass"].collect()] == ["B"] and left["stops"].count() == 1
