"""N-5/N-6/N-7 against straightforward Python restatements (brute force)."""

import random
from itertools import groupby

from pyspark.sql import functions as F

from gtfsforge.operators import profiles as P
from gtfsforge.plans.fixtures import Fixtures

from conftest import SF_SMALL


def _shares(times, distances):
    """A stretch's whole time by distance: floors (4 for a floor of 0), the rest on the last link."""
    total, length, n = sum(times), sum(distances), len(times)
    floors = [total * d // length if length else total // n for d in distances[:-1]]
    floors = [f or 4 for f in floors]
    return [*floors, total - sum(floors)]


def settled(times, distances):
    """Run times of one pattern after redistribution.

    A stretch begins at the first link without time, or before one, and ends with
    the next link that has time (or the last one).  Its last link, with its new time,
    is the first link of what remains.
    """
    opens = [i for i, t in enumerate(times) if 0 in times[i:i + 2]]
    if not opens:
        return times
    first = opens[0]
    last = min([j for j in range(first + 1, len(times)) if times[j]], default=len(times) - 1)
    new = _shares(times[first:last + 1], distances[first:last + 1])
    if last == len(times) - 1:
        return times[:first] + new
    return times[:first] + new[:-1] + settled(new[-1:] + times[last + 1:], distances[last:])


def _groups(rows, keys):
    rows = sorted(rows, key=lambda r: tuple(r[k] for k in keys) + (r["timinglinkorder"],))
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def test_redistribute_matches_fold(spark):
    fx = Fixtures(spark, SF_SMALL)
    rt = fx.runtimes.withColumnRenamed("drivetime", "totaldrivetime")
    keys = P.RUNTIME_GROUP
    got = {tuple(r[k] for k in keys) + (r["timinglinkorder"],): r["totaldrivetime"]
           for r in P.redistribute_drive_time(rt).collect()}
    src = [r.asDict() for r in rt.collect()]
    expected = {}
    for g, rows in _groups(src, keys):
        rows = list(rows)
        new = settled([r["totaldrivetime"] for r in rows], [r["distance"] for r in rows])
        for r, v in zip(rows, new):
            expected[g + (r["timinglinkorder"],)] = v
    assert got == expected


def test_redistribute_random_groups(spark):
    rnd = random.Random(7)
    data = []
    for g in range(300):
        n = rnd.randint(1, 12)
        for k in range(n):
            t = 0 if rnd.random() < 0.55 else rnd.randint(1, 400)
            data.append((1, "O", 1, g, 0, k + 1, k, k + 1, t, rnd.choice([0, 15]), rnd.randint(1, 900)))
    cols = ["version", "dataownercode", "lineplanningnumber", "journeypatterncode", "timedemandgroupcode",
            "timinglinkorder", "userstopcodebegin", "userstopcodeend", "totaldrivetime", "stopwaittime", "distance"]
    df = spark.createDataFrame(data, cols)
    got = {(r["journeypatterncode"], r["timinglinkorder"]): r["totaldrivetime"]
           for r in P.redistribute_drive_time(df).collect()}
    rows = [dict(zip(cols, x)) for x in data]
    for g, grp in _groups(rows, ["journeypatterncode"]):
        grp = list(grp)
        new = settled([r["totaldrivetime"] for r in grp], [r["distance"] for r in grp])
        for r, v in zip(grp, new):
            assert got[(g[0], r["timinglinkorder"])] == v


def test_redistribute_preserves_group_total(spark):
    fx = Fixtures(spark, SF_SMALL)
    rt = fx.runtimes.withColumnRenamed("drivetime", "totaldrivetime")
    before = rt.groupBy(*P.RUNTIME_GROUP).agg(F.sum("totaldrivetime").alias("t"))
    after = P.redistribute_drive_time(rt).groupBy(*P.RUNTIME_GROUP).agg(F.sum("totaldrivetime").alias("t"))
    assert before.exceptAll(after).count() == 0


def test_offsets_are_running_sums(spark):
    rows = [(1, "O", 1, 1, 0, k, k, k + 1, t, w) for k, (t, w) in enumerate([(60, 0), (30, 15), (0, 10), (45, 0)], 1)]
    df = spark.createDataFrame(rows, ["version", "dataownercode", "lineplanningnumber", "journeypatterncode",
                                      "timedemandgroupcode", "timinglinkorder", "userstopcodebegin",
                                      "userstopcodeend", "totaldrivetime", "stopwaittime"])
    got = [r["totaldrivetime"] for r in P.pass_offsets(df).orderBy("timinglinkorder").collect()]
    assert got == [60, 90, 105, 160]


def test_compress_round_trip(spark):
    """Expanding the compressed journeys gives back the original passing times."""
    fx = Fixtures(spark, SF_SMALL)
    passes = fx.passes
    c = P.compress_journeys(passes)
    # profiles with the same code in a pattern are identical
    rnt = c["timdemrnt"]
    assert rnt.groupBy(*P.GROUP, "timedemandgroupcode", "timinglinkorder").count().filter("count > 1").count() == 0
    sp = c["schedpujo"]
    assert sp.count() == passes.select(*P.JOURNEY).distinct().count()
    # rebuild departure times from departure + cumulative totals
    rebuilt = sp.join(rnt, on=P.GROUP + ["timedemandgroupcode"])
    from pyspark.sql import Window
    w = Window.partitionBy(*P.JOURNEY).orderBy("timinglinkorder")
    rebuilt = rebuilt.withColumn("dep_next", F.col("departure_s") + F.sum("totaldrivetime").over(w)) \
        .select(*P.JOURNEY, (F.col("timinglinkorder") + 1).alias("stoporder"), "dep_next")
    orig = passes.select(*P.JOURNEY, "stoporder", F.coalesce("dep_s", "arr_s").alias("dep_next"))
    assert rebuilt.exceptAll(orig.join(rebuilt.select(*P.JOURNEY, "stoporder"), on=P.JOURNEY + ["stoporder"])
                             .select(*P.JOURNEY, "stoporder", "dep_next")).count() == 0


def test_codes_last_from_delivery_to_delivery(spark):
    """New profiles follow, known ones keep their codes, whatever is imported again."""
    ddl = "version int, dataownercode string, organizationalunitcode string, schedulecode string, scheduletypecode string, lineplanningnumber string, journeynumber int, journeypatterncode string, stoporder int, userstopcode string, arr_s long, dep_s long"

    def delivery(version, drives):
        rows = []
        for number, drive in enumerate(drives):
            rows += [(version, "ARR", "U", "S", "WE", "1", number, "p", 1, "a", None, 100), (version, "ARR", "U", "S", "WE", "1", number, "p", 2, "b", 100 + drive, None)]
        return spark.createDataFrame(rows, ddl)

    def codes(tables):
        return {r["journeynumber"]: r["timedemandgroupcode"] for r in tables["schedpujo"].collect()}

    known, first = P.lasting_codes(delivery(1, [60, 90, 60]))
    assert codes(first) == {0: 0, 1: 1, 2: 0}
    known, second = P.lasting_codes(delivery(2, [120, 90, 30, 60, 120]), known)
    assert codes(second) == {0: 2, 1: 1, 2: 3, 3: 0, 4: 2}
    after, again = P.lasting_codes(delivery(1, [60, 90, 60]), known)
    assert codes(again) == codes(first) and after.count() == known.count() == 4
    assert sorted((r["timedemandgroupcode"], r["totaldrivetime"]) for r in second["timdemrnt"].collect()) == [(0, 60), (1, 90), (2, 120), (3, 30)]
    empty, none = P.lasting_codes(delivery(3, []), known)
    assert empty.count() == 4 and none["schedpujo"].count() == 0
