"""Run-time profiles (N-5, N-6, N-7).

* :func:`compress_journeys` — journeys of one pattern that drive the same
  run times share a time-demand group (KV1 "schedpujo" compression).
* :func:`redistribute_drive_time` — spread a run time recorded on one link
  over the following links recorded with 0 s, by distance.
* :func:`pass_offsets` — arrival offset of each link end from the journey
  departure.

All three work per pattern (or per journey) on arrays that are bounded by
the number of stops of one trip, so no task ever holds more than one
pattern's links; the grouping itself is a regular hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rank import nested_rank

JOURNEY = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode",
           "lineplanningnumber", "journeynumber"]
GROUP = ["version", "dataownercode", "lineplanningnumber", "journeypatterncode"]
RUNTIME_GROUP = GROUP + ["timedemandgroupcode"]


# --------------------------------------------------------------------------
# N-5
# --------------------------------------------------------------------------

def journey_profiles(pujopass: DataFrame) -> DataFrame:
    """One row per journey: its ordered link run times (the profile).

    For consecutive passes a -> b (dep = coalesce(dep, arr), arr =
    coalesce(arr, dep)): total = dep(b) - dep(a), drive = arr(b) - dep(a),
    wait = total - drive.  A single-stop journey gets an empty profile.
    """
    dep = F.coalesce("dep_s", "arr_s")
    arr = F.coalesce("arr_s", "dep_s")
    extra = [c for c in ("wheelchairaccessible", "dataownerisoperator") if c in pujopass.columns]
    stops = pujopass.select(
        *JOURNEY, "journeypatterncode", *extra,
        F.struct(F.col("stoporder").alias("o"), F.col("userstopcode").alias("stop"),
                 dep.cast("long").alias("dep"), arr.cast("long").alias("arr")).alias("s"))
    aggs = [F.array_sort(F.collect_list("s")).alias("stops")]
    aggs += [F.min_by(c, "s.o").alias(c) for c in extra]
    j = stops.groupBy(*JOURNEY, "journeypatterncode").agg(*aggs)
    n = F.size("stops")
    head = F.slice("stops", 1, n - 1)
    tail = F.slice("stops", F.lit(2), n - 1)
    profile = F.zip_with(head, tail, lambda a, b: F.struct(
        a["o"].alias("timinglinkorder"), a["stop"].alias("userstopcodebegin"), b["stop"].alias("userstopcodeend"),
        (b["dep"] - a["dep"]).alias("totaldrivetime"), (b["arr"] - a["dep"]).alias("drivetime"),
        ((b["dep"] - a["dep"]) - (b["arr"] - a["dep"])).alias("stopwaittime")))
    return j.select(*JOURNEY, "journeypatterncode", *extra,
                    F.element_at("stops", 1)["dep"].alias("departure_s"), profile.alias("profile"))


def compress_journeys(pujopass: DataFrame) -> dict[str, DataFrame]:
    """Time-demand-group compression (N-5, §2.2).

    Returns ``schedpujo`` (journey + ``timedemandgroupcode``), ``timdemgrp``
    and ``timdemrnt``.  Codes are 0, 1, 2 … per (version, owner, line,
    pattern) in the order in which the profile first appears in journey-key
    order.  Grouping is on the profile array itself (exact, no hash
    collisions); the code ranking runs over distinct profiles, never
    over journeys, and is numbered per schedule (``nested_rank``): no window over a whole pattern, no job while planning.
    """
    jp = journey_profiles(pujopass)
    first_key = F.struct("organizationalunitcode", "schedulecode", "scheduletypecode", "journeynumber")
    profiles = jp.groupBy(*GROUP, "profile").agg(F.min(first_key).alias("first_key"))
    # first keys are distinct per profile, so the dense rank is a row number: that within
    # the first key's schedule plus the profiles of the pattern's earlier schedules
    parts = profiles.withColumn("first_schedule", F.struct("first_key.organizationalunitcode", "first_key.schedulecode", "first_key.scheduletypecode")) \
        .withColumn("first_journey", F.col("first_key.journeynumber"))
    codes = nested_rank(parts, GROUP, "first_schedule", ["first_journey"], "code1", method="row_number") \
        .withColumn("timedemandgroupcode", F.col("code1") - 1).drop("first_key", "first_schedule", "first_journey", "code1")
    coded = codes.select(*[F.col(k).alias(f"__{k}") for k in GROUP], F.col("profile").alias("__profile"), "timedemandgroupcode")
    same = F.col("profile") == F.col("__profile")
    for k in GROUP:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))  # a NULL key part is a value like any other
    schedpujo = jp.join(coded, same).drop("profile", "__profile", *[f"__{k}" for k in GROUP])
    timdemgrp = codes.select(*GROUP, "timedemandgroupcode")
    timdemrnt = codes.select(*GROUP, "timedemandgroupcode", F.explode("profile").alias("r")).select(
        *GROUP, "timedemandgroupcode", "r.*")
    return {"schedpujo": schedpujo, "timdemgrp": timdemgrp, "timdemrnt": timdemrnt}


#: A pattern, whatever delivery describes it.
LASTING = [k for k in GROUP if k != "version"]


def _same(columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return out


def lasting_codes(pujopass: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Compression with codes that stay the same from delivery to delivery (N-5, L-1).

    ``known`` is the dictionary so far: (owner, line, pattern, content, timedemandgroupcode), where ``content`` is a
    SHA-256 of the profile.  A profile keeps the code that its content has; new ones follow the
    largest code of their pattern, in order of first appearance.  So importing a
    delivery again, or after others, changes no code.  Returns the dictionary with the new
    entries, to be stored for the next delivery, and the tables of :func:`compress_journeys`."""
    entry = [*LASTING, "content"]
    jp = journey_profiles(pujopass).withColumn("content", F.sha2(F.to_json("profile"), 256))
    first = F.struct("version", "organizationalunitcode", "schedulecode", "scheduletypecode", "journeynumber")
    fresh = jp.groupBy(*entry).agg(F.min(first).alias("first"))
    if known is not None:
        old = known.select(*[F.col(c).alias(f"__{c}") for c in entry])
        fresh = fresh.join(old, _same(entry), "left_anti")
    fresh = fresh.withColumn("first_schedule", F.struct("first.version", "first.organizationalunitcode", "first.schedulecode", "first.scheduletypecode")) \
        .withColumn("first_journey", F.col("first.journeynumber"))
    fresh = nested_rank(fresh, LASTING, "first_schedule", ["first_journey"], "nth", method="row_number").withColumn("timedemandgroupcode", F.col("nth") - 1)
    if known is not None:
        top = known.groupBy(*[F.col(c).alias(f"__{c}") for c in LASTING]).agg(F.max("timedemandgroupcode").alias("top"))
        fresh = fresh.join(top, _same(LASTING), "left").withColumn("timedemandgroupcode", F.coalesce(F.col("top") + 1, F.lit(0)) + F.col("nth") - 1)
    dictionary = fresh.select(*entry, F.col("timedemandgroupcode").cast("int").alias("timedemandgroupcode"))
    if known is not None:
        dictionary = known.select(*dictionary.columns).unionByName(dictionary)
    codes = dictionary.select(*[F.col(c).alias(f"__{c}") for c in entry], "timedemandgroupcode")
    coded = jp.join(codes, _same(entry)).drop(*[f"__{c}" for c in entry], "content")
    groups = coded.groupBy(*GROUP, "timedemandgroupcode").agg(F.first("profile").alias("profile"))
    return dictionary, {
        "schedpujo": coded.drop("profile"), "timdemgrp": groups.drop("profile"),
        "timdemrnt": groups.select(*GROUP, "timedemandgroupcode", F.explode("profile").alias("r")).select(*GROUP, "timedemandgroupcode", "r.*"),
    }


# --------------------------------------------------------------------------
# N-6
# --------------------------------------------------------------------------

def _floor_div(a: Column, b: Column) -> Column:
    """Integer floor division for b > 0 (Python's ``//``), exact in longs."""
    # (a - pmod(a, b)) is an exact multiple of b, so the quotient is exact
    return ((a - F.pmod(a, b)) / b).cast("long")


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it inside ``body`` (avoids re-evaluating a
    sub-expression that a lambda references several times)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _redistribute(run: Column) -> Column:
    """Spread the run's total time over its links by distance (§2.3).

    alloc = floor(T*d/D), 4 where that is 0, the remainder T - sum(alloc)
    on the last link.  D = 0 (no distances) splits evenly.
    """
    zero = F.lit(0).cast("long")
    totals = F.struct(
        F.aggregate(run, zero, lambda acc, x: acc + x["t"]).alias("t"),
        F.aggregate(run, zero, lambda acc, x: acc + x["d"]).alias("d"),
        F.size(run).cast("long").alias("n"))

    def with_totals(tot):
        def alloc(x):
            raw = F.when(tot["d"] > 0, _floor_div(tot["t"] * x["d"], tot["d"])).otherwise(_floor_div(tot["t"], tot["n"]))
            return F.when(raw == 0, F.lit(4).cast("long")).otherwise(raw)

        def finalize(al):
            spent = F.aggregate(al, zero, lambda acc, x: acc + x["t"])
            return F.transform(al, lambda x, i: x.withField(
                "t", x["t"] + F.when(i == tot["n"] - 1, tot["t"] - spent).otherwise(zero)))

        return _let(F.transform(run, lambda x: x.withField("t", alloc(x))), finalize)

    return _let(totals, with_totals)


def redistribute_drive_time(timdemrnt: DataFrame, link: DataFrame | None = None) -> DataFrame:
    """Spread run time recorded on one link over following 0-second links (N-6).

    ``link`` (version, userstopcodebegin, userstopcodeend, distance) gives
    the distance as the shortest link per stop pair (pre-aggregated before
    the join); rows without a distance drop out, as in the reference.
    Without ``link`` the input must carry ``distance``.

    The chained rule (a closing link that is followed by another 0 re-enters
    the next run with its new value) makes this a sequential fold, done per
    group with ``aggregate`` over the sorted links in the JVM.
    """
    rt = timdemrnt
    if link is not None:
        d = link.groupBy("version", "userstopcodebegin", "userstopcodeend").agg(F.min("distance").alias("distance"))
        rt = rt.drop("distance").join(d, on=["version", "userstopcodebegin", "userstopcodeend"])
    keys = [c for c in RUNTIME_GROUP + ["implicit"] if c in rt.columns]
    elem = F.struct(
        F.col("timinglinkorder").alias("o"), F.col("userstopcodebegin").alias("b"),
        F.col("userstopcodeend").alias("e"), F.col("totaldrivetime").cast("long").alias("t"),
        F.col("stopwaittime").cast("long").alias("w"), F.col("distance").cast("long").alias("d"))
    g = rt.groupBy(*keys).agg(F.array_sort(F.collect_list(elem)).alias("links"))
    # lookahead: the original run time of the next link in the group
    links = F.transform("links", lambda x, i: x.withField("nt", F.get(F.col("links"), i + 1)["t"]))
    empty = F.slice(F.col("links_n"), 1, 0)

    def step(acc, x):
        buf, out = acc["buf"], acc["out"]
        flush = (F.size(buf) > 0) & (x["t"] != 0)
        flushed = _let(_redistribute(F.concat(buf, F.array(x))), lambda red: F.struct(
            F.concat(out, F.slice(red, 1, F.size(red) - 1)).alias("out1"),
            F.element_at(red, -1).alias("cur"), F.slice(buf, 1, 0).alias("buf1")))
        plain = F.struct(out.alias("out1"), x.alias("cur"), buf.alias("buf1"))

        def after(st):
            keep = (st["cur"]["t"] == 0) | F.coalesce(x["nt"] == 0, F.lit(False))
            return F.struct(
                F.when(keep, F.concat(st["buf1"], F.array(st["cur"]))).otherwise(st["buf1"]).alias("buf"),
                F.when(keep, st["out1"]).otherwise(F.concat(st["out1"], F.array(st["cur"]))).alias("out"))

        return _let(F.when(flush, flushed).otherwise(plain), after)

    def finish(acc):
        return F.when(F.size(acc["buf"]) > 0, F.concat(acc["out"], _redistribute(acc["buf"]))).otherwise(acc["out"])

    folded = g.withColumn("links_n", links).select(
        *keys, F.aggregate("links_n", F.struct(empty.alias("buf"), empty.alias("out")), step, finish).alias("r"))
    return folded.select(*keys, F.explode("r").alias("x")).select(
        *keys, F.col("x.o").alias("timinglinkorder"), F.col("x.b").alias("userstopcodebegin"),
        F.col("x.e").alias("userstopcodeend"), F.col("x.t").alias("totaldrivetime"),
        F.col("x.w").alias("stopwaittime"), F.col("x.d").alias("distance"))


# --------------------------------------------------------------------------
# N-7
# --------------------------------------------------------------------------

def pass_offsets(runtimes: DataFrame) -> DataFrame:
    """timdempass (N-7): offset of each link end = drives so far + earlier waits.

    Two running sums over one window partitioned by the run-time group (the
    links of one pattern); ``totaldrivetime`` of the output is the offset.
    """
    keys = [c for c in RUNTIME_GROUP + ["implicit"] if c in runtimes.columns]
    w = Window.partitionBy(*keys).orderBy("timinglinkorder")
    drive = F.sum(F.col("totaldrivetime").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    waits = F.coalesce(F.sum(F.col("stopwaittime").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0).cast("long"))
    return runtimes.select(*keys, "timinglinkorder", "userstopcodebegin", "userstopcodeend",
                           (drive + waits).alias("totaldrivetime"), F.col("stopwaittime").cast("long").alias("stopwaittime"))
