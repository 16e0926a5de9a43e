"""Integrity checks (B-2…B-4) and the GTFS feed validation (N-39).

The reference leans on PRIMARY KEY / FOREIGN KEY / NOT NULL constraints at
load time and on an external feed validator.  Here each rule is a query
that returns the violations, so a 100 TB load never fails half-way: checks
run as ordinary distributed jobs (hash aggregation, anti-joins, one
per-trip window) and report counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import great_circle_m, grid_cell
from ..functions.times import to_seconds

# Netherlands bounding box used by the stop-location rule (degrees)
NL_BOUNDS = (50.5, 53.8, 3.2, 7.3)


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (B-2): key columns + ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_foreign_key(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                      parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Child key values without a parent row (B-3): key columns + ``n``.
    Rows with a NULL key part pass (SQL foreign-key rule)."""
    parent_keys = list(parent_keys or child_keys)
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)]).distinct()
    c = child.select(*child_keys)
    for k in child_keys:
        c = c.filter(F.col(k).isNotNull())
    orphans = c.join(p, on=list(child_keys), how="left_anti")
    return orphans.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n"))


def check_not_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column in one pass (B-4): (column, nulls), all columns listed."""
    cols = list(cols or df.columns)
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.select(F.expr(f"stack({len(cols)}, {stack}) as (column, nulls)")) \
        .withColumn("nulls", F.coalesce(F.col("nulls"), F.lit(0)).cast("long"))


def _stack(counts: DataFrame, rules: list[str]) -> DataFrame:
    spec = ", ".join(f"'{r}', `{r}`" for r in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {spec}) as (rule, violations)"))


def validate_gtfs(feed: dict[str, DataFrame], bounds=NL_BOUNDS) -> DataFrame:
    """One row per violated rule with its count (N-39).

    Rules: stop_times key unique (counted per duplicated key); stop_times ->
    trips, stop_times -> stops, trips -> routes, trips -> calendar service
    ids, routes -> agencies; calendar dates unique per service; times never
    decrease along a trip; stops inside ``bounds``.  Rules with 0 violations
    are not listed.

    Stop times are shuffled once, by trip: one window per trip, whose sums meet
    the trip ids.  The other references are counted per id before they meet the
    ids that exist.  Every rule reads its columns separately, so pass stored
    tables (``feeds.store_feed``), not lazy derivations.
    """
    parts = []
    st, trips = feed.get("stop_times"), feed.get("trips")
    stops, routes, cal = feed.get("stops"), feed.get("routes"), feed.get("calendar_dates")
    agency = feed.get("agency")

    def ids(df: DataFrame, col: str) -> DataFrame:
        return df.select(col).filter(F.col(col).isNotNull()).distinct().withColumn("__there", F.lit(True))

    def unknown(rule: str, df: DataFrame, col: str, parent: DataFrame) -> DataFrame:
        """Rows whose ``col`` is none of the parent's (NULL is none)."""
        # no anti-join: the planner would move it below the counts, and all rows would meet the ids
        n = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).join(ids(parent, col), on=col, how="left")
        return _stack(n.agg(F.sum(F.when(F.col("__there").isNull(), F.col("n"))).alias(rule)), [rule])

    if st is not None:
        t = st.select("trip_id", "stop_sequence", to_seconds("arrival_time").alias("a"), to_seconds("departure_time").alias("d"))
        rules = ["stop_times_duplicate_key", "stop_times_time_decreases"]
        # one window: a duplicated key is counted at its second row
        trip_w = Window.partitionBy("trip_id").orderBy("stop_sequence", "a", "d")
        t = t.withColumn("__prev", F.lag("d").over(trip_w)).withColumn("__nth", F.row_number().over(trip_w)) \
            .withColumn("__seq1", F.lag("stop_sequence", 1).over(trip_w)).withColumn("__seq2", F.lag("stop_sequence", 2).over(trip_w))
        second = (F.col("__nth") > 1) & F.col("stop_sequence").eqNullSafe(F.col("__seq1")) \
            & ((F.col("__nth") == 2) | ~F.col("stop_sequence").eqNullSafe(F.col("__seq2")))
        # sums per trip first (the rows are together already): trips, not stop times, meet the ids
        t = t.groupBy("trip_id").agg(
            F.sum(second.cast("long")).alias(rules[0]),
            F.sum(F.coalesce((F.col("a") < F.col("__prev")) | (F.col("d") < F.col("a")), F.lit(False)).cast("long")).alias(rules[1]),
            F.count(F.lit(1)).alias("__n"))
        aggs = [F.sum(r).alias(r) for r in rules]
        if trips is not None:
            t = t.join(ids(trips, "trip_id"), on="trip_id", how="left")
            rules.append("stop_times_unknown_trip")
            aggs.append(F.sum(F.when(F.col("__there").isNull(), F.col("__n"))).alias("stop_times_unknown_trip"))
        parts.append(_stack(t.agg(*aggs), rules))
        if stops is not None:
            parts.append(unknown("stop_times_unknown_stop", st, "stop_id", stops))
    if trips is not None and routes is not None:
        parts.append(unknown("trips_unknown_route", trips, "route_id", routes))
    if trips is not None and cal is not None:
        parts.append(unknown("trips_unknown_service", trips, "service_id", cal))
    if routes is not None and agency is not None:
        parts.append(unknown("routes_unknown_agency", routes, "agency_id", agency))
    if cal is not None:
        dup = check_primary_key(cal, ["service_id", "date"]).agg(F.count(F.lit(1)).alias("calendar_dates_duplicate"))
        parts.append(_stack(dup, ["calendar_dates_duplicate"]))
    if stops is not None:
        lat_lo, lat_hi, lon_lo, lon_hi = bounds
        lat, lon = F.col("stop_lat").cast("double"), F.col("stop_lon").cast("double")
        # a stop without coordinates is not counted here (SQL three-valued logic)
        bad = F.coalesce(~(lat.between(lat_lo, lat_hi) & lon.between(lon_lo, lon_hi)), F.lit(False))
        parts.append(_stack(stops.agg(F.sum(bad.cast("long")).alias("stops_out_of_bounds")), ["stops_out_of_bounds"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("violations", F.coalesce(F.col("violations"), F.lit(0)).cast("long")) \
        .filter(F.col("violations") > 0)


def stops_too_close(stops: DataFrame, metres: float) -> DataFrame:
    """(stop_id, n_close) of the stops that have others within ``metres`` (N-39).

    Stops at one position count as one entry in a grid of cubes of that edge; every position meets those of
    its own and the 26 neighbouring cubes in an equi-join.  Stops without a position have no neighbours."""
    at = stops.filter(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()) \
        .select("stop_id", F.col("stop_lat").cast("double").alias("lat"), F.col("stop_lon").cast("double").alias("lon"))
    places = at.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n")).withColumn("cell", grid_cell("lat", "lon", metres))
    near = F.array(*[F.struct(*[(F.col(f"cell.{a}") + k).alias(a) for a, k in zip("xyz", shift)]) for shift in product((-1, 0, 1), repeat=3)])
    other = places.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("n").alias("n2"), F.explode(near).alias("cell2"))
    pairs = places.join(other, F.col("cell") == F.col("cell2")).filter(great_circle_m("lat", "lon", "lat2", "lon2") <= metres)
    found = pairs.groupBy("lat", "lon").agg((F.sum("n2") - 1).alias("n_close")).filter("n_close > 0")
    return at.join(found.toDF("lat3", "lon3", "n_close"), (F.col("lat") == F.col("lat3")) & (F.col("lon") == F.col("lon3"))).select("stop_id", "n_close")


def fast_travel(stop_times: DataFrame, stops: DataFrame, kmh: float) -> DataFrame:
    """(trip_id, stop_sequence, metres, seconds): legs between consecutive stops of a trip that
    are faster than ``kmh`` as the crow flies (N-39); a leg of no time counts as one second."""
    where = stops.select("stop_id", F.col("stop_lat").cast("double").alias("lat"), F.col("stop_lon").cast("double").alias("lon")).dropDuplicates(["stop_id"])
    t = stop_times.filter(F.col("trip_id").isNotNull()).select("trip_id", "stop_sequence", "stop_id", to_seconds("arrival_time").alias("a"), to_seconds("departure_time").alias("d")).join(where, "stop_id")
    w = Window.partitionBy("trip_id").orderBy("stop_sequence", "a", "d", "stop_id")
    prev = {c: F.lag(c).over(w) for c in ("lat", "lon", "d")}
    legs = t.select("trip_id", "stop_sequence", "lat", "lon", "a", *[v.alias(f"p_{c}") for c, v in prev.items()])
    legs = legs.select("trip_id", "stop_sequence", great_circle_m("p_lat", "p_lon", "lat", "lon").alias("metres"), (F.col("a") - F.col("p_d")).alias("seconds"))
    return legs.filter(F.col("metres") * 3.6 > F.greatest("seconds", F.lit(1)) * kmh)


def block_overlaps(trips: DataFrame, stop_times: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """(block_id, date, trip_id, start_s, busy_until_s): trips that start while an earlier trip of their
    block is still under way that day (N-39).

    A sweep over the trips of a block and day in order of their start (then end, then id) with the running
    maximum of the ends so far: no trip meets more than its predecessor's maximum."""
    times = stop_times.filter(F.col("trip_id").isNotNull()).groupBy("trip_id").agg(
        F.min(to_seconds("departure_time")).alias("start_s"), F.max(to_seconds("arrival_time")).alias("end_s"))
    days = calendar_dates.select("service_id", "date").distinct()
    own = trips.filter(F.col("block_id").isNotNull()).select("block_id", "service_id", "trip_id").distinct()
    # both sides grow with the feed, and far beyond what their files tell (ids and days are made from a few columns)
    t = own.join(times.hint("merge"), "trip_id").join(days.hint("merge"), "service_id")
    before = Window.partitionBy("block_id", "date").orderBy("start_s", "end_s", "trip_id").rowsBetween(Window.unboundedPreceding, -1)
    return t.withColumn("busy_until_s", F.max("end_s").over(before)).filter(F.col("start_s") < F.col("busy_until_s")) \
        .select("block_id", "date", "trip_id", "start_s", "busy_until_s")


def feed_orphans(feed: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations) of a feed whose trips, stop times and transfers must name each other; every
    rule is listed, also with 0.  Transfers between platforms (type 2) name no trips."""
    trips, st, routes, transfers = feed["trips"], feed["stop_times"], feed["routes"], feed["transfers"]
    there = F.lit(True)
    # trips are read once for their three rules; stop times grow with the feed, so their ids are not collected to be broadcast
    t = trips.select("trip_id", "route_id").join(routes.select("route_id").distinct().withColumn("__route", there), on="route_id", how="left") \
        .join(st.select("trip_id").distinct().withColumn("__called", there).hint("merge"), on="trip_id", how="left")
    no_id = F.col("trip_id").isNull()
    out = _stack(t.agg(F.count_if(no_id).alias("trips_without_id"), F.count_if(F.col("__route").isNull()).alias("trips_without_route"),
                       F.count_if(~no_id & F.col("__called").isNull()).alias("trips_without_stop_times")),
                 ["trips_without_id", "trips_without_route", "trips_without_stop_times"])
    rules = {"stop_times_without_trip_id": st.filter(F.col("trip_id").isNull())}
    if "from_trip_id" in transfers.columns:
        rules["transfers_without_trip_id"] = transfers.filter(
            (F.col("transfer_type") != 2) & (F.col("from_trip_id").isNull() | F.col("to_trip_id").isNull()))
    for rule, rows in rules.items():
        out = out.unionByName(rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations"))
    return out
