"""GTFS from IFF rail timetables (N-24…N-33).

Inputs are the parsed IFF tables (see ``sources/iff.py``):
``service`` (serviceid, companynumber, servicenumber, variant, firststop,
laststop, servicename), ``validity`` (serviceid, footnote, firststop,
laststop), ``transport`` (serviceid, transmode, firststop, laststop),
``attribute`` (serviceid, code, firststop, laststop), ``stop`` (serviceid,
idx, station, arr_s, dep_s), ``platform`` (serviceid, idx, station,
arrival, departure), ``station`` (shortname, name, trainchanges,
layovertime, x, y, timezone), ``trnsmode`` (code, description),
``company`` (company, code, name), ``changes`` (station, fromservice,
toservice, possiblechange).

Tables that name a service meet by the service alone, one shuffle each, and
what is joined stays where it is for the next join; indexes, index ranges (a
service part covers stops firststop..laststop) and stations are compared
within the service, whose rows are those of one train.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, MutableMapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import as_text, null_of, pipe_id
from ..functions.first import first_per_key, nulls_last
from ..functions.geo import rd_to_wgs84
from ..functions.times import format_clock
from . import mappings as M

# ---- fixed values (must equal the reference's rail mode lists) ----
BUS_LIKE_MODES = ("NSS", "NSB", "B", "BNS", "X", "U", "Y")
BUS_LIKE_MODES_V3 = ("NSS", "NSB", "B", "NSM", "NST", "BNS", "X", "U", "Y")
BIKE_MODES = {1: ("HSN", "HSI"), 3: ("HSN", "HSI", "NSS", "NSB", "B", "NST")}
BIKE_ATTRIBUTES = {1: ("NIIN", "GEFI"), 3: ("GEFI",)}
STATION_OVERRIDES = [("aixtgv", 5.317222, 43.455), ("mannhe", 8.469858, 49.479633), ("magdeb", 11.627778, 52.130556)]
REASSIGN_960 = [("TGV", 980), ("THA", 300), ("ES", 999)]
EXTRA_COMPANIES = [(999, "EUROSTAR", "Eurostar")]
STOP_ATTRIBUTES = ("NIIN", "NUIT", "RESV", "IRES")
MODE_NAME_FIXES = [("stoptrein", "Stoptrein")]
V3_ROUTE_TYPES = [
    (("ES", "HSI", "HSN", "THA", "ICE", "TGV"), 101), (("INT", "IC", "EC"), 102), (("EN", "CNL"), 105),
    (("S", "ST"), 103), (("SPR",), 109),
]
# ---- end of fixed values ----


class Tables(MutableMapping):
    """Tables by name, each made when it is first read: an export makes what it reads, no more."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __setitem__(self, name: str, table: DataFrame) -> None:
        self._makers[name], self._made[name] = lambda: table, table

    def __delitem__(self, name: str) -> None:
        del self._makers[name]
        self._made.pop(name, None)

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def _large(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the services.  Sorted keys pack its files so well that the planner
    takes it for small and would collect it on the driver to broadcast it."""
    return df.hint("merge")


def _same(a: str, b: str) -> Column:
    """a = b, which the planner does not take for a key of the join: the tables then meet by service alone."""
    return (F.col(a) >= F.col(b)) & (F.col(a) <= F.col(b))


def _tc(c):
    """try_cast to int: NULL instead of an error for text that is not a number."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("int")


def station_points(station: DataFrame, overrides=STATION_OVERRIDES) -> DataFrame:
    """station + lon/lat (RD transform, literal overrides win) (I-30, I-32)."""
    spark = station.sparkSession
    ov = F.broadcast(spark.createDataFrame(overrides, "shortname string, o_lon double, o_lat double"))
    p = rd_to_wgs84("x", "y")
    has_xy = F.col("x").isNotNull() & F.col("y").isNotNull()
    s = station.join(ov, on="shortname", how="left")
    return s.withColumn("lon", F.coalesce(F.col("o_lon"), F.when(has_xy, p["lon"]))) \
        .withColumn("lat", F.coalesce(F.col("o_lat"), F.when(has_xy, p["lat"]))).drop("o_lon", "o_lat")


def _served_stations(station: DataFrame, stop: DataFrame) -> DataFrame:
    served = stop.select(F.col("station").alias("shortname")).distinct()
    return station_points(station).join(served, on="shortname", how="left_semi").filter(F.col("trainchanges") != 2)


# --------------------------------------------------------------------------
# N-28, K-1, K-2 clean-ups
# --------------------------------------------------------------------------

def reassign_company(service: DataFrame, transport: DataFrame, rules=REASSIGN_960, from_company: int = 960) -> DataFrame:
    """International trains of company 960 go to the operator of their mode (N-28);
    of several modes the first rule decides."""
    spark = service.sparkSession
    r = F.broadcast(spark.createDataFrame([(*x, k) for k, x in enumerate(rules)], "transmode string, new_company int, rule int"))
    hit = transport.join(r, on="transmode").groupBy("serviceid").agg(F.min_by("new_company", "rule").alias("new_company"))
    return service.join(_large(hit), on="serviceid", how="left").withColumn(
        "companynumber",
        F.when((F.col("companynumber") == from_company) & F.col("new_company").isNotNull(), F.col("new_company"))
        .otherwise(F.col("companynumber"))).drop("new_company")


def with_numbers(service: DataFrame) -> DataFrame:
    """K-1: a service without number takes its variant as number, one without either 0 (so
    does one whose variant is no number): every export names its trips by this number."""
    return service.withColumn("servicenumber", F.coalesce("servicenumber", _tc("variant"), F.lit(0)))


def open_single_transport(transport: DataFrame) -> DataFrame:
    """K-2: a service with a single transport mode gets laststop 999 (whole service)."""
    n = F.count("serviceid").over(Window.partitionBy("serviceid"))  # 0 for rows without a service: each is open
    return transport.withColumn("laststop", F.when(n > 1, F.col("laststop")).otherwise(F.lit(999)))


def prepare(tables: Mapping[str, DataFrame], version: int = 1) -> MutableMapping[str, DataFrame]:
    """The tables as all exports of one rail feed read them, changed once for all of them: numbers
    (K-1) and single modes (K-2); in v3 also the Eurostar company, reassigned international
    trains (N-28) and the mode name fixed.  Every export below takes prepared tables."""
    out: dict[str, Callable[[], DataFrame]] = {name: (lambda n=name: tables[n]) for name in tables}

    def company() -> DataFrame:
        known = [F.col(c) for c in ("company", "code", "name")]
        # literals, whose size the planner knows: else no export could broadcast the companies
        extra = tables["company"].sparkSession.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("company"), F.lit(code).alias("code"), F.lit(name).alias("name")) for c, code, name in EXTRA_COMPANIES])))
        return tables["company"].select(*known).unionByName(extra.join(tables["company"].select("company"), "company", "left_anti").select(*known))

    def service() -> DataFrame:
        return with_numbers(reassign_company(tables["service"], tables["transport"]) if version == 3 else tables["service"])

    if version == 3:
        out["company"] = company
        out["trnsmode"] = lambda: tables["trnsmode"].replace(dict(MODE_NAME_FIXES), subset=["description"])
    out["service"] = service
    out["transport"] = lambda: open_single_transport(tables["transport"])
    return Tables(out)


# --------------------------------------------------------------------------
# N-24 calendar_dates, N-14 agency
# --------------------------------------------------------------------------

def gtfs_agency_iff(company: DataFrame, service: DataFrame, urls: DataFrame | None = None, version: int = 1) -> DataFrame:
    """agency.txt: companies that run a service, with their URL (N-14); v3 names them by code."""
    urls = M.company_urls(company.sparkSession, version) if urls is None else urls
    used = service.select(F.col("companynumber").alias("company")).distinct()
    c = company.join(used, on="company", how="left_semi").join(urls, on="company", how="left")
    agency_id = F.upper(F.col("code")) if version == 3 else F.col("company")
    return c.select(agency_id.alias("agency_id"), F.col("name").alias("agency_name"), "agency_url",
                    F.lit(M.AGENCY_TIMEZONE).alias("agency_timezone"), F.lit(M.AGENCY_LANG).alias("agency_lang"))


# --------------------------------------------------------------------------
# N-25 stops
# --------------------------------------------------------------------------

def gtfs_stops_iff(station: DataFrame, stop: DataFrame, platform: DataFrame, positioned: DataFrame | None = None,
                   version: int = 1) -> DataFrame:
    """stops.txt (N-25): stations, their platforms and platform 0; stations
    that allow no transfer (trainchanges 2) are left out; rows of the
    positioned-stop file win.  ``version=3`` also emits arrival platforms,
    fills stop_code and keeps one row per stop_id."""
    st = _served_stations(station, stop)
    lon = F.col("lon").cast("decimal(8,5)")
    lat = F.col("lat").cast("decimal(9,6)")
    stations = st.select(
        F.col("shortname").alias("stop_id"), F.col("shortname").alias("stop_code"), F.col("name").alias("stop_name"),
        lon.alias("stop_lon"), lat.alias("stop_lat"),
        F.when(F.col("timezone") == 1, F.lit("Europe/London")).otherwise(F.lit("Europe/Amsterdam")).alias("stop_timezone"),
        F.lit(1).alias("location_type"), null_of("string").alias("parent_station"), null_of("string").alias("platform_code"))
    plats = platform.select(F.col("station").alias("shortname"), "arrival", "departure").distinct() \
        .join(st, on="shortname")

    def platform_rows(col: str) -> DataFrame:
        p = F.col(col)
        return plats.select(
            F.concat(F.col("shortname"), F.lit("|"), F.coalesce(p, F.lit("0"))).alias("stop_id"),
            (F.col("shortname") if version == 3 else null_of("string")).alias("stop_code"),
            F.when(p.isNotNull(), F.concat(F.col("name"), F.lit(" spoor "), p)).otherwise(F.col("name")).alias("stop_name"),
            F.coalesce(lon, F.lit(0).cast("decimal(8,5)")).alias("stop_lon"),
            F.coalesce(lat, F.lit(0).cast("decimal(9,6)")).alias("stop_lat"),
            null_of("string").alias("stop_timezone"), F.lit(0).alias("location_type"),
            F.col("shortname").alias("parent_station"), F.col("departure").alias("platform_code"))

    zero = st.select(
        F.concat(F.col("shortname"), F.lit("|0")).alias("stop_id"),
        (F.col("shortname") if version == 3 else null_of("string")).alias("stop_code"),
        F.col("name").alias("stop_name"),
        F.coalesce(lon, F.lit(0).cast("decimal(8,5)")).alias("stop_lon"),
        F.coalesce(lat, F.lit(0).cast("decimal(9,6)")).alias("stop_lat"),
        null_of("string").alias("stop_timezone"), F.lit(0).alias("location_type"),
        F.col("shortname").alias("parent_station"), null_of("string").alias("platform_code"))
    parts = [stations, platform_rows("departure"), zero]
    if version == 3:
        parts.insert(1, platform_rows("arrival"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if positioned is not None:
        out = out.join(positioned.select("stop_id"), on="stop_id", how="left_anti").unionByName(
            positioned.select(*out.columns))
    out = out.distinct()
    if version == 3:
        cols = [c for c in out.columns if c != "stop_id"]
        out = first_per_key(out, ["stop_id"], [nulls_last("stop_name"), nulls_last("platform_code"),
                                               nulls_last("location_type")], cols)
    return out


# --------------------------------------------------------------------------
# N-26 / N-27 routes
# --------------------------------------------------------------------------

def route_type_v1(mode: Column) -> Column:
    return (F.when(mode.isin(*BUS_LIKE_MODES), F.lit(3)).when(mode == "NSM", F.lit(1))
            .when(mode == "NST", F.lit(0)).otherwise(F.lit(2)))


def gtfs_routes_iff_v1(transport: DataFrame, trnsmode: DataFrame, service: DataFrame) -> DataFrame:
    """routes.txt v1 (N-26): one route per company x mode."""
    j = transport.select("serviceid", "transmode").join(
        trnsmode.select(F.col("code").alias("transmode"), "description"), on="transmode") \
        .join(_large(service.select("serviceid", "companynumber")), on="serviceid")
    r = j.select("transmode", "companynumber", "description").distinct()
    return r.select(
        F.concat(as_text("companynumber"), F.lit("-"), F.col("transmode")).alias("route_id"),
        F.col("companynumber").alias("agency_id"), null_of("string").alias("route_short_name"),
        F.col("description").alias("route_long_name"), route_type_v1(F.col("transmode")).alias("route_type"))


def _stations_of(stop: DataFrame) -> DataFrame:
    """Per service its first and last station, and all of them by index (as many as one train calls at)."""
    e = stop.groupBy("serviceid").agg(F.min(F.struct("idx", "station")).alias("b"), F.max(F.struct("idx", "station")).alias("d"),
                                      F.collect_list(F.struct("idx", "station")).alias("calls"))
    return e.select("serviceid", F.col("b.station").alias("begin_station"), F.col("d.station").alias("dest_station"), "calls")


def _station_at(idx: str) -> Column:
    return F.get(F.filter("calls", lambda c: c["idx"] == F.col(idx)), F.lit(0))["station"]


def _covers() -> Column:
    """A transport row (t_first, t_last) that holds for a service part."""
    return (F.col("t_first") == F.col("firststop")) | (F.col("t_last") == 999)


def gtfs_routes_iff_v3(transport: DataFrame, trnsmode: DataFrame, service: DataFrame, company: DataFrame,
                       stop: DataFrame, station: DataFrame) -> DataFrame:
    """routes.txt v3 (N-27): trains per company x mode x block of 100
    numbers; bus-like modes per unordered pair of the end stations of a service part, as the
    trips name them."""
    j = (transport.select("serviceid", "transmode", F.col("firststop").alias("t_first"), F.col("laststop").alias("t_last"))
         .join(trnsmode.select(F.col("code").alias("transmode"), "description"), on="transmode")
         .join(_large(service.select("serviceid", "companynumber", "servicenumber", "servicename", "firststop", "laststop")), on="serviceid")
         .join(company.select(F.col("company").alias("companynumber"), "code"), on="companynumber")
         .join(_large(_stations_of(stop)), on="serviceid"))
    names = station.select("shortname", "name")

    def named(rows: DataFrame) -> DataFrame:
        return rows.join(names.toDF("begin_station", "begin_name"), on="begin_station").join(names.toDF("dest_station", "dest_name"), on="dest_station")

    block = (F.floor(F.col("servicenumber") / 100) * 100).cast("long")
    mode = F.col("transmode")
    rt = F.when(mode == "NSM", F.lit(1)).when(mode == "NST", F.lit(0))
    for modes, code in V3_ROUTE_TYPES:
        rt = rt.when(mode.isin(*modes), F.lit(code))
    ends = F.concat(F.col("begin_name"), F.lit(" <-> "), F.col("dest_name"))
    trains = named(j.filter(~mode.isin(*BUS_LIKE_MODES_V3))).select(
        "transmode", "companynumber", block.alias("block"), "servicenumber", "laststop",
        F.concat(as_text("companynumber"), F.lit("-"), mode, F.lit("-"), as_text(block)).alias("route_id"),
        F.upper("code").alias("agency_id"), F.col("description").alias("route_short_name"),
        F.when(F.col("servicename").isNotNull(), F.concat(F.col("servicename"), F.lit(" "), ends))
        .otherwise(F.concat(ends, F.lit(" "), mode, as_text(block))).alias("route_long_name"),
        rt.otherwise(F.lit(2)).alias("route_type"))
    # per (mode, company, block): odd numbers first, then the longest service
    # (largest laststop), then the smallest number as the final tiebreak
    out_cols = ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"]
    trains = first_per_key(trains, ["transmode", "companynumber", "block"],
                           [(F.col("servicenumber") % 2 == 0), -F.col("laststop"), F.col("servicenumber"),
                            F.col("route_long_name")], out_cols)
    lo, hi = F.least("begin_station", "dest_station"), F.greatest("begin_station", "dest_station")
    parts = j.filter(mode.isin(*BUS_LIKE_MODES_V3) & _covers()) \
        .withColumn("begin_station", _station_at("firststop")).withColumn("dest_station", _station_at("laststop"))
    buses = named(parts).select(
        "transmode", "companynumber", lo.alias("lo"), hi.alias("hi"),
        F.concat(as_text("companynumber"), F.lit("-"), mode, F.lit("-"), lo, F.lit("-"), hi).alias("route_id"),
        F.upper("code").alias("agency_id"), F.col("description").alias("route_short_name"),
        ends.alias("route_long_name"), F.lit(3).alias("route_type"))
    buses = first_per_key(buses, ["transmode", "companynumber", "lo", "hi"], [F.col("route_long_name")], out_cols)
    return trains.select(*out_cols).unionByName(buses.select(*out_cols)).distinct()


# --------------------------------------------------------------------------
# N-29 trips
# --------------------------------------------------------------------------

def _service_trips(service: DataFrame, validity: DataFrame, transport: DataFrame) -> DataFrame:
    """service part x validity x transport, with the range rules of the trips export."""
    s = service.alias("s")
    v = validity.select("serviceid", "footnote", F.col("firststop").alias("v_first"), F.col("laststop").alias("v_last"))
    t = transport.select("serviceid", "transmode", F.col("firststop").alias("t_first"), F.col("laststop").alias("t_last"))
    j = s.join(_large(v), on="serviceid").filter(
        ((F.col("v_last") == F.col("laststop")) & (F.col("v_first") == F.col("firststop"))) | (F.col("v_last") == 999))
    return j.join(_large(t), on="serviceid").filter(_covers())


def gtfs_trips_iff(service: DataFrame, validity: DataFrame, transport: DataFrame, attribute: DataFrame,
                   stop: DataFrame, station: DataFrame, version: int = 1) -> DataFrame:
    """trips.txt (N-29): one trip per service part, footnote and mode.

    Headsign = station at the part's last stop.  v1: direction from the
    number's parity, bikes unless HSN/HSI or attribute NIIN/GEFI.  v3:
    bus-like modes get the end-station route and direction from the end
    stations' order; the short name is the variant where it differs.
    """
    j = _service_trips(service, validity, transport)
    if version == 1:
        j = j.filter(F.col("footnote").isNotNull())
    names = station.select(F.col("shortname").alias("n_station"), F.col("name").alias("trip_headsign")).filter(F.col("n_station").isNotNull())
    last_stop = stop.select("serviceid", F.col("idx").alias("l_idx"), F.col("station").alias("dest_station"))
    j = j.join(_large(last_stop), on="serviceid").filter(_same("l_idx", "laststop"))
    num = F.col("servicenumber")
    bikes = attribute.filter(F.col("code").isin(*BIKE_ATTRIBUTES[version])).select("serviceid").distinct() \
        .withColumn("bike_attr", F.lit(True))
    j = j.join(_large(bikes), on="serviceid", how="left")
    if version == 3:
        first_stop = stop.select("serviceid", F.col("idx").alias("f_idx"), F.col("station").alias("begin_station"))
        j = j.join(_large(first_stop), on="serviceid").filter(_same("f_idx", "firststop"))
    # null-safe, although no name has a NULL: else stops without station were left out for the last stop only, and shuffled twice
    j = j.join(names, F.col("dest_station").eqNullSafe(F.col("n_station")))
    bikes_allowed = F.when(F.col("transmode").isin(*BIKE_MODES[version]), F.lit(1)).when(
        F.col("bike_attr").isNotNull(), F.lit(1)).otherwise(F.lit(2))
    trip_id = F.concat(as_text("serviceid"), F.lit("|"), as_text("footnote"), F.lit("|"), as_text(num))
    if version == 1:
        return j.select(
            F.concat(as_text("companynumber"), F.lit("-"), F.col("transmode")).alias("route_id"),
            F.concat(F.lit("NS:"), as_text("footnote")).alias("service_id"),
            trip_id.alias("trip_id"), F.col("trip_headsign"),
            (num % 2).alias("direction_id"), num.alias("trip_short_name"),
            F.col("serviceid").alias("block_id"), bikes_allowed.alias("trip_bikes_allowed"))
    bus = F.col("transmode").isin(*BUS_LIKE_MODES_V3)
    lo, hi = F.least("begin_station", "dest_station"), F.greatest("begin_station", "dest_station")
    block = (F.floor(num / 100) * 100).cast("long")
    route = F.when(bus, F.concat(as_text("companynumber"), F.lit("-"), F.col("transmode"), F.lit("-"), lo, F.lit("-"), hi)) \
        .otherwise(F.concat(as_text("companynumber"), F.lit("-"), F.col("transmode"), F.lit("-"), as_text(block)))
    variant_num = _tc(F.col("variant"))
    return j.select(
        route.alias("route_id"), F.concat(F.lit("NS:"), as_text("footnote")).alias("service_id"),
        trip_id.alias("trip_id"), F.col("trip_headsign"),
        F.when(bus, (F.col("begin_station") > F.col("dest_station")).cast("int")).otherwise(num % 2).alias("direction_id"),
        F.when(num != variant_num, variant_num).otherwise(num).alias("trip_short_name"),
        F.col("serviceid").alias("block_id"), bikes_allowed.alias("trip_bikes_allowed"))


# --------------------------------------------------------------------------
# N-30 stop_times
# --------------------------------------------------------------------------

def gtfs_stop_times_iff(stop: DataFrame, attribute: DataFrame, service: DataFrame, validity: DataFrame,
                        platform: DataFrame) -> DataFrame:
    """stop_times.txt (N-30): each stop of each service part and footnote.

    Attributes and service parts hold for a range of stop indexes; the stops are
    resequenced per trip; pickup/drop-off from the stop's attributes
    (NIIN: no boarding, NUIT: no alighting, RESV/IRES: reservation); an
    arrival platform that differs from the departure platform becomes
    ``arrival_stop_id``.  Validity is joined by service only (§8-D17).
    """
    first, last = F.col("firststop").cast("int"), F.col("laststop").cast("int")
    attrs = attribute.filter(F.col("code").isin(*STOP_ATTRIBUTES)).groupBy("serviceid") \
        .agg(F.collect_set(F.struct("code", first.alias("first"), last.alias("last"))).alias("attrs"))
    parts = service.select(F.col("serviceid").alias("p_service"), "servicenumber", first.alias("p_first"), last.alias("p_last"))
    plat = platform.select(F.col("serviceid").alias("q_service"), F.col("idx").alias("q_idx"), "arrival", "departure")
    # by service alone, which also feeds the per-trip window
    j = stop.join(_large(attrs), on="serviceid", how="left") \
        .join(_large(parts), (F.col("serviceid") == F.col("p_service")) & F.col("idx").between(F.col("p_first"), F.col("p_last")), how="left") \
        .join(_large(plat), (F.col("serviceid") == F.col("q_service")) & _same("idx", "q_idx"), how="left") \
        .join(_large(validity.select("serviceid", "footnote")), on="serviceid", how="left")
    j = j.withColumn("trip_id", pipe_id("serviceid", "footnote", "servicenumber"))
    w = Window.partitionBy("serviceid", "footnote", "servicenumber").orderBy("idx")
    j = j.withColumn("stop_sequence", F.row_number().over(w))

    def has(code: str) -> Column:
        return F.exists("attrs", lambda a: (a["code"] == code) & F.col("idx").between(a["first"], a["last"]))

    dep = F.coalesce("dep_s", "arr_s")
    return j.select(
        "trip_id",
        format_clock(F.when(F.col("stop_sequence") == 1, dep).otherwise(F.col("arr_s"))).alias("arrival_time"),
        format_clock(dep).alias("departure_time"),
        F.concat(F.col("station"), F.lit("|"), F.coalesce(F.col("departure"), F.lit("0"))).alias("stop_id"),
        F.when(F.col("arrival") != F.col("departure"), F.concat(F.col("station"), F.lit("|"), F.col("arrival")))
        .alias("arrival_stop_id"),
        F.col("stop_sequence"),
        F.when(has("NIIN"), F.lit(1)).when(has("RESV") | has("IRES"), F.lit(2)).otherwise(F.lit(0)).alias("pickup_type"),
        F.when(has("NUIT"), F.lit(1)).when(has("IRES") | has("RESV"), F.lit(2)).otherwise(F.lit(0)).alias("drop_off_type"),
    )


# --------------------------------------------------------------------------
# N-31 platform transfers, N-32 / N-33 connections
# --------------------------------------------------------------------------

def platform_transfers(station: DataFrame, platform: DataFrame, version: int = 1) -> DataFrame:
    """Transfers between the platforms of one station (N-31).

    Pairs are formed over the *distinct* platform names of a station (both
    sides reduced before the join), so the output is bounded by the
    physical platforms, not by the number of timetable rows.  v1: from the
    arrival platform, min time = layover; v3: from the departure platform,
    layover - 20 s.
    """
    dep_platforms = platform.select("station", "departure").filter(F.col("departure").isNotNull()).distinct()
    p = platform.select("station", "departure", "arrival").distinct()
    src_col = "arrival" if version == 1 else "departure"
    src = p.select("station", F.col(src_col).alias("from_platform"), F.col("arrival").alias("from_arrival")) \
        .join(dep_platforms.withColumnRenamed("departure", "from_platform"), on=["station", "from_platform"],
              how="left_semi").select("station", "from_platform", "from_arrival").distinct()
    dst = p.select("station", F.col("departure").alias("to_platform")) \
        .join(dep_platforms.withColumnRenamed("departure", "to_platform"), on=["station", "to_platform"],
              how="left_semi").distinct()
    pairs = src.join(dst, on="station").filter(F.col("from_arrival") != F.col("to_platform"))
    lay = station.select(F.col("shortname").alias("station"), "layovertime")
    pairs = pairs.join(lay, on="station").select(
        F.concat(F.col("station"), F.lit("|"), F.col("from_platform")).alias("from_stop_id"),
        F.concat(F.col("station"), F.lit("|"), F.col("to_platform")).alias("to_stop_id"),
        F.lit(2).alias("transfer_type"),
        (F.col("layovertime") - (0 if version == 1 else 20)).alias("min_transfer_time")).distinct()
    return pairs


def _calls(changes, platform, stop, station, service, validity, attribute, trips: bool, store=None) -> DataFrame:
    """(serviceid, station, call): where the trains of change records call at a named platform of a known station, per
    service part and (``trips``) footnote, with the trip's id; services with attribute NIIN are left out.

    The records come first: what they do not name is left out before it meets stops, parts and footnotes."""
    niin = attribute.filter(F.col("code") == "NIIN").select("serviceid").distinct()
    known = station.select(F.col("shortname").alias("n_station")).distinct()
    named = changes.select(F.explode(F.array("fromservice", "toservice")).alias("n_service"), F.col("station").alias("n_station")) \
        .join(known, on="n_station", how="left_semi")
    part = service.select("serviceid", F.col("firststop").alias("p_first"), F.col("laststop").alias("p_last"), "servicenumber")
    if trips:
        part = part.join(_large(validity.select("serviceid", "footnote")), on="serviceid")
    else:
        part = part.drop("servicenumber").join(_large(validity.select("serviceid")), on="serviceid", how="left_semi")
    at = stop.select("serviceid", F.col("station").alias("s_station"), F.col("idx").alias("s_idx"), "arr_s", "dep_s")
    visits = platform.select("serviceid", "station", "idx", "arrival", "departure") \
        .join(_large(named), (F.col("serviceid") == F.col("n_service")) & _same("station", "n_station"), how="left_semi") \
        .join(_large(niin), on="serviceid", how="left_anti")
    j = (visits if store is None else store(visits)).join(_large(at), on="serviceid").filter(_same("idx", "s_idx") & _same("station", "s_station")) \
        .join(_large(part), on="serviceid").filter(F.col("idx").between(F.col("p_first"), F.col("p_last")))
    call = ["arrival", "departure", "arr_s", "dep_s"]
    if trips:
        call.append(pipe_id("serviceid", "footnote", "servicenumber").alias("trip_id"))
    return j.select("serviceid", "station", F.struct(*call).alias("call"))


def _connection_rows(changes, platform, stop, station, service, validity, attribute, kinds, later: str, store=None) -> DataFrame:
    """The change records with the calls of both services (D-17), columns a and d, where the platforms differ and d
    leaves after ``later`` of a.  Both sides make their calls, as one struct, of the same tables, which Spark shuffles
    once; ``exists`` reads the structs whole, else each side would be cut to the fields of its own.  ``store`` writes
    what is named, then the calls, and reads it back: the shuffles that make it need not be kept until both sides have met."""
    c = changes.filter(F.col("possiblechange").isin(*kinds)) if kinds else changes
    c = c.filter(F.col("fromservice") != F.col("toservice"))
    calls = _calls(c, platform, stop, station, service, validity, attribute, not kinds, store)
    if store is not None:
        calls = store(calls)
    both = c.join(_large(calls.toDF("fromservice", "a_station", "a")), on="fromservice").filter(_same("station", "a_station")) \
        .join(_large(calls.toDF("toservice", "d_station", "d")), on="toservice").filter(_same("station", "d_station"))
    return both.filter(F.exists(F.array(F.struct("a", "d")), lambda m: (m["a"]["arrival"] != m["d"]["departure"]) & (m["d"]["dep_s"] > m["a"][later])))


def _stop_at(call: str) -> Column:
    return F.concat(F.col("station"), F.lit("|"), F.col(f"{call}.departure"))


def connections_v1(changes, platform, stop, station, service, validity, attribute) -> DataFrame:
    """Timed transfers from the change records (N-32): kinds 1 and 2, time =
    departure - arrival - 30 s, the smallest per stop pair.  Times compare as
    seconds (§8-D21)."""
    j = _connection_rows(changes, platform, stop, station, service, validity, attribute, (1, 2), "dep_s")
    rows = j.select(_stop_at("a").alias("from_stop_id"), _stop_at("d").alias("to_stop_id"), F.lit(2).alias("transfer_type"),
                    (F.col("d.dep_s") - F.col("a.arr_s") - 30).alias("min_transfer_time"))
    return first_per_key(rows, ["from_stop_id", "to_stop_id"], [nulls_last("min_transfer_time")],
                         ["transfer_type", "min_transfer_time"])


def connections_v3(changes, platform, stop, station, service, validity, attribute) -> DataFrame:
    """Trip-to-trip transfers (N-33): change kind 0/1/2 -> type 3/0/1, else 99."""
    return _connections_v3(changes, platform, stop, station, service, validity, attribute).distinct()


def _connections_v3(changes, platform, stop, station, service, validity, attribute, store=None) -> DataFrame:
    """With repeats, for a caller that makes more rows distinct."""
    j = _connection_rows(changes, platform, stop, station, service, validity, attribute, None, "arr_s", store)
    kind = F.col("possiblechange")
    return j.select(
        _stop_at("a").alias("from_stop_id"), _stop_at("d").alias("to_stop_id"),
        F.col("a.trip_id").alias("from_trip_id"), F.col("d.trip_id").alias("to_trip_id"),
        F.when(kind == 0, F.lit(3)).when(kind == 1, F.lit(0)).when(kind == 2, F.lit(1)).otherwise(F.lit(99))
        .alias("transfer_type"),
        null_of("int").alias("min_transfer_time"))


def gtfs_transfers_iff_v1(changes, platform, stop, station, service, validity, attribute) -> DataFrame:
    """transfers.txt v1: platform transfers and timed connections, the
    smallest time per stop pair."""
    both = platform_transfers(station, platform, 1).unionByName(
        connections_v1(changes, platform, stop, station, service, validity, attribute))
    return first_per_key(both, ["from_stop_id", "to_stop_id"], [nulls_last("min_transfer_time")],
                         ["transfer_type", "min_transfer_time"])


def exports(tables: dict[str, DataFrame], version: int = 1, store: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """routes, trips, stop_times and transfers of one rail feed, all from the same prepared tables.  ``store`` writes
    a table and reads it back: the calls that both sides of v3 connections read are then made beforehand."""
    t = prepare(tables, version)
    args = (t["changes"], t["platform"], t["stop"], t["station"], t["service"], t["validity"], t["attribute"])
    out = {
        "trips": gtfs_trips_iff(t["service"], t["validity"], t["transport"], t["attribute"], t["stop"], t["station"], version=version),
        "stop_times": gtfs_stop_times_iff(t["stop"], t["attribute"], t["service"], t["validity"], t["platform"]),
    }
    if version == 3:
        out["routes"] = gtfs_routes_iff_v3(t["transport"], t["trnsmode"], t["service"], t["company"], t["stop"], t["station"])
        walks = platform_transfers(t["station"], t["platform"], 3).select(
            "from_stop_id", "to_stop_id", null_of("string").alias("from_trip_id"), null_of("string").alias("to_trip_id"), "transfer_type", "min_transfer_time")
        out["transfers"] = walks.unionByName(_connections_v3(*args, store)).distinct()
    else:
        out["routes"] = gtfs_routes_iff_v1(t["transport"], t["trnsmode"], t["service"])
        out["transfers"] = gtfs_transfers_iff_v1(*args)
    return out
