"""Parser round trips: tagged text built from the driver-derived tables is
parsed back by the same code that reads IFF / PAS files (A-8, A-9, A-10).

The text is built per service in Spark (one section record per service, as
the ``\\r\\n#`` record split of a file yields), so the parse runs on data
that grows with the scale factor.  The oracle is the source rows with clock
times truncated to the file format's minutes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from ..sources import archives
from ..sources import iff as IFF
from ..sources import kv1 as KV1
from ..sources import pas as PAS
from .fixtures import ADAPTERS, Fixtures, dependency_order, duckdb_with
from .sqltext import clock


def _hhmm(s: Column) -> Column:
    return F.concat(F.lpad(F.floor(s / 3600).cast("string"), 2, "0"),
                    F.lpad(F.floor((s % 3600) / 60).cast("string"), 2, "0"))


def _okey(kind: int, pos: Column | None = None) -> Column:
    """Sort key of a line inside its block: record kind, then position."""
    k = F.lit(kind).cast("long") * (1 << 40)
    return k if pos is None else k + pos.cast("long")


def _blocks(lines: DataFrame, key: str) -> DataFrame:
    """(key, order key, line) -> one record per key: the lines in order."""
    return lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("o", "line"))).alias("ls")).select(
        F.col(key), F.transform("ls", lambda x: x["line"]).alias("body"))


def _padded(c: str, width: int, zeros: bool = True) -> Column:
    """A field of fixed width; blank where there is no value."""
    text = F.col(c).cast("string")
    return F.coalesce(F.lpad(text, width, "0") if zeros else F.rpad(text, width, " "), F.lit(" " * width))


def _line(tag: str, *parts: Column) -> Column:
    return F.concat(F.lit(tag), F.concat_ws(",", *parts))


def iff_text_sections(fx: Fixtures) -> DataFrame:
    """Service blocks of an IFF timetable file, as (head, body) records, stored once."""
    if not fx.materialize:
        return _iff_text_sections(fx)
    return fx.stored("iff_text", lambda: _iff_text_sections(fx), "".join(ADAPTERS[n] for n in dependency_order(["iff_services", "iff_validity", "iff_transport", "iff_attributes"])))


def _iff_text_sections(fx: Fixtures) -> DataFrame:
    span = [_padded("firststop", 3), _padded("laststop", 3)]
    svc = fx.iff_services.select("serviceid", _okey(0).alias("o"), _line("%", F.col("companynumber").cast("string"), _padded("servicenumber", 5), _padded("variant", 6, False),
                                                                         *span, _padded("servicename", 30, False)).alias("line"))
    val = fx.iff_validity.select("serviceid", _okey(1).alias("o"), _line("-", _padded("footnote", 5), *span).alias("line"))
    tr = fx.iff_transport.select("serviceid", _okey(2).alias("o"), _line("&", _padded("transmode", 4, False), *span).alias("line"))
    at = fx.iff_attributes.select("serviceid", _okey(3).alias("o"), _line("*", _padded("code", 4, False), *span, F.lit("00000")).alias("line"))
    st = fx.iff_stops
    arr, dep = F.col("arr_s"), F.col("dep_s")
    stn = F.rpad("station", 7, " ")
    stop_line = (F.when(arr.isNull() & dep.isNull(), F.concat(F.lit(";"), stn))
                 .when(arr.isNull(), F.concat(F.lit(">"), stn, F.lit(","), _hhmm(dep)))
                 .when(dep.isNull(), F.concat(F.lit("<"), stn, F.lit(","), _hhmm(arr)))
                 .when(_hhmm(arr) == _hhmm(dep), F.concat(F.lit("."), stn, F.lit(","), _hhmm(arr)))
                 .otherwise(F.concat(F.lit("+"), stn, F.lit(","), _hhmm(arr), F.lit(","), _hhmm(dep))))
    stops = st.select("serviceid", _okey(4, F.col("idx") * 2).alias("o"), stop_line.alias("line"))
    plats = st.filter(F.col("departure").isNotNull()).select(
        "serviceid", _okey(4, F.col("idx") * 2 + 1).alias("o"),
        F.concat(F.lit("?"), F.rpad("arrival", 5, " "), F.lit(","), F.rpad("departure", 5, " "),
                 F.lit(",00007")).alias("line"))
    allx = svc
    for d in (val, tr, at, stops, plats):
        allx = allx.unionByName(d)
    b = _blocks(allx, "serviceid")
    return b.select(F.lpad(F.col("serviceid").cast("string"), 8, "0").alias("head"), "body")


def q_iff_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IFF.parse_timetable_sections(iff_text_sections(Fixtures(spark, sf_dir)))["stop"]


SQL_IFF_PARSE = duckdb_with(["iff_stops"], """
select serviceid, cast(idx as integer) as idx, station, (arr_s // 60) * 60 as arr_s, (dep_s // 60) * 60 as dep_s from iff_stops
""")


def _stored_table(kind: str):
    """A table of the timetable after one pass has written all of them."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"iff/records-{uuid.uuid4().hex}")
        return IFF.store_timetable(iff_text_sections(Fixtures(spark, sf_dir)), path)[kind]

    q.__name__ = f"q_iff_parse_{kind}"
    return q


SQL_IFF_PARSE_PLATFORMS = duckdb_with(["iff_stops"], """
select serviceid, cast(idx as integer) as idx, station, arrival, departure, 7 as footnote from iff_stops where departure is not null
""")
SQL_IFF_PARSE_SERVICES = duckdb_with(["iff_services"], "\nselect serviceid, companynumber, servicenumber, variant, firststop, laststop, servicename from iff_services")
SQL_IFF_PARSE_VALIDITY = duckdb_with(["iff_validity"], "\nselect serviceid, footnote, firststop, laststop from iff_validity")
SQL_IFF_PARSE_TRANSPORT = duckdb_with(["iff_transport"], "\nselect serviceid, transmode, firststop, laststop from iff_transport")
SQL_IFF_PARSE_ATTRIBUTES = duckdb_with(["iff_attributes"], "\nselect serviceid, code, firststop, laststop, 0 as unknown from iff_attributes")


def pas_text_sections(fx: Fixtures) -> DataFrame:
    keys = ["vervoerdercode", "lijnsysteemnr", "richting", "ritnummer", "voetnoot"]
    pp = fx.pas_pujopass
    arr, dep = F.col("arr_s"), F.col("dep_s")
    h = F.col("halteid")
    line = (F.when(arr.isNull(), F.concat(F.lit(">"), h, F.lit(","), F.coalesce(_hhmm(dep), F.lit("")))
                   ).when(dep.isNull(), F.concat(F.lit("<"), h, F.lit(","), _hhmm(arr)))
            .when(_hhmm(arr) == _hhmm(dep), F.concat(F.lit("."), h, F.lit(","), _hhmm(arr)))
            .otherwise(F.concat(F.lit("+"), h, F.lit(","), _hhmm(arr), F.lit(","), _hhmm(dep))))
    stops = pp.select(F.concat_ws("|", *keys).alias("k"),
                                       _okey(2, F.col("stopsequentie")).alias("o"), line.alias("line"))
    j = fx.pas_pujo
    heads = j.select(F.concat_ws("|", *keys).alias("k"), _okey(0).alias("o"),
                     F.concat_ws(",", "modaliteit", "vervoerdercode", "lijnsysteemnr", F.col("richting").cast("string"),
                                 "ritnummer").alias("line"))
    notes = j.select(F.concat_ws("|", *keys).alias("k"), _okey(1).alias("o"),
                     F.concat(F.lit("-"), F.col("voetnoot")).alias("line"))
    allx = heads.unionByName(notes).unionByName(stops)
    return _blocks(allx, "k").select(F.col("body").alias("lines"))


def q_pas_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PAS.parse_journey_sections(pas_text_sections(Fixtures(spark, sf_dir)))["pujopass"]


SQL_PAS_PARSE = duckdb_with(["pas_pujopass"], """
select vervoerdercode, lijnsysteemnr, richting, ritnummer, voetnoot, cast(stopsequentie as integer) + 0 as stopsequentie,
 halteid, (arr_s // 60) * 60 as arr_s, (dep_s // 60) * 60 as dep_s from pas_pujopass
""")


# ---- q_kv1_parse, q_kv1_parse_stops (A-1, A-2, A-3, A-4) -----------------------

def _clock(col: str) -> Column:
    """hh:mm:ss, empty where there is none."""
    s = F.col(col)
    two = [F.lpad(F.floor(x).cast("string"), 2, "0") for x in (s / 3600, s % 3600 / 60, s % 60)]
    return F.coalesce(F.concat(two[0], F.lit(":"), two[1], F.lit(":"), two[2]), F.lit(""))


def _pass_lines(fx: Fixtures) -> DataFrame:
    text = F.concat_ws("|", F.lit("PUJOPASS"), F.col("version").cast("string"), F.lit("I"), "dataownercode", "organizationalunitcode", F.col("schedulecode").cast("string"),
                       "scheduletypecode", F.col("lineplanningnumber").cast("string"), F.col("journeynumber").cast("string"), F.col("stoporder").cast("string"),
                       F.col("journeypatterncode").cast("string"), F.col("userstopcode").cast("string"), _clock("arr_s"), _clock("dep_s"),
                       F.coalesce("wheelchairaccessible", F.lit("")), F.lit(""))
    return fx.passes.select(F.pmod("journeynumber", F.lit(7)).alias("delivery"), F.lit("PUJOPASSX.csv").alias("member"), text.alias("line"))


def _stop_lines(fx: Fixtures) -> DataFrame:
    """Names with separators, quotes and line ends inside quoted fields."""
    name = F.concat(F.lit('"'), F.col("name"), F.lit(' | ""Ænd""\n of '), F.col("dataownercode"), F.lit('"'))
    area = F.coalesce(F.col("userstopareacode").cast("string"), F.lit(""))
    text = F.concat_ws("|", F.lit("USRSTOP"), F.col("version").cast("string"), F.lit("I"), "dataownercode", F.col("userstopcode").cast("string"), F.lit(""),
                       F.col("getin").cast("string"), F.col("getout").cast("string"), F.lit(""), name, F.lit("Town"), area, F.lit("-"), F.lit(""), F.lit(""), F.lit("30"), F.lit(""), F.lit(""), F.lit("PASSENGER"))
    return fx.stops.select(F.pmod("userstopcode", F.lit(7)).alias("delivery"), F.lit("USRSTOPX.csv").alias("member"), text.alias("line"))


def _zipped(batches):
    """One archive per delivery (whose lines follow each other): its members in an archive ``Csv.zip``, each
    after a header line.  No more than one delivery is held."""
    import io
    import zipfile

    import pyarrow as pa

    def archive(delivery: str, members: dict) -> pa.RecordBatch:
        inner, outer = io.BytesIO(), io.BytesIO()
        with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
            for member, lines in members.items():
                z.writestr(f"Csv/{member}", "\r\n".join(lines).encode("utf-8"))
        with zipfile.ZipFile(outer, "w") as z:
            z.writestr("Csv.zip", inner.getvalue())
        return pa.RecordBatch.from_arrays([pa.array([f"delivery{delivery}.zip"]), pa.array([outer.getvalue()], pa.binary())], names=["path", "content"])

    now, members = None, {}
    for batch in batches:
        for delivery, member, line in zip(*(batch.column(c).to_pylist() for c in ("delivery", "member", "line"))):
            if delivery != now and members:
                yield archive(now, members)
                members = {}
            now = delivery
            members.setdefault(member, [f"{member[:-5]}|Version_Number|Implicit"]).append(line)
    if members:
        yield archive(now, members)


def kv1_archives(lines: DataFrame, per_archive: int = 100_000) -> DataFrame:
    """(path, content): deliveries as zip archives, as many as it takes to hold ``per_archive`` lines each."""
    ship_package(lines.sparkSession)
    n = max(1, lines.count() // per_archive)
    keyed = lines.withColumn("delivery", F.concat_ws("-", F.col("delivery").cast("string"), F.pmod(F.xxhash64("line"), F.lit(n)).cast("string")))
    return keyed.repartition("delivery").sortWithinPartitions("delivery", "member").mapInArrow(_zipped, "path string, content binary")


def _parsed(spark: SparkSession, sf_dir: str, lines, table: str) -> DataFrame:
    found = archives.expand(kv1_archives(lines(Fixtures(spark, sf_dir))))
    return KV1.parse_lines(found.filter(F.col("table") == table), table)


def q_kv1_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passing times through zipped deliveries and back."""
    return _parsed(spark, sf_dir, _pass_lines, "pujopass").select(
        "version", "dataownercode", "organizationalunitcode", "schedulecode", "lineplanningnumber", "journeynumber", "stoporder", "userstopcode",
        "targetarrivaltime", "targetdeparturetime", "arr_s", "dep_s", "wheelchairaccessible")


SQL_KV1_PARSE = duckdb_with(["passes"], f"""
select version, dataownercode, organizationalunitcode, cast(schedulecode as varchar) as schedulecode, cast(lineplanningnumber as varchar) as lineplanningnumber, journeynumber, stoporder,
 cast(userstopcode as varchar) as userstopcode, {clock('arr_s')} as targetarrivaltime, {clock('dep_s')} as targetdeparturetime, arr_s, dep_s, wheelchairaccessible
from passes
""")


def q_kv1_parse_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, _stop_lines, "usrstop").select("version", "dataownercode", "userstopcode", "getin", "getout", "name", "userstopareacode", "minimalstoptime", "userstoptype")


SQL_KV1_PARSE_STOPS = duckdb_with(["stops"], """
select version, dataownercode, cast(userstopcode as varchar) as userstopcode, getin, getout, name || ' | "Ænd"' || chr(10) || ' of ' || dataownercode as name,
 cast(userstopareacode as varchar) as userstopareacode, 30 as minimalstoptime, 'PASSENGER' as userstoptype
from stops
""")


QUERIES = {
    "q_iff_parse": (q_iff_parse, SQL_IFF_PARSE),
    "q_iff_parse_platforms": (_stored_table("platform"), SQL_IFF_PARSE_PLATFORMS),
    "q_iff_parse_services": (_stored_table("service"), SQL_IFF_PARSE_SERVICES),
    "q_iff_parse_validity": (_stored_table("validity"), SQL_IFF_PARSE_VALIDITY),
    "q_iff_parse_transport": (_stored_table("transport"), SQL_IFF_PARSE_TRANSPORT),
    "q_iff_parse_attributes": (_stored_table("attribute"), SQL_IFF_PARSE_ATTRIBUTES),
    "q_pas_parse": (q_pas_parse, SQL_PAS_PARSE),
    "q_kv1_parse": (q_kv1_parse, SQL_KV1_PARSE),
    "q_kv1_parse_stops": (q_kv1_parse_stops, SQL_KV1_PARSE_STOPS),
}
