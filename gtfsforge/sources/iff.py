"""IFF rail timetable readers (A-6…A-9, A-7).

Every ``.dat`` file starts with the delivery line ``@company,from,to,
version,description``.  Flat files are one record per line; sectioned files
(``timetbls``, ``timezone``, ``footnote``, ``changes``, ``trnsaqst``) are
read with the record separator ``\\r\\n#`` so that one section (one train
service, one footnote …) is one row.  Per-section context — the running
stop index and the station of the last stop for platform lines — is
computed inside the row with array functions, so parsing needs no shuffle
and no global ordering, and the input stays splittable.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import hhmm_to_seconds, parse_ddmmyyyy
from ..session import scratch_path
from .text import CRLF, SECTION, after_tag, field, fields, int_field, read_records, section_lines

CHARSET = "cp1252"
STOP_TAGS = (">", ".", ";", "+", "<")


def _path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.dat"


def _lines(spark: SparkSession, base: str, name: str, charset: str) -> DataFrame:
    """Data lines of a flat file: delivery line and blank lines dropped."""
    r = read_records(spark, _path(base, name), charset)
    return r.filter((F.length("text") > 0) & ~F.col("text").startswith("@"))


# --------------------------------------------------------------------------
# delivery (A-7)
# --------------------------------------------------------------------------

def parse_delivery_line(text: Column) -> list[Column]:
    p = fields(after_tag(text))
    return [int_field(p, 0).alias("companynumber"), parse_ddmmyyyy(field(p, 1)).alias("firstday"),
            parse_ddmmyyyy(field(p, 2)).alias("lastday"), int_field(p, 3).alias("versionnumber"),
            field(p, 4).alias("description")]


def read_delivery(spark: SparkSession, base: str, charset: str = CHARSET) -> DataFrame:
    r = read_records(spark, _path(base, "delivery"), charset).filter(F.col("text").startswith("@"))
    return r.select(*parse_delivery_line(F.col("text")))


def delivery_line(spark: SparkSession, base: str, charset: str = CHARSET) -> str | None:
    """The delivery line itself (one short record, read as a scalar)."""
    r = read_records(spark, _path(base, "delivery"), charset).filter(F.col("text").startswith("@")).first()
    return None if r is None else r["text"]


def check_delivery(spark: SparkSession, base: str, names: list[str], charset: str = CHARSET) -> DataFrame:
    """Per file: does its first line equal the delivery line? (A-7, §8-D26)."""
    line = delivery_line(spark, base, charset)
    heads = None
    for n in names:
        h = read_records(spark, _path(base, n), charset).filter(F.col("text").startswith("@")) \
            .select(F.lit(n).alias("file"), (F.col("text") == F.lit(line)).alias("matches_delivery"))
        heads = h if heads is None else heads.unionByName(h)
    return heads


# --------------------------------------------------------------------------
# flat files (A-6)
# --------------------------------------------------------------------------

def read_countries(spark, base, charset=CHARSET) -> DataFrame:
    p = fields(F.col("text"))
    return _lines(spark, base, "country", charset).select(
        field(p, 0).alias("code"), (field(p, 1) == "1").alias("inland"), field(p, 2).alias("name"))


def read_companies(spark, base, charset=CHARSET) -> DataFrame:
    p = fields(F.col("text"))
    return _lines(spark, base, "company", charset).select(
        int_field(p, 0).alias("company"), field(p, 1).alias("code"), field(p, 2).alias("name"),
        hhmm_to_seconds(field(p, 3)).alias("timeturn_s"))


def read_transport_modes(spark, base, charset=CHARSET) -> DataFrame:
    p = fields(F.col("text"))
    return _lines(spark, base, "trnsmode", charset).select(field(p, 0).alias("code"), field(p, 1).alias("description"))


def read_transport_attributes(spark, base, charset=CHARSET) -> DataFrame:
    p = fields(F.col("text"))
    return _lines(spark, base, "trnsattr", charset).select(
        field(p, 0).alias("code"), int_field(p, 1).alias("processingcode"), field(p, 2).alias("description"))


def read_connection_modes(spark, base, charset=CHARSET) -> DataFrame:
    p = fields(F.col("text"))
    return _lines(spark, base, "connmode", charset).select(
        field(p, 0).alias("code"), int_field(p, 1).alias("connectiontype"), field(p, 2).alias("description"))


def read_continuous_connections(spark, base, charset=CHARSET) -> DataFrame:
    p = fields(F.col("text"))
    return _lines(spark, base, "contconn", charset).select(
        field(p, 0).alias("fromstation"), field(p, 1).alias("tostation"),
        (int_field(p, 2) * 60).alias("connectiontime"), field(p, 3).alias("connectionmode"))


def read_stations(spark, base, charset=CHARSET) -> DataFrame:
    """Stations: transfer minutes -> seconds, RD hectometre-ish units x10 -> metres."""
    p = fields(F.col("text"))
    return _lines(spark, base, "stations", charset).select(
        field(p, 1).alias("shortname"), int_field(p, 0).alias("trainchanges"),
        (int_field(p, 2) * 60).alias("layovertime"), field(p, 4).alias("country"),
        int_field(p, 5).alias("timezone"), (int_field(p, 7) * 10).alias("x"), (int_field(p, 8) * 10).alias("y"),
        field(p, 9).alias("name"))


# --------------------------------------------------------------------------
# sectioned files (A-8)
# --------------------------------------------------------------------------

def _sections(spark, base, name, charset) -> DataFrame:
    """Sections of a file whose first record also holds the delivery line."""
    r = read_records(spark, _path(base, name), charset, sep=SECTION)
    lines = F.filter(section_lines(F.col("text")), lambda x: ~x.startswith("@"))
    lines = F.transform(lines, lambda x: F.regexp_replace(x, "^#", ""))
    return r.select(lines.alias("lines")).filter(F.size("lines") > 0).select(
        F.element_at("lines", 1).alias("head"), F.slice("lines", 2, F.size("lines")).alias("body"))


def read_timezones(spark, base, charset=CHARSET) -> DataFrame:
    s = _sections(spark, base, "timezone", charset)
    e = s.select(F.trim("head").try_cast("int").alias("tznumber"), F.explode("body").alias("l"))
    p = fields(after_tag(F.col("l")))
    sign = F.when(F.col("l").startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    return e.select("tznumber", (sign * int_field(p, 0)).alias("difference"),
                    parse_ddmmyyyy(field(p, 1)).alias("firstday"), parse_ddmmyyyy(field(p, 2)).alias("lastday"))


def read_attribute_questions(spark, base, charset=CHARSET) -> DataFrame:
    s = _sections(spark, base, "trnsaqst", charset)
    h = fields(F.col("head"))
    e = s.select(field(h, 0).alias("code"), (field(h, 1) == "1").alias("inclusive"), field(h, 2).alias("question"),
                 F.explode(F.filter("body", lambda x: x.startswith("-"))).alias("l"))
    return e.select("code", "inclusive", "question", F.trim(after_tag(F.col("l"))).alias("transattr"))


def read_footnote_bitmaps(spark, base, charset=CHARSET) -> DataFrame:
    s = _sections(spark, base, "footnote", charset)
    return s.select(F.trim("head").try_cast("int").alias("footnote"), F.trim(F.element_at("body", 1)).alias("bits"))


def read_changes(spark, base, charset=CHARSET) -> DataFrame:
    """Change records per station, one list per station (§8-D3)."""
    s = _sections(spark, base, "changes", charset)
    e = s.select(F.trim("head").alias("station"), F.explode("body").alias("l"))
    p = fields(after_tag(F.col("l")))
    return e.select("station", int_field(p, 0).alias("fromservice"), int_field(p, 1).alias("toservice"),
                    int_field(p, 2).alias("possiblechange"))


# --------------------------------------------------------------------------
# timetable (A-9)
# --------------------------------------------------------------------------

#: Record tag -> table of a service block.
TAGS = {"%": "service", "-": "validity", "&": "transport", "*": "attribute", "?": "platform", **dict.fromkeys(STOP_TAGS, "stop")}
RECORD_SCHEMA = "serviceid int, idx int, stop_station string, tag string, p array<string>"


def timetable_records(sections: DataFrame) -> DataFrame:
    """(kind, serviceid, idx, stop_station, tag, p): the lines of service blocks (``head`` = service id,
    ``body`` = lines), with their fields ``p`` and the table ``kind`` that they belong to.

    The stop index of a line is the number of stop records up to it; a
    platform line (``?``) belongs to the most recent stop.

    A block is cut before each stop line, so the n-th cut is the n-th stop with
    the lines that follow it (cut 0: the lines before the first stop); every
    character of the block is looked at once.
    """
    cuts = F.split(F.concat(F.lit(CRLF), F.array_join("body", CRLF)), CRLF + "(?=[" + "".join(STOP_TAGS) + "])")
    e = sections.select(F.trim("head").try_cast("int").alias("serviceid"), F.posexplode(cuts).alias("idx", "cut"))
    station = F.trim(F.get(F.split(after_tag(F.get(F.split("cut", CRLF), F.lit(0))), ","), 0))
    e = e.select("serviceid", "idx", F.when(F.col("idx") > 0, station).alias("stop_station"), F.explode(F.split("cut", CRLF)).alias("line")) \
        .filter(F.length("line") > 0)
    kinds = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])
    tag = F.substring("line", 1, 1)
    return e.select(kinds[tag].alias("kind"), "serviceid", "idx", "stop_station", tag.alias("tag"), fields(after_tag(F.col("line"))).alias("p")) \
        .filter("kind is not null")


def timetable_table(records: DataFrame, kind: str) -> DataFrame:
    """One of the six timetable tables from its records.  A passing record (``;``) is a stop
    without times (§8-D2).  Zeros stay zeros (§8-D1)."""
    P, t = F.col("p"), F.col("tag")
    first_last = [int_field(P, 1).alias("firststop"), int_field(P, 2).alias("laststop")]
    columns = {
        "service": ["serviceid", int_field(P, 0).alias("companynumber"), int_field(P, 1).alias("servicenumber"), field(P, 2).alias("variant"),
                    int_field(P, 3).alias("firststop"), int_field(P, 4).alias("laststop"), field(P, 5).alias("servicename")],
        "validity": ["serviceid", int_field(P, 0).alias("footnote"), *first_last],
        "transport": ["serviceid", field(P, 0).alias("transmode"), *first_last],
        "attribute": ["serviceid", field(P, 0).alias("code"), *first_last, int_field(P, 3).alias("unknown")],
        "platform": ["serviceid", "idx", F.col("stop_station").alias("station"), field(P, 0).alias("arrival"), field(P, 1).alias("departure"),
                     int_field(P, 2).alias("footnote")],
        "stop": ["serviceid", "idx", field(P, 0).alias("station"), F.when(t.isin(".", "+", "<"), hhmm_to_seconds(field(P, 1))).cast("long").alias("arr_s"),
                 F.when(t.isin(">", "."), hhmm_to_seconds(field(P, 1))).when(t == "+", hhmm_to_seconds(field(P, 2))).cast("long").alias("dep_s")],
    }
    return records.filter(F.col("kind") == kind).select(*columns[kind])


def parse_timetable_sections(sections: DataFrame) -> dict[str, DataFrame]:
    """Six lazy tables from service blocks; each parses the blocks again when it is read
    (:func:`store_timetable` parses them once)."""
    records = timetable_records(sections)
    return {k: timetable_table(records, k) for k in dict.fromkeys(TAGS.values())}


def store_timetable(sections: DataFrame, path: str) -> dict[str, DataFrame]:
    """Six tables from service blocks that are read and parsed once: one pass writes all records to
    ``path``, in a folder per table, and each table reads its own folder only."""
    spark = sections.sparkSession
    # a file per table stays open: with one at a time every record would be sorted by its table first, by way of the disk
    open_files = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(open_files)
    spark.conf.set(open_files, len(set(TAGS.values())) + 1)
    try:
        timetable_records(sections).write.mode("overwrite").partitionBy("kind").parquet(path)
    finally:
        spark.conf.set(open_files, before)
    records = spark.read.schema(f"{RECORD_SCHEMA}, kind string").parquet(path)
    return {k: timetable_table(records, k) for k in dict.fromkeys(TAGS.values())}


def read_timetables(spark: SparkSession, base: str, charset: str = CHARSET, store: str | None = None) -> dict[str, DataFrame]:
    """The timetable file, parsed once into ``store`` (default: a folder of the session's shared scratch)."""
    return store_timetable(_sections(spark, base, "timetbls", charset), store or scratch_path(spark, f"iff/timetable-{uuid.uuid4().hex}"))


def read_iff(spark: SparkSession, base: str, charset: str = CHARSET, store: str | None = None) -> dict[str, DataFrame]:
    """Every table of one IFF delivery directory; the timetable is parsed here, once for its six
    tables, the small files are lazy."""
    t = read_timetables(spark, base, charset, store)
    t.update({
        "delivery": read_delivery(spark, base, charset), "country": read_countries(spark, base, charset),
        "company": read_companies(spark, base, charset), "trnsmode": read_transport_modes(spark, base, charset),
        "trnsattr": read_transport_attributes(spark, base, charset),
        "connmode": read_connection_modes(spark, base, charset),
        "contconn": read_continuous_connections(spark, base, charset),
        "station": read_stations(spark, base, charset), "timezone": read_timezones(spark, base, charset),
        "trnsaqst": read_attribute_questions(spark, base, charset),
        "footnote_bits": read_footnote_bitmaps(spark, base, charset), "changes": read_changes(spark, base, charset),
    })
    return t


def footnote_dates(footnote_bits: DataFrame, first_day) -> DataFrame:
    """footnote(footnote, servicedate): bit i of a footnote is ``first_day + i``.

    ``first_day`` is the delivery's first day (``read_delivery(...).first()``
    is one row) or a date/Column.
    """
    from ..operators.calendars import bitmap_dates

    return bitmap_dates(footnote_bits, first_day)
