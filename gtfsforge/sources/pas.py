"""PAS metro/tram/bus readers (A-10, A-11).

``.HLT`` stops are comma lines; ``.PAS`` journeys are ``#``-sections (the
journey header, its ``-`` footnote line and the stop lines ``> . + <``),
read one section per row like the IFF timetable; ``.VTN`` footnotes are
``@note,bitmap`` lines whose first bit is the PAS file's first valid day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import hhmm_to_seconds, parse_ddmmyyyy
from ..operators.calendars import bitmap_dates
from ..operators.gtfs_pas import normalise_midnight
from .text import SECTION, after_tag, field, fields, int_field, read_records, section_lines

CHARSET = "cp1252"
FORMAT_TAG = "RETPAS1"
STOP_TAGS = (">", ".", "+", "<")

HLT_COLUMNS = [("overstaphalte", "int"), ("halteid", "string"), ("overstaptijd", "int"), ("maxoverstaptijd", "int"),
               ("landcode", "string"), ("tijdzone", "int"), ("attribuut", "int"), ("x", "long"), ("y", "long"),
               ("naam", "string"), ("straat", "string"), ("volgendezijstraat", "string"),
               ("volgendezijstraat2", "string"), ("zone1", "int"), ("zone2", "int"), ("zone3", "int"), ("zone4", "int")]


def read_stops(spark: SparkSession, path: str, charset: str = CHARSET) -> DataFrame:
    """HLT stop file: 17 comma fields, each trimmed (A-11)."""
    r = read_records(spark, path, charset).filter(F.length("text") > 0)
    p = fields(F.col("text"))
    cols = []
    for i, (name, typ) in enumerate(HLT_COLUMNS):
        v = field(p, i)
        cols.append((v if typ == "string" else v.try_cast(typ)).alias(name))
    return r.select(*cols)


def parse_journey_sections(sections: DataFrame) -> dict[str, DataFrame]:
    """pujo + pujopass from journey sections (``lines`` = array of lines).

    The stop sequence is the count of stop lines up to a line; times are
    seconds, and clock drops within a trip get +24 h (N-23, both columns
    interleaved).
    """
    lines = F.col("lines")
    head = fields(F.element_at(lines, 1))
    note = F.try_element_at(F.filter(lines, lambda x: x.startswith("-")), F.lit(1))
    j = sections.select(
        field(head, 0).alias("modaliteit"), field(head, 1).alias("vervoerdercode"), field(head, 2).alias("lijnsysteemnr"),
        int_field(head, 3).alias("richting"), field(head, 4).alias("ritnummer"),
        F.trim(after_tag(note)).alias("voetnoot"),
        F.filter(lines, lambda x: F.substring(x, 1, 1).isin(*STOP_TAGS)).alias("stops"))
    pujo = j.select("modaliteit", "vervoerdercode", "lijnsysteemnr", "richting", "ritnummer", "voetnoot")
    e = j.select("vervoerdercode", "lijnsysteemnr", "richting", "ritnummer", "voetnoot",
                 F.posexplode("stops").alias("pos", "l"))
    t = F.substring("l", 1, 1)
    p = fields(after_tag(F.col("l")))
    arr = F.when(t.isin(".", "+", "<"), hhmm_to_seconds(field(p, 1)))
    dep = F.when(t.isin(">", "."), hhmm_to_seconds(field(p, 1))).when(t == "+", hhmm_to_seconds(field(p, 2)))
    passes = e.select("vervoerdercode", "lijnsysteemnr", "richting", "ritnummer", "voetnoot",
                      (F.col("pos") + 1).alias("stopsequentie"), field(p, 0).alias("halteid"),
                      arr.cast("long").alias("arr_s"), dep.cast("long").alias("dep_s"))
    return {"pujo": pujo, "pujopass": normalise_midnight(passes)}


def read_journeys(spark: SparkSession, path: str, charset: str = CHARSET) -> dict[str, DataFrame]:
    """PAS file -> pujo, pujopass and the validity period (A-10)."""
    r = read_records(spark, path, charset, sep=SECTION)
    lines = section_lines(F.col("text"))
    preamble = F.filter(lines, lambda x: x.startswith("!") | x.startswith("&"))
    secs = r.select(lines.alias("lines")).filter(~F.element_at("lines", 1).startswith("!")) \
        .filter(F.size("lines") > 0)
    out = parse_journey_sections(secs)
    period = r.select(F.explode(preamble).alias("l")).filter(F.col("l").startswith("&")).select(
        parse_ddmmyyyy(F.split(after_tag(F.col("l")), "-").getItem(0)).alias("validfrom"),
        parse_ddmmyyyy(F.split(after_tag(F.col("l")), "-").getItem(1)).alias("validthru"))
    fmt = r.select(F.explode(preamble).alias("l")).filter(F.col("l").startswith("!")).select(
        (after_tag(F.col("l")) == FORMAT_TAG).alias("format_ok"))
    out.update({"period": period, "format": fmt})
    return out


def read_footnotes(spark: SparkSession, path: str, first_day, charset: str = CHARSET) -> DataFrame:
    """VTN file -> voetnoot(voetnoot, datum) from ``first_day`` (A-11, J-3)."""
    r = read_records(spark, path, charset).filter(F.col("text").startswith("@"))
    p = fields(after_tag(F.col("text")))
    bits = r.select(field(p, 0).alias("voetnoot"), field(p, 1).alias("bits"))
    return bitmap_dates(bits, first_day, key="voetnoot").withColumnRenamed("servicedate", "datum")

