"""Lossless text records from legacy-encoded files.

``spark.read.text`` splits on any separator (``\\r\\n`` for lines,
``\\r\\n#`` for ``#``-sections, so one section is one record and files stay
splittable) and keeps the raw bytes of each record; casting the value to
binary and decoding as Latin-1 recovers them exactly, after which the
feed's charset is applied with one ``translate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .charsets import LATIN1, decode_latin1_text

CRLF = "\r\n"
SECTION = "\r\n#"


def read_records(spark: SparkSession, path: str, charset: str = "cp1252", sep: str = CRLF,
                 with_file: bool = False) -> DataFrame:
    """Records of ``path`` as column ``text`` (decoded), optionally with ``file``."""
    df = spark.read.option("lineSep", sep).text(path)
    cols = [decode_latin1_text(F.decode(F.col("value").cast("binary"), LATIN1), charset).alias("text")]
    if with_file:
        cols.append(F.col("_metadata.file_path").alias("file"))
    return df.select(*cols)


def fields(text: Column, sep: str = ",") -> Column:
    return F.split(text, sep, -1)


def after_tag(line: Column) -> Column:
    """The line without its first character (the record tag), to its end."""
    return F.substr(line, F.lit(2))


def field(parts: Column, i: int) -> Column:
    """i-th field (0-based), trimmed; empty -> NULL; missing -> NULL."""
    v = F.trim(F.get(parts, i))
    return F.when(v == "", F.lit(None)).otherwise(v)


def int_field(parts: Column, i: int) -> Column:
    return field(parts, i).try_cast("int")


def section_lines(text: Column) -> Column:
    """Lines of a ``#``-section record (leading ``#`` and empty lines dropped)."""
    lines = F.split(F.regexp_replace(text, "^#", ""), CRLF, -1)
    return F.filter(lines, lambda x: F.length(x) > 0)
