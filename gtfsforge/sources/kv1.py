"""KV1 pipe-delimited feed reader (A-1…A-5).

Files are read with Spark's CSV reader as Latin-1 (lossless for every byte;
see ``charsets``), split on ``|`` with CSV quoting, empty fields as NULL.
Header lines are recognised per row by their second field (the version
column holds a header name), so files stay splittable and no "first line"
state is needed.  Values are then decoded to the feed's charset and cast
with ``try_cast`` (a malformed value becomes NULL and is reported by the
NOT NULL check instead of failing a 100 TB load).  Clock-time text becomes
integer seconds next to the text column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cols import ensure_columns
from ..functions.times import to_seconds
from . import schemas
from .charsets import LATIN1, decode_latin1_text

# ---- fixed values: names that mark a header line in the version column ----
VERSION_HEADERS = ("Version_Number", "VersionNumber", "VERSIONNUMBER", "version")
# ---- end of fixed values ----

# text clock times -> seconds columns
TIME_COLUMNS = {"pujopass": {"targetarrivaltime": "arr_s", "targetdeparturetime": "dep_s"},
                "pujo": {"departuretime": "departure_s"}, "schedpujo": {"departuretime": "departure_s"}}


def _raw_schema(table: str, dialect: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in schemas.columns(table, dialect)])


def parse_fields(raw: DataFrame, table: str, dialect: str = "standard", charset: str = "UTF-8", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed KV1 table from string columns read as Latin-1; columns ``keep`` come along as they are."""
    cols = schemas.columns(table, dialect)
    df = raw.filter(~F.coalesce(F.col("version").isin(*VERSION_HEADERS), F.lit(False)))
    out = []
    for name, typ in cols:
        v = F.rtrim(decode_latin1_text(F.col(name), charset))
        v = F.when(v == "", F.lit(None)).otherwise(v)
        out.append((v if typ == "string" else v.try_cast(typ)).alias(name))
    df = df.select(*out, *keep)
    df = ensure_columns(df, {n: t for n, t in schemas.full_columns(table)})
    for text_col, sec_col in TIME_COLUMNS.get(table, {}).items():
        df = df.withColumn(sec_col, to_seconds(text_col))
    return df


def count_undecodable(raw: DataFrame, table: str, dialect: str = "standard", charset: str = "UTF-8") -> DataFrame:
    """(table, column, n): values of the raw table whose bytes are malformed in
    ``charset``; they are NULL in the parsed table."""
    names = [n for n, _ in schemas.columns(table, dialect)]
    bad = [F.count_if(F.col(n).isNotNull() & decode_latin1_text(F.col(n), charset).isNull()).alias(n) for n in names]
    one = raw.agg(*bad)
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("n")) for n in names])
    return one.select(F.lit(table).alias("table"), F.explode(pairs).alias("c")).select("table", "c.column", "c.n").where("n > 0")


def read_kv1(spark: SparkSession, path: str, table: str, dialect: str = "standard",
             charset: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """One KV1 table from pipe-delimited file(s) at ``path`` (file, dir or glob).  A quote inside a quoted
    field is doubled.  With ``multi_line`` quoted fields may hold line ends; a file is
    then read by one task."""
    raw = (spark.read.schema(_raw_schema(table, dialect)).option("sep", "|").option("quote", '"').option("escape", '"').option("multiLine", multi_line)
           .option("encoding", LATIN1).option("mode", "PERMISSIVE").option("nullValue", "")
           .csv(path))
    return parse_fields(raw, table, dialect, charset)


def parse_lines(lines: DataFrame, table: str, dialect: str = "standard", charset: str = "UTF-8",
                value_col: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """KV1 table from a DataFrame of text lines (as produced by
    :func:`sources.archives.expand_archives`), parsed with ``from_csv``; columns ``keep`` come along."""
    return parse_fields(raw_lines(lines, table, dialect, value_col, keep), table, dialect, charset, keep)


def raw_lines(lines: DataFrame, table: str, dialect: str = "standard", value_col: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of text lines as strings, not yet decoded or cast."""
    ddl = ", ".join(f"`{f.name}` string" for f in _raw_schema(table, dialect).fields)
    return lines.select(F.from_csv(F.col(value_col), ddl, {"sep": "|", "quote": '"', "escape": '"', "multiLine": "true"}).alias("r"), *keep).select("r.*", *keep)


def table_name(member: str) -> str:
    """Archive member name -> table name: ``…/USRSTOP.TMI`` / ``USRSTOPX.csv`` -> ``usrstop``."""
    base = member.rsplit("/", 1)[-1]
    base = base.split(".TMI")[0]
    if base.lower().endswith(".csv"):
        base = base[:-4]
    return base.rstrip("X").lower()


def list_delivery(spark: SparkSession, path: str) -> dict[str, str]:
    """table -> file path for an unpacked delivery folder (file names only
    are listed on the driver; no data is read)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, str] = {}
    for st in fs.listStatus(root):
        if st.isFile():
            name = st.getPath().getName()
            t = table_name(name)
            if t in schemas.KV1_TABLES:
                out[t] = st.getPath().toString()
    return out


def delivery_owner(spark: SparkSession, operday_path: str) -> str | None:
    """Data owner of a delivery: the owner column of its first OPERDAY row."""
    r = read_kv1(spark, operday_path, "operday").select("dataownercode").first()
    return None if r is None else r[0]


def read_delivery(spark: SparkSession, files: dict[str, str] | str, dialect: str = "standard",
                  charset: str | None = None) -> dict[str, DataFrame]:
    """All tables of one delivery, in load order; absent tables are skipped
    (A-5).  ``files`` is a folder or a table -> path map.  Without
    ``charset`` the owner's charset is used (A-3)."""
    from .charsets import charset_of_owner

    if isinstance(files, str):
        files = list_delivery(spark, files)
    if charset is None:
        owner = delivery_owner(spark, files["operday"]) if "operday" in files else None
        charset = charset_of_owner(owner) if owner else "UTF-8"
    return {t: read_kv1(spark, files[t], t, dialect, charset) for t in schemas.IMPORT_ORDER if t in files}
