"""GTFS sinks (A-16, A-17).

Each GTFS table is written as CSV with a header.  Every table is
range-partitioned and sorted within partitions on its GTFS order, so the
part files concatenate to a sorted table without a single-task global sort
(adaptive execution merges the partitions of a small table).  Parquet output
keeps types for downstream Spark jobs; :func:`publish_feed` writes it so that readers see either
the old feed or the whole new one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ORDER = {"stop_times": ("trip_id", "stop_sequence"), "shapes": ("shape_id", "shape_pt_sequence"),
         "trips": ("trip_id",), "calendar_dates": ("service_id", "date"), "stops": ("stop_id",), "routes": ("route_id",),
         "transfers": ("from_stop_id", "to_stop_id", "from_trip_id", "to_trip_id"), "agency": ("agency_id",)}


def write_table(df: DataFrame, path: str, name: str, fmt: str = "csv", partitions: int | None = None) -> None:
    order = [c for c in ORDER.get(name, ()) if c in df.columns]
    out = df
    if order:
        out = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
        out = out.sortWithinPartitions(*order)
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(f"{path.rstrip('/')}/{name}")
    else:
        w.parquet(f"{path.rstrip('/')}/{name}")


def write_feed(feed: dict[str, DataFrame], path: str, fmt: str = "csv") -> None:
    for name, df in feed.items():
        write_table(df, path, name, fmt)


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """A table with columns but no rows (A-17): written as a header-only file."""
    return spark.createDataFrame([], schema)


#: Bytes of a part file of a published feed, and feeds that stay besides the current one.
PART_BYTES = 128 << 20
KEPT = 1


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed manifests, ascending."""
    p, fs = _fs(spark, f"{path}/manifests")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_feed(feed: dict[str, DataFrame], path: str, part_bytes: int = PART_BYTES, partition_by: Mapping[str, Sequence[str]] = {},
                 kept: int = KEPT) -> int:
    """Publish a feed as Parquet, all tables at once; returns its number.

    Each table is written to a folder of this feed alone, then cut by ranges of its GTFS order into
    parts of about ``part_bytes`` (by the size it was first written with) and sorted in them;
    ``partition_by`` names columns that large tables are filed under.  The manifest, one small file that lists the tables, is
    renamed into place last: readers (:func:`read_feed`) see the old feed until then, also if a job
    fails on the way, which is simply run again.  Of the older feeds ``kept`` stay, for
    jobs that still read them."""
    spark = next(iter(feed.values())).sparkSession
    path = path.rstrip("/")
    done = _manifests(spark, path)
    number = done[-1] + 1 if done else 1
    own = f"{path}/feeds/{number}-{uuid.uuid4().hex}"
    tables = {}
    for name, df in feed.items():
        rough = f"{own}/_rough/{name}"
        df.write.parquet(rough)
        p, fs = _fs(spark, rough)
        size = fs.getContentSummary(p).getLength()
        rows = spark.read.schema(df.schema).parquet(rough)
        order = [c for c in ORDER.get(name, ()) if c in df.columns]
        under = [c for c in partition_by.get(name, ()) if c in df.columns]
        if order:
            rows = rows.repartitionByRange(max(1, -(-size // part_bytes)), *under, *order).sortWithinPartitions(*under, *order)
        rows.write.partitionBy(*under).parquet(f"{own}/{name}")
        tables[name] = {"path": f"{own}/{name}", "schema": df.schema.jsonValue(), "rough_bytes": size}
    p, fs = _fs(spark, f"{own}/_rough")
    fs.delete(p, True)
    _commit(spark, path, number, json.dumps({"number": number, "tables": tables}))
    for old in done[:len(done) - kept]:
        folder = json.loads(_read_text(spark, f"{path}/manifests/{old}.json"))["tables"]
        for place in {t["path"].rsplit("/", 1)[0] for t in folder.values()}:
            p, fs = _fs(spark, place)
            fs.delete(p, True)
        p, fs = _fs(spark, f"{path}/manifests/{old}.json")
        fs.delete(p, False)
    return number


def _commit(spark: SparkSession, path: str, number: int, text: str) -> None:
    """Write the manifest aside and rename it into place; an error if that number was taken meanwhile."""
    aside, fs = _fs(spark, f"{path}/manifests/.{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target, _ = _fs(spark, f"{path}/manifests/{number}.json")
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise FileExistsError(f"feed {number} of {path} was published by another job")


def read_feed(spark: SparkSession, path: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest published feed (or of a given one that stays)."""
    done = _manifests(spark, path.rstrip("/"))
    if not done:
        raise FileNotFoundError(f"no feed was published to {path}")
    manifest = json.loads(_read_text(spark, f"{path.rstrip('/')}/manifests/{number or done[-1]}.json"))
    return {name: spark.read.schema(T.StructType.fromJson(t["schema"])).parquet(t["path"]) for name, t in manifest["tables"].items()}
