"""Feed index XML (A-12) and lookup CSV files (A-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_feed_index(spark: SparkSession, path: str) -> DataFrame:
    """``periode`` elements of a feed index as a manifest DataFrame.

    Columns: feedkey, filename, dataownerversion, ispublished, publishdate,
    isbaseline, validfrom, validthru, idx (Spark's XML source, one row per
    ``periode``).
    """
    raw = spark.read.format("xml").option("rowTag", "periode").option("inferSchema", "false").load(path)
    return raw.select(
        F.col("_key").alias("feedkey"), F.col("zipfile").alias("filename"),
        F.col("versie").try_cast("int").alias("dataownerversion"),
        (F.lower(F.col("isgepubliceerd")) == "true").alias("ispublished"),
        F.col("publicatiedatum").alias("publishdate"),
        (F.lower(F.col("isbaseline")) == "true").alias("isbaseline"),
        F.to_date(F.substring("startdatum", 1, 10)).alias("validfrom"),
        F.to_date(F.substring("einddatum", 1, 10)).alias("validthru"),
        F.col("index").try_cast("int").alias("idx"))


def read_index_stamp(spark: SparkSession, path: str) -> DataFrame:
    """The index's ``mutatiedatum`` (change stamp) as a one-row DataFrame."""
    raw = spark.read.format("xml").option("rowTag", "kv1index").option("inferSchema", "false").load(path)
    return raw.select(F.col("mutatiedatum").cast("string").alias("mutatiedatum"))


def read_lookup_csv(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    """Small lookup CSV (line public numbers, positioned stops …) (A-13)."""
    return spark.read.schema(schema).option("header", header).csv(path)
