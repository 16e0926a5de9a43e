"""From ``documents`` to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the
shared folder as Parquet and reads it again as the next stage's docs.  All but the last
return the columns of ``documents`` (further columns travel along untouched).  Null texts
count as empty in every stage, and an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gtfsforge.llm import packing, quality_classifier, quality_rules, simhash_near_dedup, substring_dedup
from gtfsforge.llm.frames import stored


def _whole_rows(docs: DataFrame) -> DataFrame:
    """row (the input row as a struct) and body (its text): no column names to clash."""
    return docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("text").alias("body"))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it predicts to be of label 0 go."""
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.score(_whole_rows(docs), model, "body").where("predicted = 1").select("row.*")


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rule or leave their script's bands go."""
    return quality_rules.quality_rules(_whole_rows(docs), "body").where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document with the smallest id of each group stays."""
    return simhash_near_dedup.one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: windows that an earlier document also has are cut out; what is left
    of such a text is its words joined by one space (n_chars follows).  Other texts, and
    all rows, stay as they are."""
    cut = substring_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    new = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row per piece of a document in a sequence."""
    return packing.piece_digests(packing.pack(docs))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: SQL expresses neither the classifier nor the tokenisers; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
