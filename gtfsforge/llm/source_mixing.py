"""Mixing sources to target weights by entropy balancing.

The mix keeps document rates as even as the targets allow: among all rates r between 0 and
MOST that give each source its target of words, it takes those closest in relative entropy to 1 for
every document.  By duality they are exponentially tilted,

    r = min(MOST, exp(lambda * size / mean size)),

with one multiplier per source, the root of  sum(size * r) = target,  which Newton steps on the
logarithm find, kept inside a bracket that is known from the start.

* Documents enter the iterations as counts per (source, size) only, a table that
  shrinks with every repetition.  One iteration is one grouped sum over it; the
  multipliers of all sources are a table as well.  Sums are decimals, so that neither the
  order of rows nor a lost executor changes a result.
* Targets come from the sources' weights by sharing the total among those below their
  bound, again and again until none passes it.
* Rates become copies per (source, size), largest sizes first: whole copies as far as the words
  owed reach, the rest is owed to the next size.  What a source is still owed at the end is less than
  one document and is cut from one more copy, so a source meets its target to the word.
  Among documents of one source and size a hash of id and text decides who has the extra copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rank import grouped_rank
from .frames import WORD, ensure_importable, stored

#: Weights of the sources in order, repeating, and the copies of a document at most.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Newton ends when every source is this near its target (share of it, or words).
NEAR, WORDS = 1e-9, 0.25
STEPS = 100


def sizes(documents: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, source, size, h): size in words (null text: 0), h a hash of id and text."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source}`").cast("string").alias("source"),
                            F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.col(f"`{id_col}`"), t).alias("h"))


def targets(counts: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """(source, place, n, total, least, target) from counts (source, size, n): total words, documents with
    words, the smallest size among them, and the target in words."""
    some = F.col("size") > 0
    base = counts.groupBy("source").agg(F.sum(F.when(some, F.col("n")).otherwise(0)).alias("n"), F.sum(F.col("n") * F.col("size")).alias("total"),
                                        F.min(F.when(some, F.col("size"))).alias("least")).withColumn("all", F.lit(1))
    placed = grouped_rank(base, ["all"], [F.col("source").isNull(), F.col("source")], "place", "row_number")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    rows = stored(placed.select("source", "place", "n", "total", "least", F.element_at(turn, (F.col("place") - 1) % len(weights) + 1).alias("weight"),
                                (F.col("total") * most).alias("bound")), "sources")
    whole, free = rows.agg(F.sum("total"), F.sum("weight")).head()
    whole, fixed, level, held = (whole or 0) * share, 0, 0.0, 0
    while free:  # the level only rises, and every round but the last puts one more source at its bound
        level = (whole - fixed) / free
        full = F.col("bound") <= F.lit(level) * F.col("weight")
        n, fixed, free = rows.agg(F.sum(full.cast("long")), F.sum(F.when(full, F.col("bound")).otherwise(0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0))).head()
        if n == held:
            break
        held = n
    return rows.select("source", "place", "n", "total", "least", F.least(F.col("bound").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _rate(lam, size, mean, most: int):
    return F.least(F.lit(float(most)), F.exp(F.least(F.lit(700.0), lam * size / mean)))


def multipliers(counts: DataFrame, sources: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """The sources with ``lam``: Newton on log(sum(size * rate)) = log(target), bracketed.

    A source whose target is its bound has all rates at ``most`` (infinite multiplier), one with target 0 none."""
    mean, ratio = F.try_divide("total", "n"), F.try_divide("target", "total")
    edge = F.when(ratio > 1, F.lit(math.log(most))).otherwise(F.log(F.greatest(ratio, F.lit(1e-300)))) * mean / F.col("least")
    fixed = F.when((F.col("total") == 0) | (F.col("target") <= 0), float("-inf")).when(F.col("target") >= F.col("total") * most, float("inf")) \
        .when(F.col("target") == F.col("total"), 0.0)
    zero = F.lit(0.0)
    state = stored(sources.withColumn("fixed", fixed).withColumn("lam", F.coalesce("fixed", zero)).withColumn("done", F.col("fixed").isNotNull())
                   .withColumn("lo", F.when(F.col("done"), zero).when(ratio < 1, edge).otherwise(zero))
                   .withColumn("hi", F.when(F.col("done"), zero).when(ratio < 1, zero).otherwise(edge)).drop("fixed"), "dual")
    for _ in range(steps):
        if not state.where("not done").head(1):
            break
        open_ = state.where("not done").select(F.col("source").alias("s"), F.col("lam").alias("l"), (F.col("total") / F.col("n")).alias("mean"))
        rate = _rate(F.col("l"), F.col("size"), F.col("mean"), most)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
        got = counts.where("size > 0").join(open_, F.col("source").eqNullSafe(F.col("s"))) \
            .groupBy("s").agg(F.sum(words.cast("decimal(38,9)")).cast("double").alias("g"), F.sum(slope.cast("decimal(38,9)")).cast("double").alias("dg"))
        s = state.join(got.select(F.col("s"), "g", "dg", F.lit(True).alias("hit")), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        lo, hi = F.when(F.col("g") < F.col("target"), F.col("lam")).otherwise(F.col("lo")), F.when(F.col("g") > F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        near = F.abs(F.col("g") - F.col("target")) <= F.greatest(F.lit(WORDS), F.col("target") * NEAR)
        step = F.col("lam") - (F.log("g") - F.log("target")) * F.col("g") / F.nullif(F.col("dg"), zero)
        s = s.withColumn("lo2", lo).withColumn("hi2", hi)
        inside = (step > F.col("lo2")) & (step < F.col("hi2"))
        moved = F.when(F.coalesce(inside, F.lit(False)), step).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        end = F.col("done") | F.coalesce(near, F.lit(False))
        state = stored(s.select(*sources.columns, F.when(end, F.col("lam")).otherwise(moved).alias("lam"), end.alias("done"),
                                F.when(F.col("hit"), F.col("lo2")).otherwise(F.col("lo")).alias("lo"), F.when(F.col("hit"), F.col("hi2")).otherwise(F.col("hi")).alias("hi")), "dual")
    return state.select(*sources.columns, "lam")


def fold(size: np.ndarray, n: np.ndarray, rate: np.ndarray, owed: float, most: int, taken: int) -> tuple[list[int], float, int]:
    """Copies of some sizes of one source (descending): (copies per size, words owed after, words taken)."""
    out = []
    for s, k, r in zip(size.tolist(), n.tolist(), rate.tolist()):
        owed += k * s * r
        c = min(most * k, max(0, math.floor(owed / s + 1e-9))) if s else 0
        owed -= c * s
        taken += c * s
        out.append(c)
    return out, owed, taken


def _copies(counts: DataFrame, duals: DataFrame, most: int) -> DataFrame:
    """(s, size_, n_, copies, cut, source_size, target) per source and size: whole copies of all its documents
    together, and the words of one more copy that is cut."""
    spark = counts.sparkSession
    rate = F.when(F.col("lam") == float("inf"), float(most)).when(F.col("lam") == float("-inf"), 0.0) \
        .otherwise(_rate(F.col("lam"), F.col("size"), F.try_divide("total", "n_docs"), most))
    d = duals.select(F.col("source").alias("s"), "place", F.col("n").alias("n_docs"), "total", "target", "lam")
    rows = counts.join(d, F.col("source").eqNullSafe(F.col("s"))).select("place", "size", "n", F.coalesce(rate, F.lit(0.0)).alias("rate"), "target", "total", "source")
    ensure_importable(spark)
    keys = ["place", "size", "n", "target", "total"]
    schema = pa.schema([("place", pa.int32()), ("size", pa.int64()), ("n", pa.int64()), ("target", pa.float64()), ("total", pa.int64()),
                        ("source", pa.string()), ("copies", pa.int64()), ("cut", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams a source's sizes; the one row that may take the cut copy is held back until the source ends."""
        now, held, owed, taken, goal = None, None, 0.0, 0, 0.0

        def closed() -> pa.RecordBatch:
            row, size, n, copies = held
            rest = max(0, min(round(goal) - taken, size - 1)) if copies < most * n else 0
            return pa.RecordBatch.from_arrays([*row.columns, pa.array([copies], pa.int64()), pa.array([rest], pa.int64())], schema=schema)

        for batch in batches:
            place = batch.column(0).to_numpy()
            at = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), len(place)]
            for s, e in zip(at, at[1:]):
                part = batch.slice(s, e - s)
                if e > s and place[s] != now:
                    if held is not None:
                        yield closed()
                    now, held, owed, taken, goal = place[s], None, 0.0, 0, part.column(3)[0].as_py()
                size, n = part.column(1).to_numpy(), part.column(2).to_numpy()
                copies, owed, taken = fold(size, n, part.column(6).to_numpy(), owed, most, taken)
                c = np.array(copies, np.int64)
                base = part.select([0, 1, 2, 3, 4, 5])
                able = np.flatnonzero((c < most * n) & (size > 0))
                go = np.ones(len(c), bool)
                if len(able):  # the smallest size with room takes the cut copy
                    if held is not None:
                        row, _, _, was = held
                        yield pa.RecordBatch.from_arrays([*row.columns, pa.array([was], pa.int64()), pa.array([0], pa.int64())], schema=schema)
                    k = int(able[-1])
                    held = (base.slice(k, 1), int(size[k]), int(n[k]), int(c[k]))
                    go[k] = False
                rows_ = base.filter(pa.array(go))
                yield pa.RecordBatch.from_arrays([*rows_.columns, pa.array(c[go]), pa.array(np.zeros(int(go.sum()), np.int64))], schema=schema)
        if held is not None:
            yield closed()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*keys, "source", "rate").repartition(n, "place").sortWithinPartitions("place", F.desc("size"))
    made = dealt.mapInArrow(run, "place int, size long, n long, target double, total long, source string, copies long, cut long")
    return made.select(F.col("source").alias("s"), F.col("size").alias("size_"), F.col("n").alias("n_"), "copies", "cut", F.col("total").alias("source_size"), "target")


def mix(documents: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
        most: int = MOST, share: float = 1.0) -> DataFrame:
    """(id, size, source_size, target, copies, taken) per document.

    Sources in code point order, null last, have ``weights`` in turn and share ``share`` of all words; a target stops at ``most``
    times its source's words, the excess is shared again.  taken = size * copies, plus, in
    one document of a source at most, the words of a last copy that is cut.  Defined results: a null
    or empty text has size 0 and none taken; a null source is a source; a null id is an id
    like others; repeated rows are documents of their own; a source without words has target 0; an
    empty table stays empty; other columns are ignored.
    """
    if share > most:
        raise ValueError("the mix cannot be larger than all copies together")
    docs = stored(sizes(documents, id_col, text, source), "sizes")
    counts = stored(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    plan = stored(_copies(counts, multipliers(counts, targets(counts, weights, most, share), most), most), "copies")
    ranked = grouped_rank(docs, ["source", "size"], ["h"], "rank", "row_number")
    each, extra = F.floor(F.col("copies") / F.col("n_")), F.col("copies") % F.col("n_")
    rank = F.col("rank") - 1
    out = ranked.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("size_")))
    copies = each + (rank < extra).cast("int")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", copies.cast("int").alias("copies"),
                      (copies * F.col("size") + F.when(rank == extra, F.col("cut")).otherwise(0)).alias("taken"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
