"""Centroid clustering (Lloyd rounds) by equal-average equal-variance search.

Components are integers, floor(scale * x), so that sums, distances and centroids are exact
and a rerun gives the same result bit for bit.

The search for a vector's nearest centroid sorts the centroids by their component sum once.
With s the component sums, k the number of components and D the squared deviation sums
k * sum(x^2) - s^2, any vector x and centroid c satisfy

    k * |x - c|^2  >=  (s_x - s_c)^2                                   (equal average)
    k * |x - c|^2  >=  (s_x - s_c)^2 + (sqrt(D_x) - sqrt(D_c))^2       (equal variance)

A scan goes outward from the vector's own sum; a side ends as soon as the first bound
exceeds the best distance found, a centroid that the second bound excludes is passed over,
and only the rest have their distances computed, in integers.  Both rejections are strict, so
that ties reach the integer comparison, where the smaller number wins.

A round is one scan of the input: each task assigns its vectors and hands on one row of
integer sums per cluster; k rows of sums are what the driver sees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import ensure_importable, stored

#: Parameters of the registered query.
CLUSTERS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = 1
#: Integer components lie below this size, so that a squared distance over 256 of them fits a long.
MOST = 1 << 26


class Centroids:
    """Integer centroids (one per row), ready for searches."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        sums = rows.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]
        self.dev = np.sqrt(_spread(rows)[self.order])

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance) of each row, and how many distances were computed."""
        n, k = x.shape
        m = len(self.rows)
        sums = x.sum(axis=1)
        dev = np.sqrt(_spread(x))
        hi = np.searchsorted(self.sums, sums)
        lo = hi - 1
        best = np.full(n, np.iinfo(np.int64).max)
        who = np.zeros(n, np.int64)
        live = np.arange(n)
        computed = 0
        while len(live):
            left, right, s = lo[live], hi[live], sums[live]
            down = np.where(left >= 0, s - self.sums[np.maximum(left, 0)], -1)  # distance in the sum; -1: side at its end
            up = np.where(right < m, self.sums[np.minimum(right, m - 1)] - s, -1)
            go_down = (down >= 0) & ((up < 0) | (down <= up))
            gap = np.where(go_down, down, up)
            at = np.where(go_down, left, right)
            # k * best may pass 63 bits before the first distance is known
            limit = np.where(best[live] == np.iinfo(np.int64).max, np.inf, k * best[live].astype(np.float64))
            go = (gap >= 0) & ~_beyond(gap.astype(np.float64) ** 2, limit)
            live, at, gap, limit, go_down = live[go], at[go], gap[go], limit[go], go_down[go]
            bound = gap.astype(np.float64) ** 2 + (dev[live] - self.dev[at]) ** 2
            near = ~_beyond(bound, limit, dev[live] ** 2 + self.dev[at] ** 2)
            rows, number = live[near], self.order[at[near]]
            diff = x[rows] - self.rows[number]
            dist = (diff * diff).sum(axis=1)
            computed += len(rows)
            better = (dist < best[rows]) | ((dist == best[rows]) & (number < who[rows]))
            best[rows[better]], who[rows[better]] = dist[better], number[better]
            lo[live] -= go_down
            hi[live] += ~go_down
        return who, best, computed


def _spread(x: np.ndarray) -> np.ndarray:
    """k * sum(x^2) - s^2 in double precision.  A shift of all components leaves it as it is; shifted
    by the mean's floor nothing cancels."""
    f = (x - (x.sum(axis=1) // x.shape[1])[:, None]).astype(np.float64)
    return x.shape[1] * (f * f).sum(axis=1) - f.sum(axis=1) ** 2


def _beyond(bound: np.ndarray, limit: np.ndarray, noise: np.ndarray | float = 0.0) -> np.ndarray:
    """bound > limit, whatever the rounding of either (and of the squares in ``noise``)."""
    return bound > limit + 1e-9 * (bound + noise) + 1.0


def _usable(vector: Column, kind: T.DataType, dims: int, scale: int) -> Column:
    """Exactly ``dims`` components, none null, non-finite or too large for exact distances."""
    bound = F.lit(float(MOST // scale))
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < bound))
    return F.coalesce((F.size(vector) == dims) & sound, F.lit(False))


def _integers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(-1, dims)


def assign(vectors: DataFrame, centroids: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance) of rows (id, e) of usable vectors."""
    dims = centroids.shape[1]
    ensure_importable(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids).search
        for batch in batches:
            if batch.num_rows:
                who, dist, _ = search(_integers(batch.column(1), dims, scale))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(who, pa.int32()), pa.array(dist)], names=["id", "cluster", "distance"])

    return vectors.select("id", "e").mapInArrow(run, T.StructType([vectors.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]))


def _sums(vectors: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """(cluster, n, sums): one row per cluster that a task found members of."""
    k, dims = centroids.shape
    ensure_importable(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids).search
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column(0), dims, scale)
                who = search(x)[0]
                n += np.bincount(who, minlength=k)
                np.add.at(sums, who, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "sums"])

    return vectors.select("e").mapInArrow(run, "cluster int, n long, sums array<long>")


def _moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """Centroids after one round: floor of the mean per component; empty clusters stay."""
    parts = _sums(vectors, centroids, scale)
    total = parts.select("cluster", "n", F.posexplode("sums").alias("i", "x")) \
        .groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in total.collect():  # k * dims rows, whatever the input
        out[r.cluster, r.i] = int(r.x) // r.n
    return out


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
            id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per usable vector.

    Start: the ``clusters`` vectors with the smallest lowercase-hex SHA-256 of ``<seed>:<id>``,
    in that order (equal ids: by their components).  Defined results: a vector that is null, of another
    length, holds a null or non-finite component or one of 2**26 / ``scale`` or more (beyond
    which distances leave the range of a long) has no row; fewer usable vectors than
    clusters give fewer clusters; a null id is never a start but is assigned (a null id in
    the result; no usable id at all: no rows); repeated rows are vectors of their own; ties go to the smaller
    number; an inertia beyond a long is null; an empty table stays empty; other columns are ignored.
    """
    kind = vectors.schema[vector].dataType.elementType
    e = F.col(f"`{vector}`")
    e = e if isinstance(kind, (T.FloatType, T.DoubleType)) else e.cast("array<double>")
    usable = vectors.select(F.col(f"`{id_col}`").alias("id"), e.alias("e")).where(_usable(F.col("e"), kind, dims, scale))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = usable.where("id is not null").select(digest.alias("h"), "e").orderBy("h", "e").limit(clusters).collect()
    if not first:
        return usable.where("false").select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
                                            F.lit("").alias("centroid_sha256"))
    centroids = np.floor(scale * np.array([r.e for r in first], np.float64)).astype(np.int64)
    for _ in range(rounds):
        centroids = _moved(usable, centroids, scale)
    rows = stored(assign(usable, centroids, scale), "assigned")
    spark = vectors.sparkSession
    names = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)],
                                  "c int, centroid_sha256 string")
    sums = rows.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    total = rows.agg(F.try_sum("distance").alias("inertia"))
    return rows.join(F.broadcast(sums.join(F.broadcast(names), F.col("cluster") == F.col("c"))), "cluster") \
        .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", total.scalar().alias("inertia"), "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle() -> str:
    """The rounds, spelled out: all distances of all vectors."""
    parts = [f"""v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings
      WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS})""",
             f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, x FROM v
      QUALIFY row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) <= {CLUSTERS})"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS (SELECT vec_id, v.x, k.c, d FROM v, LATERAL (
          SELECT c, list_sum(list_transform(list_zip(v.x, c{r}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM c{r}) k
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < ROUNDS:
            parts.append(f"""s{r} AS (SELECT c, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{r}, range(1, {DIMS + 1}) t(i) GROUP BY c, i),
    c{r + 1} AS (SELECT o.c, coalesce(m.x, o.x) AS x FROM c{r} o
      LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM s{r} GROUP BY c) m ON m.c = o.c)""")
    last = ROUNDS
    return "WITH " + ",\n    ".join(parts) + f"""
SELECT vec_id, a{last}.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{last}.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c{last}.x, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON a{last}.c = c{last}.c
"""


ORACLE = _oracle()
