"""Embedding near-dedup by cross-polytope hashing after fast Hadamard rotations.

1. Vectors of equal label and equal components collapse to one class (a pre-aggregated
   group), so copies, however many, are one entry from here on.
2. A table hashes a unit vector by ``K`` pseudo-random rotations (three rounds of random
   signs and a fast Hadamard transform); each gives the nearest of the 2d signed axes, the
   vertices of a cross-polytope.  The K vertices together are the bucket.
3. Each vector has a home bucket and ``PROBES`` buckets in all per table: those whose
   vertices it comes nearest to.  Two vectors are candidates if the home of one is
   among the buckets of the other, in any of ``TABLES`` tables.  For unit vectors at cosine
   0.98 in 64 dimensions one table misses about 1 pair in 28, all six 1 in 4e8.
4. Candidates are verified by their cosine in double precision.  A pair that meets several
   times is counted where it meets first (table, then bucket), which both vectors' hashes
   tell, so no list of pairs is made: a task returns each vector's number of links and a
   spanning forest.
5. The forests' connected components give the groups.

Long buckets are dealt out in pairs of bounded blocks (:mod:`.blocks`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import forest, list_blocks, pairs_within, runs, together
from .components import components
from .frames import ensure_importable, stored

#: Production parameters.
THRESHOLD = 0.98
TABLES = 6
K = 2
PROBES = 6
#: Vertices of each rotation that probing looks at.
NEAREST = 4
SEED = 20
#: Members of a bucket that one task compares with each other.
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Unnormalised fast Hadamard transform of each row (length a power of two)."""
    h = 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), -1)
        h *= 2
    return x


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision (no row may be zero)."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def buckets(x: np.ndarray, tables: int = TABLES, k: int = K, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """(rows, tables, probes): bucket numbers of unit vectors, nearest first; [:, :, 0] are the homes."""
    n, d = x.shape
    size = max(4, 1 << (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = x
    near = min(NEAREST, size)
    rng = np.random.default_rng([seed, size])
    combos = np.stack(np.meshgrid(*[np.arange(near)] * k, indexing="ij"), -1).reshape(-1, k)
    out = np.zeros((n, tables, min(probes, len(combos))), np.int64)
    for t in range(tables):
        loss = np.zeros((n, len(combos)))
        code = np.zeros((n, len(combos)), np.int64)
        for j in range(k):
            y = padded
            for signs in rng.choice([-1.0, 1.0], size=(3, size)):
                y = hadamard(y * signs)
            far = np.abs(y)
            axes = np.argsort(-far, axis=1, kind="stable")[:, :near]
            vertex = 2 * axes + (np.take_along_axis(y, axes, 1) > 0)
            gap = np.take_along_axis(far, axes, 1)
            gap = gap[:, :1] - gap
            loss += gap[:, combos[:, j]]
            code = code * (2 * size) + vertex[:, combos[:, j]]
        best = np.argsort(loss, axis=1, kind="stable")[:, :out.shape[2]]
        out[:, t] = np.take_along_axis(code, best, 1)
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.Array) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _postings(classes: DataFrame) -> DataFrame:
    """(label, dim, tab, bucket, rep, home): one row per class and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "dim", "tab", "bucket", "rep", "home"]
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims = table.column("dim").to_numpy()
            for d in np.unique(dims):
                part = table.filter(pa.array(dims == d))
                for at in range(0, part.num_rows, 2048):
                    rows = part.slice(at, 2048)
                    b = buckets(unit(_matrix(rows.column("embedding"))))
                    n, tables, probes = b.shape
                    who = np.repeat(np.arange(n), tables * probes)
                    yield pa.RecordBatch.from_arrays([
                        rows.column("label").take(pa.array(who)).combine_chunks(), pa.array(np.full(len(who), d, np.int32)),
                        pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), n)), pa.array(b.reshape(-1)),
                        rows.column("rep").take(pa.array(who)).combine_chunks(),
                        pa.array(np.tile(np.arange(probes) == 0, n * tables))], names=names)

    ensure_importable(classes.sparkSession)
    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("label", "dim", "rep", "embedding").mapInArrow(
        run, f"label {kind}, dim int, tab int, bucket long, rep long, home boolean")


def _first_meeting(x: np.ndarray, y: np.ndarray, tab: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the pairs of rows (their buckets x, y) meet first in the given table and bucket."""
    ok = np.ones(len(x), bool)
    for t in range(x.shape[1]):
        hx, hy = x[:, t, 0], y[:, t, 0]
        in_y, in_x = (y[:, t] == hx[:, None]).any(axis=1), (x[:, t] == hy[:, None]).any(axis=1)
        here = np.minimum(np.where(in_y, hx, np.iinfo(np.int64).max), np.where(in_x, hy, np.iinfo(np.int64).max))
        ok &= np.where(tab == t, here == bucket, (tab < t) | ~(in_x | in_y))
    return ok


def _compare(dealt: DataFrame, threshold: float) -> DataFrame:
    """(u, v, n): v null: u has n more links; else a forest edge."""
    keys = ["label", "dim", "tab", "bucket", "bi", "bj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, keys):
            rep, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
            home, own = table.column("home").to_numpy(), table.column("own").to_numpy()
            within = table.column("bi").to_numpy() == table.column("bj").to_numpy()  # a block against itself
            tab, bucket, dims = (table.column(c).to_numpy() for c in ("tab", "bucket", "dim"))
            links = np.zeros(len(rep), np.int64)
            a_all, b_all = [], []
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                x = np.zeros((len(rep), d))
                x[rows] = unit(_matrix(table.take(pa.array(rows)).column("embedding")))
                groups = [(s, e) for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()) if dims[s] == d]
                for a, b in _candidates(groups, home, own, within, x, threshold):
                    who, back = np.unique(np.concatenate((a, b)), return_inverse=True)
                    code = buckets(x[who])
                    mine = _first_meeting(code[back[:len(a)]], code[back[len(a):]], tab[a], bucket[a])
                    np.add.at(links, a[mine], weight[b[mine]])
                    np.add.at(links, b[mine], weight[a[mine]])
                    node, low = forest(len(who), back[:len(a)], back[len(a):])
                    a_all.append(rep[who[node]])
                    b_all.append(rep[who[low]])
            some = np.flatnonzero(links)
            u = np.concatenate([rep[some], *a_all])
            if len(u):
                v = pa.array(np.concatenate([np.zeros(len(some), np.int64), *b_all]), mask=np.arange(len(u)) < len(some))
                n = np.concatenate((links[some], np.zeros(len(u) - len(some), np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(u), v, pa.array(n)], names=["u", "v", "n"])

    return dealt.mapInArrow(run, "u long, v long, n long")


def _candidates(groups: list, home: np.ndarray, own: np.ndarray, within: np.ndarray, x: np.ndarray, threshold: float) -> Iterator[tuple]:
    """Verified row pairs (a, b), each once: small groups all at a time, long ones by themselves."""
    small = [(s, e) for s, e in groups if e - s <= 32]
    if small:
        rows = np.concatenate([np.arange(s, e) for s, e in small])
        cut = np.cumsum([0] + [e - s for s, e in small])
        found = []
        for i, j in pairs_within(cut):
            i, j = rows[i], rows[j]
            ok = (home[i] | home[j]) & (within[i] | (own[i] != own[j]))
            i, j = i[ok], j[ok]
            hit = (x[i] * x[j]).sum(axis=1) >= threshold
            found.append((i[hit], j[hit]))
        a, b = (np.concatenate(p) for p in zip(*found)) if found else ((), ())
        if len(a):
            yield a, b
    for s, e in groups:
        if e - s <= 32:
            continue
        mine = own[s:e] == own[s]
        left = s + np.flatnonzero(mine)
        right = left if within[s] else s + np.flatnonzero(~mine)
        for at in range(0, len(left), 256):
            part = left[at:at + 256]
            a, b = np.nonzero(x[part] @ x[right].T >= threshold)
            a, b = part[a], right[b]
            ok = home[a] | home[b]
            if right is left:
                ok &= a < b
            if ok.any():
                yield a[ok], b[ok]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) per input row.

    n_links: other rows of the same label at a cosine of ``threshold`` or more;
    component_id: the smallest id reachable over links, the own one included; kept: the
    own id is the component's.  Defined results: a vector that is null, empty, zero or
    holds a null or non-finite component, or has a null label, links with nothing, as do
    vectors of different lengths with each other; a row with a null id takes no part (0
    links, null component, not kept); repeated rows are vectors of their own, and so are rows that
    share an id but not the vector or label; an empty table gives an empty table;
    other columns are ignored.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("embedding"), F.col(f"`{label}`").alias("label"))
    inf = F.lit(float("inf"))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf)) & F.exists("embedding", lambda v: v != 0)
    usable = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    # a class is one label and vector; its number ``rep`` is not an id, which rows of several classes may share
    classes = stored(usable.groupBy("label", "embedding").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("weight"))
                     .withColumn("dim", F.size("embedding")).withColumn("rep", F.monotonically_increasing_id()), "vectors")
    keys = ["label", "dim", "tab", "bucket"]
    dealt = list_blocks(_postings(classes), keys, "rep", block)
    dealt = dealt.join(classes.select(F.col("rep").alias("r"), "embedding", "weight"), F.col("rep") == F.col("r")).drop("r")
    found = stored(_compare(together(dealt, keys), threshold), "links")
    comp = stored(components(found.where("v is not null").select("u", "v")).join(classes.select("rep", "low"), F.col("node") == F.col("rep"))
                  .select("node", "component", "low"), "components")
    least = comp.groupBy(F.col("component").alias("c")).agg(F.min("low").alias("least"))
    comp = comp.join(least, F.col("component") == F.col("c")).select("node", "least")
    links = found.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    of = classes.join(comp, F.col("rep") == F.col("node"), "left").join(links, F.col("rep") == F.col("u"), "left") \
        .select(F.col("label").alias("l"), F.col("embedding").alias("e"),
                (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("least", "low").alias("component_id"))
    usable = usable.join(of, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))).select("id", "n_links", "component_id")
    rest = rows.where(F.col("id").isNull() | F.col("label").isNull() | ~F.coalesce(sound, F.lit(False))) \
        .select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return usable.unionAll(rest).select(F.col("id").alias(id_col), "n_links", "component_id",
                                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs of one label, then a transitive closure.
ORACLE = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(u, v) AS (
  SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u
), low AS (SELECT u, min(v) AS v FROM reach GROUP BY u), n AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low.v, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low.v, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON vec_id = low.u LEFT JOIN n ON vec_id = n.u
"""
