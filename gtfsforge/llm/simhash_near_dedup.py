"""SimHash near-dedup over a byte-position inverted index with count filtering.

1. Every document gets a 64-bit SimHash: a bit is 1 if it is set in over half of
   the XXH64 values (seed 42) of its word shingles, repeats counted.
2. Documents collapse to distinct fingerprints (a pre-aggregated group), so copies,
   however many, are one entry from here on.
3. Two fingerprints that differ in at most ``d`` bits differ in at most ``d`` of the
   eight bytes, so they agree in at least ``8 - d`` byte positions: the guaranteed
   minimum of matches.  The inverted index lists fingerprints by the bytes at three
   positions together.  The 20 position triples are chosen so that any four positions
   hold one of them; every pair with four shared positional bytes therefore meets in a
   posting list, while lists stay 2**24 times shorter than the table.
4. In a list the shared positional bytes of each pair are tallied; pairs below the
   minimum go, the others are verified by the bit distance.  Each list yields a spanning
   forest of its links (at most one row per member), never all pairs.
5. The forests' connected components give the groups.

Long lists are dealt out in pairs of bounded blocks (:mod:`.blocks`).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import forest, list_blocks, pairs_within, runs, together
from .components import components
from .frames import append_columns, ensure_importable, stored

#: Production parameters (those of the contract).
SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
#: Members of a posting list that one task compares with each other.
BLOCK = 1024

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of one whole text as a signed 64-bit integer; 0 for a text without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if len(words) <= shingle:
        spans = [line]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        first = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
        spans = [line[a:b] for a, b in zip(first, ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 14):
        h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in spans[k:k + (1 << 14)]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint column ``out`` (long)."""

    def make():
        return lambda texts: {out: [fingerprint(t, shingle) for t in texts]}

    return append_columns(docs, [T.StructField(out, T.LongType())], text, make)


def position_triples() -> list[tuple[int, int, int]]:
    """Twenty triples of the positions 0..7 such that any four positions contain one:
    those inside one of the classes {0,1,2}, {3,4,5}, {6,7}, and those with two
    positions in a class and one in the next (cyclically)."""
    cls = (0, 0, 0, 1, 1, 1, 2, 2)

    def chosen(t) -> bool:
        a = sorted(cls[x] for x in t)
        if a[0] == a[2]:
            return True
        if len(set(a)) == 3:
            return False
        return (a[1] + 1) % 3 == (a[0] + a[2] - a[1]) % 3

    return [t for t in combinations(range(8), 3) if chosen(t)]


def postings(fps: DataFrame, fp: str = "fp") -> DataFrame:
    """(key, fp): one row per position triple; the key holds the triple's number and its three bytes."""

    def byte(p: int):
        return F.shiftrightunsigned(F.col(fp), 8 * p).bitwiseAND(F.lit(255))

    keys = [F.lit(k << 24).cast("long") + byte(a) * 65536 + byte(b) * 256 + byte(c) for k, (a, b, c) in enumerate(position_triples())]
    return fps.select(fp, F.explode(F.array(*keys)).alias("key"))


def _linked(x: np.ndarray, y: np.ndarray, least: int, most: int) -> np.ndarray:
    """Tally of shared positional bytes, count filter, then the bit distance."""
    xor = x ^ y
    tally = sum((xor >> np.uint64(8 * p)) & np.uint64(255) == 0 for p in range(8))
    ok = np.flatnonzero(tally >= least)
    return ok[np.bitwise_count(xor[ok]) <= most]


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """(u, v): forests of the links among distinct fingerprints (column ``fp``).

    ``max_distance`` may be 0 to 4: beyond it fewer than four bytes are guaranteed to match."""
    if not 0 <= max_distance <= 4:
        raise ValueError("max_distance must be 0 to 4")
    least = 8 - max_distance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, ["key", "bi", "bj"]):
            signed = table.column("fp").to_numpy()
            fp, own = signed.view(np.uint64), table.column("own").to_numpy()
            within = table.column("bi").to_numpy() == table.column("bj").to_numpy()  # a block against itself
            size = np.diff(starts)
            a, b = [], []
            small = size <= 32
            bounds = np.column_stack((starts[:-1], starts[1:]))[small]
            if len(bounds):
                rows = np.concatenate([np.arange(s, e) for s, e in bounds])
                cut = np.concatenate(([0], np.cumsum(size[small])))
                for i, j in pairs_within(cut):
                    i, j = rows[i], rows[j]
                    hit = _linked(fp[i], fp[j], least, max_distance)
                    a.append(i[hit])
                    b.append(j[hit])
            for s, e in np.column_stack((starts[:-1], starts[1:]))[~small].tolist():
                left = s + np.flatnonzero(own[s:e] == own[s])
                right = left if within[s] else s + np.flatnonzero(own[s:e] != own[s])
                for i in left.tolist():
                    rest = right[right > i] if right is left else right
                    hit = rest[_linked(fp[i], fp[rest], least, max_distance)]
                    a.append(np.full(len(hit), i))
                    b.append(hit)
            if a:
                node, low = forest(len(fp), np.concatenate(a), np.concatenate(b))
                yield pa.RecordBatch.from_arrays([pa.array(signed[node]), pa.array(signed[low])], names=["u", "v"])

    ensure_importable(fps.sparkSession)
    return together(list_blocks(postings(fps), ["key"], "fp", block), ["key"]).mapInArrow(run, "u long, v long").where("u != v").distinct()


def _members(marked: DataFrame, max_distance: int) -> DataFrame:
    """(fp, low, c) of the distinct fingerprints: the least ``first`` of their rows in
    ``marked`` (first, fp), and their component."""
    found = stored(marked.groupBy("fp").agg(F.min("first").alias("low")), "fingerprints")
    comp = components(links(found.select("fp"), max_distance))
    comp = found.join(comp, found.fp == comp.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("c"))
    return stored(comp, "members")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                   max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(id, fp, component_id) per input row.

    component_id: the smallest id reachable over links of at most ``max_distance``
    bits, the own id included.  Defined results: a null text counts as empty; texts
    without words have fingerprint 0 and link like any other; a row with a null id
    links too but lends no id (null component_id only if its whole group has none);
    repeated rows each get a row; an empty table gives an empty table; other columns
    are ignored, whatever their names.
    """
    marked = fingerprints(docs.select(F.col(f"`{id_col}`").alias("first"), F.col(f"`{text}`").alias("body")), "body", shingle)
    marked = stored(marked.select("first", "fp"), "simhash")
    comp = _members(marked, max_distance)
    least = comp.groupBy("c").agg(F.min("low").alias("component_id"))
    of = comp.join(least, "c").select(F.col("fp").alias("f"), "component_id")
    return marked.join(of, F.col("fp") == F.col("f")).select(F.col("first").alias(id_col), "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` for each group: the first by id (nulls last), fingerprint, text
    digest and the digest of the whole row.  Rows that share an id but not the text belong
    to the groups of their texts; of rows equal in all columns one stays."""
    body = F.col(f"`{text}`")
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()]
    digest = F.md5(F.coalesce(body, F.lit("")).cast("binary"))
    whole = F.md5(F.concat(digest, F.to_json(F.struct(body.isNull().alias("none"), F.struct(*others).alias("row")))).cast("binary"))
    marked = fingerprints(docs.select(F.col(f"`{id_col}`").alias("id"), body.alias("body"), digest.alias("digest"), whole.alias("whole")), "body", shingle)
    marked = stored(marked.select(F.struct(F.col("id").isNull().alias("none"), "id", "fp", "digest", "whole").alias("first"), "fp"), "simhash")
    kept = _members(marked, max_distance).groupBy("c").agg(F.min("low").alias("low")).select(F.col("low.whole").alias("kept"))
    # equal rows collapse before the exchange, so that no row, however often repeated, fills a task
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole.alias("whole")).dropDuplicates(["whole"])
    return rows.join(kept, F.col("whole") == F.col("kept"), "left_semi").select("row.*")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    g = simhash_groups(docs)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
