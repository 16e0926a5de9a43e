"""Compare the members of many posting lists, some of them very long.

``list_blocks`` deals the members of each list into blocks of bounded size, one
row group per pair of blocks, so that a list of any length is compared by many
tasks.  Lists of one member are dropped before anything is dealt out.
``runs`` streams the row groups of a sorted partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_blocks(postings: DataFrame, keys: list[str], member: str, block: int) -> DataFrame:
    """The rows of lists (equal ``keys``, no nulls) of two members or more, with ``bi``, ``bj``
    (block pair, bi <= bj) and ``own`` (the row's block); a row of a list of n blocks comes n times."""
    sizes = postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_list")).where("n_list > 1")
    n_blocks = F.ceil(F.col("n_list") / F.lit(block)).cast("int")
    return postings.join(sizes, keys).withColumn("n_blocks", n_blocks) \
        .withColumn("own", F.pmod(F.xxhash64(member), F.col("n_blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))) \
        .withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other")) \
        .drop("other", "n_list", "n_blocks")


def together(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """Whole block pairs in one partition, in order of (keys, bi, bj)."""
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, *keys, "bi", "bj").sortWithinPartitions(*keys, "bi", "bj")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], at_once: int = 8192) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Stretches of whole row groups (equal ``keys``) of a sorted stream, each of at least
    ``at_once`` rows but for the last, with the groups' first rows and the end."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < at_once:
            continue
        table = pa.Table.from_batches(held)
        starts = _starts(table, keys)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last), starts
            held, rows = table.slice(last).combine_chunks().to_batches(), table.num_rows - last
    if rows:
        table = pa.Table.from_batches(held)
        yield table, np.append(_starts(table, keys), table.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def pairs_within(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All row pairs (i < j) inside the given groups, by their distance: first all
    neighbours, then those two apart, and so on; a few arrays for many small groups."""
    size = np.diff(starts)
    first = starts[:-1]
    d = 1
    while (live := size > d).any():
        n = size[live] - d
        i = np.repeat(first[live] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        yield i, i + d
        d += 1


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the graph on 0..n-1 with edges (a, b): at most n - 1 edges
    with the same components, as (node, smallest node of its component).

    Labels fall to the smallest one reachable by repeated minima over edges and
    pointer jumping."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
        if (label == before).all():
            break
    nodes = np.flatnonzero(label != np.arange(n))
    return nodes, label[nodes]
