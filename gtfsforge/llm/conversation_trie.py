"""Prefix trie of conversations by the Euler-tour technique.

1. Turns are numbered, conversations rebuilt, and every prefix of a conversation gets a
   128-bit key: the exclusive or of its turns' hashes, each taken together with its place.
   Keys are running aggregates, so a long conversation is cut into stretches of turns whose
   totals are added afterwards.
2. Equal keys are one node.  Nodes are sorted by (smallest member, depth) and numbered in
   that order; a node's parent is found by the key without its last turn.
3. Each node has two arcs, enter (2 id) and exit (2 id + 1).  Siblings follow each other by id, so
   the successor of every arc on the tour is known from a node's first child, next sibling
   and parent.  A parent's children are linked within stretches of ids, and the stretches to
   each other: no parent's children meet in one task.
4. The tour is ranked by contraction.  Each task joins the arcs that it holds into chains: the
   first arc of a chain survives with the chain's sums and end, the others note their distance
   from it.  The first round deals arcs by ranges of ids, where most successors are near; the next
   ones deal an arc that drew 0 to its successor if that drew 1, which removes a quarter of
   whatever is left, however it hangs together.  When one arc is left, its rank is 0, and the
   rounds are undone in reverse order.
5. The prefix sums at a node's two arcs differ by what its subtree holds: childless nodes and
   tokens that sharing the prefix saves.

All work is linear in the number of nodes but for the sorts; only counts reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rank import grouped_rank
from .frames import WORD, ensure_importable, stored

#: Turns of a conversation whose keys one window computes.
STRETCH = 4096
#: Arcs that one task contracts (40 bytes each), and the number at which one task finishes.
PER_TASK = 1 << 18
LAST = 1 << 14
#: Conversation ids that one string of a node's ends holds.
PIECE = 512
#: Rebuilding: a conversation starts as the first of its block does, for up to this many turns.
BLOCK = 20
HEADS = 4

WEIGHTS = ["arcs", "leaves", "saved"]


def _partitions(spark: SparkSession, rows: int = 0, per_task: int = PER_TASK) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, pos, dig, words): turns numbered from 1 by ``turn`` (null first), equal ones by the
    digest of role and text; null role or text is empty; rows without a conversation are left out."""
    col = {k: F.col(f"`{v}`") for k, v in (("c", conv), ("turn", turn), ("role", role), ("text", text))}
    role_, text_ = (F.coalesce(col[k].cast("string"), F.lit("")) for k in ("role", "text"))
    rows = conversations.select(col["c"].cast("long").alias("c"), col["turn"].alias("turn"),
                                F.md5(F.concat(F.md5(role_), text_)).alias("dig"), F.regexp_count(text_, F.lit(WORD)).cast("long").alias("words")) \
        .where("c is not null")
    return grouped_rank(stored(rows, "rows"), ["c"], ["turn", "dig"], "pos", "row_number").select("c", "pos", "dig", "words")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations c, turns (c, d, dig, words)): the first h turns of the block's first
    conversation, then the own ones after the first h; h = crc32(c in decimal) mod 4."""
    convs = turns.select("c").distinct().withColumn("h", (F.crc32(F.col("c").cast("string").cast("binary")) % HEADS).cast("int")) \
        .withColumn("b", F.col("c") - F.col("c") % BLOCK)
    first = turns.where(F.col("pos") < HEADS).select(F.col("c").alias("of"), F.col("pos").alias("d"), "dig", "words")
    lent = convs.where("h > 0").join(first, (F.col("b") == F.col("of")) & (F.col("d") <= F.col("h"))).select("c", "d", "dig", "words")
    got = lent.groupBy("c").agg(F.count(F.lit(1)).cast("int").alias("got"))
    place = convs.join(got, "c", "left").select("c", "h", F.coalesce("got", F.lit(0)).alias("got"))
    own = turns.join(place, "c").where("pos > h").select("c", (F.col("got") + F.col("pos") - F.col("h")).alias("d"), "dig", "words")
    return convs.select("c"), lent.unionByName(own)


def prefixes(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(c, d, k1, k2, p1, p2, words) per turn: the key of the prefix that ends there and of the one before."""
    rows = stored(turns.select("c", "d", "words", F.xxhash64(F.lit(1), "d", "dig").alias("l1"), F.xxhash64(F.lit(2), "d", "dig").alias("l2"),
                               F.floor((F.col("d") - 1) / stretch).alias("part")), "rebuilt")
    w = Window.partitionBy("c", "part").orderBy("d")
    local = rows.select("*", *[F.bit_xor(f"l{i}").over(w).alias(f"r{i}") for i in (1, 2)])
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("c", "part").agg(F.bit_xor("l1").alias("t1"), F.bit_xor("l2").alias("t2"))
    before = totals.select("c", "part", *[F.bit_xor(f"t{i}").over(earlier).alias(f"b{i}") for i in (1, 2)]).where("part > 0")
    out = local.join(before, ["c", "part"], "left")
    for i in (1, 2):
        out = out.withColumn(f"k{i}", F.col(f"r{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0).cast("long")))) \
            .withColumn(f"p{i}", F.col(f"k{i}").bitwiseXOR(F.col(f"l{i}")))
    return out.select("c", "d", "k1", "k2", "p1", "p2", "words")


def _tree(pre: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes with their ids and parents; ids ascend by (conv_id, d)."""
    zero = F.lit(0).cast("long")
    inner = pre.groupBy("d", "k1", "k2").agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
                                             F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0") \
        .select(F.lit(0).alias("d"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("words"), none.alias("p1"), none.alias("p2"))
    nodes = stored(inner.unionByName(root).repartitionByRange(_partitions(pre.sparkSession), "conv_id", "d").sortWithinPartitions("conv_id", "d")
                   .withColumn("id", F.monotonically_increasing_id()), "nodes")
    up = nodes.select((F.col("d") + 1).alias("pd"), F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return stored(nodes.join(up, (F.col("d") == F.col("pd")) & (F.col("p1") == F.col("a1")) & (F.col("p2") == F.col("a2")), "left")
                  .drop("pd", "a1", "a2", "p1", "p2"), "tree")


def tour(tree: DataFrame, kids: DataFrame) -> DataFrame:
    """(x, succ, arcs, leaves, saved): the arcs of the Euler tour; succ is null after the last."""
    part = F.shiftright("id", 33)  # the range of ids that a node was numbered in
    rows = tree.select("id", "parent", "n_convs", "words", part.alias("part"))
    near = rows.withColumn("next", F.lead("id").over(Window.partitionBy("parent", "part").orderBy("id")))
    ends = rows.where("parent is not null").groupBy("parent", "part").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    far = ends.select("hi", F.lead("lo").over(Window.partitionBy("parent").orderBy("part")).alias("hop")).where("hop is not null")
    t = near.join(far, F.col("id") == F.col("hi"), "left").join(kids.select("of", "first"), F.col("id") == F.col("of"), "left")
    leaf = F.col("first").isNull()
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    enter = F.struct((F.col("id") * 2).alias("x"), F.when(leaf, F.col("id") * 2 + 1).otherwise(F.col("first") * 2).alias("succ"),
                     one.alias("arcs"), F.when(leaf, one).otherwise(zero).alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    leave = F.struct((F.col("id") * 2 + 1).alias("x"), F.coalesce(F.col("next") * 2, F.col("hop") * 2, F.col("parent") * 2 + 1).alias("succ"),
                     one.alias("arcs"), zero.alias("leaves"), zero.alias("saved"))
    return t.select(F.inline(F.array(enter, leave)))


def contract(x: np.ndarray, succ: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joins elements of a list (or of pieces of it) to their successors among them.

    ``succ`` is -1 at the end, ``w`` one row of weights per element, ``x`` ascends.  Returns head (the
    index of the first element of each element's chain), and for heads the chain's
    successor and sums, for the others (succ -1) the sums from the head to themselves.
    """
    n = len(x)
    at = np.minimum(np.searchsorted(x, succ), n - 1)
    here = x[at] == succ
    head = np.arange(n)
    head[at[here]] = np.flatnonzero(here)
    off = np.where((head != np.arange(n))[:, None], w[head], 0)
    while True:
        further = head[head]
        if (further == head).all():
            break
        off += off[head]
        head = further
    out_succ, out = np.full(n, -1), off.copy()
    tail = np.flatnonzero(~here)
    out_succ[head[tail]] = succ[tail]
    out[head[tail]] = off[tail] + w[tail]
    return head, out_succ, out


def _contracted(dealt: DataFrame) -> DataFrame:
    """Chains within each partition: (x, head, succ, weights); head is null for survivors."""
    names = ["x", "head", "succ", *WEIGHTS]
    ensure_importable(dealt.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).sort_by("x")
        x, succ = t.column("x").to_numpy(), t.column("succ").fill_null(-1).to_numpy()
        head, out, w = contract(x, succ, np.column_stack([t.column(c).to_numpy() for c in WEIGHTS]))
        alive = head == np.arange(len(x))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(x[head], mask=alive), pa.array(out, mask=~alive | (out < 0)), *[pa.array(np.ascontiguousarray(c)) for c in w.T]], names=names)

    return dealt.select("x", "succ", *WEIGHTS).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def list_rank(arcs: DataFrame, per_task: int = PER_TASK, last: int = LAST) -> DataFrame:
    """(x, arcs, leaves, saved): for every element of one list (x >= 0, succ, weights) the sums of the weights before it."""
    spark = arcs.sparkSession
    rounds: list[DataFrame] = []
    left = stored(arcs, "tour")
    n = left.count()
    while not rounds or n > 1:
        parts = _partitions(spark, n, per_task)
        if not rounds:
            dealt = left.repartitionByRange(parts, "x")
        elif n <= last:
            dealt = left.repartition(1)
        else:
            drew = [F.xxhash64(F.lit(len(rounds)), c).bitwiseAND(F.lit(1)) == 1 for c in ("x", "succ")]
            dealt = left.repartition(parts, F.when(~drew[0] & F.coalesce(drew[1], F.lit(False)), F.col("succ")).otherwise(F.col("x")))
        rounds.append(stored(_contracted(dealt), "round"))
        left = rounds[-1].where("head is null").drop("head")
        n = left.count()
    known = left.select("x", *[F.lit(0).cast("long").alias(c) for c in WEIGHTS])
    for k, done in enumerate(reversed(rounds)):
        of = known.select(F.col("x").alias("of"), *[F.col(c).alias(f"of_{c}") for c in WEIGHTS])
        more = done.where("head is not null").join(of, F.col("head") == F.col("of")).select("x", *[(F.col(c) + F.col(f"of_{c}")).alias(c) for c in WEIGHTS])
        known = known.unionByName(more)
        if k + 1 < len(rounds):
            known = stored(known, "ranks")
    return known


def _digests(last: DataFrame) -> DataFrame:
    """(d, k1, k2, ends_sha256) of rows (d, k1, k2, c): ids in ascending order are joined to
    strings of bounded length, which a second pass feeds to the digest one by one."""
    keys = ["d", "k1", "k2"]
    n = _partitions(last.sparkSession)
    ensure_importable(last.sparkSession)

    def starts(batch: pa.RecordBatch) -> list[int]:
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([(c := batch.column(k).to_numpy())[1:] != c[:-1] for k in range(3)], axis=0)
        return np.flatnonzero(new).tolist()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = starts(batch)
            cut = [p for s, e in zip(at, [*at[1:], batch.num_rows]) for p in range(s, e, PIECE)]
            ids = [str(i) for i in batch.column(3).to_pylist()]
            ends = sorted({*at[1:], *cut[1:], batch.num_rows})
            text = [",".join(ids[s:e]) for s, e in zip(cut, ends)]
            yield pa.RecordBatch.from_arrays([c.take(pa.array(cut)) for c in batch.columns] + [pa.array(text)], names=[*keys, "c", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for batch in batches:
            out = []
            for *key, piece in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 4)]):
                if key == now:
                    h.update(b"," + piece.encode())
                    continue
                if now is not None:
                    out.append((*now, h.hexdigest()))
                now, h = key, hashlib.sha256(piece.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, h.hexdigest())], schema=schema)

    schema = pa.schema([("d", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    rows = last.select(F.col("d").cast("int"), "k1", "k2", "c").repartitionByRange(n, *keys, "c").sortWithinPartitions(*keys, "c")
    cut = rows.mapInArrow(pieces, "d int, k1 long, k2 long, c long, piece string")
    return cut.repartition(n, *keys).sortWithinPartitions(*keys, "c").mapInArrow(digest, "d int, k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, stretch: int = STRETCH, per_task: int = PER_TASK, last: int = LAST) -> DataFrame:
    """One row per node of the trie of the conversations ``convs`` (c) with ``turns`` (c, d from 1 without
    gaps, dig: the turn's identity, words); a conversation without turns belongs to the root alone.  No
    conversations: no nodes."""
    pre = stored(prefixes(turns, stretch), "prefixes")
    tree = _tree(pre, convs)
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"), F.min("id").alias("first"))
    ranks = list_rank(tour(tree, kids), per_task, last)
    held = ranks.groupBy(F.shiftright("x", 1).alias("node")).agg(*[(F.max(c) - F.min(c)).alias(c) for c in ("leaves", "saved")])
    zero = F.lit(0).cast("long")
    final = pre.select("c", "d", "k1", "k2").unionAll(convs.select("c", F.lit(0), zero, zero)).groupBy("c").agg(F.max(F.struct("d", "k1", "k2")).alias("at"))
    ends = _digests(final.select("at.*", "c")).select(*[F.col(c).alias(f"e_{c}") for c in ("d", "k1", "k2")], "ends_sha256")
    same = (F.col("d") == F.col("e_d")) & (F.col("k1") == F.col("e_k1")) & (F.col("k2") == F.col("e_k2"))
    return tree.join(held, F.col("id") == F.col("node")).join(kids, F.col("id") == F.col("of"), "left").join(ends, same, "left") \
        .select("conv_id", F.col("d").cast("long").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of all rebuilt conversations, one row per node.

    Defined results: null roles and texts are empty; turns with equal numbers, null first, follow by the
    digest of role and text; repeated rows are turns of their own; a null conversation id belongs to
    none; an empty table gives no node; other columns are ignored.
    """
    turns = stored(numbered_turns(conversations, conv, turn, role, text), "turns")
    convs, rebuilt = rebuilt_turns(turns)
    return prefix_trie(rebuilt, stored(convs, "convs"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: CRC-32 bit by bit, paths as strings of digests, subtrees by joining every node to its ancestors.
ORACLE = r"""
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ord(substr(c::VARCHAR, i::INT, 1))::BIGINT)),
          lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::BIGINT) AS u FROM ids),
h AS (SELECT c, c - c % 20 AS b, u % 4 AS h FROM crc),
num AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || coalesce(text, ''))) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
reb AS (SELECT h.c, 0 AS own, pos, r, t FROM h JOIN num ON num.c = h.b AND pos <= h UNION ALL
        SELECT h.c, 1, pos, r, t FROM h JOIN num ON num.c = h.c AND pos > h),
seq AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, r, t FROM reb),
pre AS (SELECT c, d, string_agg(md5(r) || md5(t), '') OVER (PARTITION BY c ORDER BY d) AS path, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words FROM seq
        UNION ALL SELECT c, 0, '', 0 FROM ids),
node AS (SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, min(words) AS words FROM pre GROUP BY d, path),
place AS (SELECT c, d, conv_id AS m, path FROM pre JOIN node USING (d, path)),
kid AS (SELECT n.d, n.conv_id, p.m AS parent_conv_id FROM node n JOIN place p ON p.c = n.conv_id AND p.d = n.d - 1),
kids AS (SELECT d - 1 AS d, parent_conv_id AS m, count(*) AS n FROM kid GROUP BY 1, 2),
sub AS (SELECT p.d, p.m, count(*) FILTER (WHERE kids.n IS NULL) AS leaves, sum((n_convs - 1) * words) AS saved
        FROM node JOIN place p ON p.c = node.conv_id AND p.d <= node.d LEFT JOIN kids ON kids.d = node.d AND kids.m = node.conv_id GROUP BY 1, 2),
ends AS (SELECT d, m, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT * FROM place QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY 1, 2)
SELECT node.conv_id, node.d::BIGINT AS depth, kid.parent_conv_id, n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node JOIN sub ON sub.d = node.d AND sub.m = node.conv_id LEFT JOIN kid ON kid.d = node.d AND kid.conv_id = node.conv_id
LEFT JOIN kids ON kids.d = node.d AND kids.m = node.conv_id LEFT JOIN ends ON ends.d = node.d AND ends.m = node.conv_id
"""
