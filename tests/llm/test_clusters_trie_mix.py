"""Centroid clustering, the conversation trie and source mixing against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gtfsforge.llm import centroid_clustering as C
from gtfsforge.llm import conversation_trie as T
from gtfsforge.llm import source_mixing as M

from brute import SF_SMALL, words_of


# -- centroid clustering


def brute_clusters(rows, clusters, rounds, scale=64):
    kept = [(i, [int(np.floor(scale * float(x))) for x in e]) for i, e in rows]
    start = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), e) for i, e in kept if i is not None))[:clusters]
    cents = [e for _, e in start]

    def near(e):
        return min((sum((a - b) ** 2 for a, b in zip(e, c)), k) for k, c in enumerate(cents))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, e in kept:
            groups[near(e)[1]].append(e)
        cents = [[sum(col) // len(groups[k]) for col in zip(*groups[k])] if groups[k] else c for k, c in enumerate(cents)]
    out = [(i, *near(e)) for i, e in kept]
    inertia = Counter()
    for _, d, k in out:
        inertia[k] += d
    return sorted((str(i), k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()) for i, d, k in out)


def test_search_is_exact_and_rejects():
    rng = np.random.default_rng(3)
    middles = rng.integers(-40, 40, (200, 1)) + rng.integers(-9, 9, (200, 16))
    cents = np.vstack([middles, middles[:20]])  # equal centroids: the smaller number wins
    x = cents[rng.integers(0, 220, 3000)] + rng.integers(-2, 3, (3000, 16))
    who, dist, computed = C.Centroids(cents).search(x)
    full = ((x[:, None] - cents[None]) ** 2).sum(axis=2)
    assert (dist == full.min(axis=1)).all() and (who == full.argmin(axis=1)).all()
    assert computed < 0.2 * full.size


@pytest.mark.parametrize("shift", [0, 1 << 25])
def test_search_of_large_integers(shift):
    rng = np.random.default_rng(4)
    cents = shift + rng.integers(-3, 4, (30, 64))
    x = shift + rng.integers(-3, 4, (300, 64))
    who, dist, _ = C.Centroids(cents).search(x)
    full = ((x[:, None] - cents[None]) ** 2).sum(axis=2)
    assert (dist == full.min(axis=1)).all() and (who == full.argmin(axis=1)).all()


def test_clusters_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(k, [float(v) for v in rng.normal(k % 3, 0.3, 4)]) for k in range(60)]
    good += [(3, good[3][1]), (3, good[4][1]), (None, good[5][1]), (70, [0.0, -0.0, -1e-9, 1e5])]
    bad = [(80, None), (81, []), (82, [1.0, 2.0, 3.0]), (83, [1.0, None, 1.0, 1.0]), (84, [1.0, float("nan"), 1.0, 1.0]), (85, [float("inf")] * 4), (86, [1e300] * 4)]
    df = spark.createDataFrame([(i, e, 1, "x", 5) for i, e in good + bad], "vec_id long, embedding array<double>, cluster int, distance string, n int")
    got = sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in C.cluster(df, 5, 3, 4).collect())
    assert got == brute_clusters(good, 5, 3)
    few = C.cluster(df.where("vec_id in (1, 2)"), 5, 2, 4)
    assert {r.cluster for r in few.collect()} == {0, 1}
    assert C.cluster(df.limit(0), 5, 3, 4).collect() == [] and C.cluster(df.where("vec_id >= 80"), 5, 3, 4).collect() == []
    assert C.cluster(df.limit(0), 5, 3, 4).dtypes == few.dtypes


# -- conversation trie


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            key = hashlib.md5((hashlib.md5(r.encode()).hexdigest() + x).encode()).hexdigest()
            turns[c].append(((t is not None, t or 0, key), (r, x)))
    turns = {c: [v for _, v in sorted(t)] for c, t in turns.items()}
    full = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]  # the remainder has the sign of c, as in SQL
    nodes = defaultdict(list)
    for c, s in full.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    held = {}
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * (len(words_of(p[-1][1])) if p else 0)
        held[p] = (sum(held[k][0] for k in kids[p]) or 1, own + sum(held[k][1] for k in kids[p]))
    out = []
    for p, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(full[c]) == len(p)))
        out.append((min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), len(kids[p]), *held[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for c in range(130):
        if c in (40, 61):  # a base conversation that is absent, and an id without turns of its own
            continue
        rows += [(c, t, ("user", "assistant")[t % 2], f"said {rng.integers(0, 2)} w" + " w" * t) for t in range(int(rng.integers(0, 6)))]
    rows += [(200 + k, 0, "user", "same first words") for k in range(50)]
    rows += [(300, None, None, None), (300, None, "user", "a"), (300, 1, "", "x" * 5000), (300, 1, "", "x" * 5000), (300, 1, "user", ""), (None, 0, "user", "nobody")]
    rows += [(-5, 0, "user", "minus"), (-20, 0, "user", "minus"), (400, 0, "user", "hi"), *[(400, t, "user", f"turn {t}") for t in range(1, 60)]]
    df = spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], "conv_id long, turn long, role string, text string, id int, k1 string, c int, n_convs int")
    got = sorted((tuple(r[c] for c in TRIE) for r in T.conversation_trie(df).collect()), key=str)
    assert got == brute_trie(rows)
    assert T.conversation_trie(df.limit(0)).collect() == []


def test_trie_in_stretches_and_many_rounds(spark):
    """Small stretches, tasks and last rounds: the paths that long conversations and large tries take."""
    rng = np.random.default_rng(7)
    talks = [[int(v) for v in rng.integers(0, 2, int(rng.integers(0, 9)))] for _ in range(150)] + [[0] * 40, [0] * 41, [1] * 30 + [0] * 9]
    turns = [(c, d, f"{v}", 2) for c, t in enumerate(talks) for d, v in enumerate(t, 1)]
    df = spark.createDataFrame(turns, "c long, d int, dig string, words long")
    convs = spark.createDataFrame([(c,) for c in range(len(talks))], "c long")
    got = sorted((r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in T.prefix_trie(df, convs, stretch=4, per_task=16, last=8).collect())
    nodes = defaultdict(list)
    for c, t in enumerate(talks):
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    want = []
    for p, cs in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        kids = {q for q in below if len(q) == len(p) + 1}
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below)]
        want.append((min(cs), len(p), len(cs), len(kids), len(leaves), sum((len(nodes[q]) - 1) * 2 for q in below if q)))
    assert got == sorted(want)


def test_ranks_are_the_tour(spark):
    n = 500
    order = np.random.default_rng(8).permutation(n)
    succ = {int(a): int(b) for a, b in zip(order[:-1], order[1:])}
    arcs = spark.createDataFrame([(x, succ.get(x), 1, x % 3, x) for x in range(n)], "x long, succ long, arcs long, leaves long, saved long")
    got = {r.x: (r.arcs, r.leaves, r.saved) for r in T.list_rank(arcs, per_task=64, last=32).collect()}
    at, sums = {int(x): k for k, x in enumerate(order)}, np.cumsum([0, *order])
    assert len(got) == n and all(got[x][0] == at[x] and got[x][2] == sums[at[x]] for x in range(n))


# -- mixing sources


def brute_targets(totals, weights=(5, 2, 1), most=3):
    names = sorted((s for s in totals if s is not None)) + [None] * (None in totals)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    whole, at_bound = sum(totals.values()), set()
    while True:
        free = sum(w[s] for s in names if s not in at_bound)
        level = (whole - sum(most * totals[s] for s in at_bound)) / free if free else 0
        more = {s for s in names if s not in at_bound and most * totals[s] <= level * w[s]}
        if not more:
            return {s: float(most * totals[s]) if s in at_bound else level * w[s] for s in names}
        at_bound |= more


def check_mix(rows, got, most=3):
    totals, sizes = Counter(), [len(words_of(t)) for _, t, _ in rows]
    for n, (_, _, s) in zip(sizes, rows):
        totals[s] += n
    want = brute_targets(totals, most=most)
    assert Counter((i, n, totals[s]) for n, (i, _, s) in zip(sizes, rows)) == Counter((r.doc_id, r["size"], r.source_size) for r in got)
    taken = Counter()
    by_key = defaultdict(set)
    for (i, t, s), n in zip(rows, sizes):
        by_key[(i, n, totals[s])].add(s)
    for r in got:
        assert 0 <= r.taken <= most * r["size"]
        names = by_key[(r.doc_id, r["size"], r.source_size)]
        s = next(s for s in names if abs(want[s] - r.target) <= 1e-6 * max(1, want[s]))
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1, (s, taken[s], t)


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(11)
    rows = [(k, "w " * int(rng.integers(0, 300)), f"s{k % 7}") for k in range(400)]
    rows += [(500 + k, "same words here", "hot") for k in range(200)] + [(800, "a b", "tiny"), (801, "w " * 9000, "z long"), (802, None, "none"), (803, "", "none")]
    rows += [(900, "no source \t\n at all", None), (None, "null id", "s1"), (None, "null id", "s1"), (901, "é ünï x", "ß")]
    df = spark.createDataFrame([(i, t, s, 1, "x", 2) for i, t, s in rows], "doc_id long, text string, source string, size int, target string, n int")
    out = M.mix(df)
    got = out.collect()
    check_mix(rows, got)
    assert Counter(got) == Counter(M.mix(df.repartition(3)).collect())  # reruns agree, whatever the partitions
    assert M.mix(df.limit(0)).collect() == []
    assert {r.taken for r in M.mix(df.where("source = 'none'")).collect()} == {0}


def test_rates_are_the_dual_solution(spark):
    """Rates fall on one exponential per source, and their words on the target."""
    rng = np.random.default_rng(12)
    rows = [(s, int(n)) for s in ("a", "b", "c") for n in rng.integers(1, 500, 200)]
    counts = spark.createDataFrame(rows, "source string, size long").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    for r in M.multipliers(counts, M.targets(counts)).collect():
        n = np.array([k for s, k in rows if s == r.source])
        rate = np.minimum(3, np.exp(r.lam * n / n.mean()))
        assert abs((n * rate).sum() - r.target) < 1 and r.n == len(n) and (r.lam > 0) == (r.target > n.sum())


def test_given_tables_meet_targets(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check_mix([(r.doc_id, r.text, r.source) for r in docs.collect()], M.op13_source_mixing(spark, SF_SMALL).collect())
