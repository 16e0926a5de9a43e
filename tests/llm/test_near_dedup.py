"""Embedding and SimHash near-dedup against all pairs."""

from itertools import combinations

import numpy as np

from gtfsforge.llm import blocks, components, embedding_near_dedup as emb, simhash_near_dedup as sim

from brute import docs_of, brute_components, brute_fingerprint, prose


def test_components_of_a_long_path_a_star_and_loops(spark):
    rng = np.random.default_rng(1)
    name = rng.permutation(3000)
    edges = [(int(name[k]), int(name[k + 1])) for k in range(500)]  # a path
    edges += [(int(name[600]), int(name[k])) for k in range(601, 2000)]  # a hub
    edges += [(int(name[2500]), int(name[2500])), *edges[:50]]  # a loop, repeats
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {int(name[k]): int(min(name[:501])) for k in range(501)}
    want |= {int(name[k]): int(min(name[600:2000])) for k in range(600, 2000)}
    assert got == want | {int(name[2500]): int(name[2500])}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_forest_keeps_components():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    node, low = blocks.forest(300, a, b)
    comp = brute_components(range(300), lambda x, y, e=set(zip(a.tolist(), b.tolist())): (x, y) in e or (y, x) in e)
    got = dict(zip(node.tolist(), low.tolist()))
    assert all(got.get(x, x) == min(comp[x]) for x in range(300))


def test_any_four_positions_hold_a_triple():
    t = sim.position_triples()
    assert len(t) == 20
    assert all(any(set(x) <= set(q) for x in t) for q in combinations(range(8), 4))


def test_fingerprint_is_the_definition():
    rng = np.random.default_rng(4)
    for text in ["", " \n\t", "a", "A b", "a b c d", "a b c d e", "É É é", "a b " * 40, prose(rng, 300), "x y\x1cz\x0bq"]:
        assert sim.fingerprint(text) % (1 << 64) == brute_fingerprint(text), text


def test_simhash_groups_against_all_pairs(docs_of):
    rng = np.random.default_rng(5)
    rows, i = [], 10
    for _ in range(40):
        base = prose(rng, int(rng.integers(3, 400))).split()
        for _ in range(int(rng.integers(1, 5))):
            w = list(base)
            if rng.random() < 0.7:
                w[int(rng.integers(len(w)))] = "changed"
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(5, ""), (6, None), (7, " \n"), (9, rows[0][1]), (9, rows[0][1]), (None, rows[3][1])]
    got = sim.simhash_groups(docs_of(rows)).collect()
    assert len(got) == len(rows)
    fps = {t or "": brute_fingerprint(t) for _, t in rows}
    comp = brute_components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    ids: dict = {}
    for d, t in rows:
        if d is not None:
            ids.setdefault(fps[t or ""], []).append(d)
    want = sorted((str(d), fps[t or ""], min(x for f in comp[fps[t or ""]] for x in ids.get(f, []))) for d, t in rows)
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == want


def test_long_posting_lists_are_split_without_losing_links(spark):
    rng = np.random.default_rng(6)
    center = int(rng.integers(1 << 62))
    fps = {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (400, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 300)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    comp = brute_components(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    got = {r.node: r.component for r in components.components(sim.links(df, block=16)).collect()}
    assert {f: got.get(f, f) for f in fps} == {f: min(comp[f]) for f in fps}


def test_one_document_of_each_group_stays(docs_of):
    rows = [(4, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (9, "other words in this text"), (None, "no id here")]
    out = sim.one_per_group(docs_of(rows))
    assert sorted((r.doc_id or -1) for r in out.collect()) == [-1, 2, 9]
    assert out.columns == docs_of(rows).columns
    assert sim.one_per_group(docs_of([])).count() == 0


def test_one_row_of_each_group_stays_with_shared_and_null_ids(docs_of):
    rng = np.random.default_rng(10)
    a, b, c, d, e = (prose(rng, 200) for _ in range(5))
    rows = [(1, a), (1, b), (2, b), (3, c), (3, d), (2, d), *[(None, e)] * 40, (None, a), (None, d), (4, ""), (None, None), (None, " ")]
    assert len({brute_fingerprint(t) for t in (a, b, c, d, e)}) == 5
    want = sorted([(1, a), (1, b), (3, c), (2, d), (None, e), (4, "")], key=str)
    for k in (1, 7):
        out = sim.one_per_group(docs_of(rows).repartition(k))
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == want
        assert out.columns == docs_of(rows).columns


def test_one_of_rows_that_differ_in_other_columns_is_always_the_same(docs_of):
    rows = docs_of([(1, "a b c d e")] * 2 + [(None, "other words in this text")] * 2)
    rows = rows.drop("source").crossJoin(rows.sparkSession.createDataFrame([(f"s{k}",) for k in range(9)], "source string"))
    got = [sorted((str(r.doc_id), r.source) for r in sim.one_per_group(rows.repartition(k)).collect()) for k in (1, 5, 8)]
    assert len(got[0]) == 2 and got[0] == got[1] == got[2]


def _brute_vectors(rows, threshold=0.98):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        return x / np.linalg.norm(x)

    u = [unit(v) if i is not None and lab is not None else None for i, v, lab in rows]

    def linked(a, b):
        return u[a] is not None and u[b] is not None and rows[a][2] == rows[b][2] and len(u[a]) == len(u[b]) and float(u[a] @ u[b]) >= threshold

    n = len(rows)
    links = [sum(linked(a, b) for b in range(n) if b != a) for a in range(n)]
    comp = brute_components(range(n), linked)
    out = []
    for a, (i, _, _) in enumerate(rows):
        low = None if i is None else min(rows[b][0] for b in comp[a])
        out.append((str(i), links[a], str(low), i is not None and i == low))
    return sorted(out)


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(7)
    rows, i = [], 100
    for k in range(60):
        base = rng.standard_normal(16).astype(np.float32)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((i, [float(x) for x in (base + rng.standard_normal(16) * 0.12).astype(np.float32)], int(k % 3)))
            i += 1
    first = rows[0]
    rows += [(1, first[1], first[2]), (1, first[1], first[2]), (2, [2 * x for x in first[1]], first[2]), (3, first[1], None), (None, first[1], first[2]),
             (4, None, 1), (5, [], 1), (6, [0.0] * 16, 1), (7, [float("nan")] + [1.0] * 15, 1), (8, [float("inf")] + [1.0] * 15, 1),
             (9, [None] + [1.0] * 15, 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.01, 0.0], 1), (12, [1.0, 0.01, 0.0, 0.0], 1), (13, first[1], first[2] + 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, weight int")
    for block in (1024, 4):
        got = emb.near_duplicates(df, block=block).collect()
        assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == _brute_vectors(rows)
    assert emb.near_duplicates(df.limit(0)).count() == 0


def test_hashing_misses_next_to_nothing():
    rng = np.random.default_rng(8)
    x = emb.unit(rng.standard_normal((4000, 64)))
    g = rng.standard_normal((4000, 64))
    g -= (g * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * emb.unit(g)
    a, b = emb.buckets(x), emb.buckets(y)
    met = (a == b[:, :, :1]).any(axis=2) | (b == a[:, :, :1]).any(axis=2)
    assert met.mean() > 0.94  # one table
    assert met.any(axis=1).all()  # all tables


def test_rows_that_share_an_id_are_vectors_of_their_own(spark):
    """Counted and linked by label and vector, as a comparison of all rows does."""
    rng = np.random.default_rng(21)
    base = rng.normal(size=(3, 16))
    near = lambda k: (base[k] + rng.normal(size=16) * 0.01).tolist()
    rows = [(1, near(0), 0), (1, near(0), 0), (2, near(0), 0), (5, near(1), 0), (5, near(1), 1), (6, near(1), 0), (7, near(1), 1), (3, near(1), 1), (9, near(2), 0), (9, near(2), 0)]
    rows += [rows[0], (4, rows[0][1], 0), (None, near(0), 0), (8, near(2), None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    unit = [np.array(e) / np.linalg.norm(e) for _, e, _ in rows]
    ok = [i is not None and lab is not None for i, _, lab in rows]
    link = [[a != b and ok[a] and ok[b] and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= 0.98 for b in range(len(rows))] for a in range(len(rows))]
    want = []
    for a, (i, _, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            x = todo.pop()
            todo += [b for b in range(len(rows)) if link[x][b] and b not in seen]
            seen |= set(todo)
        want.append((str(i), sum(link[a]), min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)))
    got = emb.near_duplicates(df).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got) == sorted(want)
    assert [w[1] for w in want[:3]] == [4, 4, 4]
