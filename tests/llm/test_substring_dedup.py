import numpy as np

from gtfsforge.llm import substring_dedup as sub

from brute import docs_of, brute_repeats, prose, words_of


def _rows(rng):
    passage = prose(rng, 70)
    rows = [(i, prose(rng, int(rng.integers(0, 150)))) for i in range(100, 130)]
    rows += [(i, f"{prose(rng, 20)} {passage} {prose(rng, 30)}") for i in range(130, 150)]
    rows += [(151, rows[0][1]), (90, rows[5][1]), (152, passage), (153, "a b " * 200), (154, "a b " * 120), (155, " ".join(["same"] * 400)),
             (156, prose(rng, 49)), (157, None), (158, ""), (159, passage.replace(" ", " \n\t ")), (None, passage), (160, passage + " é x"),
             (161, rows[31][1]), (161, rows[31][1]), (161, rows[32][1] + " tail")]
    return rows


def _got(df):
    return sorted((str(r.row.doc_id), r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_against_all_windows(docs_of):
    rows = _rows(np.random.default_rng(1))
    want = sorted((str(i), n, k, t) for i, n, k, t in brute_repeats(rows))
    assert sum(k > 0 for _, _, k, _ in want) > 20
    assert _got(sub.remove_repeats(docs_of(rows))) == want
    # every bucket of more than one string cut again by further minimisers, then window by window
    assert _got(sub.remove_repeats(docs_of(rows), long=0)) == want
    # some of them
    assert _got(sub.remove_repeats(docs_of(rows), long=60)) == want


def test_short_windows_and_empty_tables(docs_of):
    rng = np.random.default_rng(2)
    rows = [(i, prose(rng, 30, 6)) for i in range(40)]
    want = sorted((str(i), n, k, t) for i, n, k, t in brute_repeats(rows, 5))
    assert _got(sub.remove_repeats(docs_of(rows), window=5, gram=3)) == want
    assert sub.remove_repeats(docs_of([])).count() == 0


def test_whole_rows_travel_along(docs_of):
    df = docs_of([(1, "a b")])
    assert sub.remove_repeats(df).select("row.*").columns == df.columns


def test_super_kmers_tile_the_windows():
    w = words_of(prose(np.random.default_rng(3), 500))
    mins, first = sub.super_kmers(w)
    assert first[0] == 0 and (np.diff(first) > 0).all() and len(mins) == len(first)
    # equal windows get equal minimisers wherever they stand
    again, first2 = sub.super_kmers(words_of(prose(np.random.default_rng(4), 77)) + w)
    at = {int(p): m for p, m in zip(range(451), np.repeat(mins, np.diff([*first, 451])))}
    of = np.repeat(again, np.diff([*first2, 528]))
    assert all(of[p + 77] == m for p, m in at.items())


def test_sliding_min():
    a = np.random.default_rng(5).integers(0, 100, 60)
    for k in (1, 2, 3, 7, 8, 43, 60):
        assert sub.sliding_min(a, k).tolist() == [min(a[i:i + k]) for i in range(61 - k)]


def test_sorting_in_parts_gives_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = []
    for m in range(60):
        words = words_of(prose(rng, 56, 30))
        for doc in rng.integers(0, 9, int(rng.integers(1, 6))).tolist():
            k = int(rng.integers(0, 5))
            rows.append((m, doc, 1, 1, k, 7 - k, bytearray(b" ".join(words[k:]))))
    df = spark.createDataFrame(rows, "min long, id long, h1 long, h2 long, pos int, n int, packed binary")
    whole = sorted(map(tuple, sub._sorted_windows(df, 50).collect()))
    first = {}
    for m, doc, _, _, pos, n, _ in rows:
        for p in range(pos, pos + n):
            first[m, p] = min(first.get((m, p), 99), doc)
    want = sorted((doc, p, first[m, p] < doc) for m, doc, _, _, pos, n, _ in rows for p in range(pos, pos + n))
    got = [(doc, p) for doc, _, _, pos, n in whole for p in range(pos, pos + n)]
    assert sorted(got) == [(d, p) for d, p, gone in want if gone]
    for at_once in (1, 10, 60):
        assert sorted(map(tuple, sub._sorted_windows(df, 50, at_once).collect())) == whole


def test_a_frequent_passage_is_spread_by_further_minimisers(spark, docs_of):
    """Buckets around one passage of many documents shrink with every order; equal strings travel once."""
    rng = np.random.default_rng(8)
    passage = prose(rng, 90)
    rows = [(i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(120)]
    want = sorted((str(i), n, k, t) for i, n, k, t in brute_repeats(rows))
    assert _got(sub.remove_repeats(docs_of(rows), long=50)) == want
    words = [words_of(t) for _, t in rows]
    sizes = []
    for order in range(3):  # windows of the largest bucket under one, two and three minimisers
        keys = [tuple(np.repeat(m, np.diff([*f, len(w) - 49])) for m, f in (sub.super_kmers(w, order=o) for o in range(order + 1))) for w in words]
        counts = {}
        for w, k in zip(words, keys):
            for p, key in enumerate(zip(*(x.tolist() for x in k))):
                counts.setdefault(key, set()).add(b" ".join(w[p:p + 50]))
        sizes.append(max(map(len, counts.values())))
    assert sizes[0] > sizes[1] > sizes[2]
