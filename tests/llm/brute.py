"""Small tables and brute-force versions for the tests of the corpus operators."""

from __future__ import annotations

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string, score string, fp string, id int, body int, marks int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (id, text) -> documents with further columns, some named like results."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, -1, "x", "y", "z", 7, 8, 9) for i, t in rows], DOC)

    return make


def words_of(text):
    return (text or "").encode().split()


def brute_repeats(rows, window=50):
    """[(id, n_words, n_removed, kept)] by comparing all windows."""
    first = {}
    for i, t in rows:
        w = words_of(t)
        if i is not None:
            for p in range(len(w) - window + 1):
                key = tuple(w[p:p + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        if i is not None:
            for p in range(len(w) - window + 1):
                if first[tuple(w[p:p + window])] < i:
                    gone[p:p + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return out


def brute_fingerprint(text):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words_of(low)
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, linked):
    """Smallest member by transitive closure over all pairs."""
    comp = {n: {n} for n in nodes}
    for a in nodes:
        for b in nodes:
            if a != b and linked(a, b) and comp[a] is not comp[b]:
                joined = comp[a] | comp[b]
                for x in joined:
                    comp[x] = joined
    return comp


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{k}" for k in rng.integers(0, vocabulary, n))


def speech(rng, n):
    """Words of syllables, as prose has them."""
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it"]
    return " ".join("".join(parts[k] for k in rng.integers(0, 20, int(rng.integers(1, 5)))) for _ in range(n))
