"""Registered corpus queries: oracles where SQL has them, and the pipeline's stages."""

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from gtfsforge.llm import catalog
from gtfsforge.llm.frames import stored
from gtfsforge.plans.verify import compare, duck_connect

from brute import SF_SMALL, docs_of, brute_components, brute_fingerprint, brute_repeats, speech


def test_all_are_registered():
    names = set(E.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "SimHash near-dedup", "substring dedup", "packing"]


@pytest.mark.parametrize("name", [n for n, (_, sql) in catalog.QUERIES.items() if sql])
def test_oracles(spark, name):
    fn, sql = catalog.QUERIES[name]
    r = compare(fn(spark, SF_SMALL), sql, duck_connect(SF_SMALL))
    assert r["ok"], {k: r.get(k) for k in ("spark_cols", "duck_cols", "only_spark", "only_duck")}


def _table(docs):
    return sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)


def test_stages_against_brute_force(spark, docs_of):
    rng = np.random.default_rng(9)
    passage = speech(rng, 60)
    rows = [(k, speech(rng, 120)) for k in range(30)] + [(40 + k, f"{speech(rng, 60)} {passage} {speech(rng, 40)}") for k in range(4)]
    rows += [(60, rows[3][1]), (61, rows[3][1] + " tail"), (62, "short"), (63, None), (64, "a b " * 100)]
    docs = docs_of(rows)
    docs = stored(corpus_pipeline.apply_rules(spark, docs, SF_SMALL), "t")
    left = [r for r in rows if r[0] < 62]
    assert _table(docs) == sorted(left, key=str)
    docs = stored(corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL), "t")
    fp = {i: brute_fingerprint(t) for i, t in left}
    comp = brute_components(list(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    left = [(i, t) for i, t in left if min(comp[i]) == i]
    assert _table(docs) == sorted(left, key=str)
    before = docs.columns
    docs = stored(corpus_pipeline.cut_repeats(spark, docs, SF_SMALL), "t")
    want = {i: k if gone else dict(left)[i] for i, _, gone, k in brute_repeats(left)}
    assert _table(docs) == sorted(want.items(), key=str) and docs.columns == before
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    pieces = corpus_pipeline.pack(spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == set(want)
    for i in want:
        own = [r for r in pieces if r.doc_id == i]
        assert sum(r.length for r in own) == own[0].doc_tokens


def test_pipeline_on_small_and_empty_tables(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert ids <= {r.doc_id for r in docs.collect()}
    assert np.mean([labels[i] for i in ids if i in labels]) > 0.9
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_SMALL)
        assert empty.count() == 0, name


def test_remainder_of_the_library_does_not_need_the_subpackage():
    import pathlib

    root = pathlib.Path(E.__file__).parent / "gtfsforge"
    users = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and ".llm" in p.read_text()]
    assert users == []
