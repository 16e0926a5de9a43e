"""Encoders, token counts and packing against the public libraries."""

import os
import random
import zlib

import numpy as np
import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer, models, pre_tokenizers  # noqa: E402

from gtfsforge.llm import bpe, packing, token_counts  # noqa: E402

from brute import docs_of  # noqa: E402, F401

ODD = ["", "a", " ", "  \n\n a", "x" * 5000, "ab" * 3000, " " * 3000, "<|endoftext|>a <|endoftext|><|endoftext|> b", "<|endoftext", "日本語 テスト 한국어 русский 😀👍🏽 é ñ ß x y\x85z",
       "can't we'll I'D it's'", "\x00\x01\x1c\x1d\x1e\x1f a", "ﬁ Ⅷ ² ½ ٣", "<s> </s> <0x0A> <unk> ▁▁ ▁a a▁b", "aaaa aaaaaaaa", "the the  the\tthe"]


def _texts(n=1500):
    rnd = random.Random(5)
    common = "abcdeth inonerst  \n'1290.,!é日😀"
    ranges = [(0, 0x7F), (0x80, 0x2FFF), (0x3000, 0xD7FF), (0x10000, 0x1FFFF)]
    out = ["".join(rnd.choice(common) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return ODD + out + ["".join(chr(rnd.randint(*rnd.choice(ranges))) for _ in range(30)) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_ids_and_texts_are_the_librarys(library):
    v = bpe.vocabulary()
    texts = _texts()
    want = library.encode_batch(texts, add_special_tokens=False)
    got = [np.frombuffer(v.encode(t), np.int32) for t in texts]
    assert [g.tolist() for g in got] == [w.ids for w in want]
    assert v.decode(np.concatenate(got), np.cumsum([len(g) for g in got])) == library.decode_batch([w.ids for w in want], skip_special_tokens=False) == texts


def test_every_token_is_its_own_encoding():
    v = bpe.vocabulary()
    assert all(v.encode_word(v.token[i]) == [i] for i in range(50256))


def test_decoding_broken_utf8(library):
    v = bpe.vocabulary()
    ids = [np.array(x, np.int32) for x in ([220, 128], [160], [], [50256, 64, 200, 255], [98, 240, 100])]
    assert v.decode(np.concatenate(ids), np.cumsum([len(i) for i in ids])) == library.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)


def test_bpe_columns(docs_of, library):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "é <|endoftext|>")]
    out = bpe.decode(bpe.encode(docs_of(rows))).collect()
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in out) == sorted((str(i), library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows)
    assert bpe.decode(bpe.encode(docs_of([]))).count() == 0


def test_token_counts_are_the_unigram_models(docs_of):
    pieces = token_counts.read_pieces()
    for vocab, by_bytes in ((pieces, True), ([(p, s) for p, s in pieces if not p.startswith("<0x")], False),
                            ([("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("b", -1.5), ("ab", -2.5), ("▁", -1.0), ("▁a", -2.0)], False)):
        lib = Tokenizer(models.Unigram(vocab, 0, by_bytes))
        lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        counter = token_counts.PieceCounter(vocab)
        texts = _texts(800)
        assert [counter.text(t) for t in texts] == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "é")]
    counter = token_counts.PieceCounter(pieces)
    got = token_counts.token_counts(docs_of(rows))
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == sorted((str(i), counter.text(t or "")) for i, t in rows)
    assert token_counts.token_counts(docs_of([])).count() == 0


def test_packing_encoder_is_the_librarys(library):
    ids = packing.encoder()
    texts = _texts()
    assert [ids(t).tolist() for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    run = " " * 1_100_000  # too long for the rank encoder
    assert ids(run).tolist() == library.encode(run, add_special_tokens=False).ids


def _check_pieces(pieces, tokens, window):
    """pieces: (key, start, ids, doc_tokens, sequence, offset); tokens: key -> ids."""
    of, seq = {}, {}
    for key, start, ids, n, s, at in pieces:
        assert len(ids) and n == len(tokens[key])
        of.setdefault(key, []).append((start, list(ids)))
        seq.setdefault(s, []).append((at, len(ids)))
    assert {k: [t for _, part in sorted(v) for t in part] for k, v in of.items()} == {k: list(t) for k, t in tokens.items()}
    lengths = []
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window and at & (at - 1) == 0  # full, or a smaller power of two
        lengths.append(at)
    return lengths


@pytest.mark.parametrize("window,n", [(64, 300), (64, 7), (2048, 1500), (2, 20), (64, 0)])
def test_packer(window, n):
    rnd = np.random.default_rng(window + n)
    tokens = {k: rnd.integers(0, 50000, int(rnd.integers(1, 3 * window))).astype("<u4") for k in range(n)}
    p = packing.Packer(window, first_sequence=100)
    pieces = [x[:6] for k, t in tokens.items() for x in p.add(k, t)] + [x[:6] for x in p.finish()]
    lengths = _check_pieces(pieces, tokens, window)
    total = sum(map(len, tokens.values()))
    assert sum(lengths) == total and sum(x == window for x in lengths) == total // window
    # most documents that fit into a window stay in one piece
    if window == 2048:
        small = [k for k, t in tokens.items() if len(t) < window]
        assert sum(1 for x in pieces if x[0] in small) < 1.5 * len(small)


def test_sum_of_squares_choice():
    p = packing.Packer(16)
    rnd = np.random.default_rng(1)
    for k in range(400):
        size = int(rnd.integers(1, 16))
        before = p.count.copy()
        costs = {}
        for level in [0, *np.flatnonzero(before[:16 - size + 1])]:
            c = before.copy()
            c[level] -= level > 0
            c[level + size] += level + size < 16
            costs[int(level)] = int((c * c).sum())
        level = p._level(size)
        assert costs[level] == min(costs.values())
        list(p.add(k, np.zeros(size, "<u4")))
        assert [len(w) for w in p.open] == p.count.tolist()


def test_packing_columns(docs_of, library):
    rows = [(k, "word " * k) for k in range(60)] + [(100, None), (101, ""), (102, "x y " * 5000)]
    out = packing.piece_digests(packing.pack(docs_of(rows).repartition(3), window=128)).collect()
    tokens = {k: library.encode(t or "", add_special_tokens=False).ids + [1] for k, t in rows}
    for r in out:
        part = np.array(tokens[r.doc_id][r.start:r.start + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and r.length == len(part)
    lengths = _check_pieces([(r.doc_id, r.start, tokens[r.doc_id][r.start:r.start + r.length], r.doc_tokens, r.sequence_id, r.offset) for r in out], tokens, 128)
    assert sum(lengths) == sum(map(len, tokens.values()))
    # repeated rows are documents of their own; an empty table has no pieces
    again = packing.pack(docs_of([(1, "a"), (1, "a"), (None, "b")])).collect()
    assert sorted((str(r.doc_id), r.length) for r in again) == [("1", 2), ("1", 2), ("None", 2)]
    assert packing.pack(docs_of([])).count() == 0


@pytest.mark.parametrize("partitions", [1, 16])
def test_most_ids_lie_where_the_rule_puts_them(spark, partitions):
    """Of the ids that are no whole window of a document, however the input is partitioned."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(partitions)
    pieces = packing.pack(docs).where("length < 2048 or offset > 0")
    assert pieces.selectExpr("sum(if(placed, length, 0)) / sum(length) as share").first().share > 0.85
