"""Quality scores from random-indexing word vectors and a small calibrated network.

1. Random indexing.  Every word (a run of word characters, or one of other characters)
   hashes to one of ``ROWS`` rows; a row has a fixed sparse index vector of a few +1 and -1.
   One pass over all documents adds to each row the index vectors of its neighbours up
   to ``REACH`` words away.  The sums are integers, so they don't depend on the order in
   which tasks end.  Tasks send at most ``ROWS`` partial vectors, summed by row.
2. A row's word vector is its mean context, less the corpus mean, at length 1.
3. A document pools its words' vectors: their mean, their spread, and the mean product
   of neighbours, dimension by dimension.  A pool of n words tells n / (n + ``SHRINK``) of
   its distance from the average document; the rest is shrunk away, so that a few words
   don't decide.
4. A two-layer network (numpy) learns the labels of a bounded sample of labelled
   documents (``SAMPLE``, the first by a hash of the id); rows whose crc32(id) mod 5 is 0
   are never learned.  A part of the sample is set aside to choose the epoch and to fit a
   temperature, by which scores become calibrated probabilities.
5. The vectors and the network (their size is fixed by the parameters) go to every task,
   and each whole text is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns, column, ensure_importable, slices

#: Production parameters.
ROWS = 8192
DIM = 64
NONZERO = 4
REACH = 2
SHRINK = 30
HIDDEN = 32
EPOCHS = 60
SEED = 7
#: Labelled documents to learn from, at most.
SAMPLE = 12_000
#: A score from here on predicts label 1.
THRESHOLD = 0.3
CACHE_WORDS = 250_000
#: Words pooled at once.
CHUNK = 1 << 16

_find = re.compile(r"\w+|[^\w\s]+").findall


class _Rows(dict):
    """Word -> row, filled as words occur."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % ROWS
        return got


_ROWS = _Rows()


def rows_of(text: str) -> np.ndarray:
    words = _find(text)
    return np.fromiter(map(_ROWS.__getitem__, words), np.int64, len(words))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(positions, signs) of the nonzero components of every row's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.permuted(np.tile(np.arange(DIM), (ROWS, 1)), axis=1)[:, :NONZERO], rng.choice([-1.0, 1.0], (ROWS, NONZERO))


def add_contexts(total: np.ndarray, count: np.ndarray, texts: list[np.ndarray], pos: np.ndarray, sign: np.ndarray) -> None:
    """Adds the neighbours' index vectors of some documents (their rows) to ``total``."""
    flat = np.concatenate(texts)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    count += np.bincount(flat, minlength=ROWS)
    for d in range(1, REACH + 1):
        same = doc[d:] == doc[:-d]
        left, right = flat[:-d][same], flat[d:][same]
        for at, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                total += np.bincount(at * DIM + pos[other, k], weights=sign[other, k], minlength=ROWS * DIM)


def context_sums(docs: DataFrame, text: str) -> DataFrame:
    """(row, n, c0, c1, ...): occurrences and summed contexts over all documents."""
    names = ["row", "n", *(f"c{k}" for k in range(DIM))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, sign = index_vectors()
        total, count = np.zeros(ROWS * DIM), np.zeros(ROWS, np.int64)
        for batch in batches:
            for part in slices(batch, "body"):
                add_contexts(total, count, [rows_of(t or "") for t in column(part, "body").to_pylist()], pos, sign)
        seen = np.flatnonzero(count)
        vectors = np.rint(total.reshape(ROWS, DIM)[seen]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(count[seen]), *(pa.array(vectors[:, k]) for k in range(DIM))], names=names)

    ensure_importable(docs.sparkSession)
    parts = docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names[1:]])


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """(ROWS, DIM) word vectors from rows of (row, n, contexts)."""
    out = np.zeros((ROWS, DIM), np.float32)
    if len(sums):
        row, n, c = sums[:, 0], sums[:, 1:2].astype(float), sums[:, 2:].astype(float)
        v = c / n - c.sum(axis=0) / n.sum()
        out[row] = v / (np.sqrt((v * v).sum(axis=1, keepdims=True)) + 1e-9)
    return out


def pooled(vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The 3 x DIM features of one document and the weight of its pool; zeros for one without words."""
    n = len(rows)
    if not n:
        return np.zeros(3 * DIM + 1)
    s, q, p = np.zeros(DIM), np.zeros(DIM), np.zeros(DIM)
    for k in range(0, n, CHUNK):
        v = vectors[rows[k:k + CHUNK + 1]]  # one more, for the last neighbour
        own = v[:CHUNK]
        s += own.sum(axis=0)
        q += np.einsum("ij,ij->j", own, own)
        p += np.einsum("ij,ij->j", v[:-1], v[1:])
    mean = s / n
    return np.concatenate((mean, np.sqrt(np.maximum(q / n - mean * mean, 0)), p / max(1, n - 1), [n / (n + SHRINK)]))


class Network(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(_shrunk(x, self.mean, self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _shrunk(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features times their pool's weight, the last column."""
    return (x[:, :-1] - mean) / scale * x[:, -1:]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y == 1, -z, z)).mean())


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """x: features, the last column their weight; y: labels.  Adam on the cross entropy; the epoch and the temperature by a fifth set aside.  With
    labels of one kind only (or none) every score is that label (or 0.5)."""
    n, d = x.shape[0], x.shape[1] - 1
    if len(set(y.tolist())) < 2:
        b = 0.0 if not n else 20.0 if y[0] else -20.0
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), b, 1.0)
    rng = np.random.default_rng(SEED)
    seen = x[:, -1] > 0.5  # the average of documents that are long enough to tell
    seen = seen if seen.any() else np.ones(n, bool)
    mean, scale = x[seen, :-1].mean(axis=0), x[seen, :-1].std(axis=0) + 1e-6
    z = _shrunk(x, mean, scale)
    order = rng.permutation(n)
    aside, rest = order[:n // 5], order[n // 5:]
    if len(set(y[aside].tolist())) < 2:
        aside = order
    w = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second, t = [0 * a for a in w], [0 * a for a in w], 0
    best: tuple = (np.inf, None, None)
    for _ in range(EPOCHS):
        shuffled = rng.permutation(rest)
        for k in range(0, len(rest), 256):
            i = shuffled[k:k + 256]
            h = np.tanh(z[i] @ w[0] + w[1])
            err = (_sigmoid(h @ w[2] + w[3]) - y[i]) / len(i)
            back = np.outer(err, w[2]) * (1 - h * h)
            grads = [z[i].T @ back + 1e-4 * w[0], back.sum(axis=0), h.T @ err + 1e-4 * w[2], np.array([err.sum()])]
            t += 1
            for j, g in enumerate(grads):
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                w[j] = w[j] - 0.003 * (first[j] / (1 - 0.9 ** t)) / (np.sqrt(second[j] / (1 - 0.999 ** t)) + 1e-8)
        logit = np.tanh(z[aside] @ w[0] + w[1]) @ w[2] + w[3]
        now = _loss(logit, y[aside])
        if now < best[0]:
            best = (now, [a.copy() for a in w], logit)
    _, w, logit = best
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    temperature = float(grid[np.argmin([_loss(logit / g, y[aside]) for g in grid])])
    return Network(mean, scale, *w[:3], float(w[3][0]), temperature)


class Model(NamedTuple):
    vectors: np.ndarray
    network: Network

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.network.scores(np.stack([pooled(self.vectors, rows_of(t)) for t in texts]))


def held_out(id_col: str):
    """Rows that are never learned: crc32 of the id's text leaves 0 by 5."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE) -> Model:
    """Word vectors of all ``docs`` and a network for 0/1 ``label`` of ``labels``.

    Labels that are null, or of ids labelled both ways, are left out; a repeated label
    counts once, and so does a repeated document."""
    spark = docs.sparkSession
    ensure_importable(spark)
    sums = context_sums(docs, text).toPandas().sort_values("row").to_numpy(np.int64)
    vectors = word_vectors(sums)
    by = F.xxhash64("id")
    chosen = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("id is not null and y in (0, 1)") \
        .where(~held_out("id")).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").drop("y2")
    some = chosen.orderBy(by, "id").limit(sample)  # bounded, so it may be sent to every task
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body")).join(F.broadcast(some), "id")

    def make():
        return lambda found: {"x": [pooled(vectors, rows_of(t)).astype("<f4").tobytes() for t in found]}

    learned = append_columns(texts, [T.StructField("x", T.BinaryType())], "body", make).drop("body") \
        .orderBy(by, "id", "x").limit(sample).collect()
    learned = list({r.id: r for r in learned}.values())
    x = np.stack([np.frombuffer(r.x, "<f4") for r in learned]).astype(float) if learned else np.zeros((0, 3 * DIM + 1))
    return Model(vectors, train(x, np.array([r.y for r in learned], float)))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts are scored like any text without words; repeated rows get equal
    scores; ids, labels and other columns are not looked at; input columns named like the
    new ones are replaced; an empty table stays empty.  Texts are read whole."""

    def make():
        def work(texts: list[str]) -> dict:
            s = model.scores(texts)
            return {"score": s, "predicted": (s >= threshold).astype(np.int32)}

        return work

    return append_columns(docs, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], text, make)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
