"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  A word goes if a window that
covers it has a word sequence that also starts in a document with a smaller id.

1. The minimiser of a window is the least hash of its runs of ``gram`` words.  Equal
   windows have equal minimisers, and consecutive windows mostly share theirs; a stretch of
   windows with one minimiser is a super-k-mer.  One pass over the texts lists each
   document's super-k-mers as (minimiser, first word), without any text.
2. Documents with equal texts collapse to the one with the smallest id (a pre-aggregated
   group): a later copy goes wholly, if it has a window.
3. A minimiser that occurs in one document only can have no repeated window, and is
   dropped.  Equal super-k-mers collapse to the smallest document that has them, by the digest of
   their words: all windows of the others are repeats.  So a passage that any number of
   documents hold is one entry wherever a super-k-mer lies inside it.
4. The remaining super-k-mers travel as one packed string each to the bucket of
   their minimiser; there the windows are sorted, by a 128-bit digest and document, so
   that each run of equal windows tells its smallest document.
5. A bucket of over ``LONG`` windows (different texts around one frequent passage) is not sorted:
   its super-k-mers are cut again by the minimisers of another hash order and dealt by
   both, with steps 3 and 4 (``ORDERS`` orders in all).  Windows that differ in next to nothing
   share all of these; what is still long then is dealt by the digests of single windows, of which
   only the smallest document is kept, aggregated before the shuffle.
6. The windows found are cut out of the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import runs
from .frames import append_columns, column, ensure_importable, slices, stored

#: Production parameters.
WINDOW = 50
GRAM = 8
#: Windows of a bucket (about 150 bytes each while they are sorted) beyond which it is dealt by a
#: further minimiser, hash orders in all, and windows that a task sorts at once.
LONG = 20_000
ORDERS = 2
AT_ONCE = 250_000
#: Word hashes that a worker remembers.
CACHE_WORDS = 250_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word -> 64-bit hash, filled as words occur."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_HASHES = _Hashes()


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def digest(raw: bytes) -> tuple[int, int]:
    """128 bits of a byte string as two signed longs."""
    import xxhash

    a, b = np.frombuffer(xxhash.xxh3_128_digest(raw), "<i8").tolist()
    return a, b


def sliding_min(a: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every k neighbours."""
    span = 1
    while 2 * span <= k:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    rest = k - span
    return np.minimum(a[:-rest], a[rest:]) if rest else a


def super_kmers(words: list[bytes], window: int = WINDOW, gram: int = GRAM, order: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(minimisers, first windows) of the super-k-mers of one document, in order; ``order`` chooses the hash order."""
    n = len(words)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    g = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        g = g * _MIX + h[j:n - gram + 1 + j]
    g += np.uint64(order * int(_MIX) % (1 << 64))
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(29)
    low = sliding_min(g, window - gram + 1).view(np.int64)
    first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    return low[first], first.astype(np.int32)


def window_digests(words: list[bytes], window: int) -> np.ndarray:
    """(windows, 2) longs: a 128-bit digest of each window's words."""
    import xxhash

    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate(([0], ends[:len(words) - window] + 1)).tolist()
    of = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([of(line[a:b]) for a, b in zip(first, ends[window - 1:].tolist())]), "<i8").reshape(-1, 2)


def _strings(words: list[bytes], starts: list[int], stops: list[int], window: int) -> list[tuple[int, int]]:
    """Digests of the words of super-k-mers."""
    return [digest(b" ".join(words[a:b + window - 1])) for a, b in zip(starts, stops)]


def _survey(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(id, h1, h2, cuts) of the documents that have a window; cuts: their super-k-mers (key,
    first, n, s1, s2), the last two a digest of the words."""
    fields = [T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("n_windows", T.IntegerType()),
              T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("firsts", T.ArrayType(T.IntegerType())),
              T.StructField("d1", T.ArrayType(T.LongType())), T.StructField("d2", T.ArrayType(T.LongType()))]

    def make():
        def one(text: str) -> tuple:
            words = split(text)
            mins, starts = super_kmers(words, window, gram)
            n = max(0, len(words) - window + 1)
            d1, d2 = zip(*_strings(words, starts.tolist(), [*starts[1:].tolist(), n], window)) if n else ((), ())
            return (*digest(text.encode("utf-8", "surrogatepass")), n, mins, starts, d1, d2)

        return lambda texts: dict(zip(("h1", "h2", "n_windows", "keys", "firsts", "d1", "d2"), zip(*map(one, texts))))

    return append_columns(docs.select("id", "body"), fields, "body", make).drop("body").where("n_windows > 0")


PIECE = "min long, id long, h1 long, h2 long, pos int, n int, packed binary"


def _rows(out: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*out), fields)], names=[n for n, _ in fields])


def _pieces(held: DataFrame, window: int) -> DataFrame:
    """From documents (id, body) with super-k-mers (``hits``): one packed string each."""
    schema = PIECE + ", long boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                out = []
                for doc, h1, h2, body, hits in zip(*(column(part, c).to_pylist() for c in ("id", "h1", "h2", "body", "hits"))):
                    if (h1, h2) != digest((body or "").encode("utf-8", "surrogatepass")):
                        continue  # another row of that id
                    words = split(body or "")
                    out += [(x["key"], doc, h1, h2, x["first"], x["n"], b" ".join(words[x["first"]:x["first"] + x["n"] + window - 1]), x["long"]) for x in hits]
                if out:
                    yield _rows(out, schema)

    return held.select("id", "body", "h1", "h2", "hits").mapInArrow(run, schema)


def _from_pieces(pieces: DataFrame, make, schema: str) -> DataFrame:
    """Rows that ``make`` derives from packed strings, a bounded number of strings at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                out = []
                for row in zip(*(column(batch.slice(at, 1024), c).to_pylist() for c in ("min", "id", "h1", "h2", "pos", "n", "packed"))):
                    out += make(*row)
                if out:
                    yield _rows(out, schema)

    return pieces.mapInArrow(run, schema)


def _cut_again(pieces: DataFrame, window: int, gram: int, order: int) -> DataFrame:
    """Super-k-mers by the minimisers of a further hash order inside packed strings; their key
    tells both minimisers."""

    def make(key: int, doc: int, h1: int, h2: int, pos: int, n: int, packed: bytes) -> Iterator[tuple]:
        words = packed.split(b" ")
        mins, starts = super_kmers(words, window, gram, order)
        keys = ((mins.view(np.uint64) ^ np.uint64(key % (1 << 64))) * _MIX).view(np.int64).tolist()
        starts = starts.tolist()
        for k, a, b in zip(keys, starts, [*starts[1:], n]):
            part = b" ".join(words[a:b + window - 1])
            yield doc, h1, h2, k, pos + a, b - a, *digest(part), part

    return _from_pieces(pieces, make, "rep long, h1 long, h2 long, key long, first int, n int, s1 long, s2 long, packed binary")


def _single(pieces: DataFrame, window: int) -> DataFrame:
    """One row per window of packed strings, by its digest."""

    def make(key: int, doc: int, h1: int, h2: int, pos: int, n: int, packed: bytes) -> Iterator[tuple]:
        return ((a, b, doc, h1, h2, pos + k) for k, (a, b) in enumerate(window_digests(packed.split(b" "), window).tolist()))

    return _from_pieces(pieces, make, "a long, b long, id long, h1 long, h2 long, pos int")


def _sorted_windows(pieces: DataFrame, window: int, at_once: int = AT_ONCE) -> DataFrame:
    """(id, h1, h2, pos, n): stretches of windows that a smaller document also has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, ["min"], 512):
            size = table.column("n").to_numpy()
            ends = np.cumsum(size)[starts[1:] - 1]
            at = 0
            while at < table.num_rows:  # whole minimisers, up to at_once windows
                done = ends[np.searchsorted(starts, at) - 1] if at else 0
                fit = int(np.searchsorted(ends, done + at_once, side="right"))
                stop = max(int(starts[fit]), int(starts[np.searchsorted(starts, at) + 1]))
                part = table.slice(at, stop - at)
                at = stop
                yield from some(part)

    def some(table: pa.Table) -> Iterator[pa.RecordBatch]:
        size = table.column("n").to_numpy()
        d = np.concatenate([window_digests(p.split(b" "), window) for p in table.column("packed").to_pylist()])
        row = np.repeat(np.arange(len(size)), size)
        ids = table.column("id").to_numpy()
        doc = ids[row]
        order = np.lexsort((doc, d[:, 1], d[:, 0]))
        s = d[order]
        new = np.concatenate(([True], (s[1:] != s[:-1]).any(axis=1)))
        least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        gone = np.zeros(len(doc), bool)
        gone[order] = least < doc[order]
        # stretches of neighbours in one super-k-mer
        same = row[1:] == row[:-1]
        a = np.flatnonzero(gone & ~np.concatenate(([False], gone[:-1] & same)))
        b = np.flatnonzero(gone & ~np.concatenate((gone[1:] & same, [False])))
        if len(a):
            of = row[a]
            inside = a - (np.cumsum(size) - size)[of]
            cols = [ids[of], table.column("h1").to_numpy()[of], table.column("h2").to_numpy()[of],
                    (table.column("pos").to_numpy()[of] + inside).astype(np.int32), (b - a + 1).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["id", "h1", "h2", "pos", "n"])

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(n, "min").sortWithinPartitions("min").mapInArrow(run, "id long, h1 long, h2 long, pos int, n int")


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """Takes the windows in ``marks`` out of ``body``; adds kept, n_words, n_removed."""
    base = docs.drop("marks").schema.fields
    new = [T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]

    def one(body: str | None, marks: list | None) -> tuple[str, int, int]:
        words = split(body or "")
        n = len(words)
        gone = np.zeros(n, bool)
        if marks:
            own = digest((body or "").encode("utf-8", "surrogatepass"))
            for m in marks:
                if (m["h1"], m["h2"]) == own:
                    if m["whole"]:
                        gone[:] = True
                    for x in m["spans"] or ():
                        gone[x["pos"]:x["pos"] + x["n"] + window - 1] = True
        left = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
        return b" ".join(left).decode("utf-8", "surrogatepass"), n, n - len(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                made = zip(*map(one, column(part, "body").to_pylist(), column(part, "marks").to_pylist()))
                arrays = [pa.array(x, k) for x, k in zip(made, (pa.string(), pa.int64(), pa.int64()))]
                keep = [c for c in part.schema.names if c != "marks"]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), *arrays],
                                                 names=[*keep, "kept", "n_words", "n_removed"])

    return docs.select(*[f.name for f in base], "marks").mapInArrow(run, T.StructType([*base, *new]))


def _repeats(each: DataFrame, texts: DataFrame, window: int, gram: int, long: int, order: int = 0) -> DataFrame:
    """(id, h1, h2, pos, n): stretches of windows that also start in a smaller document, from the
    super-k-mers ``each`` (rep, h1, h2, key, first, n, s1, s2, and packed after the first order) of distinct
    texts (``texts``: id, body); equal windows have equal keys."""
    strings = each.groupBy("key", "s1", "s2").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.first("n").alias("n"))
    shared = strings.groupBy("key").agg(F.min("low").alias("a"), F.max("high").alias("b"), F.count(F.lit(1)).alias("strings"), F.sum("n").alias("many")) \
        .where("a < b").select(F.col("key").alias("k"), (F.col("strings") > 1).alias("differ"), (F.col("many") > long).alias("long"))
    # first the distinct strings learn about their keys, then every super-k-mer about its string
    marked = strings.join(shared, F.col("key") == F.col("k")).where("differ or low < high") \
        .select(F.col("key").alias("k2"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), "low", "differ", "long")
    hits = each.join(marked, (F.col("key") == F.col("k2")) & (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")))
    copy = F.col("low") < F.col("rep")
    packed = [F.when(~copy, F.col("packed")).alias("packed")] if order else []
    hits = hits.select("rep", "h1", "h2", "key", "first", "n", "differ", "long", copy.alias("copy"), *packed)
    hits = hits.where("copy or differ")
    hits = hits if order else stored(hits, "hits")
    found = hits.where("copy").select(F.col("rep").alias("id"), "h1", "h2", F.col("first").alias("pos"), "n")
    live = hits.where("not copy")
    if order:
        pieces = live.select(F.col("key").alias("min"), F.col("rep").alias("id"), "h1", "h2", F.col("first").alias("pos"), "n", "packed", "long")
    else:  # the texts travel once; further orders cut the packed strings
        by_doc = live.groupBy(F.col("rep").alias("doc"), "h1", "h2").agg(F.collect_list(F.struct("key", "first", "n", "long")).alias("hits"))
        pieces = stored(_pieces(texts.join(by_doc, F.col("id") == F.col("doc")), window), "pieces")
    found = found.unionAll(_sorted_windows(pieces.where("not long").drop("long"), window))
    rest = pieces.where("long").drop("long")
    if not rest.head(1):
        return found
    if order + 1 < ORDERS:
        return found.unionAll(_repeats(stored(_cut_again(rest, window, gram, order + 1), "superkmers"), texts, window, gram, long, order + 1))
    loose = _single(rest, window)
    least = loose.groupBy("a", "b").agg(F.min("id").alias("low")).select(F.col("a").alias("a2"), F.col("b").alias("b2"), "low")
    return found.unionAll(loose.join(least, (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2"))).where("low < id")
                          .select("id", "h1", "h2", "pos", F.lit(1).alias("n")))


MARKS = "array<struct<h1:bigint,h2:bigint,whole:boolean,spans:array<struct<pos:int,n:int>>>>"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   long: int = LONG) -> DataFrame:
    """(id, row, kept, n_words, n_removed) per input row; ``row`` is the whole input row as
    a struct, ``kept`` the words that stay, joined by one space.

    Windows are judged on the input, not on what is left.  Defined results: a null text has
    no words; texts shorter than a window stay whole; a row with a null id is neither
    judged nor taken as a source; of repeated rows (one id) none removes words of the
    other; rows that share an id but not the text are judged each by its own text; the
    columns of the input may have any names.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be 1 to window")
    spark = docs.sparkSession
    ensure_importable(spark)
    body = F.col("row").getField(docs.select(F.col(f"`{text}`")).columns[0])
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    usable = rows.where("id is not null")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("body")).where("id is not null")
    seen = stored(_survey(texts, window, gram), "superkmers")
    classes = seen.groupBy("h1", "h2").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("n_windows", "keys", "firsts", "d1", "d2")])
    each = classes.select("rep", "h1", "h2", F.explode(F.arrays_zip(
        "keys", "firsts", F.concat(F.slice("firsts", F.lit(2), F.size("firsts")), F.array("n_windows")).alias("stops"), "d1", "d2")).alias("x"))
    each = each.select("rep", "h1", "h2", F.col("x.keys").alias("key"), F.col("x.firsts").alias("first"), (F.col("x.stops") - F.col("x.firsts")).alias("n"),
                       F.col("x.d1").alias("s1"), F.col("x.d2").alias("s2"))
    found = _repeats(each, texts, window, gram, long)
    spans = found.groupBy("id", "h1", "h2").agg(F.collect_list(F.struct("pos", "n")).alias("spans")) \
        .select("id", "h1", "h2", F.lit(False).alias("whole"), "spans")
    low = seen.groupBy("h1", "h2").agg(F.min("id").alias("rep")).select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "rep")
    copies = seen.select("id", "h1", "h2").join(low, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).where("id > rep") \
        .select("id", "h1", "h2", F.lit(True).alias("whole"), F.lit(None).cast("array<struct<pos:int,n:int>>").alias("spans"))
    marks = spans.unionAll(copies).groupBy("id").agg(F.collect_list(F.struct("h1", "h2", "whole", "spans")).alias("marks")) \
        .select(F.col("id").alias("doc"), F.col("marks").cast(MARKS).alias("marks"))
    judged = usable.join(marks, F.col("id") == F.col("doc"), "left").drop("doc")
    rest = rows.where("id is null").withColumn("marks", F.lit(None).cast(MARKS))
    return _cut(judged.unionAll(rest).withColumn("body", body), window).drop("body")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
                                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50)),
low AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN low USING (s) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(ws) AS t, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
