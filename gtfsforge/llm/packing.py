"""Packing token documents into windows by the online sum-of-squares rule.

Documents are encoded where they lie, each to its ids and one closing id, and dealt out evenly to
tasks of about ``ROWS`` documents: the rule works on a stream, and the longer it is, the fewer windows
are open at its end.  Whole windows of a long document are cut
off first.  The rest is placed at once: of all fill levels that leave room for it
(or a new window), the one that makes the sum of squares of the level counts least,
where count[h] is the number of partially filled windows with h ids.  The counts are
kept in one array of ``window`` levels, with a stack of open windows per level, so a
document costs one vectorised pass over the array, whatever the number of windows.

When the stream ends, the windows that are still open are filled up from each other
by cutting (their pieces are marked as not placed), so at most one window per task is not full; it
is laid out as sequences whose lengths are powers of two, which need no padding.  Open windows are
held in memory: at most one per document of the task, each with less than a window of ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import column, ensure_importable, slices

#: Production parameters.
WINDOW = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
#: Documents of a task that packs (at most a window of ids of each is held: 256 MB, if none fitted another).
ROWS = 1 << 15
#: Sequence numbers of a task start at its partition number times this.
PER_TASK = 1 << 33

PIECES = ("{id} {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, placed boolean")

_ENCODERS: dict = {}


def encoder(ranks_path: str | None = None, vocabulary_path: str | None = None):
    """text -> ids of the public byte-level BPE, special tokens recognised, none added.

    The rank file holds the same vocabulary as the ``tokenizers`` file and is encoded
    several times faster; tests hold the ids of both against each other.  A text that
    the rank encoder refuses (a run of a million blanks) goes to ``tokenizers``."""
    key = ranks_path, vocabulary_path
    if key not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path or public_tokenizers.path(RANKS), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

        def ids(text: str) -> np.ndarray:
            try:
                return enc.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                from tokenizers import Tokenizer

                full = Tokenizer.from_file(vocabulary_path or public_tokenizers.path(VOCABULARY))
                return np.array(full.encode(text, add_special_tokens=False).ids, "<u4")

        _ENCODERS[key] = ids
    return _ENCODERS[key]


class Packer:
    """Sum-of-squares packing of one stream.  ``add`` and ``finish`` yield pieces
    (document key, start, ids, doc_tokens, sequence, offset, placed); keys are opaque, and ``placed``
    tells whole windows and pieces that lie where the rule put them from those cut at the end."""

    def __init__(self, window: int = WINDOW, first_sequence: int = 0):
        self.window, self.next = window, first_sequence
        self.count = np.zeros(window + 1, np.int64)  # count[window] stays 0: full windows don't count
        self.open: list[list[list]] = [[] for _ in range(window + 1)]  # windows (lists of pieces) by fill level

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        n, w = len(ids), self.window
        whole = n - n % w
        for start in range(0, whole, w):
            yield from self._out([(key, start, ids[start:start + w], n)], w, True)
        if n == whole:
            return
        size = n - whole
        level = self._level(size)
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window = []
        window.append((key, whole, ids[whole:].copy(), n))  # not a view that would hold the whole document
        if level + size == w:
            yield from self._out(window, w, True)
        else:
            self.open[level + size].append(window)
            self.count[level + size] += 1

    def _level(self, size: int) -> int:
        """The level (0: a new window) to put ``size`` ids on; the fullest of equals."""
        c, w = self.count, self.window
        change = 2 * c[size:] + 1  # a window more at level + size ...
        change[-1] = 0  # ... unless it is full then
        change[1:] -= 2 * c[1:w - size + 1] - 1  # and one less at level
        usable = np.flatnonzero(c[:w - size + 1])
        if not len(usable):
            return 0
        best = usable[::-1][np.argmin(change[usable[::-1]])]
        return int(best) if change[best] <= change[0] else 0

    def _out(self, window: list, length: int, placed: bool) -> Iterator[tuple]:
        at = 0
        for key, start, ids, n in window:
            yield key, start, ids, n, self.next, at, placed
            at += len(ids)
        assert at == length
        self.next += 1

    def finish(self) -> Iterator[tuple]:
        """Closes the open windows: their pieces, the fullest windows' first, are cut in a row
        into full windows and a rest in powers of two."""
        row = [piece for level in self.open[::-1] for window in level for piece in window][::-1]
        fill = sum(len(piece[2]) for piece in row)
        rest = fill % self.window
        for length in [self.window] * (fill // self.window) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]:
            window, room = [], length
            while room:
                key, start, ids, n = row.pop()
                if len(ids) > room:
                    row.append((key, start + room, ids[room:], n))
                    ids = ids[:room]
                window.append((key, start, ids, n))
                room -= len(ids)
            yield from self._out(window, length, False)
        self.count[:] = 0
        self.open = [[] for _ in self.open]


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
         ranks_path: str | None = None, vocabulary_path: str | None = None, rows: int = ROWS) -> DataFrame:
    """One row per piece: id, start (ids of the document before it), length, ids (little-endian
    unsigned 32-bit), doc_tokens (with the closing id), sequence_id, offset, placed (false: cut at the end).

    Each id of each document lies in exactly one piece; sequences are gapless and of
    ``window`` ids, or of a smaller power of two.  Defined results: a null or empty text
    is the closing id alone; null and repeated ids are carried as they are, each row
    being a document of its own; an empty table gives no pieces; other columns are
    ignored, whatever their names.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")
    ensure_importable(docs.sparkSession)
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"))
    kind = base.schema["id"].dataType.simpleString()
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "placed"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(ranks_path, vocabulary_path)
        for batch in batches:
            for part in slices(batch, "body"):
                ids = [np.append(to_ids(body or ""), end_id).astype("<u4").tobytes() for body in column(part, "body").to_pylist()]
                yield pa.RecordBatch.from_arrays([column(part, "id"), pa.array(ids, pa.binary())], names=["id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() * PER_TASK)
        kind = pa.int64()

        def pieces(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(found), 4096):
                k, start, ids, n, seq, offset, placed = zip(*found[at:at + 4096])
                yield pa.RecordBatch.from_arrays([
                    pa.array(k, kind), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(n, pa.int64()),
                    pa.array(seq, pa.int64()), pa.array(offset, pa.int64()), pa.array(placed, pa.bool_())], names=names)

        for batch in batches:
            kind = batch.schema.field("id").type
            for part in slices(batch, "ids"):
                done: list[tuple] = []
                for key, ids in zip(column(part, "id").to_pylist(), column(part, "ids").to_pylist()):
                    done += packer.add(key, np.frombuffer(ids, "<u4"))
                yield from pieces(done)
        yield from pieces(list(packer.finish()))

    tasks = max(1, -(-base.count() // rows))
    return base.mapInArrow(encode, f"id {kind}, ids binary").repartition(tasks).mapInArrow(run, PIECES.format(id=f"`{id_col}`", kind=kind))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "placed")
