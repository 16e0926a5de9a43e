"""Byte-level BPE: exact encoding by backtracking, decoding by an offset table.

Encoding never runs merges over the text.  For each pre-token an Aho-Corasick
automaton gives the longest vocabulary token from every byte; from left to right
the longest one is tried first, then its longest proper prefixes.  A token may
follow another only if the pair is compatible: if merging, lowest rank first and
leftmost among equals, would leave the border between the two alone.  Whether it
would depends on the two tokens only, so it is looked up in a table that is filled
as pairs occur.  If no token fits, the last one is taken back and the dead position
is marked, so every position is entered a bounded number of times: linear time.

Decoding gathers each id's bytes out of one byte string by an offset table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns, ensure_importable, slices

#: The public vocabulary of the registered queries (a file of ``public_tokenizers``).
VOCABULARY = "byte_bpe_50k.json"
#: Pre-tokens whose encoding a worker remembers, and the longest that it remembers.
CACHE_WORDS = 400_000
CACHE_CHARS = 48

_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself,
    the other bytes in order for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class BytePairs:
    """A byte-level BPE vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if odd or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        added = spec["added_tokens"]
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("added tokens with stripping, word or normalising rules are not supported")
        to_byte = byte_alphabet()
        size = 1 + max([*model["vocab"].values(), *(a["id"] for a in added)])
        self.token = [b""] * size
        for piece, i in model["vocab"].items():
            self.token[i] = bytes(to_byte[c] for c in piece)
        ids = {t: i for i, t in enumerate(self.token) if t}
        self.added = {a["content"]: a["id"] for a in added}
        for content, i in self.added.items():
            self.token[i] = content.encode()
        # merges: rank of a pair, and what each token is made of
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, (list, tuple)) else m.split(" ")
            x, y = model["vocab"][a], model["vocab"][b]
            whole = model["vocab"][a + b]
            if whole in made:
                raise ValueError(f"token {whole} is made by two merges")
            self.rank[x, y] = r
            made[whole] = (x, y, r)
        self._made = made
        self.length = [len(t) for t in self.token]
        self.shorter = [-1] * size
        for t, i in ids.items():
            for k in range(len(t) - 1, 0, -1):
                if t[:k] in ids:
                    self.shorter[i] = ids[t[:k]]
                    break
        self._auto = ahocorasick.Automaton()
        for t, i in ids.items():
            self._auto.add_word(t.decode("latin-1"), i)
        self._auto.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}
        self._ends: dict[int, list[tuple[int, int]]] = {}
        self._begins: dict[int, list[tuple[int, int]]] = {}
        import public_tokenizers

        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words: dict[str, bytes] = {}
        self.blob = np.frombuffer(b"".join(self.token), np.uint8)
        self.size = np.array(self.length, np.int64)
        self.offset = np.concatenate(([0], np.cumsum(self.size)[:-1]))

    def _border(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts of a token that touch its left (0) or right (1) end, from the byte up,
        each with the rank of the merge that takes it up."""
        up, until = [], _NEVER
        while True:
            up.append((token, until))
            if token not in self._made:
                return up[::-1]
            until = self._made[token][2]
            token = self._made[token][side]

    def fits(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of ``a`` followed by ``b``."""
        known = self._fits.get((a, b))
        if known is not None:
            return known
        left = self._ends.get(a) or self._ends.setdefault(a, self._border(a, 1))
        right = self._begins.get(b) or self._begins.setdefault(b, self._border(b, 0))
        i = j = 0
        fit = True
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            r = self.rank.get((x, y), _NEVER)
            if r < x_until and r <= y_until:  # of equal ranks the leftmost merges first
                fit = r == _NEVER
                break
            if x_until == y_until == _NEVER:
                break
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        if len(self._fits) > 1_000_000:
            self._fits.clear()
        self._fits[a, b] = fit
        return fit

    def encode_word(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        n, length, shorter, fits = len(raw), self.length, self.shorter, self.fits
        longest = [0] * n
        for end, t in self._auto.iter(raw.decode("latin-1")):
            longest[end - length[t] + 1] = t
        alive = [True] * (n + 1)
        out: list[int] = []
        at, t = 0, longest[0]
        while True:
            end = at + length[t]
            if alive[end] and (not out or fits(out[-1], t)):
                out.append(t)
                if end == n:
                    return out
                at, t = end, longest[end]
            elif shorter[t] >= 0:
                t = shorter[t]
            else:
                alive[at] = False
                t = out.pop()
                at -= length[t]

    def _word(self, word: str) -> bytes:
        got = np.array(self.encode_word(word.encode()), np.int32).tobytes()
        if len(word) <= CACHE_CHARS:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as 32-bit integers in native order."""
        known, word = self.words.get, self._word
        out: list[bytes] = []
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                out.append(np.int32(self.added[part]).tobytes())
            elif part:
                out += [known(w) or word(w) for w in self.split(part)]
        return b"".join(out)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of consecutive id lists that end at ``ends`` (UTF-8; what is not valid
        becomes U+FFFD)."""
        size = self.size[ids]
        stop = np.cumsum(size)
        shift = self.offset[ids] - (stop - size)
        raw = self.blob[np.repeat(shift, size) + np.arange(int(stop[-1]) if len(stop) else 0)].tobytes()
        cuts = [0, *np.concatenate(([0], stop))[ends].tolist()]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


_LOADED: dict[str, BytePairs] = {}


def vocabulary(path: str | None = None) -> BytePairs:
    """The vocabulary of a file, kept per worker; by default that of the queries."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _LOADED:
        _LOADED[path] = BytePairs(path)
    return _LOADED[path]


def encode(docs: DataFrame, text: str = "text", path: str | None = None, out: str = "ids") -> DataFrame:
    """``docs`` with ``out``: the ids (array of int) of every whole text.

    Special tokens of the file are recognised in the text, none is added.  Null
    and empty texts have no ids; an input column named like ``out`` is replaced.
    """

    def make():
        v = vocabulary(path)

        def work(texts: Iterable[str]) -> dict:
            found = [v.encode(t) for t in texts]
            ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found])))
            flat = pa.array(np.frombuffer(b"".join(found), np.int32))
            return {out: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)}

        return work

    return append_columns(docs, [T.StructField(out, T.ArrayType(T.IntegerType(), True))], text, make)


def decode(df: DataFrame, ids: str = "ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of each id list (null or empty list: the empty text)."""
    ensure_importable(df.sparkSession)
    base = df.select(*[f"`{c}`" for c in df.columns if c.lower() != out.lower()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for part in slices(batch):
                lists = part.column(part.schema.get_field_index(ids))
                if lists.null_count:
                    lists = pa.array([x or [] for x in lists.to_pylist()], lists.type)
                flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()).cumsum()
                texts = pa.array(v.decode(flat, ends), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, out])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(out, T.StringType())]))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = decode(encode(docs).drop("text"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
