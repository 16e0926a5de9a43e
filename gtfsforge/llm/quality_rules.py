"""Quality rules by tokeniser fertility, beside a few counts of words and lines.

Public vocabularies measure each whole text:

* characters per token and the entropy of its token distribution (bits), from the
  many-language byte-level BPE ``byte_bpe_multi_50k``;
* the byte-fallback share: characters that ``piece_bpe_32k`` can only spell as
  bytes, per character of the text's words.

A document is rejected if a measure leaves the band of its main script (the script of
most of its letters).  The bands are wide: prose keeps well inside them, while texts
of symbols, shouting, tables and loops leave them.  They judge documents that have the
least number of words; shorter ones fail the base rule anyway.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .frames import append_columns

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
MIN_WORDS = 50
#: A document fails if more than this percentage of its words is in repeated 3-word windows.
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"


class Band(NamedTuple):
    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float


#: Rejection bands by script: characters per token, byte-fallback share, entropy in bits.
BANDS = {
    "latin": Band(2.0, 8.0, 0.10, 5.0),
    "cyrillic": Band(0.8, 8.0, 0.10, 5.0),
    "greek": Band(0.5, 8.0, 0.25, 4.5),
    "arabic": Band(0.5, 8.0, 0.25, 4.5),
    "cjk": Band(0.3, 4.0, 0.60, 5.0),
    "other": Band(0.2, 10.0, 1.00, 4.0),
}
#: First and last code points of letters by script; the rest is "other".
SCRIPTS = (("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("arabic", 0x600, 0x77F),
           ("latin", 0x1E00, 0x1EFF), ("cjk", 0x3040, 0x30FF), ("cjk", 0x3400, 0x9FFF), ("cjk", 0xAC00, 0xD7AF))

FIELDS = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("chars_per_token", T.DoubleType()),
    T.StructField("fallback_share", T.DoubleType()), T.StructField("token_entropy", T.DoubleType()),
    T.StructField("script", T.StringType()), T.StructField("kept", T.BooleanType())]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more (every occurrence counts)."""
    n = len(words) - 2
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    g = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    order = np.argsort(g, kind="stable")
    same = g[order[1:]] == g[order[:-1]]
    if not same.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = True
    maybe[order[:-1][same]] = True
    at = np.flatnonzero(maybe).tolist()  # equal hashes: compare the words themselves
    seen = Counter((words[i], words[i + 1], words[i + 2]) for i in at)
    hit = np.array([i for i in at if seen[words[i], words[i + 1], words[i + 2]] > 1], np.int64)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[hit + k] = True
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def main_script(text: str) -> str:
    if text.isascii():
        return "latin"
    n: Counter = Counter()
    for ch, k in Counter(text).items():
        if ch.isalpha():
            code = ord(ch)
            n[next((s for s, a, b in SCRIPTS if a <= code <= b), "other")] += k
    return max(sorted(n), key=n.get) if n else "latin"


class Fertility:
    """chars per token, byte-fallback share and token entropy of whole texts."""

    def __init__(self, ranks_path: str | None = None, pieces_path: str | None = None):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path or public_tokenizers.path(RANKS), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        sp = sentencepiece.SentencePieceProcessor(model_file=pieces_path or public_tokenizers.path(PIECES))
        self._known = {p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if len(p) == 1} | set(BLANKS)

    def tokens(self, text: str) -> np.ndarray:
        try:
            return self._enc.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        except ValueError:  # a run too long for the splitting pattern: line by line, then in parts
            parts = text.splitlines(keepends=True)
            if len(parts) == 1:
                parts = [text[k:k + 100_000] for k in range(0, len(text), 100_000)]
            return np.concatenate([self.tokens(p) for p in parts])

    def measure(self, text: str, word_chars: int) -> tuple[float, float, float]:
        ids = self.tokens(text)
        if not len(ids):
            return 0.0, 0.0, 0.0
        share = np.unique(ids, return_counts=True)[1] / len(ids)
        strange = set(text) - self._known
        fallback = sum(map(text.count, strange))
        return len(text) / len(ids), fallback / max(1, word_chars), float(-(share * np.log2(share)).sum()) + 0.0


_LOADED: dict = {}


def quality_rules(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
                  bands: dict[str, Band] = BANDS, ranks_path: str | None = None, pieces_path: str | None = None) -> DataFrame:
    """``docs`` with the columns of FIELDS; ``kept`` is the verdict.

    Defined results: null and empty texts have no words, measures of 0 and fail the
    base rule; repeated rows get equal results; ids are not looked at; an input column
    with the name of a new one is replaced; an empty table stays empty.  A text of any
    length is measured whole.
    """

    def make():
        key = ranks_path, pieces_path
        if key not in _LOADED:
            _LOADED[key] = Fertility(ranks_path, pieces_path)
        fertility = _LOADED[key]

        def one(t: str) -> tuple:
            words = t.encode("utf-8", "surrogatepass").split()
            n = len(words)
            chars = len(t) - sum(map(t.count, BLANKS))
            repeat = repeated_words(words)
            failed = n < min_words or 100 * repeat > max_repeat_percent * n
            per, fall, bits = fertility.measure(t, chars)
            script = main_script(t)
            band = bands[script]
            good = band.least_chars <= per <= band.most_chars and fall <= band.most_fallback and bits >= band.least_entropy
            return (n, chars, sum(map(t.count, SYMBOLS)), duplicate_lines(t), repeat, failed, per, fall, bits, script, good and not failed)

        def work(texts: list[str]) -> dict:
            return dict(zip([f.name for f in FIELDS], zip(*map(one, texts))))

        return work

    return append_columns(docs, FIELDS, text, make)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "chars_per_token", "fallback_share", "token_entropy", "script")
