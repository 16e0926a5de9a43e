"""Token counts of a unigram vocabulary by a count-only Viterbi search.

An Aho-Corasick automaton enumerates, end by end, every vocabulary piece that
occurs in a pre-token.  For each end two numbers are carried forward: the best
score of a segmentation and how many pieces it has; no pieces, back pointers or
ids are kept.  Ties follow the tokenizer (the unigram model of the ``tokenizers``
library): a later candidate replaces an earlier one only if its score is higher,
candidates come by ascending start, and a character that is no piece of its own may
be an unknown at the lowest score less ten.  Unknown characters count one piece per
UTF-8 byte where the vocabulary has byte pieces, else one per run.

The vocabulary is the public ``piece_bpe_32k.model``: its pieces and scores, read
as a unigram table.  Before the search, spaces become U+2581, one is put before the
text, and the text is cut before each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .frames import append_columns

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: What an unknown character scores below the lowest piece (fixed by the tokenizer).
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000
CACHE_CHARS = 48


def read_pieces(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score) by id of a sentencepiece model file."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class PieceCounter:
    def __init__(self, pieces: list[tuple[str, float]], unknown_id: int = 0):
        import ahocorasick

        self._auto = ahocorasick.Automaton()
        for k, (piece, score) in enumerate(pieces):
            if piece and not self._auto.exists(piece):
                self._auto.add_word(piece, (len(piece), score))
        self._auto.make_automaton()
        names = {p for p, _ in pieces}
        single = {p for p in names if len(p) == 1}
        if any(len(p) > 1 and not any(c in single for c in p) for p in names if p != pieces[unknown_id][0]):
            raise ValueError("a piece made of unknown characters only: runs of unknowns could spell it")
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.words: dict[str, int] = {}

    def word(self, w: str) -> int:
        """Pieces in the best segmentation of one pre-token."""
        n = len(w)
        best: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        loose = [False] * (n + 1)  # the best segmentation up to here ends in an unknown
        settled = 0

        def settle(end: int, single: bool) -> None:
            """All pieces that end here are tried; an unknown character comes last."""
            if single:
                return
            score = best[end - 1] + self.unknown
            if best[end] is None or score > best[end]:
                best[end] = score
                count[end] = count[end - 1] + (len(w[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else not loose[end - 1])
                loose[end] = True

        single = True
        for end, (size, score) in self._auto.iter(w):
            end += 1
            while settled < end:  # a new end: close those before it
                if settled:
                    settle(settled, single)
                settled, single = settled + 1, False
            score += best[end - size]
            if best[end] is None or score > best[end]:
                best[end], count[end], loose[end] = score, count[end - size] + 1, False
            single = single or size == 1
        while settled <= n:
            if settled:
                settle(settled, single)
            settled, single = settled + 1, False
        return count[n]

    def _new(self, w: str) -> int:
        got = self.word(SPACE + w)
        if len(w) <= CACHE_CHARS:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[w] = got
        return got

    def text(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(" ", SPACE).split(SPACE)
        if not words[0]:
            words = words[1:]
        known, new = self.words.get, self._new
        return sum([known(w) or new(w) for w in words])


_LOADED: dict[str | None, PieceCounter] = {}


def token_counts(docs: DataFrame, text: str = "text", path: str | None = None, out: str = "n_tokens") -> DataFrame:
    """``docs`` with ``out`` (long): tokens of every whole text.  Null and empty texts
    have 0; repeated rows count alike; an input column of that name is replaced."""

    def make():
        if path not in _LOADED:
            _LOADED[path] = PieceCounter(read_pieces(path))
        counter = _LOADED[path]
        return lambda texts: {out: [counter.text(t) for t in texts]}

    return append_columns(docs, [T.StructField(out, T.LongType())], text, make)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs).drop("text")
