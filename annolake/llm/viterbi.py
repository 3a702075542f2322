"""Operator 7, token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton of all pieces gives, for each end position, the pieces
that end there; dynamic programming carries the best score and the number of
tokens of the best path, never the path. Ties follow the tokenizer: among equal
scores the candidate of the earliest start stays. A character that is no piece
scores (lowest score - 10) and counts one token for each UTF-8 byte (byte
fallback). The scores are whole numbers, so sums are exact and the best path of a
text is the chain of the best paths of its units: no piece crosses from a letter
to a following word mark, and a character that lies in no piece stands alone.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import CACHE_ENTRIES, CACHE_WORD, text_columns

MARK = "▁"
MODEL = "piece_bpe_32k.model"
UNK_PENALTY = 10.0


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, in the order of its ids."""
    import sentencepiece

    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())]


class Counter(dict):
    """Tokens of a unit, remembered."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        if any(s != int(s) for _, s in pieces):
            raise ValueError("scores must be whole numbers: else the best path depends on the order of sums")
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.unk = min(s for _, s in pieces) - UNK_PENALTY
        inside = "".join(p for p, _ in pieces)
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in inside)
        if any(MARK in p.lstrip(MARK) for p, _ in pieces):
            self.units = re.compile(r"(?s).+")
        else:
            self.units = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))

    def __missing__(self, unit: str) -> int:
        n = self.viterbi(unit)
        if len(unit) <= CACHE_WORD:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[unit] = n
        return n

    def viterbi(self, unit: str) -> int:
        n = len(unit)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        at, top, c, single = 0, None, 0, False   # ``at``: characters settled; the rest is of position at + 1
        for end, (size, score) in self.automaton.iter(unit):
            while at < end:                       # settle every position up to the one before this match's end
                top, c = self._settle(unit, at, best, count, top, c, single)
                at += 1
                best[at], count[at], top, single = top, c, None, False
            start = end + 1 - size
            s = best[start] + score
            if top is None or s > top:
                top, c = s, count[start] + 1
            single = single or size == 1
        while at < n:
            top, c = self._settle(unit, at, best, count, top, c, single)
            at += 1
            best[at], count[at], top, single = top, c, None, False
        return count[n]

    def _settle(self, unit, at, best, count, top, c, single):
        """Position at + 1: where its last character is no piece, the unknown character is one more candidate."""
        if not single:
            s = best[at] + self.unk
            if top is None or s > top:
                return s, count[at] + len(unit[at].encode())
        return top, c

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.units.findall(MARK + text.replace(" ", MARK))))


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_bytes), one row for each row of ``docs``, whole texts.

    Spaces become the word mark and one mark goes before the text, as the model's own
    normaliser does. Null and empty texts have 0 tokens. Repeated rows are repeated;
    an empty table gives an empty result; other columns are not read.
    """
    def make():
        counter = Counter(vocabulary(model))

        def f(texts):
            return [pa.array([counter.count(t.decode()) for t in texts], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64())]
        return f

    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return text_columns(d, "text", [("n_tokens", T.LongType()), ("n_bytes", T.LongType())], make)
