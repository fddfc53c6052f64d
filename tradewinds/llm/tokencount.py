"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton over the vocabulary enumerates all matches of a text by their end. For each
end, dynamic programming carries the best score and the number of pieces on that path. Ties go to the
match that starts first, as in the tokenizer: at one end the automaton yields the longest match first
and only a strictly better score replaces it. A character that is no piece costs the least score
less 10; runs of such characters are one unknown piece, or their UTF-8 bytes with byte fallback.

No piece has a space mark after another character, so the best path always passes the border before
a word and words can be counted one by one. Scores are rounded to multiples of 2 ** -20: their sums
are then exact, in whatever order they are added, and a word counts alike in any text. Counts of words
are remembered, up to a bound after which the memory starts anew.

Defined cases: null and empty texts have 0 tokens; long texts and texts without spaces are read whole;
repeated rows are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tradewinds.llm.common import ship_package

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer
_GRID = 2.0**20
_REMEMBERED = 300_000
_MAX_PIECES = 500_000  # bound of what is broadcast


@dataclass
class Unigram:
    """Pieces with their scores. `byte_fallback`: unknown characters count as their bytes."""

    pieces: list[tuple[str, float]]
    byte_fallback: bool = True
    _words: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if len(self.pieces) > _MAX_PIECES:
            raise ValueError(f"{len(self.pieces)} pieces; at most {_MAX_PIECES} are broadcast")
        self.pieces = [(piece, round(score * _GRID) / _GRID) for piece, score in self.pieces if piece]
        self.unknown = min((score for _, score in self.pieces), default=0.0) - UNKNOWN_PENALTY
        crossing = any(SPACE in piece.lstrip(SPACE) for piece, _ in self.pieces)
        self.by_word = not crossing and (self.byte_fallback or any(piece == SPACE for piece, _ in self.pieces))
        self._automaton = None

    def __getstate__(self):
        return {"pieces": self.pieces, "byte_fallback": self.byte_fallback}

    def __setstate__(self, state):
        self.__init__(**state, _words={})

    @property
    def automaton(self):
        if self._automaton is None:
            built = ahocorasick.Automaton()
            for piece, score in self.pieces:
                built.add_word(piece, (len(piece), score))
            if self.pieces:
                built.make_automaton()
            self._automaton = built
        return self._automaton

    def path(self, text: str) -> int:
        """Pieces on the best path through a marked text."""
        size = len(text)
        best = [0.0] + [None] * size
        count = [0] * (size + 1)
        after_unknown = [False] * (size + 1)
        single = [False] * (size + 1)
        end = 0  # places before `end` are final

        def settle(place: int) -> None:
            """The unknown character before `place`, which starts last and so needs a better score."""
            if single[place]:
                return
            score = best[place - 1] + self.unknown
            if best[place] is None or score > best[place]:
                best[place] = score
                if self.byte_fallback:
                    count[place] = count[place - 1] + len(text[place - 1].encode("utf-8", "surrogatepass"))
                else:
                    count[place] = count[place - 1] + (not after_unknown[place - 1])
                after_unknown[place] = True

        if self.pieces:
            for last, (length, score) in self.automaton.iter(text):
                place = last + 1
                while end < last:
                    end += 1
                    settle(end)
                score += best[place - length]
                if best[place] is None or score > best[place]:
                    best[place], count[place], after_unknown[place] = score, count[place - length] + 1, False
                if length == 1:
                    single[place] = True
        while end < size:
            end += 1
            settle(end)
        return count[size]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self.path(SPACE + text.replace(" ", SPACE))
        words = text.split(" ")
        if "" in words or SPACE in text:  # runs of spaces belong to the word that follows
            words = [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]
        known, total = self._words, 0
        for word in words:
            n = known.get(word)
            if n is None:
                if len(known) >= _REMEMBERED:
                    known.clear()
                n = self.path(SPACE + word)
                if len(word) <= 100:
                    known[word] = n
            total += n
        return total


def from_file(path: str, *, scores: str = "zipf") -> Unigram:
    """Vocabulary of a SentencePiece model file.

    `scores="file"` takes the scores as they are, for a unigram model. A model of another kind has
    ranks in their place; `"zipf"` gives its n-th piece the log-probability -ln(n) - ln(H).
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    fallback = any(model.is_byte(i) for i in range(model.get_piece_size()))
    if scores == "file":
        return Unigram([(model.id_to_piece(i), model.get_score(i)) for i in plain], fallback)
    ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
    whole = math.log(sum(1 / n for n in range(1, len(ranked) + 1))) if ranked else 0.0
    return Unigram([(model.id_to_piece(i), -math.log(n) - whole) for n, i in enumerate(ranked, 1)], fallback)


def token_counts(docs: DataFrame, vocabulary: Unigram) -> DataFrame:
    """doc_id and n_tokens per document."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.count(text) for text in texts.to_pylist()], pa.int64())

    return docs.select("doc_id", count(F.col("text")).alias("n_tokens"))
