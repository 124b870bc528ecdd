"""Token counts under a unigram vocabulary without making the tokens.

A text is cut before each blank, as a metaspace pre-tokenizer does, and every
part is segmented by Viterbi: an Aho-Corasick automaton lists all vocabulary
pieces that end at each character, and the best score is carried forward with
the number of pieces of the best path. Ties keep the piece that starts first.
A character that no piece covers alone may be taken as unknown, at the lowest
score less ten; neighbouring unknown characters are one token, or their bytes
where the vocabulary has byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN_PENALTY = 10.0
CACHE_PARTS = 400_000
BLANK = "▁"


@dataclass(frozen=True)
class UnigramVocabulary:
    """Pieces with their scores; ``byte_fallback`` counts unknown characters in bytes."""
    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool = True


def load_vocabulary(path: str) -> UnigramVocabulary:
    """The ordinary pieces of a sentencepiece file with log scores.

    Files of merge vocabularies carry ranks instead of probabilities; a piece of
    rank r gets the log of 1 / (r + 2), which falls as word frequencies do.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = [model.get_score(i) for i in plain]
    ranked = len(scores) > 0 and all(s == int(s) for s in scores)
    return UnigramVocabulary(tuple(
        (model.id_to_piece(i), -float(np.log(k + 2.0)) if ranked else s) for k, (i, s) in enumerate(zip(plain, scores))),
        any(model.is_byte(i) for i in range(n)))


class PieceCounter(dict):
    """Part -> (pieces, score), computed once and kept while there is room."""

    _last: tuple[UnigramVocabulary, PieceCounter] | None = None

    def __init__(self, vocabulary: UnigramVocabulary):
        super().__init__()
        self.bytes = vocabulary.byte_fallback
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()

    @classmethod
    def shared(cls, vocabulary: UnigramVocabulary) -> PieceCounter:
        if cls._last is None or cls._last[0] != vocabulary:
            cls._last = (vocabulary, cls(vocabulary))
        return cls._last[1]

    def __missing__(self, part: str) -> tuple[int, float]:
        found = self._viterbi(part)
        if len(self) < CACHE_PARTS:
            self[part] = found
        return found

    def _viterbi(self, part: str) -> tuple[int, float]:
        n = len(part)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # at each last character: (length, score)
        for last, found in (() if self.empty else self.automaton.iter(part)):
            ends[last].append(found)
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        open_ = [False] * (n + 1)  # does the best path end in an unknown character?
        for end in range(1, n + 1):
            top, pieces, unknown, single = None, 0, False, False
            # Pieces of one end, the one that starts first first: a later one must be strictly better.
            for length, score in sorted(ends[end - 1], reverse=True):
                single |= length == 1
                value = score + best[end - length]
                if top is None or value > top:
                    top, pieces = value, count[end - length] + 1
            if not single:
                value = self.unknown + best[end - 1]
                if top is None or value > top:
                    top, unknown = value, True
                    cost = len(part[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else int(not open_[end - 1])
                    pieces = count[end - 1] + cost
            best[end], count[end], open_[end] = top, pieces, unknown
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        """(tokens, score) of a whole text; an empty one has none."""
        if not text:
            return 0, 0.0
        parts = text.replace(BLANK, " ").split(" ")
        if parts[0] == "":  # a text that begins with a blank gets no further one
            parts = parts[1:]
        found = [self[BLANK + p] for p in parts]
        return sum(f[0] for f in found), float(sum(f[1] for f in found))


def count_tokens(docs: DataFrame, vocabulary: UnigramVocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (key, n_parts, n_tokens, score); no shuffle.

    Null and empty texts have no tokens and score 0. Rows that repeat a key
    have a row each; a null key stays null. Other columns are not looked at.
    """
    own = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.shared(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                texts = rows.column(1).to_pylist()
                found = [counter.text(t) for t in texts]
                parts = [0 if not t else t.count(" ") + t.count(BLANK) + (t[0] not in (" ", BLANK)) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(parts, pa.int64()),
                     pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())],
                    names=[key, "n_parts", "n_tokens", "score"])

    return own.mapInArrow(run, f"`{key}` long, n_parts long, n_tokens long, score double")
