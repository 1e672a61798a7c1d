"""Token counts under a unigram vocabulary, without building the tokens.

Count-only Viterbi: an Aho-Corasick automaton over the vocabulary lists every piece that ends at
a position; dynamic programming carries the best score and, with it, only the number of pieces.
Rules of the unigram tokenizer: a character that is no piece of its own may be an unknown, ten
below the least score; among equal scores at a position the piece that starts first stays; runs of
unknowns are one token, or as many as their bytes where the vocabulary has byte pieces. Spaces
become the escape mark, and one is put before the text. Where no piece holds a mark after another
character, texts are cut before marks, and the counts of the parts are remembered up to a bound.

Defined results: null and empty texts have 0 tokens; equal rows give equal results; an empty
table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from liftlens.llm.common import by_batch
from liftlens.llm.shingles import Memo

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[tuple[str, float]]
    has_bytes: bool


def read_vocabulary(path: str | None = None) -> Vocabulary:
    """Pieces and scores of a sentencepiece model, read on the driver; by default a public one."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i)
                                    or model.is_byte(i) or model.is_unused(i))]
    return Vocabulary([(model.id_to_piece(i), model.get_score(i)) for i in plain],
                      sum(model.is_byte(i) for i in ids) == 256)


class Counter:
    """(tokens, score) of texts."""

    def __init__(self, vocabulary: Vocabulary):
        self._automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self._single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self._bytes = vocabulary.has_bytes
        self._parts = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary.pieces)
        self._known = Memo(self.best)

    def best(self, part: str) -> tuple[int, float]:
        n = len(part)
        ends: list[list] = [[] for _ in range(n)]
        for end, match in self._automaton.iter(part):
            ends[end].append(match)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, found, is_unknown = float("-inf"), 0, False
            for length, own in sorted(ends[end - 1], reverse=True):  # the first start first
                value = score[end - length] + own
                if value > top:
                    top, found, is_unknown = value, count[end - length] + 1, False
            char = part[end - 1]
            if char not in self._single:
                value = score[end - 1] + self._unknown
                if value > top:
                    top, is_unknown = value, True
                    if self._bytes:
                        found = count[end - 1] + len(char.encode())
                    else:
                        found = count[end - 1] + (not unknown[end - 1])
            score[end], count[end], unknown[end] = top, found, is_unknown
        return count[n], score[n]

    def __call__(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        parts = _PART.findall(marked) if self._parts else [marked]
        total, score = 0, 0.0
        for n, s in map(self._known.__getitem__, parts):
            total += n
            score += s
        return total, score


def count(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and score (of the best segmentation) of every document. The vocabulary
    is broadcast; `path` names its file on the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    counters: list[Counter] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not counters:
            counters.append(Counter(shared.value))
        found = [counters[0](t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([n for n, _ in found], pa.int64()),
             pa.array([s for _, s in found], pa.float64())],
            names=["doc_id", "n_tokens", "score"])

    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, score double")
