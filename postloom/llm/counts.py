"""Token counts of a unigram vocabulary by Viterbi, without building the tokens.

An Aho-Corasick automaton enumerates the pieces that end at each place; dynamic programming keeps, for each place, the
best score and the number of tokens of the best cut up to there. Ties are settled as the ``tokenizers`` library does:
of equal scores the earliest start, so the longest last piece, wins; a character without a piece of its own costs the
lowest score less ten and becomes its UTF-8 bytes if the vocabulary has all byte pieces, else runs of such characters
are one unknown token.

Scores are 32-bit numbers, so their sums are exact in double precision, and where no piece holds a space mark after
another character, texts can be cut before space marks without changing a tie. Words repeat, so each Python worker
keeps the counts of those it has met, up to a bounded number.

Defined results: a null text is counted like the empty one (0); an empty table gives no rows.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from postloom.llm.common import file_bytes, small_batches, text_or_empty

MARK = "▁"  # stands for a space
UNKNOWN_COST = 10.0
CACHED_WORDS = 500_000
CACHED_WORD = 48


class Counter:
    """Counts for a vocabulary of ``(piece, score)``; the unknown, control and byte pieces are not matched in texts."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        self.bytes = byte_fallback
        scores = [float(np.float32(s)) for _, s in pieces]
        self.unknown = min(scores, default=0.0) - UNKNOWN_COST
        self.automaton = ahocorasick.Automaton()
        for (piece, _), score in zip(pieces, scores):
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in pieces)
        self.cache: dict[str, int] = {}

    def viterbi(self, text: str) -> int:
        """Tokens of the best cut of ``text``, in which spaces are marks."""
        n = len(text)
        none = -float("inf")
        best, tokens, single = [none] * (n + 1), [0] * (n + 1), [False] * n
        best[0] = 0.0
        unknown_end = [False] * (n + 1)
        at = 0  # places below it are settled

        def settle(to: int) -> None:
            # The candidate of an unknown character starts latest of all, so it wins only if it is better.
            nonlocal at
            while at < to:
                at += 1
                if not single[at - 1]:
                    score = best[at - 1] + self.unknown
                    if score > best[at]:
                        best[at] = score
                        if self.bytes:
                            tokens[at] = tokens[at - 1] + len(text[at - 1].encode())
                        else:
                            tokens[at] = tokens[at - 1] + (not unknown_end[at - 1])
                            unknown_end[at] = True

        if len(self.automaton):
            for last, (size, piece_score) in self.automaton.iter(text):
                end = last + 1
                settle(last)
                score = best[end - size] + piece_score
                if size == 1:
                    single[last] = True
                if score > best[end]:  # longer pieces come first
                    best[end], tokens[end] = score, tokens[end - size] + 1
        settle(n)
        return tokens[n]

    def word(self, word: str) -> int:
        count = self.viterbi(word)
        if len(word) <= CACHED_WORD:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if not self.cuts:
            return self.viterbi(marked)
        if MARK * 2 in marked or MARK in text:
            words = re.findall(f"{MARK}+[^{MARK}]*", marked)
        else:
            words = [MARK + w for w in text.split(" ")]
        got = list(map(self.cache.get, words))
        if None in got:
            got = [self.cache.get(w) if g is None and w in self.cache else self.word(w) if g is None else g for g, w in zip(got, words)]
        return sum(got)


def vocabulary(content: bytes) -> tuple[list[tuple[str, float]], bool]:
    """Pieces and scores of a sentencepiece model file, and whether it falls back to bytes."""
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    usual = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in usual], any(model.is_byte(i) for i in range(model.vocab_size()))


_counters: dict[int, Counter] = {}


def counter(content: bytes) -> Counter:
    key = hash(content)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(*vocabulary(content))
    return _counters[key]


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of ``text`` under the unigram vocabulary in ``path``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(file_bytes(path))

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        count = counter(shared.value).count
        return pa.array([count(t.as_py()) for t in texts], pa.int64())

    return docs.withColumn(out, of(text_or_empty(text)))


def report(docs: DataFrame, path: str) -> DataFrame:
    return token_counts(docs.select("doc_id", "text"), path).select("doc_id", "n_tokens")
