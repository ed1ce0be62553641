"""Token counts of a unigram tokenizer without the tokens: count-only Viterbi.

An Aho-Corasick automaton enumerates the vocabulary's matches in a segment. For
every position the best score of a path that ends there and its number of
tokens are carried; no back pointers and no tokens are kept. Ties go as in the
tokenizers library: pieces are tried by where they begin, and a later one must
be strictly better. A character that no one-character piece covers is unknown,
at the least score less ten; neighbouring unknowns are one token, or the bytes
of them with byte fallback.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from lakemill.llm.common import texts
from lakemill.llm.tokens import WordCache, worker_cache

UNKNOWN_PENALTY = 10.0
#: Stands for a space; a text begins with one, and segments begin at each.
MARK = "▁"


def vocabulary_of(model_path: str) -> list[tuple[str, float]]:
    """(piece, score) by id from a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the tokens of segments under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        self.byte_fallback = byte_fallback
        self.least = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.cache = WordCache(self.segment, 200_000)

    def segment(self, text: str) -> int:
        """Tokens of the best path through ``text``."""
        n = len(text)
        best = [0.0] + [-math.inf] * n
        count = [0] * (n + 1)
        loose = [False] * (n + 1)  # the path ends in an unknown
        single = [False] * (n + 1)
        at = 0

        # Matches come by where they end, and of those the longest first: the one that begins first.
        for end, (size, score) in self.automaton.iter(text):
            while at < end:
                if not single[at]:
                    self.unknown(text, at, best, count, loose)
                at += 1
            start = end + 1 - size
            value = best[start] + score
            if value > best[end + 1]:
                best[end + 1] = value
                count[end + 1] = count[start] + 1
            if size == 1:
                single[end] = True
        for at in range(at, n):
            if not single[at]:
                self.unknown(text, at, best, count, loose)
        return count[n]

    def unknown(self, text: str, at: int, best: list[float], count: list[int], loose: list[bool]) -> None:
        """The character at ``at`` as an unknown, tried after all matches that end with it."""
        value = best[at] + self.least
        if value > best[at + 1]:
            best[at + 1], loose[at + 1] = value, True
            if self.byte_fallback:
                count[at + 1] = count[at] + len(text[at].encode())
            else:
                count[at + 1] = count[at] + (not loose[at])

    def text(self, text: str) -> int:
        """Tokens of a whole text: segments begin at every mark."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        first, *rest = marked.split(MARK)
        return (self.cache[first] if first else 0) + sum(map(self.cache.__getitem__, (MARK + r for r in rest)))


def counter(model_path: str, byte_fallback: bool) -> Counter:
    return worker_cache(
        f"counter:{model_path}:{byte_fallback}", lambda: Counter(vocabulary_of(model_path), byte_fallback)
    )


def token_counts(
    docs: DataFrame, model_path: str, byte_fallback: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, n_chars of every row.

    A null or empty text has no tokens. Repeated rows are counted alike, a null
    doc_id stays null, an empty table gives an empty result. Segments of any
    length are whole; only short ones are cached.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = counter(model_path, byte_fallback)
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_tokens": batch["text"].map(own.text), "n_chars": batch["text"].map(len)}
            )

    lean, restored = texts(docs, id_col, text_col)
    return restored(lean.mapInPandas(run, "doc_id string, n_tokens long, n_chars long"))
