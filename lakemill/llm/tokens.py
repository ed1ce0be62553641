"""Whole-text ids of public tokenizers, by way of bounded caches of words.

Byte-level BPE merges never cross a pre-token, and a space with a non-space on
either side always begins one. So a text is cut at such spaces, each word is
encoded by the tokenizers library, and frequent words come from a cache.
"""

from __future__ import annotations

import re
import sys
import types
from array import array

#: Letters, marks behind them (one pre-token of either vocabulary), and a word of the next line.
LATIN_MARK = re.compile(
    r"([A-Za-zÀ-ÖØ-öø-ÿ]+)(?:([.,;:!?|#*$%&@+=~^/_()\[\]{}\"-]+)(?:\n([A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]*))?)?"
)
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Words kept by each of the two generations of a cache, and the longest word kept.
GENERATION, LONGEST = 350_000, 64


def worker_cache(key: str, make):
    """What ``make`` returns, once per worker process: workers serve many tasks."""
    store = sys.modules.setdefault("_lakemill_worker_cache", types.ModuleType("_lakemill_worker_cache"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)


class WordCache(dict):
    """word → value with two generations: a word that is used again survives, memory stays bounded."""

    def __init__(self, encode, generation: int = GENERATION):
        super().__init__()
        self.encode, self.old, self.generation = encode, {}, generation

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= self.generation:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


class OddSpace(Exception):
    """A cut at every space would split a run of white space."""


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in table]
    return [table.get(b) or chr(256 + rest.index(b)) for b in range(256)]


class Encoder:
    """Packed little-endian unsigned 32-bit ids of whole texts.

    ``spaced``: words carry the space before them (byte-level vocabularies);
    else the tokenizer drops white space and lower-cases (word-end vocabularies).
    Ids are those of the library's ``encode`` without added special tokens: the
    string of an added token in a text is that token, and ends the words beside it.
    """

    def __init__(self, path: str, spaced: bool, generation: int = GENERATION):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        added = self.whole.get_added_tokens_decoder()
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        # Such tokens are found in normalized text, or take space or whole words with them: only the library splits at them.
        self.entire = any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values())
        self.model = self.whole.model
        self.spaced = spaced
        self.tokenize = self.model.tokenize
        self.letters = byte_alphabet()
        self.accents = {c: "".join(self.letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.lead = " " if spaced else ""
        self.cache = WordCache(self.word, generation)
        self.bare = WordCache(self.bare_word, generation // 4)

    def plain(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token."""
        if not piece.isascii() or not piece.isalpha():
            piece = "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def letters_piece(self, word: str, lead: str) -> bytes:
        if not self.spaced:
            return self.piece(word.lower())
        # \u0120 stands for the space
        spelled = word if word.isascii() else word.translate(self.accents)
        return array("I", [t.id for t in self.tokenize("\u0120" + spelled if lead else spelled)]).tobytes()

    def word(self, word: str) -> bytes:
        """A word after a space."""
        m = LATIN_MARK.fullmatch(word)
        if m is None:
            if not word or word.strip() != word:
                raise OddSpace
            return self.plain(self.lead + word)
        letters, marks, line = m.groups()
        if marks is None:
            return self.letters_piece(letters, " ")
        ids = self.cache[letters] + self.bare[marks]
        if line:
            ids += self.bare["\n"] + self.bare[line] if self.spaced else self.cache[line]
        return ids

    def bare_word(self, word: str) -> bytes:
        """A word without a space before it."""
        m = LATIN_MARK.fullmatch(word)
        if m is None or m[3]:
            return self.plain(word)
        return self.bare[m[1]] + self.bare[m[2]] if m[2] else self.letters_piece(word, "")

    def joined(self, words: list[str], ids) -> bytes:
        """``words`` with one space between them; the first one has none before it."""
        if not self.spaced:
            return b"".join(map(ids, words))
        return b"".join([self.plain(words[0]), *map(ids, words[1:])])

    def edge(self, word: str) -> bytes:
        return self.cache[word] if word.strip() == word else self.plain(self.lead + word)

    def encode(self, text: str) -> bytes:
        if self.entire:
            return self.plain(text)
        if self.marks and self.marks.search(text):
            parts = self.marks.split(text)
            return b"".join(self.added[part] if i % 2 else self.unmarked(part) for i, part in enumerate(parts))
        return self.unmarked(text)

    def unmarked(self, text: str) -> bytes:
        """Ids of a text without strings of added tokens."""
        if not text:
            return b""
        words = text.split(" ")
        if words[0] and words[-1].strip() and words[0].strip() == words[0]:
            try:
                return self.joined(words, self.cache.__getitem__)
            except OddSpace:
                pass
        return self.joined(CUT.split(text), self.edge)


def vocabulary_size(path: str) -> int:
    """Ids of a vocabulary file, added tokens included; read on the driver."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return worker_cache(f"encoder:{path}:{spaced}", lambda: Encoder(path, spaced))
