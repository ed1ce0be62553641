"""Alignment of the tokens of two tokenizers over one text, by shared ends before spaces.

Both tokenizers encode the whole text. Their tokens, as bytes, must give the
same bytes again, a space and the text; then every token has a place in them.
An end that tokens of both share, verified on these places, is an anchor where
both go on with a token that begins with a space. Anchors cut a document into
windows, pairs of id tuples. What lies in a window depends on its ids alone, so
its groups and links are worked out once in a chunk and remembered by the id tuples.

How many documents link a pair of ids is counted over the corpus without a row
per document and pair: tasks work in chunks of bounded size, keep the distinct
pairs of a chunk with the number of its documents, and documents point to them.
Chunks' pairs are added up, joined with the totals, and go back to the
documents of their chunk.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakemill.llm.common import stored, texts
from lakemill.llm.tokens import Encoder, WordCache, byte_alphabet, worker_cache

#: A space between other characters; the model of B never merges across it.
SINGLE = re.compile("(?<=[^ ]) (?=[^ ])")
#: A chunk ends after so many characters or documents.
CHUNK_CHARS, CHUNK_DOCS = 4_000_000, 4096
#: Longer texts are encoded by B word by word, which takes less memory.
WHOLE_CHARS = 100_000


@dataclass(frozen=True)
class Vocabularies:
    """Files of a byte-level vocabulary (A) and of a piece vocabulary with byte fallback (B)."""

    a: str
    b: str


class BytesTokenizer(Encoder):
    """A: ids of a space and a text; strings of added tokens are plain text."""

    def __init__(self, path: str, generation: int = 100_000):
        super().__init__(path, spaced=True, generation=generation)
        self.whole.encode_special_tokens = True
        self.marks, self.entire = None, False
        letters = {c: b for b, c in enumerate(byte_alphabet())}
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.entries = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            # An added token is no entry in byte-level letters; its id never comes out.
            self.entries[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()

    def ids(self, text: str) -> np.ndarray:
        try:
            packed = b"".join(map(self.cache.__getitem__, text.split(" ")))
        except Exception as odd:
            if type(odd).__name__ != "OddSpace":
                raise
            packed = self.encode(" " + text)
        return np.frombuffer(packed, dtype="uint32")


class PieceTokenizer:
    """B: ids of a text, before which the model puts a space.

    The library takes less time for a whole text than a cache for its words.
    No piece but runs of marks has a mark after its first letter, so merges do
    not cross a space between other letters, and long texts can go word by word.
    """

    def __init__(self, path: str, generation: int = 100_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cache = WordCache(self.word, generation)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.entries = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.cuts = all(set(p) == {"▁"} for p in pieces if "▁" in p[1:])

    def word(self, word: str) -> bytes:
        return array("I", self.model.encode(word, num_threads=1)).tobytes()

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= WHOLE_CHARS:
            return np.array(self.model.encode(text, num_threads=1), dtype="uint32")
        words = text.split(" ") if self.cuts else [text]
        if self.cuts and "" in words:
            words = SINGLE.split(text)
        return np.frombuffer(b"".join(map(self.cache.__getitem__, words)), dtype="uint32")


class Aligner:
    """Both tokenizers of a worker, and what its chunks need of their vocabularies."""

    def __init__(self, files: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = BytesTokenizer(files.a), PieceTokenizer(files.b)
        measure = lambda entries: np.array([len(e) for e in entries], dtype="int64")
        spaced = lambda entries: np.array([e[:1] == b" " for e in entries])
        self.a_lengths, self.b_lengths = measure(self.a.entries), measure(self.b.entries)
        self.a_spaced, self.b_spaced = spaced(self.a.entries), spaced(self.b.entries)
        flat = lambda entries: np.frombuffer(b"".join(entries), dtype="uint8")
        self.a_flat, self.b_flat = flat(self.a.entries), flat(self.b.entries)
        self.a_starts, self.b_starts = (np.cumsum(x) - x for x in (self.a_lengths, self.b_lengths))
        # Decimal ids with what may follow them: another of the same side and group, the other side, another group.
        self.size = max(len(self.a.entries), len(self.b.entries))
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(self.size)]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None where they don't give the bytes of a space and the text."""
        if not text:
            return None
        a, b, want = self.a.ids(text), self.b.ids(text), np.frombuffer((" " + text).encode(), dtype="uint8")
        same = spells(a, want, self.a_lengths, self.a_starts, self.a_flat)
        return (a, b) if same and spells(b, want, self.b_lengths, self.b_starts, self.b_flat) else None

    def worked_out(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[str, bytes]]:
        """Of windows by their id tuples: groups as text, and the packed (A id << 32 | B id) of every link.

        The windows stand one behind the other and are aligned at once.
        """
        a = np.frombuffer(b"".join([x for x, _ in keys]), dtype="uint32")
        b = np.frombuffer(b"".join([y for _, y in keys]), dtype="uint32")
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        at = np.searchsorted(b_ends, a_ends)
        shared = b_ends[at] == a_ends
        last_a, last_b = np.zeros(len(a), dtype="int64"), np.zeros(len(b), dtype="int64")
        last_a[shared] = 1
        last_b[at[shared]] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        # A token stands behind the B tokens of earlier groups; a B token behind the A tokens of its own as well.
        place_a = np.arange(len(a)) + np.append(0, upto_b[:-1])[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b]
        names = np.empty(len(a) + len(b), dtype="int64")
        names[place_a] = a + self.size * last_a
        names[place_b] = b + 2 * self.size * last_b
        pieces = list(map(self.names.__getitem__, names.tolist()))
        # Between two neighbouring ends of either kind lies the overlap of one A token with one B token.
        ends = np.union1d(a_ends, b_ends)
        of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        pairs = (a[of_a].astype("int64") << 32 | b[of_b].astype("int64")).tobytes()
        cut_a = np.cumsum([0] + [len(x) >> 2 for x, _ in keys])
        cut_b = np.cumsum([0] + [len(y) >> 2 for _, y in keys])
        groups = np.append(0, np.cumsum(last_a))[cut_a]
        first, links = (cut_a + cut_b).tolist(), ((cut_a + cut_b - groups) * 8).tolist()
        return [
            ("".join(pieces[p:q])[:-1], pairs[r:s])
            for p, q, r, s in zip(first, first[1:], links, links[1:])
        ]


def spells(ids: np.ndarray, want: np.ndarray, lengths: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> bool:
    """Whether the entries of the ids, one behind the other, are these bytes."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    if ends[-1] != len(want):
        return False
    return np.array_equal(flat[np.repeat(starts[ids] - ends + sizes, sizes) + np.arange(len(want))], want)


def windows_of(aligner: Aligner, a: np.ndarray, b: np.ndarray) -> tuple[list[tuple[bytes, bytes]], int]:
    """Packed id tuples between anchors, and the number of groups of the document.

    Anchors are shared ends before tokens with a space on both sides, and the last end.
    """
    a_ends, b_ends = np.cumsum(aligner.a_lengths[a]), np.cumsum(aligner.b_lengths[b])
    at = np.searchsorted(b_ends, a_ends)
    shared = np.flatnonzero(b_ends[at] == a_ends)
    here, there = shared + 1, at[shared] + 1
    inner = here < len(a)
    inner[inner] = aligner.a_spaced[a[here[inner]]] & aligner.b_spaced[b[there[inner]]]
    inner[-1] = True
    i, j = [0, *(here[inner] * 4).tolist()], [0, *(there[inner] * 4).tolist()]
    a_packed, b_packed = a.tobytes(), b.tobytes()
    return [(a_packed[p:q], b_packed[r:s]) for p, q, r, s in zip(i, i[1:], j, j[1:])], len(shared)


class Chunk:
    """Documents of one chunk, and its windows: worked out once each, and remembered by their id tuples."""

    def __init__(self, name: int, aligner: Aligner):
        self.name, self.aligner = name, aligner
        self.numbers: dict[tuple[bytes, bytes], int] = {}
        # Of every window, by its number.
        self.groups: list[str] = []
        self.pairs: list[bytes] = []
        self.docs: list[tuple] = []
        self.chars = 0

    def add(self, doc_id: str | None, text: str) -> None:
        self.chars += len(text)
        tokens = self.aligner.tokens(text)
        if tokens is None:
            self.docs.append((doc_id, 0, 0, 0, "", np.zeros(0, dtype="int64")))
            return
        keys, n_groups = windows_of(self.aligner, *tokens)
        numbers = self.numbers
        windows = list(map(numbers.get, keys))
        if None in windows:
            new = list(dict.fromkeys([key for key, number in zip(keys, windows) if number is None]))
            for key, (groups, pairs) in zip(new, self.aligner.worked_out(new)):
                numbers[key] = len(numbers)
                self.groups.append(groups)
                self.pairs.append(pairs)
            windows = list(map(numbers.__getitem__, keys))
        digest = hashlib.sha256(";".join(map(self.groups.__getitem__, windows)).encode()).hexdigest()
        self.docs.append((doc_id, len(tokens[0]), len(tokens[1]), n_groups, digest, np.array(windows)))

    def full(self) -> bool:
        return self.chars >= CHUNK_CHARS or len(self.docs) >= CHUNK_DOCS

    def rows(self) -> Iterator[pd.DataFrame]:
        """A row for each document, and one with the chunk's pairs."""
        sizes = np.array([len(p) // 8 for p in self.pairs], dtype="int64")
        starts = np.cumsum(sizes) - sizes
        every = np.frombuffer(b"".join(self.pairs), dtype="int64")
        pairs, index = np.unique(every, return_inverse=True)
        held = np.zeros(len(pairs), dtype="int64")
        out = []
        for doc_id, a, b, n_groups, groups, windows in self.docs:
            own, often = np.unique(windows, return_counts=True)
            each = sizes[own]
            flat = np.repeat(starts[own] - np.cumsum(each) + each, each) + np.arange(each.sum())
            mine, back = np.unique(index[flat], return_inverse=True)
            times = np.bincount(back, weights=np.repeat(often, each), minlength=len(mine)).astype("int64")
            held[mine] += 1
            out.append((self.name, doc_id, a, b, n_groups, a + b - n_groups, groups, mine.astype("<i4").tobytes(), times.astype("<i4").tobytes()))
        none = (None,) * 8
        names = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "mine", "times", "pairs", "held"]
        rows = [(*doc, None, None) for doc in out] + [(self.name, *none, pairs, held)]
        for at in range(0, len(rows), 500):
            piece = pd.DataFrame(rows[at : at + 500], columns=names, dtype=object)
            yield piece.astype({c: "Int64" for c in ("chunk", "n_a", "n_b", "n_groups", "n_links")})


CHUNKED = (
    "chunk long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "mine binary, times binary, pairs array<long>, held array<long>"
)


def chunked(lean: DataFrame, files: Vocabularies) -> DataFrame:
    """Documents and pairs of chunks, from (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = worker_cache(f"aligner:{files}", lambda: Aligner(files))
        name = TaskContext.get().partitionId() << 33
        chunk = Chunk(name, aligner)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                chunk.add(doc_id, text)
                if chunk.full():
                    yield from chunk.rows()
                    name += 1
                    chunk = Chunk(name, aligner)
        if chunk.docs:
            yield from chunk.rows()

    return lean.mapInPandas(run, CHUNKED)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, n, best): documents that link the ids, and whether no pair of the A id has more. Input (pair, held)."""
    counts = pairs.groupBy("pair").agg(F.sum("held").alias("n"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def token_align(docs: DataFrame, files: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A null or empty text, or one that the tokens of A or B do not give back
    byte by byte (it holds the mark of pieces), has no tokens: zeros and an empty
    digest. Rows of one id, or of none, are documents of their own. An empty
    table gives an empty result. Other columns are left out.
    """
    lean, typed = texts(docs, id_col, text_col)
    out = stored(chunked(lean, files), "aligned")
    pairs = out.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "pair"))
    pairs = pairs.select("chunk", "at", F.col("pair.pairs").alias("pair"), F.col("pair.held").alias("held"))
    counts = pair_counts(pairs.select("pair", "held"))
    totals = pairs.select("chunk", "at", "pair").join(counts, "pair").select(F.col("chunk").alias("of"), "at", "n", "best")
    rows = out.where("pairs IS NULL").drop("pairs", "held")

    def finish(found: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        counts, best = np.zeros(len(known), dtype="int64"), np.zeros(len(known), dtype="int64")
        counts[known["at"]], best[known["at"]] = known["n"], known["best"]
        sums, bests = [], []
        for mine, times in zip(found["mine"], found["times"]):
            at, often = np.frombuffer(mine, dtype="<i4"), np.frombuffer(times, dtype="<i4").astype("int64")
            sums.append(int((counts[at] * often).sum()))
            bests.append(int((best[at] * often).sum()))
        return found.drop(columns=["chunk", "mine", "times"]).assign(n_best=bests, count_sum=sums)

    done = rows.groupBy("chunk").cogroup(totals.groupBy("of")).applyInPandas(
        finish,
        "doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long",
    )
    return typed(done).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
