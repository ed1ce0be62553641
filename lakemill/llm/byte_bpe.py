"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks that overlap. Chunks are pre-tokenised in
parallel, each from its own first character, so a chunk may begin inside a
pre-token. The pattern looks ahead but never behind: once two neighbours share
a boundary they agree from there on, and the text is stitched at the first
boundary in the overlap that both report. The pre-tokens between stitches are
encoded one by one. A pair that shares none (a run longer than the overlap) is
pre-tokenised again as one text. Short texts are a single chunk and never move.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lakemill.llm.common import slices, texts
from lakemill.llm.tokens import WordCache, worker_cache

CHUNK, OVERLAP = 16_384, 512
#: A contraction that is cut by a chunk's end changes boundaries in its last two characters.
LOOSE = 3


class Codec:
    """Ids of pre-tokens by a rank file, and bytes of ids."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.single = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )._encode_single_piece
        self.bytes_of = {rank: piece for piece, rank in ranks.items()}
        self.cache = WordCache(lambda piece: array("I", self.single(piece)).tobytes())

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.cache.__getitem__, pieces))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, array("I", packed)))


def codec(ranks_path: str, pattern: str) -> Codec:
    return worker_cache(f"codec:{ranks_path}:{pattern}", lambda: Codec(ranks_path, pattern))


def starts_of(pieces: list[str], first: int = 0) -> np.ndarray:
    """Where each pre-token begins."""
    lengths = np.fromiter(map(len, pieces), dtype="int64", count=len(pieces))
    return first + np.cumsum(lengths) - lengths


def chunks(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, bool, str]]:
    """(number, last, text) of the overlapping chunks."""
    count = max(1, -(-len(text) // chunk))
    for k in range(count):
        yield k, k == count - 1, text[k * chunk : (k + 1) * chunk + overlap]


class Stitcher:
    """Takes the chunks of one text in order and gives its pre-tokens piece by piece."""

    def __init__(self, pattern):
        self.pattern, self.text, self.at, self.starts = pattern, "", 0, np.zeros(0, dtype="int64")

    def between(self, stop: int) -> list[str]:
        """Pre-tokens of the held text from ``at`` up to ``stop``."""
        cuts = [*self.starts[(self.starts >= self.at) & (self.starts < stop)].tolist(), stop]
        first = self.base
        return [self.text[a - first : b - first] for a, b in zip(cuts, cuts[1:])]

    def add(self, first: int, text: str, starts: np.ndarray) -> list[str]:
        """``starts``: boundaries of this chunk, which begins at ``first``; returns what is now settled."""
        if not self.text:
            self.base, self.text, self.starts = first, text, starts
            return []
        held_end = self.base + len(self.text)
        shared = np.intersect1d(self.starts, starts)
        shared = shared[(shared >= max(first, self.at)) & (shared <= held_end - LOOSE)]
        if len(shared):
            out = self.between(int(shared[0]))
            self.base, self.text, self.starts, self.at = first, text, starts, int(shared[0])
            return out
        whole = self.text[self.at - self.base :] + text[held_end - first :]
        self.base, self.text = self.at, whole
        self.starts = starts_of(self.pattern.findall(whole), self.at)
        return []

    def rest(self) -> list[str]:
        return self.between(self.base + len(self.text)) if self.text else []


def bpe(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP, ids: bool = True,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``ids``, the packed ids and decoded bytes.

    Null and empty texts have no tokens. Repeated rows give repeated results,
    a null doc_id stays null, an empty table gives an empty result.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must lie within a chunk")
    lean, restored = texts(docs, id_col, text_col)
    more = ["ids", "decoded"] if ids else []
    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(
        f", {c} binary" for c in more
    )
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *more]

    def result(own: Codec, doc_id, packed: bytes) -> tuple:
        plain = own.decode(packed)
        digests = hashlib.sha256(packed).hexdigest(), hashlib.sha256(plain).hexdigest()
        return (doc_id, len(packed) // 4, *digests, *((packed, plain) if ids else ()))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks_path, pattern)
        for batch in slices(batches):
            yield pd.DataFrame(
                [result(own, i, own.encode(own.pattern.findall(t))) for i, t in zip(batch["doc_id"], batch["text"])],
                columns=columns,
            )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
                yield pd.DataFrame(
                    [(row, k, last, doc_id, piece) for k, last, piece in chunks(text, chunk, overlap)],
                    columns=["row", "k", "last", "doc_id", "text"],
                )

    def pre_tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = codec(ranks_path, pattern).pattern.findall
        for batch in batches:
            starts = []
            for text, k, last in zip(batch["text"], batch["k"], batch["last"]):
                found = starts_of(find(text))
                found = found if last else found[found <= len(text) - LOOSE]
                starts.append(found.astype("<u4").tobytes())
            yield batch.assign(starts=starts)

    def stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks_path, pattern)
        stitcher, parts = None, []
        for batch in batches:
            out = []
            for _, k, last, doc_id, text, found in batch[["row", "k", "last", "doc_id", "text", "starts"]].itertuples(index=False):
                if k == 0:
                    stitcher, parts = Stitcher(own.pattern), []
                starts = np.frombuffer(found, dtype="<u4").astype("int64") + k * chunk
                parts.append(own.encode(stitcher.add(k * chunk, text, starts)))
                if last:
                    out.append(result(own, doc_id, b"".join([*parts, own.encode(stitcher.rest())])))
            yield pd.DataFrame(out, columns=columns)

    short = lean.where(F.char_length("text") <= chunk).mapInPandas(whole, schema)
    parts = (
        lean.where(F.char_length("text") > chunk)
        .withColumn("row", F.monotonically_increasing_id())
        .mapInPandas(cut, "row long, k int, last boolean, doc_id string, text string")
        .repartition("row", "k")
        .mapInPandas(pre_tokenise, "row long, k int, last boolean, doc_id string, text string, starts binary")
    )
    long = parts.repartition("row").sortWithinPartitions("row", "k").mapInPandas(stitch, schema)
    return restored(short.unionByName(long))


def decoder(ranks_path: str, pattern: str) -> Callable[[bytes], bytes]:
    """Packed ids → bytes, for use on workers."""
    return lambda packed: codec(ranks_path, pattern).decode(packed)
