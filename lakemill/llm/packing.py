"""Packing: concatenate and cut.

Pass one encodes every document and notes, per input partition, the tokens
before it; partition totals are summed into bases. Pass two adds base and
running count to the global offset of each document and cuts it at multiples
of the window; a document over a boundary leaves one record on either side.
All sequences but the last are full, whatever the lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakemill.llm.common import part_bases, slices, stored, texts
from lakemill.llm.tokens import encoder, vocabulary_size

WINDOW = 4096


def width(vocabulary: int) -> str:
    """The narrowest unsigned type that holds every id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encoded_parts(docs: DataFrame, make: Callable, vocabulary: int, end_id: int) -> DataFrame:
    """(part, before, doc_id, n, ids) for every document; ``make`` gives a worker's text → packed ids."""
    kind, tail = width(vocabulary), np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, before = make(), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids = [np.frombuffer(encode(t) + tail, dtype="<u4").astype(kind) for t in batch["text"]]
            counts = np.asarray([len(x) for x in ids], dtype="int64")
            ends = before + np.cumsum(counts)
            yield pd.DataFrame({
                "part": part, "before": ends - counts, "doc_id": batch["doc_id"], "n": counts,
                "ids": [x.tobytes() for x in ids],
            })
            before += int(counts.sum())

    return docs.mapInPandas(run, "part int, before long, doc_id string, n long, ids binary")


def cut(first: int, ids: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, int, int]]:
    """(start, ids, sequence, offset) of the pieces of a document that begins at global offset ``first``."""
    start = 0
    while start < len(ids):
        sequence, offset = divmod(first + start, window)
        piece = ids[start : start + window - offset]
        yield start, piece, sequence, offset
        start += len(piece)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, spaced: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    ids (packed little-endian 32-bit). Every document ends in ``end_id``, so a
    null or empty text is one piece of one token. Documents follow each other
    in the order of the input's partitions; a repeated row or doc_id is packed
    as often as it occurs, a null doc_id stays null. An empty table gives no pieces.
    """
    lean, restored = texts(docs, id_col, text_col)
    vocabulary = max(vocabulary_size(tokenizer), end_id + 1)
    tokens = stored(encoded_parts(lean, lambda: encoder(tokenizer, spaced).encode, vocabulary, end_id), "packing")
    bases = part_bases(tokens.groupBy("part").agg(F.sum("n").alias("tokens")), "tokens")
    kind = width(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            out = []
            for doc_id, first, packed in zip(batch["doc_id"], batch["first"], batch["ids"]):
                ids = np.frombuffer(packed, dtype=kind).astype("<u4")
                out += [
                    (doc_id, start, len(piece), zlib.crc32(raw := piece.tobytes()), len(ids), sequence, offset, raw)
                    for start, piece, sequence, offset in cut(int(first), ids, window)
                ]
            yield pd.DataFrame(out, columns=columns)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    # One row of 12 bytes for each split of the input: that bounds the broadcast.
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("first"), "ids")
    return restored(
        placed.mapInPandas(
            run,
            "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
            "offset long, ids binary",
        )
    )


def sequences(pieces: DataFrame, pad_id: int = 0, window: int = WINDOW) -> DataFrame:
    """(sequence_id, ids array): the packed sequences, the last one padded. A group holds at most ``window`` ids."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("offset")["ids"]
        ids = np.frombuffer(b"".join(ordered), dtype="<u4").astype("int64")
        full = np.concatenate([ids, np.full(window - len(ids), pad_id, dtype="int64")])
        return pd.DataFrame({"sequence_id": [key[0]], "ids": [full.tolist()]})

    return pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(
        run, "sequence_id long, ids array<long>"
    )
