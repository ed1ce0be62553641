"""Token-ID files: concatenated ids with Elias-Fano document boundaries.

A file is a run of blocks. A block holds the ids of consecutive documents one
after the other and, in Elias-Fano form, the ends of the documents and their
doc_ids: the low bits of each value are packed, the high bits are one unary bit
vector, and the position of every 64th one is sampled for ``select``. That is
about two bits and the low bits for each document; no table of 64-bit offsets.

Spark's own writer and its ``binaryFile`` reader carry the blocks, so files go
to any store Spark reaches, appear only when their task commits, and survive
lost executors.

Block: 4 bytes ``LMID``, a header of 12 signed 64-bit integers, then the ends,
the doc_ids and the ids, then one line feed (the writer's row separator).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.common import column, part_bases, slices
from lakemill.llm.packing import width
from lakemill.llm.tokens import encoder, vocabulary_size
from lakemill.session import scratch_path

MAGIC = b"LMID"
#: part, tokens of the part before the block, documents, null doc_ids, tokens, bytes an id, smallest doc_id,
#: low bits of the ends and of the doc_ids, bytes of the ends, of the doc_ids and of the ids.
HEADER = "<12q"
SAMPLE = 64
BLOCK_TOKENS = 1 << 20
BLOCKS_A_FILE = 8


class EliasFano:
    """A non-decreasing sequence of unsigned integers, readable by position."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype="uint64")
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(low_bits)).astype("int64") + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype="uint8")
        unary[ones] = 1
        shifts = np.arange(low_bits, dtype="uint64")
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype("uint8").ravel(), bitorder="little")
        return cls(n, low_bits, low, np.packbits(unary, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return b"".join([self.samples.tobytes(), self.low.tobytes(), self.high.tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes, n: int, low_bits: int) -> EliasFano:
        samples = np.frombuffer(raw, "<u4", -(-n // SAMPLE))
        low_size = -(-n * low_bits // 8)
        low = np.frombuffer(raw, "u1", low_size, samples.nbytes)
        return cls(n, low_bits, low, np.frombuffer(raw, "u1", -1, samples.nbytes + low_size), samples)

    def lows(self, first: int, count: int) -> np.ndarray:
        """Low bits of ``count`` values from ``first`` on."""
        if not self.low_bits:
            return np.zeros(count, dtype="uint64")
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[begin // 8 : -(-end // 8)], bitorder="little")[begin % 8 :]
        bits = bits[: end - begin].reshape(count, self.low_bits).astype("uint64")
        return (bits << np.arange(self.low_bits, dtype="uint64")).sum(axis=1, dtype="uint64")

    def select(self, i: int) -> int:
        """The position of one number ``i`` in the high bits, from the sample before it."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        while left:
            start = at + 1
            window = np.unpackbits(self.high[start // 8 : start // 8 + 64], bitorder="little")[start % 8 :]
            ones = np.flatnonzero(window)
            if len(ones) >= left:
                return start + int(ones[left - 1])
            left -= len(ones)
            at = (start // 8 + 64) * 8 - 1
        return at

    def __getitem__(self, i: int) -> int:
        return (self.select(i) - i << self.low_bits) | int(self.lows(i, 1)[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype("uint64") << np.uint64(self.low_bits)
        return high | self.lows(0, self.n)


def block_bytes(part: int, before: int, doc_ids: list, ids: list[np.ndarray], kind: str) -> bytes:
    """One block; ``doc_ids`` ascend, nulls first."""
    nulls = sum(x is None for x in doc_ids)
    known = np.asarray(doc_ids[nulls:], dtype="int64")
    least = int(known[0]) if len(known) else 0
    ends = EliasFano.build(np.cumsum([len(x) for x in ids]))
    names = EliasFano.build(known.astype("uint64") - np.uint64(least & (1 << 64) - 1))
    body = np.concatenate(ids).astype(kind).tobytes()
    a, b = ends.to_bytes(), names.to_bytes()
    tokens = sum(map(len, ids))
    head = struct.pack(
        HEADER, part, before, len(ids), nulls, tokens, np.dtype(kind).itemsize, least, ends.low_bits, names.low_bits,
        len(a), len(b), len(body),
    )
    return b"".join([MAGIC, head, a, b, body])


class Block:
    """Reads a block: documents by position, without touching the others."""

    def __init__(self, raw: memoryview):
        if bytes(raw[:4]) != MAGIC:
            raise ValueError("not a block of token ids")
        (self.part, self.before, self.n, self.nulls, self.tokens, size, self.least, low_a, low_b, a, b, c) = (
            struct.unpack_from(HEADER, raw, 4)
        )
        at = 4 + struct.calcsize(HEADER)
        self.size = at + a + b + c
        if len(raw) < self.size:
            raise ValueError("a block of token ids is cut short")
        self.ends = EliasFano.from_bytes(raw[at : at + a], self.n, low_a)
        self.names = EliasFano.from_bytes(raw[at + a : at + a + b], self.n - self.nulls, low_b)
        self.ids = np.frombuffer(raw, f"<u{size}", c // size, at + a + b)

    def span(self, i: int) -> tuple[int, int]:
        """Where document ``i`` of the block lies among its ids, by two selects."""
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.names[i - self.nulls]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, tokens of the part before it, ids) of every document."""
        ends = self.ends.all().astype("int64")
        names = [None] * self.nulls + [self.least + int(x) for x in self.names.all()]
        for name, start, end in zip(names, np.concatenate([[0], ends[:-1]]), ends):
            yield name, self.before + int(start), self.ids[start:end].astype("<u4")


def blocks(raw: bytes) -> Iterator[Block]:
    """The blocks of a file."""
    view = memoryview(raw)
    while len(view):
        block = Block(view)
        yield block
        view = view[block.size + 1 :]


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, spaced: bool = True,
    id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encode all documents and write them below ``path`` in ascending doc_id order, each ending in ``end_id``.

    ``parts`` ranges of doc_id, cut at its quantiles, are sorted and written
    each by one task; a block closes at ``block_tokens``, so a task holds one
    block and one document. Null doc_ids come first; equal ones follow each
    other by number of tokens, then by ids. A null or empty text is its end id
    alone. An empty table writes no blocks.
    """
    name = column(id_col).cast("long")
    lean = docs.select(
        F.coalesce(name, F.lit(0)).alias("doc_id"), name.isNotNull().alias("known"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 4 * tasks
    quantiles = [i / parts for i in range(1, parts)]
    cuts = lean.where("known").agg(F.percentile_approx("doc_id", quantiles, 20 * parts)).first()[0] if quantiles else None
    cuts = np.unique(np.asarray(cuts or [], dtype="int64"))  # at most one number for each part
    kind = width(max(vocabulary_size(tokenizer), end_id + 1))
    tail = np.asarray([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(tokenizer, spaced).encode
        for batch in slices(batches):
            ids = [np.frombuffer(ids_of(t) + tail, dtype="<u4").astype(kind) for t in batch["text"]]
            part = np.where(batch["known"], np.searchsorted(cuts, batch["doc_id"], side="right") + 1, 0)
            yield batch[["doc_id", "known"]].assign(
                part=part, n=[len(x) for x in ids], ids=[x.tobytes() for x in ids]
            )

    def to_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, before, names, held, size = None, 0, [], [], 0

        def closed() -> pd.DataFrame:
            return pd.DataFrame({"block": [block_bytes(part, before, names, held, kind)]})

        for batch in batches:
            for p, name, known, packed in zip(batch["part"], batch["doc_id"], batch["known"], batch["ids"]):
                if held and (p != part or size >= block_tokens):
                    yield closed()
                    before, names, held, size = before + size, [], [], 0
                if p != part:
                    part, before = p, 0
                names.append(int(name) if known else None)
                held.append(np.frombuffer(packed, dtype=kind))
                size += len(held[-1])
        if held:
            yield closed()

    sorted_ids = (
        lean.mapInPandas(encode, "part int, doc_id long, known boolean, n long, ids binary")
        # Ranges go to tasks in their order, so that files in the order of their names are the whole array.
        .repartitionById(tasks, F.expr(f"int((part * {tasks}L) div {len(cuts) + 2})"))
        .sortWithinPartitions("part", "doc_id", "n", "ids")
    )
    rows = sorted_ids.mapInPandas(to_blocks, "block binary").select(F.col("block").cast("string"))
    rows.write.option("maxRecordsPerFile", BLOCKS_A_FILE).option("lineSep", "\n").text(path)


def read_ids(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) and, with ``ids``, the packed 32-bit ids, all read from the files.

    Headers give the tokens of each part; the sums of the parts before it make
    the ``start`` of every document in the whole array.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                yield pd.DataFrame([(b.part, b.tokens) for b in blocks(raw)], columns=["part", "tokens"])

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                for block in blocks(raw):
                    out = [
                        (block.part, name, start, len(x), zlib.crc32(x), x.tobytes() if ids else None)
                        for name, start, x in block.documents()
                    ]
                    frame = pd.DataFrame(out, columns=["part", "doc_id", "within", "n_tokens", "ids_crc32", "ids"])
                    yield frame.astype({"doc_id": "Int64"})

    totals = files.mapInPandas(heads, "part int, tokens long").groupBy("part").agg(F.sum("tokens").alias("tokens"))
    found = files.mapInPandas(
        documents, "part int, doc_id long, within long, n_tokens long, ids_crc32 long, ids binary"
    )
    out = found.join(part_bases(totals, "tokens"), "part").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
    return out if ids else out.drop("ids")


def id_store(docs: DataFrame, tokenizer: str, ids: bool = True, **options) -> DataFrame:
    """Write all documents to a new folder and read them back; ``options`` go to ``write_ids``."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, **options)
    return read_ids(docs.sparkSession, path, ids)


def reader(path: str) -> Callable[[int], np.ndarray]:
    """Random access to one local file: position in the file → ids, for training loops."""
    with open(path, "rb") as file:
        found = list(blocks(file.read()))
    firsts = np.cumsum([0, *(b.n for b in found)])

    def ids_at(i: int) -> np.ndarray:
        k = int(np.searchsorted(firsts, i, side="right")) - 1
        start, end = found[k].span(i - int(firsts[k]))
        return found[k].ids[start:end]

    return ids_at
