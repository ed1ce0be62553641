"""Compression of integer vectors to part codes, with Orchard's search for the nearest entry.

Vectors are cut into equal parts; each part position has a codebook of entries,
refined by rounds of assignment and averaging on whole numbers. A codebook is
small and known to all tasks; vectors never leave the task that reads them, and
what a round shuffles is one partial sum per task and entry.

Orchard's search keeps, for every entry, all others sorted by their distance
from it. A part starts at some entry and walks that entry's list. When it meets
an entry nearer to itself it jumps to that entry's list. Entries met before are
marked and not measured again. The walk ends where the list goes beyond twice
the distance to the current entry: by the triangle inequality nothing there is
as near. Equally near entries lie within that bound, so ties go to the lower
index by jumping on (distance, index).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lakemill.llm.common import column

#: Components up to this size are squared and summed in 64 bits without overflow, for vectors of up to 4096 of them.
FAST = 1 << 24
#: Bits of a limb in which sums of components leave a task.
LIMB = 32
#: Rows searched at a time; bounds a task's memory.
ROWS = 2048


@dataclass(frozen=True)
class Plan:
    """Parts of a vector, entries of a codebook, rounds of refinement, and the scale before rounding down."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


# --- Orchard's search -----------------------------------------------------


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, exact."""
    gap = a - b
    return (gap * gap).sum(axis=-1)


class Codebooks:
    """All entries (parts × entries × width) and, for each entry, the others by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        parts, size, _ = entries.shape
        self.apart = np.stack([squared(book[:, None, :], book[None, :, :]) for book in entries])
        order = np.argsort(self.apart, axis=2, kind="stable")
        # An entry's own place is moved to the front of its list, then dropped.
        own = order == np.arange(size)[None, :, None]
        self.lists = np.take_along_axis(order, np.argsort(~own, axis=2, kind="stable"), axis=2)[:, :, 1:]
        self.gaps = np.take_along_axis(self.apart, self.lists, axis=2)
        # Walks start at the entry with the least sum of distances, the middle of its book.
        self.start = self.apart.sum(axis=2).argmin(axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance), each rows × parts, of vectors (rows × parts × width).

        All walks of a batch take their steps together; those that have ended leave.
        """
        rows, parts, width = vectors.shape
        size = self.entries.shape[1]
        part = np.tile(np.arange(parts), rows)
        flat = vectors.reshape(rows * parts, width)
        at = self.start[part]
        best = squared(flat, self.entries[part, at])
        place = np.zeros(rows * parts, dtype="int64")
        met = np.zeros((rows * parts, size), dtype=bool)
        met[np.arange(rows * parts), at] = True
        walking = np.arange(rows * parts)
        while len(walking):
            walking = walking[place[walking] < size - 1]
            p, here, step = part[walking], at[walking], place[walking]
            on = self.gaps[p, here, step] <= 4 * best[walking]  # squares: twice the distance
            walking, p, here, step = walking[on], p[on], here[on], step[on]
            entry = self.lists[p, here, step]
            place[walking] += 1
            new = ~met[walking, entry]
            seen, entry, p = walking[new], entry[new], p[new]
            met[seen, entry] = True
            gap = squared(flat[seen], self.entries[p, entry])
            nearer = (gap < best[seen]) | ((gap == best[seen]) & (entry < at[seen]))
            jump = seen[nearer]
            at[jump], best[jump], place[jump] = entry[nearer], gap[nearer], 0
        return at.reshape(rows, parts), best.reshape(rows, parts)


# --- vectors --------------------------------------------------------------


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale · x) as 64-bit integers, or as Python integers where components are very large."""
    with np.errstate(over="ignore"):
        floored = np.floor(vectors.astype("float64") * scale)
    if not len(floored) or np.abs(floored).max(initial=0) <= FAST:
        return floored.astype("int64")
    exact = [int(x) * scale if abs(x) > 2**52 else int(np.floor(x * scale)) for x in vectors.astype("float64").ravel().tolist()]
    return np.array(exact, dtype=object).reshape(vectors.shape)


def sound(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    v = column(vector)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return v.isNotNull() & ~F.coalesce(F.exists(v, bad), F.lit(False))


def batches_of(batches: Iterator[pd.DataFrame], plan: Plan) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows with their vectors as whole numbers, rows × parts × width."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            piece = batch.iloc[at : at + ROWS]
            numbers = whole_numbers(np.stack(piece["vector"].to_numpy()), plan.scale)
            yield piece, numbers.reshape(len(piece), plan.parts, -1)


def first_entries(kept: DataFrame, plan: Plan) -> np.ndarray:
    """The parts of the vectors with the smallest ids, at most ``entries`` of them; the driver holds these alone."""
    least = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(plan.entries).collect()
    numbers = whole_numbers(np.array([r["vector"] for r in least], dtype="float64"), plan.scale)
    return numbers.reshape(len(least), plan.parts, -1).transpose(1, 0, 2)


def limbs(value: int) -> list[int]:
    """A whole number as signed limbs, lowest first; zero has none."""
    sign, value, out = (-1 if value < 0 else 1), abs(int(value)), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def refined(kept: DataFrame, entries: np.ndarray, plan: Plan) -> np.ndarray:
    """One round: assign every part, then average the parts of each entry, rounding down."""
    parts, size, width = entries.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books = Codebooks(entries)
        sums = np.zeros((parts * size, width), dtype=object)
        counts = np.zeros(parts * size, dtype="int64")
        for _, vectors in batches_of(batches, plan):
            codes, _ = books.nearest(vectors)
            slots = (codes + np.arange(parts) * size).ravel()
            part_sums = np.zeros((parts * size, width), dtype=vectors.dtype)
            np.add.at(part_sums, slots, vectors.reshape(len(slots), width))
            sums += part_sums.astype(object)
            counts += np.bincount(slots, minlength=parts * size)
        out = [(slot, -1, 0, int(counts[slot])) for slot in np.flatnonzero(counts).tolist()]
        for slot in np.flatnonzero(counts).tolist():
            for at, value in enumerate(sums[slot]):
                out += [(slot, at, k, x) for k, x in enumerate(limbs(value))]
        yield pd.DataFrame(out, columns=["slot", "place", "limb", "value"]).astype("int64")

    sent = kept.select("vector").mapInPandas(run, "slot long, place long, limb long, value long")
    sums: dict[tuple[int, int], int] = {}
    # One row per entry, place and limb: the size of the codebooks, whatever the table holds.
    for slot, place, limb, value in sent.groupBy("slot", "place", "limb").agg(F.sum("value")).collect():
        sums[slot, place] = sums.get((slot, place), 0) + (value << (LIMB * limb))
    out = entries.reshape(parts * size, width).astype(object)
    for (slot, place), count in sums.items():
        if place < 0:
            out[slot] = [sums.get((slot, at), 0) // count for at in range(width)]
    fits = max((abs(x) for x in out.ravel()), default=0) <= FAST
    return out.reshape(parts, size, width).astype("int64" if fits else object)


def codebooks_digest(entries: np.ndarray) -> str:
    """SHA-256 of all components, decimal, by part, entry and position, with commas between them."""
    return hashlib.sha256(",".join(str(int(x)) for x in entries.ravel()).encode()).hexdigest()


def coded(kept: DataFrame, entries: np.ndarray, plan: Plan, label_type: str) -> DataFrame:
    """(vec_id, label, code, error) by the final codebooks."""
    fields = {f.name: f.dataType.simpleString() for f in kept.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books = Codebooks(entries)
        for piece, vectors in batches_of(batches, plan):
            codes, gaps = books.nearest(vectors)
            wide = 2 if entries.shape[1] <= 256 else 4
            totals = [int(x) for x in gaps.sum(axis=1)]
            yield pd.DataFrame({
                "name": piece["name"].to_numpy(), "label": piece["label"].to_numpy(),
                "code": ["".join(f"{int(c):0{wide}x}" for c in row) for row in codes],
                "error": pd.array([x if x < 2**63 else None for x in totals], dtype="Int64"),
            })

    # Ids and labels travel as strings: pandas would turn whole numbers beside nulls into floats.
    lean = kept.select(F.col("vec_id").cast("string").alias("name"), F.col("label").cast("string").alias("label"), "vector")
    out = lean.mapInPandas(run, "name string, label string, code string, error long")
    return out.select(
        F.col("name").cast(fields["vec_id"]).alias("vec_id"), F.col("label").cast(label_type).alias("label"), "code", "error"
    )


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    plan: Plan = Plan(),
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256, label of every sound vector.

    Rows whose vector is null or holds nulls, NaN or infinities are left out.
    ``code`` has two hex digits a part (four where a codebook has more than 256
    entries), ``error`` is the squared distance to what the code stands for and
    ``label_error`` its sum over the rows of one label, nulls together; both are
    null where 64 bits can't hold them. Fewer vectors than entries make smaller
    codebooks. Repeated ids are rows of their own; null ids come last among the
    first entries. The length of the vectors is that of the smallest id; a
    vector of another length, or an empty one, has no code and no error, and a
    length that the parts don't divide is an error. An empty table gives an
    empty result. Other columns, whatever their names, are left out.
    """
    there = vectors.where(sound(vector_col)).select(
        column(id_col).alias("vec_id"), column(label_col).alias("label"), column(vector_col).cast("array<double>").alias("vector")
    )
    kinds = {f.name: f.dataType.simpleString() for f in there.schema}
    head = there.where(F.size("vector") > 0).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).collect()
    length = len(head[0]["vector"]) if head else 0
    if length % plan.parts:
        raise ValueError(f"vectors of {length} components can't be cut into {plan.parts} equal parts")
    kept = there.where((F.size("vector") == length) & (F.size("vector") > 0))
    other = there.where((F.size("vector") != length) | (F.size("vector") == 0)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    if not head:
        entries = np.zeros((plan.parts, 0, 0), dtype="int64")
        rows = other
    else:
        entries = first_entries(kept, plan)
        for _ in range(plan.rounds):
            entries = refined(kept, entries, plan)
        rows = coded(kept, entries, plan, kinds["label"]).unionByName(other)
    per_label = rows.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    joined = rows.join(per_label, F.col("label").eqNullSafe(F.col("__label")), "left")
    digest = F.lit(codebooks_digest(entries)).alias("codebooks_sha256")
    return joined.select("vec_id", "code", "error", "label_error", digest, "label")
