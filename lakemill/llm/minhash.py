"""MinHash near-dedup with tensored banding.

A document's words give a set of shingles. Two small collections of ``half``
sketches, each of ``rows`` minhashes, are computed; every pair of one sketch
from either collection is a table key, so ``half``² tables cost the minhashes
of 2·``half`` of them. Two documents meet in some table if a sketch of each
collection agrees: at a similarity s they miss each other with probability
2·(1 - s^rows)^half, under one in 100,000 at 0.75 for 2 × 16 sketches of two.

Texts with one shingle set are one class from the start, however many copies
there are. Candidates are then worked off in three steps, each on what the one
before left open, and every link is confirmed on full shingle sets:

1. the diagonal tables (i, i): members of a bucket meet its pivot, so a bucket
   costs its size, not its square; links make components;
2. all pairs of sketches whose buckets still hold two components or more: small
   buckets in full, large ones by their smallest set;
3. documents of large buckets with several components left (passages that many
   texts share): the exact join of ``crowds.py``, which tells what they all have
   in common from the rest.

Before a pair travels, exact bounds rule out most that can't be similar enough:
the sizes, and a bitmap in which every shingle flips one bit, as two sets differ
in at least the bits that their bitmaps differ in. Nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lakemill.llm.common import column, field, slices, staying, stored, with_rows
from lakemill.llm.crowds import crowd_links

#: A bucket of so many members is compared in full; larger ones by pivots.
SMALL = 6
#: Members that one task compares with a pivot.
FANOUT = 256
#: Pieces of a class or component that may hold very many rows; joins split larger ones at run time.
SALTS = 8
#: Bits of a set's bitmap.
BITS = 1024


@dataclass(frozen=True)
class Plan:
    """Words in a shingle, similarity in percent, sketches in a collection, minhashes in a sketch."""

    words: int = 5
    percent: int = 75
    half: int = 16
    rows: int = 2


def kept(df: DataFrame) -> DataFrame:
    """A step's result as a written table.

    Not checkpoint(): a checkpointed frame keeps the size estimate of its plan,
    and estimates of joins multiply from round to round until the numbers
    alone fill the driver.
    """
    return stored(df, "near-dedup")


# --- shingle sets ---------------------------------------------------------

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every bit depends on every other."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def byte_values() -> np.ndarray:
    """A 64-bit value for each byte; A-Z have those of a-z."""
    values = mixed((np.arange(256, dtype="uint64") + np.uint64(1)) * _SPREAD)
    values[65:91] = values[97:123]
    return values


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype="uint64")
    out[0] = 1
    return np.multiply.accumulate(out)


VALUES = byte_values()
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
WORD_BASE, SHINGLE_BASE = 0x100000001B3, 0xD6E8FEB86659FD93


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash for each word, A-Z in lower case."""
    raw = np.frombuffer(text.encode(), dtype="uint8")
    inside = ~SPACE[raw]
    edges = np.flatnonzero(np.diff(inside.view("int8"), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype="uint64")
    lengths = ends - starts
    at = np.flatnonzero(inside)
    offset = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = VALUES[raw[at]] * powers(WORD_BASE, int(lengths.max()))[offset]
    return mixed(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype("uint64") * _SPREAD)


def shingles(text: str, words: int) -> np.ndarray:
    """The sorted distinct shingles; with fewer words all of them as one; none without words."""
    h = word_hashes(text)
    if not len(h):
        return h
    size = min(words, len(h))
    n = len(h) - size + 1
    base = powers(SHINGLE_BASE, size)
    total = np.full(n, np.uint64(size), dtype="uint64")
    for j in range(size):
        total += h[j : j + n] * base[j]
    return np.unique(mixed(total))


def sketches(hashes: np.ndarray, plan: Plan) -> np.ndarray:
    """2·``half`` sketches of a set, each made of ``rows`` minhashes."""
    count = 2 * plan.half * plan.rows
    factors = mixed(np.arange(1, count + 1, dtype="uint64") * _SPREAD) | np.uint64(1)
    least = np.full(count, np.iinfo("uint64").max, dtype="uint64")
    for at in range(0, len(hashes), 4096):  # bounds the memory of long texts
        part = hashes[at : at + 4096, None]
        least = np.minimum(least, (part * factors ^ (part * factors >> np.uint64(29))).min(axis=0))
    rows = least.reshape(2 * plan.half, plan.rows)
    out = np.arange(1, 2 * plan.half + 1, dtype="uint64") * _SPREAD
    for j in range(plan.rows):
        out = mixed(out + rows[:, j] * np.uint64(SHINGLE_BASE))
    return out


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """``BITS`` bits, each the parity of how many of the shingles fall on it."""
    falls = np.bincount((hashes >> np.uint64(40)).astype("int64") % BITS, minlength=BITS)
    return np.packbits((falls & 1).astype("uint8"), bitorder="little").view("int64")


def sketched(docs: DataFrame, plan: Plan) -> DataFrame:
    """(row, n, digest, sketch, bits) of every (row, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            out = []
            for row, text in zip(batch["row"], batch["text"]):
                own = shingles(text, plan.words)
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                out.append((row, len(own), digest, sketches(own, plan).view("int64") if len(own) else [], bitmap(own)))
            yield pd.DataFrame(out, columns=["row", "n", "digest", "sketch", "bits"])

    return docs.mapInPandas(run, "row long, n long, digest binary, sketch array<long>, bits array<long>")


def shingle_sets(docs: DataFrame, plan: Plan) -> DataFrame:
    """(row, set) with the packed sorted shingles of every (row, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            sets = [shingles(t, plan.words).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"row": batch["row"].to_numpy(), "set": sets})

    return docs.mapInPandas(run, "row long, set binary")


# --- components -----------------------------------------------------------


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(row, comp): each node with the least row it is linked to, by contraction.

    Each round every node moves to its least neighbour, and on to where that one
    moves; links between the places they reach are the next round's. The least
    node of a component never moves, so when no link is left every node is
    there. A node with very many links is pre-aggregated and never one list.
    """
    edges = kept(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct())
    reached = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        onward = least.select(F.col("u").alias("m"), F.col("m").alias("further"))
        moves = kept(least.join(onward, "m").select("u", F.col("further").alias("m")))
        ends = lambda c: moves.select(F.col("u").alias(c), F.col("m").alias(f"m_{c}"))
        edges = edges.join(ends("u"), "u").join(ends("v"), "v").where("m_u <> m_v")
        edges = kept(edges.select(F.least("m_u", "m_v").alias("u"), F.greatest("m_u", "m_v").alias("v")).distinct())
        if reached is None:
            reached = moves
        else:
            later = moves.select(F.col("u").alias("m"), F.col("m").alias("further"))
            reached = kept(reached.join(later, "m", "left").select("u", F.coalesce("further", "m").alias("m")))
    if reached is None:
        return nodes.select("row", F.col("row").alias("comp"))
    joined = nodes.select("row").join(reached, F.col("row") == F.col("u"), "left")
    return kept(joined.select("row", F.coalesce("m", "row").alias("comp")))


# --- candidates -----------------------------------------------------------


def fitting(a: str, b: str, plan: Plan) -> Column:
    """Sets whose sizes differ too much can't be similar enough."""
    return F.expr(f"100 * least({a}, {b}) >= {plan.percent} * greatest({a}, {b})")


def near_bits(a: str, b: str, an: str, bn: str, plan: Plan) -> Column:
    """Sets differ in at least the bits that their bitmaps differ in; similar ones in few."""
    apart = f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    return F.expr(f"{100 + plan.percent} * {apart} <= {100 - plan.percent} * ({an} + {bn})")


def plausible(pairs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """The (a, b) that their bitmaps do not rule out."""
    side = lambda c: nodes.select(F.col("row").alias(c), F.col("n").alias(f"{c}n"), F.col("bits").alias(f"{c}bits"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.where(near_bits("abits", "bbits", "an", "bn", plan)).select("a", "b")


def open_buckets(buckets: DataFrame) -> DataFrame:
    """(key, size, pivot) of the buckets with several components; the pivot has the least hashed row."""
    pivot = F.min(F.struct(F.xxhash64("row").alias("rank"), "row", "n", "comp")).alias("pivot")
    found = buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), pivot
    )
    return found.where("lo <> hi").select("key", "size", "pivot")


def pivot_pairs(members: DataFrame, plan: Plan) -> DataFrame:
    """(a, b): the pivot of each bucket with every member of another component."""
    return (
        members.where((F.col("pivot.comp") != F.col("comp")) & fitting("pivot.n", "n", plan))
        .select(F.col("pivot.row").alias("a"), F.col("row").alias("b"))
        .distinct()
    )


def smallest_members(members: DataFrame) -> DataFrame:
    """(key, pivot) of large buckets: the smallest set, which needs the least overlap with any other."""
    return members.groupBy("key").agg(F.min(F.struct("n", "row", "comp")).alias("pivot"))


def full_pairs(members: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """(a, b): the pairs of different components within a small bucket that no bound rules out."""
    wide = members.join(nodes.select("row", "bits"), "row")
    side = lambda c: wide.select("key", F.col("row").alias(c), *[F.col(x).alias(f"{c}{x}") for x in ("n", "comp", "bits")])
    bound = (F.col("a") < F.col("b")) & (F.col("acomp") != F.col("bcomp")) & fitting("an", "bn", plan)
    bound = bound & near_bits("abits", "bbits", "an", "bn", plan)
    left, right = side("a"), side("b")
    joined = left.join(right.withColumnRenamed("key", "bkey"), (F.col("key") == F.col("bkey")) & bound)
    return joined.select("a", "b").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """The (a, b) whose full sets are similar enough.

    Members travel to their pivot in blocks of about ``FANOUT``: each block
    reads the pivot's set once and holds two sets at a time.
    """
    pairs = kept(pairs)
    sized = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    blocks = kept(sized.select("a", F.ceil(F.col("size") / FANOUT).cast("int").alias("blocks")))
    dealt = pairs.join(blocks, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "b"
    )
    heads = blocks.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    wanted = heads.select("a", "block", F.col("a").alias("row"), F.lit(0).alias("member")).unionByName(
        dealt.select("a", "block", F.col("b").alias("row"), F.lit(1).alias("member"))
    )
    placed = wanted.join(sets, "row").repartition("a", "block").sortWithinPartitions("a", "block", "member")
    percent = plan.percent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(0, dtype="uint64")
        for batch in batches:
            out = []
            for a, row, member, packed in zip(batch["a"], batch["row"], batch["member"], batch["set"]):
                other = np.frombuffer(packed, dtype="uint64")
                if not member:
                    own = other
                    continue
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                both = int((own[at] == other).sum())
                if 100 * both >= percent * (len(own) + len(other) - both):
                    out.append((a, row))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return kept(placed.select("a", "row", "member", "set").mapInPandas(run, "a long, b long"))


def labelled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    return buckets.join(labels, "row")


def classes_of(sketch: DataFrame) -> DataFrame:
    """(digest, n, class): texts with one shingle set, named by their least row."""
    return sketch.where("n > 0").groupBy("digest", "n").agg(F.min("row").alias("class"))


def resolve(sketch: DataFrame, classes: DataFrame, docs: DataFrame, plan: Plan) -> DataFrame:
    """(row, comp) of the classes."""
    half = plan.half
    nodes = kept(
        sketch.join(classes.select(F.col("class").alias("row")), "row", "left_semi").select("row", "n", "sketch", "bits")
    )
    # Sketches that another class has too; the others cannot meet anyone.
    entries = nodes.select("row", "n", F.posexplode("sketch").alias("slot", "value")).select(
        "row", "n", "slot", "value", F.xxhash64("slot", "value").alias("key")
    )
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    entries = kept(entries.join(shared, "key"))
    sides = entries.groupBy("row").agg(
        F.max((F.col("slot") < half).cast("int")).alias("left"), F.max((F.col("slot") >= half).cast("int")).alias("right")
    )
    meeting = kept(sides.where("left + right = 2").select("row"))
    sets = stored(shingle_sets(docs.join(meeting, "row", "left_semi"), plan), "shingle-sets")

    # 1. Diagonal tables.
    left, right = entries.where(F.col("slot") < half), entries.where(F.col("slot") >= half)
    other = right.select("row", (F.col("slot") - half).alias("slot"), F.col("value").alias("other"))
    diagonal = kept(
        left.join(other, ["row", "slot"]).select(
            F.xxhash64(F.lit(1), "slot", "value", "other").alias("key"), "row", "n", F.col("row").alias("comp")
        )
    )
    start = kept(diagonal.join(open_buckets(diagonal), "key"))
    met = plausible(pivot_pairs(start, plan), nodes, plan)
    pairs = met.unionByName(full_pairs(start.where(F.col("size") <= SMALL), nodes, plan)).distinct()
    links = confirmed(pairs, sets, plan)
    labels = components(nodes, links)

    # 2. All combinations of sketches whose buckets are still open.
    live = labelled(entries.join(meeting, "row", "left_semi"), labels)
    still = live.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    live = kept(live.join(still, "key").select("row", "n", "comp", "slot", "value"))
    b = live.where(F.col("slot") >= half).select("row", F.col("slot").alias("slot2"), F.col("value").alias("value2"))
    tables = (
        live.where(F.col("slot") < half)
        .join(b, "row")
        .select(F.xxhash64(F.lit(2), "slot", "value", "slot2", "value2").alias("key"), "row", "n", "comp")
    )
    tables = stored(tables, "tables")
    members = kept(tables.join(open_buckets(tables), "key").select("key", "row", "n", "comp", "size"))
    small = full_pairs(members.where(F.col("size") <= SMALL), nodes, plan)

    large = members.where(F.col("size") > SMALL)
    met = plausible(pivot_pairs(large.join(smallest_members(large), "key"), plan), nodes, plan)
    found = confirmed(small.unionByName(met).distinct(), sets, plan)
    if not found.isEmpty():
        links = kept(links.unionByName(found))
        labels = components(nodes, links)

    # 3. Members of large buckets that are still open, exactly.
    now = labelled(large.drop("comp"), labels)
    crowd = kept(now.join(open_buckets(now).select("key"), "key", "left_semi").select("row").distinct())
    if crowd.isEmpty():
        return labels
    found = crowd_links(
        sets.join(crowd, "row", "left_semi"), labels.join(crowd, "row", "left_semi"), plan.percent, kept,
        lambda pairs: confirmed(plausible(pairs, nodes, plan), sets, plan),
        lambda more: components(nodes, links.unionByName(more)).join(crowd, "row", "left_semi"),
    )
    return components(nodes, links.unionByName(found))


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, plan: Plan = Plan()
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row (and ``row_col``).

    component_id is the smallest doc_id that links reach, its own included. A
    text without words, or null, has no shingles and is linked with nothing: its
    component is its own doc_id. Exactly one row of a component is kept: that
    with the smallest doc_id, nulls last, and of repeated rows the first. A
    component without any doc_id has a null one. An empty table gives an empty
    result. ``row_col``: a unique long that is stable between passes.
    """
    if row_col:
        lean = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"), column(row_col).alias("row"))
    else:
        slim = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
        lean = with_rows(slim, "doc_id").select("doc.doc_id", "doc.text", "row")
    texts = lean.select("row", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = lean.select("row", "doc_id")
    sketch = stored(sketched(texts, plan), "sketches")
    classes = kept(classes_of(sketch))
    labels = resolve(sketch, classes, texts, plan)
    # Rows of one class may be very many: they meet their class by (digest, salt). Rows without words stand alone.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
    named = classes.join(labels.withColumnRenamed("row", "class"), "class").select("digest", "n", "comp", salts.alias("salt"))
    placed = sketch.select("row", "n", "digest", salt.alias("salt")).join(named, ["digest", "n", "salt"], "left")
    placed = kept(
        placed.select("row", "n", F.coalesce("comp", "row").alias("comp"), (F.col("n") == 0).alias("alone")).join(ids, "row")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))).alias("first")
    heads = placed.groupBy("comp", "alone").agg(first).select("*", salts.alias("salt"))
    out = placed.withColumn("salt", salt).join(heads, ["comp", "alone", "salt"])
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"),
        (F.col("first.row") == F.col("row")).alias("kept"), *([F.col("row").alias(row_col)] if row_col else []),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``docs`` with one document of each component; columns stay as they are."""
    rows = with_rows(docs, id_col)
    view = rows.select(field(id_col).alias("doc_id"), field(text_col).alias("text"), "row")
    return staying(rows, near_dedup(view, "doc_id", "text", "row", plan).where("kept").select("row"))
