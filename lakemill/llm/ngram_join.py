"""Similarity join of shingle sets by partitions of the universe (pigeonhole).

A similarity bound is a bound on how many shingles two sets differ in: with
sizes a and b at most D(a, b) = (100 - percent)(a + b) / (100 + percent). Sizes
fall into bands so wide that a set's partners of no larger size lie in its own
band and the one below. Each band hashes all shingles to one of its segments. A
set looks into a band (it "probes", its partners there are "indexed") with an
allowance for each segment: -1, skip it; 0, the two subsets there are equal; 1,
they differ in one shingle at most, which the subset and its one-deletion
neighbours tell. Allowances plus one that add up to D + 1 miss no pair: with all
segments beyond their allowance, the sets would differ in D + 1 shingles.

Where the allowances lie is a matter of cost. A band has a few segments more
than D + 1, so most sets look up every segment at 0 but skip a few, and similar
sets share several segments, which two sets that share one by chance do not. A segment
subset that very many sets share (empty, or all of it from a common passage) is
dear: it is skipped, and the units come from the cheapest alternatives, a 1
elsewhere, priced by the matches that the deletions have, or the dear one after
all. Sets that no allocation keeps apart go through the exact join of
``crowds.py``. All links are confirmed on full sets. Nothing is capped.

Sets that are equal are one class from the start, and pairs already connected
are left out later: components come out whole, not lists of all pairs.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lakemill.llm.common import column, slices, stored, with_rows
from lakemill.llm.crowds import crowd_links
from lakemill.llm.minhash import bitmap, components, confirmed, fitting, mixed, near_bits, plausible, shingle_sets, shingles

#: A key of so many sets is looked up in full; a dearer one is up to the allocation.
SMALL = 6
#: Matches that an allocation may cost one set; beyond, it goes to the crowd.
DEAR = 32
#: Pieces of a class that may hold very many rows.
SALTS = 8
#: Bits of the filter that spares keys of one or two sets a second shuffle, and of a block of Spark's bitmaps.
FILTER_BITS, BLOCK_BITS = 26, 32768

_SPREAD, _SEGMENT, _VALUE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Plan:
    """Words in a shingle and similarity in percent."""

    words: int = 5
    percent: int = 80


def kept(df: DataFrame) -> DataFrame:
    """A step's result as a written table; its size is known to later joins."""
    return stored(df, "ngram-join")


# --- bands, segments, keys ------------------------------------------------


def distance(a: int, b: int, percent: int) -> int:
    """Shingles in which similar sets of these sizes differ at most."""
    return (100 - percent) * (a + b) // (100 + percent)


@lru_cache(maxsize=None)
def band_starts(percent: int) -> tuple[int, ...]:
    """Smallest size of each band; partners of a size lie in its band and the next lower one.

    Bands of 7/4 make the fewest keys: narrower ones are all looked into from
    the band above, wider ones have more segments than their small sets need.
    """
    starts = [1]
    while starts[-1] < 2**40:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 100 // percent), starts[-1] * 7 // 4))
    return tuple(starts)


def band_of(n: int, percent: int) -> int:
    return bisect_right(band_starts(percent), n) - 1


def largest(band: int, percent: int) -> int:
    return band_starts(percent)[band + 1] - 1


def segments(band: int, percent: int) -> int:
    """Segments of a band: enough for its largest set and that one's largest partner, and an eighth to spare.

    The spare ones let sets skip the dear keys of a passage that makes up a third of them.
    """
    top = largest(band, percent)
    need = distance(top, top * 100 // percent, percent)
    return need + 1 + (2 + need // 8 if need else 0)


def needed(n: int, band: int, percent: int) -> int:
    """Units of allowance with which a set of size n misses no partner of its size or less in a band."""
    return distance(n, min(n, largest(band, percent)), percent) + 1


def segment_sums(own: np.ndarray, band: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segment and value of each shingle, and of each segment the sum of values and a number of its own."""
    count = segments(band, percent)
    salt = mixed(np.array([band + 1], dtype="uint64") * _SPREAD)
    at = (mixed(own ^ salt) % np.uint64(count)).astype("int64")
    values = mixed(own * _VALUE + _SEGMENT)
    sums = np.zeros(count, dtype="uint64")
    np.add.at(sums, at, values)
    return at, values, sums, mixed(np.arange(1, count + 1, dtype="uint64") * _SEGMENT + salt)


def full_keys(own: np.ndarray, band: int, percent: int) -> np.ndarray:
    """A number for the subset of each segment."""
    _, _, sums, name = segment_sums(own, band, percent)
    return mixed(sums + name).view("int64")


def deletion_keys(own: np.ndarray, band: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments and numbers of the subsets with one shingle less."""
    at, values, sums, name = segment_sums(own, band, percent)
    return at, mixed(sums[at] - values + name[at]).view("int64")


def looks_below(n: int, percent: int) -> bool:
    """Whether a set of size n can have a partner in the band below."""
    band = band_of(n, percent)
    return band > 0 and 100 * largest(band - 1, percent) >= percent * n and distance(n, largest(band - 1, percent), percent) > 0


def looks_within(n: int, percent: int) -> bool:
    """Whether sets in the band of size n can have any unequal partner there or above."""
    return segments(band_of(n, percent), percent) > 1


def signed(docs: DataFrame, plan: Plan) -> DataFrame:
    """(row, node, n, digest, bits, wide, own, below) of every (row, text): keys in the own band, of ``wide`` segments, and below.

    Equal sets have one ``node``, a number from the digest.
    """
    percent = plan.percent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 250):
            out = []
            for row, text in zip(batch["row"], batch["text"]):
                own = shingles(text, plan.words)
                n = len(own)
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                band = band_of(n, percent) if n else 0
                within = full_keys(own, band, percent) if n and looks_within(n, percent) else []
                below = full_keys(own, band - 1, percent) if n and looks_below(n, percent) else []
                node = int.from_bytes(digest[:8], "little") >> 2
                out.append((row, node, n, digest, bitmap(own), segments(band, percent), within, below))
            yield pd.DataFrame(out, columns=["row", "node", "n", "digest", "bits", "wide", "own", "below"])

    return docs.mapInPandas(
        run, "row long, node long, n long, digest binary, bits array<long>, wide long, own array<long>, below array<long>"
    )


def lookups(sets: DataFrame, plan: Plan) -> DataFrame:
    """(row, role, seg, kind, key): all keys of every (row, role, set), kind 0 of subsets, 1 with a shingle deleted.

    Role 1: in the set's own band; 0: in the band below.
    """
    percent = plan.percent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 64):
            out = []
            for row, role, packed in zip(batch["row"], batch["role"], batch["set"]):
                own = np.frombuffer(packed, dtype="uint64")
                band = band_of(len(own), percent) - (1 - role)
                full = full_keys(own, band, percent)
                at, less = deletion_keys(own, band, percent)
                out.append(pd.DataFrame({
                    "row": row, "role": role, "seg": np.concatenate([np.arange(len(full)), at]),
                    "kind": np.repeat([0, 1], [len(full), len(less)]), "key": np.concatenate([full, less]),
                }))
            if out:
                yield pd.concat(out)

    return sets.mapInPandas(run, "row long, role int, seg long, kind int, key long")


def budgets(probes: DataFrame, plan: Plan) -> DataFrame:
    """Of every (row, role, n, dear): segments that are not dear, and units still to find when the dear ones are skipped."""
    percent = plan.percent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, role, n, dear in zip(batch["row"], batch["role"], batch["n"], batch["dear"]):
                band = band_of(n, percent) - (1 - role)
                plain = segments(band, percent) - dear
                out.append((row, role, plain, needed(n, band, percent) - plain))
            yield pd.DataFrame(out, columns=["row", "role", "plain", "missing"])

    return probes.mapInPandas(run, "row long, role int, plain long, missing long").where("missing > 0")


# --- the join -------------------------------------------------------------


def entries_of(nodes: DataFrame) -> DataFrame:
    """(key, entry) of every lookup; ``entry`` is twice the node, and one more in the own band."""
    own = nodes.select(F.explode("own").alias("key"), (F.col("node") * 2 + 1).alias("entry"))
    return own.unionByName(nodes.select(F.explode("below").alias("key"), (F.col("node") * 2).alias("entry")))


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of ``2**FILTER_BITS`` bits in which those of the keys are set; its size does not depend on them."""
    place = F.col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    blocks = keys.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(((1 << FILTER_BITS) // BLOCK_BITS + 1, BLOCK_BITS // 8), dtype="uint8")
    for block, bits in blocks.toLocalIterator():
        out[block] = np.frombuffer(bits, dtype="uint8")
    return out


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be among those of a bitmap."""
    # Block numbers start at one, as bitmap_bucket_number has them; so do positions with bit 0 of 0.
    place = keys.astype("int64") & ((1 << FILTER_BITS) - 1)
    at = np.where(place > 0, (place - 1) % BLOCK_BITS, 0)
    block = np.where(place > 0, (place - 1) // BLOCK_BITS + 1, 0)
    return (bits[block, at >> 3] >> (at & 7).astype("uint8") & 1).astype(bool)


def filtered(nodes: DataFrame, bits: np.ndarray) -> DataFrame:
    """(row, n, role, keys): the lookups whose key may be among those of a bitmap."""
    shared = nodes.sparkSession.sparkContext.broadcast(bits)  # of fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for batch in slices(batches):
            for role, name in ((1, "own"), (0, "below")):
                sizes = batch[name].map(len).to_numpy()
                keys = np.concatenate(list(batch[name])) if sizes.sum() else np.zeros(0, dtype="int64")
                keep = marked(bits, keys)
                left = np.add.reduceat(np.append(keep, False).astype("int64"), np.cumsum(sizes) - sizes) * (sizes > 0)
                found = left > 0
                if found.any():
                    yield pd.DataFrame({
                        "row": batch["row"].to_numpy()[found], "n": batch["n"].to_numpy()[found], "role": role,
                        "keys": np.split(keys[keep], np.cumsum(left[found])[:-1]),
                    })

    return nodes.select("row", "n", "own", "below").mapInPandas(run, "row long, n long, role int, keys array<long>")


def sets_of(docs: DataFrame, rows: DataFrame, plan: Plan) -> DataFrame:
    """(row, set) of the (row, text) among ``rows``; a bitmap spares most other texts the shuffle."""
    number = F.xxhash64("row")
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(rows.select(number.alias("key"))))  # of fixed size

    @F.pandas_udf("boolean")
    def wanted(keys: pd.Series) -> pd.Series:
        return pd.Series(marked(bits.value, keys.to_numpy()))

    return shingle_sets(docs.where(wanted(number)).join(rows, "row", "left_semi"), plan)


def counted_pairs(pairs: DataFrame, lean: DataFrame, skipped: DataFrame, plan: Plan) -> DataFrame:
    """(a, b) of (a, b, times) that share as many keys as similar sets must.

    In the band of the smaller set they differ in at most D of its segments. Of
    those they share, the dear keys of the smaller one (row, dear) may be missing
    from the count.
    """
    found = pairs.groupBy("a", "b").agg(F.sum("times").alias("times"))
    side = lambda c: lean.select(F.col("row").alias(c), *[F.col(x).alias(f"{c}{x}") for x in ("n", "wide", "bits")])
    sized = found.join(side("a"), "a").join(side("b"), "b").where(fitting("an", "bn", plan))
    sized = sized.withColumn("row", F.when(F.col("an") <= F.col("bn"), F.col("a")).otherwise(F.col("b")))
    least = F.expr(
        f"if(an <= bn, awide, bwide) - ({100 - plan.percent} * (an + bn)) div {100 + plan.percent} - coalesce(dear, 0L)"
    )
    known = sized.join(skipped, "row", "left").where(F.col("times") >= least)
    return known.where(near_bits("abits", "bbits", "an", "bn", plan)).select("a", "b")


def open_keys(members: DataFrame) -> DataFrame:
    """(key, size, held): keys of several components with an indexed set among them; ``held`` counts those."""
    found = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.sum("role").alias("held"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
    )
    return found.where("lo <> hi AND held > 0").select("key", "size", "held")


def short_of(dear: DataFrame, plan: Plan) -> DataFrame:
    """(row, role, plain, missing) of sets that hold more dear (key, row, n, role) than they may skip."""
    return budgets(dear.groupBy("row", "role", "n").agg(F.count(F.lit(1)).alias("dear")), plan)


def owed_of(dear: DataFrame, short: DataFrame) -> DataFrame:
    """The dear keys of short sets but for the dearest, as many as may be skipped.

    Similar sets share more segments than may be skipped: if all they share are
    dear, one of these is among them.
    """
    least = Window.partitionBy("row", "role").orderBy("size", "key")
    placed = dear.join(short.select("row", "role", "missing"), ["row", "role"]).withColumn("place", F.row_number().over(least))
    return placed.where("place <= missing").drop("place", "missing")


def allocated(dear: DataFrame, short: DataFrame, sets: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """Candidates (a, b) of sets that hold (key, row, n, role, held) dear keys, and the rows of the crowd.

    Skipped keys are made up for by the cheapest units, those of no cost first.
    Only holders of the keys owed can be partners that no plain segment shows.
    """
    asked = owed_of(dear, short).select("key").distinct()
    indexed = kept(dear.where("role = 1").join(asked, "key", "left_semi").select("row", "role").distinct())
    wanted = short.select("row", "role").unionByName(indexed).distinct()
    keys = kept(lookups(sets.join(wanted, "row"), plan))
    there = keys.join(indexed, ["row", "role"], "left_semi").select(F.col("row").alias("b"), "kind", "key")
    # A probe's subset meets deletions, its deletions meet subsets.
    mine = keys.join(short.select("row", "role"), ["row", "role"], "left_semi")
    hot = dear.select("row", "role", "key", F.lit(0).alias("kind"), "held")
    priced = mine.where("kind = 0").join(hot, ["row", "role", "key", "kind"], "left")
    plain = priced.where("held IS NULL").select("row", "role", "seg")
    asks = kept(
        mine.join(plain, ["row", "role", "seg"], "left_semi").select("row", "role", "seg", "key", (1 - F.col("kind")).alias("kind"))
    )
    matches = kept(there.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("held")).join(
        asks.select("key", "kind").distinct(), ["key", "kind"], "left_semi"
    ))
    costs = asks.join(matches, ["key", "kind"]).groupBy("row", "role", "seg").agg(F.sum("held").alias("cost"))
    # Segments without any match are units for nothing.
    dearer = costs.groupBy("row", "role").agg(F.count(F.lit(1)).alias("costly"))
    still = short.join(dearer, ["row", "role"], "left").select(
        "row", "role", (F.col("missing") - F.col("plain") + F.coalesce("costly", F.lit(0))).alias("units")
    )
    again = priced.where("held IS NOT NULL").select("row", "role", "seg", F.col("held").alias("cost"), F.lit(0).alias("one"))
    options = costs.withColumn("one", F.lit(1)).unionByName(again).join(still.where("units > 0"), ["row", "role"])
    cheapest = Window.partitionBy("row", "role").orderBy("cost", "seg")
    chosen = kept(options.withColumn("place", F.row_number().over(cheapest)).where("place <= units"))
    total = chosen.groupBy("row", "role").agg(F.sum("cost").alias("total"))
    chosen = kept(chosen.join(total, ["row", "role"]).select("row", "role", "seg", "one", (F.col("total") > DEAR).alias("crowded")))
    # What the chosen units ask for: deletions of and at a segment, or the dear key itself.
    ones = asks.join(chosen.where("one = 1"), ["row", "role", "seg"]).select("row", "key", "kind", "crowded")
    zeros = mine.where("kind = 0").join(chosen.where("one = 0"), ["row", "role", "seg"]).select("row", "key", "kind", "crowded")
    asked = kept(ones.unionByName(zeros))
    pairs = asked.where("NOT crowded").join(there, ["key", "kind"]).select("row", "b").where("row <> b")
    pairs = pairs.select(F.least("row", "b").alias("a"), F.greatest("row", "b").alias("b")).distinct()
    crowded = asked.where("crowded")
    partners = there.join(crowded.select("key", "kind").distinct(), ["key", "kind"], "left_semi").select(F.col("b").alias("row"))
    return pairs, crowded.select("row").unionByName(partners).distinct()


def resolve(marks: DataFrame, heads: DataFrame, docs: DataFrame, plan: Plan) -> DataFrame:
    """(row, comp) of the classes, by the (row, node, n, bits, wide, own, below) of all rows and the rows that stand for them.

    Keys are counted with all copies, so no list of them travels to its class;
    copies go once the keys of single classes have.
    """
    found = entries_of(marks).groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("entry").alias("a"), F.max("entry").alias("b"))
    shared = kept(found.where("a div 2 <> b div 2 AND (size > 2 OR a % 2 = 1 OR b % 2 = 1)"))
    nodes = kept(marks.select("row", "node", "n", "wide", "bits").join(heads, "row", "left_semi"))
    lean = nodes.drop("node")
    groups = shared.where("size > 2").select("key")
    held = filtered(marks, key_filter(groups)).join(heads, "row", "left_semi")
    held = kept(held.select(F.explode("keys").alias("key"), "row", "n", "role"))
    sizes = held.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("role").alias("held")).where("held > 0")
    members = kept(held.join(sizes.join(groups, "key", "left_semi").select("key", "size"), "key"))
    dear = kept(members.where(F.col("size") > SMALL))
    skipped = dear.where("role = 1").groupBy("row").agg(F.count(F.lit(1)).alias("dear"))
    twos = shared.where("size = 2").groupBy(F.expr("a div 2").alias("a"), F.expr("b div 2").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    named = lambda c: nodes.select(F.col("node").alias(c), F.col("row").alias(f"{c}row"))
    twos = twos.join(named("a"), "a").join(named("b"), "b").select(
        F.least("arow", "brow").alias("a"), F.greatest("arow", "brow").alias("b"), "times"
    )
    few = members.where(F.col("size") <= SMALL)
    left, right = (few.select("key", *[F.col(x).alias(f"{c}{x}") for x in ("row", "role")]) for c in "ab")
    threes = left.join(right, "key").where("arow < brow AND arole + brole > 0").select(
        F.col("arow").alias("a"), F.col("brow").alias("b"), F.lit(1).alias("times")
    )
    pairs = kept(counted_pairs(twos.unionByName(threes), lean, skipped, plan))

    # Dear keys matter to sets that hold more of them than they may skip: first each with the smallest holder.
    short = kept(short_of(dear, plan))
    mine = kept(owed_of(dear, short))
    pivots = dear.where("role = 1").groupBy("key").agg(F.min(F.struct("n", "row")).alias("pivot"))
    met = mine.join(pivots, "key").where((F.col("pivot.row") != F.col("row")) & fitting("pivot.n", "n", plan))
    met = met.select(F.least("pivot.row", "row").alias("a"), F.greatest("pivot.row", "row").alias("b")).distinct()
    pairs = kept(pairs.unionByName(plausible(met, lean, plan)).distinct())
    crowded = mine.select("row").unionByName(dear.where("role = 1").join(mine.select("key").distinct(), "key", "left_semi").select("row"))
    meeting = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).unionByName(crowded)
    sets = stored(sets_of(docs, kept(meeting.distinct()), plan), "shingle-sets")
    links = confirmed(pairs, sets, plan)
    labels = components(lean, links)

    # Then by allocation, where dear keys of several components are left.
    live = dear.join(labels, "row")
    live = kept(live.drop("size").join(open_keys(live), "key"))
    short = kept(short_of(live, plan))
    if short.isEmpty():
        return labels
    more, crowd = allocated(live, short, sets, plan)
    comps = lambda c: labels.select(F.col("row").alias(c), F.col("comp").alias(f"{c}c"))
    more = more.join(comps("a"), "a").join(comps("b"), "b").where("ac <> bc").select("a", "b")
    side = lambda c: lean.select(F.col("row").alias(c), F.col("n").alias(f"{c}n"))
    more = more.join(side("a"), "a").join(side("b"), "b").where(fitting("an", "bn", plan)).select("a", "b")
    found = confirmed(plausible(more, lean, plan).distinct(), sets, plan)
    if not found.isEmpty():
        links = kept(links.unionByName(found))
        labels = components(lean, links)
    crowd = kept(crowd)
    if crowd.isEmpty():
        return labels
    found = crowd_links(
        sets.join(crowd, "row", "left_semi"), labels.join(crowd, "row", "left_semi"), plan.percent, kept,
        lambda pairs: confirmed(plausible(pairs, lean, plan), sets, plan),
        lambda new: components(lean, links.unionByName(new)).join(crowd, "row", "left_semi"),
    )
    return components(lean, links.unionByName(found))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """doc_id, n_shingles, component_id, class_row, comp_row of every row.

    component_id is the smallest doc_id that links reach, its own included. A
    text without words, or null, has no shingles and is linked with nothing: its
    component is its own doc_id. Rows of one id are nodes of their own; a
    component without any doc_id has a null one. An empty table gives an empty
    result. ``class_row`` and ``comp_row`` name the class of equal sets and the
    component by a row number. Other columns, whatever their names, are left out.
    """
    slim = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    rows = with_rows(slim, "doc_id").select("doc.doc_id", "doc.text", "row")
    texts = rows.select("row", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = stored(signed(texts, plan), "signatures")
    classes = kept(marks.where("n > 0").groupBy("digest", "n").agg(F.min("row").alias("class")))
    heads = classes.select(F.col("class").alias("row"))
    labels = resolve(marks, heads, texts, plan)
    # A class may hold very many rows: they meet it by (digest, salt).
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
    named = classes.join(labels.withColumnRenamed("row", "class"), "class").select("digest", "n", "class", "comp", salts.alias("salt"))
    placed = marks.select("row", "n", "digest", salt.alias("salt")).join(named, ["digest", "n", "salt"], "left")
    placed = kept(
        placed.select(
            "row", "n", F.coalesce("class", "row").alias("class"), F.coalesce("comp", "row").alias("comp"), (F.col("n") == 0).alias("alone")
        ).join(rows.select("row", "doc_id"), "row")
    )
    least = placed.groupBy("comp", "alone").agg(F.min("doc_id").alias("component_id")).select("*", salts.alias("salt"))
    out = placed.withColumn("salt", salt).join(least, ["comp", "alone", "salt"])
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("class").alias("class_row"), F.col("comp").alias("comp_row")
    )
