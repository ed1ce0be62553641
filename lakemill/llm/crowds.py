"""Links between sets of a crowd: many sets that share common parts and still belong to several components.

Filters on shared parts fail where thousands of sets hold one passage: all of
them meet, though few pairs are similar. Here a set is told apart into its
common shingles (held by more than ``COMMON`` of the crowd) and its rest, and
two similar sets are found by whichever of the two makes them similar.

- They share a shingle of the rest. Those are held by few, so pairs that meet in
  one are few; of each rest only a prefix, rarest first, need be looked at.
- They share none, so the common parts alone reach the overlap. Of sets with one
  and the same common part the smallest links with all that this holds for (a
  smaller set needs no more overlap than a larger one), so after these links one
  set for each component and common part is enough: the smallest again. What is
  left is a join of distinct common parts, with a prefix filter of its own.

Copies with edits of their own form crowds in which most pairs are similar. So
the smallest holder of each prefix key meets the others first, which costs no
more than the keys have holders, and pairs are formed only between components
that this leaves; each of them at about one of the keys it shares.

Links make components the same as all pairs would; nothing is capped. All
candidates are confirmed on full sets by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lakemill.llm.common import slices

#: A shingle of more sets of a crowd than this is common.
COMMON = 8
#: Keys before its own that a row of a prefix carries, so that a pair is formed at the first key it shares.
CARRIED = 16


def overlap(an: str, bn: str, percent: int) -> str:
    """SQL: shingles that two sets of these sizes must share at least."""
    return f"(({percent} * ({an} + {bn}) + {99 + percent}) div {100 + percent})"


def least_overlap(n: str, percent: int) -> str:
    """SQL: shingles that a set of this size shares at least with any similar one."""
    return f"(({percent} * {n} + 99) div 100)"


def spelled(sets: DataFrame) -> DataFrame:
    """(row, n, key): the shingles of every (row, set), one row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 64):
            own = [np.frombuffer(s, dtype="int64") for s in batch["set"]]
            sizes = [len(x) for x in own]
            yield pd.DataFrame({
                "row": np.repeat(batch["row"].to_numpy(), sizes), "n": np.repeat(sizes, sizes),
                "key": np.concatenate(own) if own else np.zeros(0, "int64"),
            })

    return sets.mapInPandas(run, "row long, n long, key long")


def bounded(percent: int, common: bool) -> str:
    """SQL: whether sets a and b that share a key as their first one can be similar.

    With ``common`` the part that the key is of must reach the overlap alone.
    """
    need = overlap("an", "bn", percent)
    rest = "" if common else " + least(an - asize, bn - bsize)"
    return (
        f"acomp <> bcomp AND 100 * least(an, bn) >= {percent} * greatest(an, bn)"
        f" AND least(asize - apos, bsize - bpos) + 1{rest} >= {need}"
    )


def side(placed: DataFrame, c: str, *more: str) -> DataFrame:
    return placed.select("key", *[F.col(x).alias(f"{c}{x}") for x in ("row", "n", "pos", "size", "comp", *more)])


def hubs(prefixes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): the smallest holder of each key of (key, row, n, pos, size) with the others of other components, ``common``."""
    placed = prefixes.join(labels, "row")
    least = F.min(F.struct("n", "row", "pos", "size", "comp")).alias("least")
    heads = placed.groupBy("key").agg(least, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    heads = heads.select("key", *[F.col(f"least.{x}").alias(f"a{x}") for x in ("row", "n", "pos", "size", "comp")])
    met = heads.join(side(placed, "b"), "key").where(bounded(percent, True))
    return met.select(F.col("arow").alias("a"), F.col("brow").alias("b")).distinct()


def meeting(prefixes: DataFrame, labels: DataFrame, percent: int, common: bool) -> DataFrame:
    """(a, b): rows of different components that share a key of (key, row, n, pos, size, before) and no bound rules out.

    ``size`` counts the keys of the part that a row's prefix is of, ``pos`` its
    place there. The first key that two rows share has none of the other's
    before it; at most later ones that is seen, and the pair is not formed again.
    """
    placed = prefixes.join(labels, "row")
    open_keys = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    placed = placed.join(open_keys, "key", "left_semi")
    left, right = side(placed, "a", "before"), side(placed, "b", "before").withColumnRenamed("key", "bkey")
    first = f"key = bkey AND arow < brow AND {bounded(percent, common)} AND NOT arrays_overlap(abefore, bbefore)"
    return left.join(right, F.expr(first)).select(F.col("arow").alias("a"), F.col("brow").alias("b")).distinct()


def prefixes_of(keys: DataFrame, need: str) -> DataFrame:
    """(key, row, n, pos, size, before): the first keys of each row, rarest first, that an overlap of ``need`` can't do without.

    ``before`` lists the last ``CARRIED`` of the keys before.
    """
    own = Window.partitionBy("row")
    placed = keys.withColumn("pos", F.row_number().over(own.orderBy("df", "key"))).withColumn(
        "size", F.col("alone") + F.count(F.lit(1)).over(own)
    )
    # Keys of one row alone come first and can't be shared.
    first = placed.withColumn("pos", F.col("pos") + F.col("alone")).where(f"pos <= size - ({need}) + 1")
    before = F.collect_list("key").over(own.orderBy("pos").rowsBetween(-CARRIED, -1)).alias("before")
    return first.select("key", "row", "n", "pos", "size", before)


def crowd_links(
    sets: DataFrame,
    labels: DataFrame,
    percent: int,
    keep: Callable[[DataFrame], DataFrame],
    confirm: Callable[[DataFrame], DataFrame],
    relabel: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """(a, b): links between the (row, set) of a crowd whose (row, comp) ``labels`` differ.

    With the links of ``labels`` they connect whatever similar sets of the crowd
    connect. ``keep`` stores a small result, ``confirm`` gives the (a, b) that
    are similar, ``relabel`` the (row, comp) with more links.
    """
    keys = keep(spelled(sets))
    held = keys.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = keys.join(held, "key")
    # Of every row: its shared shingles, and how many it has for itself.
    sums = shared.groupBy("row").agg(
        F.count(F.lit(1)).alias("shared"), F.sum((F.col("df") > COMMON).cast("long")).alias("h")
    )
    shared = keep(shared.join(sums, "row").withColumn("alone", F.col("n") - F.col("shared")))
    common = shared.where(F.col("df") > COMMON)
    # The common part as a number; equal parts have equal ones, and a chance match costs a candidate.
    parts = keep(
        common.groupBy("row", "n", "h").agg(
            F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y")
        )
    )
    least = F.min(F.struct("n", "row")).alias("least")
    heads = parts.join(labels, "row").groupBy("x", "y").agg(least, F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    heads = keep(heads.where("lo <> hi").select("x", "y", F.col("least.row").alias("a"), F.col("least.n").alias("an")))
    members = parts.join(heads, ["x", "y"]).where(f"row <> a AND h >= {overlap('an', 'n', percent)}")
    same = members.select("a", F.col("row").alias("b"))
    whole = keep(prefixes_of(
        common.select("key", "df", "row", "n", F.lit(0).alias("alone")), least_overlap("n", percent)
    ))
    differ = lambda pairs, now: pairs.join(now.select(F.col("row").alias("a"), F.col("comp").alias("ac")), "a").join(
        now.select(F.col("row").alias("b"), F.col("comp").alias("bc")), "b"
    ).where("ac <> bc").select("a", "b")
    met = same.unionByName(hubs(whole, labels, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    links = confirm(differ(met.distinct(), labels))
    labels = relabel(links)
    rest = prefixes_of(
        shared.where(F.col("df") <= COMMON).select("key", "df", "row", "n", "h", "alone"),
        f"greatest(1, {least_overlap('n', percent)} - h)",
    )
    ones = parts.join(labels, "row").groupBy("x", "y", "comp").agg(least)
    ones = keep(ones.select(F.col("least.row").alias("row")))
    alone = meeting(whole.join(ones, "row", "left_semi"), labels, percent, True)
    return links.unionByName(confirm(meeting(rest, labels, percent, False).unionByName(alone).distinct()))
