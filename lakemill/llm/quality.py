"""Quality rules with adaptive thresholds, on DataFrame functions only.

Counts of each text come from array and string functions. Every metric is an
integer, and a sketch of its distribution is a histogram whose buckets keep the
leading ``PRECISION`` bits of the value, so a quantile is off by one part in 64
at most. Sketches merge by adding counts: partitions merge into (language,
source) groups, small groups borrow the sketch of their language or of all.
A document is rejected beyond median + ``reach`` × spread of its group, where
the spread is the distance from the lower quartile, which junk does not move.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemill.llm.common import SPACES, column, field, kept, staying, with_rows

PRECISION = 7
#: Thresholds go to every task if there are at most so many rows of them (about 5 MB); else they are joined by a shuffle.
BROADCAST_ROWS = 100_000
SALTS = 32


@dataclass(frozen=True)
class Rule:
    """Reject where a metric lies ``reach`` spreads above the median; a spread is ``least`` at least."""

    name: str
    least: int
    reach: int = 3


#: Values per thousand words or lines, and hundredths of a character.
RULES = (
    Rule("symbols", 50),
    Rule("dup_lines", 120),
    Rule("word_length", 250),
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, and not once for each element of a lambda that reads it."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in ``words``."""
    size = 8

    def windows(w: Column) -> Column:
        return F.when(
            F.size(w) > size,
            F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size))),
        ).otherwise(F.array().cast("array<bigint>"))

    def marked(w: Column, hashes: Column) -> Column:
        keyed = F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), F.hash(F.slice(w, i + 1, size)).alias("g"), i.alias("p"))
        )
        same = lambda a, b: (a["h"] == b["h"]) & (a["g"] == b["g"])
        beside = lambda s, x, k: F.coalesce(same(F.get(s, k), x), F.lit(False))
        twice = bound(
            F.sort_array(keyed), lambda s: F.filter(s, lambda x, k: beside(s, x, k - 1) | beside(s, x, k + 1))
        )
        return F.sort_array(F.transform(twice, lambda x: x["p"].cast("bigint")))

    def covered(places: Column) -> Column:
        none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
        return F.aggregate(
            places,
            none,
            lambda a, p: F.struct((a["n"] + p + size - F.greatest(p, a["end"])).alias("n"), (p + size).alias("end")),
            lambda a: a["n"],
        )

    def found(w: Column, h: Column) -> Column:
        none = F.lit(0).cast("bigint")
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(marked(w, h)))

    return bound(words, lambda w: bound(windows(w), lambda h: found(w, h)))


def counts(docs: DataFrame, text_col: str = "text", into: str = "counts") -> DataFrame:
    """``docs`` with a struct of the counts of each text; a null text has none of anything."""
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))

    def described(b: Column) -> Column:
        whole = {
            "n_words": F.size(b["words"]),
            "word_chars": F.char_length(F.array_join(b["words"], "")),
            "n_symbols": b["symbols"],
            "n_lines": F.size(b["lines"]),
            "n_dup_lines": F.size(b["lines"]) - F.size(F.array_distinct(b["lines"])),
            "n_repeat_words": b["repeats"],
        }
        return F.struct(*[c.cast("bigint").alias(n) for n, c in whole.items()])

    def read(w: Column) -> Column:
        return F.struct(w.alias("words"), lines.alias("lines"), symbols.alias("symbols"), repeated_words(w).alias("repeats"))

    return docs.withColumn(into, bound(bound(words, read), described))


def base_failed(c: str = "counts") -> Column:
    """Too short, or too much of it repeats."""
    return F.expr(f"{c}.n_words < 20 OR 100 * {c}.n_repeat_words > 30 * {c}.n_words")


def metrics(c: str = "counts") -> dict[str, Column]:
    """Each rule's value; null where nothing is to divide by."""
    return {
        "symbols": F.expr(f"{c}.n_symbols * 1000 div nullif({c}.n_words, 0)"),
        "dup_lines": F.expr(f"{c}.n_dup_lines * 1000 div nullif({c}.n_lines, 0)"),
        "word_length": F.expr(f"{c}.word_chars * 100 div nullif({c}.n_words, 0)"),
    }


def sketch(values: DataFrame, group: list[str]) -> DataFrame:
    """(group, rule, bucket, n): a quantile sketch of every metric, partial sums first."""
    bits = f"greatest(length(bin(value)) - {PRECISION}, 0)"
    long = values.select(
        *group, F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("value")) for r in RULES])).alias("m")
    ).select(*group, "m.rule", "m.value")
    return (
        long.where("value IS NOT NULL")
        .select(*group, "rule", F.expr(f"shiftleft(shiftright(value, {bits}), {bits})").alias("bucket"))
        .groupBy(*group, "rule", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fences(sketches: DataFrame, group: list[str], least_docs: int) -> DataFrame:
    """One row per group with the limit of every rule; groups of fewer than ``least_docs`` have none.

    A group's sketch has a bounded number of buckets, so the window is small.
    """
    own = Window.partitionBy(*group, "rule")
    upto = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketches.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(own).alias("all"))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("all") * q, F.col("bucket")))
    found = ranked.where(F.col("all") >= least_docs).groupBy(*group, "rule").agg(at(25).alias("low"), at(50).alias("mid"))
    limit = lambda r: F.max(
        F.when(F.col("rule") == r.name, F.col("mid") + r.reach * F.greatest(F.col("mid") - F.col("low"), F.lit(r.least)))
    )
    return found.groupBy(*group).agg(*[limit(r).cast("bigint").alias(r.name) for r in RULES])


def thresholds(values: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, limits): from the group's own sketch, else its language's, else that of all."""
    fine = kept(sketch(values, ["lang", "source"]))
    merge = lambda *by: fine.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))
    names = [r.name for r in RULES]
    prefixed = lambda df, p: df.select(
        *[c for c in df.columns if c not in names], *[F.col(c).alias(f"{p}_{c}") for c in names]
    )
    groups = fine.select("lang", "source").distinct()
    one = fences(merge().withColumn("one", F.lit(1)), ["one"], 1).first()  # one number for each rule
    by_lang = fences(merge("lang"), ["lang"], least_docs)
    by_group = fences(fine, ["lang", "source"], least_docs)
    last = {n: F.lit(one[n] if one else None).cast("bigint") for n in names}
    return (
        groups.join(prefixed(by_group, "own"), ["lang", "source"], "left")
        .join(prefixed(by_lang, "lang"), ["lang"], "left")
        .select("lang", "source", *[F.coalesce(f"own_{n}", f"lang_{n}", last[n]).alias(n) for n in names])
    )


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` (lang, source, counts, …) with ``base_failed`` and ``kept``.

    Limits of a proven small number are broadcast. More of them are joined on
    (group, salt), so a source with a third of all rows is many keys.
    """
    limits = kept(limits)
    right = limits.select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.struct(*[r.name for r in RULES]).alias("__limits")
    )
    same = (F.col("__group.lang") == F.col("__lang")) & (F.col("__group.source") == F.col("__source"))
    if limits.count() <= BROADCAST_ROWS:
        joined = measured.join(F.broadcast(right), same, "left")
    else:
        right = right.withColumn("__salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = measured.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = salted.join(right, same & (F.col("__salt") == F.col("__salt2")), "left").drop("__salt", "__salt2")
    values = metrics("__counts")
    within = [
        F.coalesce(values[r.name] <= F.col(f"__limits.{r.name}"), F.lit(True)) for r in RULES
    ]
    fine = within[0]
    for x in within[1:]:
        fine = fine & x
    failed = base_failed("__counts")
    return joined.select(
        *[column(c) for c in measured.columns], failed.alias("__base_failed"), (~failed & fine).alias("__kept")
    )


def grouped(docs: DataFrame, lang_col: str, source_col: str) -> Column:
    """Null language or source counts as the empty one."""
    own = lambda c: F.coalesce(column(c).cast("string"), F.lit(""))
    return F.struct(own(lang_col).alias("lang"), own(source_col).alias("source"))


def limits_of(measured: DataFrame, least_docs: int) -> DataFrame:
    """Limits from all measured documents that the base rules let pass."""
    values = measured.where(~base_failed("__counts")).select(
        "__group.lang", "__group.source", *[v.alias(n) for n, v in metrics("__counts").items()]
    )
    return thresholds(values, least_docs)


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_docs: int = 200,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every row.

    A null or empty text has no words and fails the base rules. Repeated rows
    are judged alike; a null doc_id stays null; an empty table gives an empty
    result. Texts are read once: their counts are checkpointed.
    """
    measured = counts(
        docs.select(column(id_col).alias("doc_id"), column(text_col).alias("__text"), grouped(docs, lang_col, source_col).alias("__group")),
        "__text", "__counts",
    ).select("doc_id", "__group", "__counts")
    measured = kept(measured)
    out = judged(measured, limits_of(measured, least_docs))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select(
        "doc_id", *[F.col(f"__counts.{n}").alias(n) for n in names],
        F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"),
    )


def keep_good(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_docs: int = 200,
) -> DataFrame:
    """The rows of ``docs`` that pass; columns stay as they are. Texts are counted once and joined with the verdicts."""
    rows = with_rows(docs, id_col)
    view = rows.select(
        "row", field(text_col).alias("text"), field(lang_col).alias("lang"), field(source_col).alias("source")
    )
    verdicts = quality(view, id_col="row", least_docs=least_docs)
    return staying(rows, verdicts.where("kept").select(F.col("doc_id").alias("row")))
