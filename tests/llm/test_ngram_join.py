"""The n-gram join against all pairs."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import crowds, ngram_join
from lakemill.llm.minhash import shingles

SCHEMA = "doc_id long, text string, row long, class string, comp string, n int, key string, `a.b` int"


def shingle_set(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    size = min(words, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


def brute(found, percent=80):
    sets = [shingle_set(t) for _, t in found]
    comp = list(range(len(found)))
    for i in range(len(found)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {c: min((x for (x, _), d in zip(found, comp) if d == c), key=lambda x: (x is None, x or 0)) for c in comp}
    return collections.Counter((x, len(s), least[c]) for (x, _), s, c in zip(found, sets, comp))


def joined(spark, found):
    df = spark.createDataFrame([(i, t, 1, "c", "d", 2, "k", 3) for i, t in found], SCHEMA).repartition(4)
    out = ngram_join.ngram_join(df).collect()
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out)


def texts(seed):
    """Copies, edits, chains, short texts, and texts around a passage with much and little of their own."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    words = lambda n: [word() for _ in range(n)]
    found = []
    passage = words(60)
    for own in [0, 2, 5, 8, 10, 12, 14, 16, 20, 30, 60, 200] * 4:
        found.append([*words(own // 2), *passage, *words(own - own // 2)])
    base = words(120)
    for _ in range(30):
        copy = list(base)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(len(copy))] = word()
        found.append(copy)
    chain = words(90)
    for _ in range(10):
        found.append(chain)
        chain = chain[3:] + words(3)
    few = words(4)
    found += [few[:k] for k in (1, 2, 3, 4)] + [few * k for k in (2, 3, 4)] + [words(n) for n in (5, 6, 7, 9, 40)]
    numbered = [(i, " ".join(w)) for i, w in enumerate(found)]
    numbered += [(500, None), (501, ""), (502, " \t "), (None, numbered[3][1]), (503, numbered[3][1].upper()), (504, " ".join(words(3000)))]
    numbered += [numbered[7], numbered[7]]
    draw.shuffle(numbered)
    return numbered


@pytest.mark.parametrize("seed, small, dear, common", [(1, 6, 32, 32), (2, 2, 0, 4), (3, 2, 10**6, 32)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, small, dear, common):
    """With the real limits, with all dear sets through the crowd, and with none."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "DEAR", dear)
    monkeypatch.setattr(crowds, "COMMON", common)
    found = texts(seed)
    assert joined(spark, found) == brute(found)


def test_empty_tables(spark):
    assert not joined(spark, []) and joined(spark, [(1, None)]) == {(1, 0, 1): 1}


@pytest.mark.parametrize("percent", [60, 75, 80, 90])
def test_pigeonhole(percent):
    """Similar sets share a whole segment, also where as many as the budget leaves are skipped."""
    draw = random.Random(percent)
    for _ in range(400):
        n = draw.choice([5, 9, 14, 40, 150, 700])
        own = draw.sample(range(10**12), n)
        lost = draw.randrange(max(1, n // 4))
        other = own[lost:] + draw.sample(range(10**12, 2 * 10**12), draw.randrange(max(1, n // 8)))
        a, b = (np.sort(np.array(x, dtype="uint64")) for x in sorted((own, other), key=len))
        both = len(np.intersect1d(a, b))
        if 100 * both < percent * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        band = ngram_join.band_of(len(a), percent)
        at = ngram_join.band_of(len(b), percent)
        assert at == band or (at == band + 1 and ngram_join.looks_below(len(b), percent))
        same = (ngram_join.full_keys(a, band, percent) == ngram_join.full_keys(b, band, percent)).sum()
        skipped = ngram_join.segments(band, percent) - ngram_join.needed(len(b), band, percent)
        assert skipped >= 0 and same > skipped


def test_deletions_are_subsets_with_one_less():
    own = shingles("a b c d e f g h i j k l m n o p q r s t u v w x y z", 5)
    band = ngram_join.band_of(len(own), 80)
    at, less = ngram_join.deletion_keys(own, band, 80)
    for k in range(len(own)):
        assert ngram_join.full_keys(np.delete(own, k), band, 80)[at[k]] == less[k]


def test_only_texts_that_are_asked_for_travel(spark):
    found = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(400)]
    docs = spark.createDataFrame(found, "row long, text string")
    rows = spark.createDataFrame([(i,) for i in range(0, 400, 40)], "row long")
    df = ngram_join.sets_of(docs, rows, ngram_join.Plan())
    assert {r["row"]: bytes(r["set"]) for r in df.collect()} == {i: shingles(t, 5).tobytes() for i, t in found if i % 40 == 0}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("ArrowEvalPython")  # below the join


def test_lists_of_keys_stay_where_they_are(spark):
    """Copies do not make a key shared, and of the lists only keys that several sets hold go on."""
    texts = [f"one two three four five six seven eight nine ten {w}" for w in ("a", "b", "a", "a")]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    marks = ngram_join.signed(docs, ngram_join.Plan())
    shared = ngram_join.entries_of(marks).groupBy("key").agg(F.min("entry").alias("a"), F.max("entry").alias("b")).where("a div 2 <> b div 2")
    bits = ngram_join.key_filter(shared.select("key"))
    kept = {(r["row"], len(r["keys"])) for r in ngram_join.filtered(marks, bits).where("role = 1").collect()}
    held = [set(r["own"]) for r in marks.orderBy("row").collect()]
    assert held[0] == held[2] != held[1] and kept == {(i, len(held[0] & held[1])) for i in range(4)}
