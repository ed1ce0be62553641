"""Components of crowded sets against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import crowds, minhash


def crowd(seed):
    """Sets around shared passages: whole, in part, with edits, with much and little of their own."""
    draw = random.Random(seed)
    fresh = iter(range(10**6, 10**9))
    passages = [[next(fresh) for _ in range(60)] for _ in range(2)]
    found = []
    for _ in range(90):
        passage = passages[draw.random() < 0.2]
        lost = draw.choice([0, 0, 0, 1, 5, 15])
        own = draw.choice([0, 3, 8, 12, 15, 20, 40, 150])
        part = draw.sample(passage, len(passage) - lost)
        if found and draw.random() < 0.3:
            part += draw.sample(sorted(draw.choice(found)), 8)
        found.append(frozenset([*part, *(next(fresh) for _ in range(own))]))
    return sorted(set(found), key=sorted)


def joined(found, percent):
    comp = list(range(len(found)))
    for i in range(len(found)):
        for j in range(i):
            both = len(found[i] & found[j])
            if 100 * both >= percent * len(found[i] | found[j]) and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    return {frozenset(k for k, c in enumerate(comp) if c == d) for d in comp}


@pytest.mark.parametrize("percent, common", [(75, 4), (80, 30)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, percent, common):
    monkeypatch.setattr(crowds, "COMMON", common)
    found = crowd(percent)
    plan = minhash.Plan(percent=percent)
    packed = [(k, np.sort(np.array(list(s), dtype="uint64")).tobytes()) for k, s in enumerate(found)]
    sets = minhash.kept(spark.createDataFrame([(k, bytearray(p)) for k, p in packed], "row long, set binary").repartition(3))
    nodes = sets.select("row")
    labels = nodes.select("row", F.col("row").alias("comp"))
    seen = []

    def confirm(pairs):
        seen.append(pairs.count())
        return minhash.confirmed(pairs, sets, plan)

    links = crowds.crowd_links(sets, labels, percent, minhash.kept, confirm, lambda more: minhash.components(nodes, more))
    reached = {}
    for r in minhash.components(nodes, links).collect():
        reached.setdefault(r["comp"], set()).add(r["row"])
    want = joined(found, percent)
    assert {frozenset(x) for x in reached.values()} == want and 2 < len(want) < len(found) - 5
    assert sum(seen) < len(found) ** 2 / 4


def test_copies_with_edits_meet_few(spark):
    """Where most pairs are similar, what is compared grows with the sets, not with their pairs."""
    draw = random.Random(5)
    fresh = iter(range(10**6, 10**9))
    base = [next(fresh) for _ in range(120)]
    found = [frozenset([*draw.sample(base, 120 - k % 12), *(next(fresh) for _ in range(k % 7))]) for k in range(160)]
    plan = minhash.Plan(percent=80)
    packed = [(k, bytearray(np.sort(np.array(list(s), dtype="uint64")).tobytes())) for k, s in enumerate(found)]
    sets = minhash.kept(spark.createDataFrame(packed, "row long, set binary").repartition(3))
    nodes = sets.select("row")
    seen = []

    def confirm(pairs):
        seen.append(pairs.count())
        return minhash.confirmed(pairs, sets, plan)

    labels = nodes.select("row", F.col("row").alias("comp"))
    links = crowds.crowd_links(sets, labels, 80, minhash.kept, confirm, lambda more: minhash.components(nodes, more))
    reached = {}
    for r in minhash.components(nodes, links).collect():
        reached.setdefault(r["comp"], set()).add(r["row"])
    assert {frozenset(x) for x in reached.values()} == joined(found, 80)
    assert sum(seen) < 20 * len(found)


@pytest.mark.parametrize("carried", [2, 100])
def test_pairs_are_formed_at_the_first_key(spark, monkeypatch, carried):
    """The keys carried spare repeated pairs and never the only one."""
    monkeypatch.setattr(crowds, "CARRIED", carried)
    draw = random.Random(carried)
    base = list(range(60))
    found = [sorted(draw.sample(base, 50)) for _ in range(30)]
    df = {k: sum(k in x for x in found) for k in base}
    rows = [(k, df[k], r, len(x), 0) for r, x in enumerate(found) for k in x]
    keys = spark.createDataFrame(rows, "key long, df long, row long, n long, alone long")
    prefixes = minhash.kept(crowds.prefixes_of(keys, crowds.least_overlap("n", 70)))
    labels = spark.createDataFrame([(r, r) for r in range(30)], "row long, comp long")
    met = {(r["a"], r["b"]) for r in crowds.meeting(prefixes, labels, 70, True).collect()}
    similar = {(a, b) for b in range(30) for a in range(b) if 100 * len({*found[a]} & {*found[b]}) >= 70 * len({*found[a]} | {*found[b]})}
    assert similar and similar <= met
