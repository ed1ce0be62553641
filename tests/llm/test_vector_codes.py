"""Vector codes against a plain version of the contract."""

import hashlib
import math
import random

import numpy as np
import pytest

from lakemill.llm.vector_codes import Codebooks, Plan, squared, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, vector string, `a.b` int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "c", "e", "v", 1) for i, v, l in rows], SCHEMA).repartition(3)


def plain(rows, plan):
    """Whole numbers in Python, one part at a time, every entry measured."""
    good = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(x) * plan.scale if abs(x) > 2**52 else math.floor(x * plan.scale) for x in v] for _, v, _ in good]
    width = len(whole[0]) // plan.parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(plan.parts)] for v in whole]
    least = sorted(range(len(good)), key=lambda r: (good[r][0] is None, good[r][0] or 0, good[r][1]))[: plan.entries]
    books = [[cut[r][p] for r in least] for p in range(plan.parts)]
    near = lambda part, p: min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))
    for _ in range(plan.rounds):
        for p in range(plan.parts):
            groups = {}
            for row in cut:
                groups.setdefault(near(row[p], p)[1], []).append(row[p])
            for k, members in groups.items():
                books[p][k] = tuple(sum(c) // len(members) for c in zip(*members))
    out = []
    for (i, _, label), row in zip(good, cut):
        found = [near(part, p) for p, part in enumerate(row)]
        out.append([i, "".join(f"{k:02x}" for _, k in found), sum(g for g, _ in found), label])
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    cap = lambda x: x if x < 2**63 else None
    return sorted(((i, c, cap(e), cap(totals[l]), digest, l) for i, c, e, l in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("spread", [0.3, 0.01])
def test_codes_equal_brute_force(spark, spread):
    """Narrow spreads make equal entries and ties; rows repeat, ids and labels are null."""
    draw = random.Random(spread)
    rows = [(k, [draw.gauss(0, spread) for _ in range(8)], draw.choice([1, 2, None])) for k in range(150)]
    rows += [rows[3], (None, rows[5][1], 1), (900, None, 1), (901, [1.0, None] * 4, 1), (902, [float("nan")] * 8, 1)]
    rows += [(903, [float("-inf")] * 8, None), (-4, [0.0] * 8, 2)]
    plan = Plan(parts=4, entries=16)
    assert got(vector_codes(table(spark, rows), plan=plan)) == plain(rows, plan)


def test_one_vector_many_times_and_few_vectors(spark):
    plan = Plan(parts=4, entries=16)
    rows = [(k, [0.1, -0.1] * 4, 1) for k in range(300)] + [(k, [k / 7.0] * 8, 2) for k in range(300, 305)]
    assert got(vector_codes(table(spark, rows), plan=plan)) == plain(rows, plan)
    assert got(vector_codes(table(spark, rows[-3:]), plan=plan)) == plain(rows[-3:], plan)


def test_very_large_components(spark):
    plan = Plan(parts=2, entries=4)
    rows = [(k, [(-1) ** k * 10.0**k, 3.0, 1e-300, float(k)], k % 2) for k in range(30)] + [(40, [1e300, 1.0, 2.0, -1e300], 0)]
    mine = [(i, c, e, d) for i, c, e, _, d, _ in got(vector_codes(table(spark, rows), plan=plan))]
    assert mine == [(i, c, e, d) for i, c, e, _, d, _ in plain(rows, plan)]


def test_empty_tables_and_odd_lengths(spark):
    plan = Plan(parts=4, entries=16)
    assert got(vector_codes(table(spark, []), plan=plan)) == []
    assert got(vector_codes(table(spark, [(1, None, 1)]), plan=plan)) == []
    only = got(vector_codes(table(spark, [(1, [], 1)]), plan=plan))
    assert [r[:4] for r in only] == [(1, None, None, None)]
    mixed = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [1.0] * 4, 1)]
    out = got(vector_codes(table(spark, mixed), plan=plan))
    assert [r[1] is None for r in out] == [False, False, True] and [r[:3] for r in out[:2]] == [r[:3] for r in plain(mixed[:2], plan)]
    with pytest.raises(ValueError):
        vector_codes(table(spark, [(1, [0.5] * 6, 1)]), plan=plan)


def test_search_finds_the_nearest():
    """Entries in clusters: walks end long before they have met all of them."""
    draw = np.random.default_rng(5)
    entries = (draw.integers(0, 8, (2, 64, 1)) * 1000 + draw.integers(0, 40, (2, 64, 3))).astype("int64")
    vectors = (draw.integers(0, 8, (500, 2, 1)) * 1000 + draw.integers(0, 40, (500, 2, 3))).astype("int64")
    books = Codebooks(entries)
    codes, gaps = books.nearest(vectors)
    every = np.stack([squared(vectors[:, None, p], entries[p][None]) for p in range(2)], axis=1)
    assert (codes == every.argmin(axis=2)).all() and (gaps == every.min(axis=2)).all()
