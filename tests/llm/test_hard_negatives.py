"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookmart.llm.hard_negatives import Best, Block, hard_negatives, products, spanning_tree

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, anchor_id long, vector int"


def brute(rows, positives=5, negatives=5, shares=(80, 100)):
    v = [(i, y, [math.floor(256 * x) for x in e]) for i, e, y, *_ in rows
         if i is not None and y is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    anchors = {}
    for i, y, e in sorted(v):
        if i % 10 == 0:
            anchors.setdefault(i, (y, e))
    out = []
    for a, (y, e) in anchors.items():
        scored = [(-sum(p * q for p, q in zip(e, f)), i, z == y) for i, z, f in v if i != a]
        best = sorted((s, i) for s, i, same in scored if same)[:positives]
        for s, p in best:
            hard = sorted((t, i) for t, i, same in scored if not same and shares[0] * -s <= shares[1] * -t <= shares[1] * -s)[:negatives]
            out += [(a, p, n, i, -s, -t) for n, (t, i) in enumerate(hard, 1)]
    return sorted(out)


def made(seed, n, width, labels=3, spread=0.3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    f = np.float32
    return [(i, [float(f(x + r.gauss(0, spread))) for x in r.choice(centres)], r.randrange(labels), "r", 1, 2) for i in range(n)]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()))
    assert got == brute(rows, **options)
    return got


@pytest.mark.parametrize("seed, width, spread", [(1, 8, 0.3), (2, 3, 0.05), (3, 1, 1.0)])
def test_against_all_scores(spark, seed, width, spread):
    assert check(spark, made(seed, 400, width, spread=spread))


def test_other_numbers_and_shares(spark):
    assert check(spark, made(5, 200, 4), positives=2, negatives=3, shares=(1, 2))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    more = ("r", 1, 2)
    rows = made(7, 120, 4) + [
        (200, None, 1, *more), (210, [1.0, 2.0, 3.0, 4.0], None, *more), (None, [1.0] * 4, 1, *more), (220, [nan, 1.0, 1.0, 1.0], 1, *more),
        (230, [1.0, inf, 0.0, 0.0], 1, *more), (240, [1.0, None, 0.0, 0.0], 1, *more), (250, [], 1, *more), (260, [0.5, 0.5], 2, *more),
        (270, [0.0] * 4, 0, *more), (-10, [1.0, -1.0, 0.5, 0.5], 1, *more),
    ] + [(301, [1.0, 0.5, 0.25, 2.0], y, *more) for y in (0, 1, 1, 2)] * 3 + [(i, [1.0, 1.0, 1.0, 1.0], i % 3, *more) for i in range(310, 330)]
    assert check(spark, rows)


def test_empty_tables(spark):
    assert check(spark, []) == []
    assert check(spark, [(1, [1.0], 1, "r", 1, 2)]) == []
    assert check(spark, [(10, [1.0], 1, "r", 1, 2), (20, [1.0], 1, "r", 1, 2)]) == []


def test_numbers_beyond_doubles(spark):
    rows = [(i, [x * (1.0 + (i % 5) * 2.0**-20) for x in e], y, *m) for i, e, y, *m in made(9, 60, 2)]
    big = [(i, [float(np.float32(x * 2.0**21)) for x in e], y, *m) for i, e, y, *m in rows]
    assert check(spark, big)


def test_passes_of_few_blocks(spark, monkeypatch):
    monkeypatch.setattr("brookmart.llm.hard_negatives.PASS_BYTES", 1)
    monkeypatch.setattr("brookmart.llm.hard_negatives.BLOCK", 4)
    rows = made(11, 1500, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives(df, F.col("vec_id") % 50 == 0)
    assert got.count() > 0
    want = {r for r in brute(rows) if r[0] % 50 == 0}
    assert set(map(tuple, got.collect())) == want


def test_the_tree_is_a_minimum_one():
    r = np.random.default_rng(1)
    v = r.normal(size=(40, 3))
    order, parents, edges = spanning_tree(v)
    assert sorted(order) == list(range(40)) and (parents[1:] < np.arange(1, 40)).all()
    assert np.allclose(edges[1:], np.linalg.norm(v[order[1:]] - v[order[parents[1:]]], axis=1))
    pairs = sorted((np.linalg.norm(v[i] - v[j]), i, j) for i in range(40) for j in range(i))
    group, total = list(range(40)), 0.0
    for d, i, j in pairs:
        if group[i] != group[j]:
            total += d
            old = group[i]
            group = [group[j] if g == old else g for g in group]
    assert math.isclose(edges.sum(), total)


def test_bounds_hold_and_spare_work():
    r = np.random.default_rng(2)
    centre = r.normal(size=(1, 6)) * 200
    anchors = np.floor(centre + r.normal(size=(50, 6)) * 2)
    rows = np.floor(r.normal(size=(300, 6)) * 200)
    order, parents, edges = spanning_tree(anchors)
    block = Block(np.arange(50), np.zeros(50, np.int64), anchors[order], parents, edges)
    least = np.quantile(rows @ anchors[0], 0.95)
    met = {}
    done = block.intervals(rows, np.linalg.norm(rows, axis=1), lambda k, low, high: high >= least, lambda k, which, s: met.update({k: (which, s)}))
    assert done < 0.3 * 50 * 300
    for k in range(1, 50):
        exact = rows @ anchors[order[k]]
        assert set(np.flatnonzero(exact >= least)) <= set(met[k][0]) and (met[k][1] == exact[met[k][0]]).all()


def test_best_keeps_ties_by_identifier():
    best = Best(1, 2)
    best.add(0, np.array([5.0, 7.0, 5.0]), np.array([9, 3, 2]))
    best.add(0, np.array([5.0, 4.0]), np.array([1, 0]))
    assert best.kept[0] == [(-7, 3), (-5, 1)]
    assert products(np.array([[2.0**40, 1.0]]), np.array([2.0**40, 1.0])).tolist() == [2**80 + 1]
