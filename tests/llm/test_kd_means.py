"""Centroids through kd-trees against every vector measured with every centroid."""

import hashlib
import math
import random

import numpy as np
import pytest

from palimpsest.llm import kd_means


def plainly(rows, k, rounds, dims, scale=256, seed="2"):
    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]
    measure = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), z) for z, c in enumerate(centroids))
    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(measure(v)[1], []).append(v)
        centroids = [[sum(x) // len(held[z]) for x in zip(*held[z], strict=True)] if z in held else c for z, c in enumerate(centroids)]
    found = [(i, *measure(v)[::-1]) for i, v in kept]
    own = {}
    for _, z, d in found:
        own[z] = own.get(z, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, z, d, own[z], sum(own.values()), sha[z]) for i, z, d in found), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    return sorted(map(tuple, kd_means.kd_means(df, **kw).collect()), key=str)


@pytest.mark.parametrize("dims, spread", [(2, 4), (3, 0.05), (8, 1)])
def test_against_brute_force(spark, dims, spread):
    """Few dimensions, where boxes prune; the coarse grid has ties in plenty and repeated rows."""
    r = random.Random(dims)
    rows = [(i, [round(r.gauss(r.choice([-3, 0, 3]), spread), 1) for _ in range(dims)]) for i in range(900)]
    rows += rows[:50] + [(None, rows[0][1]), (2000, None), (2001, [1.0] * (dims + 1)), (2002, [float("nan")] * dims), (2003, [None] * dims), (2004, [math.inf] * dims), (2005, [])]
    assert run(spark, rows, k=7, rounds=3, dims=dims, tree_rows=200) == plainly(rows, 7, 3, dims)


def test_filtering_prunes_and_keeps_ties():
    """Whole nodes are assigned where clusters lie apart; a centroid as near as the best one is never pruned before it."""
    r = np.random.default_rng(5)
    points = np.concatenate([r.integers(-20, 20, (300, 4)) + 1000 * i for i in range(4)])
    tree, order = kd_means.build(points)
    assert (points[order] == tree.points).all() and (tree.sums[0] == points.sum(0)).all() and len(tree.low) == 127
    for centroids in (np.array([[1000 * i] * 4 for i in range(4)]), np.array([[0] * 4, [0] * 4, [2000] * 4, [1000] * 4])):
        cluster, counts, sums = kd_means.nearest(tree, centroids)
        want, n, s = kd_means._plainly(tree.points, centroids)
        assert (cluster == want).all() and (counts == n).all() and (sums == s).all()
    c = np.array([[1000.0 * i] * 4 for i in range(4)])
    at = slice(3, 7)  # the four nodes of the third level: each lies in one cluster
    alive, _ = kd_means._dominated(tree.low[at].astype(float), tree.high[at].astype(float), c, (c * c).sum(1), np.ones((4, 4), bool))
    assert (alive.sum(1) == 1).all()


def test_large_components(spark):
    """Beyond what floats add up exactly, and where a distance doesn't fit."""
    r = random.Random(1)
    rows = [(i, [r.choice([-1, 1]) * 2.0**20 + r.random(), r.random()]) for i in range(60)]
    assert run(spark, rows, k=3, rounds=2, dims=2) == plainly(rows, 3, 2, 2)
    same = [(i, [2.0**50, 1.0]) for i in range(5)]
    assert {row[2] for row in run(spark, same, k=2, rounds=2, dims=2)} == {0}
    for bad in ([(0, [2.0**50]), (1, [-(2.0**50)])], [(0, [1e300])]):
        with pytest.raises(Exception, match="fit|beyond"):
            run(spark, bad, k=1, rounds=1, dims=1)


def test_few_and_none(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert run(spark, rows, k=40, dims=2) == plainly(rows, 40, 5, 2)
