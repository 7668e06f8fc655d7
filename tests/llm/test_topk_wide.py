"""Top-k where 64-bit floats or longs don't reach, and over vectors of very different lengths."""

import math
import random

import pytest
from pyspark.sql import functions as F

from palimpsest.llm import topk


def plainly(rows, k):
    kept = {(i, tuple(math.floor(x * 1024) for x in v)) for i, v in rows}
    out = []
    for q, a in kept:
        if q % 2 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in kept if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 2 == 0, k).collect()))


def test_own_row_and_pairs_that_never_meet_do_not_overflow(spark):
    rows = [(0, [3e6, 0.5]), (1, [0.25, 1.0]), (3, [0.5, 0.5])]
    assert run(spark, rows) == plainly(rows, 3)
    rows = [(1, [3e6, 0.5]), (3, [4e6, 0.5]), (2, [0.5, 1.0]), (5, [1e30, -1e30])]
    assert run(spark, rows, 2) == plainly(rows, 2)


def test_between_floats_and_longs(spark):
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) * r.choice([1.0, 2.0**16, 2.0**18]) for _ in range(5)]) for i in range(60)]
    assert run(spark, rows) == plainly(rows, 3)


def test_only_returned_scores_have_to_fit(spark):
    rows = [(0, [2.0**25, 0.0]), (1, [-(2.0**25), 0.0]), (3, [1.0, 0.0]), (5, [2.0, 0.0]), (7, [0.5, 9.0])]
    assert run(spark, rows) == plainly(rows, 3)
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [*rows, (9, [2.0**25, 0.0])])
    with pytest.raises(Exception, match="64 bits"):
        run(spark, rows, 4)


def test_one_very_long_vector(spark, monkeypatch):
    """Rows are dense in parts, so a long vector doesn't widen the others."""
    r = random.Random(3)
    rows = [(i, [r.uniform(-1, 1) for _ in range(r.choice([0, 1, 3, 8]))]) for i in range(80)] + [(101, [0.5] * 300_000), (102, [0.25] * 200_000)]
    assert run(spark, rows) == plainly(rows, 3)
    monkeypatch.setattr(topk, "CELLS", 16)
    parts = [p.tolist() for p in topk._parts(topk.np.array([3, 1, 40, 8, 8, 2]))]
    assert parts == [[1, 5, 0], [3, 4], [2]]
