"""Centroid clustering of integer vectors: kd-trees of a partition's vectors, through which candidate centroids are filtered.

A tree holds ``tree_rows`` vectors at most, halved at the median of the widest side down to leaves; each node has its count,
its componentwise integer sums and its box, and is stored once for all rounds. A round sends all centroids down each tree. At
a node a centroid goes where another one is strictly nearer to every place of the box (to the corner that favours it most).
Where one is left, the whole node is its: count and sums are added. What reaches a leaf with more is measured exactly; of
equal distances the centroid with the smaller number counts, which strict pruning never takes away.

Trees meet nothing but the centroids (``k`` times ``dims`` integers), so rounds are maps over stored rows, with a sum for each
centroid and component behind them: ``k`` times (``dims`` + 1) numbers come to the driver, whatever the input.

All is integer arithmetic: in 64-bit floats where every sum is below 2**53, else by Python's integers without a tree.

Edge cases: vectors that are null, of another length, or hold a null or non-finite component are left out. With fewer than
``k`` vectors each is a centroid; without any the result is empty. Repeated rows, also with one id, are vectors of their own.
A vector without id is a first centroid only where too few have one. A scaled component beyond 2**62, or a returned distance
or inertia that doesn't fit a long, is an error. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

LEAF = 32
_TREE = "ids array<bigint>, points binary, low binary, high binary, sums binary"
#: Node by centroid by component at once, while boxes are pruned.
_CELLS = 1 << 22


class Tree(NamedTuple):
    """Points in the order of the leaves; boxes and sums of all levels' nodes, the root first."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray


def _levels(n: int) -> int:
    return max(0, -(-n // LEAF) - 1).bit_length()


def _cuts(n: int, level: int) -> np.ndarray:
    """The edges of a level's nodes."""
    return (np.arange((1 << level) + 1) * n) >> level


def build(points: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The tree, and which point stands at each of its places."""
    n, order = len(points), np.arange(len(points))
    points = points.copy()
    for level in range(_levels(n)):
        edges, halves = _cuts(n, level), _cuts(n, level + 1)
        for i in range(1 << level):
            a, b = edges[i], edges[i + 1]
            part = points[a:b]
            widest = np.argmax(part.max(0) - part.min(0))
            halved = np.argpartition(part[:, widest], halves[2 * i + 1] - a)
            points[a:b], order[a:b] = part[halved], order[a:b][halved]
    nodes = [_cuts(n, level)[:-1] for level in range(_levels(n) + 1)]
    low, high, sums = (np.concatenate([f.reduceat(points, at) for at in nodes]) for f in (np.minimum, np.maximum, np.add))
    return Tree(points, low, high, sums), order


def fits(tree_points: np.ndarray, centroids: np.ndarray) -> bool:
    """Whether all that filtering adds up is below 2**53."""
    most = max(int(np.abs(tree_points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    return 4 * tree_points.shape[1] * most * most < 1 << 53 and most * len(tree_points) < 1 << 53


def _dominated(low: np.ndarray, high: np.ndarray, centroids: np.ndarray, norms: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node's box its candidates that stay, and the one nearest to its middle."""
    best = np.argmin(np.where(alive, norms - (low + high) @ centroids.T, np.inf), 1)
    stay = np.empty_like(alive)
    step = max(1, _CELLS // centroids.size)
    for a in range(0, len(low), step):
        b = slice(a, a + step)
        away = centroids[None] - centroids[best[b]][:, None]
        corner = np.where(away > 0, high[b][:, None], low[b][:, None])  # of all places of the box the one most to the candidate's side
        stay[b] = norms[None] - norms[best[b]][:, None] - 2 * np.einsum("mkd,mkd->mk", corner, away) <= 0
    return alive & stay, best


def nearest(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The centroid of each point, and each centroid's count and sums."""
    n, k = len(tree.points), len(centroids)
    if not fits(tree.points, centroids):
        return _plainly(tree.points, centroids)
    c = centroids.astype(np.float64)
    norms, cluster = (c * c).sum(1), np.empty(n, np.int32)
    counts, sums = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
    node, alive = np.zeros(1, np.int64), np.ones((1, k), bool)
    for level in range(_levels(n) + 1):
        at, edges = node + (1 << level) - 1, _cuts(n, level)
        alive, best = _dominated(tree.low[at].astype(np.float64), tree.high[at].astype(np.float64), c, norms, alive)
        whole = alive.sum(1) == 1
        for i, z in zip(node[whole].tolist(), best[whole].tolist(), strict=True):
            cluster[edges[i] : edges[i + 1]] = z
        np.add.at(sums, best[whole], tree.sums[at[whole]])
        np.add.at(counts, best[whole], edges[node[whole] + 1] - edges[node[whole]])
        node, alive = node[~whole], alive[~whole]
        if level < _levels(n):
            node, alive = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([alive, alive])
    edges = _cuts(n, _levels(n))
    sizes = edges[node + 1] - edges[node]
    rows = np.repeat(edges[node] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    if len(rows):
        x = tree.points[rows]
        cluster[rows] = np.argmin(np.where(np.repeat(alive, sizes, 0), norms - 2 * (x @ c.T), np.inf), 1)
        np.add.at(sums, cluster[rows], x)
        counts += np.bincount(cluster[rows], minlength=k)
    return cluster, counts, sums


def _plainly(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    wide, c = points.astype(object), centroids.astype(object)
    cluster = np.array([int(np.argmin(((c - p) ** 2).sum(1))) for p in wide], np.int32)
    sums = np.zeros(c.shape, object)
    np.add.at(sums, cluster, wide)
    return cluster, np.bincount(cluster, minlength=len(c)), sums


def distances(points: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Squared distances of points to their own centroids."""
    if fits(points, own):
        return ((points - own) ** 2).sum(1)
    found = [int(((p - c) ** 2).sum()) for p, c in zip(points.astype(object), own.astype(object), strict=True)]
    if max(found, default=0) >= 1 << 63:
        raise OverflowError("a squared distance doesn't fit a long")
    return np.array(found, np.int64)


def integers(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, x``: the vectors that take part, as integers."""

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0**62, F.floor(scaled)).otherwise(F.raise_error(F.lit("a scaled component is beyond 2**62")).cast("long"))

    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter((F.size("embedding") == dims) & F.coalesce(finite, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("x"))


def trees(rows: DataFrame, dims: int, tree_rows: int) -> DataFrame:
    """A row a tree, stored."""

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tree(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            points = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            # sums of components too large for 64 bits are never read, as such points are measured without a tree
            made, order = build(points)
            ids = rows["vec_id"].combine_chunks().take(pa.array(order))
            return pa.record_batch([pa.array([ids.to_pylist()], pa.list_(pa.int64())), *(pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in made)], names=[c.split()[0] for c in _TREE.split(", ")])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < tree_rows:
                continue
            whole = pa.Table.from_batches(held)
            last = len(whole) - len(whole) % tree_rows
            for a in range(0, last, tree_rows):
                yield tree(whole.slice(a, tree_rows))
            held = whole.slice(last).to_batches()
        if sum(b.num_rows for b in held):
            yield tree(pa.Table.from_batches(held))

    return materialize(rows.mapInArrow(grown, _TREE), "trees")


def _read(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, Tree]]:
    for i in range(batch.num_rows):
        yield batch["ids"][i].values, Tree(*(np.frombuffer(batch[c][i].as_buffer(), np.int64).reshape(-1, dims) for c in Tree._fields))


def _moved(forest: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floors of their vectors' means; those without vectors stay."""
    k, dims = centroids.shape

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), object)
        for batch in batches:
            for _, tree in _read(batch, dims):
                _, counts, sums = nearest(tree, centroids)
                total[:, :dims] += sums.astype(object)
                total[:, dims] += counts.astype(object)
        z, d = np.nonzero(total)
        yield pa.record_batch([pa.array(z, pa.int32()), pa.array(d, pa.int32()), pa.array([str(v) for v in total[z, d]], pa.string())], names=["z", "d", "total"])

    parts = forest.mapInArrow(filtered, "z int, d int, total string")
    total = np.zeros((k, dims + 1), object)
    for z, d, v in parts.groupBy("z", "d").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("v")).collect():  # k times (dims + 1) rows at most
        total[z, d] = int(v)
    after = centroids.copy()
    for z in range(k):
        if total[z, dims]:
            after[z] = [v // total[z, dims] for v in total[z, :dims]]
    return after


def kd_means(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", tree_rows: int = 1024) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for each vector that takes part."""
    spark = vectors.sparkSession
    rows = integers(vectors, dims, scale)
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = [r.x for r in rows.withColumn("h", first).orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()]
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not chosen:
        return spark.createDataFrame([], result)
    centroids = np.array(chosen, np.int64)
    forest = trees(rows, dims, tree_rows)
    for _ in range(rounds):
        centroids = _moved(forest, centroids)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tree in _read(batch, dims):
                cluster, _, _ = nearest(tree, centroids)
                yield pa.record_batch([ids, pa.array(cluster, pa.int32()), pa.array(distances(tree.points, centroids[cluster]), pa.int64())], names=["vec_id", "cluster", "distance"])

    found = materialize(forest.mapInArrow(assigned, "vec_id long, cluster int, distance long"), "clusters")
    own = {r.cluster: int(r.own) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()}  # k rows at most
    inertia = sum(own.values())
    if inertia >= 1 << 63:
        raise OverflowError("the inertia doesn't fit a long")
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    per = spark.createDataFrame([(z, own[z], inertia, digest(centroids[z])) for z in own], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2") -> str:
    """SQL that measures every vector against every centroid, round after round."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS z, x AS c FROM (SELECT sha256('{seed}:' || vec_id::VARCHAR) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, x, arg_min(z, d * 1000 + z) AS z, min(d) AS d FROM (
    SELECT r, vec_id, x, z, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i}) GROUP BY r, vec_id, x)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.z, COALESCE(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT z, list((s - (s % n + n) % n) // n ORDER BY j) AS c FROM (
      SELECT z, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, {dims + 1}) t(j) GROUP BY z, j) GROUP BY z) m ON m.z = c{i}.z)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, a{rounds}.z::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a{rounds}.z)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (z)"""
