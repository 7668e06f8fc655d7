"""Exact top-k search by inner product, with MaxScore.

Vectors are bags of terms: a term is a dimension, its impact floor(1024 * x). Rows are dealt into shards; queries meet
each shard in blocks. In a shard, a query's terms are ordered by the bound of what they can add to a score there. Terms
whose bounds together can't lift a row over the k-th best score so far are non-essential: the essential terms' postings
are traversed for all rows, and the others are probed, largest bound first, only for rows that are still competitive.
The shards' top k are merged.

Edge cases: rows without an id, and vectors that are null or hold a null or non-finite component, take no part; an empty
vector scores 0 with every query; of vectors of different lengths the missing components are 0; rows that repeat both id
and vector count once; a query's candidates are the rows with another id; if one id has several vectors, each is a
query of its own; ties go to the smaller id; fewer than k candidates are all returned; no queries give an empty result.
A query whose scores in a shard may exceed 64 bits is scored there by Python's integers; only a returned score that doesn't
fit a long is an error. Vectors of any length: a shard's rows become dense in parts of CELLS components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
#: A shard meets a block in one task, so rows are copied once a block and queries once a shard.
SHARD_ROWS = 32768
BLOCK_QUERIES = 16384
#: Rows scored in full before the first threshold is known, and terms probed between two prunings.
SEED_ROWS, STEP = 256, 8

#: Components of a shard's rows that are dense at once; a longer vector is alone.
CELLS = 1 << 24

#: ``beyond`` is 1 where the score is over the largest long, -1 where it is under the least one.
_HITS = "query_id long, query_key long, vec_id long, score long, beyond int"


class Shard:
    """Postings by term: row ``d`` of ``impacts`` has every row's impact on term d; with each term's extremes."""

    def __init__(self, ids: np.ndarray, impacts: np.ndarray):
        self.ids, self.impacts = ids, impacts
        self.high, self.low = (impacts.max(1), impacts.min(1)) if impacts.size else (np.zeros(len(impacts)), np.zeros(len(impacts)))

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows whose id isn't ``own``: ids and scores, by falling score, then id."""
        bounds = np.where(query > 0, query * self.high, query * self.low)
        order = np.argsort(-np.maximum(bounds, 0), kind="stable")
        query, bounds = query[order], bounds[order]
        rest = np.concatenate([np.cumsum(bounds[::-1])[::-1], np.zeros(1, bounds.dtype)])  # rest[i]: what terms from i on can add at most
        least = np.minimum(query * self.high[order], query * self.low[order])
        least = np.concatenate([np.cumsum(least[::-1])[::-1], np.zeros(1, least.dtype)])  # what terms from i on take away at most
        step = max(STEP, len(query) // 64)
        seed = np.flatnonzero(self.ids[: SEED_ROWS + k] != own)
        best = np.sort(query @ self.impacts[order][:, seed]) if len(query) else np.zeros(len(seed))
        floor = best[-k] if len(best) >= k else None
        # Essential: up to the first place from which the rest can't reach the threshold without them.
        essential = len(query) if floor is None else int(np.argmax(rest < floor)) if (rest < floor).any() else len(query)
        score = query[:essential] @ self.impacts[order[:essential]] if essential else np.zeros(len(self.ids), self.impacts.dtype)
        rows = np.arange(len(self.ids))
        while essential < len(query):
            stay = score + rest[essential] >= floor
            rows, score = rows[stay], score[stay]
            terms = slice(essential, essential + step)
            score = score + query[terms] @ self.impacts[order[terms]][:, rows]
            essential = min(essential + step, len(query))
            if len(score) > k:
                lowest = score + least[essential]
                if not (self.ids[rows] == own).any():
                    floor = max(floor, np.partition(lowest, -k)[-k])
        other = self.ids[rows] != own
        ids, score = self.ids[rows[other]], score[other]
        top = np.lexsort((ids, -score))[:k]
        return ids[top], score[top]


def _vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, all components back to back, and each vector's first one (n + 1)."""
    column = table.column("impacts").combine_chunks()
    offsets = np.asarray(column.offsets) if len(column) else np.zeros(1, np.int64)
    return table.column("vec_id").to_numpy(), np.asarray(column.values)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _parts(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Rows that are dense together, shorter ones first."""
    order, begin = np.argsort(lengths, kind="stable"), 0
    for end in range(1, len(order) + 1):
        if end == len(order) or (end + 1 - begin) * int(lengths[order[end]]) > CELLS:
            yield order[begin:end]
            begin = end


def _dense(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A column a row."""
    lengths = offsets[rows + 1] - offsets[rows]
    out = np.zeros((len(rows), int(lengths.max(initial=0))))
    at = np.repeat(offsets[rows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    out[np.arange(out.shape[1]) < lengths[:, None]] = values[at]
    return np.ascontiguousarray(out.T)


def _plainly(ids: np.ndarray, impacts: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows by Python's integers."""
    other, held = np.flatnonzero(ids != own), np.flatnonzero(query)
    weights = [int(v) for v in query[held]]
    score = [sum(w * int(v) for w, v in zip(weights, impacts[held, i], strict=True)) for i in other.tolist()]
    top = sorted(range(len(score)), key=lambda j: (-score[j], ids[other[j]]))[:k]
    return ids[other[top]] if top else ids[:0], np.array([score[j] for j in top], object)


def _search(k: int):
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: dict[str, list] = {c.split()[0]: [] for c in _HITS.split(", ")}
        if queries.num_rows and rows.num_rows:
            (q_ids, q_values, q_at), (ids, values, at) = _vectors(queries), _vectors(rows)
            keys = queries.column("query_key").to_numpy()
            for part in _parts(np.diff(at)):
                x = _dense(values, at, part)
                most, shards = np.abs(x).max(1, initial=0), {}
                for i, own in enumerate(q_ids.tolist()):
                    q = np.zeros(len(x))
                    mine = q_values[q_at[i] : q_at[i + 1]][: len(x)]
                    q[: len(mine)] = mine
                    peak = float(np.abs(q) @ most) * 1.01  # more than any sum can be, rounding counted
                    if peak < 2**62:
                        kind = np.float64 if peak < 2**52 else np.int64  # both are exact here; floats multiply faster
                        if kind not in shards:
                            shards[kind] = Shard(ids[part], x.astype(kind))
                        hit, score = shards[kind].search(q.astype(kind), own, k)
                    else:
                        hit, score = _plainly(ids[part], x, q, own, k)
                    beyond = np.array([(v >= 2**63) - (v < -(2**63)) for v in score.tolist()], np.int32)
                    found["query_id"].append(np.full(len(hit), own))
                    found["query_key"].append(np.full(len(hit), keys[i]))
                    found["vec_id"].append(hit)
                    found["score"].append(np.where(beyond == 0, score, 0).astype(np.int64))
                    found["beyond"].append(beyond)
        kinds = {"beyond": (np.int32, pa.int32())}
        return pa.table({c: pa.array(np.concatenate(v).astype(kinds.get(c, (np.int64,))[0]) if v else np.zeros(0, kinds.get(c, (np.int64,))[0]), kinds.get(c, (0, pa.int64()))[1]) for c, v in found.items()})

    return search


def top_k(rows: DataFrame, is_query, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``is_query`` holds, the k rows with another id that have
    the highest integer inner product."""
    sound = F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("_v"), is_query.alias("_query")).filter(sound)
    floor = lambda y: F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)  # noqa: E731  (larger doubles are integers)
    rows = rows.select("vec_id", F.transform("_v", lambda x: floor(x * SCALE)).alias("impacts"), "_query").dropDuplicates(["vec_id", "impacts"])
    n, queries = rows.agg(F.count(F.lit(1)), F.count_if("_query")).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS), min(48, n // 512)), max(1, -(-queries // BLOCK_QUERIES))
    mine = lambda count, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = rows.filter("_query").select("vec_id", F.xxhash64("impacts").alias("query_key"), "impacts", mine(blocks, 1).alias("block"), every(shards).alias("shard"))
    dealt = rows.select("vec_id", "impacts", mine(shards, 2).alias("shard"), every(blocks).alias("block"))
    hits = asked.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInArrow(lambda a, b: _search(k)(a, b), _HITS)
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("beyond").desc(), F.col("score").desc(), "vec_id")
    top = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("scores may not fit into 64 bits, and a returned one doesn't")).cast("long"))
    return top.select("query_id", "rank", "vec_id", score.alias("score"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
u AS (SELECT vec_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score FROM u q JOIN u c ON q.i = c.i
  WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
