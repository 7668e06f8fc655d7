"""Similarity digests from improbable byte windows.

The entropy of every window of 32 bytes is followed exactly, in integers, along the text. A window's rank is the
probability of its entropy under a fixed reference distribution, so the rarest comes first; windows with under 1.5 bits
a byte (runs, rules) are never features. A window is selected if it is the leftmost of lowest rank in at least 8 of the
32-window neighbourhoods that hold it. Selected windows' hashes go, in text order and each once, into a chain of Bloom
filters of 2048 bits with at most 160 features and 5 bits a feature. The likeness of two digests is the mean, over the
filters of the shorter chain and weighted by their features, of the best overlap with a filter of the other, where 0 is
the overlap expected by chance and 1 the largest possible one.

Edge cases: a text without any selectable window (shorter than 32 bytes, or monotonous) has one feature, its whole text;
an empty text has an empty chain, which is like another empty one (1) and unlike all else (0); equal texts have equal
digests; null is empty; a text of any length is one text, its windows held at once.

In :func:`successors` documents pair with the next by rising doc_id, the last with the first; rows with equal ids follow
each other by text; null ids come first; a sole document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, partitions, powers

WINDOW = 32
NEIGHBOURS = 32
POPULARITY = 8
BITS, FEATURES, HASHES = 2048, 160, 5
#: The reference distribution of a window's entropy, in bits a byte: mean and deviation (fixed values), and the least used.
MEAN, DEVIATION, LEAST = 3.55, 0.22, 1.5

_SHIFT = 1 << 16
_GAIN = np.zeros(WINDOW + 2, np.int64)  # of c log2 c when a count rises to c
_GAIN[1:] = np.round(_SHIFT * np.diff([c * np.log2(c) if c else 0.0 for c in range(WINDOW + 2)])).astype(np.int64)
_NEVER = np.int64(1) << 30


def _rank(sums: np.ndarray) -> np.ndarray:
    """0 for the least probable entropy; ``sums`` has the sum of c log2 c of windows."""
    entropy = np.log2(WINDOW) - sums / (_SHIFT * WINDOW)
    rank = np.round(1e6 * np.exp(-0.5 * ((entropy - MEAN) / DEVIATION) ** 2)).astype(np.int64)
    return np.where(entropy < LEAST, _NEVER, rank)


#: By the sum in steps of 1/64: so few values occur that a table serves.
_TABLE = _rank(np.arange(0, int(WINDOW * np.log2(WINDOW) * 64) + 2) * (_SHIFT // 64))


def windows(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and hash of every window of ``data``; both depend on a window's bytes only."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    order = np.argsort(data, kind="stable")
    key = order + (data[order].astype(np.int64) << 40)
    before, after = np.zeros(len(data), np.int8), np.zeros(len(data), np.int8)  # equal bytes among the 31 before, after
    near, m = np.arange(1, len(data)), 1
    while len(near):
        near = near[key[near] - key[near - m] < WINDOW]
        before[order[near]] += 1
        after[order[near - m]] += 1
        near, m = near[near > m], m + 1
    rises = _GAIN[before[WINDOW:] + 1] - _GAIN[after[: n - 1] + 1]
    sums = np.empty(n, np.int64)
    sums[0] = _GAIN[before[:WINDOW] + 1].sum()
    np.cumsum(rises, out=sums[1:])
    sums[1:] += sums[0]
    up, down = powers(len(data) + 1)[:2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return _TABLE[np.maximum(sums, 0) >> 10], (total[WINDOW:] - total[:-WINDOW]) * down[:n]


def select(rank: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions of the popular windows; text i has the windows first[i] to first[i + 1]."""
    count = np.diff(first)
    gap = NEIGHBOURS - 1
    placed = np.arange(len(rank)) + np.repeat(np.arange(1, len(count) + 1) * gap, count)
    padded = np.full(len(rank) + gap * (len(count) + 1), _NEVER << 30, np.int64)  # texts lie so far apart that no neighbourhood has two
    padded[placed] = (rank << 30) + placed
    least = padded
    step = 1
    while step < NEIGHBOURS:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = least[least < _NEVER << 30]
    popular = np.bincount(least & ((1 << 30) - 1), minlength=len(padded))[placed] if len(least) else np.zeros(len(rank), int)
    return np.flatnonzero((popular >= POPULARITY) & (rank < _NEVER))


def digests(rank: np.ndarray, hashes: np.ndarray, first: np.ndarray, whole: list[bytes]) -> list[np.ndarray]:
    """Each text's chain of filters, as rows of the number of features and 256 bytes; ``whole``: the texts."""
    texts = len(first) - 1
    at = select(rank, first)
    doc = np.searchsorted(first, at, side="right") - 1
    none = np.setdiff1d(np.flatnonzero([bool(x) for x in whole]), doc)
    alone = np.array([int.from_bytes(hashlib.blake2b(whole[i], digest_size=8).digest(), "little") for i in none], np.uint64)
    doc, feature = np.concatenate([doc, none]), mix64(np.concatenate([hashes[at], alone]))
    # each feature of a text once, at its first place
    order = np.lexsort((np.arange(len(doc)), feature, doc))
    once = np.ones(len(doc), bool)
    once[1:] = (doc[order][1:] != doc[order][:-1]) | (feature[order][1:] != feature[order][:-1])
    kept = np.sort(order[once])
    kept = kept[np.argsort(doc[kept], kind="stable")]
    doc, feature = doc[kept], feature[kept]
    count = np.bincount(doc, minlength=texts)
    nth = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    filters = -(-count // FEATURES)
    base = np.concatenate([[0], np.cumsum(filters)])
    bits = np.zeros(int(base[-1]) * BITS, bool)
    home = (base[doc] + nth // FEATURES) * BITS
    for i in range(HASHES):
        bits[home + ((feature >> np.uint64(11 * i)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, bitorder="little").reshape(-1, BITS // 8)
    size = np.bincount(home // BITS, minlength=int(base[-1])).astype(np.uint8)
    rows = np.concatenate([size[:, None], packed], 1)
    return [rows[base[i] : base[i + 1]] for i in range(texts)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1 for two chains."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    x, y = a[:, 1:], b[:, 1:]
    px, py = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    both = np.stack([np.bitwise_count(row & y).sum(1, dtype=np.int64) for row in x])
    chance, most = px[:, None] * py / BITS, np.minimum(px[:, None], py)
    overlap = np.where(most > chance, (both - chance) / np.maximum(most - chance, 1e-9), 0)
    weight = a[:, 0].astype(float)
    return float(np.clip((overlap.max(1) * weight).sum() / weight.sum(), 0, 1))


def encode(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8 + 1)


class Features:
    """Windows of many texts at once, and of texts put together from their parts without doing parts again."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        self.rank, self.hash = windows(self.data)

    def of(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranks, hashes and first window of the byte ranges, which must not span two texts."""
        count = np.maximum(length - WINDOW + 1, 0)
        first = np.concatenate([[0], np.cumsum(count)])
        index = np.arange(first[-1]) + np.repeat(start - first[:-1], count)
        return self.rank[index], self.hash[index], first


def _chains(texts: list[bytes], parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Digests of texts whose windows are those of ``parts``, one after another."""
    counts = np.stack([np.diff(f) for _, _, f in parts])
    first = np.concatenate([[0], np.cumsum(counts.sum(0))])
    rank, hashes = np.empty(first[-1], np.int64), np.empty(first[-1], np.uint64)
    shift = first[:-1].copy()
    for (r, h, f), count in zip(parts, counts, strict=True):
        index = np.arange(len(r)) + np.repeat(shift - f[:-1], count)
        rank[index], hashes[index] = r, h
        shift += count
    return digests(rank, hashes, first, texts)


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    f = Features(texts)
    return _chains(texts, [f.of(f.at[:-1], np.diff(f.at))])


def _halves(text: bytes) -> tuple[int, int, int]:
    """Code points, those of the last half, and the byte where that half begins."""
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    half = len(starts) // 2
    return len(starts), half, int(starts[len(starts) - half]) if half else len(text)


def _head(text: bytes, points: int) -> int:
    """Bytes of a text's first code points."""
    if points >= len(text):
        return len(text)
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return int(starts[points]) if points < len(starts) else len(text)


def compare(texts: list[bytes]) -> dict[str, list]:
    """The columns of all texts but the last, each with its next: its own digest, its edited text's, and likenesses."""
    base = Features(texts)
    parts = [_halves(x) for x in texts[:-1]]
    cut = np.array([p[2] for p in parts], np.int64)
    head = np.array([_head(y, p[1]) for p, y in zip(parts, texts[1:], strict=True)], np.int64)
    edited = [x[:c] + y[:h] for x, y, c, h in zip(texts, texts[1:], cut, head, strict=False)]
    edge = WINDOW - 1
    seams = Features([x[max(0, c - edge) : c] + y[: min(h, edge)] for x, y, c, h in zip(texts, texts[1:], cut, head, strict=False)])
    own = _chains(texts, [base.of(base.at[:-1], np.diff(base.at))])
    changed = _chains(edited, [base.of(base.at[:-2], cut), seams.of(seams.at[:-1], np.diff(seams.at)), base.of(base.at[1:-1], head)])
    return {
        "n_chars": [p[0] for p in parts],
        "edited_sha256": [hashlib.sha256(x).hexdigest() for x in edited],
        "fingerprint": [encode(x) for x in own[:-1]],
        "edited_fingerprint": [encode(x) for x in changed],
        "near_edited": [likeness(a, b) for a, b in zip(own[:-1], changed, strict=True)],
        "near_next": [likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)],
    }


CHUNK_BYTES = 1 << 20
_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _follow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by bucket and id; a ghost is the first row of the next bucket and ends its bucket."""
    ids: list = []
    texts: list[bytes] = []
    size, bucket, ended = 0, None, False

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(ids[:-1], pa.int64())} | compare(texts), _OUT)

    for batch in batches:
        for doc, text, b, ghost in zip(batch.column(0), batch.column(1).cast(pa.binary()).fill_null(b""), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if b != bucket:
                if len(ids) > 1:
                    yield flush()
                ids, texts, size, bucket, ended = [], [], 0, b, False
            if ended:
                continue
            ids.append(doc.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            ended = ghost
            if size >= CHUNK_BYTES and len(ids) > 1:
                yield flush()
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if len(ids) > 1:
        yield flush()


def successors(docs: DataFrame) -> DataFrame:
    """Every row with its fingerprint, its edited text's and the likenesses.

    Rows go to buckets of rising ids by quantiles; the first id of each bucket comes to the driver (a number for each
    bucket), and rows with it go to the bucket before as well, as ghosts. So texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = 4 * partitions(spark)
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    marks = rows.agg(F.percentile_approx(key, [i / wanted for i in range(wanted + 1)], 10 * wanted)).first()[0] or []
    marks = np.unique(np.array(marks, np.int64))

    @F.pandas_udf("int")
    def bucket_of(x):
        import pandas as pd

        return pd.Series(np.maximum(np.searchsorted(marks, x.to_numpy(), side="right") - 1, 0).astype(np.int32))

    placed = rows.withColumn("_key", key).withColumn("_bucket", bucket_of("_key"))
    firsts = [(r[0], r[1]) for r in placed.groupBy("_bucket").agg(F.min("_key")).orderBy("_bucket").collect()]
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    if not before:
        return rows.select("doc_id").mapInArrow(lambda batches: iter(()), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    ghosts = spark.createDataFrame([(k, b) for k, b in before.items()], "_first long, _to int")
    copies = placed.join(F.broadcast(ghosts), F.col("_key") == F.col("_first")).select("doc_id", "text", F.col("_to").alias("_bucket"), F.lit(True).alias("_ghost"), "_key")
    both = placed.select("doc_id", "text", "_bucket", F.lit(False).alias("_ghost"), "_key").unionByName(copies)
    dealt = both.repartition(partitions(spark), "_bucket").sortWithinPartitions("_bucket", "_ghost", "_key", "text")
    return dealt.select("doc_id", "text", "_bucket", "_ghost").mapInArrow(_follow, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
