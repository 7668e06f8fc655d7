"""Drop lines that many documents repeat, by sharded minimal perfect hash.

Each distinct qualifying line hash gets a slot of its shard's minimal perfect hash; compact arrays indexed by slot hold a
fingerprint, the count of documents and the document that keeps the line. Documents send 16-byte hashes to the shards
and probe these arrays; lines themselves are neither shuffled nor joined.

A line's key is the line without the bytes ``[ \\t-\\r]`` at both ends and with A-Z lower-cased. Documents are distinct
ids; rows without an id are distinct texts. Hash: 128 bits of XXH3.

Edge cases: a null or empty text is one empty line and comes back as an empty text; a text of any length is split whole;
rows that repeat an id count once for a line, and of rows that share the largest doc_id with a line all keep it; a null
doc_id counts as less than all others, so it keeps a line only if no other row has it; an empty table gives an empty
result; other columns are carried only on request, under any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, carried_row, materialize, mix64, partitions

MIN_CHARS = 40
MIN_DOCS = 5
#: Lines with more than 1 / HOT_LINES of all counted occurrences are hot. So there are HOT_LINES of them at most, whatever
#: the input; every task holds their arrays (24 bytes a line), and no shard gets their occurrences.
HOT_LINES = 4096
GAMMA = 2.0
#: Stands for a null doc_id: the least one, so that null keeps a line only where no other row has it.
NO_ID = -(2**63)


class MinimalPerfectHash:
    """Keys (uint64, distinct) to 0..n-1: a cascade of bit arrays, each with the keys that fall on a bit alone.

    ``sizes`` has the bits of each level and ``words`` all levels' bits; a slot is the number of set bits before a key's.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        keys, sizes, bits = np.asarray(keys, np.uint64), [], []
        while len(keys):
            size = -(-max(64, int(len(keys) * GAMMA)) // 64) * 64
            at = cls.place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            keys = keys[~alone[at]]
        packed = np.packbits(np.concatenate(bits), bitorder="little").view(np.uint64) if bits else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), packed)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 if no level has it (other unknown keys get any slot: compare a fingerprint)."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.place(keys[left], level, int(size)) + self.starts[level]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            here = (self.words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[here]] = (self.before[word] + below)[here]
            left = left[~here]
            if not len(left):
                break
        return out


class LineIndex:
    """One shard: a minimal perfect hash over line hashes and, by slot, the fingerprint, count and keeper arrays."""

    def __init__(self, mph: MinimalPerfectHash, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.mph, self.prints, self.counts, self.keepers = mph, prints, counts, keepers

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> LineIndex:
        mph = MinimalPerfectHash.build(h1.view(np.uint64) ^ mix64(h2.view(np.uint64)))
        slot = mph.slots(h1.view(np.uint64) ^ mix64(h2.view(np.uint64)))
        out = [np.empty(len(h1), np.int64), np.empty(len(h1), np.int64), np.empty(len(h1), np.int64)]
        for to, values in zip(out, (h2, counts, keepers), strict=True):
            to[slot] = values
        return cls(mph, *out)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Each hash's slot, -1 if the index doesn't hold it."""
        if not len(self.prints):
            return np.full(len(h1), -1, np.int64)
        slot = self.mph.slots(h1.view(np.uint64) ^ mix64(h2.view(np.uint64)))
        slot[(slot >= 0) & (self.prints[slot] != h2)] = -1
        return slot

    def to_row(self) -> dict[str, bytes]:
        return {"sizes": self.mph.sizes.tobytes(), "words": self.mph.words.tobytes(), "prints": self.prints.tobytes(), "counts": self.counts.tobytes(), "keepers": self.keepers.tobytes()}

    @classmethod
    def from_row(cls, row: dict[str, bytes]) -> LineIndex:
        long = {k: np.frombuffer(row[k], np.int64) for k in ("sizes", "prints", "counts", "keepers")}
        return cls(MinimalPerfectHash(long["sizes"], np.frombuffer(row["words"], np.uint64)), long["prints"], long["counts"], long["keepers"])


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """A line's key, None if it is shorter than ``min_chars`` code points."""
    key = line.strip(SPACE)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key.lower()  # of bytes: A-Z only


def _hashes(text: bytes, min_chars: int) -> dict[bytes, None]:
    return dict.fromkeys(xxhash.xxh3_128_digest(k) for line in text.split(b"\n") if (k := key_of(line, min_chars)) is not None)


def _occurrences(min_chars: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, found = [], [], []
            for doc, text, row in zip(batch.column(0), batch.column(1).cast(pa.binary()).fill_null(b""), batch.column(2), strict=True):
                own = _hashes(text.as_py(), min_chars)
                found.extend(own)
                ids.extend([doc.as_py()] * len(own))
                rows.extend([row.as_py()] * len(own))
            both = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["doc_id", "row", "h1", "h2"])

    return emit


_INDEX = "shard int, sizes binary, words binary, prints binary, counts binary, keepers binary"


def _build(group: pa.Table) -> pa.Table:
    h1, h2, counts, keepers = (group.column(k).to_numpy() for k in ("h1", "h2", "n", "keeper"))
    row = LineIndex.build(h1, h2, counts, keepers).to_row()
    return pa.table({"shard": pa.array([group.column("shard")[0].as_py()], pa.int32())} | {k: pa.array([v], pa.binary()) for k, v in row.items()})


def _probe(index: pa.Table, lines: pa.Table) -> pa.Table:
    ids, h1, h2 = lines.column("doc_id"), lines.column("h1").to_numpy(), lines.column("h2").to_numpy()
    if not index.num_rows or not len(h1):
        hit = np.zeros(len(h1), bool)
    else:
        arrays = LineIndex.from_row({k: index.column(k)[0].as_py() for k in index.column_names if k != "shard"})
        slot = arrays.probe(h1, h2)
        hit = (slot >= 0) & (arrays.keepers[slot] != ids.fill_null(NO_ID).to_numpy()) if len(arrays.prints) else np.zeros(len(h1), bool)
    return pa.table({"doc_id": ids.filter(pa.array(hit)), "row": lines.column("row").filter(pa.array(hit)), "hash": pa.array([a.tobytes() for a in np.stack([h1[hit], h2[hit]], 1)], pa.binary())})


def _clean(hot: dict[str, bytes], min_chars: int, carried: list[str]):
    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = LineIndex.from_row(hot)
        for batch in batches:
            out: dict[str, list] = {"n_lines": [], "n_dropped": [], "kept": []}
            for doc, text, drop in zip(batch.column(0), batch.column(1).cast(pa.binary()).fill_null(b""), batch.column(2), strict=True):
                text, drop, doc = text.as_py(), set(drop.as_py() or ()), NO_ID if (doc := doc.as_py()) is None else doc
                lines, kept = text.count(b"\n") + 1, None
                if drop or len(arrays.prints) and len(text) >= min_chars:
                    parts = text.split(b"\n")
                    digests = [k if (k := key_of(x, min_chars)) is None else xxhash.xxh3_128_digest(k) for x in parts]
                    if len(arrays.prints) and (own := list(dict.fromkeys(x for x in digests if x is not None))):
                        both = np.frombuffer(b"".join(own), np.int64).reshape(-1, 2)
                        slot = arrays.probe(both[:, 0].copy(), both[:, 1].copy())
                        drop |= {own[i] for i in np.flatnonzero(slot >= 0) if arrays.keepers[slot[i]] != doc}
                    if drop:
                        kept = [x for x, d in zip(parts, digests, strict=True) if d not in drop]
                out["n_lines"].append(lines)
                out["n_dropped"].append(lines - len(kept) if kept is not None else 0)
                out["kept"].append(text if kept is None else b"\n".join(kept))
            made = [batch.column(0), pa.array(out["n_lines"], pa.int64()), pa.array(out["n_dropped"], pa.int64())]
            if carried[3] == "kept_sha256":
                made.append(pa.array([hashlib.sha256(x).hexdigest() for x in out["kept"]], pa.string()))
            else:
                made.append(pa.array(out["kept"], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*made, *(batch.column(3).flatten() if len(carried) > 4 else [])], carried)

    return clean


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, text_out: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_lines, n_dropped`` of each row, with ``kept_text`` (or, without ``text_out``, its ``kept_sha256``)
    and the columns ``carry``: lines whose key has ``min_chars`` code points and is in ``min_docs`` documents or more are
    dropped except in the largest doc_id that holds them."""
    spark = docs.sparkSession
    row = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))  # so that rows without an id don't gather in one group
    lines = materialize(docs.select("doc_id", "text", row).mapInArrow(_occurrences(min_chars), "doc_id long, row long, h1 long, h2 long"), "lines")
    counted = lines.groupBy("h1", "h2").agg(F.count_distinct(F.coalesce("doc_id", "row")).alias("n"), F.coalesce(F.max("doc_id"), F.lit(NO_ID)).alias("keeper")).filter(F.col("n") >= min_docs)
    counted = materialize(counted, "line-counts")
    total, entries = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hot_from = max(min_docs, total // HOT_LINES) + 1
    hot = counted.filter(F.col("n") >= hot_from).toArrow()
    assert hot.num_rows <= HOT_LINES
    hot_row = LineIndex.build(*(hot.column(k).to_numpy().copy() for k in ("h1", "h2", "n", "keeper"))).to_row()
    # A shard holds about 2**20 lines' arrays and probes about 2**21 occurrences of lines, whether these repeat or not, in
    # even shares: no line in it is hot.
    shards = max(4 * partitions(spark), entries >> 20, lines.count() >> 21)
    shard = F.pmod("h1", F.lit(shards)).cast("int")
    index = counted.filter(F.col("n") < hot_from).withColumn("shard", shard).groupBy("shard").applyInArrow(_build, _INDEX)
    cold = lines.join(F.broadcast(counted.filter(F.col("n") >= hot_from).select("h1", "h2")), ["h1", "h2"], "left_anti").withColumn("shard", shard)
    hits = index.groupBy("shard").cogroup(cold.groupBy("shard")).applyInArrow(_probe, "doc_id long, row long, hash binary")
    drops = hits.groupBy(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).agg(F.collect_set("hash").alias("drop"))
    kinds = dict(docs.dtypes)
    carried = ["doc_id", "n_lines", "n_dropped", "kept_text" if text_out else "kept_sha256", *carry]
    schema = ", ".join([f"`doc_id` {kinds['doc_id']}, n_lines long, n_dropped long, {carried[3]} string", *(f"`{c}` {kinds[c]}" for c in carry)])
    rows = docs.select("doc_id", "text", row.alias("row"), carried_row(carry)).join(drops.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("row").eqNullSafe(F.col("_row")), "left")
    return rows.select("doc_id", "text", "drop", "carried").mapInArrow(_clean(hot_row, min_chars, carried), schema)


ORACLE = """
WITH l AS (SELECT d.doc_id, u.i, string_split(coalesce(d.text, ''), chr(10))[u.i] AS line
  FROM documents d, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) AS i) u),
k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.i, k.line, r.key IS NOT NULL AND r.keeper <> k.doc_id AS dropped FROM k LEFT JOIN r ON r.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
