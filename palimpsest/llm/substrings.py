"""Remove byte strings of 200 bytes or more that occur more than once, with a logarithmic family of suffix arrays.

The suffixes that matter are those of repeated neighbourhoods. Every 200-byte window has an anchor, the leftmost of its
32-byte strings of least hash, so equal windows have equal anchors at equal places. Neighbouring windows with one anchor
make a segment.

1. Anchors' hashes are counted; segments whose anchor occurs once hold nothing that repeats and go no further.
2. The other anchors' distinct segments, each with the number of its copies, are dealt into shards, by anchor. A shard's
   segments come in batches. A batch gets the suffix array of its windows, which is merge-scanned against each existing
   level (the sorted positions of windows, without repeated ones) for matches of 200 bytes; what is new becomes a level,
   and levels of equal size merge. The index decides what repeats: a window found twice, or in a segment with copies.
   Anchors with more than SHARD_SEGMENTS distinct segments take several shards; what these don't find twice themselves is
   then counted over shards by 128-bit prints.
3. The removed runs meet their documents; segments with very many copies are broadcast to them (HOT at most).

Edge cases: a null text is empty; texts under 200 bytes keep all; a text of any length is cut into overlapping parts of
2**23 bytes for its segments, so no window is lost; a text may repeat itself, also with overlap; rows that repeat remove
each other's text whole where it has 200 bytes; an empty table gives an empty result; a null doc_id stays; of other
columns only ``carry`` is kept, under any names. Rows are told apart by doc_id and 64 bits of a hash of the text, a
segment by 64 bits of its anchor's hash and 64 of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, Ranges, carried_row, flat, materialize, mix64, partitions, skew_join

LENGTH, ANCHOR = 200, 32
CHUNK_BYTES = 1 << 20
BATCH_SEGMENTS = 128
SHARD_SEGMENTS = 2048


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts back to back: each segment's text, first byte and end (in ``data``), anchor hash and content hash."""
    none = np.zeros(0, np.int64)
    wide = length - ANCHOR + 1  # anchors in a window
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, none, none
    ranges = Ranges(data)
    hashes = mix64((ranges.wide[ANCHOR:] - ranges.wide[:-ANCHOR]) * ranges.tables[1][: len(data) - ANCHOR + 1])
    key = ((hashes >> np.uint64(24 + 1)) << np.uint64(24)).view(np.int64) | np.arange(len(hashes))  # 39 bits of hash, then the place
    least, step = key, 1
    while step * 2 <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[: n], least[wide - step : wide - step + n])
    text = np.searchsorted(offsets, np.arange(n), side="right") - 1
    inside = np.arange(n) + length <= offsets[text + 1]
    start = np.flatnonzero(inside)
    if not len(start):
        return none, none, none, none, none
    anchor, text = least[start] & ((1 << 24) - 1), text[start]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    begin, end = start[first], start[last] + length
    content = mix64(ranges.hashes(begin, end) + (anchor[first] - begin).astype(np.uint64))
    return text[first], begin, end, hashes[anchor[first]].view(np.int64), content.view(np.int64)


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about CHUNK_BYTES of text; a longer text is alone (and no longer than 2**24 bytes at a time)."""
    sizes = np.diff(flat(batch.column(column))[1])
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > CHUNK_BYTES:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += size
    if batch.num_rows:
        yield batch.slice(at)


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Segments of texts of any length: of over 2**23 bytes at a time, in parts that overlap so that no window is lost.

    A segment cut by a part's edge comes as two that hold its windows between them.
    """
    step = 1 << 23
    if len(data) <= step:
        yield segments(data, offsets, length)
        return
    for a in range(0, len(data), step):
        b = min(len(data), a + step + length - 1)
        i, j = np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b, side="left")
        part = np.clip(offsets[i : j + 1], a, b) - a
        text, begin, end, h, g = segments(data[a:b], part, length)
        yield text + i, begin + a, end + a, h, g


def _emit(places: bool, length: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch, 1):
                data, offsets = flat(part.column(1))
                ids, row = part.column(0).to_numpy(), part.column(2).to_numpy()
                for text, begin, end, h, g in _pieces(data, offsets, length):
                    columns = {"h": pa.array(h), "g": pa.array(g)}
                    if places:
                        columns |= {"id": pa.array(ids[text]), "row": pa.array(row[text]), "start": pa.array(begin - offsets[text]), "size": pa.array((end - begin).astype(np.int32))}
                    yield pa.RecordBatch.from_pydict(columns)

    return emit


SCAN = 8192  # windows of a level that are laid out at a time


class SuffixIndex:
    """Texts back to back in ``pool``; ``hit`` tells the positions whose window occurred more than once so far.

    A level is a suffix array without repeated windows: their positions in the pool, in the order of their bytes.
    """

    def __init__(self, length: int = LENGTH):
        self.length, self.levels, self.size = length, [], 0
        self.pool, self.hit = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, bool)

    def windows(self, at: np.ndarray) -> np.ndarray:
        """The windows at these positions, as fixed-width byte strings."""
        views = np.lib.stride_tricks.sliding_window_view(self.pool, self.length)
        return views[at].view(f"S{self.length}").ravel()

    def _grow(self, size: int) -> None:
        while len(self.pool) < size:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.hit = np.concatenate([self.hit, np.zeros_like(self.hit)])

    def scan(self, level: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted windows stand in a level, and whether it has them; both are read in order."""
        at, found, done = np.full(len(keys), len(level)), np.zeros(len(keys), bool), 0
        for i in range(0, len(level), SCAN):
            if done == len(keys):
                break
            block = self.windows(level[i : i + SCAN])
            to = done + int(np.searchsorted(keys[done:], block[-1], side="right"))
            place = np.searchsorted(block, keys[done:to])
            at[done:to], found[done:to], done = i + place, block[place] == keys[done:to], to
        return at, found

    def add(self, texts: list[bytes], twice: list[bool] | None = None) -> list[int]:
        """The texts' places in the pool; windows of a text that occurs ``twice`` count as found again."""
        begin = [int(x) for x in self.size + np.concatenate([[0], np.cumsum([len(x) for x in texts])])]
        self._grow(begin[-1] + self.length)
        self.pool[self.size : begin[-1]] = np.frombuffer(b"".join(texts), np.uint8)
        self.size = begin.pop()
        spans = [np.arange(b, b + len(x) - self.length + 1) for b, x in zip(begin, texts, strict=True)]
        for span, more in zip(spans, twice or (), strict=False):
            self.hit[span] |= more
        at = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        if not len(at):
            return begin
        keys = self.windows(at)
        order = np.argsort(keys, kind="stable")  # the batch's suffix array
        keys, at = keys[order], at[order]
        same = keys[1:] == keys[:-1]
        self.hit[at[1:][same]] = True
        self.hit[at[:-1][same]] = True
        head = np.concatenate([[True], ~same])
        run = np.cumsum(head) - 1
        distinct, fresh = keys[head], np.ones(int(head.sum()), bool)
        for level in self.levels:
            place, found = self.scan(level, distinct)
            self.hit[level[place[found]]] = True
            self.hit[at[found[run]]] = True
            fresh &= ~found
        if fresh.any():
            self.levels.append(at[head][fresh])
            while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
                last = self.levels.pop()
                place, _ = self.scan(self.levels[-1], self.windows(last))
                self.levels.append(np.insert(self.levels.pop(), place, last))
        return begin


_FOUND = "h long, g long, low int, high int, w1 long, w2 long"


def _scan(length: int):
    def scan(group: pa.Table) -> pa.Table:
        """Runs of repeated windows of each segment; for anchors in several shards also what others have to know: a row
        with a print (w1, w2) for each window found once here, and one without a segment for each found more often."""
        group = group.sort_by([("h", "ascending"), ("g", "ascending")])
        texts, twice = [x.as_py() for x in group.column("content")], group.column("twice").to_pylist()
        index, begin = SuffixIndex(length), []
        for i in range(0, len(texts), BATCH_SEGMENTS):
            begin += index.add(texts[i : i + BATCH_SEGMENTS], twice[i : i + BATCH_SEGMENTS])
        counts, begin = np.array([max(0, len(x) - length + 1) for x in texts], np.int64), np.array(begin, np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        hit = index.hit[begin[owner] + place] if len(owner) else np.zeros(0, bool)
        edge = np.ones(len(hit), bool)
        edge[1:] = (owner[1:] != owner[:-1]) | (hit[1:] != hit[:-1])
        first = np.flatnonzero(edge)
        last = np.append(first[1:], len(hit)) - 1
        runs = hit[first] if len(first) else np.zeros(0, bool)
        h, g = group.column("h").to_numpy(), group.column("g").to_numpy()
        a, b = first[runs], last[runs]
        out = {"h": [h[owner[a]]], "g": [g[owner[a]]], "low": [place[a]], "high": [place[b]], "w": []}
        if group.column("shards")[0].as_py() > 1:
            for level in index.levels:
                keys = (k for i in range(0, len(level), SCAN) for k in index.windows(level[i : i + SCAN]).tolist())
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.ljust(length, b"\0")) for k in keys), np.int64).reshape(-1, 2)
                own, often = np.searchsorted(begin, level, side="right") - 1, index.hit[level]
                out["h"].append(h[own])
                out["g"].append(g[own])
                out["low"].append(np.where(often, -1, level - begin[own]))
                out["high"].append(np.where(often, -1, level - begin[own]))
                out["w"].append(digest)
        flat_ = {k: np.concatenate(v) if v else np.zeros((0, 2), np.int64) for k, v in out.items()}
        gap = len(flat_["h"]) - len(flat_["w"])
        w = [pa.concat_arrays([pa.nulls(gap, pa.int64()), pa.array(flat_["w"][:, i].copy(), pa.int64())]) for i in (0, 1)]
        return pa.table({"h": pa.array(flat_["h"], pa.int64()), "g": pa.array(flat_["g"], pa.int64()), "low": pa.array(flat_["low"], pa.int32()), "high": pa.array(flat_["high"], pa.int32()), "w1": w[0], "w2": w[1]})

    return scan


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {"h": [], "g": [], "twice": [], "shards": [], "shard": [], "content": []}
        for text, wanted in zip(batch.column(0).cast(pa.binary()).fill_null(b""), batch.column(1).to_pylist(), strict=True):
            text = text.as_py()
            for x in wanted:
                for k in ("h", "g", "twice", "shards", "shard"):
                    rows[k].append(x[k])
                rows["content"].append(text[x["start"] : x["start"] + x["size"]])
        yield pa.RecordBatch.from_arrays([pa.array(rows["h"], pa.int64()), pa.array(rows["g"], pa.int64()), pa.array(rows["twice"], pa.bool_()), pa.array(rows["shards"], pa.int32()), pa.array(rows["shard"], pa.int64()), pa.array(rows["content"], pa.binary())], list(rows))


def _remove(carried: list[str], extra: int):
    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "spans": [], "kept": []}
            for text, cuts in zip(batch.column(1).cast(pa.binary()).fill_null(b""), batch.column(2).to_pylist(), strict=True):
                text, spans = text.as_py(), []
                for c in sorted((c["start"], c["end"]) for c in cuts or ()):
                    if spans and c[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], c[1])
                    else:
                        spans.append([c[0], c[1]])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(sum(b - a for a, b in spans))
                out["n_spans"].append(len(spans))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept"].append(b"".join(kept))
            made = {"doc_id": batch.column(0)} | {k: pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")}
            if "spans" in carried:
                made["spans"] = pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            if "kept" in carried:
                made["kept"] = pa.array(out["kept"], pa.binary())
            if "kept_sha256" in carried:
                made["kept_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in out["kept"]], pa.string())
            own = [made[c] for c in carried[: len(carried) - extra]]
            yield pa.RecordBatch.from_arrays([*own, *(batch.column(3).flatten() if extra else [])], carried)

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH, bytes_out: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` of each row, with ``spans`` and the bytes ``kept`` (or, without
    ``bytes_out``, their ``kept_sha256``) and the columns ``carry``."""
    spark = docs.sparkSession
    # Of rows with one id, 64 bits of the text tell which is which; without an id 128 bits do.
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").try_cast("long"), F.xxhash64(F.lit("no id"), "text")).alias("id"), F.xxhash64("text").alias("row"), carried_row(carry))
    plain = rows.select("id", "text", "row")
    anchors = plain.mapInArrow(_emit(False, length), "h long, g long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(anchors.filter("n > 1").select("h"), "anchors")
    found = plain.mapInArrow(_emit(True, length), "h long, g long, id long, row long, start long, size int")
    placed = materialize(found.join(repeated, "h"), "segments")
    distinct = materialize(placed.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row", "start", "size")).alias("at")), "distinct")
    wide = distinct.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / SHARD_SEGMENTS).cast("int").alias("shards"))
    total, places = distinct.count(), placed.count()
    buckets = max(4 * partitions(spark), total // SHARD_SEGMENTS)
    # Anchors with one shard share the buckets; each shard of the others is a group of its own.
    shard = F.when(F.col("shards") == 1, F.pmod(F.xxhash64("h"), F.lit(buckets))).otherwise(buckets + F.abs(F.xxhash64("h", F.pmod("g", "shards")) % (2**40)))
    wanted = skew_join(distinct, wide, ["h"], F.col("shards") > max(1, total // SHARD_SEGMENTS // HOT)).withColumn("shard", shard)
    part = F.struct("h", "g", (F.col("n") > 1).alias("twice"), "shards", "shard", F.col("at.start").alias("start"), F.col("at.size").alias("size"))
    by_row = wanted.groupBy(F.col("at.id").alias("_id"), F.col("at.row").alias("_row")).agg(F.collect_list(part).alias("parts"))
    once = plain.join(by_row.hint("shuffle_hash"), (F.col("id") == F.col("_id")) & (F.col("row") == F.col("_row")))
    contents = once.select("text", "parts").mapInArrow(_cut_out, "h long, g long, twice boolean, shards int, shard long, content binary").dropDuplicates(["h", "g"])
    scanned = materialize(contents.groupBy("shard").applyInArrow(lambda t: _scan(length)(t), _FOUND), "scanned")
    across = scanned.filter("w1 IS NOT NULL")
    often = across.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    runs = scanned.filter("w1 IS NULL").select("h", "g", "low", "high").unionByName(across.filter("low >= 0").join(often, ["w1", "w2"]).select("h", "g", "low", "high"))
    held = runs.groupBy("h", "g").agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    held = held.join(distinct.select("h", "g", "n"), ["h", "g"])
    hits = skew_join(placed, held, ["h", "g"], F.col("n") > max(1024, places // HOT))
    cut = F.explode(F.transform("runs", lambda r: F.struct((F.col("start") + r["low"]).alias("start"), (F.col("start") + r["high"] + length).alias("end"))))
    cuts = hits.select(F.col("id").alias("_id"), F.col("row").alias("_row"), cut.alias("cut")).groupBy("_id", "_row").agg(F.collect_set("cut").alias("cuts"))
    kinds = dict(docs.dtypes)
    carried = ["doc_id", "n_bytes", "n_removed", "n_spans", *(("spans", "kept") if bytes_out else ("kept_sha256",)), *carry]
    made = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "spans": "array<struct<start: long, end: long>>", "kept": "binary", "kept_sha256": "string"}
    own = carried[: len(carried) - len(carry)]
    schema = ", ".join([f"`{c}` {made.get(c) or kinds[c]}" for c in own] + [f"`{c}` {kinds[c]}" for c in carry])
    joined = rows.join(cuts.hint("shuffle_hash"), (F.col("id") == F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    return joined.select("doc_id", "text", "cuts", "carried").mapInArrow(_remove(carried, len(carry)), schema)
