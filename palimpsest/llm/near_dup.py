"""Link documents by the Jaccard similarity of their word shingles, with signature trees.

Words are runs of other bytes than ``[ \\t-\\r]``, A-Z lower-cased; a document's set has its distinct shingles of k
words, as 64-bit hashes, or with fewer words the whole sequence as one. Two documents link when the similarity reaches
the threshold, a ratio of integers. No link is lost:

1. Documents with equal sets are one class (128 bits of a digest of the set); classes go on, as numbered nodes.
2. Two sets that reach the threshold share an element of their prefixes, the first n - ceil(t n) + 1 elements in any
   global order. The order here: elements of a fixed part U of the hash space, those of fewer classes first, then the rest. So a class whose elements in U are mostly its own has no candidate. A class with too few
   elements in U for its prefix sends all its elements. Elements are counted by hash; those that stand out in one of SAMPLE
   texts (HOT at most) are spread over SALTS tasks each and count as equally frequent, which is an order, too.
3. Classes that are tied by shared prefix elements, and by sizes that allow a link, form families: components of that
   graph. A family of BLOCK classes at most is one group.
4. Larger families first link what is easy, in rounds: classes without a large component are dealt by a min-hash of their
   prefixes into groups of about BLOCK, each with the PIVOTS of its sizes (the classes with the most links so far), so that a
   mass of near copies becomes one component. What remains are links between components: sizes are divided into bins such that links are within bins or between adjacent ones, a bin's classes
   into blocks, those of a large component apart, and blocks meet but for those of one component. Families of over WIDE
   blocks aren't met as a whole: there the classes with one shared element, and sizes that allow a link, are what is
   divided so, and elements that only one component has are left out. So a set is copied at most once for each block that
   shares one of its prefix elements.
5. Where blocks meet, each one's classes form a signature tree: leaves by size, inner nodes with the OR of their bitmaps
   (a bit for each element that two of the sets have) and their range of sizes. A dual traversal leaves out pairs of nodes
   whose largest possible overlap can't reach the threshold, and counts the overlaps of the others' leaves exactly. It
   emits each set with the first one of its links' component there, or all links on request.
6. Components of the links, over classes, give each document its component.

Edge cases: a null, empty or blank text has an empty set and links with nothing, its component is its own id; a text of
any length is one set; rows that repeat an id are nodes of their own, and take part in the smallest id; a null id counts
only where all of a component's ids are null; an empty table gives an empty result; only the columns named below are made.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT, LOWER, discard, flat, materialize, mix64, partitions, range_hashes, runs, skew_join, word_spans
from .components import components

BLOCK = 256  # classes in a block
WIDE = 64  # blocks of a family that is met as a whole
PURE = 64  # classes of a component that has blocks of its own
PIVOTS = 8
MOST = 4096  # an element that so many classes have isn't counted further
SAMPLE, OFTEN, SALTS = 64, 64, 64  # an element is spread if OFTEN of the sampled classes have it
LEAF, FAN = 16, 8
NO_ID = -(2**63)  # stands for a null id


def _least_overlap(n, num: int, den: int):
    return -(-n * num // den)


def prefix_length(n: int, num: int, den: int) -> int:
    """Any set that reaches the threshold with one of n elements shares ceil(n num / den) of them at least."""
    return n - _least_overlap(n, num, den) + 1


def _cut(num: int, den: int) -> int:
    """Hashes 0 <= h < cut are in U: twice as many of a set's elements as its prefix has, in the mean."""
    return min(2**63 - 1, int(2**64 * min(0.5, 2.0 * (den - num) / den)))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (int64) of each text."""
    data, offsets = flat(texts)
    data = LOWER[data]
    start, end, first = word_spans(data, offsets)
    words = range_hashes(data, start, end)
    n = len(words) - k + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for i in range(k):
        rolled = rolled * np.uint64(0x9FB21C651E98DF25) + words[i : i + n] if n > 0 else rolled
    rolled = mix64(rolled).view(np.int64)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            short = hashlib.blake2b(words[a:b].tobytes(), digest_size=8, person=b"short").digest()
            out.append(np.frombuffer(short, np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(k: int, cut: int):
    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n in runs(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(i, n), k)
                inside = [int(np.searchsorted(s, cut) - np.searchsorted(s, 0)) for s in sets]
                sig = np.frombuffer(b"".join(map(_signature, sets)), np.int64).reshape(-1, 2)
                made = [pa.array([len(s) for s in sets], pa.int64()), pa.array(inside, pa.int64()), pa.array(sig[:, 0].copy()), pa.array(sig[:, 1].copy())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), *made, batch.column(2).slice(i, n)], ["doc_id", "n", "inside", "s1", "s2", "t"])

    return sketch


def _elements(k: int, cut: int, num: int, den: int, hot: np.ndarray):
    """(h, salt, s1, s2): of each class its elements in U, or all where these are fewer than its prefix; once a partition.
    ``hot``: the elements, sorted, that get a salt."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for i, n in runs(batch.column(0)):
                parts, sigs, sizes = [np.zeros(0, np.int64)], [], []
                for s in shingle_sets(batch.column(0).slice(i, n), k):
                    if not len(s) or (sig := _signature(s)) in seen:
                        continue
                    seen.add(sig)
                    part = s[np.searchsorted(s, 0) : np.searchsorted(s, cut)]
                    part = s if len(part) < prefix_length(len(s), num, den) else part
                    parts.append(part)
                    sigs.append(sig)
                    sizes.append(len(part))
                both = np.repeat(np.frombuffer(b"".join(sigs), np.int64).reshape(-1, 2), sizes, axis=0)
                h = np.concatenate(parts)
                salt = np.where(_among(h, hot), both[:, 0] & (SALTS - 1), 0).astype(np.int16)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(salt), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["h", "salt", "s1", "s2"])

    return emit


def _among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(few):
        return np.zeros(len(values), bool)
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


def _shared(hot: np.ndarray):
    """Of rows (h, s1, s2) sorted by h and then so that equal ones are neighbours, the distinct ones whose h has more than
    one class, with the number of its classes.

    Numbers end at MOST, so that no more than MOST rows wait for the end of their h, however many it has. A hot h has that
    number at once, as a task sees only some of its classes.
    """

    def shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = h = None  # the last row seen; the unfinished h
        held: list[np.ndarray] = []  # its classes, until they are sent
        size, sent = 0, False

        def rows(hs: np.ndarray, sigs: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(hs), pa.array(sigs[:, 0].copy()), pa.array(sigs[:, 1].copy()), pa.array(df.astype(np.int32))], ["h", "s1", "s2", "df"])

        def grown(sigs: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, sent
            if not sent:
                held.append(sigs)
                size += len(sigs)
                if size < MOST:
                    return
                sigs, held, sent = np.concatenate(held), [], True
            yield rows(np.full(len(sigs), h), sigs, np.full(len(sigs), MOST))

        def ended() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, sent
            if not sent and size > 1:
                yield rows(np.full(size, h), np.concatenate(held), np.full(size, size))
            held, size, sent = [], 0, False

        for batch in batches:
            hs, sigs = batch.column(0).to_numpy(), np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], 1)
            if not len(hs):
                continue
            new = np.ones(len(hs), bool)
            new[1:] = (hs[1:] != hs[:-1]) | (sigs[1:] != sigs[:-1]).any(1)
            new[0] = (hs[0], *sigs[0].tolist()) != before
            before = (hs[-1], *sigs[-1].tolist())
            hs, sigs = hs[new], sigs[new]
            spread = _among(hs, hot)
            if spread.any():
                yield rows(hs[spread], sigs[spread], np.full(int(spread.sum()), MOST))
                hs, sigs = hs[~spread], sigs[~spread]
            if not len(hs):
                continue
            first = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
            if h is not None and hs[0] == h:
                yield from grown(sigs[: first[1] if len(first) > 1 else len(hs)])
                first = first[1:]
            if len(first):
                yield from ended()
                count = np.diff(first)
                inner = slice(first[0], first[-1])
                each = np.repeat(count, count)
                keep = each > 1
                if keep.any():
                    yield rows(hs[inner][keep], sigs[inner][keep], np.minimum(each[keep], MOST))
                h = hs[first[-1]]
                yield from grown(sigs[first[-1] :])
        yield from ended()

    return shared


class SignatureTree:
    """Sets with exact bitmaps, sorted by size; levels of nodes with OR-combined bitmaps and ranges of sizes."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, height: int = 1):
        self.order = np.argsort(sizes, kind="stable")
        self.sizes, self.bitmaps = sizes[self.order], bitmaps[self.order]
        self.levels = [self._group(self.bitmaps, self.sizes, self.sizes, LEAF)]
        while len(self.levels[-1][0]) > 1 or len(self.levels) < height:
            self.levels.append(self._group(*self.levels[-1], FAN))

    @staticmethod
    def _group(bitmaps: np.ndarray, low: np.ndarray, high: np.ndarray, width: int):
        at = np.arange(0, len(low), width)
        return np.bitwise_or.reduceat(bitmaps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)

    def _may(self, other: SignatureTree, level: int, x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
        """Whether a set below node x and one of the other tree's below y can reach the threshold."""
        (bits, low, high), (bits_, low_, high_) = self.levels[level], other.levels[level]
        overlap = np.minimum(np.minimum(high[x], high_[y]), np.bitwise_count(bits[x] & bits_[y]).sum(1, dtype=np.int64))
        return den * overlap >= num * (np.maximum(low[x], overlap) + np.maximum(low_[y], overlap) - overlap)

    def join(self, num: int, den: int, other: SignatureTree | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets (positions as given) that reach the threshold, of this tree or of this and another one of the
        same height; a few leaves at a time."""
        alone, other = other is None, other or self
        x = y = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            may = [self._may(other, level, x[i : i + 512], y[i : i + 512], num, den) for i in range(0, len(x), 512)]
            may = np.concatenate(may) if may else np.zeros(0, bool)
            x, y = x[may], y[may]
            if not level or not len(x):
                break
            cx = (x[:, None] * FAN + np.arange(FAN))[:, :, None] + np.zeros((1, 1, FAN), np.int64)
            cy = (y[:, None] * FAN + np.arange(FAN))[:, None, :] + np.zeros((1, FAN, 1), np.int64)
            ok = (cx < len(self.levels[level - 1][1])) & (cy < len(other.levels[level - 1][1]))
            if alone:
                ok &= cx <= cy
            x, y = cx[ok], cy[ok]
        for a, b in zip(x, y, strict=True):
            i, j = slice(a * LEAF, (a + 1) * LEAF), slice(b * LEAF, (b + 1) * LEAF)
            overlap = np.stack([np.bitwise_count(row & other.bitmaps[j]).sum(1, dtype=np.int64) for row in self.bitmaps[i]])
            hit = den * overlap >= num * (self.sizes[i][:, None] + other.sizes[j] - overlap)
            if alone and a == b:
                hit &= np.tri(*hit.shape, -1, dtype=bool).T
            p, q = np.nonzero(hit)
            yield self.order[a * LEAF + p], other.order[b * LEAF + q]


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 64-bit words for each set: a bit for each element that two sets have at least."""
    every = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    values, code, count = np.unique(every, return_inverse=True, return_counts=True)
    bit = np.cumsum(count > 1) - 1
    wide = max(1, -(-int((count > 1).sum()) // 64))
    out = np.zeros((len(sets), wide), np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = count[code] > 1
    at = bit[code[common]]
    np.bitwise_or.at(out, (row[common], at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return out


def _meet(num: int, den: int, all_links: bool):
    def meet(group: pa.Table) -> pa.Table:
        """The links within side 0, or between it and side 1 where there is one."""
        order = np.lexsort((group.column("side").to_numpy(), group.column("node").to_numpy()))
        node, side = group.column("node").to_numpy()[order], group.column("side").to_numpy()[order]
        once = np.concatenate([[True], (node[1:] != node[:-1]) | (side[1:] != side[:-1])])
        node, side = node[once], side[once]
        elements = group.column("elements")
        sets = [np.frombuffer(elements[int(i)].as_py(), np.int64) for i in order[once]]
        bits, sizes = bitmaps(sets), np.array([len(s) for s in sets], np.int64)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left):
            left, right = right, left
        x = SignatureTree(bits[left], sizes[left])
        if len(right):
            y = SignatureTree(bits[right], sizes[right], len(x.levels))
            x = SignatureTree(bits[left], sizes[left], len(y.levels))
            found = ((left[a], right[b]) for a, b in x.join(num, den, y))
        else:
            found = ((left[a], left[b]) for a, b in x.join(num, den))
        parent = np.arange(len(node))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        links: list[tuple[int, int]] = []
        degree = np.zeros(len(node), np.int64)
        for a, b in found:
            np.add.at(degree, a, 1)
            np.add.at(degree, b, 1)
            if all_links:
                links.extend((u, v) for u, v in zip(node[a], node[b], strict=True) if u != v)
                continue
            for i, j in zip(a, b, strict=True):
                if (p := root(i)) != (q := root(j)):
                    parent[max(p, q)] = min(p, q)
        if not all_links:
            links = [(node[i], node[r]) for i in range(len(node)) if (r := root(i)) != i]
        made = {"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64()), "degree": pa.array([0] * len(links), pa.int32())}
        if degree.any():  # and the set with the most links, as a row of its own
            hub = int(np.argmax(degree))
            made = {k: pa.concat_arrays([x, pa.array([y], x.type)]) for (k, x), y in zip(made.items(), (node[hub], node[hub], degree[hub]), strict=True)}
        return pa.table(made)

    return meet


def _load_sets(k: int):
    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for i, n in runs(batch.column(0)):
                nodes, sets = [], []
                own = shingle_sets(batch.column(0).slice(i, n), k)
                for s, node, s1, s2 in zip(own, *(batch.column(j).slice(i, n).to_pylist() for j in (1, 2, 3)), strict=True):
                    if node not in seen and np.frombuffer(_signature(s), np.int64).tolist() == [s1, s2]:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "elements"])

    return load


_LINKS = "u long, v long, degree int"


class NearDuplicates:
    """``sketch``: doc_id, n and the set's digest (s1, s2) of every row; ``classes``: the node of each digest; ``links``:
    (u, v) over nodes, all links or as many as tie each group."""

    def __init__(self, docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, all_links: bool = False):
        self.spark, self.k, self.num, self.den, self.all_links = docs.sparkSession, k, num, den, all_links
        self.stored: list[DataFrame] = []  # tables that only the links are made from
        cut = _cut(num, den)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t"))
        self.sketch = materialize(rows.mapInArrow(_sketch(k, cut), "doc_id long, n long, inside long, s1 long, s2 long, t long"), "sketch")
        one = F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "t"))
        classes = self.sketch.filter("n > 0").groupBy("s1", "s2").agg(one.alias("at"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("docs"), F.first("n").alias("n"), F.first("inside").alias("inside"))
        self.classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        def elements(texts: DataFrame, hot: np.ndarray) -> DataFrame:
            return texts.select("text").mapInArrow(_elements(k, cut, num, den, hot), "h long, salt short, s1 long, s2 long")

        often = elements(rows.filter(F.pmod("t", F.lit(SAMPLE)) == 0), np.zeros(0, np.int64)).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OFTEN)
        hot = np.sort(np.array([r["h"] for r in often.orderBy(F.col("n").desc(), "h").limit(HOT).collect()], np.int64))
        dealt = elements(rows, hot).repartition(4 * partitions(self.spark), "h", "salt").sortWithinPartitions("h", "salt", "s1", "s2")
        shared = dealt.select("h", "s1", "s2").mapInArrow(_shared(hot), "h long, s1 long, s2 long, df int")
        own = shared.groupBy("s1", "s2").agg(F.transform(F.array_sort(F.collect_set(F.struct("df", "h"))), lambda x: x["h"]).alias("all"))  # rarest first
        own = own.withColumn("common", F.filter("all", lambda h: (h >= 0) & (h < cut)))
        prefix = F.col("n") - F.expr(f"(n * {num} + {den - 1}) div {den}") + 1
        spare = F.greatest(F.lit(0), prefix - (F.col("inside") - F.size("common")))
        picked = own.join(self.classes, ["s1", "s2"]).withColumn("prefix", F.concat(F.slice("common", 1, spare.cast("int")), F.filter("all", lambda h: (h < 0) | (h >= cut))))
        held = self._store(picked.filter("size(prefix) > 0").select("node", "n", "at", "s1", "s2", "prefix"), "prefixes")
        near = self._runs(held)
        family = self._store(components(near.select(F.col("node").alias("u"), F.col("tie").alias("v"))).withColumnRenamed("root", "family"), "families")
        sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("classes"))
        family = self._store(skew_join(family, sizes, ["family"], F.col("classes") > max(1024, family.count() // HOT)), "families")
        # Linked sets' sizes are in one bin or in adjacent ones; a family that is one group needs no bins.
        bin_ = F.floor(F.log("n") / math.log(den / num * 1.0001)).cast("int") if num < den else F.col("n").cast("int")
        members = held.join(family, "node").withColumn("bin", F.when(F.col("classes") <= BLOCK, 0).otherwise(bin_))
        members = self._store(members, "members")
        self.sets = self._load(rows, members)
        large = members.filter(F.col("classes") > BLOCK)
        easy, found = (None, None) if all_links or large.isEmpty() else self._rounds(large)
        groups = members.filter(F.col("classes") <= BLOCK * WIDE).select(F.col("family").alias("g1"), F.lit(-1).alias("g2"), "node", "bin")
        wide = members.filter(F.col("classes") > BLOCK * WIDE)
        part = F.lit(-1).cast("long")
        if found is not None:
            part = F.coalesce("root", "node")
        else:
            found = self.spark.createDataFrame([], "node long, root long, size long")
        if not wide.isEmpty():
            by_element = near.join(wide.select("node", "bin"), "node").join(found, "node", "left").withColumn("part", part)
            held_by = by_element.groupBy("h", "run").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("c"))
            open_ = held_by.filter("c > 1") if all_links else held_by.filter("low <> high")
            by_element = skew_join(by_element.select("h", "run", "node", "bin"), open_, ["h", "run"], F.col("c") > max(1024, near.count() // HOT))
            groups = groups.unionByName(by_element.select(F.col("h").alias("g1"), F.col("run").cast("int").alias("g2"), "node", "bin"))
        # A large component's classes have blocks of their own, which needn't meet.
        pure = F.when(F.col("size") >= PURE, F.col("root")).otherwise(F.lit(-1).cast("long"))
        groups = self._store(groups.join(found, "node", "left").withColumn("part", F.coalesce(pure, F.lit(-1).cast("long"))).select("g1", "g2", "node", "bin", "part"), "groups")
        links = self._linked(self._meetings(groups))
        links = (links if easy is None else links.unionByName(easy)).filter("u <> v").select("u", "v")
        self.links = materialize(links.distinct() if all_links else links, "links")
        for stored in self.stored:
            discard(stored)

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        self.stored.append(materialize(df, name))
        return self.stored[-1]

    def _runs(self, held: DataFrame) -> DataFrame:
        """``node, n, h, run, tie`` for each element of a prefix. Linked sets' sizes are within the threshold's ratio, and
        so are those of neighbours by size between them: among the sets with an element, all that can link by it are in
        one run of such neighbours; tie is the run's least node. Only distinct sizes are put in order."""
        near = self._store(held.select("node", "n", F.explode("prefix").alias("h")), "near")
        sizes = near.groupBy("h", "n").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("c"))
        by_size = Window.partitionBy("h").orderBy("n")
        sizes = sizes.withColumn("_m", F.lag("n").over(by_size))
        sizes = sizes.withColumn("run", F.sum(F.when(F.col("_m") * self.den >= F.col("n") * self.num, 0).otherwise(1)).over(by_size))
        sizes = sizes.withColumn("tie", F.min("least").over(Window.partitionBy("h", "run"))).select("h", "n", "run", "tie", "c")
        return self._store(skew_join(near, sizes, ["h", "n"], F.col("c") > max(1024, near.count() // HOT)).select("node", "n", "h", "run", "tie"), "near")

    def _load(self, rows: DataFrame, members: DataFrame) -> DataFrame:
        """``node, elements`` of every class with a family, from the text of one of its rows."""
        wanted = members.select(F.col("at.doc").alias("_doc"), F.col("at.t").alias("_t"), "node", "s1", "s2")
        texts = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
        texts = texts.join(wanted.hint("shuffle_hash"), (F.col("doc") == F.col("_doc")) & (F.col("t") == F.col("_t"))).select("text", "node", "s1", "s2")
        return self._store(texts.mapInArrow(_load_sets(self.k), "node long, elements binary"), "sets")

    def _rounds(self, large: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links that make few components of what is close, and ``node, root, size`` of these; rounds end when they no
        longer find much."""
        large = self._store(large.select("family", "bin", "node", "prefix"), "large")
        links, loose, hubs, left, salt = None, large, None, large.count(), 0
        while True:
            salt += 1
            found = self._store(self._linked(self._easy(loose, large, hubs, salt)), "links")
            links = found if links is None else self._store(links.unionByName(found), "links")
            roots = components(links.select("u", "v"))
            size = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
            roots = self._store(skew_join(roots, size, ["root"], F.col("size") > max(1024, left // HOT)).select("node", "root", "size"), "parts")
            loose = self._store(large.join(roots.filter(F.col("size") >= PURE).select("node"), "node", "left_anti"), "loose")
            hubs, before, left = found.filter("degree > 0").select(F.col("u").alias("node"), "degree"), left, loose.count()
            if left > 0.7 * before or left <= BLOCK:
                return links, roots

    def _easy(self, loose: DataFrame, large: DataFrame, hubs: DataFrame | None, salt: int) -> DataFrame:
        """``meeting, node, side`` of groups of classes with close prefixes, and the pivots of theirs and the next sizes."""
        slot = F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(PIVOTS)).alias("slot")
        if hubs is None:
            pivots = large.groupBy("family", "bin", slot).agg(F.min("node").alias("node"))
        else:
            most = hubs.groupBy("node").agg(F.max("degree").alias("degree")).join(large.select("family", "bin", "node"), "node")
            pivots = most.groupBy("family", "bin", slot).agg(F.max_by("node", F.struct("degree", "node")).alias("node"))
        loose = loose.select("family", "bin", "node", F.array_min(F.transform("prefix", lambda h: F.xxhash64(h, F.lit(salt)))).alias("least"))
        binned = loose.groupBy("family", "bin").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("k"))
        loose = loose.join(binned, ["family", "bin"]).withColumn("bucket", F.pmod("least", "k"))
        full = loose.groupBy("family", "bin", "bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("k2"))
        loose = loose.join(full, ["family", "bin", "bucket"]).withColumn("sub", F.pmod(F.xxhash64("node"), "k2"))
        listed = full.select("family", "bin", "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k2") - 1)).alias("sub"))
        listed = self._store(listed.withColumn("meeting", F.monotonically_increasing_id()), "easy")
        near_by = listed.withColumn("bin", F.explode(F.array(F.col("bin") - 1, "bin", F.col("bin") + 1)))
        rows = loose.join(listed, ["family", "bin", "bucket", "sub"]).select("meeting", "node")
        return rows.unionByName(near_by.join(pivots, ["family", "bin"]).select("meeting", "node")).withColumn("side", F.lit(0))

    def _meetings(self, groups: DataFrame) -> DataFrame:
        """``meeting, node, side``: every block meets itself and the others of its bin and of the next, but blocks of one
        large component don't meet."""
        keys = ["g1", "g2", "bin", "part"]
        counted = self._store(groups.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("k"), F.count(F.lit(1)).alias("c")), "blocks")
        hot = F.col("c") > max(1024, groups.count() // HOT)
        placed = skew_join(groups, counted, keys, hot).withColumn("no", F.pmod(F.xxhash64("node"), "k"))
        listed = counted.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("no"))
        a = listed.select("g1", "g2", "bin", F.struct("part", "no").alias("a"), F.explode(F.array("bin", F.col("bin") + 1)).alias("other"))
        b = listed.select("g1", "g2", F.col("bin").alias("other"), F.struct("part", "no").alias("b"))
        pairs = a.join(b, ["g1", "g2", "other"]).filter((F.col("bin") < F.col("other")) | (F.col("a") <= F.col("b"))).filter("a.part <> b.part OR a.part = -1")
        pairs = self._store(pairs.withColumn("meeting", F.monotonically_increasing_id()), "meetings")
        first = pairs.select("g1", "g2", "bin", "a.part", "a.no", "meeting", F.lit(0).alias("side"))
        second = pairs.filter("bin < other OR a <> b").select("g1", "g2", F.col("other").alias("bin"), "b.part", "b.no", "meeting", F.lit(1).alias("side"))
        return placed.join(first.unionByName(second), [*keys, "no"]).select("meeting", "node", "side")

    def _linked(self, dealt: DataFrame) -> DataFrame:
        meet = _meet(self.num, self.den, self.all_links)
        return dealt.join(self.sets, "node").groupBy("meeting").applyInArrow(lambda group: meet(group), _LINKS)

    def documents(self, texts: bool = False) -> DataFrame:
        """``doc_id, n_shingles, component_id`` of every row; with ``texts`` also ``t``, the 64-bit hash of its text."""
        roots = components(self.links)
        placed = self.classes.join(roots, "node", "left").select("s1", "s2", "docs", F.coalesce("root", "node").alias("root"), "least")
        named = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("c"))
        by_class = skew_join(placed, named, ["root"], F.col("c") > max(1024, self.classes.count() // HOT)).select("s1", "s2", "docs", "component_id")
        linked = skew_join(self.sketch.filter("n > 0"), by_class, ["s1", "s2"], F.col("docs") > max(1024, self.sketch.count() // HOT))
        rows = linked.select("doc_id", "n", "component_id", "t").unionByName(self.sketch.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), "t"))
        return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", *(["t"] if texts else []))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    return NearDuplicates(docs, k, num, den).documents()
