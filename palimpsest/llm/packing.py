"""Pack tokenized documents into fixed windows, each filled with lexically close documents.

A document's full windows stand alone. What remains of the documents (under one window each) is packed in shards of about
SHARD_TOKENS tokens. Shards group what is lexically close, whatever files or partitions it comes from: remainders are
range-sorted by the leaf of a tree over their BM25 vectors, then by a min-hash, and a shard is a run of that order. In a
shard a seed takes its window, its best unused neighbours follow in order of BM25 over all of its terms, and the last is
cut where the window ends; its rest stays for later. So only the last sequence of a shard needs padding. Document
frequencies and the mean length are those of all remainders. What a shard can't see are neighbours in other shards.

Edge cases: null and empty texts are documents of the closing id alone; a text of any length is tokenized whole; rows
that repeat are documents of their own; an empty table gives an empty result; a null doc_id stays null; only the columns
named below are made.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64

WINDOW = 1024
SHARD_TOKENS = 2_000_000
K1, B = 1.2, 0.75
CHUNK_BYTES = 8 << 20
#: The tree that groups remainders is fitted on about so many of them (twice at most), splits vectors of so many hashed terms, and so deep.
#: It only chooses which documents share a shard: all are placed by it and packed.
TREE_SAMPLE, TREE_DIM, TREE_DEPTH = 4096, 1024, 9


class ByteTokenizer:
    """A byte-level BPE tokenizer that encodes each distinct word of a batch once.

    ``path`` is the tokenizers file that defines the ids, ``ranks`` the same vocabulary as ranks. Texts whose single
    blanks all stand between two characters that are no white space are cut there: no token spans such a place. All
    other texts, and those that hold a special token's string, are encoded whole from ``path``.
    """

    #: Fixed value: the byte-level vocabulary's rule for cutting a text before merging.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    #: Words that are empty or have white space (or a control character) at an end.
    EDGE = r"^$|^[\x00-\x20\x7f-\xa0\p{Z}]|[\x00-\x20\x7f-\xa0\p{Z}]$"

    def __init__(self, path: str, ranks: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.words = tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=table, special_tokens={})
        self.size = self.whole.get_vocab_size()
        self.bytes = np.zeros(self.size + 1, np.int64)
        self.bytes[list(table.values())] = [len(x) for x in table]
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def _first(self, text: str) -> np.ndarray:
        return np.array(self.words.encode_ordinary(text), np.int32)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        odd = np.asarray(pc.equal(texts, ""))
        for s in self.special:
            odd = odd | np.asarray(pc.match_substring(texts, s))
        parts = pc.split_pattern(texts, " ")
        at = np.asarray(parts.offsets)
        values = parts.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at = at - at[0]
        word, names = np.asarray(values.indices), values.dictionary
        bad = np.asarray(pc.match_substring_regex(names, self.EDGE))
        odd = odd | np.logical_or.reduceat(bad[word], at[:-1])
        inner = np.ones(len(word), bool)
        inner[at[:-1]] = False  # a text's first word has no blank before it
        inner &= ~np.repeat(odd, np.diff(at))
        used = np.unique(word[inner])
        held = names.take(pa.array(used)).cast(pa.string())
        sizes = np.asarray(pc.binary_length(held)).astype(np.int64) + 1
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), " ")[0].as_py() if len(used) else ""
        ids = np.asarray(self.words.encode_to_numpy(" " + joined, disallowed_special=())).astype(np.int32) if len(used) else np.zeros(0, np.int32)
        end = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(sizes), side="right")
        where = np.zeros(len(names), np.int64)
        where[used] = np.arange(len(used))
        first = at[:-1][~odd]
        distinct, own = np.unique(word[first], return_inverse=True)
        heads = [self._first(x) for x in names.take(pa.array(distinct)).to_pylist()]
        # All tokens in one pool; each word has a place and a count there.
        pool = np.concatenate([ids, *heads])
        ends = np.concatenate([end, len(ids) + np.cumsum([len(x) for x in heads], dtype=np.int64)])
        begins = np.concatenate([[0], ends[:-1]])
        slot = np.full(len(word), -1)
        slot[inner], slot[first] = where[word[inner]], len(used) + own
        count = np.where(slot >= 0, ends[slot] - begins[slot], 0) if len(ends) else np.zeros(len(word), np.int64)
        upto = np.concatenate([[0], np.cumsum(count)])
        tokens = pool[np.arange(upto[-1]) + np.repeat(begins[slot] - upto[:-1], count)] if len(ends) else pool
        out = np.split(tokens, upto[at[1:-1]])
        for i in np.flatnonzero(odd):
            text = texts[int(i)].as_py()
            out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int32) if text else np.zeros(0, np.int32)
        return out


@dataclass(frozen=True)
class Statistics:
    """Items, mean length and, by term, the number of items that hold it."""

    n: int
    mean: float
    df: np.ndarray


def _cells(items: list[np.ndarray], vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each item's distinct terms: item, term and occurrences, by item."""
    length = [len(x) for x in items]
    flat = np.concatenate(items).astype(np.int64) if items else np.zeros(0, np.int64)
    cells, tf = np.unique(np.repeat(np.arange(len(items)), length) * vocabulary + flat, return_counts=True)
    return cells // vocabulary, cells % vocabulary, tf


def _weights(items: list[np.ndarray], item: np.ndarray, token: np.ndarray, tf: np.ndarray, stats: Statistics) -> np.ndarray:
    idf = np.log1p((stats.n - stats.df + 0.5) / (stats.df + 0.5))
    norm = K1 * (1 - B + B * np.array([len(x) for x in items]) / max(1.0, stats.mean))
    return idf[token] * tf * (K1 + 1) / (tf + norm[item])


class Bm25:
    """An inverted index over items of token ids: postings with BM25 weights. ``stats`` are those of the items if not
    given."""

    def __init__(self, items: list[np.ndarray], vocabulary: int, stats: Statistics | None = None):
        item, token, tf = _cells(items, vocabulary)
        df = np.bincount(token, minlength=vocabulary)
        stats = stats or Statistics(len(items), float(np.mean([len(x) for x in items])) if items else 0.0, df)
        weight = _weights(items, item, token, tf, stats)
        self.terms = np.split(token, np.searchsorted(item, np.arange(1, len(items)))) if items else []
        order = np.argsort(token, kind="stable")
        self.n, self.vocabulary, self.token = len(items), vocabulary, token[order]
        self.items, self.weights = item[order], weight[order]
        self.start = np.concatenate([[0], np.cumsum(df)])

    def drop(self, free: np.ndarray) -> None:
        """Forget the postings of items that aren't free any more."""
        left = free[self.items]
        self.items, self.weights, self.token = self.items[left], self.weights[left], self.token[left]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(self.token, minlength=self.vocabulary))])

    def scores(self, item: int) -> np.ndarray:
        """Every item's score for all terms of ``item``."""
        spans = [slice(a, b) for a, b in zip(self.start[self.terms[item]].tolist(), self.start[self.terms[item] + 1].tolist(), strict=True) if a < b]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.items[s] for s in spans]), np.concatenate([self.weights[s] for s in spans]), self.n)


def vectors(items: list[np.ndarray], vocabulary: int, stats: Statistics, cells: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
    """The items' BM25 weights by hashed term, each of length 1."""
    item, token, tf = cells or _cells(items, vocabulary)
    slot = (mix64(np.arange(vocabulary)) % np.uint64(TREE_DIM)).astype(np.int64)
    out = np.bincount(item * TREE_DIM + slot[token], _weights(items, item, token, tf, stats), len(items) * TREE_DIM)
    out = out.reshape(len(items), TREE_DIM).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class Tree:
    """Halves a sample of vectors along its principal direction, and each half again."""

    def __init__(self, sample: np.ndarray, depth: int = TREE_DEPTH, first: int = 0):
        self.first, self.leaves, self.direction = first, 1, None
        if depth == 0 or len(sample) < 16:
            return
        centred = sample - sample.mean(0)
        direction = centred[np.argmax((centred**2).sum(1))]
        for _ in range(12):
            direction = centred.T @ (centred @ direction)
            direction /= max(1e-12, float(np.linalg.norm(direction)))
        along = sample @ direction
        cut = float(np.median(along))
        low = along <= cut
        if low.all() or not low.any():
            return
        self.direction, self.cut = direction, cut
        self.below = Tree(sample[low], depth - 1, first)
        self.above = Tree(sample[~low], depth - 1, first + self.below.leaves)
        self.leaves = self.below.leaves + self.above.leaves

    def place(self, rows: np.ndarray) -> np.ndarray:
        """Each vector's leaf; the order of leaves is that of the tree."""
        if self.direction is None or not len(rows):
            return np.full(len(rows), self.first, np.int32)
        out, low = np.empty(len(rows), np.int32), np.einsum("ij,j->i", rows, self.direction) <= self.cut  # one thread
        out[low], out[~low] = self.below.place(rows[low]), self.above.place(rows[~low])
        return out


def _best(score: np.ndarray, most: int) -> np.ndarray:
    """The places of the ``most`` highest scores or of all, highest first, ties in order."""
    top = np.argpartition(-score, most - 1)[:most] if len(score) > 2 * most else np.arange(len(score))
    return top[np.lexsort((top, -score[top]))]


def pack_shard(docs: list[np.ndarray], vocabulary: int, window: int = WINDOW, stats: Statistics | None = None) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length); every id of every document is in exactly one."""
    sequences, items, left, start = [], [], [], []
    for d, ids in enumerate(docs):
        full = len(ids) // window * window
        sequences.extend([(d, s, window)] for s in range(0, full, window))
        if full < len(ids):
            items.append(d)
            start.append(full)
            left.append(len(ids) - full)
    index = Bm25([docs[d][s:] for d, s in zip(items, start, strict=True)], vocabulary, stats)
    free, next_seed, indexed = np.ones(len(items), bool), 0, len(items)
    while next_seed < len(items):
        if not free[next_seed]:
            next_seed += 1
            continue
        seed, space, pieces = next_seed, window, []

        def place(i: int) -> None:
            nonlocal space
            size = min(space, left[i])
            pieces.append((items[i], start[i], size))
            start[i], left[i], space = start[i] + size, left[i] - size, space - size
            free[i] = left[i] > 0

        place(seed)
        if space:
            if 10 * np.count_nonzero(free) < 9 * indexed:
                index.drop(free)
                indexed = np.count_nonzero(free)
            score = index.scores(seed)
            score[~free] = -1
            for most in (16, window):  # every item has an id at least, so the ``window`` best fill what there is to fill
                for i in _best(score, most):
                    if not space or score[i] < 0:
                        break
                    if free[i]:
                        place(int(i))
                if not space:
                    break
        sequences.append(pieces)
    return sequences


def _tokens(path: str, ranks: str, end_id: int, window: int, ids_out: bool, stats: Statistics | None = None, tree: Tree | None = None):
    """Each document's row; with a tree, also its place, and a last row (-1) with the counts that Statistics adds up."""

    def tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteTokenizer(path, ranks)
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 40
        counts = np.zeros(tokenizer.size + 2, np.int64)
        hashed = mix64(np.arange(tokenizer.size)).view(np.int64)
        for batch in batches:
            texts = batch.column(1)
            step = max(1, min(len(texts), int(len(texts) * CHUNK_BYTES / max(1, texts.nbytes))))
            for i in range(0, len(texts), step):
                docs = [np.append(ids, end_id).astype("<u4") for ids in tokenizer.encode(texts.slice(i, step))]
                full = [len(ids) // window * window for ids in docs]
                crcs = [np.array([zlib.crc32(ids[s : s + window].tobytes()) for s in range(0, n, window)], "<u4").tobytes() for ids, n in zip(docs, full, strict=True)]
                items = [ids[n:] for ids, n in zip(docs, full, strict=True)]
                rest = [ids.astype(_kind(tokenizer.size)).tobytes() for ids in items]
                columns = {"doc_id": batch.column(0).slice(i, step), "row": pa.array(np.arange(number, number + len(docs)))}
                columns |= {"doc_tokens": pa.array([len(ids) for ids in docs], pa.int64()), "crcs": pa.array(crcs, pa.binary()), "rest": pa.array(rest, pa.binary())}
                if ids_out:
                    columns["head"] = pa.array([ids[:n].tobytes() for ids, n in zip(docs, full, strict=True)], pa.binary())
                if tree:
                    parts = [items[j : j + 1024] for j in range(0, len(items), 1024)]
                    cells = [_cells(x, tokenizer.size) for x in parts]
                    columns["leaf"] = pa.array(np.concatenate([tree.place(vectors(x, tokenizer.size, stats, c)) for x, c in zip(parts, cells, strict=True)]))
                    columns["near"] = pa.array([int(hashed[x].min()) if len(x) else 0 for x in items], pa.int64())
                    for _, token, _ in cells:
                        counts[:-2] += np.bincount(token, minlength=tokenizer.size)
                    counts[-2:] += sum(len(x) > 0 for x in items), sum(map(len, items))
                number += len(docs)
                yield pa.RecordBatch.from_pydict(columns)
        if tree:
            last = {"doc_id": pa.nulls(1, pa.int64()), "row": pa.array([-1]), "doc_tokens": pa.array([0]), "crcs": pa.array([counts.tobytes()], pa.binary()), "rest": pa.array([b""], pa.binary())}
            last |= {"head": pa.array([b""], pa.binary())} if ids_out else {}
            yield pa.RecordBatch.from_pydict(last | {"leaf": pa.array([0], pa.int32()), "near": pa.array([0])})

    return tokens


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _items(column: pa.Array, vocabulary: int) -> list[np.ndarray]:
    return [np.frombuffer(x, _kind(vocabulary)).astype(np.int32) for x in column.to_pylist()]


def _sum_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column(0).to_pylist():
            own = np.frombuffer(x, np.int64)
            total = own if total is None else total + own
    if total is not None:
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"token": pa.array(held), "n": pa.array(total[held])})


def statistics(tokens: DataFrame, vocabulary: int) -> Statistics:
    """Those of all remainders."""
    counts = tokens.filter("row = -1").select("crcs").mapInArrow(_sum_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(vocabulary + 2, np.int64)
    total[counts.column("token").to_numpy()] = counts.column("n").to_numpy()
    return Statistics(int(total[-2]), int(total[-1]) / max(1, int(total[-2])), total[:-2])


def _pack(vocabulary: int, stats: Statistics, window: int, shard_tokens: int, ids_out: bool):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 40
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        out: list[tuple] = []
        pieces: list[np.ndarray] = []
        docs: list[tuple] = []  # doc_id, doc_tokens, remainder
        size = 0

        def made() -> pa.RecordBatch:
            columns = {k: pa.array(v, pa.int64()) for k, v in zip(names, zip(*out, strict=True), strict=True)}
            if ids_out:
                columns["ids"] = pa.array(pieces, pa.list_(pa.int32()))
            out.clear()
            pieces.clear()
            return pa.RecordBatch.from_pydict(columns)

        def flush() -> None:
            nonlocal number, size
            for sequence in pack_shard([ids for _, _, ids in docs], vocabulary, window, stats):
                offset = 0
                for d, start, length in sequence:
                    name, total, rest = docs[d]
                    ids = rest[start : start + length].astype("<u4")
                    out.append((name, total - len(rest) + start, length, zlib.crc32(ids.tobytes()), total, number, offset))
                    if ids_out:
                        pieces.append(ids.astype(np.int32))
                    offset += length
                number += 1
            docs.clear()
            size = 0

        for batch in batches:
            heads = batch.column(batch.schema.get_field_index("head")).to_pylist() if ids_out else [b""] * batch.num_rows
            rest = _items(batch.column(batch.schema.get_field_index("rest")), vocabulary)
            plain = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "doc_tokens", "crcs")]
            for name, total, crcs, ids, head in zip(*plain, rest, heads, strict=True):
                for i, crc in enumerate(np.frombuffer(crcs, "<u4").tolist()):
                    out.append((name, i * window, window, crc, total, number, 0))
                    if ids_out:
                        pieces.append(np.frombuffer(head, "<u4", window, 4 * i * window).astype(np.int32))
                    number += 1
                if len(ids):
                    docs.append((name, total, ids))
                    size += len(ids)
                if size >= shard_tokens:
                    flush()
            if len(out) >= 1 << 14:
                yield made()
        flush()
        if out:
            yield made()

    return pack


def pack(docs: DataFrame, path: str, ranks: str, end_id: int = 0, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, ids_out: bool = False) -> DataFrame:
    """A row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``)."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab_size()
    docs = docs.select(docs["doc_id"].cast("long"), "text")
    schema = "doc_id long, row long, doc_tokens long, crcs binary, rest binary" + ", head binary" * ids_out
    share = min(1 << 30, (TREE_SAMPLE << 30) // max(1, docs.count()))
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share).limit(2 * TREE_SAMPLE).mapInArrow(_tokens(path, ranks, end_id, window, False), schema.removesuffix(", head binary"))
    items = [x for x in _items(some.select("rest").toArrow().column("rest"), vocabulary) if len(x)]
    rough = Statistics(len(items), float(np.mean([len(x) for x in items])) if items else 0.0, np.bincount(_cells(items, vocabulary)[1], minlength=vocabulary))
    tree = Tree(vectors(items, vocabulary, rough))
    tokens = materialize(docs.mapInArrow(_tokens(path, ranks, end_id, window, ids_out, rough, tree), f"{schema}, leaf int, near long"), "tokens")
    stats = statistics(tokens, vocabulary)
    order = ("leaf", "near", "row")
    shards = max(1, -(-int(1.25 * stats.n * stats.mean) // shard_tokens))  # so that uneven ranges seldom take two
    grouped = tokens.filter("row >= 0").repartitionByRange(shards, *order).sortWithinPartitions(*order)
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * ids_out
    return grouped.mapInArrow(_pack(vocabulary, stats, window, shard_tokens, ids_out), out)
