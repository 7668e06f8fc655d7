"""The methods themselves against brute force, round trips and held-out accuracy."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.llm import common, digest, line_dedup, near_dup, packing, substrings, topk, toxicity, warc
from palimpsest.llm.components import components
from palimpsest.llm.queries import QUERIES, tokenizer_files


def test_word_spans():
    texts = pa.array(["ab c", "", " d\x0be ", None, "f"])
    data, offsets = common.flat(texts)
    start, end, first = common.word_spans(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(start, end, strict=True)] == [b"ab", b"c", b"d", b"e", b"f"]
    assert first.tolist() == [0, 2, 2, 4, 4, 5]


@given(st.lists(st.binary(max_size=12), min_size=1, max_size=30))
def test_range_hashes(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    h = common.range_hashes(data, ends - [len(p) for p in parts], ends)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            assert (h[i] == h[j]) == (a == b)


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
@settings(deadline=None)
def test_minimal_perfect_hash(keys):
    keys = np.array(sorted(keys), np.uint64)
    mph = line_dedup.MinimalPerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))


def test_hot_lines(spark, monkeypatch):
    """Lines above the hot bound go another way and give the same."""
    line = "a line that a third of all documents share, long enough to count"
    rows = [(i, f"{line if i % 3 == 0 else 'own ' * 3}\n{'another line that is shared by some of the documents' if i % 7 == 0 else i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {tuple(r) for r in line_dedup.dedup_lines(docs, text_out=False).collect()}
    monkeypatch.setattr(line_dedup, "HOT_LINES", 1)
    assert {tuple(r) for r in line_dedup.dedup_lines(docs, text_out=False).collect()} == plain
    assert sum(r[2] for r in plain) == 66 + 28


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("hot", [[], [2, 5, 11]])
def test_shared_elements(seed, hot, monkeypatch):
    """Streaming over batches of any size finds the elements that two classes have, and how many have them."""
    monkeypatch.setattr(near_dup, "MOST", 3 if seed % 2 else 100)
    rng = random.Random(seed)
    rows = sorted((rng.randrange(12), x // 3, x) for _ in range(120) for x in [rng.randrange(5 + seed)])
    have = defaultdict(set)
    for h, s, t in rows:
        have[h].add((s, t))
    want = sorted((h, *s, near_dup.MOST if h in hot else min(len(v), near_dup.MOST)) for h, v in have.items() if len(v) > 1 or h in hot for s in v)

    def batches():
        i = 0
        while i < len(rows):
            n = rng.randrange(0, 6 + 10 * (seed % 3))
            part = rows[i : i + n]
            i += n
            yield pa.RecordBatch.from_arrays([pa.array([p[j] for p in part], pa.int64()) for j in range(3)], ["h", "s1", "s2"])

    got = [tuple(x.values()) for b in near_dup._shared(np.array(hot, np.int64))(batches()) for x in b.to_pylist()]
    assert sorted(got) == want


@pytest.mark.parametrize(("num", "den"), [(8, 10), (90, 100), (1, 2)])
def test_signature_tree(num, den):
    rng = random.Random(1)
    sets = []
    for _ in range(60):
        base = {rng.randrange(10_000) for _ in range(rng.randrange(1, 60))}
        for _ in range(rng.randrange(1, 6)):
            sets.append(np.array(sorted(base | {rng.randrange(10_000) for _ in range(rng.randrange(0, 6))}), np.int64))
    bits, sizes = near_dup.bitmaps(sets), np.array([len(s) for s in sets])
    tree = near_dup.SignatureTree(bits, sizes)
    got = {tuple(sorted((int(a), int(b)))) for x, y in tree.join(num, den) for a, b in zip(x, y, strict=True)}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if den * len(set(sets[i]) & set(sets[j])) >= num * len(set(sets[i]) | set(sets[j]))}
    assert got == want
    few = len(sets) // 5  # two trees, one of them small
    left = near_dup.SignatureTree(bits[:few], sizes[:few], len(tree.levels))
    right = near_dup.SignatureTree(bits[few:], sizes[few:], len(tree.levels))
    got = {(int(a), int(b) + few) for x, y in left.join(num, den, right) for a, b in zip(x, y, strict=True)}
    assert got == {(i, j) for i, j in want if i < few <= j}


def _components(sets, num, den):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}


@pytest.mark.parametrize(("k", "num", "den", "block", "wide"), [(3, 90, 100, 256, 16), (5, 8, 10, 8, 16), (3, 90, 100, 4, 16), (5, 8, 10, 2, 1), (2, 1, 2, 3, 1)])
def test_near_duplicates(spark, monkeypatch, k, num, den, block, wide):
    """Also where families take many blocks, and where they are met by element."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "WIDE", wide)
    monkeypatch.setattr(near_dup, "PURE", 2)
    monkeypatch.setattr(near_dup, "SAMPLE", 1 if block < 8 else 64)
    monkeypatch.setattr(near_dup, "OFTEN", 3)
    rng = random.Random(k)
    texts = {}
    for _ in range(25):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(300)}"
            if rng.random() < 0.3:
                copy += ["the", "shared", "passage", "of", "many"] * 2
            texts[len(texts)] = " ".join(copy)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    sets = {}
    for d, t in texts.items():
        w = t.split()
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    want = _components(sets, num, den)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(rows, k, num, den).collect()}
    assert got == {d: (len(sets[d]), want[d]) for d in texts}
    every = {tuple(sorted(r)) for r in near_dup.NearDuplicates(rows, k, num, den, all_links=True).links.collect()}
    distinct = {frozenset(s) for s in sets.values() if s}
    assert len(every) == sum(1 for a in distinct for b in distinct if a != b and den * len(a & b) >= num * len(a | b)) // 2


def _thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


def test_words_of_two_letters(spark):
    """Words that a polynomial modulo a power of two can't tell apart."""
    x, y = _thue_morse(2048), _thue_morse(2048, "ba")
    rows = [(1, x), (2, y), (3, f"{x} p q"), (4, f"{y} p q")]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert all(r.component_id == r.doc_id for r in out)
    out = substrings.remove_repeats(spark.createDataFrame([(1, x), (2, y)], "doc_id long, text string"), length=1500).collect()
    assert [r.n_removed for r in out] == [0, 0]


@pytest.mark.parametrize("near", [True, False])
def test_large_families_copy_little(spark, monkeypatch, near):
    """Sets of one large family are copied a bounded number of times, whether they link or only share a passage."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join([f"u{i}", *passage] if near else [*(f"w{rng.randrange(10**6)}" for _ in range(40)), *passage[:20]]) for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dealt = []
    linked = near_dup.NearDuplicates._linked
    monkeypatch.setattr(near_dup.NearDuplicates, "_linked", lambda self, rows: (dealt.append(rows.count()), linked(self, rows))[1])
    out = near_dup.near_duplicates(docs, 3, 90, 100)
    assert out.select("component_id").distinct().count() == (1 if near else 3000)
    assert sum(dealt) < 10 * 3000


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(30)] + [(500, i) for i in range(300, 340)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def _removed(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cut = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cut[i : i + length] = b"\1" * length
        out.append(bytes(b for b, x in zip(t, cut, strict=True) if not x))
    return out


@pytest.mark.parametrize(("shard", "batch"), [(2048, 128), (2, 2)])
def test_substrings(spark, monkeypatch, shard, batch):
    """Also where an anchor's segments need many shards and batches."""
    monkeypatch.setattr(substrings, "SHARD_SEGMENTS", shard)
    monkeypatch.setattr(substrings, "BATCH_SEGMENTS", batch)
    rng = random.Random(5)
    piece = lambda n: "".join(rng.choice("abcd e") for _ in range(n))
    shared = [piece(n) for n in (60, 150, 199, 200, 201, 260, 500, 900)]
    texts = ["".join(rng.choice([piece(rng.randrange(150)), rng.choice(shared), rng.choice(shared)[rng.randrange(50) :]]) for _ in range(rng.randrange(5))) for _ in range(60)]
    texts += ["z" * 350, "z" * 199, "é" * 400, "\0" * 300, piece(205) * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: bytes(r.kept) for r in substrings.remove_repeats(docs).collect()}
    assert got == dict(enumerate(_removed([t.encode() for t in texts], 200)))


@given(st.lists(st.lists(st.text("ab", max_size=14), max_size=4), max_size=6), st.integers(1, 4))
@settings(deadline=None, max_examples=60)
def test_suffix_index(batches, scan):
    substrings.SCAN = scan
    index = substrings.SuffixIndex(3)
    texts = [t.encode() for b in batches for t in b]
    for b in batches:
        index.add([t.encode() for t in b])
    every = [t[i : i + 3] for t in texts for i in range(len(t) - 2)]
    at = np.cumsum([0, *map(len, texts)])
    hit = [bool(index.hit[b + i]) for b, t in zip(at, texts, strict=False) for i in range(len(t) - 2)]
    count = Counter(every)
    substrings.SCAN = 8192
    assert hit == [count[w] > 1 for w in every]
    assert all(len(a) >= 2 * len(b) for a, b in zip(index.levels, index.levels[1:], strict=False))
    for level in index.levels:
        windows = [texts[np.searchsorted(at, p, side="right") - 1][p - at[np.searchsorted(at, p, side="right") - 1] :][:3] for p in level]
        assert windows == sorted(set(windows))


def test_long_text_segments():
    """A text beyond one part's size keeps every window."""
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, (1 << 23) + 5000, dtype=np.uint8)
    covered = np.zeros(len(data), bool)
    for _, begin, end, _, _ in substrings._pieces(data, np.array([0, len(data)]), 200):
        edge = np.zeros(len(data) + 1, int)
        np.add.at(edge, begin, 1)
        np.add.at(edge, end - 199, -1)
        covered |= np.cumsum(edge)[:-1] > 0
    assert covered[: len(data) - 199].all()


@given(st.integers(1, 400), st.integers(1, 12), st.integers(0, 10**6))
@settings(deadline=None, max_examples=40)
def test_max_score(n, terms, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-20, 20, (n, terms)) * (rng.random((n, terms)) < 0.6)
    q = rng.integers(-20, 20, terms)
    ids = rng.permutation(n)
    got = topk.Shard(ids, np.ascontiguousarray(x.T.astype(float))).search(q.astype(float), int(ids[0]), 10)
    want = sorted((-int(x[i] @ q), int(ids[i])) for i in range(n) if ids[i] != ids[0])[:10]
    assert [(-int(s), int(i)) for i, s in zip(*got, strict=True)] == want


def test_entropy_windows():
    text = ("the quick brown fox jumps over the lazy dog " * 4).encode() + bytes(range(97, 123)) * 3
    rank, _ = digest.windows(np.frombuffer(text, np.uint8))
    for s in range(0, len(text) - 31, 7):
        counts = Counter(text[s : s + 32]).values()
        entropy = 5 - sum(c * math.log2(c) for c in counts) / 32
        want = 1e6 * math.exp(-0.5 * ((entropy - digest.MEAN) / digest.DEVIATION) ** 2) if entropy >= digest.LEAST else digest._NEVER
        assert abs(rank[s] - want) < 2e3


def _popular(rank, neighbours, popularity):
    """How often each window is the leftmost one of least rank among ``neighbours`` in a row, counted one by one."""
    count = [0] * len(rank)
    for i in range(1 - neighbours, len(rank)):
        around = [j for j in range(max(0, i), min(len(rank), i + neighbours)) if rank[j] < digest._NEVER]
        if around:
            count[min(around, key=lambda j: (rank[j], j))] += 1
    return [j for j, c in enumerate(count) if c >= popularity]


@pytest.mark.parametrize("seed", range(5))
def test_features_by_hand(seed):
    """Selection, the chain of filters and the likeness against plain loops."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) + str(rng.randrange(9)) for _ in range(rng.choice([3, 60, 300, 900]))).encode() for _ in range(4)]
    texts[1] = texts[0][: len(texts[0]) // 2] + texts[1]
    chains = digest.fingerprints(texts)
    for text, chain in zip(texts, chains, strict=True):
        data = np.frombuffer(text, np.uint8)
        rank, hashes = digest.windows(data)
        at = _popular(rank.tolist(), digest.NEIGHBOURS, digest.POPULARITY)
        assert digest.select(rank, np.array([0, len(rank)])).tolist() == at
        features = list(dict.fromkeys(int(x) for x in common.mix64(hashes[np.array(at, int)])))
        filters = []
        for i in range(0, len(features), digest.FEATURES):
            bits = 0
            for f in features[i : i + digest.FEATURES]:
                for k in range(digest.HASHES):
                    bits |= 1 << (f >> 11 * k & digest.BITS - 1)
            filters.append((len(features[i : i + digest.FEATURES]), bits))
        if features:
            assert [(int(r[0]), int.from_bytes(r[1:].tobytes(), "little")) for r in chain] == filters
    unpack = lambda chain: [(int(r[0]), int.from_bytes(r[1:].tobytes(), "little")) for r in chain]
    for a in chains:
        for b in chains:
            x, y = sorted((unpack(a), unpack(b)), key=len)
            if x == y:
                assert digest.likeness(a, b) == 1.0
                continue
            best = []
            for _, p in x:
                near = []
                for _, q in y:
                    chance, most = p.bit_count() * q.bit_count() / digest.BITS, min(p.bit_count(), q.bit_count())
                    near.append(((p & q).bit_count() - chance) / (most - chance) if most > chance else 0)
                best.append(max(near))
            mean = sum(n * v for (n, _), v in zip(x, best, strict=True)) / sum(n for n, _ in x)
            assert abs(digest.likeness(a, b) - min(1, max(0, mean))) < 1e-9


def test_digest_of_parts_is_digest_of_whole():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "béta", "gamma", "delta", "日本", "x"]) + str(rng.randrange(50)) for _ in range(n)).encode() for n in (0, 1, 3, 10, 40, 200, 900, 300)]
    out = digest.compare(texts)
    for i, t in enumerate(texts[:-1]):
        chars, after = t.decode(), texts[i + 1].decode()
        half = len(chars) // 2
        edited = (chars[: len(chars) - half] + after[:half]).encode()
        assert digest.encode(digest.fingerprints([edited])[0]) == out["edited_fingerprint"][i]
        assert digest.encode(digest.fingerprints([t])[0]) == out["fingerprint"][i]
        assert (digest.decode(out["fingerprint"][i]) == digest.fingerprints([t])[0]).all()


def test_digest_likeness(spark, sf):
    out = QUERIES["op7_digest"](spark, sf).filter("n_chars >= 400")
    row = out.agg(F.avg((F.col("near_edited") > F.col("near_next")).cast("double")).alias("better"), F.avg("near_edited").alias("edited"), F.expr("percentile(near_next, 0.5)").alias("other")).first()
    assert row.better > 0.9 and row.edited > 0.4 and row.other < 0.05


def test_digest_order(spark, sf):
    """Each document is paired with the next id, over buckets."""
    import hashlib

    docs = {r.doc_id: r.text for r in common.table(spark, sf, "documents").collect()}
    ids = sorted(docs)
    got = {r.doc_id: r.edited_sha256 for r in QUERIES["op7_digest"](spark, sf).collect()}
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        half = len(docs[a]) // 2
        assert got[a] == hashlib.sha256((docs[a][: len(docs[a]) - half] + docs[b][:half]).encode()).hexdigest()


ODD = ["", " ", " a", "a  b", "x\n y", "Hello　 world \t", "<|endoftext|> hi", "don't it's 12 3\n\n\nq ", "é ü ß", "a b ", "日本 語", "tab\tin it", "a b", "end.\n"]


def test_tokenizer(spark, sf):
    from tokenizers import Tokenizer

    path, ranks = tokenizer_files()
    texts = [r.text for r in common.table(spark, sf, "documents").limit(150).collect()] + ODD
    plain = Tokenizer.from_file(path)
    got = packing.ByteTokenizer(path, ranks).encode(pa.array(texts))
    assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.lists(st.lists(st.integers(1, 30), max_size=60), max_size=25))
@settings(deadline=None, max_examples=50)
def test_pack_shard(docs):
    docs = [np.array([*d, 0], np.int32) for d in docs]
    sequences = packing.pack_shard(docs, 31, window=16)
    seen = Counter((d, i) for s in sequences for d, a, n in s for i in range(a, a + n))
    assert seen == Counter((d, i) for d, ids in enumerate(docs) for i in range(len(ids)))
    assert all(sum(n for _, _, n in s) <= 16 for s in sequences) and sum(sum(n for _, _, n in s) < 16 for s in sequences) <= 1


def test_packing_query(spark, sf):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_files()[0])
    docs = {r.doc_id: r.text for r in common.table(spark, sf, "documents").collect()}
    rows = QUERIES["op8_packing"](spark, sf).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for d, pieces in by_doc.items():
        ids = [*plain.encode(docs[d], add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes()) == r.ids_crc32
        assert at == len(ids)
    assert by_doc.keys() == docs.keys()
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= total / 1024 + 2


def test_packing_prefers_neighbours():
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(100 * (i % 2), 100 * (i % 2) + 100, 40), 0) for i in range(24)]
    sequences = packing.pack_shard([d.astype(np.int32) for d in docs], 300, window=128)
    pure = sum(len({d % 2 for d, _, _ in s}) == 1 for s in sequences)
    assert pure >= len(sequences) - 2


@pytest.mark.parametrize("seed", range(4))
def test_bm25_and_greedy_filling_by_hand(seed):
    """Scores by the formula, and windows filled by a plain walk over all unused neighbours."""
    rng = np.random.default_rng(seed)
    docs = [np.append(rng.zipf(1.5, rng.integers(1, 60)) % 200 + 1, 0).astype(np.int32) for _ in range(28)]
    window, left, start = 64, {}, {}
    want = []
    for d, ids in enumerate(docs):
        full = len(ids) // window * window
        want += [[(d, s, window)] for s in range(0, full, window)]
        if full < len(ids):
            left[d], start[d] = len(ids) - full, full
    held = {d: docs[d][start[d] :].tolist() for d in left}
    mean = sum(map(len, held.values())) / len(held)

    def score(seed, d):
        total = 0.0
        for term in set(held[seed]):
            df, tf = sum(term in x for x in held.values()), held[d].count(term)
            total += math.log(1 + (len(held) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(held[d]) / mean))
        return total

    index = packing.Bm25([docs[d][start[d] :] for d in held], 201)
    for i, d in enumerate(held):
        assert np.allclose(index.scores(i), [score(d, other) for other in held])
    for seed_doc in held:
        if not left[seed_doc]:
            continue
        pieces, space = [], window
        order = sorted((d for d in held if d != seed_doc), key=lambda d: (-round(score(seed_doc, d), 9), d))
        for d in [seed_doc, *order]:
            if space and left[d]:
                size = min(space, left[d])
                pieces.append((d, start[d], size))
                start[d], left[d], space = start[d] + size, left[d] - size, space - size
        want.append(pieces)
    assert packing.pack_shard(docs, 201, window) == want


def test_packing_ranks_by_all_terms():
    """Neighbours that share only frequent terms with a seed are found, however many rare terms it has."""
    rare, shared = np.arange(100, 200), np.arange(60)
    docs = [np.concatenate([rare, shared])] + [np.arange(200 + 60 * i, 260 + 60 * i) for i in range(40)] + [shared] * 8
    index = packing.Bm25([d.astype(np.int32) for d in docs], 3000)
    score = index.scores(0)
    assert (score[-8:] > 0).all() and not score[1:-8].any()
    free = np.ones(len(docs), bool)
    free[-4:] = False
    index.drop(free)
    assert np.allclose(index.scores(0)[:-4], score[:-4]) and not index.scores(0)[-4:].any()


def test_packing_groups_across_partitions(spark):
    """Close documents meet in a sequence though every one comes from another partition and fills a shard's share."""
    rng = np.random.default_rng(3)
    topics = [[f"t{t}w{i}" for i in range(60)] for t in range(12)]
    rows = [(t * 8 + i, " ".join(rng.permutation(topics[t]))) for i in range(8) for t in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(48, "doc_id")
    pieces = packing.pack(docs, *tokenizer_files(), window=1024, shard_tokens=4096).collect()
    spread = defaultdict(set)
    for r in pieces:
        spread[r.doc_id // 8].add(r.sequence_id)
    assert sum(map(len, spread.values())) / len(spread) < 4.5  # 8 each if close documents don't meet


def test_marginals_are_exact():
    """Forward-backward against the sum over all paths."""
    rng = np.random.default_rng(0)
    crf = toxicity.Crf(rng.normal(size=toxicity.FEATURES).astype(np.float32), 0.3, rng.normal(size=(2, 2)))
    lengths = [1, 4, 2, 5]
    features = rng.integers(0, toxicity.FEATURES, (sum(lengths), 6))
    place = np.concatenate([np.arange(n) for n in lengths])
    p, pairs, total = crf.marginals(crf.emissions(features), place)
    at, want_pairs, want_total = 0, np.zeros((2, 2)), 0.0
    for n in lengths:
        emit = crf.weights[features[at : at + n]].sum(1).astype(float) + crf.bias
        weight, toxic, steps = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in range(2**n):
            y = [(path >> i) & 1 for i in range(n)]
            w = math.exp(sum(e for e, v in zip(emit, y, strict=True) if v) + sum(crf.transition[a, b] for a, b in zip(y, y[1:], strict=False)))
            weight += w
            toxic += w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                steps[a, b] += w
        assert np.allclose(p[at : at + n], toxic / weight)
        want_pairs += steps / weight
        want_total += math.log(weight)
        at += n
    assert np.allclose(pairs, want_pairs) and abs(total - want_total) < 1e-8


def test_score_by_hand(spark):
    """Tokens, features, sums over all paths and the logistic function, done again in plain Python."""
    docs = spark.createDataFrame([(i, "you are a filthy scumbag. truly" if i % 3 == 0 else "all is well. we are fine") for i in range(90)], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int"))
    texts = ["You scumbag! You, é are fine", "", "well\nfilthy filthy 3 scum", None]

    def feature(kind, word):
        h = int(common.range_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])
        return ((h ^ 0x9E3779B97F4A7C15 * (kind + 1) & (1 << 64) - 1) * 0xFF51AFD7ED558CCD & (1 << 64) - 1) >> 44

    def score(text):
        expected = most = 0.0
        for sentence in re.split(r"[.!?\n]", text or ""):
            words = [w.encode() for w in re.findall(r"[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), sentence))]
            emit = [sum(float(model.crf.weights[feature(k, x)]) for k, x in enumerate([w, w[:3], w[:4], w[:5], w[:6], w[-4:]])) + model.crf.bias for w in words]
            paths = list(itertools.product((0, 1), repeat=len(words)))
            weight = [math.exp(sum(e * y for e, y in zip(emit, p, strict=True)) + sum(model.crf.transition[a, b] for a, b in zip(p, p[1:], strict=False))) for p in paths]
            marginal = [sum(w for w, p in zip(weight, paths, strict=True) if p[i]) / sum(weight) for i in range(len(words))]
            expected, most = expected + sum(marginal), max([most, *marginal])
        return 1 / (1 + math.exp(-(model.calibration @ [1, math.log1p(expected), most])))

    out = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in out:
        assert abs(r.score - score(texts[r.doc_id])) < 1e-5 and r.predicted == (r.score >= 0.5)
    assert out[0].predicted and not out[1].predicted


def test_held_out_labels_change_nothing(spark):
    rows = [(i, f"you are a filthy scumbag {i}" if i % 3 == 0 else f"all is well {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    label = lambda i, other: int((i % 3 == 0) != (other and zlib.crc32(str(i).encode()) % 5 == 0))
    a, b = (toxicity.train(docs, spark.createDataFrame([(i, 1, label(i, o)) for i in range(200)], "doc_id long, quality int, toxic int")) for o in (False, True))
    assert (a.calibration == b.calibration).all() and (a.crf.weights == b.crf.weights).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op1_toxicity"](spark, sf).join(common.table(spark, sf, "labels"), "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    assert len(rows) > 40
    good, bad = [r.score for r in rows if not r.toxic], [r.score for r in rows if r.toxic]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.9 and np.mean([r.predicted == r.toxic for r in rows]) > 0.9


def test_spans_are_code_points(spark):
    rows = [(i, "ünï cödé words are fine. all is well" if i % 2 else "ünï you are a filthy scumbag today. é") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, 1, int(i % 2 == 0)) for i in range(60)], "doc_id long, quality int, toxic int"))
    got = toxicity.score(docs.filter("doc_id = 0"), model).first()
    assert got.predicted == 1 and any("scumbag" in rows[0][1][s.start : s.end] for s in got.spans)


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    out = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in out], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels).constant == 0.0


@given(st.lists(st.tuples(st.integers(0, 9), st.binary(max_size=400)), min_size=1, max_size=30))
@settings(deadline=None, max_examples=30)
def test_archive_round_trip(items):
    import hashlib

    rows = [{"page_id": i, "url": f"http://x/{i}", "payload": p, "payload_bytes": len(p), "payload_digest": hashlib.sha256(p).hexdigest(), "record_type": "response", "refers_to": None} for i, p in items]
    content = warc.write_archive(rows)
    assert content[:4] == (0x184D2A5D).to_bytes(4, "little")
    back = [warc.parse_record(r) for r in warc.frames(content)]
    assert back == rows


def test_archive_files(spark, sf, tmp_path):
    """Archives as files, read back by Spark's file source; and pages of one very common payload spread by id."""
    pages = common.table(spark, sf, "pages").withColumn("html", F.when(F.col("page_id") % 3 == 0, F.lit("the same page " * 20)).otherwise(F.col("html")))
    plain = sorted(map(str, warc.read_archives(warc.write_archives(pages)).collect()))
    saved = warc.save_archives(warc.write_archives(pages), f"file://{tmp_path}/archives").collect()
    assert sorted(r.archive for r in saved) == sorted(p.name for p in (tmp_path / "archives").iterdir())
    back = warc.read_archives(warc.open_archives(spark, f"file://{tmp_path}/archives"))
    assert sorted(map(str, back.collect())) == plain and len(plain) == pages.count()


def test_common_pages(spark):
    rows = [(i, "u", "the same page " * 20 if i % 3 else f"own page {i} " * 20) for i in range(3000)]
    out = warc.with_revisits(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert out.filter("record_type = 'revisit'").agg(F.count("*"), F.min("refers_to"), F.max("refers_to")).first() == (1999, 1, 1)


def test_broken_archives():
    import hashlib

    row = {"page_id": 1, "url": "u", "payload": b"abc" * 100, "payload_bytes": 300, "payload_digest": hashlib.sha256(b"abc" * 100).hexdigest(), "record_type": "response", "refers_to": None}
    content = warc.write_archive([row, row])
    with pytest.raises(ValueError, match="cut off"):
        list(warc.frames(content[:-3]))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.frames(content[:-20] + bytes(20)))
    record = next(warc.frames(content))
    for broken in (record.replace(b"WARC/1.1", b"HTTP/1.1"), record[:-1], record.replace(b"abc", b"abd", 1), record.replace(b"WARC-Date", b"X-Date"), record.replace(b"Content-Length: 300", b"Content-Length: 299")):
        with pytest.raises(ValueError):
            warc.parse_record(broken)
    packed = zstandard.ZstdCompressor().compress(content[8 : 8 + int.from_bytes(content[4:8], "little")])
    size = int.from_bytes(content[4:8], "little")
    again = content[:4] + len(packed).to_bytes(4, "little") + packed + content[8 + size :]
    assert [warc.parse_record(r) for r in warc.frames(again)] == [row, row]


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = common.table(spark, sf, "documents").withColumn("score", F.lit("extra"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.materialize(stage(spark, docs, sf), name)
        assert after.columns == docs.columns and 0 < after.count()
        if name != "mixing":
            assert after.count() <= docs.count()
            assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.agg(F.count_distinct("doc_id")).first()[0] == docs.select("doc_id").distinct().count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "packing"]


def test_pipeline_keeps_one_of_each_group(spark, sf):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(80))
    rows = [(5, text, "en", "a", 1), (3, text + " more", "en", "a", 1), (9, "quite another text of its own with more words", "en", "b", 1), (9, "quite another text of its own with more words", "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()
    assert sorted(r.doc_id for r in out) == [3, 9]
