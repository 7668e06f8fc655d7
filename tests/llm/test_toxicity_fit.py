"""How the field is fitted: the sample, the tokens' labels and the gradient, by plain loops."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from palimpsest.llm import toxicity


@pytest.mark.parametrize("long", [1, 0])
def test_a_long_text_keeps_no_others_out(spark, long):
    """One text of the label beyond the bound, the first in order: the others are learnt from all the same."""
    docs = [(i, f"plain words number {i}. " + ("they are vile gorpfilth scum. " if i % 2 else "they are kind. ")) for i in range(320)]
    mine = [i for i in range(320) if i % 2 == long and zlib.crc32(str(i).encode()) % 5]
    first = min(mine, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    docs[first] = (first, docs[first][1] * (2_300_000 // len(docs[first][1])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(table, spark.createDataFrame([(i, 1, i % 2) for i in range(320)], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.predicted for r in toxicity.score(table, model).collect()}
    assert got == {i: i % 2 for i in range(320)}


def test_sampled():
    assert toxicity.sampled([(1, 2000), (2, 50), (3, 60), (4, 500)], 1000) == [2, 3, 4] and toxicity.sampled([(1, 60)] * 17 + [(2, 1)], 1000) == [1] * 16
    assert toxicity.sampled([(1, 5000), (2, 4000)], 1000) == [2] and toxicity.sampled([], 1000) == []


def test_no_label_is_lost(spark):
    docs = spark.createDataFrame([(i, ("vile. " if i % 2 else "kind. ") * 50) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels, max_bytes=100).crf is not None


def test_chains_are_scored_whole():
    """A sequence of many tokens without a stop has the marginals of one chain."""
    words = [random.Random(4).choice(["aa", "bb", "cc"]) for _ in range(1000)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    tokens = toxicity.tokenize(data, np.array([0, len(data)]))
    assert tokens.sequence.max() == 0 and tokens.place.tolist() == list(range(1000))
    assert toxicity.tokenize(data, np.array([0, len(data)]), 256).place.max() == 255
    rng = np.random.default_rng(1)
    crf = toxicity.Crf(rng.normal(size=toxicity.FEATURES).astype(np.float32), 0.1, rng.normal(size=(2, 2)))
    emit = crf.emissions(tokens.features)
    p, _, _ = crf.marginals(emit, tokens.place)
    t, ahead, back = np.exp(crf.transition), [np.array([1, math.exp(emit[0])])], [np.ones(2)]
    for e in emit[1:]:
        v = (ahead[-1] @ t) * [1, math.exp(e)]
        ahead.append(v / v.sum())
    for e in emit[:0:-1]:
        v = t @ (back[-1] * [1, math.exp(e)])
        back.append(v / v.sum())
    both = np.array(ahead) * np.array(back[::-1])
    assert np.allclose(p, both[:, 1] / both.sum(1))


def sample(seed):
    r = random.Random(seed)
    texts = [" ".join(r.choice(["ill", "bad", "vile"] if i % 2 and r.random() < 0.5 else ["sun", "tree", "lake", "stone"]) + r.choice([" ", ". "]) for _ in range(12)) for i in range(80)]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    return toxicity.tokenize(np.frombuffer(data, np.uint8), offsets), np.array([i % 2 for i in range(80)], np.float64)


def test_token_labels():
    """A feature's documents are counted one by one."""
    tokens, label = sample(2)
    held = {}
    for d, row in zip(tokens.doc.tolist(), tokens.features.tolist(), strict=True):
        for column, f in enumerate(row):
            held.setdefault((column, f), set()).add(d)
    count = {}
    for (_, f), docs in held.items():
        for d in docs:
            count.setdefault(f, [0, 0])[int(label[d])] += 1
    n = [sum(label == y) for y in (0, 1)]
    marked = set()
    for f, (clean, toxic) in count.items():
        ratio = math.log((toxic + 0.5) / (n[1] + 1)) - math.log((clean + 0.5) / (n[0] + 1))
        if ratio > 2 and ratio / math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)) > 2.5 and toxic >= 3:
            marked.add(f)
    want = [int(label[d] == 1 and any(f in marked for f in row)) for d, row in zip(tokens.doc.tolist(), tokens.features.tolist(), strict=True)]
    got = toxicity.token_labels(tokens, label)
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_first_step_follows_the_gradient():
    """The gradient of the conditional log-likelihood, by enumeration of all labellings of each sequence."""
    tokens, label = sample(3)
    few = np.flatnonzero(np.isin(tokens.sequence, [s for s in range(40) if (tokens.sequence == s).sum() <= 8]))
    tokens = tokens.of(few)
    y = toxicity.token_labels(*sample(3))[few]
    crf = toxicity.Crf()
    crf.fit(tokens, y, rounds=1, rate=0.5, decay=0.0)
    expected, pairs, seen = np.zeros(len(y)), np.zeros((2, 2)), np.zeros((2, 2))
    for s in set(tokens.sequence.tolist()):
        at = np.flatnonzero(tokens.sequence == s)
        ways = list(itertools.product((0, 1), repeat=len(at)))  # all weights are 0, so all are as likely
        for way in ways:
            expected[at] += np.array(way) / len(ways)
            for a, b in itertools.pairwise(way):
                pairs[a, b] += 1 / len(ways)
        for a, b in itertools.pairwise(y[at].tolist()):
            seen[a, b] += 1
    slope = np.zeros(toxicity.FEATURES)
    for row, d in zip(tokens.features.tolist(), (y - expected).tolist(), strict=True):
        for f in row:
            slope[f] += d / len(y)
    step = lambda g: 0.5 * g / np.sqrt(1e-8 + g**2)
    assert np.allclose(crf.weights, step(slope), atol=1e-5)
    assert np.allclose(crf.transition, step((seen - pairs) / len(y))) and math.isclose(crf.bias, step((y - expected).sum() / len(y)))
