"""Tag toxic spans with a linear-chain conditional random field and score documents by its marginals.

Tokens are runs of letters (A-Z lower-cased, any byte from 0x80 on counts as a letter); a sequence is the tokens between
two of ``. ! ?`` or line feeds, however many; only the fit cuts its sample's into pieces of FIT_SEQUENCE. States: 0 clean, 1 toxic. A token's features are its bytes, its
first 3, 4, 5 and 6 bytes and its last 4, hashed into 2**20 weights.

Documents are labelled, tokens aren't, so tokens get their labels from the documents': a token of a toxic document is
toxic if one of its features is far more frequent, beyond chance, in toxic documents. The field is fitted on these by
gradient ascent on the conditional likelihood. Forward-backward gives each token's marginal; a document's score is a
logistic function of the expected number of toxic tokens and of the largest marginal, fitted on the documents' labels.

The model is fitted on a bounded sample of the labelled documents that aren't held out: MAX_TRAINING of each label, smallest
md5(doc_id) first, and of these, in that order, whole texts of MAX_TRAINING_BYTES together: first those that need no more than
1/TEXT_SHARE of it, then longer ones, each if it still fits. So no long text keeps others out. Where no text of a label fits, the
least of them is learnt from as far as the bound goes, so that no label is lost. The logistic function is fitted
on signals of documents that a field hadn't seen: the sample's halves are scored by fields fitted on the other half. Its
ridge is the one of RIDGES with the least loss when either half's function is tried on the other half. Nothing is chosen
by the held-out fold. Scoring covers every whole text.

Edge cases: null and empty texts have no tokens and get the score of a text without toxic tokens; a text of any length is
scored whole; null labels are not used; of several labels of a document the largest counts; of rows that repeat a labelled
id the least text is learnt from; without labels of both kinds every score is the labels' mean (0 without labels); a null
doc_id is never held out, nor used for fitting; rows that repeat are scored alike; an empty table gives an empty result;
only the columns ``carry`` are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Ranges, discard, flat, materialize, runs

MAX_TRAINING = 2000
MAX_TRAINING_BYTES = 2 << 20  # the fit takes about a second a MB on the driver
FOLDS = 5
RIDGES = (0.001, 0.01, 0.1, 1.0, 10.0)
FEATURES = 1 << 20
TEXT_SHARE = 16
FIT_SEQUENCE = 256
FAINT = 0.05
CHUNK = 256  # texts tokenized at a time, so that arrays stay small
AFFIXES = (3, 4, 5, 6)
SUFFIX = 4

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[0x80:] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


@dataclass
class Tokens:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    features: np.ndarray  # a row for each token
    sequence: np.ndarray  # of each token, rising
    place: np.ndarray  # in its sequence
    word: np.ndarray  # hash of its bytes

    def of(self, keep: np.ndarray) -> Tokens:
        return Tokens(*(getattr(self, k)[keep] for k in ("start", "end", "doc", "features", "sequence", "place", "word")))


def tokenize(data: np.ndarray, offsets: np.ndarray, longest: int | None = None) -> Tokens:
    """Tokens of texts that lie back to back in ``data``; sequences of over ``longest`` are cut."""
    data = LOWER[data]
    letter = np.concatenate([[False], _LETTER[data], [False]])
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a text's first byte, and the end
    start = np.flatnonzero(letter[1:-1] & (~letter[:-2] | first[:-1])) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(letter[1:-1] & (~letter[2:] | first[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    doc = np.searchsorted(offsets, start, side="right") - 1
    stops = np.concatenate([[0], np.cumsum(_STOP[data], dtype=np.int64)])
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (stops[start[1:]] != stops[end[:-1]])
    begin = np.flatnonzero(new)
    place = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
    if longest:
        place %= longest
        new |= place == 0
    sequence = np.cumsum(new) - 1
    ranges = Ranges(data)
    kinds = [ranges.hashes(start, end)] + [ranges.hashes(start, np.minimum(start + n, end)) for n in AFFIXES] + [ranges.hashes(np.maximum(end - SUFFIX, start), end)]
    features = np.empty((len(start), len(kinds)), np.int32)
    for i, h in enumerate(kinds):
        features[:, i] = (h ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(44)
    return Tokens(start, end, doc, features, sequence, place, kinds[0])


def _join(parts: list[Tokens], docs: list[int]) -> Tokens:
    """Tokens of chunks of texts as of all texts, given the texts before each; offsets stay those in the chunks."""
    sequences = 0
    for x, before in zip(parts, docs, strict=True):
        last = int(x.sequence[-1]) + 1 if len(x.sequence) else 0
        x.doc, x.sequence, sequences = x.doc + before, x.sequence + sequences, sequences + last
    return Tokens(*(np.concatenate([getattr(x, k) for x in parts]) for k in ("start", "end", "doc", "features", "sequence", "place", "word")))


def layout(place: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Where each token goes so that all sequences' first tokens come first, then their second ones and so on, longest
    sequence first; and how many sequences have each."""
    if not len(place):
        return np.zeros(0, np.int64), []
    begin = np.flatnonzero(place == 0)
    length = np.diff(np.append(begin, len(place)))
    rank = np.empty(len(length), np.int64)
    rank[np.argsort(-length, kind="stable")] = np.arange(len(length))
    alive = len(length) - np.searchsorted(np.sort(length), np.arange(int(length.max())), side="right")
    first = np.concatenate([[0], np.cumsum(alive)])
    return first[place] + np.repeat(rank, length), alive.tolist()


@dataclass
class Crf:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))  # for the toxic state, by feature
    bias: float = 0.0
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(1).astype(np.float64) + self.bias

    def marginals(self, emit: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(toxic) of each token, the expected transitions (2 x 2), and the log of all sequences' partition functions."""
        at, alive = layout(place)
        ordered = np.empty(len(emit))
        ordered[at] = emit
        p, pairs, total = self.forward_backward(ordered, alive)
        return p[at], pairs, total

    def forward_backward(self, emit: np.ndarray, alive: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
        """The same of tokens in the order of :func:`layout`: all sequences advance together, one step a token, and a
        step's tokens lie side by side."""
        n, pairs = len(emit), np.zeros((2, 2))
        if not n:
            return np.zeros(0), pairs, 0.0
        odds = np.exp(np.clip(emit, -30, 30))
        first = [0, *itertools.accumulate(alive)]
        t = np.exp(self.transition)
        toxic, scale = np.empty(n), np.empty(n)  # given what came before, a token is clean with 1 - toxic
        for step, m in enumerate(alive):
            at = slice(first[step], first[step] + m)
            if step:
                b = toxic[first[step - 1] : first[step - 1] + m]
                clean_to = t[0, 0] + b * (t[1, 0] - t[0, 0])
                toxic_to = (t[0, 1] + b * (t[1, 1] - t[0, 1])) * odds[at]
            else:
                clean_to, toxic_to = np.ones(m), odds[at]
            np.add(clean_to, toxic_to, out=scale[at])
            np.divide(toxic_to, scale[at], out=toxic[at])
        total = float(np.log(scale).sum())
        p = toxic.copy()
        after_clean = after_toxic = None
        for step in range(len(alive) - 1, 0, -1):
            m, at = alive[step], slice(first[step], first[step + 1])
            v, w = 1 / scale[at], odds[at] / scale[at]
            if after_clean is not None:
                v[: len(after_clean)] *= after_clean
                w[: len(after_toxic)] *= after_toxic
            b = toxic[first[step - 1] : first[step - 1] + m]
            bv, bw, sv, sw = np.einsum("i,i", b, v), np.einsum("i,i", b, w), v.sum(), w.sum()  # one thread
            pairs += t * np.array([[sv - bv, sw - bw], [bv, bw]])
            after_clean, after_toxic = t[0, 0] * v + t[0, 1] * w, t[1, 0] * v + t[1, 1] * w
            p[first[step - 1] : first[step - 1] + m] *= after_toxic
        return p, pairs, total

    def fit(self, tokens: Tokens, label: np.ndarray, rounds: int = 40, rate: float = 0.5, decay: float = 1e-4) -> None:
        """Full-batch AdaGrad on the conditional log-likelihood."""
        y = label.astype(np.float64)
        inner = tokens.place > 0
        seen = np.zeros((2, 2))
        np.add.at(seen, (label[:-1][inner[1:]], label[1:][inner[1:]]), 1)
        # Tokens of one word have one emission, so weights are looked up and moved once a word; only weights in use move.
        _, one, word = np.unique(tokens.word, return_index=True, return_inverse=True)
        used, cells = np.unique(tokens.features[one], return_inverse=True)
        cells, size = cells.reshape(len(one), -1), max(1, len(y))
        flat_cells, times = cells.ravel(), cells.shape[1]
        at, alive = layout(tokens.place)
        order = np.empty(len(at), np.int64)
        order[at] = np.arange(len(at))
        word, y = word[order], y[order]
        weights, square, square_t, square_b = np.zeros(len(used)), np.full(len(used), 1e-8), np.full((2, 2), 1e-8), 1e-8
        for _ in range(rounds):
            p, pairs, _ = self.forward_backward((weights[cells].sum(1) + self.bias)[word], alive)
            slope = np.bincount(flat_cells, np.repeat(np.bincount(word, y - p, len(one)), times), len(used)) / size - decay * weights
            slope_t, slope_b = (seen - pairs) / size - decay * self.transition, float((y - p).sum()) / size
            square, square_t, square_b = square + slope**2, square_t + slope_t**2, square_b + slope_b**2
            weights = weights + rate * slope / np.sqrt(square)
            self.transition, self.bias = self.transition + rate * slope_t / np.sqrt(square_t), self.bias + rate * slope_b / square_b**0.5
        self.weights[used] = weights


def token_labels(tokens: Tokens, doc_label: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents with a feature that is far more frequent, beyond chance, in toxic documents."""
    n1, n0 = doc_label.sum(), (1 - doc_label).sum()
    toxic, clean = np.zeros(FEATURES), np.zeros(FEATURES)
    for column in tokens.features.T:
        cells = np.unique(tokens.doc.astype(np.int64) * FEATURES + column)
        doc, cell = cells // FEATURES, cells % FEATURES
        toxic += np.bincount(cell, doc_label[doc], FEATURES)
        clean += np.bincount(cell, 1 - doc_label[doc], FEATURES)
    ratio = np.log((toxic + 0.5) / (n1 + 1)) - np.log((clean + 0.5) / (n0 + 1))
    marked = (ratio > 2) & (ratio / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)) > 2.5) & (toxic >= 3)
    return (marked[tokens.features].any(1) & (doc_label[tokens.doc] == 1)).astype(np.int64)


def _signals(p: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Intercept, log(1 + expected toxic tokens) and largest marginal of each document. Marginals under FAINT don't count
    as tokens: in a long text they would add up by its length alone."""
    most = np.zeros(docs)
    if len(p):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        most[doc[first]] = np.maximum.reduceat(p, first)
    expected = np.bincount(doc, np.where(p < FAINT, 0, p), docs) if len(p) else np.zeros(docs)
    return np.stack([np.ones(docs), np.log1p(expected), most], 1)


@dataclass
class Model:
    crf: Crf | None
    calibration: np.ndarray
    constant: float = 0.0

    def score(self, signals: np.ndarray) -> np.ndarray:
        if self.crf is None:
            return np.full(len(signals), self.constant)
        return 1 / (1 + np.exp(-np.clip(signals @ self.calibration, -30, 30)))


def calibrate(x: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression of labels on signals, by Newton's method; the intercept isn't held back."""
    w, held = np.zeros(3), ridge * np.array([0, 1, 1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (labels - q)) - held * w
        curve = (x * (weights * q * (1 - q))[:, None]).T @ x + np.diag(held + 1e-6)
        step = np.linalg.solve(curve, slope)
        w = w + step / max(1, np.abs(step).max() / 2)
    return w


def _loss(x: np.ndarray, labels: np.ndarray, weights: np.ndarray, w: np.ndarray) -> float:
    z = np.clip(x @ w, -30, 30)
    return float(weights @ (np.log1p(np.exp(z)) - labels * z))


def _field(tokens: Tokens, labels: np.ndarray, docs: np.ndarray) -> Crf:
    """The field fitted on the tokens of some of the documents."""
    part = tokens.of(docs[tokens.doc])
    number = np.cumsum(docs) - 1
    part.doc = number[part.doc]
    crf = Crf()
    crf.fit(part, token_labels(part, labels[docs]))
    return crf


def fit(texts: pa.Array, labels: np.ndarray, weights: np.ndarray) -> Model:
    """``weights``: the documents that each sampled one stands for."""
    if not len(labels) or labels.min() == labels.max():
        return Model(None, np.zeros(3), float(np.average(labels, weights=weights)) if len(labels) else 0.0)
    chunks = list(runs(texts, 1 << 20, CHUNK))
    tokens = _join([tokenize(*flat(texts.slice(i, n)), FIT_SEQUENCE) for i, n in chunks], [i for i, _ in chunks])
    crf = _field(tokens, labels, np.ones(len(labels), bool))
    half, x = np.zeros(len(labels), bool), np.zeros((len(labels), 3))
    for y in (0, 1):
        half[np.flatnonzero(labels == y)[::2]] = True

    def signals(by: Crf) -> np.ndarray:
        p, _, _ = by.marginals(by.emissions(tokens.features), tokens.place)
        return _signals(p, tokens.doc, len(labels))

    if min((labels == y).sum() for y in (0, 1)) < 2:  # one half would lack a label
        return Model(crf, calibrate(signals(crf), labels, weights, RIDGES[-1]))
    for side in (half, ~half):
        x[~side] = signals(_field(tokens, labels, side))[~side]
    tried = {r: sum(_loss(x[~s], labels[~s], weights[~s], calibrate(x[s], labels[s], weights[s], r)) for s in (half, ~half)) for r in RIDGES}
    return Model(crf, calibrate(x, labels, weights, min(tried, key=tried.get)))


def _spans(data: np.ndarray, offsets: np.ndarray, tokens: Tokens, p: np.ndarray) -> list[list[dict]]:
    """For each text, its runs of tokens of one sequence with a marginal of 0.5 or more, as code point offsets."""
    hit = np.flatnonzero(p >= 0.5)
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    if not len(hit):
        return out
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    new = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (tokens.sequence[hit[1:]] != tokens.sequence[hit[:-1]])])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(hit)) - 1
    best = np.maximum.reduceat(p[hit], heads)
    for a, b, m in zip(hit[heads], hit[tails], best, strict=True):
        d = tokens.doc[a]
        base = points[offsets[d]]
        out[d].append({"start": int(points[tokens.start[a]] - base), "end": int(points[tokens.end[b]] - base), "probability": float(m)})
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


def _score(model: Model, carried: list[str], text_column: str):
    sparse = (np.flatnonzero(model.crf.weights), model.crf.weights[model.crf.weights != 0]) if model.crf else None
    plain = Model(None if model.crf is None else Crf(np.zeros(0, np.float32), model.crf.bias, model.crf.transition), model.calibration, model.constant)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sparse:
            plain.crf.weights = np.zeros(FEATURES, np.float32)
            plain.crf.weights[sparse[0]] = sparse[1]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column))
            for i, n in runs(texts, 1 << 20, CHUNK):
                part = batch.slice(i, n)
                data, offsets = flat(texts.slice(i, n))
                if plain.crf is None:
                    tokens, p = tokenize(data[:0], np.zeros(part.num_rows + 1, np.int64)), np.zeros(0)
                else:
                    tokens = tokenize(data, offsets)
                    p, _, _ = plain.crf.marginals(plain.crf.emissions(tokens.features), tokens.place)
                s = plain.score(_signals(p, tokens.doc, part.num_rows))
                spans = _spans(data, offsets, tokens, p) if plain.crf else [[] for _ in range(part.num_rows)]
                arrays = [part.column(part.schema.get_field_index(c)) for c in carried] + [pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays(arrays, [*carried, "score", "predicted", "spans"])

    return score


def sampled(sizes: list[tuple[int, int]], max_bytes: int) -> list[int]:
    """Of (id, bytes) in order the ids that are learnt from: of texts up to a share of ``max_bytes`` as many as fit, then longer
    ones, each if it still fits; the smallest one if none does."""
    taken, total, share = [], 0, max_bytes // TEXT_SHARE
    for i, size in (x for x in sizes if x[1] <= share):
        if total + size > max_bytes:
            break  # going on with what is small enough would make the sample one of short texts
        taken.append(i)
        total += size
    for i, size in (x for x in sizes if x[1] > share):
        if total + size <= max_bytes:
            taken.append(i)
            total += size
    return taken or [i for i, _ in sorted(sizes, key=lambda x: x[1])[:1]]


def train(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING, max_bytes: int = MAX_TRAINING_BYTES) -> Model:
    """Fit on labelled documents outside the held-out fold, ``max_training`` and ``max_bytes`` of each label at most."""
    ids = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.filter(~held_out("doc_id")).filter(F.col("toxic").isin(0, 1))
    have = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    order = [F.md5(F.col("doc_id").cast("string")), "doc_id"]
    labelled = ids.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = [labelled.filter(F.col("toxic") == y).orderBy(*order).limit(max_training) for y in (0, 1)]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # 2 * max_training ids at most
    texts = materialize(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "labelled")
    sizes = texts.select("doc_id", "toxic", F.octet_length("text").alias("bytes")).orderBy(*order).collect()  # no texts yet, 2 * max_training numbers
    taken = [i for y in (0, 1) for i in sampled([(r.doc_id, r.bytes) for r in sizes if r.toxic == y], max_bytes)]
    learnt = texts.filter(F.col("doc_id").isin(taken)).select("doc_id", F.substring("text", 1, max_bytes).alias("text"), "toxic")  # cuts only what alone exceeds the bound
    sample = learnt.toArrow().sort_by([("doc_id", "ascending")])
    discard(texts)
    y = sample.column("toxic").to_numpy().astype(np.float64) if sample.num_rows else np.zeros(0)
    share = np.array([max(1.0, have.get(v, 0) / max(1, int((y == v).sum()))) for v in (0, 1)])
    return fit(sample.column("text").combine_chunks(), y, share[y.astype(int)])


def held_out(column: str):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % FOLDS == 0, F.lit(False))


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """``carry`` with score, predicted and spans (code point offsets of toxic runs with their probability)."""
    carried = list(carry)
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), "score double", "predicted int", "spans array<struct<start: long, end: long, probability: double>>"])
    return docs.select(*dict.fromkeys([*carried, text_column])).mapInArrow(_score(model, carried, text_column), schema)
