"""Functions that no built-in expresses, in Arrow batches."""

from __future__ import annotations

import difflib
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import squeeze, without_dagger, without_space


def _normal(form: str):
    @F.pandas_udf(T.StringType())
    def normalize(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    return normalize


def normal_form(text: Column, form: str = "NFC") -> Column:
    """Unicode normal form; ASCII texts are already in it."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), _normal(form)(text)).otherwise(text)


def norm(text: Column) -> Column:
    """The key by which texts match: composed, squeezed, without a heading's dagger."""
    return without_dagger(squeeze(normal_form(F.coalesce(text, F.lit("")))))


def norm_no_space(text: Column) -> Column:
    return without_space(norm(text))


def slugify(text: Column) -> Column:
    """An anchor for a heading: word characters and hyphens, white space to hyphens, lower-cased; ``sec`` if none is left."""
    bare = normal_form(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", ""), "<[^>]+>", ""), "NFKC")
    kept = F.regexp_replace(F.regexp_replace(bare, r"(?U)[^\w\s\-]", ""), r"(?U)\s+", "-")
    slug = F.lower(F.regexp_replace(kept, "^-+|-+$", ""))
    return F.when(slug == "", "sec").otherwise(slug)


#: Pairs of equal rare characters that are held at once; texts with more go through the standard library.
MOST_PAIRS = 1 << 22


def ratio(x: str, y: str) -> float:
    """``difflib.SequenceMatcher(None, x, y).ratio()``: the same blocks, found among the runs of equal rare characters of all
    diagonals, which are made once by sorting instead of anew for each block."""
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (x, y))
    if not len(a) or not len(b):
        return 0.0 if len(a) + len(b) else 1.0
    values, of_b, times = np.unique(b, return_inverse=True, return_counts=True)
    rare = times <= len(b) // 100 + 1 if len(b) >= 200 else np.ones(len(values), bool)
    at = np.minimum(np.searchsorted(values, a), len(values) - 1)
    i = np.flatnonzero((values[at] == a) & rare[at])
    pairs = times[at[i]]
    if pairs.sum() > MOST_PAIRS:
        return difflib.SequenceMatcher(None, x, y, autojunk=True).ratio()
    first = (np.cumsum(times) - times)[at[i]]
    j = np.argsort(of_b, kind="stable")[np.repeat(first - (np.cumsum(pairs) - pairs), pairs) + np.arange(pairs.sum())]
    i = np.repeat(i, pairs)
    by_diagonal = np.lexsort((i, i - j))
    i, j = i[by_diagonal], j[by_diagonal]
    begins = np.flatnonzero(np.r_[True, (np.diff(i) != 1) | (np.diff(j) != 1)][: len(i)])
    runs = i[begins], j[begins], np.diff(np.r_[begins, len(i)])
    matched, waiting = 0, [(0, len(a), 0, len(b), runs)]
    while waiting:
        alo, ahi, blo, bhi, (ri, rj, n) = waiting.pop()
        skip = np.maximum(np.maximum(alo - ri, blo - rj), 0)  # what of a run lies in this part of both texts
        ri, rj, n = ri + skip, rj + skip, np.minimum(np.minimum(n - skip, ahi - ri - skip), bhi - rj - skip)
        inside = n > 0
        ri, rj, n = ri[inside], rj[inside], n[inside]
        p, q, size = alo, blo, 0
        if len(n):  # the longest; of several the first in x, then in y
            longest = np.flatnonzero(n == n.max())
            k = longest[np.lexsort((rj[longest], ri[longest]))[0]]
            p, q, size = int(ri[k]), int(rj[k]), int(n[k])
        while p > alo and q > blo and x[p - 1] == y[q - 1]:
            p, q, size = p - 1, q - 1, size + 1
        while p + size < ahi and q + size < bhi and x[p + size] == y[q + size]:
            size += 1
        if size:
            matched += size
            if alo < p and blo < q:
                waiting.append((alo, p, blo, q, (ri, rj, n)))
            if p + size < ahi and q + size < bhi:
                waiting.append((p + size, ahi, q + size, bhi, (ri, rj, n)))
    return 2.0 * matched / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all characters, by longest common blocks; 1 for two empty texts."""
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])


_PAIR = re.compile(r"<[A-Za-z][^>]*>.*?</[A-Za-z][^>]*>", re.S)


def outside_tags(text: str) -> str:
    """What no pair of tags encloses: pairs go until none is left."""
    before = None
    while before != text:
        before, text = text, _PAIR.sub("", text)
    return text


@F.pandas_udf(T.StringType())
def strip_tag_pairs(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else outside_tags(t))


_TAG = re.compile(r"</?[A-Za-z][^>]*>")


def wrap(text: str, pairs: list[tuple[str, str]], whole: frozenset[str] = frozenset()) -> str:
    """Outside tags, the first place of each needle, longest needles first, becomes its replacement; a needle in
    ``whole`` only where no ASCII letter or digit adjoins, and none inside what another one wrote."""
    pairs = sorted(pairs, key=lambda p: -len(p[0]))

    def segment(part: str) -> str:
        done: list[tuple[str, bool]] = [(part, True)]
        for needle, new in pairs:
            for i, (piece, open_) in enumerate(done):
                if not open_ or not needle:
                    continue
                if needle in whole:
                    m = re.search(rf"(?<![A-Za-z0-9]){re.escape(needle)}(?![A-Za-z0-9])", piece)
                    at = m.start() if m else -1
                else:
                    at = piece.find(needle)
                if at >= 0:
                    done[i : i + 1] = [(piece[:at], True), (new, False), (piece[at + len(needle) :], True)]
                    break
        return "".join(p for p, _ in done)

    out, last = [], 0
    for m in _TAG.finditer(text):
        out += [segment(text[last : m.start()]), m.group(0)]
        last = m.end()
    return "".join([*out, segment(text[last:])])
