"""A page's translations carried over to its next version.

Texts of a page are numbered keys. When the page is parsed anew, its list of texts is aligned with the old one: texts that stand
once in both are anchors, the longest chain of them that keeps its order divides both lists, and so on between them (a patience
difference). An aligned text keeps its number and its translation. So does a text that moved: of what is left over, equal texts pair
up in order. A text that is new gets a number that the page never had, and the translation that an equal text has on the page.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict, deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CARRIED = "slug string, ord int, key_no int, ja string, zh string"


def _chain(places: list[int]) -> list[int]:
    """Which of ``places`` form a longest rising sequence: piles with their tops, and each one's predecessor."""
    tops: list[int] = []
    ends: list[int] = []
    below = [-1] * len(places)
    for i, p in enumerate(places):
        pile = bisect_left(tops, p)
        below[i] = ends[pile - 1] if pile else -1
        tops[pile : pile + 1], ends[pile : pile + 1] = [p], [i]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = below[at]
    return out[::-1]


def aligned(old: list[str], new: list[str]) -> dict[int, int]:
    """Place in ``new`` to place in ``old`` of the texts that keep their order."""
    pairs, open_parts = {}, [(0, len(old), 0, len(new))]
    while open_parts:
        a, b, c, d = open_parts.pop()
        while a < b and c < d and old[a] == new[c]:
            pairs[c] = a
            a, c = a + 1, c + 1
        while a < b and c < d and old[b - 1] == new[d - 1]:
            b, d = b - 1, d - 1
            pairs[d] = b
        where: dict[str, list[list[int]]] = defaultdict(lambda: [[], []])
        for side, (texts, begin, end) in enumerate(((old, a, b), (new, c, d))):
            for i in range(begin, end):
                where[texts[i]][side].append(i)
        anchors = sorted((n[0], o[0]) for o, n in where.values() if len(o) == len(n) == 1)
        for k in _chain([o for _, o in anchors]):
            n, o = anchors[k]
            pairs[n] = o
            open_parts.append((a, o, c, n))
            a, c = o + 1, n + 1
        if anchors:
            open_parts.append((a, b, c, d))
    return pairs


def _carried(slug: str, old: list[tuple[int, str, str]], new: list[tuple[int, str, str]]) -> pd.DataFrame:
    """``old``: number, normal text, translation; ``new``: place, normal text, text; both in order."""
    before = [t for _, t, _ in old]
    pairs = aligned(before, [t for _, t, _ in new])
    used = set(pairs.values())
    left: dict[str, deque] = defaultdict(deque)
    for i, t in enumerate(before):
        if i not in used:
            left[t].append(i)
    known: dict[str, str] = {}
    for _, t, zh in old:
        if zh:
            known.setdefault(t, zh)
    number, rows = max((n for n, _, _ in old), default=0), []
    for j, (place, t, ja) in enumerate(new):
        i = pairs.get(j)
        if i is None and left[t]:
            i = left[t].popleft()
        if i is None:
            number += 1
            rows.append((slug, place, number, ja, known.get(t)))
        else:
            rows.append((slug, place, old[i][0], ja, old[i][2] or known.get(t)))
    return pd.DataFrame(rows, columns=["slug", "ord", "key_no", "ja", "zh"])


def carry_over(old: DataFrame, new: DataFrame, norm=lambda c: c) -> DataFrame:
    """``slug, ord, key_no, ja, zh`` of the ``new`` texts (slug, ord, ja) with what ``old`` (slug, key_no, ja, zh) knew. A page is
    one group, so as large as a page's list of texts. Null texts are equal to each other; a null slug is a page, too."""

    def step(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("key_no"), b.sort_values("ord")
        texts = lambda c: [None if pd.isna(x) else x for x in c]
        return _carried(key[0], list(zip(a["key_no"].tolist(), texts(a["n"]), texts(a["zh"]), strict=True)), list(zip(b["ord"].tolist(), texts(b["n"]), texts(b["ja"]), strict=True)))

    left = old.select("slug", F.col("key_no").cast("int").alias("key_no"), norm(F.col("ja")).alias("n"), "zh").groupBy("slug")
    right = new.select("slug", F.col("ord").cast("int").alias("ord"), "ja", norm(F.col("ja")).alias("n")).groupBy("slug")
    return left.cogroup(right).applyInPandas(step, CARRIED)
