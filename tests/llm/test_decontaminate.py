"""Winnowed hits against all windows of all texts."""

import hashlib
import random
import re

import pytest

from palimpsest.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plainly(docs, items, span=10):
    known = {}
    for item, text in items:
        w = split(text)
        n = min(len(w), span)
        for p in range(len(w) - n + 1 if w else 0):
            known.setdefault(tuple(w[p : p + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(k) for k in known}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in known:
                    hit |= set(range(p, p + n))
                    found |= known[tuple(w[p : p + n])]
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, w string").repartition(3)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, window string")
    out = decontaminate.decontaminate(d, b, **kw)
    return sorted(map(tuple, out.collect()), key=str)


@pytest.fixture(scope="module")
def made():
    r = random.Random(3)
    word = lambda: r.choice("the of Ab ÄB é 日本 x1 2 zz q".split()) + r.choice(["", "", "s", "t"])
    glue = lambda ws: "".join(w + r.choice([" ", ", ", "\n", "--"]) for w in ws)
    items = [(i, [word() for _ in range(r.choice([1, 3, 5, 7, 9, 10, 11, 25, 60]))]) for i in range(40)]
    items += [(40, items[7][1]), (10, items[9][1] + ["end"])]
    docs = []
    for i in range(150):
        w = [word() for _ in range(r.choice([0, 4, 30, 200]))]
        for _ in range(r.randrange(3)):
            other = r.choice(items)[1]
            a = r.randrange(len(other))
            at = r.randrange(len(w) + 1)
            w[at:at] = other[a : a + r.choice([8, 9, 10, 14, 60])]
        docs.append((i, glue(w)))
    docs += [(1, docs[5][1]), (None, docs[6][1]), (None, docs[6][1]), (900, None), (901, ""), (902, " .,- "), (903, "the " * 3000), (904, glue(w for _, ws in items for w in ws))]
    return docs, [(i, glue(w)) for i, w in items] + [(50, None), (51, ""), (52, "..."), (None, "the " * 30)]


def test_against_all_windows(spark, made):
    want = plainly(*made)
    assert run(spark, *made) == want
    assert sum(row[5] for row in want) > 20


def test_shuffled(spark, made, monkeypatch):
    """The way beyond a broadcast, and other spans."""
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    assert run(spark, *made, span=4, k=2) == plainly(*made, span=4)


def test_every_shared_span(spark):
    """A span of ten words is found wherever it begins in either text; nine words aren't enough."""
    item = [f"w{i}" for i in range(19)]
    docs = [(a, " ".join(["pad"] * a + item[a : a + 10] + ["pad"])) for a in range(10)] + [(20 + a, " ".join(item[a : a + 9])) for a in range(11)]
    got = run(spark, docs, [(1, " ".join(item))])
    assert {r[0] for r in got if r[5]} == set(range(10)) and {r[2] for r in got if r[5]} == {10}


def test_empty(spark, made):
    docs, items = made
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == plainly(docs, []) and run(spark, docs[:5], [(1, None)]) == plainly(docs[:5], [])


def test_native(spark, made):
    """No Python in any plan."""
    seen = []
    real = decontaminate.materialize

    def watch(df, name, *folders):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name, *folders)

    decontaminate.materialize = watch
    try:
        d = spark.createDataFrame(made[0], "doc_id long, text string")
        out = decontaminate.decontaminate(d, spark.createDataFrame(made[1], "item_id long, text string"))
    finally:
        decontaminate.materialize = real
    seen.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(seen) > 5 and not any(word in plan for plan in seen for word in ("Python", "Arrow", "Pandas"))
