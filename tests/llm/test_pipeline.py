"""Each stage of the pipeline against a plain version of it on its own input, and its edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import common, mixing
from palimpsest.llm.queries import tokenizer_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(400)]


def made(seed=3):
    """Documents with lines that repeat, near copies, exact copies, nulls, blanks and repeated ids."""
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    common_lines = [line(12) for _ in range(4)]
    texts = []
    for _ in range(40):
        text = "\n".join(rng.choice(common_lines) if rng.random() < 0.3 else line(rng.randrange(3, 40)) for _ in range(rng.randrange(1, 5)))
        texts.append(text)
        if rng.random() < 0.4:
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            texts += [" ".join(words), text]
    rows = [(i, t, "en", rng.choice("abc"), len(t)) for i, t in enumerate(texts)]
    return rows + [(500, None, "en", "a", None), (501, "", None, None, 0), (502, " \t", "en", None, 2), (503, line(60), "en", None, 9), (503, line(50), "en", "b", 9), (None, line(30), "en", "c", 9), (None, line(30), "en", "c", 9)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), SCHEMA)


def bag(rows):
    return Counter(map(tuple, rows))


def test_lines(spark, docs, sf):
    rows = made()
    key = lambda x: x.strip(" \t\n\v\f\r").lower()
    holders = defaultdict(set)
    for d, t, *_ in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(d if d is not None else ("no id", t))
    drop = {k: max((d for d in v if isinstance(d, int)), default=None) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    assert drop
    want = []
    for d, t, lang, source, _ in rows:
        kept = "\n".join(x for x in (t or "").split("\n") if key(x) not in drop or drop[key(x)] == d)
        want.append((d, kept, lang, source, len(kept)))
    assert bag(corpus_pipeline.drop_lines(spark, docs, sf).collect()) == bag(want)


def test_near_duplicates(spark, docs, sf):
    rows = made()

    def shingles(t):
        w = re.findall(r"[^ \t-\r]+", (t or "").lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i])
    want = set()
    for g in groups.values():
        first = min((r[0] for r in g if r[0] is not None), default=None)
        want |= {(r[0], r[1]) for r in g if r[0] == first}
    out = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()]
    assert {(r[0], r[1]) for r in out} == want and len(out) == len({(r[0], r[1]) for r in out})
    assert len(out) < len(rows) - 10


def test_mix(spark, docs, sf):
    rows, out = made(), [tuple(r) for r in corpus_pipeline.mix_sources(spark, docs, sf).collect()]
    size = lambda t: len(re.findall(r"[^ \t-\r]+", t or ""))
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    names = sorted(by_source, key=lambda s: (s is None, s))
    total, weight = {s: sum(size(r[1]) for r in by_source[s]) for s in names}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(total.values())
    while True:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if 3 * total[s] <= share * weight[s]}
        if not full:
            break
        target |= {s: 3.0 * total[s] for s in full}
        left -= sum(3 * total[s] for s in full)
        free -= full
    target |= {s: left / sum(weight[x] for x in free) * weight[s] for s in free}
    want = Counter()
    for s in names:
        words, at = int(target[s] + 1e-9), 0
        order = sorted(by_source[s], key=lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]} {r[1] or ''}".encode()).hexdigest())
        while at < words:
            for r in order:
                take = min(size(r[1]), words - at)
                if take:
                    text = mixing.first_words(r[1], take) if take < size(r[1]) else r[1]
                    want[(r[0], text, r[2], r[3], len(text))] += 1
                at += take
    assert bag(out) == want


def test_packs_every_token_once(spark, docs, sf):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_files()[0])
    want = sorted((str(d), len(plain.encode(t or "", add_special_tokens=False).ids) + 1) for d, t, *_ in made())
    got = defaultdict(list)
    for r in corpus_pipeline.pack_windows(spark, docs, sf).collect():
        got[str(r.doc_id), r.doc_tokens].append((r.start, r.length))
    assert sum(n for _, n in want) == sum(n for v in got.values() for _, n in v)
    assert {k for k in got} == set(want)


def test_toxic_documents_go(spark, sf):
    rows = [(i, f"you are a filthy scumbag number {i}" if i % 4 == 0 else f"all is well in house number {i}", "en", "a", 30) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = common.table(spark, sf, "labels").limit(0).unionByName(spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 150)], "doc_id long, quality int, toxic int").select([F.col(c).cast(k).alias(c) for c, k in common.table(spark, sf, "labels").dtypes]))
    path = f"{common.shared_dir(spark)}/toxic-test"
    labels.write.mode("overwrite").parquet(f"{path}/labels.parquet")
    assert bag(corpus_pipeline.reject_toxic(spark, docs, path).collect()) == bag(r for r in rows if r[0] % 4)


@pytest.mark.parametrize("empty", [True, False])
def test_extra_columns_and_empty_tables(spark, docs, sf, empty):
    """Names of the operators' own columns come through every stage; empty tables do, too."""
    names = ["score", "kept_text", "_column0", "_doc", "row", "low", "copy", "part", "position", "node", "carried", "predicted"]
    docs = docs.select("*", *(F.concat(F.lit(f"{n}-"), F.coalesce(F.col("source"), F.lit(""))).alias(n) for n in names))
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf), f"edge-{name}")
        rows = docs.collect()
        assert docs.columns[5:] == names and bool(rows) != empty
        assert all(r[n] == f"{n}-{r['source'] or ''}" for r in rows for n in names)
    assert bool(corpus_pipeline.STAGES[-1][1](spark, docs, sf).count()) != empty
