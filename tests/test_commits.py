"""Versions of many tables, translation memory, and a site's run that publishes through them."""

import difflib
import random
import uuid

import pytest
from pyspark.sql import functions as F
from test_site import BASE, BODY, MANIFEST

from palimpsest.operators import memory
from palimpsest.plans import site
from palimpsest.sources import commits as C


@pytest.fixture
def log(spark, tmp_path):
    return C.Commits(spark, f"file://{tmp_path}/store-{uuid.uuid4().hex}")


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def held(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_versions(spark, log):
    assert log.version() == 0 and log.tables() == {}
    assert log.commit({"a": C.Change(table(spark, (1, "x"), (2, "y")), ["k"]), "b": C.Change(table(spark, (9, "whole")))}) == 1
    assert log.commit({"a": C.Change(table(spark, (2, "new"), (3, "z"), (None, "n")), ["k"])}) == 2
    assert held(log.read("a")) == [(1, "x"), (2, "new"), (3, "z"), (None, "n")] and held(log.read("a", 1)) == [(1, "x"), (2, "y")]
    assert log.commit({"a": C.Change(table(spark, (None, "m")), ["k"]), "b": C.Change(table(spark))}) == 3
    assert held(log.read("a")) == [(1, "x"), (2, "new"), (3, "z"), (None, "m")] and held(log.read("b")) == [] and held(log.read("b", 2)) == [(9, "whole")]
    assert log.sweep(keep=3) != [] and held(log.read("a", 1)) == [(1, "x"), (2, "y")] and held(log.read("a", 2)) != []  # of the merge, only what no entry names
    log.sweep(keep=1)
    assert held(log.read("a")) == [(1, "x"), (2, "new"), (3, "z"), (None, "m")]


def test_a_crash_leaves_the_old_version(spark, log, monkeypatch):
    log.commit({"a": C.Change(table(spark, (1, "x")), ["k"]), "b": C.Change(table(spark, (1, "x")))})
    real, done = C.Commits._written, []

    def second_fails(self, name, rows):
        done.append(name)
        if len(done) == 2:
            raise RuntimeError("lost")
        return real(self, name, rows)

    monkeypatch.setattr(C.Commits, "_written", second_fails)
    with pytest.raises(RuntimeError):
        log.commit({"a": C.Change(table(spark, (1, "half")), ["k"]), "b": C.Change(table(spark, (1, "half")))})
    monkeypatch.undo()
    assert log.version() == 1 and held(log.read("a")) == held(log.read("b")) == [(1, "x")]
    assert len(log.sweep()) == 1


def test_two_writers(spark, log):
    log.commit({"a": C.Change(table(spark, (1, "x")), ["k"]), "b": C.Change(table(spark, (1, "x")), ["k"])})
    seen = log.version()
    other = C.Commits(spark, log.folder)
    other.commit({"b": C.Change(table(spark, (2, "b")), ["k"])}, read=seen)
    assert log.commit({"a": C.Change(table(spark, (2, "a")), ["k"])}, read=seen) == 3  # another table: on top of it
    assert held(log.read("a")) == [(1, "x"), (2, "a")] and held(log.read("b")) == [(1, "x"), (2, "b")]
    with pytest.raises(C.Conflict):
        log.commit({"b": C.Change(table(spark, (3, "late")), ["k"])}, read=seen)
    tried = []

    def change(version):
        if not tried:
            other.commit({"b": C.Change(table(spark, (4, "first")), ["k"])})
        tried.append(version)
        return {"b": C.Change(table(spark, (5, str(log.read("b", version).count()))), ["k"])}

    C.retried(log, change)
    assert tried == [3, 4] and (5, "3") in held(log.read("b"))
    assert log._publish(log.version(), {}) is False  # an entry is never written over


def test_rows_written_do_not_grow_with_the_table(spark, log, monkeypatch):
    log.commit({"a": C.Change(spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v")), ["k"])})
    written, real = [], C.Commits._written

    def counted(self, name, rows):
        run = real(self, name, rows)
        written.append(run["rows"])
        return run

    monkeypatch.setattr(C.Commits, "_written", counted)
    for i in range(8):
        log.commit({"a": C.Change(table(spark, *((10 * i + j, f"{i}") for j in range(10))), ["k"])})
    assert sum(written) <= 10 * 8 * 5 and log.read("a").count() == 4000 and log.read("a").filter("v <> 'x'").count() == 80
    assert len(log.tables()["a"]["runs"]) <= 5


# ------------------------------------------------------------------ translation memory


def test_chain_is_longest():
    r = random.Random(1)
    for _ in range(200):
        places = r.sample(range(40), r.randrange(12))
        best = [1] * len(places)
        for i, p in enumerate(places):
            best[i] = 1 + max((best[j] for j in range(i) if places[j] < p), default=0)
        got = memory._chain(places)
        assert len(got) == max(best, default=0) and [places[i] for i in got] == sorted(places[i] for i in got) and got == sorted(got)


def test_alignment_keeps_order_and_texts():
    r = random.Random(2)
    for _ in range(100):
        old = [r.choice("abcdefghij") for _ in range(r.randrange(15))]
        new = [r.choice("abcdefghij") if r.random() < 0.3 else x for x in old if r.random() < 0.8]
        pairs = sorted(memory.aligned(old, new).items())
        assert all(new[n] == old[o] for n, o in pairs) and [o for _, o in pairs] == sorted({o for _, o in pairs})
    unique = [f"t{i}" for i in range(50)]
    other = unique[:10] + ["x"] + unique[10:30] + unique[35:]
    matched = sum(b.size for b in difflib.SequenceMatcher(None, unique, other, False).get_matching_blocks())
    assert len(memory.aligned(unique, other)) == matched == 45


def test_carry_over(spark):
    old = [("p", 1, "a", "A"), ("p", 2, "same", "first"), ("p", 3, "b", "B"), ("p", 4, "same", "second"), ("p", 5, "moved", "M"), ("p", 7, "gone", "G"), ("q", 1, "x", ""), ("old page", 1, "x", "X")]
    new = [("p", 0, "moved"), ("p", 1, "a"), ("p", 2, "inserted"), ("p", 3, "same"), ("p", 4, "b"), ("p", 5, "same"), ("p", 6, "same"), ("q", 0, "x"), ("new", 0, "y"), ("new", 1, None)]
    got = memory.carry_over(spark.createDataFrame(old, "slug string, key_no int, ja string, zh string"), spark.createDataFrame(new, "slug string, ord int, ja string"))
    assert sorted((r.slug, r.ord, r.key_no, r.zh) for r in got.collect()) == [
        ("new", 0, 1, None), ("new", 1, 2, None),
        ("p", 0, 5, "M"), ("p", 1, 1, "A"), ("p", 2, 8, None), ("p", 3, 2, "first"), ("p", 4, 3, "B"), ("p", 5, 4, "second"), ("p", 6, 9, "first"),
        ("q", 0, 1, None),
    ]


# ------------------------------------------------------------------ a run


def test_run_publishes_one_version(spark, log):
    pages = [("a", "watch", "info"), ("b", "watch", "info")]
    log.commit({"registry": C.Change(spark.createDataFrame(pages, "name string, mode string, category string")), "manifest": C.Change(spark.createDataFrame([], MANIFEST), ["name"])})
    recent = spark.createDataFrame([("a",), ("b",)], "name string")
    served, asked = {"a": BODY.format("一</p><p>二</p><p>三"), "b": BODY.format("本文")}, []

    def fetch(urls):
        asked.append(sorted(r.url[-1] for r in urls.collect()))
        name = F.substring_index("url", "?", -1)
        content = F.try_element_at(F.create_map(*[F.lit(x) for p in served.items() for x in p]), name).cast("binary")
        return urls.select("url", F.lit(200).alias("status"), content.alias("content"), F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("string").alias("error"))

    def update(at, **changed):
        served.update(changed)
        current = spark.createDataFrame([(n, at if n in changed or at == "1" else "1") for n in "ab"], "name string, wiki_last_modified string")
        return site.run(log, recent, current, fetch, BASE, at, lambda c: c)

    first = update("1")
    assert first == 2 and {"registry", "manifest", "snapshots", "fragments", "keys"} == set(log.tables())
    assert held(site.open_items(log)) == [("a", 1, "一"), ("a", 2, "二"), ("a", 3, "三"), ("b", 1, "本文")]
    site.filled(log, spark.createDataFrame([("a", 2, "two"), ("b", 1, "text"), ("b", 9, "nothing")], "name string, key_no int, zh string"))
    manifest = log.read("manifest").withColumn("wiki_last_modified", F.lit("1"))
    log.commit({"manifest": C.Change(manifest, ["name"])})
    update("2", a=BODY.format("新</p><p>二</p><p>一"))
    assert asked[-1] == ["a"]
    keys = {(r.name, r.ja): (r.key_no, r.zh) for r in log.read("keys").select("name", F.inline("keys")).collect()}
    assert keys == {("a", "新"): (4, None), ("a", "二"): (2, "two"), ("a", "一"): (1, None), ("b", "本文"): (1, "text")}
    assert held(site.open_items(log, first)) == [("a", 1, "一"), ("a", 2, "二"), ("a", 3, "三"), ("b", 1, "本文")]  # the old version is still there
