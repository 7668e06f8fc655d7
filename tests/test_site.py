"""The site's plans from end to end, and reports."""

import pytest
from pyspark.sql import functions as F

from palimpsest.plans import registry, reports, site
from palimpsest.sources import web

BASE = "https://wiki.example/index.php"
BODY = '<div id="body"><p>{}</p></div><hr class="full_hr">'
MANIFEST = "name string, url string, sha256 string, status string, wiki_last_modified string, fetched_at string, error string, attempts int, parsed_sha256 string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_discover(spark):
    menu = spark.createDataFrame([(1, '<a href="?News">n</a><a href="?Guide">g</a>')], "page_id int, html string")
    cells = spark.createDataFrame([("l", 0, "heading", "SSR", None), ("l", 1, "link", "x", "?Hero"), ("l", 2, "link", "x", "?News")], "page string, ord int, kind string, text string, href string")
    wanted = spark.createDataFrame([(0, "news", "info"), (1, "Gone", "info")], "ord int, name string, category string")
    known = spark.createDataFrame([(0, "Old", "old", "x", "static", None), (1, "Hero", "h", "x", "static", None)], "ord int, name string, slug string, category string, mode string, rarity string")
    out = rows(site.discover(menu, cells, wanted, known, BASE).orderBy("ord"), "name", "category", "mode", "rarity")
    assert out == [("Gone", "info", "watch", None), ("Hero", "character-detail", "static", "SSR"), ("News", "character-detail", "static", "SSR"), ("Old", "x", "static", None)]


def test_update(spark, tmp_path):
    pages = spark.createDataFrame([("a", "watch", "info"), ("b", "watch", "character-detail"), ("c", "watch", "info"), ("d", "watch", "info")], "name string, mode string, category string")
    manifest = spark.createDataFrame([("a", f"{BASE}?a", "old", "ok", "1", "t0", None, 0, "old"), ("c", f"{BASE}?c", "same", "ok", "1", "t0", None, 0, "same"), ("d", f"{BASE}?d", "kept", "ok", "1", "t0", None, 0, "kept")], MANIFEST)
    recent = spark.createDataFrame([(n,) for n in "abcd"], "name string")
    current = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "1"), ("d", "2")], "name string, wiki_last_modified string")
    served = {"a": BODY.format("新しい"), "b": BODY.format("本文") + "Last-modified: 2024-01-02 (火) 03:04:05"}

    def fetch(asked):
        name = F.substring_index("url", "?", -1)
        content = F.try_element_at(F.create_map(*[F.lit(x) for p in served.items() for x in p]), name).cast("binary")
        return asked.select("url", F.lit(200).alias("status"), content.alias("content"), F.lit(None).cast("string").alias("last_modified"), F.when(content.isNull(), "status 500").alias("error"))

    out = site.update(recent, pages, manifest, current, fetch, BASE, "t1")
    assert rows(out.manifest, "name", "status", "attempts", "fetched_at") == [("a", "ok", 0, "t1"), ("b", "ok", 0, "t1"), ("c", "ok", 0, "t0"), ("d", "error", 1, "t1")]
    held = {r["name"]: r for r in out.manifest.collect()}
    assert held["d"]["sha256"] == "kept" and held["a"]["sha256"] == held["a"]["parsed_sha256"] != "old" and held["b"]["wiki_last_modified"] == "2024-01-02 03:04:05"
    assert rows(out.parsed.fragments, "name", "html") == [("a", "<p>新しい</p>"), ("b", "<p>本文</p>")] and out.entities_changed
    out.parsed.write(f"file://{tmp_path}/parsed")
    assert spark.read.parquet(f"file://{tmp_path}/parsed/chunks").select("name", "text", "translate").count() == 2
    assert rows(spark.read.parquet(f"file://{tmp_path}/parsed/fragments"), "name") == [("a",), ("b",)]
    again = site.update(recent, pages, out.manifest, current.filter("name <> 'd'").unionByName(spark.createDataFrame([("d", "1")], "name string, wiki_last_modified string")), fetch, BASE, "t2")
    assert {r["name"]: r["attempts"] for r in again.manifest.collect()}["d"] == 2  # tried again though its time is the known one


def test_fetch_all(spark, monkeypatch):
    got = list(web._fetch_in_turn(iter([])))
    assert got == []
    import pyarrow as pa

    monkeypatch.setattr(web, "fetch", lambda u: (u, 200, b"x", None, None))
    (one,) = web._fetch_in_turn(iter([pa.RecordBatch.from_pydict({"url": ["https://a/"]})]))
    assert one.to_pylist() == [{"url": "https://a/", "status": 200, "content": b"x", "last_modified": None, "error": None}]
    pages = spark.createDataFrame([(f"https://h{i % 3}/{i}",) for i in range(9)], "url string")
    plan = web.fetch_all(pages)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(host" in plan and plan.count("MapInArrow") >= 1


def test_tree(spark):
    edges = [("r", "b", 2), ("r", "a", 1), ("a", "a2", 2), ("a", "a1", 1)] + [(f"c{i}", f"c{i + 1}", 0) for i in range(8)] + [("b", "c0", 0), ("elsewhere", "x", 0)]
    df = spark.createDataFrame(edges, "parent string, node string, ord int")
    out = [(r.node, r.depth) for r in registry.tree(df, "r").orderBy("sort").collect()]
    assert out == [("a", 0), ("a1", 1), ("a2", 1), ("b", 0)] + [(f"c{i}", i + 1) for i in range(9)]
    with pytest.raises(ValueError, match="below itself"):
        registry.tree(spark.createDataFrame([*edges, ("c3", "c1", 1)], "parent string, node string, ord int"), "r")


def test_signals(spark):
    records = spark.createDataFrame([("A", "SSR", "同盟同盟同盟x", None, "ガチャ", ["t1", "t2"], 5, None), ("B", "R", "", "近战", "", [], 7, 3)], "name string, rarity string, faction string, atk_type string, obtain string, tags array<string>, hp int, atk int")
    out = rows(reports.signals(records, ["hp", "atk"], 1), "section", "key", "rank", "name", "value")
    assert ("table", "SSR", None, "A", "同盟同盟同盟 | ? | 5/- | 卡池 | t1,t2") in out and ("table", "R", None, "B", "? | 近战 | 7/3 | ? | -") in out
    assert ("leaders", "hp", 1, "B", "7") in out and ("leaders", "atk", 1, "B", "3") in out and len([r for r in out if r[0] == "leaders"]) == 2
    assert ("tags", "t1", None, "A", "SSR") in out and ("obtained", "R", None, "?", "1") in out and ("obtained", "SSR", None, "卡池", "1") in out
