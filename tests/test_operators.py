"""Operators, sources and plans on literal rows, against plain Python."""

import random

import pytest
import yaml
from pyspark.sql import functions as F

from palimpsest.functions import features as X
from palimpsest.functions import text
from palimpsest.functions.python import norm
from palimpsest.operators import joins, order, store, teams
from palimpsest.plans import entities, fidelity, registry
from palimpsest.sources import files, web


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_first_and_last_do_not_depend_on_placement(spark):
    data = [(k, o, f"v{o}") for k in range(5) for o in range(20)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, o int, v string").repartition(seed + 2)
        assert rows(joins.first_by(df, ["k"], ["o"]), "k", "v") == [(k, "v0") for k in range(5)]
        assert rows(joins.first_by(df, ["k"], ["o"], last=True), "k", "v") == [(k, "v19") for k in range(5)]


def test_layered_and_two_level(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    one = spark.createDataFrame([("a", "1"), ("b", "")], "key string, value string")
    two = spark.createDataFrame([("a", "2"), ("b", "3")], "key string, value string")
    assert rows(joins.layered_lookup(df, "k", [one, two]), "k", "value") == sorted([("a", "1"), ("b", "3"), ("c", None), (None, None)], key=str)
    table = spark.createDataFrame([("a b", "ab", "x", 1), ("ab", "ab", "y", 0)], "exact string, loose string, value string, ord int")
    df = spark.createDataFrame([("a b", "ab"), ("a  b", "ab"), ("z", "z")], "e string, l string")
    assert rows(joins.two_level_lookup(df, "e", "l", table), "e", "value") == [("a  b", "y"), ("a b", "x"), ("z", None)]


def test_positional_join_needs_equal_counts(spark):
    a = spark.createDataFrame([("p", 1, "a"), ("p", 5, "b"), ("q", 1, "c")], "g string, o int, x string")
    b = spark.createDataFrame([("p", 9, "A"), ("p", 3, "B"), ("q", 1, "C"), ("q", 2, "D")], "g string, o int, y string")
    assert rows(joins.positional_join(a, b, "g", "o"), "g", "x", "y") == [("p", "a", "B"), ("p", "b", "A")]


def test_prefix_join(spark):
    names = spark.createDataFrame([("翼竜",), ("翼竜剣聖",), ("a",), ("a b",)], "name string")
    df = spark.createDataFrame([("翼竜剣聖 20秒",), ("翼竜剣",), ("翼竜（x）",), ("a b c",), ("ab",), ("a",), ("",)], "t string")
    assert dict(rows(joins.prefix_join(df, "t", names), "t", "prefix")) == {"翼竜剣聖 20秒": "翼竜剣聖", "翼竜剣": None, "翼竜（x）": "翼竜", "a b c": "a b", "ab": None, "a": "a", "": None}


def test_as_of_level(spark):
    df = spark.createDataFrame([("a", 80, 0, "x"), ("a", 100, 1, "y"), ("a", 100, 2, "z"), ("a", 120, 3, "w"), ("b", 110, 0, "p"), ("b", 120, 1, "q")], "k string, lv int, o int, v string")
    assert rows(joins.as_of_level(df, ["k"], "lv", "o", 100), "k", "v") == [("a", "z"), ("b", "q")]


def test_changed_is_null_safe(spark):
    new = spark.createDataFrame([("a", "1"), ("b", None), ("c", "2"), ("d", None), ("e", "3")], "n string, s string")
    old = spark.createDataFrame([("a", "1"), ("b", None), ("c", "1"), ("e", None)], "n string, s string")
    assert rows(joins.changed(new, old, "n", "s"), "n") == [("c",), ("d",), ("e",)]


def test_nearest_ancestor(spark):
    nodes = spark.createDataFrame([(1, 0, -1, "a"), (1, 1, 0, "x"), (1, 2, 1, "b"), (1, 3, 2, "x"), (1, 4, 3, "x"), (2, 0, -1, "x")], "page int, node int, parent int, tag string")
    assert rows(joins.nearest_ancestor(nodes, F.col("tag").isin("a", "b")), "page", "node", "ancestor") == [(1, 1, 0), (1, 2, 0), (1, 3, 2), (1, 4, 2)]


def test_order_operators(spark):
    df = spark.createDataFrame([("g", i, s, v) for i, (s, v) in enumerate([("a", None), ("a", 1), ("b", None), ("a", None), ("a", 2)])], "g string, o int, s string, v int")
    assert [r[1] for r in rows(order.carry_forward(df, "g", ["o"], F.col("v"), "c"), "o", "c")] == [None, 1, 1, 1, 2]
    assert [r[1] for r in rows(order.islands(df, "g", ["o"], "s"), "o", "island")] == [1, 1, 2, 3, 3]
    assert rows(order.unique_names(df, "s", ["o"]), "o", "slug") == [(0, "a"), (1, "a-1"), (2, "b"), (3, "a-2"), (4, "a-3")]
    marks = order.spans(df.filter("s = 'a'"), "g", "o", F.lit(9))
    assert rows(marks, "o", "until") == [(0, 1), (1, 3), (3, 4), (4, 9)]
    cells = "cells array<struct<h: boolean, t: string>>"
    line = spark.createDataFrame([([(True, "A"), (False, "1"), (False, "skip"), (True, "B"), (True, "2"), (True, ""), (False, "x"), (True, "A"), (False, "3"), (True, "open")],)], cells)
    assert line.select(order.label_pairs(F.col("cells"))).first()[0] == {"A": "3", "B": "2"}
    groups = order.ordered_groups(df, "s", ["b", "none", "a"], "o", "o")
    assert [tuple(r) for r in groups.orderBy("position").select("group_name", "members").collect()] == [("b", [2]), ("none", []), ("a", [0, 1, 3, 4])]


@pytest.mark.parametrize("values", [[5.0, 1.0, 5.0, -2.0, None, 3.5], [1.0] * 5, [], [None], [0.0] * 3 + [1e9]])
def test_ranks_in_parts(spark, values):
    df = spark.createDataFrame([(f"n{i}", v) for i, v in enumerate(values)], "n string, v double")
    got = {r.n: r["rank"] for r in order.ranked_in_parts(df, "v", "n").collect()}
    want = sorted(range(len(values)), key=lambda i: (values[i] is None, -(values[i] or 0), f"n{i}"))
    assert got == {f"n{i}": k + 1 for k, i in enumerate(want)}


def squeeze(c):
    return text.squeeze(c)


def test_store(spark):
    keys = spark.createDataFrame([("p", 1, "一つ目の文です。", ""), ("p", 2, "二つ目の文です。", None), ("p", 3, "三つ目", "three"), ("p", 4, "既知の長い見出しです。", ""), ("q", 1, "一つ目の文です。", ""), ("p", 5, "第3期", "")], "slug string, key_no int, ja string, zh string")
    blocks = spark.createDataFrame([("p", 1, "二つ目の文です。三つ目", "", [2, 3]), ("q", 1, "x", "done", [1])], "slug string, blk_no int, ja string, zh string, keys array<int>")
    assert rows(store.coverage(keys, blocks), "slug", "done", "total") == [("p", 1, 5), ("q", 1, 1)]
    known = spark.createDataFrame([("既知の長い見出しです。",)], "key string")
    work = store.worklist(keys, blocks, known, norm)
    assert rows(work, "slug", "kind", "id", "n") == [("p", "blk", 1, 1), ("p", "key", 1, 2), ("q", "key", 1, 1)]
    dup = store.deduplicated(keys.select("slug", F.lit("key").alias("kind"), F.col("key_no").alias("id"), "ja"), norm, ["slug", "id"])
    assert rows(dup, "ja", "occurrences") == [("一つ目の文です。", 2)]
    items = keys.select("slug", F.lit("key").alias("kind"), F.col("key_no").alias("id"), "ja")
    assert rows(store.places(items, dup, norm), "slug", "kind", "id") == [("p", "key", 1), ("q", "key", 1)]
    done = spark.createDataFrame([("一つ目の文です。", "第一句。", 1), ("一つ目の文です。", "第一句！", 2), ("二つ目の文です。", "二つ目の文です。", 3), ("第3期", "第3期", 4)], "ja string, zh string, ord int")
    once = store.apply_translations(keys, done, norm)
    assert rows(once, "slug", "key_no", "zh") == sorted([("p", 1, "第一句！"), ("p", 2, None), ("p", 3, "three"), ("p", 4, ""), ("p", 5, "第3期"), ("q", 1, "第一句！")], key=str)
    assert rows(store.apply_translations(once, done, norm), "slug", "key_no", "zh") == rows(once, "slug", "key_no", "zh")
    items = keys.select("slug", F.col("key_no").alias("id"), "ja", "zh")
    lines = spark.createDataFrame([("q", 1, "Q"), ("p", 1, "only one")], "slug string, n int, line string")
    assert rows(store.fill_by_position(items, lines).filter("zh <> ''"), "slug", "id", "zh") == [("p", 3, "three"), ("q", 1, "Q")]
    back_keys, back_blocks = files.store_rows(store_files(store_json(keys, blocks)))
    assert rows(back_keys, "slug", "key_no", "ja") == rows(keys, "slug", "key_no", "ja")
    assert rows(back_blocks, "slug", "blk_no", "keys") == rows(blocks, "slug", "blk_no", "keys")


def store_json(keys, blocks):
    return files.store_json(keys, blocks)


def store_files(df):
    return df.select(F.concat(F.lit("/x/"), "slug", F.lit(".json")).alias("path"), F.col("json").alias("text"))


def test_corrections_and_render(spark):
    entries = spark.createDataFrame([("a", 1, "剣", "古剑"), ("b", 1, "剣", "旧剑"), ("c", 1, "剣", "无关"), ("d", 1, "剣", "剑")], "slug string, ord int, ja string, zh string")
    canonical = spark.createDataFrame([("剣", "剑")], "key string, value string")
    assert rows(store.corrections(entries, canonical, norm), "wrong", "right") == [("古剑", "剑"), ("旧剑", "剑")]
    keys = spark.createDataFrame([("p", 1, "剣", "x"), ("p", 2, "第3期", ""), ("p", 3, "最終更新 2024", "x"), ("p", 4, "文", "句"), ("p", 5, "未", "")], "slug string, key_no int, ja string, zh string")
    out = store.rendered(keys, [canonical], norm, text.is_metadata, text.is_numeric_template)
    assert dict(rows(out, "key_no", "rendered")) == {1: "剑", 2: "第3期", 3: "", 4: "句", 5: "未"}


def test_control_files(spark):
    content = yaml.safe_dump({"version": 1, "pages": [{"name": "B", "slug": "b", "category": "misc", "mode": None}, {"name": "A", "slug": "a", "category": "guide", "mode": "watch", "rarity": "SR"}]}, allow_unicode=True)
    pages = files.read_registry(spark, content)
    assert rows(pages, "ord", "name", "mode") == [(0, "B", None), (1, "A", "watch")]
    assert yaml.safe_load(files.registry_yaml(pages))["pages"][1] == {"name": "A", "slug": "a", "category": "guide", "mode": "watch", "rarity": "SR"}
    plan = files.read_plan(spark, yaml.safe_dump({"planned": ["x ", {"page": "y", "group": "g"}, {"group": "none"}]}))
    assert rows(plan, "ord", "name", "group") == [(0, "x", None), (1, "y", "g")]
    glossary = files.read_glossary(spark, {"names": yaml.safe_dump({"names": {"剣": "剑", "同": "同", "空": "", "城": {"name_zh": "城堡"}}}, allow_unicode=True)})
    assert rows(glossary, "layer", "ja", "zh") == [("names", "剣", "剑"), ("names", "城", "城堡")]


def test_worklist_files(spark):
    body = "head\n# MAP A=page-a B=page/b\n===A===\n[1] one\nmore\n# note\n[2] two\n===B===\n[1] other\n"
    texts = spark.createDataFrame([("f.txt", body)], "path string, text string")
    assert rows(files.label_map(texts), "label", "slug") == [("A", "page-a"), ("B", "page/b")]
    sections = files.label_sections(texts)
    entries = files.numbered_entries(sections.select(F.col("label").alias("path"), F.col("body").alias("text")))
    assert rows(entries, "path", "mark", "body") == [("A", "1", "one\nmore"), ("A", "2", "two"), ("B", "1", "other")]
    items = spark.createDataFrame([("page-a", 1, "one"), ("page-a", 2, "two"), ("z", 1, "other")], "slug string, n int, ja string")
    made = files.worklist_text(items).first()[0]
    assert made == "# MAP A=page-a B=z\n===A===\n[1] one\n[2] two\n===B===\n[1] other\n"
    tabs = spark.createDataFrame([("a", "10\tx\n\n# c\n2\ty"), ("b", "か\t1\nx")], "path string, text string")
    assert rows(files.tab_lines(tabs), "path", "first", "second", "kind") == sorted([("a", "10", "x", "numeric"), ("a", "2", "y", "numeric"), ("b", "か", "1", "ja"), ("b", "x", None, "ja")], key=str)
    parts = spark.createDataFrame([("/x/p-2.txt",), ("/x/p-10.txt",), ("/x/p.txt",), ("/x/p-a.txt",)], "path string")
    assert rows(files.split_files(parts), "base", "part") == sorted([("p", 2), ("p", 10), ("p", 0), ("p-a", 0)], key=str)


def test_feed_and_markdown(spark):
    feed = "<rdf><item a='b'><title>%E3%81%82</title><dc:date>2024-01-02</dc:date></item><item><title> <b>x</b> </title>\n<dc:date>d</dc:date></item><item><title></title><dc:date>e</dc:date></item></rdf>"
    assert rows(files.feed_items(spark.createDataFrame([(feed,)], "text string")), "name", "date") == [("x", "d"), ("あ", "2024-01-02")]
    page = files.markdown(spark.createDataFrame([("s", 'a "b"', "<p>x</p> <p>y</p>")], "slug string, title string, html string")).first()
    assert page.path == "s.md" and 'title: "a \\"b\\""' in page.body and "hidden>x y</div>" in page.body


def test_polite_fetch(spark):
    import urllib.error

    waits, answers = [], iter([urllib.error.HTTPError("u", 503, "", None, None), OSError("net"), (200, b"ok", "m")])

    def get(_):
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    assert web.fetch("u", get, waits.append) == ("u", 200, b"ok", "m", None) and waits[1:] == [10.0, 20.0] and 2 <= waits[0] <= 4
    assert web.fetch("u", lambda _: (_ for _ in ()).throw(urllib.error.HTTPError("u", 404, "", None, None)), lambda _: None)[1] == 404
    assert len(web.PoliteReader(["http://a/1", "http://b/1", "http://a/2"]).partitions()) == 2
    spark.dataSource.register(web.PoliteHttp)
    assert spark.read.format("polite_http").option("urls", "").load().columns == ["url", "status", "content", "last_modified", "error"]
    pages = spark.createDataFrame([("a", "watch"), ("b", "watch"), ("c", "static")], "name string, mode string")
    have = spark.createDataFrame([("a",)], "name string")
    assert rows(web.to_fetch(pages, have, "watch"), "name") == [("b",)] and web.to_fetch(pages, have, force=True).count() == 3


BASE = "https://w.example/"


def test_registry_plans(spark):
    pages = spark.createDataFrame([(1, '<a href="?A">first</a><a href="?A">second</a><a href="?B+C">b</a><a href="?cmd=x">c</a>')], "page_id int, html string")
    links = registry.page_links(pages, BASE)
    assert rows(links, "name", "label") == [("A", "first"), ("B C", "b")]
    known = spark.createDataFrame([("A", "page-a")], "name string, slug string")
    assert rows(registry.resolve(links, known, BASE), "name", "target") == [("A", "__ROUTE__/page-a.html"), ("B C", BASE + "?B%20C")]
    wanted = spark.createDataFrame([(0, "b・c", "misc"), (1, "X", "misc"), (2, "Gone", "guide")], "ord int, name string, category string")
    nav = registry.navigation(wanted, links, {"X": "A"}, {"X": "ex"})
    assert [r[:2] for r in rows(nav, "name", "slug")] == [("A", "ex"), ("B C", text_slug("B C")), ("Gone", text_slug("Gone"))]
    cells = spark.createDataFrame([(1, 0, "heading", "SSR edit", None), (1, 1, "link", "", "?One"), (1, 2, "heading", "other", None), (1, 3, "link", "", "?Two"), (1, 4, "heading", "R", None), (1, 5, "link", "", "?One"), (1, 6, "link", "", "?Three"), (1, 7, "link", "", "?x掲示板")], "page int, ord int, kind string, text string, href string")
    assert rows(registry.entity_rows(cells, BASE), "name", "rarity") == [("One", "SSR"), ("Three", "R")]


def text_slug(name):
    import hashlib

    return "p-" + hashlib.md5(name.encode()).hexdigest()[:10]


def test_updates(spark):
    reg = spark.createDataFrame([("a", "watch"), ("b", "watch"), ("c", "static"), ("d", "watch"), ("e", "watch"), ("f", "watch")], "name string, mode string")
    manifest = spark.createDataFrame([("a", "ok", "1", "x", "x", 0), ("b", "missing", "1", "y", "x", 3), ("e", "ok", None, "z", None, 0), ("f", "error", None, None, None, 2)], "name string, status string, wiki_last_modified string, sha256 string, parsed_sha256 string, attempts int")
    recent = spark.createDataFrame([(n,) for n in "abcdef"], "name string")
    now = spark.createDataFrame([("a", "2"), ("b", "2"), ("c", "2"), ("d", "1"), ("e", None), ("f", None)], "name string, wiki_last_modified string")
    assert rows(registry.incremental_update(recent, reg, manifest, now), "name") == [("a",), ("d",), ("f",)]  # b was given up, f is tried again
    assert rows(registry.incremental_update(recent, reg, manifest, now, 4), "name") == [("a",), ("b",), ("d",), ("f",)]
    news = spark.createDataFrame([("a", "error"), ("b", "ok"), ("f", "missing"), ("g", "error")], "name string, status string")
    assert rows(registry.counted_attempts(manifest, news), "name", "attempts") == [("a", 1), ("b", 0), ("f", 3), ("g", 1)]
    assert rows(registry.to_parse(manifest), "name") == [("e",)]
    planned = spark.createDataFrame([("x",), ("y",)], "name string")
    done = spark.createDataFrame([("x", True), ("y", False)], "name string, ok boolean")
    assert rows(registry.drain_queue(planned, done), "name") == [("y",)]
    m = spark.createDataFrame([("a", "2024-01-01", "1"), ("b", "2024-01-01", "1")], "name string, fetched_at string, sha256 string")
    n = spark.createDataFrame([("a", "2024-01-02", "2")], "name string, fetched_at string, sha256 string")
    assert rows(registry.manifest_upsert(m, n), "name", "sha256") == [("a", "2"), ("b", "1")]
    full = spark.createDataFrame([(0, "N2", "s2", "misc", None), (1, "N1", "s1", "guide", "u"), (2, "N0", "s0", "misc", None)], "ord int, name string, slug string, category string, url string")
    held = spark.createDataFrame([("N2", "url2", "t", "f", "ok")], "name string, url string, wiki_last_modified string, fetched_at string, status string")
    times = registry.page_times(full, held, ["guide", "misc"], ["s2"])
    assert [(r.name, r.url) for r in times.collect()] == [("N1", "u"), ("N2", "url2"), ("N0", None)]
    plan = registry.mirror_plan(full, text.category_of(F.col("category"), {"misc": "M", "guide": "G"}, "O"), ["G", "O", "M"], BASE)
    assert [(r.group_name, [m.name for m in r.members]) for r in plan.orderBy("position").collect()] == [("G", ["N1"]), ("O", []), ("M", ["N2", "N0"])]


def test_fidelity(spark):
    a = spark.createDataFrame([(1, "same text"), (2, "quite different"), (3, "gone")], "k int, t string")
    b = spark.createDataFrame([(1, "same text"), (2, "0123456789"), (4, "new")], "k int, t string")
    out = fidelity.compare(a, b, "k", "t")
    assert rows(out, "k", "side", "low") == [(1, "both", False), (2, "both", True), (3, "source", True), (4, "parsed", True)]
    total = fidelity.summary(out)
    assert total.first().pages == 4 and total.first().compared == 2
    with pytest.raises(ValueError, match="3 of 4"):
        fidelity.require(total, 0.9)


CELL = "struct<h: boolean, t: string, tr: boolean, zh: string, cs: int, rs: int>"


def cell(t, h=False, zh=None):
    return (h, t, None, zh, None, None)


def test_flat_records(spark):
    sections = {
        "プロフィール": ("p", [[cell("所属勢力", True), cell("勢力", zh="阵营")], [cell("通常攻撃", True), cell("近", zh="近距离（物理）")]]),
        "基本ステータス": ("b", [[cell("レベル", True), cell("攻撃力", True), cell("魔法力", True)], [cell("Lv80"), cell("1,000"), cell("5")], [cell("100"), cell("1,200"), cell("-")], [cell("120"), cell("1,500"), cell("9")]]),
        "詳細ステータス": ("d", [[cell("連撃率", True, "连击率"), cell("40%"), cell("行動速度", True, "行动速度"), cell("5sec")], [cell("必殺充填量", True, "必杀充能效率"), cell("7.5%")]]),
        "必殺技": ("u", [[cell("名称", True), cell("効果", True)], [cell("技"), cell("敵全体に3倍", zh="对全体")]]),
        "入手方法": ("o", [[cell("方法", True)], [cell("ガチャ限定")]]),
    }
    df = spark.createDataFrame([("n", "SSR", sections), ("m", "R", {})], f"name string, rarity string, sections map<string, struct<label: string, rows: array<array<{CELL}>>>>")
    out = {r.name: r for r in entities.flat_records(df).collect()}
    n = out["n"]
    assert (n.faction, n.atk_type, n.level, n.stats["攻撃力"], n.stats["魔法力"], n.obtain) == ("阵营", "近战物理", 100, 1200, None, "ガチャ限定")
    assert tuple(n.combat) == (40.0, 5.0, 7.5) and [tuple(u) for u in n.ultimates] == [("技", "技", "敵全体に3倍", "对全体")] and n.uniques is None
    assert out["m"].stats is None and out["m"].faction == ""
    kit = entities.kits(entities.flat_records(df).withColumn("attack", F.try_element_at("stats", F.lit("攻撃力"))).withColumn("magic", F.try_element_at("stats", F.lit("魔法力"))))
    k = {r.name: r for r in kit.collect()}
    assert (k["n"].ult_mult, k["n"].aoe, k["n"].combo_rate, k["n"].base) == (3.0, True, 0.4, 1200.0) and (k["m"].action_speed, k["m"].ult_charge, k["m"].ult_mult) == (5.0, 7.5, 1.0)
    top = {r.name: r for r in entities.scored(kit).collect()}
    assert top["n"]["rank"] == 1 and top["n"].strength == pytest.approx(70.0)
    assert rows(entities.classified(kit), "name", "primary", "sub") == [("m", "其他", ""), ("n", "输出", "全体")]
    assert entities.top_list(entities.scored(kit), 1).count() == 1


def reference_score(k):
    """The model once more, in plain Python."""
    p = min(k["combo"], 0.95)
    combo = 1.0 if p <= 0 else 1 + p * 0.8 + p**2 * 0.6 + p**3 * 0.4 + 0.3 * p**4 / (1 - p)
    interval = max(k["speed"] - 2.0, 3.0, 0.1) * 0.5 / (1 + k["self"]) * (1 + k["combo"])
    hit = k["base"] * 1.2 * (1 + k["atk"] + 0.5) * (1 + k["dmg"]) * (1 - 0.5 * (1 - min(1.0, k["down"])))
    charge = k["charge"] if k["charge"] >= 15 else min(k["charge"] + 6, 15)
    return (hit * 1.25 + hit * (combo - 1)) / interval + hit * k["mult"] * 3 * (1.5 if k["cc"] else 1) * charge / 100 / interval


def test_scores(spark):
    rng = random.Random(0)
    kits = [{"base": rng.uniform(1, 900), "combo": rng.choice([0, 0.5, 0.7, 1.0]), "speed": rng.choice([2.5, 3, 5, 8]), "charge": rng.choice([5, 14, 15, 20]), "mult": rng.randrange(1, 9), "atk": rng.random(), "dmg": rng.random(), "down": rng.random() * 1.5, "cc": rng.random() < 0.5, "self": rng.random()} for _ in range(60)]
    df = spark.createDataFrame([tuple(float(v) if not isinstance(v, bool) else v for v in k.values()) for k in kits], "base double, combo double, speed double, charge double, mult double, atk double, dmg double, down double, cc boolean, self double")
    c = F.col
    normal, special = X.damage_rates(c("base"), c("combo"), c("speed"), c("charge"), c("mult"), c("atk"), c("dmg"), X.solo_reduction(c("down")), c("cc"), c("self"))
    got = [r[0] for r in df.select(normal + special).collect()]
    assert got == pytest.approx([reference_score(k) for k in kits], rel=1e-9)


def test_greedy_cover(spark):
    rng = random.Random(4)
    everyone = [*teams.MANDATORY, *teams.GAIN]
    people = [(f"n{i:03d}", rng.choice(["SSR", "SR", "R"]), sorted({rng.choice(everyone) for _ in range(rng.randrange(0, 5))})) for i in range(80)]

    def slow(must, low):
        place = {r: i for i, r in enumerate(["R", "SR", "SSR"] if low else ["SSR", "SR", "R"])}
        team, covered = [], set()
        while len(team) < 5:
            for n, r, roles in sorted(people, key=lambda p: (-len(set(p[2]) - covered), -len(p[2]), place[p[1]], p[0])):
                if n not in [x[0] for x in team] and any(m in roles and m not in covered for m in must):
                    team.append((n, roles))
                    covered |= set(roles)
                    break
            else:
                break
        while len(team) < 5:
            n, r, roles = min((p for p in people if p[0] not in [x[0] for x in team]), key=lambda p: (-(sum(teams.GAIN.get(x, 0) for x in set(p[2]) - covered) + 0.5 * len(set(p[2]) - covered)), p[0]))
            team.append((n, roles))
            covered |= set(roles)
        return [n for n, _ in team]

    df = spark.createDataFrame(people, "name string, rarity string, roles array<string>").repartition(6)
    for must, low in ((teams.MANDATORY, False), ([*teams.MANDATORY, "不撤退"], False), (teams.MANDATORY, True)):
        got = [r.name for r in teams.greedy_team(df, must, low_first=low).orderBy("slot").collect()]
        assert got == slow(must, low)


def test_reports(spark):
    df = spark.createDataFrame([("a", "SSR", 500, 10, "防御20%ダウン 回復", "交換所"), ("b", "R", 10, 460, "×4 撤退しない", ""), ("c", "R", 1, 1, "nothing", "1234567890")], "name string, rarity string, attack int, magic int, t string, obtain string")
    assert dict(rows(entities.with_roles(df, F.col("t")), "name", "roles")) == {"a": sorted(["治疗", "输出", "降防"]), "b": sorted(["不撤退", "输出"]), "c": []}
    assert dict(rows(entities.tags(df, F.col("t")), "name", "tags"))["b"] == ["不撤退"]
    assert dict(rows(df.select("name", entities.short_obtain(F.col("obtain")).alias("o")), "name", "o")) == {"a": "交换所", "b": "?", "c": "12345678"}
    assert rows(entities.role_scarcity(entities.with_roles(df, F.col("t")), ["SSR", "R"]).filter("role = '输出'"), "SSR", "R", "all") == [(1, 1, 2)]
