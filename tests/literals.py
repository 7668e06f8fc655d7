"""Functions of the library over literal rows, with the rows that they should give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import dom, lexicon, render, text
from palimpsest.functions import features as X
from palimpsest.functions.python import norm, norm_no_space
from palimpsest.operators import order
from palimpsest.plans import entities, localize, registry
from palimpsest.sources import files, web

BASE = "https://wiki.example/index.php"
_LETTER = "chr(CAST(65 + {} % 26 AS INTEGER))"
QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


def _sql(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(names: str, rows: list[tuple], kinds: str = "") -> str:
    """SQL of literal rows; ``kinds``: a type for each column that needs one."""
    listed, types = names.split(), dict(x.split(":") for x in kinds.split())
    columns = ", ".join(f'CAST("{n}" AS {types[n]}) AS "{n}"' if n in types else f'"{n}"' for n in listed)
    quoted = ", ".join(f'"{n}"' for n in listed)
    return f"SELECT {columns} FROM (VALUES {', '.join('(' + ', '.join(map(_sql, r)) + ')' for r in rows)}) t({quoted})"


def cases(name: str, function: Callable[[Column], Column], wanted: list[tuple], kind: str = "VARCHAR") -> None:
    """A query ``name`` of (input, output) over literal inputs."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return spark.createDataFrame([(i, a) for i, (a, _) in enumerate(wanted)], "i long, input string").select("i", function(F.col("input")).alias("output"))

    run.__name__ = name
    query(values("i output", [(i, b) for i, (_, b) in enumerate(wanted)], f"i:BIGINT output:{kind}"))(run)


cases("href_names", lambda c: text.href_to_name(c, BASE), [("?A%20B#x", "A B"), ("./?C", "C"), (f"{BASE}?D#y", "D"), (f"{BASE}?cmd=x", None), ("#a", None), ("?E&x=1", None), (" ?F ", "F"), ("?", None), (None, None), ("?%E5%89%A3", "剣")])


cases("excluded_names", text.is_excluded, [("コメント/x", True), ("x/コメント", False), ("攻略掲示板", True), ("MenuBar", True), ("MenuBar2", False), ("RecentChanges", True), ("剣", False), ("はじめに読む", True), ("", False)], "BOOLEAN")


cases("kana_texts", text.has_kana, [("剣", False), ("つるぎ", True), ("ツルギ", True), ("abc", False), ("", False), (None, None)], "BOOLEAN")


cases("source_texts", text.needs_translation, [("剣", True), ("abc 12", False), ("ー", False), ("々", True), ("", False)], "BOOLEAN")


cases("modified_stamps", text.wiki_last_modified, [("最終更新日時: 2024-01-02 (火) 03:04:05", "2024-01-02 03:04:05"), ("Last-modified: 2024-01-02 (火) 3:04", "2024-01-02 3:04"), ("最終更新: 2024", None), ("", None)])


cases("stripped_stamps", text.strip_stamps, [("本文 --[me]2024-01-02(火)03:04:05", "本文 "), ("本文 -- [id]2024-01-02 (火) 03:04:05", "本文"), ("本文", "本文"), ("a -- [x] b", "ab"), ("[x] stays", "[x] stays")])


cases("weekdays", text.weekday_names, [("1日(月)と（日）", "1日(周一)と（周日）"), ("(火曜)", "(火曜)"), ("", ""), ("土(土)", "土(周六)")])


cases("name_suffixes", lambda c: F.to_json(text.split_suffix(c)), [("剣（改）", '{"base":"剣","suffix":"（改）"}'), ("盾 SR", '{"base":"盾","suffix":" SR"}'), ("弓※", '{"base":"弓","suffix":"※"}'), ("槍", '{"base":"槍","suffix":""}'), ("杖　大きい", '{"base":"杖","suffix":"　大きい"}')])


cases("cell_texts", text.cell_lines, [("a<br>b", "a\nb"), (" a  b <BR/> <b>c</b>", "a b\nc"), ("<br><br>", ""), ("", ""), ("<td>x<br />y z</td>", "x\ny z")])


cases("relative_paths", lambda c: text.relative_path(F.substring_index(c, ">", 1), F.substring_index(c, ">", -1)), [("a/b>a/c", "c.html"), ("a>b/c", "b/c.html"), ("a/b/c>d", "../../d.html"), ("a/b/c>a/d/e", "../d/e.html"), ("x>y", "y.html"), ("a/b>a/b/c", "b/c.html")])


cases("site_links", lambda c: text.site_href(c, "/site/"), [("https://x/y", "https://x/y"), ("/site/p", "/site/p"), ("/p/q", "/site/p/q"), ("../a/b.html#c", "/site/zh/b.html"), ("b/", "/site/zh/b"), ("", "")])


cases("digit_texts", text.digits_only, [("1,234", 1234), (" 5 6 ", 56), ("12a", None), ("", None), (None, None), ("٣", None)], "BIGINT")


cases("unit_numbers", lambda c: text.number_before(c, "%"), [("12.5%", 12.5), ("x 3 %", 3.0), ("7sec", None), ("1% 2%", 1.0)], "DOUBLE")


cases("space_free_keys", norm_no_space, [("a  b　c†", "abc"), (None, ""), (" x ", "x"), ("か\u3099", "が")])


cases("filled_templates", lambda c: lexicon.restore_keys(c, F.create_map(F.lit(1), F.lit("one"), F.lit(2), F.lit("two"))), [("<p>{{key1}} {{key2}}</p>", "<p>one two</p>"), ("{{key9}}x", "x"), ("plain", "plain"), ("", "")])


cases("aligned_segments", lambda c: lexicon.align_segments(F.substring_index(c, "|", 1), F.substring_index(c, "|", -1), {"剣": "剑", "盾": "盾牌"}), [("剣 盾|x y", "剑 盾牌"), ("剣 弓|x y", "剑 y"), ("剣|x y", "x y"), ("a b|c d", "c d")])


cases("tail_places", lambda c: render.put_tail(c, "[T]"), [("text<br>", "text[T]<br>"), ("text", "text[T]"), ("<ul><li>x</li></ul>", "<ul><li>x</li>[T]</ul>"), ("a<b>c</b>d", "a<b>c[T]</b>d"), ("", "[T]")])


@query(f"""SELECT n, CASE WHEN n >= 18278 THEN {_LETTER.format('((n - 18278) // 17576)')} ELSE '' END || CASE WHEN n >= 702 THEN {_LETTER.format('((n - 702) // 676)')} ELSE '' END
  || CASE WHEN n >= 26 THEN {_LETTER.format('((n - 26) // 26)')} ELSE '' END || {_LETTER.format('n')} AS label FROM (SELECT CAST(unnest(range(20000)) AS BIGINT) AS n)""")
def letter_labels(spark, sf):
    return spark.range(20000).select(F.col("id").alias("n"), text.letters_label(F.col("id")).alias("label"))


cases("defence_numbers", X.defence_down, [("敵全体の防御力を30%ダウン", 0.3), ("攻防が50％低下", 0.5), ("防御30%アップ", 0.0), (None, 0.0), ("防御力20%降低 防御40%減少", 0.4)], "DOUBLE")


cases("attack_numbers", X.attack_up, [("攻撃力が25%アップ", 0.25), ("攻撃10%上昇、攻撃力40%増", 0.4), ("攻撃力10%ダウン", 0.0), ("", 0.0)], "DOUBLE")


cases("ultimate_targets", lambda c: F.to_json(X.ultimate(c)), [("敵全体に5倍の攻撃", '{"mult":5.0,"aoe":true,"target":"全体"}'), ("敵単体へ3倍、敵横一列に7倍", '{"mult":7.0,"aoe":false,"target":"横一列"}'), ("必殺威力×9", '{"mult":9.0,"aoe":false,"target":""}'), ("", '{"mult":0.0,"aoe":false,"target":""}')])


cases("healing_texts", lambda c: X.has_any(c, X.HEAL), [("体力を回復", True), ("回血", True), ("攻撃", False), (None, False)], "BOOLEAN")


@query(values("ord name slug category mode", [(1, "B", "b-page", "x", "watch"), (2, "剣 の", "p-d4d8d6ad41", "y", "watch"), (3, "Gone", "p-ed6fcfe7ed", "y", "watch")]).replace("'p-d4d8d6ad41'", "'p-' || substr(md5('剣 の'), 1, 10)").replace("'p-ed6fcfe7ed'", "'p-' || substr(md5('Gone'), 1, 10)"))
def navigation_rows(spark, sf):
    wanted = spark.createDataFrame([(1, "b", "x"), (2, "剣の", "y"), (3, "Gone", "y")], "ord int, name string, category string")
    links = spark.createDataFrame([("B", 0), ("剣 の", 1), ("b ", 2)], "name string, ord int")
    return registry.navigation(wanted, links, {"x": "y"}, {"b": "b-page"})


@query(values("text shown", [("剣", "page sword"), ("N", "entity"), ("盾", "shield"), ("t", "title"), ("?", "?")]))
def shown_names(spark, sf):
    links = spark.createDataFrame([("p", "剣", None, False), ("p", "N", "n", True), ("p", "盾", None, False), ("p", "t", "there", False), ("p", "?", None, False)], "slug string, text string, href_slug string, is_entity boolean")
    layer = lambda rows: spark.createDataFrame(rows, "key string, value string")
    own = spark.createDataFrame([("p", "剣", "page sword"), ("q", "盾", "other page")], "slug string, key string, value string")
    return localize.display_names(links, layer([("N", "entity")]), layer([("there", "title"), ("n", "N's page")]), own, layer([("剣", "sword"), ("盾", "shield")]), norm).select("text", "shown")


@query(values("pairs", [('{"A":"1","B":"3"}',), ("{}",)]))
def labelled_values(spark, sf):
    rows = spark.createDataFrame([([(True, "A"), (False, "1"), (False, "skipped"), (True, "B"), (False, "2"), (True, "B"), (False, "3"), (True, ""), (False, "x")],), ([],)], "cells array<struct<h: boolean, t: string>>")
    return rows.select(F.to_json(order.label_pairs(F.col("cells"))).alias("pairs"))


@query(values("ja zh", [("剣", "剑"), ("盾 大", "盾牌20秒"), ("弓 剣", "弓 剑"), ("x", "y"), ("空", "")]))
def baked_in(spark, sf):
    entries = spark.createDataFrame([("剣", "刀"), ("盾 大", "护盾20秒"), ("弓 剣", "弓 刀"), ("x", "y"), ("空", "")], "ja string, zh string")
    dictionary = spark.createDataFrame([("剣", "剑")], "key string, value string")
    names = spark.createDataFrame([("盾", "盾牌")], "name string, value string")
    return localize.bake_in(entries, dictionary, names, {"剣": "剑"}, norm_no_space).select("ja", "zh")


@query(values("ja scope reason", [("a", "*", None), ("b", "p", None), ("c", "p", "mismatch"), ("か", "p", "untranslated"), ("d", "p", "zh_japanese")]))
def triaged_links(spark, sf):
    rows = [("p", "a", "A", "x"), ("q", "a", "A", "x"), ("p", "b", "here", "y"), ("p", "c", "absent", "z"), ("p", "か", "か", "w"), ("p", "d", "ひ", "v")]
    pages = spark.createDataFrame([("p", "is here か ひ"), ("q", "")], "slug string, text string")
    found = localize.triage(spark.createDataFrame(rows, "slug string, ja string, zh string, href string"), pages, spark.createDataFrame([], "key string, value string"), norm_no_space)
    return found.filter("slug = 'p'").select("ja", "scope", "reason")


cases("linkable", lambda c: localize.is_linkable(c, F.lit("me"), "own.example"), [("https://x/y", True), ("https://own.example/y", False), ("../a.html#b", True), ("me.html", False), ("#a", False), ("https://x/table_edit", False), ("a", False)], "BOOLEAN")


@query(values("ord name slug category mode url", [(0, "A", "a", "x", None, None), (1, "B", None, "y", "watch", "https://u/")], "ord:INTEGER"))
def registry_rows(spark, sf):
    pages = files.read_registry(spark, "version: 1\npages:\n- {name: A, slug: a, category: x}\n- name: B\n  category: y\n  mode: watch\n  url: https://u/\n")
    return files.read_registry(spark, files.registry_yaml(pages)).select("ord", "name", "slug", "category", "mode", "url")


@query(values("ord name group", [(0, "A", None), (2, "B", "g"), (3, "https://s/?C", None)], "ord:INTEGER"))
def planned_pages(spark, sf):
    return files.read_plan(spark, "planned:\n- A\n- {group: x}\n- {page: B, group: g}\n- url: ' https://s/?C '\n")


@query(values("layer ja zh", [("a", "剣", "剑"), ("a", "盾", "盾牌"), ("b", "N", "名")]))
def glossary_rows(spark, sf):
    return files.read_glossary(spark, {"a": "x:\n  剣: 剑\n  同: 同\n  y: {盾: 盾牌, 空: ''}\n", "b": "N: {name_zh: 名, id: 3}\n"}).select("layer", "ja", "zh")


@query(values("path target", [("in/a-1.txt", "done/work/a-1.txt"), ("in/g.tsv", "done/terms/g.tsv")]))
def archived_files(spark, sf):
    paths = spark.createDataFrame([("in/a-1.txt",), ("in/g.tsv",), ("in/other",)], "path string")
    return localize.archive_plan(paths, {r"\.txt$": "work", r"\.tsv$": "terms"}, "done")


def _files(spark, *rows: tuple[str, str]) -> DataFrame:
    return spark.createDataFrame(list(rows), "path string, text string")


@query(values("ord mark body", [(0, "1", "first\nsecond"), (1, "key2", "x"), (2, "blk3", "")], "ord:INTEGER"))
def numbered_entries(spark, sf):
    return files.numbered_entries(_files(spark, ("f", "head\n[1] first\n# note\nsecond\n[key2]x\n[blk3]\n"))).select("ord", "mark", "body")


@query(values("label slug body", [("A", "p/q", "\n[1] x\n"), ("AB", "r", "\ny\n")]))
def labelled_sections(spark, sf):
    texts = _files(spark, ("f", "# MAP A=p/q AB=r\n===A===\n[1] x\n===AB===  \ny\n"))
    names = files.label_map(texts).select(F.col("label").alias("_label"), "slug")
    return files.label_sections(texts).join(names, F.col("label") == F.col("_label")).select("label", "slug", "body")


@query(values("path first second kind", [("a", "10", "x", "numeric"), ("a", "7", "y", "numeric"), ("b", "剣", "剑", "ja"), ("b", "3", None, "ja")]))
def tab_files(spark, sf):
    return files.tab_lines(_files(spark, ("a", "10\tx\r\n\n# c\n7\ty"), ("b", "剣\t剑\n3"))).select("path", "first", "second", "kind")


@query(values("base part", [("a", 0), ("a", 2), ("a", 10), ("b-x", 1)], "part:INTEGER"))
def split_files(spark, sf):
    return files.split_files(_files(spark, ("d/a.txt", ""), ("d/a-2.txt", ""), ("d/a-10.txt", ""), ("d/b-x-1.txt", ""))).select("base", "part")


@query(values("name date", [("A B", "2024-01-02T03:04:05"), ("C", "d")]))
def feed_rows(spark, sf):
    feed = "<rdf><item rdf:about='x'><title>A%20B</title><dc:date>2024-01-02T03:04:05</dc:date></item><item><title><b>C</b></title><dc:date> d </dc:date></item><item><title></title><dc:date>e</dc:date></item></rdf>"
    return files.feed_items(spark.createDataFrame([(feed,)], "text string"))


@query(values("i html", [(0, '<a href="__ROUTE__/a%3Fb.html#x" class="internal-link">a</a>'), (1, '<a href="https://wiki.example/index.php?B" target="_blank" rel="noopener" class="source-link">b</a>'), (2, '<a href="https://o/" target="_blank" rel="noopener">o</a>'), (3, '<a href="#k">k</a>')], "i:INTEGER"))
def rewritten_links(spark, sf):
    rows = spark.createDataFrame([(0, '<a href="?A#x">a</a>'), (1, '<a href="?B">b</a>'), (2, '<a href="https://o/">o</a>'), (3, '<a href="#k">k</a>')], "i int, html string")
    return rows.select("i", render.put_links(F.col("html"), {"A": "a?b"}, BASE).alias("html"))


@query(values("section row cell text", [("プロフィール", 0, 0, "名前"), ("プロフィール", 0, 1, "N"), ("プロフィール", 1, 0, "本名"), ("プロフィール", 1, 1, "M"), ("必殺技", 0, 0, "全体\n攻撃")], "row:INTEGER cell:INTEGER"))
def page_sections(spark, sf):
    page = "<body><table><tr><th>名前<td>N<tr><th>本名<td>M<tr><th>必殺技<tr><td>全体<br>攻撃<td><img src=x></table></body>"
    rows = spark.createDataFrame([(page,)], "html string").lateralJoin(dom.Sections(F.col("html").outer(), F.array(F.lit("プロフィール"), F.lit("必殺技"))))
    return rows.select("section", "row", "cell", "text")


@query(values("kind id ja", [("template", 0, None), ("key", 1, "日本"), ("key", 2, "語"), ("blk", 1, "日本語")], "id:INTEGER"))
def keyed_page(spark, sf):
    rows = spark.createDataFrame([("<p>日本<b>語</b></p><pre>漢字</pre>",)], "html string").lateralJoin(dom.Keyed(F.col("html").outer()))
    return rows.select("kind", "id", "ja")


@query(values("name rarity slug", [("One", "SSR", "characters/One"), ("Two", "R", "characters/Two")]))
def entity_lists(spark, sf):
    cells = spark.createDataFrame([("p", 0, "heading", "SSR edit", None), ("p", 1, "link", "x", "?One"), ("p", 2, "heading", "other", None), ("p", 3, "link", "y", "?Skip"), ("p", 4, "heading", "R", None), ("p", 5, "link", "z", "?Two"), ("p", 6, "link", "z", "?One"), ("p", 7, "link", "m", "?MenuBar")], "page string, ord int, kind string, text string, href string")
    return registry.entity_rows(cells, BASE).select("name", "rarity", "slug")


@query(values("name date", [("A", "d1"), ("B", "d2")]))
def dated_entities(spark, sf):
    rows = [(0, 0, "No"), (0, 1, "Name"), (0, 2, "実装日"), (1, 0, "1"), (1, 1, "A"), (1, 2, "d1"), (2, 0, "2"), (2, 1, "B"), (2, 2, "d2"), (3, 1, "A"), (3, 2, "d3"), (4, 1, ""), (4, 2, "d4")]
    cells = spark.createDataFrame([("p", 0, r, c, t) for r, c, t in rows], "page string, tab int, row int, cell int, text string")
    return localize.release_dates(cells)


cases("sanitized", render.put_sanitized, [('<p onclick="f()" style="a:\n b">t --[me]2024-01-02(火)03:04:05</p>', '<p style="a: b">t </p>'), ('<div class="jumpmenu">x</div>y', "y"), ("<table></table>", ""), ("<table><tr><td>c</table>", '<div class="table-scroll"><table><tr><td>c</td></tr></table></div>')])


@query(values("slug html", [("p", '<dl class="list1 list-indent1"><dt>剑<span class="term-ja">（つるぎ）</span></dt><dt>盾</dt></dl>'), ("q", "<dt>x</dt>")]))
def term_originals(spark, sf):
    lists = '<dl class="list1 list-indent1"><dt>{}</dt><dt>{}</dt></dl>'
    pages = lambda *rows: spark.createDataFrame(list(rows), "slug string, html string")
    return localize.with_originals(pages(("p", lists.format("剑", "盾")), ("q", "<dt>x</dt>")), pages(("p", lists.format("つるぎ", "盾")), ("q", "<dt>あ</dt>")))


@query(values("slug html", [("p", '<li class="pcmt" data-comment-id="c1">译文 -- [id]<span class="comment_date">d</span></li>'), ("q", '<li class="pcmt" data-comment-id="c1">x</li>')]))
def translated_comments(spark, sf):
    pages = spark.createDataFrame([("p", '<li class="pcmt" data-comment-id="c1">本文 -- [id]<span class="comment_date">d</span></li>'), ("q", '<li class="pcmt" data-comment-id="c1">x</li>')], "slug string, html string")
    return localize.with_comments(pages, spark.createDataFrame([("p", "c1", "译文")], "slug string, comment_id string, zh string"))


@query(values("slug html", [("p", "<p>剑</p><p>句</p>"), ("q", "plain")]))
def localized_pages(spark, sf):
    templates = spark.createDataFrame([("p", "<p>{{key1}}</p><p>{{key2}}</p>"), ("q", "plain")], "slug string, html string")
    keys = spark.createDataFrame([("p", 1, "剣", ""), ("p", 2, "文", "句")], "slug string, key_no int, ja string, zh string")
    blocks = spark.createDataFrame([], "slug string, blk_no int, ja string, zh string, keys array<int>")
    layer = spark.createDataFrame([("剣", "剑")], "key string, value string")
    return localize.pages(templates, keys, blocks, [layer], spark.createDataFrame([("N", "n")], "name string, shown string"), norm, "/s/")


_CELL = "struct<h: boolean, t: string, tr: boolean, zh: string, cs: int, rs: int>"


@query(values("name faction atk_type level hp ultimate", [("A", "联盟", "近战物理", 100, 1200, "全体攻击")], "level:INTEGER hp:BIGINT"))
def flat_entities(spark, sf):
    cell = lambda t, zh=None, h=False: (h, t, False, zh, None, None)
    table_of = lambda *rows: ("x", [list(r) for r in rows])
    sections = {
        "プロフィール": table_of([cell("所属勢力", h=True), cell("同盟", "联盟")], [cell("通常攻撃", h=True), cell("x", "近战物理攻击")]),
        "基本ステータス": table_of([cell(entities.LEVEL, h=True), cell(entities.STATS[0], h=True)], [cell("Lv80"), cell("1,000")], [cell("Lv100"), cell("1,200")], [cell("Lv120"), cell("2,000")]),
        "必殺技": table_of([cell("名称", h=True), cell("効果", h=True)], [cell("n"), cell("全体攻撃", "全体攻击")]),
    }
    rows = spark.createDataFrame([("A", "SSR", sections)], f"name string, rarity string, sections map<string, struct<label: string, rows: array<array<{_CELL}>>>>")
    flat = entities.flat_records(rows)
    return flat.select("name", "faction", "atk_type", "level", F.col("stats")[entities.STATS[0]].alias("hp"), F.get("ultimates", F.lit(0))["eff_zh"].alias("ultimate"))


@query(values("status expected", [("ok", "ok"), ("challenged", "challenged"), ("missing", "missing"), ("error", "error")]))
def page_states(spark, sf):
    body = '<div id="body">{}</div><hr class="full_hr">'
    rows = spark.createDataFrame([("ok", body.format("x"), None), ("challenged", "cf-turnstile", None), ("missing", body.format("ページが見つかりません"), None), ("error", None, "status 500")], "expected string, html string, error string")
    return rows.select(web.page_status(F.col("html"), F.col("error")).alias("status"), "expected")


