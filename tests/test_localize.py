"""Pages from templates, and the plans around them."""

import re

from pyspark.sql import functions as F

from palimpsest.functions import dom, render
from palimpsest.functions.python import norm, norm_no_space
from palimpsest.functions.text import without_space
from palimpsest.plans import localize


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_render_page():
    template = '<p data-i18n-blk="blk1">{{key1}}<a href="x.html">{{key2}}</a></p><td>{{key3}}</td><p data-i18n-blk="blk2">{{key4}}<span data-char="N">{{key5}}</span></p><p data-i18n-blk="blk3">{{key6}}</p>'
    keys = {1: "a<b", 2: "two", 3: "x & y", 4: "four", 5: "five", 6: "six"}
    blocks = {1: ("ja", "整句\x01行", [1, 2]), 2: ("ja", "块", [4, 5]), 3: ("長い文です。\n二行目もあります。", "短", [6])}
    out = render.render_page(template, keys, {4, 5}, blocks, lambda t: f"«{t}»", lambda h: "/s/" + h)
    assert out.startswith('<p>整句<br>行<a href="/s/x.html" class="inline-link">【«two»】</a></p><td>x &amp; y</td>')
    assert '<p>four<span data-char="N">five</span></p>' in out and out.endswith("<p>長い文です。\n二行目もあります。</p>")
    partly = render.render_page(template, keys, {4}, blocks, lambda t: t, str)
    assert '<p>块<span class="char-ref" data-char="N">【N】</span></p>' in partly
    assert render.before_last_tag("<b>x</b></i> ", "!") == "<b>x</b>!</i> "


def test_pages(spark):
    templates = spark.createDataFrame([("p", "<p>{{key1}}</p><p>{{key2}}</p>"), ("q", "plain")], "slug string, html string")
    keys = spark.createDataFrame([("p", 1, "剣", ""), ("p", 2, "文", "句")], "slug string, key_no int, ja string, zh string")
    blocks = spark.createDataFrame([], "slug string, blk_no int, ja string, zh string, keys array<int>")
    names = spark.createDataFrame([("N", "n")], "name string, shown string")
    layer = spark.createDataFrame([("剣", "剑")], "key string, value string")
    assert rows(localize.pages(templates, keys, blocks, [layer], names, norm, "/s/"), "slug", "html") == [("p", "<p>剑</p><p>句</p>"), ("q", "plain")]


def test_tree_passes():
    body = dom.parse('<h1>t</h1><h2>A b</h2><h2 class="help-entry">x</h2><h2>A b</h2><h2></h2><img src="i.png"><img src="data:x"><a>File not found: "N_icon.png" at page "img"[添付]</a>')
    render.contents(body, lambda t: t.lower().replace(" ", "-"), "目录")
    pending = render.rewrite_images(body, lambda s: ("https://s/" + s, "h.png"))
    assert render.repair_icons(body, {"N": "n.png"}) == 1
    html = body.inner()
    assert '<div class="oh-toc"><p>目录</p><ul><li class="toc-l1"><a href="#a-b">A b</a><ul><li class="toc-l2"><a href="#x">x</a></li></ul></li><li class="toc-l1"><a href="#a-b-1">A b</a></li></ul></div><h2 id="a-b">' in html
    assert pending == {"https://s/i.png": "h.png"} and 'src="/img/h.png"' in html and 'src="/img/n.png"' in html and "File not found" not in html
    lists = '<dl class="list1 list-indent1"><dt>{}</dt><dt>{}</dt></dl>'
    once = render.with_originals(lists.format("剑", "の"), {0: "つるぎ", 1: "の"})
    assert once == lists.format('剑<span class="term-ja">（つるぎ）</span>', "の") and render.with_originals(once, {0: "つるぎ", 1: "の"}) == once
    assert render.with_originals("<dt>a</dt>", {0: "あ"}) == "<dt>a</dt>"
    comment = '<li class="pcmt" data-comment-id="c1">本文 -- [id]<ul class="list2"><li>reply</li></ul><span class="comment_date">d</span></li><li class="pcmt">x</li>'
    out = render.translate_comments(comment, {"c1": "译文"})
    assert out == '<li class="pcmt" data-comment-id="c1">译文 -- [id]<ul class="list2"><li>reply</li></ul><span class="comment_date">d</span></li><li class="pcmt">x</li>'
    assert render.translate_comments(comment.replace('<span class="comment_date">d</span>', ""), {"c1": "译文"}).startswith('<li class="pcmt" data-comment-id="c1">译文<ul')


def test_before_last_tag():
    assert render.before_last_tag("text<br>", "[T]") == "text[T]<br>" and render.before_last_tag("text", "[T]") == "text[T]"
    assert render.before_last_tag("<ul><li>x</li></ul>", "[T]") == "<ul><li>x</li>[T]</ul>" and render.before_last_tag("a<b>c</b>d", "") == "a<b>c</b>d"
    out = render.render_page('<p data-i18n-blk="blk1">{{key1}}<a href="x.html">{{key1}}</a></p>', {1: "k"}, set(), {1: ("ja", "一\x01二", [1])}, str, str)
    assert out == '<p>一<br>二<a href="x.html" class="inline-link">【k】</a></p>'


def test_originals_by_position(spark):
    lists = '<dl class="list1 list-indent1"><dt>{}</dt><dd>x</dd><dt>{}</dt></dl>'
    pages = lambda rows: spark.createDataFrame(rows, "slug string, html string")
    zh = pages([("p", lists.format("剑", "盾")), ("q", lists.format("剑", "盾")), ("r", "plain")])
    ja = pages([("p", lists.format("つるぎ", "<b>たて</b>")), ("q", "<dt>つるぎ</dt>"), ("r", lists.format("あ", "い"))])
    out = dict(rows(localize.with_originals(zh, ja), "slug", "html"))
    mark = '{}<span class="term-ja">（{}）</span>'
    assert out == {"p": lists.format(mark.format("剑", "つるぎ"), mark.format("盾", "たて")), "q": lists.format("剑", "盾"), "r": "plain"}


def test_comments_by_id(spark):
    pages = spark.createDataFrame([("p", '<li class="pcmt" data-comment-id="c1">本文</li>'), ("q", '<li class="pcmt" data-comment-id="c1">別</li>')], "slug string, html string")
    known = spark.createDataFrame([("p", "c1", "译文"), ("p", "c2", None), ("q", "c9", "x")], "slug string, comment_id string, zh string")
    out = dict(rows(localize.with_comments(pages, known), "slug", "html"))
    assert out == {"p": '<li class="pcmt" data-comment-id="c1">译文</li>', "q": '<li class="pcmt" data-comment-id="c1">別</li>'}


def test_sanitize():
    html = '<div class="jumpmenu">x</div><h2 id="h1">One<a class="anchor_super" id="a1">†</a></h2><p onclick="f()" style="a:\n b">t --[me]2024-01-02(火)03:04:05</p><table></table><table><tr><td>c</table><svg viewbox="0 0 1 1"></svg><div class="contents"><a href="#a1">One</a></div>'
    once = render.sanitize(html)
    assert once == '<h2 id="h1">One<span id="a1"></span></h2><p style="a: b">t </p><div class="table-scroll"><table><tr><td>c</td></tr></table></div><svg viewBox="0 0 1 1"></svg><div class="contents"><a href="#h1">One</a></div>'


def test_corrections_with_suffix(spark):
    entries = spark.createDataFrame([("a", 1, "剣(強)", "古剑(强)"), ("a", 2, "剣SSR", "旧剑 SSR"), ("a", 3, "剣 ※", "旧剑"), ("a", 4, "剣(強)", "无关"), ("a", 5, "剣", "老剑")], "slug string, ord int, ja string, zh string")
    canonical = spark.createDataFrame([("剣", "剑")], "key string, value string")
    from palimpsest.operators import store

    assert rows(store.corrections(entries, canonical, norm), "wrong", "right") == sorted([("古剑(强)", "剑(强)"), ("旧剑", "剑"), ("旧剑 SSR", "剑 SSR"), ("老剑", "剑")], key=str)


def test_display_names(spark):
    links = spark.createDataFrame([("p", "剣士", "page", True), ("p", "剣士", "page", False), ("p", "文", "none", False), ("p", "語", "none", False), ("q", "文", "none", False)], "slug string, text string, href_slug string, is_entity boolean")
    pair = lambda *x: spark.createDataFrame(list(x), "key string, value string")
    own = spark.createDataFrame([("p", "文", "own")], "slug string, key string, value string")
    out = localize.display_names(links, pair(("剣士", "entity")), pair(("page", "title")), own, pair(("語", "term")), norm)
    assert rows(out, "slug", "text", "is_entity", "shown") == [("p", "剣士", False, "title"), ("p", "剣士", True, "entity"), ("p", "文", False, "own"), ("p", "語", False, "term"), ("q", "文", False, "文")]
    reg = spark.createDataFrame([("a",), ("b",), ("c",)], "slug string")
    zh = spark.createDataFrame([("a", "zh")], "slug string, html string")
    ja = spark.createDataFrame([("a", "ja"), ("b", "ja")], "slug string, html string")
    assert rows(localize.read_fragments(reg, zh, ja), "slug", "html", "translated") == [("a", "zh", True), ("b", "ja", False), ("c", "", False)]


def test_bake_in(spark):
    entries = spark.createDataFrame([("剣", "旧"), ("翼竜 20秒", "翼龙 朱音 20秒"), ("赤、abc", "r、y"), ("未", "")], "ja string, zh string")
    dictionary = spark.createDataFrame([("剣", "剑")], "key string, value string")
    names = spark.createDataFrame([("翼竜", "翼龙茜")], "name string, value string")
    once = localize.bake_in(entries, dictionary, names, {"赤": "红"}, norm_no_space)
    want = {"剣": "剑", "翼竜 20秒": "翼龙茜 20秒", "赤、abc": "红、y", "未": ""}
    assert dict(rows(once, "ja", "zh")) == want
    assert dict(rows(localize.bake_in(once, dictionary, names, {"赤": "红"}, norm_no_space), "ja", "zh")) == want


def test_triage(spark):
    links = spark.createDataFrame([("a", "剣", "剑", "u"), ("b", "剣", "剑", "u"), ("a", "かな", "かな", "v"), ("a", "x", "カナ", "w"), ("a", "城", "城堡", "z"), ("a", "門", "门", "y")], "slug string, ja string, zh string, href string")
    pages = spark.createDataFrame([("a", "有门"), ("b", "")], "slug string, text string")
    none = spark.createDataFrame([], "key string, value string")
    out = localize.triage(links, pages, none, norm_no_space)
    assert rows(out, "slug", "ja", "scope", "reason") == sorted([("a", "剣", "*", None), ("b", "剣", "*", None), ("a", "かな", "a", "untranslated"), ("a", "x", "a", "zh_japanese"), ("a", "城", "a", "mismatch"), ("a", "門", "a", None)], key=str)
    truth = links.limit(1)
    merged = localize.merge_links(truth, links)
    assert merged.count() == 6 and localize.merge_links(merged, links).count() == 6
    hrefs = spark.createDataFrame([("https://o.example/x", "a"), ("https://own/x", "a"), ("a.html#t", "a"), ("b.html", "a"), ("#x", "a"), ("x?table_edit", "a")], "href string, slug string")
    assert [r[0] for r in hrefs.select(localize.is_linkable(F.col("href"), F.col("slug"), "own")).collect()] == [True, False, False, True, False, False]


def test_files(spark):
    pages = spark.createDataFrame([("a b", bytearray(b"x"))], "name string, content binary")
    assert localize.snapshots(pages).first().path == "a%20b.html"
    images = spark.createDataFrame([("https://s/a.png",), ("https://s/a.png",), ("data:x",), ("https://s/b.gif",)], "url string")
    first = localize.pending_assets(images, spark.createDataFrame([], "file string"))
    assert first.count() == 2 and localize.pending_assets(images, first.limit(1)).count() == 1 and all(re.fullmatch(r"[0-9a-f]{16}\.(png|gif)", r.file) for r in first.collect())
    cells = spark.createDataFrame([(1, 0, 0, 0, "x"), (1, 0, 0, 2, "実装日"), (1, 0, 1, 1, "A"), (1, 0, 1, 2, "2024/01/02"), (1, 0, 2, 1, "A"), (1, 0, 2, 2, "later"), (1, 1, 1, 1, "B")], "page int, tab int, row int, cell int, text string")
    assert rows(localize.release_dates(cells), "name", "date") == [("A", "2024/01/02")]
    paths = spark.createDataFrame([("/x/a_translated.txt",), ("/x/todo_1.txt",), ("/x/z",)], "path string")
    assert rows(localize.archive_plan(paths, {"_translated": "done", "^todo": "open"}, "/arc"), "target") == [("/arc/done/a_translated.txt",), ("/arc/open/todo_1.txt",)]
    items = spark.createDataFrame([("p",), ("q",)], "slug string")
    reg = spark.createDataFrame([("p", "raid"), ("q", None)], "slug string, subgroup string")
    assert rows(localize.worklists_by_group(items, reg), "slug", "subgroup") == [("p", "raid")]
    assert spark.range(1).select(without_space(F.lit("a 　b"))).first()[0] == "ab"
