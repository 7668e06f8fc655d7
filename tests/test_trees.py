"""Interval labels against trees built one node after another."""

import random
import re

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import dom
from palimpsest.operators import trees


def page_of(r, depth=0):
    """A page with optional end tags left out here and there, and inline elements left open at a paragraph's end."""
    word = lambda: r.choice(["ab", "c d", "日本", "x", ""])
    inline = lambda: r.choice([word(), f"<b>{word()}</b>", f"<i>{word()}<b>{word()}</b></i>", f'<a href="/{word()}">{word()}</a>', "<br>", f"<img src='>'>{word()}"])
    out = []
    for _ in range(r.randrange(1, 4)):
        kind = r.choice(["p", "ul", "table", "div", "h1", "text"]) if depth < 3 else r.choice(["p", "text"])
        if kind == "p":
            out.append(f"<p>{inline()}{inline()}" + r.choice(["</p>", "</p>", ""]))
        elif kind == "text":
            out.append(inline())
        elif kind == "ul":
            out.append("<ul>" + "".join(f"<li>{page_of(r, depth + 1)}" + r.choice(["</li>", ""]) for _ in range(r.randrange(1, 3))) + "</ul>")
        elif kind == "table":
            out.append("<table>" + "".join("<tr>" + "".join(f"<td>{page_of(r, depth + 1)}" + r.choice(["</td>", ""]) for _ in range(2)) + r.choice(["</tr>", ""]) for _ in range(2)) + "</table>")
        else:
            out.append(f"<{kind}>{page_of(r, depth + 1) if kind == 'div' else inline()}</{kind}>")
    return "".join(out)


@pytest.fixture(scope="module")
def made(spark):
    r = random.Random(11)
    pages = [(i, "<!DOCTYPE html><html><body><!-- <p> -->" + page_of(r) + "<script>var t = '<p>';</script></body></html>") for i in range(60)]
    return pages, spark.createDataFrame(pages, "page long, html string")


def walk(html):
    """(place, tag, ancestors' places) of each element in order, of the standard library's parser."""
    root, places = dom.parse(html), {}
    opened = [n for n in root.walk() if n.tag not in ("", "!", "#root")]
    tags = [m for m in re.finditer(r"<(/?)([a-z][a-z0-9]*)(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.sub(r"(?s)<!--.*?-->|(?<=<script>).*?(?=</script>)", "", html))]
    begins = [i + 1 for i, m in enumerate(tags) if not m[1]]
    assert len(begins) == len(opened)
    for place, node in zip(begins, opened, strict=True):
        places[node] = place
    return [(places[n], n.tag, {places[a] for a in n.ancestors() if a in places}) for n in opened]


def test_ancestors(spark, made):
    pages, df = made
    nodes = trees.elements(trees.tokens(df, "page", "html"))
    inner = nodes.filter("node > 0")
    got = {}
    for row in trees.structural_join(inner, inner).collect():
        got.setdefault((row.page, row.node), set()).add(row.ancestor)
    want = {(p, place): above for p, html in pages for place, _, above in walk(html) if above}
    assert got == want
    assert {(r.page, r.node): r.tag for r in inner.collect()} == {(p, place): tag for p, html in pages for place, tag, _ in walk(html)}


def test_nearest(spark, made, monkeypatch):
    """Over segments shorter than the pages, too."""
    pages, df = made
    nodes = trees.elements(trees.tokens(df, "page", "html"))
    outer = F.col("tag").isin("li", "td", "div")
    want = {}
    for p, html in pages:
        found = walk(html)
        wanted = {place for place, tag, _ in found if tag in ("li", "td", "div")}
        want |= {(p, place): max(above & wanted) for place, _, above in found if above & wanted}
    for size in (1024, 3):
        monkeypatch.setattr(trees, "SEGMENT", size)
        got = trees.nearest_ancestor(nodes.filter(outer), nodes).collect()
        assert {(r.page, r.node): r.ancestor for r in got} == want


def test_broken_pages(spark):
    """What closes nothing is left; what is never closed ends with its block or the page."""
    pages = [(1, "</b><div><b>x<p>y</p></div></div>z<div>w"), (2, None), (3, ""), (4, "no tags"), (5, "<a href=\"x>y\" title='\"'>t</a><A HREF=z>"), (1, "<i>twin row</i>")]
    df = spark.createDataFrame(pages[:-1], "page long, html string")
    rows = {(r.page, r.node): (r.until, r.tag) for r in trees.elements(trees.tokens(df, "page", "html")).collect()}
    assert {k: v for k, v in rows.items() if k[0] == 1} == {(1, 0): (9, ""), (1, 2): (6, "div"), (1, 3): (4, "b"), (1, 4): (5, "p"), (1, 8): (9, "div")}
    assert rows[2, 0] == rows[3, 0] == rows[4, 0] == (1, "") and rows[5, 1] == (2, "a") and rows[5, 3] == (4, "a")
    links = trees.tokens(df, "page", "html").filter("page = 5 AND kind = 'open'").select(trees.attribute(F.col("attrs"), "href").alias("h"), trees.attribute(F.col("attrs"), "title").alias("t")).collect()
    assert [tuple(x) for x in links] == [("x>y", '"'), ("z", None)]
    assert trees.elements(trees.tokens(df.limit(0), "page", "html")).count() == 0


def plain_runs(html, source, date="comment_date"):
    """Runs of a page: texts between blocks, one node after another."""
    out, texts = [], []

    def flush():
        if sum(bool(re.search(source, t)) for t in texts) >= 2:
            out.append("".join(texts))
        texts.clear()

    def visit(node):
        for child in node.children:
            if child.tag == "":
                texts.append(child.text)
            elif child.tag in trees.VERBATIM:
                flush()
            elif child.tag in trees.INLINE and date not in child.attrs.get("class", ""):
                visit(child)
            else:
                flush()
                if date not in child.attrs.get("class", ""):
                    visit(child)
                flush()

    visit(dom.parse(html))
    flush()
    return out


def test_inline_runs(spark, made):
    pages = [*made[0], (100, "<li>日本<b>語</b>の<span class='comment_date'>日<b>付</b></span>次<i>の</i><ul><li>返<b>信</b></li></ul>尾</li><pre>漢<b>字</b></pre>")]
    df = spark.createDataFrame(pages, "page long, html string")
    date = F.coalesce(trees.attribute(F.col("attrs"), "class") == "comment_date", F.lit(False))
    for source in ("[ぁ-ん一-龯]", "[a-z]"):
        got = {}
        for r in trees.inline_runs(trees.tokens(df, "page", "html"), source, date).orderBy("page", "run").collect():
            got.setdefault(r.page, []).append(r.text)
        want = {p: runs for p, html in pages if (runs := plain_runs(html, source))}
        assert got == want
    assert got == want and want


def test_in_given_parts(spark, made, monkeypatch):
    """The number of tasks follows the pages' size, and doesn't change what is found."""
    pages, df = made
    assert trees.tasks(df.limit(0), "html") == 1
    monkeypatch.setattr(trees, "TASK_CHARACTERS", 1000)
    n = trees.tasks(df, "html")
    assert n == sum(len(h) for _, h in pages) // 1000 + 1
    found = trees.tokens(df, "page", "html")
    nodes, plain = trees.elements(found, n), trees.elements(found)
    assert nodes.filter("tag <> ''").rdd.getNumPartitions() >= n
    inner = plain.filter("node > 0")
    want = {(r.page, r.node, r.ancestor) for r in trees.nearest_ancestor(inner, inner).collect()}
    got = trees.nearest_ancestor(nodes.filter("node > 0"), inner, n, ("tag",)).collect()
    tags = {(r.page, r.node): r.tag for r in inner.collect()}
    assert want and {(r.page, r.node, r.ancestor) for r in got} == want and all(tags[r.page, r.ancestor] == r.tag for r in got)
