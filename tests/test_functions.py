"""Scalar functions against plain Python, on literal rows with the edge values of their domain."""

import difflib
import hashlib
import random
import re
import unicodedata
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.functions import dom, lexicon, python, text
from palimpsest.functions import features as X

EDGES = ["", " ", "a b", "　全角　空白 ", " nbsp ", "élégant †", "１２３％", "a+b", "%E3%81%82", "・項目", "終わり。", "短い", "第459期", "灵魂x10", "😀 emoji", "x" * 200, "あ" * 20, "５-6(消費ST15)", "5-6(消費ST15)", "（第2段）", "Last-modified: 2024-01-02"]


@pytest.fixture(scope="module")
def run(spark):
    def go(column, rows=EDGES, schema="t string"):
        data = [(r,) if not isinstance(r, tuple) else r for r in rows]
        return [r[0] for r in spark.createDataFrame(data, schema).select(column.alias("out")).collect()]

    return go


t = None


@pytest.fixture(scope="module", autouse=True)
def column(spark):
    global t
    t = F.col("t")


def test_norm(run):
    want = [re.sub(r"\s*†\s*$", "", re.sub(r"\s+", " ", unicodedata.normalize("NFC", x)).strip()) for x in EDGES]
    assert run(python.norm(t)) == want
    assert run(python.norm_no_space(t)) == [re.sub(r"\s+", "", w) for w in want]
    assert run(python.norm(t), [(None,)]) == [""]


def test_name_key(run):
    rows = ["（A・B） c", " Ｘ（y） ", "・", ""]
    assert run(text.name_key(t), rows) == ["(ab)c", "ｘ(y)", "", ""]


def test_slugify(run):
    rows = ["Hello  World!", "<b>x</b>-y", "１２ ab", "!!!", "日本 語", "--a--"]
    assert run(python.slugify(t), rows) == ["hello-world", "x-y", "12-ab", "sec", "日本-語", "a"]


def test_file_name(run):
    rows = [*EDGES, "a/b?c*~", "あ" * 19, "x" * 175, "x" * 176, "é'()!"]

    def want(n):
        e = quote(n, safe="") + ".html"
        return e if len(e) <= 180 else hashlib.sha1(n.encode()).hexdigest()[:16] + ".html"

    assert run(text.file_name(t), rows) == [want(x) for x in rows]
    assert run(text.page_url(t, "https://w.example/"), ["a/b c", "あ"]) == ["https://w.example/?a/b%20c", "https://w.example/?%E3%81%82"]


def test_href_to_name(run):
    base = "https://w.example/wiki/"
    rows = {"?%E3%81%82": "あ", "./?a+b": "a b", f"{base}?Page": "Page", f"{base}?cmd=edit": None, "?a&b": None, "?x=1": None, "?a#b": "a", "/x": None, "https://o.example/?Page": None, "?": None, "#top": None, f"{base}?P#x": "P"}
    assert run(text.href_to_name(t, base), list(rows)) == list(rows.values())


def test_asset_name(run):
    rows = {"https://w/x.png": "png", "https://w/x.PNG?v2": "pngv2", "https://w/noext": "png", "https://w.x/a.jpeg": "jpeg", "https://w/a.b/c": "png", "https://w/a.": "png"}
    assert run(text.asset_name(t), list(rows)) == [f"{hashlib.sha256(u.encode()).hexdigest()[:16]}.{e}" for u, e in rows.items()]


def test_predicates(run):
    assert run(text.is_ui_fragment(t)) == [x == "" or x.startswith("・") or (x[-1] not in "。！？.!?" and len(x) <= 10) for x in EDGES]
    flags = dict(zip(EDGES, run(text.is_numeric_template(t)), strict=True))
    assert [x for x, f in flags.items() if f] == ["第459期", "灵魂x10", "5-6(消費ST15)", "（第2段）"]  # both bracket widths: the intended forms
    assert run(text.is_metadata(t))[-1] and run(text.needs_translation(t), ["漢字", "abc", "ｱ", "々"]) == [True, False, False, True]
    assert run(text.has_kana(t), ["漢字", "かな", "カナ"]) == [False, True, True]
    assert run(text.is_excluded(t), ["コメント/x", "x掲示板", "MenuBar", "MenuBar2", "ok"]) == [True, True, True, False, False]
    assert run(text.is_challenge(t), ["a cf-turnstile b", "x"]) == [True, False]
    page = '<div id="body">{}<hr class="full_hr">'
    assert run(text.is_missing(t), [page.format("<b>ページが見つかりません</b>"), page.format("ページが見つかりません" + "x" * 300), "ページが見つかりません", page.format("ok")]) == [True, False, False, False]


def test_last_modified_and_stamps(run):
    rows = ["x Last-modified: 2024-01-02 (火) 03:04:05 y", "最終更新日時:2024-01-02(火)3:04", "最終更新時間: 2024-01-02 (火) 13:04", "none"]
    assert run(text.wiki_last_modified(t), rows) == ["2024-01-02 03:04:05", "2024-01-02 3:04", "2024-01-02 13:04", None]
    rows = ["本文 --[ab]2024-01-02(火)03:04:05", "本文 -- [id1] 2024-01-02 (火) 03:04", "本文――[x]", "本文"]
    assert run(text.strip_stamps(t), rows) == ["本文 ", "本文", "本文", "本文"]
    assert run(text.weekday_names(t), ["1(月)2（日）(x)"]) == ["1(周一)2（周日）(x)"]


def test_split_suffix(run):
    rows = {"名前(ユリカ)": ("名前", "(ユリカ)"), "名前SSR": ("名前", "SSR"), "名前 ※": ("名前", " ※"), "名前　変身前": ("名前", "　変身前"), "名前": ("名前", ""), "": ("", "")}
    assert [tuple(r) for r in run(text.split_suffix(t), list(rows))] == list(rows.values())


def test_cells_numbers_labels(run):
    assert run(text.cell_lines(t), ["a<br>b  <i>c</i>", " <br/> x ", "<BR>"]) == ["a\nb c", "x", ""]
    assert run(text.digits_only(t), ["12", "1,234", "+5", " 5 ", "x", "", "　7"]) == [12, 1234, None, 5, None, None, 7]
    assert run(text.number_before(t, "%"), ["連撃 40%", "7.5 %", "x", "40"]) == [40.0, 7.5, None, None]

    def label(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    rows = [0, 25, 26, 51, 52, 701, 702, 703, 1377, 18277]
    assert run(text.letters_label(F.col("t")), [(r,) for r in rows], "t long") == [label(r) for r in rows]


def test_paths(run):
    import posixpath

    rows = [("a", "b"), ("x/a", "b"), ("x/a", "x/b"), ("x/y/a", "x/b"), ("a", "x/b"), ("x/y/a", "z/w/b"), ("x/y/a", "x/y/b")]
    got = run(text.relative_path(F.col("a"), F.col("b")), rows, "a string, b string")
    assert got == [posixpath.relpath(b + ".html", posixpath.dirname(a) or ".") for a, b in rows]
    rows = {"https://o/x": "https://o/x", "/zh/f.html": "/site/zh/f.html", "f.html#x": "/site/zh/f.html", "/site/zh/a": "/site/zh/a", "#x": "#x", "a/b/c.html": "/site/zh/c.html"}
    assert run(text.site_href(t, "/site/"), list(rows)) == list(rows.values())


WORDS = st.text("abcあい.+(", min_size=1, max_size=4)


@given(st.lists(WORDS, min_size=1, max_size=12, unique=True), st.lists(st.text("abcあい.+(xyz ", max_size=30), min_size=1, max_size=5))
@settings(max_examples=25, deadline=None)
def test_trie_regex_is_longest_first(keys, texts):
    plain = re.compile("|".join(re.escape(k) for k in sorted(keys, key=lambda k: (-len(k), k))))
    trie = re.compile(lexicon.trie_regex(keys))
    for x in texts:
        assert trie.findall(x) == plain.findall(x)


def test_substitute(run):
    table = {"ab": "1", "abc": "2", "b": "ab", "x.y": "<$1>", "(": "\\"}
    plain = re.compile("|".join(re.escape(k) for k in sorted(table, key=len, reverse=True)))
    rows = ["", "abcab b", "x.y xzy (", "none", "abababc", "bbb"]
    assert run(lexicon.substitute(t, table), rows) == [plain.sub(lambda m: table[m[0]], x) for x in rows]
    assert run(F.size(lexicon.matches(t, [])), ["abc"]) == [0]


def test_large_dictionary(run):
    import time

    keys = {f"k{i:05d}x": str(i) for i in range(3000)}
    doc = " ".join(f"k{i % 5000:05d}x word" for i in range(20_000))
    began = time.time()
    assert run(F.size(lexicon.matches(t, keys)), [doc] * 4) == [12_000] * 4
    assert time.time() - began < 30


def test_align_and_restore(run):
    got = run(lexicon.align_segments(F.col("a"), F.col("b"), {"赤": "红", "abc": "X"}), [("赤、abc", "r、y"), ("赤", "a、b"), ("", "")], "a string, b string")
    assert got == ["红、X", "a、b", ""]
    got = run(lexicon.restore_keys(F.col("a"), F.create_map(F.lit(1), F.lit("one"), F.lit(2), F.lit("$2"))), [("{{key1}}-{{key2}}{{key9}}",), ("plain",)], "a string")
    assert got == ["one-$2", "plain"]


EFFECTS = ["敵全体に3倍 防御20％ダウン 攻撃力50%アップ", "攻防60%ダウン、味方の速度30%アップ", "与ダメージ25%アップ ダメージ40%上昇", "敵単体に10倍の攻撃、敵横一列に4倍", "防御 30%\nアップ", "必殺威力×12 回復 無効", "防御が10%" + "x" * 60 + "ダウン", "防御10%防御20%防御30%ダウン", "", "必殺ゲージ15%増 チャージ20%"]


def _near(x, pattern, verb):
    x, best = x.replace("％", "%"), 0.0
    for m in re.finditer(pattern, x):
        if re.search(verb, x[m.start() : m.start() + 44]):
            best = max(best, int(m[1]))
    return best


def test_windowed_features(run):
    for pattern, verb in ((r"防御.{0,16}?(\d+)%", X.DOWN), (r"攻撃力?.{0,12}?(\d+)%", X.UP), (r"ダメージ.{0,8}?(\d+)%", X.UP), (r"速度.{0,10}?(\d+)%", X.UP)):
        assert run(X.largest_near(t, pattern, verb), EFFECTS) == [_near(x, pattern, verb) for x in EFFECTS]
    assert run(X.defence_down(t), EFFECTS)[:2] == [0.2, 0.6]
    assert [tuple(r) for r in run(X.ultimate(t), [EFFECTS[0], EFFECTS[3], EFFECTS[5], ""])] == [(3.0, True, "全体"), (10.0, False, "横一列"), (12.0, False, ""), (0.0, False, "")]
    assert run(X.charge_up(t), EFFECTS)[-1] == 0.2
    assert run(X.has_any(t, X.HEAL), EFFECTS)[5] is True


def test_model_parts(run):
    rows = [(0.0,), (0.5,), (0.7,), (1.5,)]

    def combo(cr):
        p = min(cr, 0.95)
        return 1.0 if p <= 0 else 1 + p * 0.8 + p**2 * 0.6 + p**3 * 0.4 + 0.3 * p**4 / (1 - p)

    assert run(X.combo_multiplier(F.col("t")), rows, "t double") == pytest.approx([combo(r[0]) for r in rows])
    assert run(X.awakened_interval(F.col("t")), [(3.0,), (2.0,), (7.0,)], "t double") == [3.0, 3.0, 5.0]
    assert run(X.awakened_charge(F.col("t")), [(14.0,), (15.0,), (20.0,), (5.0,)], "t double") == [15.0, 15.0, 20.0, 11.0]
    got = [r for r in run(X.tier(F.col("t"), F.lit(10)), [(i,) for i in range(1, 11)], "t int")]
    assert got == ["T0", "T1", "T1", "T2", "T2", "T2", "T3", "T3", "T3", "T3"]


def test_python_functions(run):
    pairs = [("abc", "abd"), ("", ""), ("x" * 300, "x" * 299 + "y"), ("日本", "日本語")]
    got = run(python.similarity("a", "b"), pairs, "a string, b string")
    assert got == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert run(python.strip_tag_pairs(t), ["a <a href=x>S</a> b", "<b><i>x</i>y</b>z", "n"]) == ["a  b", "y</b>z", "n"]
    assert python.wrap("SSR SR <a>R</a> R", [("R", "[R]"), ("SR", "[SR]"), ("SSR", "[SSR]")], frozenset({"R", "SR"})) == "[SSR] [SR] <a>[R]</a> [R]"  # texts between tags are wrapped, tags are not
    assert run(text.whole_word_count(t, "R"), ["SSR R (R) R1"]) == [2]


PAGE = """<html><body><div id="other">x</div><div id="body"><!-- c --><script>var a="</p>";</script><h2 id="content_1_0">概 要<a href="#t">†</a></h2>
<div class="contents"><ul><li><a href="#zzz">概要</a></ul></div><p>一つ目<p>二つ目 <b>bold<i>mis</b>nested</i>
<a href="?cmd=edit&page=x">edit</a><a href="x?plugin=attach&f=1"><img src="p.png"></a><a href="#n"></a><img src="/image/paraedit.png">
<table><tr><th>必殺技<tr><th>名称<th>効果<tr><td>A<td>全体<br>攻撃<td><img src="i.png"><tr><th>固有効果<tr><td colspan=2>z</table>
<div class="rgn-container">ルールについて</div><form>gone</form></div><div class="pcomment"><form><ul><li class="pcmt"><input class="pcmt">hello -- [id]</li></ul></form></div></body></html>"""


def test_tree():
    body = dom.clean(PAGE)
    dom.relink_contents(body)
    html = body.inner()
    assert "gone" not in html and "cmd=edit" not in html and "paraedit" not in html and "<!--" not in html and "ルール" not in html
    assert '<img src="p.png">' in html and "plugin=attach" not in html and 'href="#content_1_0"' in html and "hello -- [id]" in html
    assert [n.content(" ") for n in dom.innermost_blocks(body) if n.tag == "p"] == ["一つ目", "二つ目 bold mis nested"]
    assert dom.parse(dom.parse(PAGE).inner()).inner() == dom.parse(PAGE).inner()
    assert dom.sections(PAGE, ["必殺技", "固有効果"]) == [
        ("必殺技", 0, 0, True, "名称", 1, 1), ("必殺技", 0, 1, True, "効果", 1, 1), ("必殺技", 1, 0, False, "A", 1, 1), ("必殺技", 1, 1, False, "全体\n攻撃", 1, 1), ("固有効果", 0, 0, False, "z", 2, 1),
    ]


def test_profile_without_a_heading():
    """A table that begins with the name heading is the profile, that row included; one of its own goes first."""
    table = "<body><table><tr><th>名前<td>N<tr><th>本名<td>M<tr><th>必殺技<tr><td>A</table></body>"
    want = [("プロフィール", 0, 0, True, "名前", 1, 1), ("プロフィール", 0, 1, False, "N", 1, 1), ("プロフィール", 1, 0, True, "本名", 1, 1), ("プロフィール", 1, 1, False, "M", 1, 1), ("必殺技", 0, 0, False, "A", 1, 1)]
    assert dom.sections(table, ["プロフィール", "必殺技"]) == want
    assert dom.sections(table, ["必殺技"]) == want[4:]
    own = "<body><table><tr><th>プロフィール<tr><td>P</table><table><tr><th>名前<td>N</table></body>"
    assert dom.sections(own, ["プロフィール"]) == [("プロフィール", 0, 0, False, "P", 1, 1)]


def test_links_are_rewritten():
    root = dom.parse('<a href="?A">a</a><a href="?B#x">b</a><a href="https://o/">o</a><a href="#k">k</a>')
    dom.rewrite_links(root, lambda h: h[1:].split("#")[0] if h.startswith("?") else None, {"A": "page-a"}, lambda n: f"https://src/?{n}")
    odd = dom.parse('<a href="?A">a</a>')
    dom.rewrite_links(odd, lambda h: "A", {"A": "x/50% off?#1 ü"}, str)
    assert odd.find("a")[0].attrs["href"] == "__ROUTE__/x/50%25%20off%3F%231%20%C3%BC.html"
    assert [(a.attrs["href"], a.attrs.get("class"), a.attrs.get("target")) for a in root.find("a")] == [("__ROUTE__/page-a.html", "internal-link", None), ("https://src/?B#x", "source-link", "_blank"), ("https://o/", None, "_blank"), ("#k", None, None)]


def test_keyed():
    template, keys, blocks = dom.keyed("<p>日本<b>語</b>です</p><pre>漢字</pre><p>abc</p><td> 一 </td>")
    assert keys == [(1, "日本"), (2, "語"), (3, "です"), (4, "一")] and blocks == [(1, "日本語です", [1, 2, 3])]
    assert template == '<p data-i18n-blk="blk1">{{key1}}<b>{{key2}}</b>{{key3}}</p><pre>漢字</pre><p>abc</p><td> {{key4}} </td>'


def test_deep_pages():
    assert dom.visible_text("<div>" * 3000 + "x") == "x"


def test_ratio_as_difflib():
    """Also of long texts, where frequent characters are left out at first."""
    r = random.Random(8)
    for letters in ("ab", "abcé😀", "etaoin shrdlu" * 3 + "".join(map(chr, range(0x3041, 0x3090)))):
        for n in (0, 1, 30, 199, 200, 450):
            x = "".join(r.choice(letters) for _ in range(n))
            y = list(x)
            for _ in range(5):
                at = r.randrange(len(y) + 1)
                y[at : at + r.randrange(9)] = [r.choice(letters) for _ in range(r.randrange(9))]
            for b in ("".join(y), x, "", "".join(r.choice(letters) for _ in range(n))):
                assert python.ratio(x, b) == difflib.SequenceMatcher(None, x, b).ratio()
    x = "".join(r.choice("etaoin shrdlu" * 3 + "".join(map(chr, range(0x3041, 0x3090)))) for _ in range(3000))
    assert python.ratio(x, x[::2] + x) == 6000 / 7500


def test_templates_in_long_texts(spark):
    """In time that doesn't grow with the square of a stretch without x."""
    df = spark.createDataFrame([("1" + "y" * 400_000,), ("1" + "y" * 400_000 + "x10",)], "t string")
    assert [r[0] for r in df.select(text.is_numeric_template(df.t)).collect()] == [False, True]


def test_segments_are_cut_once(spark):
    df = spark.createDataFrame([("a, b", "c, d"), ("a, b", "c"), (None, "c"), ("a", None)], "s string, t string")
    done = df.select(lexicon.align_segments(df.s, df.t, {"a": "A"}).alias("r"))
    assert [r.r for r in done.collect()] == ["A, d", "c", "c", None]
    assert done._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2
