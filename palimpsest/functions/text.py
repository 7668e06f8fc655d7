"""Scalar functions over text, as Column expressions.

White space means Unicode's: ``(?U)\\s`` matches U+3000 and U+00A0, plain ``\\s`` does not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and formats that results depend on.
SOURCE_SCRIPT = "[ぁ-んァ-ヶ一-龯々〆ヵヶ]"
KANA = "[ぁ-んァ-ヶ]"
KANA_BLOCK = "[぀-ゟ゠-ヿ]"
EXCLUDED_NAMES = [r"^コメント/", r"^テーブル/", r"掲示板", r"^はじめに", r"編集者", r"寝室シーン", r"^MenuBar$", r"^SideBar$", r"^ヘッダ", r"^フッタ", r"練習", r"雛形", r"^InterWiki", r"^RecentChanges", r"^最近の更新"]
CHALLENGE_MARKS = ["cf-turnstile", "海外からのアクセス"]
MISSING_MARKS = ["ページが見つかりません", "は存在しません"]
WEEKDAYS = {"月": "周一", "火": "周二", "水": "周三", "木": "周四", "金": "周五", "土": "周六", "日": "周日"}
UNSAFE = {"/": "／", "\\": "＼", ":": "：", "*": "＊", "?": "？", '"': "″", "<": "＜", ">": "＞", "|": "｜"}
LAST_MODIFIED = r"(?:最終更新日時|最終更新時間|Last-modified):\s*(\d{4}-\d{2}-\d{2})\s*\(.\d?\)\s*(\d{1,2}:\d{2}(?::\d{2})?)"
EDIT_STAMP = r"--\[[^\]]*\][0-9]{4}-[0-9]{2}-[0-9]{2}\([^)]*\)[0-9]{2}:[0-9]{2}:[0-9]{2}"
SIGNATURE = r"(?U)\s*(?:--|――|——|—)\s*\[[^\[\]]{1,48}\]\s*(?:\d{4}-\d{2}-\d{2}\s*[（(][^（）()]{1,4}[)）]\s*\d{1,2}:\d{2}(?::\d{2})?)?\s*"
NUMERIC_TEMPLATES = [r"^第?\d+期$", r"^阶梯抽卡\d+$", r"^\d+次$", r"^\d+-\d+[（(]\s*消費ST\d+[）)]$", r"^[（(]\s*第\d+段[）)]$", r"x\d+$", r"^[^A-Za-z]*UP期間\d+$"]
METADATA = r"最終更新時間|最終更新日時|Last-modified|第?\d+日：|^\s*最終更新"
SENTENCE_ENDS = "。！？.!?"
NAME_SUFFIX = r"^(.*?)([（(][^（）()]*[）)]|[　\s]*[RrSsUuNn]+|[　\s]*※|[　][ぁ-んァ-ヶー一-龯]+)$"
SEGMENT = r"[一-鿿぀-ヿ㐀-䶿0-9A-Za-z０-９Ａ-Ｚａ-ｚ]+|[^一-鿿぀-ヿ㐀-䶿0-9A-Za-z０-９Ａ-Ｚａ-ｚ]+"


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def squeeze(text: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def without_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")


def without_dagger(text: Column) -> Column:
    """Drop the mark that wiki headings end with."""
    return F.regexp_replace(text, r"\s*†\s*$", "")


def name_key(name: Column) -> Column:
    """Names that differ in bracket width, middle dots, blanks or case have one key."""
    return F.lower(F.translate(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""), "（）・ 　", "()"))


def is_excluded(name: Column) -> Column:
    return name.rlike(any_of(EXCLUDED_NAMES))


def is_challenge(html: Column) -> Column:
    return contains_any(html, CHALLENGE_MARKS)


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def is_missing(html: Column, begin: str = r'<div id="body">', end: str = r'<hr class="full_hr"', marks: list[str] | None = None) -> Column:
    """The body region, without tags, is at most 300 characters long and holds one of the phrases."""
    body = F.trim(strip_tags(F.regexp_extract(html, f"(?s){begin}(.*?){end}", 1)))
    return html.rlike(f"(?s){begin}.*?{end}") & (F.length(body) <= 300) & contains_any(body, marks or MISSING_MARKS)


def needs_translation(text: Column) -> Column:
    return text.rlike(SOURCE_SCRIPT)


def has_kana(text: Column) -> Column:
    return text.rlike(KANA)


def is_ui_fragment(text: Column) -> Column:
    """Empty, a list item, or up to ten characters that don't end a sentence."""
    text = F.coalesce(text, F.lit(""))
    return (text == "") | text.startswith("・") | (~F.right(text, F.lit(1)).isin(*SENTENCE_ENDS) & (F.length(text) <= 10))


def is_numeric_template(text: Column) -> Column:
    """Digits in a known form and no kana: such texts are the same in both languages."""
    return text.rlike(r"\d") & text.rlike(any_of(NUMERIC_TEMPLATES)) & ~text.rlike(KANA_BLOCK)


def is_metadata(text: Column) -> Column:
    return text.rlike(METADATA)


def skip_in_worklist(text: Column, allow_fragments: bool = False) -> Column:
    skip = (F.coalesce(text, F.lit("")) == "") | is_metadata(text) | is_numeric_template(text)
    return skip if allow_fragments else skip | is_ui_fragment(text)


def safe_id(name: Column) -> Column:
    return F.translate(name, "".join(UNSAFE), "".join(UNSAFE.values()))


def percent_encode(text: Column, keep: str = "") -> Column:
    """Percent-encoding that leaves letters, digits, ``_.-~`` and ``keep`` alone."""
    coded = F.url_encode(text)
    for a, b in {"+": "%20", "*": "%2A", "%7E": "~"}.items():
        coded = F.replace(coded, F.lit(a), F.lit(b))
    for c in keep:
        coded = F.replace(coded, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return coded


def file_name(name: Column) -> Column:
    coded = F.concat(percent_encode(name), F.lit(".html"))
    return F.when(F.length(coded) <= 180, coded).otherwise(F.concat(F.substring(F.sha1(F.encode(name, "UTF-8")), 1, 16), F.lit(".html")))


def page_url(name: Column, base: str) -> Column:
    return F.concat(F.lit(f"{base}?"), percent_encode(name, "/"))


def href_to_name(href: Column, base: str) -> Column:
    """The page that a link names: ``?name``, ``./?name`` or the site's own address with a query; null for others."""
    href = F.trim(href)
    raw = F.when(href.startswith("./?"), F.substr(href, F.lit(4))).when(href.startswith("?"), F.substr(href, F.lit(2))).when(
        href.startswith(f"{base}?") & ~F.contains(href, F.lit("=")), F.substring_index(F.substr(href, F.lit(len(base) + 2)), "#", 1))
    name = F.trim(F.substring_index(F.try_url_decode(raw), "#", 1))
    return F.when((name != "") & ~F.contains(name, F.lit("&")) & ~F.contains(name, F.lit("=")), name)


def asset_name(url: Column) -> Column:
    """The first 16 hex digits of the address's SHA-256 and its extension: what follows the last dot of the last part."""
    last = F.element_at(F.split(url, "/"), -1)
    extension = F.substring(F.regexp_replace(F.lower(F.element_at(F.split(url, r"\."), -1)), "[^a-z0-9]", ""), 1, 5)
    extension = F.when(F.contains(last, F.lit(".")) & (extension != ""), extension).otherwise("png")
    return F.concat(F.substring(F.sha2(F.encode(url, "UTF-8"), 256), 1, 16), F.lit("."), extension)


def fallback_slug(name: Column) -> Column:
    return F.concat(F.lit("p-"), F.substring(F.md5(F.encode(name, "UTF-8")), 1, 10))


def wiki_last_modified(html: Column) -> Column:
    day, time = F.regexp_extract(html, LAST_MODIFIED, 1), F.regexp_extract(html, LAST_MODIFIED, 2)
    return F.when(day != "", F.concat_ws(" ", day, time))


def strip_stamps(text: Column) -> Column:
    """Drop edit stamps and comment signatures."""
    return F.regexp_replace(F.regexp_replace(text, EDIT_STAMP, ""), SIGNATURE, "")


def weekday_names(text: Column) -> Column:
    for a, b in WEEKDAYS.items():
        text = F.regexp_replace(text, f"([（(]){a}([)）])", f"$1{b}$2")
    return text


def split_suffix(name: Column) -> Column:
    """(base, suffix): brackets, rarity letters, a note mark or a description after a wide blank; else (name, '')."""
    suffix = F.regexp_extract(name, NAME_SUFFIX, 2)
    return F.struct(F.when(suffix != "", F.regexp_extract(name, NAME_SUFFIX, 1)).otherwise(name).alias("base"), suffix.alias("suffix"))


def cell_lines(html: Column) -> Column:
    """A cell's text: line breaks stay, white space in a line is squeezed, empty lines go."""
    parts = F.split(F.regexp_replace(html, r"(?i)<br\s*/?>", ""), "")
    return F.array_join(F.filter(F.transform(parts, lambda x: squeeze(F.regexp_replace(x, "<[^>]+>", " "))), lambda x: x != ""), "\n")


def escape_html(text: Column) -> Column:
    for a, b in {"&": "&amp;", "<": "&lt;", ">": "&gt;"}.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def relative_path(source: Column, target: Column) -> Column:
    """From the page ``source`` to ``target``.html: one ``../`` for each folder that the two don't share."""
    here, there = F.slice(F.split(source, "/"), 1, F.size(F.split(source, "/")) - 1), F.split(F.concat(target, F.lit(".html")), "/")
    most = F.least(F.size(here), F.size(there) - 1)
    shared = F.aggregate(F.sequence(F.lit(0), most), F.lit(0), lambda n, i: F.when((i < most) & (n == i) & (F.get(here, i) == F.get(there, i)), n + 1).otherwise(n))
    up = F.repeat(F.lit("../"), (F.size(here) - shared).cast("int"))
    return F.concat(up, F.array_join(F.slice(there, (shared + 1).cast("int"), F.size(there)), "/"))


def site_href(href: Column, base: str) -> Column:
    """Outer links stay; absolute ones get the site's prefix; others their last part under the site's pages."""
    last = F.element_at(F.split(F.regexp_replace(F.substring_index(href, "#", 1), "/+$", ""), "/"), -1)
    return (
        F.when(href.rlike("^https?://") | href.startswith(base), href)
        .when(href.startswith("/"), F.concat(F.lit(base.rstrip("/")), href))
        .when(last == "", href)
        .otherwise(F.concat(F.lit(f"{base}zh/"), last))
    )


def one_line(text: Column) -> Column:
    return F.trim(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" ")))


def shares_character(a: Column, b: Column) -> Column:
    return F.arrays_overlap(F.split(a, ""), F.split(b, ""))


def digits_only(text: Column) -> Column:
    """An integer if, commas and white space apart, the text is digits only; else null."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[,\s]", "")
    return F.when(bare.rlike("^[0-9]+$"), bare.cast("long"))


def number_before(text: Column, unit: str) -> Column:
    found = F.regexp_extract(text, rf"(\d+(?:\.\d+)?)\s*{unit}", 1)
    return F.when(found != "", found.cast("double"))


def letters_label(number: Column) -> Column:
    """0 to A, 25 to Z, 26 to AA, 702 to AAA and on, for numbers of up to seven letters."""
    letters, before = [], 0  # the labels that are shorter
    for k in range(7):
        letter = F.char(F.lit(65) + (F.floor((number - before) / 26**k) % 26).cast("int"))
        letters.insert(0, F.when(number >= before, letter).otherwise(""))
        before += 26 ** (k + 1)
    return F.concat(*letters)


def category_of(value: Column, table: dict[str, str], default: str) -> Column:
    """A value's group by a literal table."""
    groups = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.element_at(groups, value), F.lit(default))


def first_match(text: Column, table: list[tuple[str, str]], otherwise: Column) -> Column:
    """The label of the first phrase that the text holds."""
    out = F
    for phrase, label in table:
        out = out.when(F.contains(text, F.lit(phrase)), F.lit(label))
    return out.otherwise(otherwise)


def whole_word_count(text: Column, word: str) -> Column:
    """Occurrences of a word that no ASCII letter or digit adjoins."""
    quoted = "".join(f"\\{c}" if not c.isalnum() and c.isascii() else c for c in word)
    return F.regexp_count(text, F.lit(f"(?<![A-Za-z0-9]){quoted}(?![A-Za-z0-9])"))
