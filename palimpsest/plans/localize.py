"""From keys and blocks to pages: rendering, display names, dictionary bake-in, triage of links, snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import align_segments
from ..functions.render import Terms, put_comments, put_originals, render
from ..functions.text import asset_name, file_name, has_kana, is_metadata, is_numeric_template
from ..operators.joins import first_by, layered_lookup, positional_join, prefix_join
from ..operators.store import missing, promoted_links, rendered

Norm = Callable[[Column], Column]
#: Names that a site's pages show; every task holds them.
MAX_NAMES = 100_000


def pages(templates: DataFrame, keys: DataFrame, blocks: DataFrame, layers: list[DataFrame], names: DataFrame, norm: Norm, base: str) -> DataFrame:
    """(slug, html) of templates (slug, html); ``layers``: dictionaries (key, value) in order; ``names``: (name, shown)."""
    shown = rendered(keys, layers, norm, is_metadata, is_numeric_template)
    by_page = shown.groupBy("slug").agg(F.map_from_entries(F.collect_list(F.struct("key_no", "rendered"))).alias("k"), F.collect_list(F.when(~missing("zh"), F.col("key_no"))).alias("d"))
    held = blocks.groupBy("slug").agg(F.collect_list(F.struct("blk_no", "ja", "zh", "keys")).alias("b"))
    named = names.groupBy("name").agg(F.min("shown").alias("shown"))  # one site's names: a control table, broadcast as one map
    if (found := named.limit(MAX_NAMES + 1).count()) > MAX_NAMES:
        raise ValueError(f"over {found - 1} names: render sites apart")
    table = named.agg(F.map_from_entries(F.collect_list(F.struct("name", "shown"))).alias("n"))
    joined = templates.join(by_page, "slug", "left").join(held, "slug", "left").join(F.broadcast(table))
    empty = F.create_map().cast("map<int, string>")
    return joined.select("slug", render(F.col("html"), F.coalesce("k", empty), F.col("d"), F.col("b"), F.col("n"), base).alias("html"))


def display_names(links: DataFrame, entity_names: DataFrame, titles: DataFrame, own: DataFrame, terms: DataFrame, norm: Norm) -> DataFrame:
    """Links (slug, text, href_slug, is_entity) with ``shown``: an entity's name first for entities; then the target
    page's title, the page's own translation, the dictionary, an entity's name, the text itself."""
    rows = links.withColumn("_n", norm(F.col("text"))).withColumn("_own", F.concat_ws("\u0000", "slug", norm(F.col("text"))))
    rows = layered_lookup(rows, "_n", [entity_names], "_entity")
    rows = layered_lookup(rows, "href_slug", [titles], "_title")
    rows = layered_lookup(rows, "_own", [own.select(F.concat_ws("\u0000", "slug", "key").alias("key"), "value")], "_page")
    rows = layered_lookup(rows, "_n", [terms], "_term")
    shown = F.coalesce(F.when(F.col("is_entity"), F.col("_entity")), "_title", "_page", "_term", "_entity", "text")
    return rows.withColumn("shown", shown).drop("_n", "_own", "_entity", "_title", "_page", "_term")


def read_fragments(registry: DataFrame, target: DataFrame, source: DataFrame) -> DataFrame:
    """(slug, html, translated): the target language's fragment, else the source's, else nothing."""
    a, b = target.select("slug", F.col("html").alias("_t")), source.select("slug", F.col("html").alias("_s"))
    return registry.select("slug").join(a, "slug", "left").join(b, "slug", "left").select("slug", F.coalesce("_t", "_s", F.lit("")).alias("html"), F.col("_t").isNotNull().alias("translated"))


HEAD = r"^[一-鿿぀-ヿ㐀-䶿]+(?:[ 　]*[一-鿿぀-ヿ㐀-䶿]+)*"


def bake_in(entries: DataFrame, dictionary: DataFrame, names: DataFrame, segments: dict[str, str], norm_no_space: Norm) -> DataFrame:
    """Translations corrected by the first rule that applies: the whole source is a key; the source starts with a name,
    whose rendering replaces the translation's head; else segment by segment where both have equally many.

    ``entries``: ja, zh; ``dictionary``: (key, value) by text without white space; ``names``: (name, value);
    ``segments``: a small dictionary of whole segments. A second run changes nothing.
    """
    rows = entries.withColumn("_k", norm_no_space(F.col("ja")))
    rows = layered_lookup(rows, "_k", [dictionary], "_whole")
    rows = prefix_join(rows, "ja", names)
    rows = rows.join(names.select(F.col("name").alias("_name"), F.col("value").alias("_value")), F.col("prefix") == F.col("_name"), "left")
    after = F.regexp_replace("zh", HEAD, "")
    headed = F.when(F.regexp_extract("zh", HEAD, 0) == F.col("_value"), F.col("zh")).when(F.col("zh").rlike(HEAD), F.concat("_value", after)).otherwise(F.col("_value"))
    fixed = F.coalesce("_whole", F.when(F.col("_value").isNotNull() & ~F.startswith(F.col("zh"), F.col("_value")), headed), align_segments(F.col("ja"), F.col("zh"), segments))
    return rows.withColumn("zh", F.when(missing("zh"), F.col("zh")).otherwise(fixed)).drop("_k", "_whole", "prefix", "_name", "_value")


def is_linkable(href: Column, slug: Column, own_host: str) -> Column:
    """Outer links, and pages other than this one; no anchors, table editors, missing files or the source's own host."""
    target = F.regexp_extract(href, r"([^/#]+)\.html(?:#.*)?$", 1)
    outer = href.rlike("^https?://") & (F.coalesce(F.try_parse_url(href, F.lit("HOST")), F.lit("")) != own_host)
    inner = ~href.rlike("^https?://") & (target != "") & (target != slug)
    return (outer | inner) & ~href.startswith("#") & ~href.rlike("table_edit|file-not-found")


def triage(links: DataFrame, pages: DataFrame, dictionary: DataFrame, norm_no_space: Norm) -> DataFrame:
    """(slug, ja, zh, href, scope, reason): links that hold everywhere or on their page need nothing; the others say why a
    person has to look: the page lacks the words (mismatch), they aren't translated, or still are in the source script.

    ``links``: slug, ja, zh, href; ``pages``: slug, text in the target language.
    """
    rows = layered_lookup(links.withColumn("_n", norm_no_space(F.col("ja"))), "_n", [dictionary], "_d").withColumn("zh", F.coalesce("_d", "zh"))
    scopes = promoted_links(rows.select("slug", F.lit("").alias("ja"), "zh", "href")).select(F.col("zh").alias("_zh"), F.col("href").alias("_href"), F.when(F.col("scope") == "*", "*").alias("_scope"))
    joined = rows.join(scopes, (F.col("zh") == F.col("_zh")) & (F.col("href") == F.col("_href"))).join(pages.select("slug", F.col("text").alias("_text")), "slug", "left")
    reason = (
        F.when(F.col("zh") == F.col("ja"), F.when(has_kana(F.col("ja")), "untranslated"))
        .when(has_kana(F.col("zh")), "zh_japanese")
        .when(F.col("_scope").isNull() & ~F.contains(F.coalesce("_text", F.lit("")), F.col("zh")), "mismatch")
    )
    return joined.select("slug", "ja", "zh", "href", F.coalesce("_scope", "slug").alias("scope"), reason.alias("reason"))


def merge_links(truth: DataFrame, found: DataFrame) -> DataFrame:
    """The link table with what it lacks; entries that are there stay as they are."""
    new = found.join(truth.select("slug", "zh", "href"), ["slug", "zh", "href"], "left_anti")
    return truth.unionByName(first_by(new.select("slug", "ja", "zh", "href"), ["slug", "zh", "href"], ["ja"]).select("slug", "ja", "zh", "href"))


def worklists_by_group(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Open items with their page's subgroup, so that each subgroup is a list of its own."""
    return items.join(registry.filter("subgroup IS NOT NULL").select("slug", "subgroup"), "slug")


def snapshots(pages: DataFrame) -> DataFrame:
    """(path, content, sha256) of fetched pages (name, content)."""
    return pages.select(file_name(F.col("name")).alias("path"), "content", F.sha2("content", 256).alias("sha256"))


def pending_assets(images: DataFrame, present: DataFrame) -> DataFrame:
    """(url, file) of images (url) whose local copy isn't present (file), each once."""
    wanted = images.filter(~F.col("url").startswith("data:")).select("url", asset_name(F.col("url")).alias("file")).distinct()
    return wanted.join(present.select("file"), "file", "left_anti").select("url", "file")


def release_dates(cells: DataFrame, heading: str = "実装日") -> DataFrame:
    """(name, date) of list tables: the column under ``heading``, the name in the second; the first of a name counts.

    ``cells``: page, tab, row, cell, text; row 0 is a table's heading row.
    """
    at = cells.filter((F.col("row") == 0) & (F.col("text") == heading)).groupBy("page", "tab").agg(F.min("cell").alias("_c"))
    body = cells.filter("row > 0")
    date = body.join(at, ["page", "tab"]).filter("cell = _c").select("page", "tab", "row", F.col("text").alias("date"))
    name = body.filter("cell = 1 AND text <> ''").select("page", "tab", "row", F.col("text").alias("name"))
    return first_by(name.join(date, ["page", "tab", "row"]), ["name"], ["page", "tab", "row"]).select("name", "date")


def archive_plan(paths: DataFrame, roles: dict[str, str], folder: str) -> DataFrame:
    """(path, target): finished files and the folder of their role, by the first pattern that matches the file name."""
    name = F.element_at(F.split("path", "/"), -1)
    role = F
    for pattern, label in roles.items():
        role = role.when(name.rlike(pattern), F.lit(label))
    return paths.select("path", role.otherwise(F.lit(None)).alias("role"), name.alias("_n")).filter("role IS NOT NULL").select("path", F.concat_ws("/", F.lit(folder), "role", "_n").alias("target"))


def with_originals(zh: DataFrame, ja: DataFrame) -> DataFrame:
    """(slug, html): the terms of ``zh`` pages with the originals of the ``ja`` page's, by position; pages whose lists differ in
    length stay."""
    terms = lambda pages, name: pages.lateralJoin(Terms(F.col("html").outer())).select("slug", "i", F.col("term").alias(name))
    pairs = positional_join(terms(zh, "term"), terms(ja, "original"), "slug", "i")
    maps = pairs.groupBy("slug").agg(F.map_from_entries(F.collect_list(F.struct("i", "original"))).alias("_originals"))
    return zh.join(maps, "slug", "left").select("slug", put_originals("html", "_originals").alias("html"))


def with_comments(pages: DataFrame, known: DataFrame) -> DataFrame:
    """(slug, html): pages with the comments translated that ``known`` (slug, comment_id, zh) has, by page and id."""
    latest = known.filter("zh <> ''").groupBy("slug", "comment_id").agg(F.max("zh").alias("zh"))
    maps = latest.groupBy("slug").agg(F.map_from_entries(F.collect_list(F.struct("comment_id", "zh"))).alias("_comments"))
    return pages.join(maps, "slug", "left").select("slug", put_comments("html", "_comments").alias("html"))
