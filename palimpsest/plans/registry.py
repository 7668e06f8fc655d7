"""Plans around the page registry: discovery, the mirror plan, updates, page times, the navigation tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dom import Links
from ..functions.text import fallback_slug, href_to_name, is_excluded, name_key, page_url, percent_encode
from ..operators.joins import changed, first_by
from ..operators.order import ordered_groups, unique_names
from ..operators.store import latest


def page_links(pages: DataFrame, base: str, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, name, label, ord): a page's links to other pages, the first of each name."""
    found = pages.select(page, html).lateralJoin(Links(F.col(html).outer()))
    named = found.select(page, href_to_name(F.col("href"), base).alias("name"), "label", "ord").filter("name IS NOT NULL")
    return first_by(named, [page, "name"], ["ord"])


def resolve(links: DataFrame, registry: DataFrame, base: str) -> DataFrame:
    """Links with their route where the name is registered, else with the source's address."""
    known = registry.select(F.col("name").alias("_name"), "slug")
    joined = links.join(known, F.col("name") == F.col("_name"), "left").drop("_name")
    return joined.withColumn("target", F.when(F.col("slug").isNotNull(), F.concat(F.lit("__ROUTE__/"), percent_encode(F.col("slug"), "/"), F.lit(".html"))).otherwise(page_url(F.col("name"), base)))


def navigation(wanted: DataFrame, links: DataFrame, aliases: dict[str, str], slugs: dict[str, str]) -> DataFrame:
    """Registry rows of wanted pages (ord, name, category): the link whose name matches after aliases and normalisation,
    else the alias or the name itself."""
    alias = F.create_map(*[F.lit(x) for p in aliases.items() for x in p]) if aliases else F.create_map().cast("map<string, string>")
    slug = F.create_map(*[F.lit(x) for p in slugs.items() for x in p]) if slugs else F.create_map().cast("map<string, string>")
    asked = wanted.withColumn("_want", F.coalesce(F.try_element_at(alias, F.col("name")), F.col("name"))).withColumn("_key", name_key(F.col("_want")))
    have = first_by(links.withColumn("_norm", name_key(F.col("name"))).select("_norm", F.col("name").alias("actual"), "ord"), ["_norm"], ["ord"]).select("_norm", "actual")
    joined = asked.join(have, F.col("_key") == F.col("_norm"), "left").withColumn("actual", F.coalesce("actual", "_want"))
    found = F.coalesce(F.try_element_at(slug, F.col("name")), F.try_element_at(slug, F.col("actual")), fallback_slug(F.col("actual")))
    return joined.select("ord", F.col("actual").alias("name"), found.alias("slug"), "category", F.lit("watch").alias("mode"))


def entity_rows(cells: DataFrame, base: str) -> DataFrame:
    """Entities of list pages: (name, rarity, ord, slug) of links in rows under a rarity's heading, the first of each name.

    ``cells``: ord, kind (``heading`` or ``link``), text, href.
    """
    letters = F.regexp_replace(F.regexp_replace("text", "[^A-Za-z]", ""), "edit", "")
    window = Window.partitionBy("page").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    state = cells.withColumn("_r", F.last(F.when(F.col("kind") == "heading", F.when(letters.isin("SSR", "SR", "R"), letters).otherwise("")), ignorenulls=True).over(window))
    links = state.filter((F.col("kind") == "link") & (F.col("_r") != "")).withColumn("name", href_to_name(F.col("href"), base))
    links = links.filter(F.col("name").isNotNull()).filter(~is_excluded(F.col("name")))
    return first_by(links.select("page", "name", F.col("_r").alias("rarity"), "ord"), ["page", "name"], ["ord"]).withColumn("slug", F.concat(F.lit("characters/"), "name"))


def mirror_plan(registry: DataFrame, group_of: Column, groups: list[str] | DataFrame, base: str) -> DataFrame:
    """Every group in its order with its pages (name, slug, url) in the registry's; empty groups stay."""
    rows = registry.withColumn("_group", group_of).withColumn("page", F.struct("name", "slug", page_url(F.col("name"), base).alias("url")))
    return ordered_groups(rows, "_group", groups, "ord", "page")


def incremental_update(recent: DataFrame, registry: DataFrame, manifest: DataFrame, current: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Names to do again: watched pages among the recent changes whose last change differs from the manifest's, and those
    that failed before, until they have failed ``max_attempts`` times in a row (the manifest's ``attempts``).
    ``current``: name, wiki_last_modified as fetched now."""
    watched = registry.filter("mode = 'watch'").select("name").join(recent.select("name").distinct(), "name", "left_semi")
    failed = F.col("status").isin("missing", "challenged", "error")
    given_up = manifest.filter(failed & (F.coalesce("attempts", F.lit(1)) >= max_attempts)).select("name")
    again = manifest.filter(failed).select("name")
    candidates = current.join(watched.join(given_up, "name", "left_anti"), "name", "left_semi")
    news = changed(candidates, manifest, "name", "wiki_last_modified").select("name")
    return news.unionByName(candidates.select("name").join(again, "name", "left_semi")).distinct().orderBy("name")


def counted_attempts(manifest: DataFrame, news: DataFrame) -> DataFrame:
    """``news`` (name, status and more) with ``attempts``, the failures in a row that it ends: 0 where it went well."""
    held = manifest.select(F.col("name").alias("_name"), F.coalesce("attempts", F.lit(0)).alias("_attempts"))
    joined = news.join(held, F.col("name") == F.col("_name"), "left")
    failed = F.col("status").isin("missing", "challenged", "error")
    return joined.withColumn("attempts", F.when(failed, F.coalesce("_attempts", F.lit(0)) + 1).otherwise(0)).drop("_name", "_attempts")


def manifest_upsert(manifest: DataFrame, news: DataFrame) -> DataFrame:
    return latest(manifest.unionByName(news), ["name"], "fetched_at", ["sha256"])


def to_parse(manifest: DataFrame) -> DataFrame:
    """Pages fetched well whose content isn't what was parsed last."""
    return manifest.filter("status = 'ok'").filter(~F.col("sha256").eqNullSafe(F.col("parsed_sha256")))


def drain_queue(planned: DataFrame, done: DataFrame) -> DataFrame:
    """Planned pages that failed stay planned."""
    return planned.join(done.filter("ok").select("name"), "name", "left_anti")


def page_times(registry: DataFrame, manifest: DataFrame, categories: list[str], order: list[str]) -> DataFrame:
    """Registered pages with their address, times and ``place`` (1, 2, ...): by category, then canonical order, then name.

    Places count within a category, behind all categories before it.
    """
    rank = lambda column, names: F.coalesce(F.try_element_at(F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))]), F.col(column)), F.lit(10**9)) if names else F.lit(10**9)
    held = manifest.select(F.col("name").alias("_name"), F.col("url").alias("_url"), "wiki_last_modified", "fetched_at", "status")
    joined = registry.join(held, F.col("name") == F.col("_name"), "left").withColumn("_c", rank("category", categories)).withColumn("_s", rank("slug", order))
    counts = registry.withColumn("_c", rank("category", categories)).groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(F.col("_c").alias("_group"), (F.sum("_n").over(Window.orderBy("_c")) - F.col("_n")).alias("_before"))  # a row a category
    within = F.row_number().over(Window.partitionBy("_c").orderBy("_s", "name"))
    placed = joined.withColumn("_within", within).join(F.broadcast(before), F.col("_c") == F.col("_group"))
    return placed.select("name", "slug", "category", F.coalesce("url", "_url").alias("url"), "wiki_last_modified", "fetched_at", (F.col("_before") + F.col("_within")).alias("place")).orderBy("place")


def update_log(rows: DataFrame, at: Column, name: str, days: int = 14) -> DataFrame:
    """The newest days with their names in order."""
    dated = rows.withColumn("day", at)
    by_day = dated.groupBy("day").agg(F.array_sort(F.collect_set(name)).alias("names"))
    return by_day.orderBy(F.col("day").desc()).limit(days)


def slugs(registry: DataFrame, slug: Column) -> DataFrame:
    return unique_names(registry.withColumn("_base", slug), "_base", ["ord"]).drop("_base")


def tree(edges: DataFrame, root: str) -> DataFrame:
    """(node, path, depth, sort) below ``root`` of (parent, node, ord); sorted by ``sort`` they are in pre-order.

    A join a level, each level made once; there is no limit on levels or rows. A node below itself raises.
    """
    place = F.lpad(F.col("ord").cast("string"), 9, "0")
    level = edges.filter(F.col("parent") == root).select("node", F.col("node").alias("path"), place.alias("sort"), F.lit(0).alias("depth"), F.array("node").alias("_up")).persist()
    found = level
    while not level.isEmpty():
        below = edges.select(F.col("parent").alias("_parent"), F.col("node").alias("_node"), place.alias("_place"))
        step = level.join(below, F.col("node") == F.col("_parent"))
        level = step.select(F.col("_node").alias("node"), F.concat_ws("/", "path", "_node").alias("path"), F.concat_ws(".", "sort", "_place").alias("sort"), (F.col("depth") + 1).alias("depth"), F.concat("_up", F.array("_node")).alias("_up"), F.array_contains("_up", F.col("_node")).alias("_again")).persist()
        if again := level.filter("_again").select("path").first():
            raise ValueError(f"a node below itself: {again[0]}")
        level = level.drop("_again")
        found = found.unionByName(level)
    return found.drop("_up")


def navigation_list(edges: DataFrame, root: str, pages: DataFrame) -> DataFrame:
    """:func:`tree` with the ``pages`` (name, ord) that it doesn't reach behind it, on the first level: node, path, depth, sort, listed."""
    listed = tree(edges, root).withColumn("listed", F.lit(True))
    rest = pages.filter("name IS NOT NULL").groupBy("name").agg(F.min("ord").alias("ord")).join(listed.select(F.col("node").alias("name")), "name", "left_anti")
    place = F.concat(F.lit("~"), F.lpad(F.col("ord").cast("string"), 9, "0"))  # behind all digits
    return listed.unionByName(rest.select(F.col("name").alias("node"), F.col("name").alias("path"), F.lit(0).alias("depth"), place.alias("sort"), F.lit(False).alias("listed")))


def unprotected(rows: DataFrame, name: str, protected: DataFrame) -> DataFrame:
    """``rows`` but those whose page is ``protected`` (name): its texts are kept as they are. Rows without a page stay."""
    return rows.join(protected.select(F.col("name").alias("_name")).distinct(), F.col(name) == F.col("_name"), "left_anti")
