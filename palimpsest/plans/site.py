"""The site's plans from end to end: discovery of pages, parsing of what changed, an incremental update.

Pages come in and go out as tables, and what fetches them is a function of the caller (``sources.web.fetch_all`` does it
from executors), so every plan also runs on stored pages.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dom import Chunks, page_fragment
from ..functions.text import page_url, wiki_last_modified
from ..operators import memory
from ..operators.joins import first_by
from ..sources.commits import Change, Commits, retried
from ..sources.web import page_status
from . import registry

Fetch = Callable[[DataFrame], DataFrame]
KEYS = "ord int, key_no int, ja string, zh string"


def discover(menu: DataFrame, lists: DataFrame, wanted: DataFrame, known: DataFrame, base: str, aliases: dict[str, str] | None = None, slugs: dict[str, str] | None = None) -> DataFrame:
    """The registry (ord, name, slug, category, mode, rarity): what ``known`` holds, the wanted pages among the links of the
    ``menu`` pages (page_id, html), then the entities of the ``lists``' cells; the newest entry of a name counts.
    ``wanted``: ord, name, category."""
    links = registry.page_links(menu, base).select("name", "ord")
    empty = F.lit(None).cast("string")
    watched = registry.navigation(wanted, links, aliases or {}, slugs or {}).select((F.col("ord") + 1_000_000).alias("ord"), "name", "slug", "category", "mode", empty.alias("rarity"))
    entities = registry.entity_rows(lists, base).select((F.col("ord") + 2_000_000).alias("ord"), "name", "slug", F.lit("character-detail").alias("category"), F.lit("static").alias("mode"), "rarity")
    rows = known.select("ord", "name", "slug", "category", "mode", "rarity").unionByName(watched).unionByName(entities)
    newest = first_by(rows, ["name"], ["ord"], last=True)
    place = rows.groupBy("name").agg(F.min("ord").alias("ord"))  # an entry keeps its place
    return newest.drop("ord").join(place, "name").select("ord", "name", "slug", "category", "mode", "rarity")


@dataclass
class Parsed:
    """What parsing makes: ``fragments`` (name, html), ``chunks`` (name, i, tag, html, text, translate)."""

    fragments: DataFrame
    chunks: DataFrame

    def write(self, folder: str) -> None:
        self.fragments.write.mode("overwrite").parquet(f"{folder}/fragments")
        self.chunks.write.mode("overwrite").partitionBy("translate").parquet(f"{folder}/chunks")


def parse(manifest: DataFrame, snapshots: DataFrame) -> tuple[Parsed, DataFrame]:
    """Parse the pages whose content isn't what was parsed last, and the manifest that says so. ``snapshots``: name, html."""
    due = registry.to_parse(manifest).select("name", "sha256")
    pages = snapshots.join(due.select("name"), "name", "left_semi")
    chunks = pages.lateralJoin(Chunks(F.col("html").outer())).select("name", "i", "tag", "text", "translate")
    done = manifest.join(due.select("name", F.col("sha256").alias("_now")), "name", "left").withColumn("parsed_sha256", F.coalesce("_now", "parsed_sha256")).drop("_now")
    return Parsed(pages.select("name", page_fragment("html").alias("html")), chunks), done


def fetched(pages: DataFrame, fetch: Fetch, base: str, at: str) -> DataFrame:
    """Manifest rows and content of pages (name) fetched at the time ``at``: name, url, html, sha256, status,
    wiki_last_modified, fetched_at, error."""
    got = fetch(pages.select("name", page_url(F.col("name"), base).alias("url")))
    html = F.make_valid_utf8(F.col("content").cast("string"))
    rows = got.select("url", html.alias("html"), F.sha2("content", 256).alias("sha256"), page_status(html, F.col("error")).alias("status"), wiki_last_modified(html).alias("wiki_last_modified"), F.lit(at).alias("fetched_at"), "error")
    return pages.select("name", page_url(F.col("name"), base).alias("url")).join(rows, "url")


@dataclass
class Update:
    """The manifest after an update, the snapshots' new rows, what was parsed, and whether entities have to be read anew."""

    manifest: DataFrame
    snapshots: DataFrame
    parsed: Parsed
    entities_changed: bool


def update(recent: DataFrame, pages: DataFrame, manifest: DataFrame, current: DataFrame, fetch: Fetch, base: str, at: str, max_attempts: int = 3, keep: Fetch | None = None) -> Update:
    """Fetch and parse what changed. ``pages`` is the registry; ``manifest``: name, url, sha256, status, wiki_last_modified,
    fetched_at, error, attempts, parsed_sha256. A page that couldn't be fetched keeps its last content. ``keep`` stores the answers
    and reads them back, so that no page is asked for twice (a second request could answer otherwise); without it they are cached."""
    due = registry.incremental_update(recent, pages, manifest, current, max_attempts)
    answers = fetched(due, fetch, base, at)
    news = keep(answers) if keep else answers.cache()
    held = manifest.select("name", F.col("sha256").alias("_sha"), F.col("wiki_last_modified").alias("_modified"), "parsed_sha256")
    counted = registry.counted_attempts(manifest, news).join(held, "name", "left")
    failed = F.col("status") != "ok"
    kept = counted.withColumn("sha256", F.when(failed, F.col("_sha")).otherwise(F.col("sha256"))).withColumn("wiki_last_modified", F.when(failed, F.col("_modified")).otherwise(F.col("wiki_last_modified")))
    whole = registry.manifest_upsert(manifest, kept.select(*manifest.columns))
    snapshots = news.filter("status = 'ok'").select("name", "html")
    parsed, done = parse(whole, snapshots)
    touched = parsed.fragments.select("name").join(pages.filter("category = 'character-detail'").select("name"), "name", "left_semi")
    return Update(done, snapshots, parsed, not touched.isEmpty())


def run(commits: Commits, recent: DataFrame, current: DataFrame, fetch: Fetch, base: str, at: str, norm: Callable[[Column], Column], max_attempts: int = 3) -> int:
    """An update from end to end, published as one version: what changed is fetched and parsed, its texts get the numbers and the
    translations of the page's last version, and manifest, snapshots, fragments and keys appear together. Returns the version.

    ``commits`` holds ``registry`` (as :func:`discover` makes it) and ``manifest``; ``keys`` has a row a page: name, keys (ord, key_no,
    ja, zh). Another run that published meanwhile makes this one a :class:`Conflict`; its answers are files by then, so nothing is
    asked for again by a caller that passes them as ``fetch``.
    """
    version = commits.version()
    manifest = commits.read("manifest", version)
    done = update(recent, commits.read("registry", version), manifest, current, fetch, base, at, max_attempts, lambda rows: commits.stage("answers", rows))
    texts = done.parsed.chunks.filter("translate").select(F.col("name").alias("slug"), F.col("i").alias("ord"), F.col("text").alias("ja"))
    known = commits.tables(version)
    if "keys" in known:
        old = commits.read("keys", version).join(done.snapshots.select("name"), "name", "left_semi").select(F.col("name").alias("slug"), F.inline("keys"))
    else:
        old = commits.spark.createDataFrame([], f"slug string, {KEYS}")
    carried = memory.carry_over(old, texts, norm).groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("ord", "key_no", "ja", "zh"))).alias("keys"))
    keys = done.parsed.fragments.select("name").join(carried.withColumnRenamed("slug", "name"), "name", "left")
    keys = keys.select("name", F.coalesce("keys", F.array()).alias("keys"))
    before = manifest.select(*(F.col(c).alias(f"_{c}") for c in manifest.columns))
    same = F.lit(True)
    for c in manifest.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    touched = done.manifest.join(before, F.col("name") == F.col("_name"), "left").filter(~same).select(*manifest.columns)
    return commits.commit({
        "manifest": Change(touched, ["name"]), "snapshots": Change(done.snapshots, ["name"]),
        "fragments": Change(done.parsed.fragments, ["name"]), "keys": Change(keys, ["name"]),
    }, read=version)


def open_items(commits: Commits, version: int | None = None) -> DataFrame:
    """The texts of a version that have no translation yet: name, key_no, ja."""
    return commits.read("keys", version).select("name", F.inline("keys")).filter("coalesce(zh, '') = ''").select("name", "key_no", "ja")


def filled(commits: Commits, translations: DataFrame) -> int:
    """Publish translations (name, key_no, zh) of a version's keys; keys that the version lacks are left out."""

    def change(version: int) -> dict[str, Change]:
        rows = commits.read("keys", version).join(translations.select("name").distinct(), "name", "left_semi").select("name", F.inline("keys"))
        new = translations.groupBy("name", "key_no").agg(F.max("zh").alias("_zh"))
        both = rows.join(new, ["name", "key_no"], "left").withColumn("zh", F.coalesce("_zh", "zh"))
        return {"keys": Change(both.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("ord", "key_no", "ja", "zh"))).alias("keys")), ["name"])}

    return retried(commits, change)
