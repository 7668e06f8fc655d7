"""The translation store: keys (slug, key_no, ja, zh) and blocks (slug, blk_no, ja, zh, keys).

Empty and missing translations are the same thing. ``norm`` is a Column function that makes texts comparable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_kana, shares_character, skip_in_worklist, split_suffix
from .joins import first_by

Norm = Callable[[Column], Column]


def missing(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def latest(rows: DataFrame, key: list[str], at: str, ties: list[str]) -> DataFrame:
    """Keyed upsert: the newest row of each key."""
    return first_by(rows, key, [at, *ties], last=True)


def coverage(keys: DataFrame, blocks: DataFrame) -> DataFrame:
    """(slug, done, total, ratio): a key is done if it or a block that has it is translated; 0 where there are no keys."""
    covered = blocks.filter(~missing("zh")).select(F.col("slug").alias("_s"), F.explode("keys").alias("_k")).distinct()
    joined = keys.join(covered, (F.col("slug") == F.col("_s")) & (F.col("key_no") == F.col("_k")), "left")
    done = F.count_if(~missing("zh") | F.col("_k").isNotNull())
    return joined.groupBy("slug").agg(done.alias("done"), F.count(F.lit(1)).alias("total"), (done / F.count(F.lit(1))).alias("ratio"))


def worklist(keys: DataFrame, blocks: DataFrame, known: DataFrame, norm: Norm, allow_fragments: bool = False) -> DataFrame:
    """(slug, kind, id, ja, n): untranslated blocks first, then untranslated keys that no untranslated block has;
    without what dictionaries cover or what needs no translator. ``known`` has the dictionaries' keys as ``key``."""

    def wanted(rows: DataFrame) -> DataFrame:  # first, so that only those are joined
        left = rows.filter(~skip_in_worklist(F.col("ja"), allow_fragments)).withColumn("_norm", norm(F.col("ja")))
        return left.join(known.select(F.col("key").alias("_norm")).distinct(), "_norm", "left_anti").drop("_norm")

    open_blocks = blocks.filter(missing("zh"))
    inside = open_blocks.select(F.col("slug").alias("_s"), F.explode("keys").alias("_k")).distinct()
    single = wanted(keys.filter(missing("zh"))).join(inside, (F.col("slug") == F.col("_s")) & (F.col("key_no") == F.col("_k")), "left_anti")
    both = wanted(open_blocks).select("slug", F.lit("blk").alias("kind"), F.col("blk_no").alias("id"), "ja").unionByName(single.select("slug", F.lit("key").alias("kind"), F.col("key_no").alias("id"), "ja"))
    return both.withColumn("n", F.row_number().over(Window.partitionBy("slug").orderBy("kind", "id")).cast("long"))


def deduplicated(items: DataFrame, norm: Norm, order: list[str], at_least: int = 2) -> DataFrame:
    """(norm, ja, occurrences): one row for a text that stands in ``at_least`` places; ja is the first one's."""
    counted = items.withColumn("norm", norm(F.col("ja"))).groupBy("norm").agg(F.min_by("ja", F.struct(*order)).alias("ja"), F.count(F.lit(1)).alias("occurrences"))
    return counted.filter(F.col("occurrences") >= at_least)


def places(items: DataFrame, repeated: DataFrame, norm: Norm) -> DataFrame:
    """(norm, ja, occurrences, slug, kind, id): a row for each place where a text of :func:`deduplicated` stands, so that a
    text with very many places is no long row."""
    where = items.select(norm(F.col("ja")).alias("_norm"), "slug", "kind", "id")
    return where.join(repeated, F.col("_norm") == F.col("norm")).drop("_norm")


def apply_translations(items: DataFrame, done: DataFrame, norm: Norm) -> DataFrame:
    """Fill empty translations by normalised source. A translation that equals its source counts only without kana; of
    several the last by ``ord`` wins; what is filled stays, so that a second run changes nothing."""
    usable = done.filter(~missing("zh") & ((norm(F.col("zh")) != norm(F.col("ja"))) | ~has_kana(F.col("zh"))))
    best = usable.groupBy(norm(F.col("ja")).alias("_norm")).agg(F.max_by("zh", "ord").alias("_zh"))
    joined = items.withColumn("_key", norm(F.col("ja"))).join(best, F.col("_key") == F.col("_norm"), "left")
    return joined.withColumn("zh", F.when(missing("zh"), F.coalesce("_zh", "zh")).otherwise(F.col("zh"))).drop("_key", "_norm", "_zh")


def fill_by_position(items: DataFrame, lines: DataFrame) -> DataFrame:
    """Fill the n-th empty item of a page with the n-th line, only where a page has as many lines as empty items."""
    empty = items.filter(missing("zh")).withColumn("_n", F.row_number().over(Window.partitionBy("slug").orderBy("id"))).withColumn("_count", F.count(F.lit(1)).over(Window.partitionBy("slug")))
    given = lines.withColumn("_m", F.row_number().over(Window.partitionBy("slug").orderBy("n"))).withColumn("_total", F.count(F.lit(1)).over(Window.partitionBy("slug")))
    pairs = empty.join(given.select(F.col("slug").alias("_s"), "_m", "_total", F.col("line").alias("_line")), (F.col("slug") == F.col("_s")) & (F.col("_n") == F.col("_m")) & (F.col("_count") == F.col("_total")))
    new = pairs.select(F.col("slug").alias("_slug"), F.col("id").alias("_id"), "_line")
    return items.join(new, (F.col("slug") == F.col("_slug")) & (F.col("id") == F.col("_id")), "left").withColumn("zh", F.coalesce("_line", "zh")).drop("_slug", "_id", "_line")


def corrections(entries: DataFrame, canonical: DataFrame, norm: Norm) -> DataFrame:
    """(wrong, right): translations of a dictionary's terms that differ from it but share a character; the last wins.

    A source with a suffix takes its base's rendering: a bracket keeps the translation's bracket, other suffixes what
    follows the translation's last blank.
    """
    parts = split_suffix(F.col("ja"))
    rows = entries.filter(~missing("zh")).withColumn("_n", norm(F.col("ja"))).withColumn("_base", norm(parts["base"])).withColumn("_suffix", parts["suffix"])
    table = canonical.select(F.col("key").alias("_key"), F.col("value").alias("_value")).dropDuplicates(["_key"])
    whole = rows.join(table, F.col("_n") == F.col("_key")).withColumn("right", F.col("_value"))
    based = rows.filter("_suffix <> ''").join(table.withColumnRenamed("_key", "_whole").select("_whole"), F.col("_n") == F.col("_whole"), "left_anti").join(table, F.col("_base") == F.col("_key"))
    bracket = F.regexp_extract("zh", r"[（(][^（）()]*[）)]$", 0)
    last = F.substring_index("zh", " ", -1)
    tail = F.when(F.col("_suffix").rlike("^[（(]"), bracket).when(F.contains("zh", F.lit(" ")), F.concat(F.lit(" "), last)).otherwise("")
    both = whole.unionByName(based.withColumn("right", F.concat("_value", tail)))
    wrong = both.filter((F.col("zh") != F.col("right")) & shares_character(F.col("zh"), F.col("_value")))
    return wrong.groupBy(F.col("zh").alias("wrong")).agg(F.max_by("right", F.struct("slug", "ord")).alias("right"))


def promoted_links(links: DataFrame) -> DataFrame:
    """(ja, zh, href, pages, scope): links seen on two pages or more hold everywhere (``*``), others on their page."""
    seen = links.groupBy("ja", "zh", "href").agg(F.count_distinct("slug").alias("pages"), F.min("slug").alias("_slug"))
    return seen.select("ja", "zh", "href", "pages", F.when(F.col("pages") >= 2, "*").otherwise(F.col("_slug")).alias("scope"))


def page_text(items: DataFrame) -> DataFrame:
    """A page's translations in order, a blank between."""
    parts = F.array_sort(F.collect_list(F.struct("kind", "id", F.coalesce("zh", F.lit("")).alias("zh"))))
    return items.groupBy("slug").agg(F.array_join(F.filter(F.transform(parts, lambda p: p["zh"]), lambda z: z != ""), " ").alias("text"))


def rendered(keys: DataFrame, layers: list[DataFrame], norm: Norm, metadata: Callable[[Column], Column], template: Callable[[Column], Column]) -> DataFrame:
    """Each key's text in the target language: nothing for metadata, else the dictionaries in order, the text itself if
    only digits vary, the stored translation, the source."""
    from .joins import layered_lookup

    found = layered_lookup(keys.withColumn("_n", norm(F.col("ja"))), "_n", layers, "_value").drop("_n")
    own = F.when(~missing("zh"), F.col("zh")).otherwise(F.col("ja"))
    text = F.when(metadata(F.col("ja")), F.lit("")).otherwise(F.coalesce("_value", F.when(template(F.col("ja")), F.col("ja")), own))
    return found.withColumn("rendered", text).drop("_value")
