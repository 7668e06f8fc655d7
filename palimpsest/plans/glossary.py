"""Plans around the dictionaries: filling the store from them, migrating numbered files, merging and building term lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_kana, without_dagger
from ..operators.joins import first_by, layered_lookup, positional_join
from ..operators.order import sequence_ids
from ..operators.store import Norm, missing


def filled_from(items: DataFrame, layers: list[DataFrame], norm: Norm) -> DataFrame:
    """Keys or blocks whose empty translation comes from a dictionary that has the whole text; of several layers (key,
    value) the last counts. What is filled stays, so a second run changes nothing."""
    found = layered_lookup(items.withColumn("_norm", norm(F.col("ja"))), "_norm", layers[::-1], "_value")
    return found.withColumn("zh", F.when(missing("zh"), F.coalesce("_value", "zh")).otherwise(F.col("zh"))).drop("_norm", "_value")


def _usable(ja: Column, zh: Column) -> Column:
    """A translation that isn't empty, and equals its source only where that shows no kana."""
    return (F.coalesce(zh, F.lit("")) != "") & ((zh != ja) | ~has_kana(ja))


def migrated(items: DataFrame, chunks: DataFrame, entries: DataFrame, norm: Norm) -> DataFrame:
    """Items (slug, ja, zh) whose empty translation comes from an old file of their page. ``chunks`` (slug, i, text,
    translate) number the texts to translate 0, 1, ...; ``entries`` (slug, part, ord, mark, body) of a page's files have the
    translation of number ``mark``, the last of a number counting. The first translation of a text on a page counts."""
    numbered = entries.filter(F.col("mark").rlike(r"^\d+$")).withColumn("n", F.col("mark").cast("long"))
    body = first_by(numbered.select("slug", "n", "part", "ord", without_dagger(F.trim("body")).alias("_zh")), ["slug", "n"], ["part", "ord"], last=True)
    wanted = sequence_ids(chunks.filter("translate"), "slug", ["i"], "n")
    place = wanted.select("slug", (F.col("n") - 1).alias("n"), norm(F.col("text")).alias("_ja"))
    pairs = place.join(body, ["slug", "n"]).filter((F.col("_ja") != "") & _usable(F.col("_ja"), F.col("_zh")))
    first = first_by(pairs.select("slug", "_ja", "n", "_zh"), ["slug", "_ja"], ["n"]).select(F.col("slug").alias("_slug"), "_ja", "_zh")
    joined = items.withColumn("_norm", norm(F.col("ja"))).join(first, (F.col("slug") == F.col("_slug")) & (F.col("_norm") == F.col("_ja")), "left")
    return joined.withColumn("zh", F.when(missing("zh"), F.coalesce("_zh", "zh")).otherwise(F.col("zh"))).drop("_norm", "_slug", "_ja", "_zh")


def merged_terms(listed: DataFrame, translated: DataFrame, overlay: DataFrame | None = None) -> DataFrame:
    """(ord, ja, zh, state) of a list of terms (ord, freq, ja) and its translated file, as ``files.tab_lines`` reads it: by
    position where its first fields are numbers (then both must be equally long), else by the source. Usable lines of
    ``overlay`` replace them. ``state``: done, missing (shows kana and isn't translated) or same (written alike)."""
    rows = translated.select("ord", "first", F.trim(F.coalesce("second", F.lit(""))).alias("zh"), "kind")
    kinds = {r["kind"] for r in rows.select("kind").distinct().collect()}  # one file: one kind
    if kinds == {"numeric"}:
        left, right = listed.select(F.lit(0).alias("g"), "ord", "ja"), rows.select(F.lit(0).alias("g"), "ord", "zh")
        if left.count() != right.count():
            raise ValueError("the translated file and the list differ in length")
        pairs = positional_join(left, right, "g", "ord").select("ja", "ord", "zh")
    else:
        pairs = rows.select(F.col("first").alias("ja"), "ord", "zh")
    pairs = first_by(pairs, ["ja"], ["ord"], last=True).select("ja", "zh", F.lit(0).alias("_layer"))
    if overlay is not None:
        more = overlay.filter("kind = 'ja'").select(F.col("first").alias("ja"), F.trim(F.coalesce("second", F.lit(""))).alias("zh"), "ord").filter("zh <> '' AND zh <> ja")
        pairs = first_by(pairs.unionByName(first_by(more, ["ja"], ["ord"], last=True).select("ja", "zh", F.lit(1).alias("_layer"))), ["ja"], ["_layer"], last=True)
    place = listed.groupBy(F.col("ja").alias("_ja")).agg(F.min("ord").alias("ord"))
    state = F.when((F.col("zh") != "") & (F.col("zh") != F.col("ja")), "done").when(has_kana(F.col("ja")), "missing").otherwise("same")
    return pairs.join(place, F.col("ja") == F.col("_ja"), "left").select("ord", "ja", "zh", state.alias("state"))


def term_file(terms: DataFrame, header: str, blank: bool = False) -> DataFrame:
    """One text of ``ja<TAB>zh`` lines in the list's order, terms that it lacks last; ``blank`` leaves the translation to be
    filled in. A control file of one site: it is one row."""
    lines = F.array_sort(F.collect_list(F.struct(F.coalesce("ord", F.lit(1 << 30)).alias("ord"), "ja", (F.lit("") if blank else F.col("zh")).alias("zh"))))
    body = F.array_join(F.transform(F.col("l"), lambda x: F.concat(x["ja"], F.lit("\t"), x["zh"])), "\n")
    return terms.agg(lines.alias("l")).select(F.concat(F.lit(f"# {header}\n\n"), body, F.lit("\n")).alias("text"))


def built(terms: DataFrame) -> DataFrame:
    """(ja, zh, rank): the finished terms as a dictionary, longest first."""
    done = terms.filter("state = 'done'").select("ja", "zh")
    sizes = done.groupBy(F.length("ja").alias("_n")).agg(F.count(F.lit(1)).alias("_c"))
    longer = Window.orderBy(F.col("_n").desc()).rowsBetween(Window.unboundedPreceding, 0)  # a row a length
    before = sizes.select("_n", (F.sum("_c").over(longer) - F.col("_c")).alias("_before"))
    numbered = sequence_ids(done.withColumn("_size", F.length("ja")), "_size", ["ja"], "_within")
    return numbered.join(before, F.col("_size") == F.col("_n")).select("ja", "zh", (F.col("_before") + F.col("_within")).alias("rank"))
