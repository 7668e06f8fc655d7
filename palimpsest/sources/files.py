"""Readers and writers of the formats that the layers exchange. Every reader adds ``ord``, the place in its file."""

from __future__ import annotations

from collections.abc import Iterable

import yaml
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import letters_label

REGISTRY = "ord int, name string, slug string, category string, mode string, rarity string, icon string, subgroup string, url string"
_FIELDS = [x.split(" ")[0] for x in REGISTRY.split(", ")][1:]


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of files, UTF-8 with replacement of what isn't."""
    return spark.read.format("binaryFile").load(path).select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def read_registry(spark: SparkSession, text: str) -> DataFrame:
    """The page registry of a YAML text (a control file of one site); ``ord`` keeps its order."""
    pages = (yaml.safe_load(text) or {}).get("pages") or []
    return spark.createDataFrame([(i, *(p.get(f) for f in _FIELDS)) for i, p in enumerate(pages)], REGISTRY)


def registry_yaml(pages: DataFrame) -> str:
    """The registry as YAML, fields in the order above, absent ones left out."""
    rows = [{f: r[f] for f in _FIELDS if r[f] is not None} for r in pages.orderBy("ord").collect()]
    return yaml.safe_dump({"version": 1, "pages": rows}, allow_unicode=True, sort_keys=False)


def read_plan(spark: SparkSession, text: str) -> DataFrame:
    """Planned pages (ord, name, group): entries are names or mappings with name, page or url, and a group."""
    rows = []
    for i, item in enumerate((yaml.safe_load(text) or {}).get("planned") or []):
        item = {"name": item} if isinstance(item, str) else item
        name = item.get("name") or item.get("page") or item.get("url")
        if name:
            rows.append((i, name.strip(), item.get("group")))
    return spark.createDataFrame(rows, "ord int, name string, group string")


def read_glossary(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """(layer, ja, zh, ord) of YAML texts, one a layer: sections are flattened; empty and unchanged entries are left out."""
    rows: list[tuple[str, str, str, int]] = []

    def add(layer: str, node: dict) -> None:
        for k, v in node.items():
            if isinstance(v, dict) and "name_zh" not in v:
                add(layer, v)
                continue
            zh = v.get("name_zh") if isinstance(v, dict) else v
            if isinstance(zh, str) and zh and zh != k:
                rows.append((layer, str(k), zh, len(rows)))

    for layer, text in layers.items():
        add(layer, yaml.safe_load(text) or {})
    return spark.createDataFrame(rows, "layer string, ja string, zh string, ord int")


def numbered_entries(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, ord, mark, body) of ``[N]``, ``[keyN]`` and ``[blkN]`` entries; a body reaches to the next mark, without
    lines that start with ``#``."""
    mark = r"(?m)^\[(key\d+|blk\d+|\d+)\]\s?"
    marks = F.regexp_extract_all(F.col(text), F.lit(mark), 1)
    bodies = F.slice(F.split(F.col(text), mark, -1), 2, 1 << 30)
    rows = files.select(path, F.posexplode(F.arrays_zip(marks.alias("mark"), bodies.alias("body"))).alias("ord", "e"))
    kept = F.array_join(F.filter(F.split(F.col("e.body"), "\n", -1), lambda x: ~F.ltrim(x).startswith("#")), "\n")
    return rows.select(path, "ord", F.col("e.mark").alias("mark"), F.regexp_replace(kept, r"(?U)^\s+|\s+$", "").alias("body"))


def label_sections(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, label, body) of ``===A===`` sections."""
    mark = r"(?m)^===([A-Z]+)===[ \t]*$"
    pairs = F.arrays_zip(F.regexp_extract_all(F.col(text), F.lit(mark), 1).alias("label"), F.slice(F.split(F.col(text), mark, -1), 2, 1 << 30).alias("body"))
    return files.select(path, F.explode(pairs).alias("e")).select(path, F.col("e.label").alias("label"), F.col("e.body").alias("body"))


def label_map(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, label, slug) of the line ``# MAP A=slug B=slug``."""
    line = F.regexp_extract(F.col(text), r"(?m)^# MAP (.*)$", 1)
    parts = F.filter(F.split(line, r"\s+"), lambda x: F.contains(x, F.lit("=")))
    return files.select(path, F.explode(parts).alias("p")).select(path, F.substring_index("p", "=", 1).alias("label"), F.expr("substr(p, instr(p, '=') + 1)").alias("slug"))


def worklist_text(items: DataFrame, resume: int = 0) -> DataFrame:
    """One text of sections: a line ``# MAP``, then ``===A===`` and ``[n] text`` for each page. ``items``: slug, n, ja."""
    pages = items.select("slug").distinct().withColumn("_i", F.row_number().over(Window.orderBy("slug")) - 1 + resume).withColumn("label", letters_label(F.col("_i")))
    lines = items.join(pages, "slug").groupBy("_i", "label", "slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "ja"))), lambda x: F.concat(F.lit("["), x["n"].cast("string"), F.lit("] "), x["ja"])), "\n").alias("body"))
    whole = F.array_sort(F.collect_list(F.struct("_i", "label", "slug", "body")))
    head = F.array_join(F.transform(F.col("s"), lambda x: F.concat(x["label"], F.lit("="), x["slug"])), " ")
    body = F.array_join(F.transform(F.col("s"), lambda x: F.concat(F.lit("==="), x["label"], F.lit("===\n"), x["body"])), "\n")
    return lines.agg(whole.alias("s")).select(F.concat(F.lit("# MAP "), head, F.lit("\n"), body, F.lit("\n")).alias("text"))


def tab_lines(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, ord, first, second, kind) of tab-separated lines, without blank and ``#`` lines; ``kind`` is ``numeric`` for
    files whose first fields are all digits, else ``ja``."""
    rows = files.select(path, F.posexplode(F.split(F.col(text), r"\r?\n", -1)).alias("ord", "line")).filter((F.trim("line") != "") & ~F.ltrim("line").startswith("#"))
    rows = rows.select(path, "ord", F.get(F.split("line", "\t"), F.lit(0)).alias("first"), F.get(F.split("line", "\t"), F.lit(1)).alias("second"))
    kinds = rows.groupBy(path).agg(F.when(F.bool_and(F.col("first").rlike(r"^\d+$")), "numeric").otherwise("ja").alias("kind"))
    return rows.join(kinds, path)


def split_files(files: DataFrame, path: str = "path") -> DataFrame:
    """(base, part, text) of files ``base-N.txt``, or ``base.txt`` as part 0, so that parts sort as numbers."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    part = F.regexp_extract(name, r"^(.*?)-(\d+)\.txt$", 2)
    return files.withColumn("base", F.when(part != "", F.regexp_extract(name, r"^(.*?)-(\d+)\.txt$", 1)).otherwise(F.regexp_replace(name, r"\.txt$", ""))).withColumn("part", F.when(part != "", part.cast("int")).otherwise(0))


def store_rows(files: DataFrame, path: str = "path", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Keys and blocks of JSON files ``slug.json``: ``{keyN: {ja, zh}, _blocks: {blkN: {ja, zh, keys}}}``."""
    slug = F.regexp_extract(F.col(path), r"([^/]+)\.json$", 1)
    keys = F.explode(F.from_json(F.col(text), "map<string, struct<ja: string, zh: string>>")).alias("k", "v")
    key_rows = files.select(slug.alias("slug"), keys).filter(F.col("k").startswith("key"))
    blocks = F.explode(F.from_json(F.get_json_object(F.col(text), "$._blocks"), "map<string, struct<ja: string, zh: string, keys: array<string>>>")).alias("k", "v")
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("int")
    return (
        key_rows.select("slug", number("k").alias("key_no"), "v.ja", "v.zh"),
        files.select(slug.alias("slug"), blocks).select("slug", number("k").alias("blk_no"), "v.ja", "v.zh", F.transform("v.keys", number).alias("keys")),
    )


def store_json(keys: DataFrame, blocks: DataFrame) -> DataFrame:
    """(slug, json): the store's pages as JSON, the inverse of :func:`store_rows`."""
    k = keys.groupBy("slug").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("key"), F.col("key_no").cast("string")).alias("k"), F.struct("ja", "zh").alias("v"))))).alias("k"))
    name = lambda x: F.concat(F.lit("key"), x.cast("string"))
    b = blocks.groupBy("slug").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("blk"), F.col("blk_no").cast("string")).alias("k"), F.struct("ja", "zh", F.transform("keys", name).alias("keys")).alias("v"))))).alias("b"))
    joined = k.join(b, "slug", "left")
    head = F.substring(F.to_json("k"), 1, 1 << 30)
    both = F.when(F.col("b").isNull(), head).otherwise(F.concat(F.expr("substr(to_json(k), 1, length(to_json(k)) - 1)"), F.lit(',"_blocks":'), F.to_json("b"), F.lit("}")))
    return joined.select("slug", both.alias("json"))


def markdown(pages: DataFrame) -> DataFrame:
    """(path, body) of pages (slug, title, html): front matter, the fragment, and a hidden text for search."""
    body = F.concat(F.lit('---\ntitle: "'), F.replace("title", F.lit('"'), F.lit('\\"')), F.lit('"\nlayout: doc\n---\n\n'), F.col("html"), F.lit('\n\n<div class="search-text" hidden>'), F.trim(F.regexp_replace(F.regexp_replace("html", "<[^>]+>", " "), r"\s+", " ")), F.lit("</div>\n"))
    return pages.select(F.concat("slug", F.lit(".md")).alias("path"), body.alias("body"))


def feed_items(feeds: DataFrame, text: str = "text") -> DataFrame:
    """(name, date) of a change feed's items: tags stripped, percent-encoding undone, empty titles left out."""
    pattern = r"(?si)<item[^>]*>.*?<title>(.*?)</title>.*?<dc:date>(.*?)</dc:date>"
    pairs = F.arrays_zip(F.regexp_extract_all(F.col(text), F.lit(pattern), 1).alias("title"), F.regexp_extract_all(F.col(text), F.lit(pattern), 2).alias("date"))
    rows = feeds.select(F.explode(pairs).alias("e"))
    name = F.coalesce(F.try_url_decode(F.regexp_replace(F.trim("e.title"), "<[^>]+>", "")), F.regexp_replace(F.trim("e.title"), "<[^>]+>", ""))
    return rows.select(name.alias("name"), F.trim("e.date").alias("date")).filter("name <> ''")


def write_files(rows: DataFrame, folder: str, columns: Iterable[str] = ("path", "body")) -> None:
    """Text rows as one Parquet table by path; a static site's publisher unpacks it."""
    rows.select(*columns).write.mode("overwrite").parquet(folder)
