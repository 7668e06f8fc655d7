"""Verbs over stored tables: ``python -m palimpsest VERB --store DIR ...``. A store has Parquet tables ``keys`` and ``blocks``.

The run's date is an argument and never the clock's; a verb returns 0, or 1 where an input is missing or a check fails.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.python import norm
from .operators import store
from .plans import fidelity, glossary
from .sources import files


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    keys, blocks = _table(spark, folder, "keys"), _table(spark, folder, "blocks")
    return keys.select("slug", F.lit("key").alias("kind"), F.col("key_no").alias("id"), "ja", "zh").unionByName(blocks.select("slug", F.lit("blk").alias("kind"), F.col("blk_no").alias("id"), "ja", "zh"))


def worklist(spark: SparkSession, a: argparse.Namespace) -> int:
    """Write the open items, as sections of one text, to ``out``/``date``."""
    known = _table(spark, a.store, "dictionary").select("key")
    items = store.worklist(_table(spark, a.store, "keys"), _table(spark, a.store, "blocks"), known, norm)
    files.worklist_text(items).coalesce(1).write.mode("overwrite").text(f"{a.out}/{a.date}")
    return 0


def coverage(spark: SparkSession, a: argparse.Namespace) -> int:
    store.coverage(_table(spark, a.store, "keys"), _table(spark, a.store, "blocks")).write.mode("overwrite").parquet(a.out)
    return 0


def extract_dedup(spark: SparkSession, a: argparse.Namespace) -> int:
    """Write the untranslated texts that stand in several places to ``out``/``date``, a row a place."""
    items = _items(spark, a.store).filter(store.missing("zh"))
    store.places(items, store.deduplicated(items, norm, ["slug", "kind", "id"]), norm).write.mode("overwrite").parquet(f"{a.out}/{a.date}")
    return 0


def apply_dedup(spark: SparkSession, a: argparse.Namespace) -> int:
    """Fill open items from the translations (ja, zh, ord) in ``input`` and write all items to ``out``."""
    store.apply_translations(_items(spark, a.store), spark.read.parquet(a.input), norm).write.mode("overwrite").parquet(a.out)
    return 0


def glossary_fill(spark: SparkSession, a: argparse.Namespace) -> int:
    glossary.filled_from(_items(spark, a.store), [_table(spark, a.store, "dictionary")], norm).write.mode("overwrite").parquet(a.out)
    return 0


def check(spark: SparkSession, a: argparse.Namespace) -> int:
    """Compare pages (slug, text) of ``input`` with those of ``out``; 1 if they aren't alike."""
    compared = fidelity.compare(spark.read.parquet(a.input), spark.read.parquet(a.out), "slug", "text")
    try:
        fidelity.require(fidelity.summary(compared), a.least)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


VERBS = {"worklist": worklist, "coverage": coverage, "extract-dedup": extract_dedup, "apply-dedup": apply_dedup, "glossary-fill": glossary_fill, "check": check}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="palimpsest")
    parser.add_argument("verb", choices=sorted(VERBS))
    parser.add_argument("--store", default="store")
    parser.add_argument("--input", default="")
    parser.add_argument("--out", required=True)
    parser.add_argument("--date", default="undated")
    parser.add_argument("--least", type=float, default=0.9)
    a = parser.parse_args(arguments)
    try:
        return VERBS[a.verb](spark or SparkSession.builder.appName("palimpsest").getOrCreate(), a)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"no such table: {e.getMessageParameters().get('path')}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
