"""Compare parsed pages with their source: independent extraction, similarity, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.python import similarity
from ..functions.text import KANA


def compare(source: DataFrame, parsed: DataFrame, key: str, text: str, threshold: float = 0.9) -> DataFrame:
    """(key, side, ratio, low): pages of either side; a page that one side lacks has no ratio."""
    a, b = source.select(key, F.col(text).alias("_a")), parsed.select(F.col(key).alias("_key"), F.col(text).alias("_b"))
    joined = a.join(b, F.col(key) == F.col("_key"), "full").withColumn("side", F.when(F.col("_b").isNull(), "source").when(F.col("_a").isNull(), "parsed").otherwise("both"))
    joined = joined.withColumn("ratio", F.when(F.col("side") == "both", similarity("_a", "_b")))
    return joined.select(F.coalesce(key, "_key").alias(key), "side", "ratio", (F.coalesce("ratio", F.lit(0.0)) < threshold).alias("low"))


def summary(compared: DataFrame) -> DataFrame:
    """Pages, pages of both sides, and the mean ratio over all pages and over those compared."""
    return compared.agg(F.count(F.lit(1)).alias("pages"), F.count("ratio").alias("compared"), F.avg(F.coalesce("ratio", F.lit(0.0))).alias("mean_over_all"), F.avg("ratio").alias("mean_over_compared"), F.count_if("low").alias("low"))


def require(summary_row: DataFrame, least_mean: float) -> None:
    """Raise if the scan failed: the exit code of a command line."""
    row = summary_row.first()
    if row["pages"] and (row["mean_over_all"] < least_mean or row["low"]):
        raise ValueError(f"{row['low']} of {row['pages']} pages differ from their source; mean similarity {row['mean_over_all']:.3f}")


def residual(rows: DataFrame, text: str, pattern: str = KANA) -> DataFrame:
    """Characters of the source script that are left, by row."""
    return rows.withColumn("residual", F.regexp_count(F.col(text), F.lit(pattern)).cast("long"))


def size_stats(rows: DataFrame, text: str, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Characters in all, on average and at most, empty texts and distinct keys, of all rows or by the columns ``by``."""
    size = F.length(F.coalesce(text, F.lit("")))
    return rows.groupBy(*by).agg(F.sum(size).cast("long").alias("chars"), F.avg(size).alias("mean_chars"), F.max(size).cast("long").alias("max_chars"), F.count_if(size == 0).alias("empty"), F.count_distinct(key).alias("keys"))
