"""Reports over entities and files: signals, versatile entities, details by name, the latest file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import entities


def versatile(records: DataFrame, least: int = 3) -> DataFrame:
    """(name, rarity, n, place): entities of ``least`` roles or more, most roles first, then by rarity and name.

    ``place`` counts within (n, rarity), behind all groups before it; there are as many groups as role counts times rarities.
    """
    rows = records.select("name", "rarity", F.size(F.array_distinct("roles")).alias("n")).filter(F.col("n") >= least)
    groups = rows.groupBy("n", "rarity").agg(F.count(F.lit(1)).alias("_c"))
    order = Window.orderBy(F.col("n").desc(), "rarity")
    before = groups.select(F.col("n").alias("_n"), F.col("rarity").alias("_r"), (F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("n", "rarity").orderBy("name"))
    joined = rows.withColumn("_within", within).join(before, (F.col("n") == F.col("_n")) & F.col("rarity").eqNullSafe(F.col("_r")))
    return joined.select("name", "rarity", "n", (F.col("_before") + F.col("_within")).alias("place"))


def details(records: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    """(name, rarity, field, value) of the entities named; unknown names give nothing."""
    wanted = F.broadcast(records.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "name string"))
    pairs = F.explode(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f"`{f}`").cast("string"))])).alias("field", "value")
    return records.join(wanted, "name", "left_semi").select("name", "rarity", pairs)


def cross_counts(records: DataFrame, a: str, b: str) -> DataFrame:
    return records.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def signals(records: DataFrame, stats: list[str], k: int = 20) -> DataFrame:
    """(section, key, rank, name, value): the whole table, the leaders of each stat, the members of each tag, and counts by
    rarity and way of obtaining. ``records``: name, rarity, faction, atk_type, obtain, tags and the stats."""
    none = F.lit(None).cast("long")
    row = lambda section, key, rank, name, value: [section.alias("section"), key.alias("key"), rank.alias("rank"), name.alias("name"), value.alias("value")]
    short = lambda c, n: F.substring(F.when(F.coalesce(c, F.lit("")) == "", "?").otherwise(c), 1, n)
    text: list[Column] = [F.coalesce(F.col(f"`{s}`").cast("string"), F.lit("-")) for s in stats]
    line = F.concat_ws(" | ", short(F.col("faction"), 6), short(F.col("atk_type"), 4), F.concat_ws("/", *text), entities.short_obtain(F.col("obtain")), F.when(F.size("tags") > 0, F.array_join("tags", ",")).otherwise("-"))
    total = records.select(*row(F.lit("table"), F.col("rarity"), none, F.col("name"), line))
    leaders = entities.leaderboard(records, stats, k).select(*row(F.lit("leaders"), F.col("stat"), F.col("rank"), F.col("name"), F.col("value").cast("string")))
    members = records.select(F.explode("tags").alias("tag"), "name", "rarity").select(*row(F.lit("tags"), F.col("tag"), none, F.col("name"), F.col("rarity")))
    ways = cross_counts(records.withColumn("_way", entities.short_obtain(F.col("obtain"))), "rarity", "_way").select(*row(F.lit("obtained"), F.col("rarity"), none, F.col("_way"), F.col("n").cast("string")))
    return total.unionByName(leaders).unionByName(members).unionByName(ways)


def latest_by_name(paths: DataFrame, path: str = "path") -> DataFrame:
    """(folder, file): of each folder the file whose name is greatest; names that hold a date sort by it."""
    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return paths.groupBy(folder.alias("folder")).agg(F.max(F.substring_index(path, "/", -1)).alias("file"))
