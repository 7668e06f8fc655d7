"""Joins with a dictionary's, a position's or a tree's semantics.

Order is data: whatever is first or last wins by an explicit order column, never by a row's place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One row a key: the first by ``order``, or the last. Partial aggregation keeps hot keys cheap."""
    rest = [c for c in rows.columns if c not in keys]
    whole, by = F.struct(*rest), F.struct(*order)
    picked = rows.groupBy(*keys).agg((F.max_by if last else F.min_by)(whole, by).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def layered_lookup(rows: DataFrame, key: str, layers: list[DataFrame], value: str = "value") -> DataFrame:
    """``value`` from the first layer (key, value) that has the row's key; null if none has."""
    union = layers[0].select("key", "value", F.lit(0).alias("_layer"))
    for i, layer in enumerate(layers[1:], 1):
        union = union.unionByName(layer.select("key", "value", F.lit(i).alias("_layer")))
    best = union.filter("value IS NOT NULL AND value <> ''").groupBy("key").agg(F.min_by("value", F.struct("_layer", "value")).alias(value))
    return rows.join(best.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left").drop("_key")


def two_level_lookup(rows: DataFrame, exact: str, loose: str, table: DataFrame, value: str = "value") -> DataFrame:
    """By the exact key, else by the loose one; ``table`` has (exact, loose, value, ord), first wins."""
    a = table.groupBy(F.col("exact").alias("_e")).agg(F.min_by("value", "ord").alias("_a"))
    b = table.groupBy(F.col("loose").alias("_l")).agg(F.min_by("value", "ord").alias("_b"))
    joined = rows.join(a, F.col(exact) == F.col("_e"), "left").join(b, F.col(loose) == F.col("_l"), "left")
    return joined.withColumn(value, F.coalesce("_a", "_b")).drop("_e", "_l", "_a", "_b")


def positional_join(left: DataFrame, right: DataFrame, group: str, order: str) -> DataFrame:
    """The n-th row of a group with the n-th of the other side's, only in groups of equal counts.

    ``order`` is on both sides; right columns other than ``group`` and ``order`` come along.
    """

    def numbered(rows: DataFrame) -> DataFrame:
        within = Window.partitionBy(group)
        return rows.withColumn("_n", F.row_number().over(within.orderBy(order))).withColumn("_count", F.count(F.lit(1)).over(within))

    a, b = numbered(left), numbered(right).drop(order).withColumnRenamed(group, "_group")
    return a.join(b.withColumnsRenamed({"_n": "_m", "_count": "_total"}), (F.col(group) == F.col("_group")) & (F.col("_n") == F.col("_m")) & (F.col("_count") == F.col("_total"))).drop("_group", "_m", "_total", "_count", "_n")


def prefix_join(rows: DataFrame, text: str, names: DataFrame, delimiters: str = " 　()（）,，.。;；:：") -> DataFrame:
    """The longest name that the text starts with, followed by a delimiter or the end; null if none.

    Each place where a name may end is a candidate, so this is an equi-join on prefixes as long as the longest name.
    """
    longest = names.agg(F.max(F.length("name"))).first()[0] or 1
    texts = rows.select(F.col(text).alias("_text")).distinct()
    ends = F.filter(F.sequence(F.lit(1), F.least(F.length("_text"), F.lit(longest))), lambda i: (i == F.length("_text")) | F.instr(F.lit(delimiters), F.substr(F.col("_text"), i + 1, F.lit(1))).cast("boolean"))
    tries = texts.filter("_text <> ''").select("_text", F.explode(F.transform(ends, lambda i: F.substr(F.col("_text"), F.lit(1), i))).alias("name"))
    found = tries.join(names.select("name").distinct(), "name").groupBy("_text").agg(F.max_by("name", F.length("name")).alias("prefix"))
    return rows.join(found, F.col(text) == F.col("_text"), "left").drop("_text")


def as_of_level(rows: DataFrame, keys: list[str], level: str, order: str, limit: int) -> DataFrame:
    """Of each key the row with the greatest level up to ``limit``, else with the greatest; of equal levels the last."""
    rest = [c for c in rows.columns if c not in keys]
    by = F.struct(F.when(F.col(level) <= limit, 1).otherwise(0), F.col(level), F.col(order))
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def changed(new: DataFrame, old: DataFrame, key: str, state: str) -> DataFrame:
    """Rows of ``new`` that have no old row or another state; two unknown states are equal."""
    before = old.select(F.col(key).alias("_key"), F.col(state).alias("_state"), F.lit(True).alias("_known"))
    joined = new.join(before, F.col(key) == F.col("_key"), "left")
    return joined.filter(F.col("_known").isNull() | ~F.col(state).eqNullSafe(F.col("_state"))).drop("_key", "_state", "_known")


def nearest_ancestor(nodes: DataFrame, wanted: Column, page: str = "page") -> DataFrame:
    """(page, node, ancestor): the nearest node above for which ``wanted`` holds; nodes without one are left out.

    ``nodes`` has page, node, parent. Levels are climbed by joins, as many as the deepest tree has.
    """
    marked = nodes.withColumn("_wanted", wanted).select(page, "node", "parent", "_wanted")
    up = marked.select(F.col(page).alias("_p"), F.col("node").alias("_n"), F.col("parent").alias("_up"), "_wanted")
    at, found = marked.select(page, "node", F.col("parent").alias("_at")), None
    while not at.isEmpty():
        step = at.join(up, (F.col(page) == F.col("_p")) & (F.col("_at") == F.col("_n"))).persist()  # a level is made once
        hit = step.filter("_wanted").select(page, "node", F.col("_at").alias("ancestor"))
        found = hit if found is None else found.unionByName(hit)
        at = step.filter("NOT _wanted AND _up >= 0").select(page, "node", F.col("_up").alias("_at"))
    return found if found is not None else nodes.select(page, "node", F.col("node").alias("ancestor")).limit(0)


def alias_map(entities: DataFrame, names: DataFrame) -> DataFrame:
    """(alias, target): an entity's own name, and the translated names of those that exist; the first wins."""
    own = entities.select(F.col("name").alias("alias"), F.col("name").alias("target"), F.lit(0).alias("prio"), F.col("ord"))
    other = names.join(entities.select(F.col("name").alias("ja")), "ja", "left_semi").select(F.col("zh").alias("alias"), F.col("ja").alias("target"), F.lit(1).alias("prio"), "ord")
    return first_by(own.unionByName(other).filter("alias <> ''"), ["alias"], ["prio", "ord"]).select("alias", "target")
