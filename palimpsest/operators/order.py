"""Order-sensitive operators: numbering, carrying forward, islands, tiers, tops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import tier


def sequence_ids(rows: DataFrame, group: str, order: list[str], name: str = "seq") -> DataFrame:
    """1, 2, ... within each group."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))


def unique_names(rows: DataFrame, base: str, order: list[str], name: str = "slug") -> DataFrame:
    """base, base-1, base-2, ... where a name repeats."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order)) - 1
    return rows.withColumn(name, F.when(n == 0, F.col(base)).otherwise(F.concat_ws("-", F.col(base), n.cast("string"))))


def carry_forward(rows: DataFrame, group: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The last value that isn't null up to each row."""
    window = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(window))


def islands(rows: DataFrame, group: str, order: list[str], same: str, name: str = "island") -> DataFrame:
    """Numbers runs of rows with equal values of ``same``."""
    window = Window.partitionBy(group).orderBy(*order)
    new = F.when(F.col(same).eqNullSafe(F.lag(same).over(window)) & (F.row_number().over(window) > 1), 0).otherwise(1)
    return rows.withColumn("_new", new).withColumn(name, F.sum("_new").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def changes(rows: DataFrame, group: str, order: list[str], state: str) -> DataFrame:
    """Rows whose state differs from the group's last one; the first of a group differs. Two null states are equal. The
    batch twin of ``streaming.changes.changed_pages``."""
    window = Window.partitionBy(group).orderBy(*order)
    marked = rows.withColumn("_same", F.col(state).eqNullSafe(F.lag(state).over(window)) & (F.row_number().over(window) > 1))
    return marked.filter("NOT _same").drop("_same")


def spans(marks: DataFrame, group: str, begin: str, end: Column) -> DataFrame:
    """From each mark to the next, or to ``end``."""
    window = Window.partitionBy(group).orderBy(begin)
    return marks.withColumn("until", F.coalesce(F.lead(begin).over(window), end))


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(window).cast("long")).filter(F.col(name) <= k)


def ranked_in_parts(rows: DataFrame, order: str, ties: str, name: str = "rank") -> DataFrame:
    """Global ranks by falling ``order`` then ``ties`` without gathering all rows in one task.

    Rows are ranked within ranges between quantiles of the sort value, so that skewed values still spread, and each range
    starts after those above it; nulls are last. Rows that share one value are one range's, in the order of ``ties``.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    marks = rows.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)], 100 * parts)).first()[0] or []
    bounds = F.array(*[F.lit(float(m)) for m in sorted(set(marks))]) if marks else F.array().cast("array<double>")
    part = F.when(F.col(order).isNull(), F.lit(parts)).otherwise(F.size(F.filter(bounds, lambda b: b > F.col(order)))).cast("int")
    placed = rows.withColumn("_part", part)
    counts = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}
    starts, total = [], 0
    for p in range(parts + 1):
        starts.append(total)
        total += counts.get(p, 0)
    before = F.element_at(F.array(*[F.lit(int(s)) for s in starts]), F.col("_part") + 1)
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(order).desc_nulls_last(), ties))
    return placed.withColumn(name, (before + within).cast("long")).withColumn("total", F.lit(total).cast("long")).drop("_part")


def tiers(rows: DataFrame, score: str, ties: str) -> DataFrame:
    ranked = ranked_in_parts(rows, score, ties)
    return ranked.withColumn("tier", tier(F.col("rank"), F.col("total")))


def histogram(rows: DataFrame, value: str, width: int = 10) -> DataFrame:
    return rows.groupBy((F.floor(F.col(value) / width) * width).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def pivot_with_total(rows: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts by row and column with the row's total as ``all``; absent pairs count 0."""
    counts = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return rows.groupBy(row).agg(*counts, F.count(F.lit(1)).alias("all"))


def ordered_groups(rows: DataFrame, group: str, groups: list[str] | DataFrame, order: str, value: str) -> DataFrame:
    """Each group's values in order; groups without rows keep an empty list. ``groups``: names in order, or a table (position,
    group_name)."""
    dimension = groups if isinstance(groups, DataFrame) else rows.sparkSession.createDataFrame(list(enumerate(groups)), "position int, group_name string")
    lists = rows.groupBy(F.col(group).alias("_g")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), F.col(value).alias("_value")))), lambda x: x["_value"]).alias("members"))
    return dimension.join(lists, F.col("group_name") == F.col("_g"), "left").select("position", "group_name", F.coalesce("members", F.array().cast(dict(lists.dtypes)["members"])).alias("members"))


def label_pairs(cells: Column) -> Column:
    """Values by label from a row of cells (h, t): after a heading cell comes its value, both are passed; other cells are skipped.

    An empty label keeps nothing; of equal labels the last counts.
    """
    start = F.struct(F.lit(False).alias("open"), F.lit("").alias("label"), F.array().cast("array<struct<key: string, value: string>>").alias("pairs"))

    def step(state: Column, cell: Column) -> Column:
        label = F.trim(F.coalesce(cell["t"], F.lit("")))
        add = F.when(state["label"] != "", F.concat(state["pairs"], F.array(F.struct(state["label"].alias("key"), label.alias("value"))))).otherwise(state["pairs"])
        return (
            F.when(state["open"], F.struct(F.lit(False).alias("open"), F.lit("").alias("label"), add.alias("pairs")))
            .when(cell["h"], F.struct(F.lit(True).alias("open"), label.alias("label"), state["pairs"].alias("pairs")))
            .otherwise(state)
        )

    pairs = F.aggregate(cells, start, step)["pairs"]
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"]))
