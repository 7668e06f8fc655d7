"""Mix sources to target weights along a curriculum.

Each source has a weight schedule over training time 0..1; its integral is the source's weight. The words of all sources
are shared by weight, which gives each source a target, and the schedule, scaled to the target, gives its cumulative
demand: the words that the mix has asked of it up to a time. A source's words come in whole rounds of all its documents,
in the order of a digest. A document's training position is the time at which the demand reaches its first word: the
inverse of the cumulative demand. Documents whose position lies before time 1 are taken, whole but for the one in which
the demand ends, and the mix is range-sorted by position.

Edge cases: a null or wordless text has size 0 and is never taken; a text of any length counts whole; a null source is a
source of its own, last in order; a source without words has target 0; with no words at all every target is 0; an empty
table gives an empty result; rows that repeat are documents of their own, next to each other; extra columns are kept by
``mixture`` and ignored otherwise, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT, materialize, numbered, skew_join, word_count

MAX_REPEATS = 3
SLICE_ROWS = 1 << 17  # rows of a slice of a source's order, about


@dataclass(frozen=True)
class Schedule:
    """A weight that moves linearly from ``start`` at time 0 to ``end`` at time 1."""

    start: float
    end: float

    @property
    def integral(self) -> float:
        return (self.start + self.end) / 2

    def due(self, share: Column) -> Column:
        """The time by which ``share`` (0..1) of the whole demand is due: the inverse of start t + (end - start) t^2 / 2."""
        rise = self.end - self.start
        if not rise:
            return share
        return (F.sqrt(F.lit(self.start**2) + F.lit(2 * rise * self.integral) * share) - self.start) / F.lit(rise)


#: Sources take these in turn, in their order: weights 5, 2 and 1, of which the first grows and the last fades.
SCHEDULES = (Schedule(2.5, 7.5), Schedule(2.0, 2.0), Schedule(1.5, 0.5))


def _by_ordinal(values: list[Column]) -> Column:
    out = values[-1]
    for i, v in enumerate(values[:-1]):
        out = F.when(F.col("ord") % len(values) == i, v).otherwise(out)
    return out


def source_targets(sized: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, ord, weight, target)`` of ``(source, size)``: sources in order of code points, null last, take the
    schedules in turn.

    The words of all sources are shared by weight; no target exceeds ``max_repeats`` times its source's size, and what
    is above goes to the others by weight. Only sums come to the driver, however many sources there are.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = numbered(sources, "mix-sources", "ord", F.col("source").asc_nulls_last())
    ranked = materialize(ranked.withColumn("weight", _by_ordinal([F.lit(float(x.integral)) for x in schedules])), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, F.col("source_size") * max_repeats
    while True:  # each round caps at least one more source, and sources cap together, so rounds are few
        full = ranked.filter(capped <= F.lit(level) * F.col("weight")).agg(F.sum(capped)).first()[0] or 0
        rest = ranked.filter(capped > F.lit(level) * F.col("weight")).agg(F.sum("weight")).first()[0]
        risen = (total - full) / rest if rest else level
        if risen <= level:
            break
        level = risen
    return ranked.withColumn("target", F.least(capped.cast("double"), F.lit(level) * F.col("weight")))


def _key(doc_id: Column, text: Column) -> Column:
    """A row's place in its source's order, and 128 bits that tell it from others."""
    return F.md5(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), F.coalesce(text.cast("string"), F.lit(""))), "UTF-8"))


def _placed(docs: DataFrame, schedules: tuple[Schedule, ...], max_repeats: int) -> DataFrame:
    """``doc_id, source, at, size`` of each row with ``low``, the words before it in its source's order, and ``ord``,
    ``source_size``, ``target`` and ``words`` (the whole words of the target)."""
    keyed = docs.select("doc_id", "source", _key(F.col("doc_id"), F.col("text")).alias("at"), word_count(F.col("text")).alias("size"))
    sized = materialize(keyed, "mix-sizes")
    targets = materialize(source_targets(sized, schedules, max_repeats), "mix-targets")
    # Slices of the order: what precedes a slice is summed first, so that one source fills many tasks.
    rows, digits = sized.count(), 3
    while 16**digits * SLICE_ROWS < rows:
        digits += 1
    placed = sized.withColumn("slice", F.substring("at", 1, digits))
    slices = placed.groupBy("source", "slice").agg(F.sum("size").alias("sum"))
    before = slices.select(F.col("source").alias("_s"), F.col("slice").alias("_k"), (F.sum("sum").over(Window.partitionBy("source").orderBy("slice")) - F.col("sum")).alias("before"))
    within = Window.partitionBy("source", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("upto", F.sum("size").over(within))
    placed = placed.join(before, F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("_k")))
    placed = placed.withColumn("low", F.col("before") + F.col("upto") - F.col("size")).withColumn("source", F.struct("source"))
    # A struct is never null, so null sources join like others; sources with many documents are broadcast.
    named = targets.select(F.struct("source").alias("source"), "source_size", "ord", "target", F.floor("target").cast("long").alias("words"), "docs")
    joined = skew_join(placed.select("doc_id", "source", "at", "size", "low"), named, ["source"], F.col("docs") > max(1024, rows // HOT))
    return joined.withColumn("source", F.col("source.source")).drop("docs")


def _rounds() -> tuple[Column, Column]:
    """The whole rounds of a source that the mix takes, and the words it takes of a document in the round after them."""
    whole = F.coalesce(F.floor(F.col("words") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("long")
    rest = F.col("words") - whole * F.col("source_size") - F.col("low")
    return whole, F.greatest(F.lit(0), F.least(F.col("size"), rest))


def _position(low: Column, schedules: tuple[Schedule, ...]) -> Column:
    """The time at which the demand reaches a source's word number ``low``, over all rounds."""
    share = low.cast("double") / F.col("words")
    return _by_ordinal([x.due(share) for x in schedules])


def mix(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``doc_id, size, source_size, target, taken, position`` of every document. ``taken``: the words the mix takes of it,
    repeats counted; ``position``: the time 0..1 at which its first word is due, null if none is taken."""
    rows = _placed(docs, schedules, max_repeats)
    whole, rest = _rounds()
    rows = rows.withColumn("taken", whole * F.col("size") + rest)
    position = F.when(F.col("taken") > 0, _position(F.col("low"), schedules))
    return rows.select("doc_id", "size", "source_size", "target", "taken", position.alias("position"))


def curriculum(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents, range-sorted by training position; documents that the mix doesn't take come last."""
    return mix(docs, **how).orderBy(F.col("position").asc_nulls_last(), "doc_id")


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def first_words(text: str, n: int) -> str:
    """A text up to the end of its n-th word."""
    end = 0
    for i, m in enumerate(_WORD.finditer(text)):
        if i == n:
            break
        end = m.end()
    return text[:end]


def _copies(text: int):
    def copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column(0).flatten()
            cut = [t if n is None or t is None else first_words(t, n) for t, n in zip(columns[text].to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns[text] = pa.array(cut, columns[text].type)
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in batch.schema.field(0).type])

    return copies


def mixture(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, range-sorted by training position.

    These are the documents and words that ``mix`` counts. Of each source one document at most is cut, to the first of
    its words; it is the one in which the source's demand ends.
    """
    kinds = dict(docs.dtypes)
    placed = _placed(docs, schedules, max_repeats)
    # Rows that repeat source, id and text stand next to each other in the order.
    one = placed.filter("size > 0 AND words > 0").groupBy(F.struct("source", "at").alias("row")).agg(F.min("low").alias("first"), *(F.first(c).alias(c) for c in ("size", "ord", "source_size", "words")))
    one = one.filter("words >= source_size OR first < words")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    rows = rows.withColumn("row", F.struct(F.col("doc.source").alias("source"), _key(F.col("doc.doc_id"), F.col("doc.text")).alias("at")))
    rows = rows.join(one.hint("shuffle_hash"), "row")
    rows = rows.withColumn("low", F.col("first") + F.col("size") * (F.row_number().over(Window.partitionBy("row").orderBy("first")) - 1))
    whole, rest = _rounds()
    rows = rows.withColumn("whole", whole).withColumn("rest", rest)
    copies = F.col("whole") + (F.col("rest") > 0).cast("long")
    rows = rows.withColumn("copy", F.explode(F.filter(F.sequence(F.lit(0), F.lit(max_repeats)), lambda i: i < copies)))
    rows = rows.withColumn("part", F.when((F.col("copy") == F.col("whole")) & (F.col("rest") < F.col("size")), F.col("rest")))
    rows = rows.withColumn("position", _position(F.col("low") + F.col("copy") * F.col("source_size"), schedules)).orderBy("position", "row", "copy")
    return rows.select("doc", "part").mapInArrow(_copies(docs.columns.index("text")), ", ".join(f"`{c}` {kinds[c]}" for c in docs.columns))


ORACLE = """
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || coalesce(text, '')) AS place,
  CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
o AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM s),
w AS (SELECT *, CASE turn WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM o),
c AS (SELECT *, source_size * 3 AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM w),
f AS (SELECT *, coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0.0) AS full_before,
  sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM c),
l AS (SELECT max((total - full_before) / rest) AS level FROM f),
t AS (SELECT source, source_size, turn, least(CAST(cap AS DOUBLE), level * weight) AS target FROM f, l),
r AS (SELECT doc_id, size, source_size, turn, target, CAST(floor(target) AS BIGINT) AS words,
  CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS low
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole FROM r),
k AS (SELECT *, whole * size + greatest(0, least(size, words - whole * source_size - low)) AS taken, CAST(low AS DOUBLE) / nullif(words, 0) AS share FROM n)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken, CASE WHEN taken > 0 THEN CASE turn
  WHEN 0 THEN (sqrt(6.25::DOUBLE + 50.0::DOUBLE * share) - 2.5::DOUBLE) / 5.0::DOUBLE
  WHEN 1 THEN share ELSE (sqrt(2.25::DOUBLE + (-2.0)::DOUBLE * share) - 1.5::DOUBLE) / (-1.0)::DOUBLE END END AS position FROM k
"""
