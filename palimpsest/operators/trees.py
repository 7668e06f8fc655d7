"""Trees of pages as interval labels: elements are rows with the place where they begin and the place where they end.

Tags are found by one pattern and exploded, so a page's order is a column. Ends are found by windows, without a stack:

* an element of a kind that has to be closed ends at its own closing tag: per page and kind a running count of open ones,
  which never falls below zero, pairs each opening tag with the next closing tag of its level;
* where end tags are optional (paragraphs, items, cells, rows) an element ends at the next tag that ends its kind within the
  same list or table, whose nesting is such a running count, too;
* what is never closed ends at the next block's tag if it is inline, else with the page.

One element is inside another if it begins inside. So ancestors are a range join, and no tree has to be climbed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dom import BLOCKS, CLOSED_BY, SCOPE, VERBATIM, VOID

# Fixed values of the language: elements within a line of text, and where a text's flow breaks.
INLINE = "a abbr b big cite code del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var br wbr".split()
CONTAINERS = tuple(sorted({*BLOCKS, *CLOSED_BY["p"], "aside", "body", "figure", "head", "html", "main", "tbody", "tfoot", "thead", "title", "tr"}))

TAG = r"""<(/?)([A-Za-z][A-Za-z0-9]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_GONE = [(r"(?s)<!--.*?-->", ""), (r"(?is)(<(script|style)\b[^>]*>).*?(</\2\s*>)", "$1$3"), (r"<[!?][^>]*>", "")]
#: Each kind whose end tag is optional: its elements, the tags (opening or closing) that end one, and what it is nested by.
_OPTIONAL = {
    kind: (own, frozenset().union(own, *(CLOSED_BY[t] for t in own), more), SCOPE.get(own[0], frozenset()))
    for kind, own, more in (
        ("p", ["p"], CONTAINERS), ("li", ["li"], ()), ("dt", ["dt", "dd"], ()), ("tr", ["tr"], ()), ("td", ["td", "th"], ("tfoot", "thead")), ("option", ["option"], ()),
    )
}
#: Places that share a row of the range join.
SEGMENT = 1024
#: Characters of pages to a task: shuffled tags are small, so Spark would put too many into one.
TASK_CHARACTERS = 4 << 20


def tokens(pages: DataFrame, page: str, html: str) -> DataFrame:
    """``page, ord, tag, kind, attrs, text``: the tags of each page in order, each with the text behind it; ``ord`` 0 is the
    page's begin. ``kind`` is open, close, void or page. Comments, declarations and what scripts and styles hold are left out.
    A null page has one empty text."""
    bare = F.coalesce(F.col(html), F.lit(""))
    for pattern, by in _GONE:
        bare = F.regexp_replace(bare, pattern, by)
    cut = pages.select(F.col(page).alias("page"), bare.alias("_h"))
    tags = F.concat(F.array(F.lit("")), F.regexp_extract_all("_h", F.lit(TAG), 0))
    rows = cut.select("page", F.posexplode(F.arrays_zip(tags.alias("t"), F.split("_h", TAG, -1).alias("s"))).alias("ord", "_r"))
    name = F.lower(F.regexp_extract("_r.t", TAG, 2))
    kind = F.when(F.col("ord") == 0, "page").when(F.startswith(F.col("_r.t"), F.lit("</")), "close").when(name.isin(*VOID) | F.endswith(F.col("_r.t"), F.lit("/>")), "void").otherwise("open")
    return rows.select("page", "ord", name.alias("tag"), kind.alias("kind"), F.regexp_extract("_r.t", TAG, 3).alias("attrs"), F.col("_r.s").alias("text"))


def attribute(attrs: Column, name: str) -> Column:
    """An attribute's value, without its quotes; null where there is none."""
    found = F.regexp_extract(attrs, rf"""(?i)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(found != "", F.regexp_replace(found, r"""^["']|["']$""", ""))


def _levels(rows: DataFrame, keys: list[str], step: Column) -> DataFrame:
    """``rows`` with ``_level``: how many are open, a closing tag counting with what it closes; one that closes nothing is 0."""
    upto = Window.partitionBy(*keys).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    ordered = Window.partitionBy(*keys).orderBy("ord")
    rows = rows.withColumn("_step", step).withColumn("_sum", F.sum("_step").over(upto)).withColumn("_low", F.least(F.min("_sum").over(upto), F.lit(0)))
    before = F.coalesce(F.lag(F.col("_sum") - F.col("_low")).over(ordered), F.lit(0))
    return rows.withColumn("_level", F.when(F.col("_step") < 0, before).otherwise(F.col("_sum") - F.col("_low"))).drop("_step", "_sum", "_low")


def tasks(pages: DataFrame, html: str) -> int:
    """How many tasks keep each one's share of pages small, whatever the input's size."""
    return (pages.agg(F.sum(F.length(html))).first()[0] or 0) // TASK_CHARACTERS + 1


def elements(found: DataFrame, parts: int | None = None) -> DataFrame:
    """``page, node, until, tag, attrs``: each element from its opening tag's place to the place where it ends, which is its
    own if it holds nothing. The page itself is the element with the empty tag. ``parts``: :func:`tasks`, else Spark's choice."""
    found = found.repartition(parts, "page") if parts else found
    optional = sorted({t for own, _, _ in _OPTIONAL.values() for t in own})
    after = Window.partitionBy("page").orderBy(F.col("ord").desc()).rowsBetween(Window.unboundedPreceding, -1)
    block = F.last(F.when(F.col("tag").isin(*CONTAINERS), F.col("ord")), ignorenulls=True).over(after)
    place = found.select("page", "ord", "tag", "kind", "attrs", block.alias("_block"), (F.max("ord").over(Window.partitionBy("page")) + 1).alias("_end"))
    sign = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)

    strict = _levels(place.filter(F.col("kind").isin("open", "close") & ~F.col("tag").isin(*optional)), ["page", "tag"], sign)
    following = F.lead(F.struct("kind", "ord")).over(Window.partitionBy("page", "tag", "_level").orderBy("ord"))
    strict = strict.withColumn("_next", following).filter("kind = 'open'").withColumn("until", F.when(F.col("_next.kind") == "close", F.col("_next.ord")))

    kinds = F.array(*[F.when(F.col("tag").isin(*ends, *scope), F.lit(kind)) for kind, (_, ends, scope) in _OPTIONAL.items()])
    loose = place.filter(F.col("kind") != "void").withColumn("_kind", F.explode(F.array_compact(kinds)))
    scoped, mine = F.lit(False), F.lit(False)
    for kind, (own, _, scope) in _OPTIONAL.items():
        scoped = scoped | ((F.col("_kind") == kind) & F.col("tag").isin(*scope)) if scope else scoped
        mine = mine | ((F.col("_kind") == kind) & F.col("tag").isin(*own))
    loose = _levels(loose, ["page", "_kind"], F.when(scoped, sign).otherwise(0))
    loose = loose.withColumn("until", F.lead("ord").over(Window.partitionBy("page", "_kind", "_level").orderBy("ord"))).filter(mine & (F.col("kind") == "open"))

    columns = ["page", "ord", "tag", "attrs", "_block", "_end", "until"]
    empty = place.filter("kind IN ('void', 'page')").withColumn("until", F.when(F.col("kind") == "void", F.col("ord")).otherwise(F.col("_end")))
    every = strict.select(*columns).unionByName(loose.select(*columns)).unionByName(empty.select(*columns))
    left_open = F.when(F.col("tag").isin(*INLINE), F.coalesce("_block", "_end")).otherwise(F.col("_end"))
    return every.select("page", F.col("ord").alias("node"), F.coalesce("until", left_open).alias("until"), "tag", "attrs")


def _met(outer: DataFrame, inner: DataFrame, parts: int | None, carry: tuple[str, ...] = ()) -> DataFrame:
    segments = F.sequence(F.floor(F.col("node") / SEGMENT), F.floor(F.col("until") / SEGMENT))
    a = outer.select("page", F.col("node").alias("ancestor"), "until", *carry, F.explode(segments).alias("_segment"))
    d = inner.select("page", "node", F.floor(F.col("node") / SEGMENT).alias("_segment"))
    if parts:
        a, d = a.repartition(parts, "page", "_segment"), d.repartition(parts, "page", "_segment")
    return a.join(d, ["page", "_segment"]).filter("ancestor < node AND node < until")


def structural_join(outer: DataFrame, inner: DataFrame, parts: int | None = None) -> DataFrame:
    """``page, ancestor, node``: each of ``outer`` (page, node, until) with each of ``inner`` (page, node) that begins inside.

    Pages are cut into segments of places: an outer row goes to each segment that it reaches into, an inner one to its own, so
    that a long page isn't met as a whole by one task."""
    return _met(outer, inner, parts).select("page", "ancestor", "node")


def nearest_ancestor(outer: DataFrame, inner: DataFrame, parts: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``page, node, ancestor``: of the outer rows that each inner one begins inside the last to begin, with its columns ``carry``.
    An inner row has one segment, so its ancestors meet where they were joined."""
    last = F.max(F.struct("ancestor", *carry)).alias("_last")
    return _met(outer, inner, parts, carry).groupBy("page", "_segment", "node").agg(last).select("page", "node", "_last.*")


def inline_runs(found: DataFrame, source: str, boundary: Column | None = None, least: int = 2) -> DataFrame:
    """``page, run, first, last, texts, text``: stretches of inline tags and texts between two tags of blocks, where at least
    ``least`` texts hold ``source`` (a pattern).

    Between two tags of blocks everything has one container, so runs are islands in a page's order. Elements for whose opening
    tag ``boundary`` holds break a run, and so does their closing tag; their own text belongs to none. What is verbatim (code,
    scripts) is left out."""
    inline = F.col("tag").isin(*INLINE) & ~F.coalesce(boundary if boundary is not None else F.lit(False), F.lit(False))
    breaks = ~inline & (F.col("kind") != "page")
    step = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    marked = _levels(found.withColumn("_stop", breaks), ["page", "tag"], step)
    opened = F.lag("_stop", 1, False).over(Window.partitionBy("page", "tag", "_level").orderBy("ord"))  # of a closing tag the opening one
    marked = marked.withColumn("_opened", opened).withColumn("_stop", F.col("_stop") | ((F.col("kind") == "close") & F.col("_opened")))
    upto = Window.partitionBy("page").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    skipped = F.col("tag").isin(*VERBATIM) | (F.col("tag").isin(*INLINE) & F.col("_stop"))
    depth = F.sum(F.when(skipped & (F.col("kind") == "open"), 1).when(skipped & (F.col("kind") == "close"), -1).otherwise(0)).over(upto)
    placed = marked.withColumn("_depth", depth).withColumn("run", F.sum(F.col("_stop").cast("long")).over(upto))
    runs = placed.filter("_depth <= 0").groupBy("page", "run").agg(
        F.min("ord").alias("first"), F.max("ord").alias("last"), F.count_if(F.col("text").rlike(source)).alias("texts"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "").alias("text"),
    )
    return runs.filter(F.col("texts") >= least)
