"""Queries over the trees of whole pages (tags, ancestors, links and runs of inline text, by interval labels) and with
dictionaries that are tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dictionary, trees
from .catalog import count, long, query, table

_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)(<script[^>]*>).*?(</script>)', '\1\2', 'g'), '(?s)(<style[^>]*>).*?(</style>)', '\1\2', 'g')"


def _tokens(spark, sf):
    return trees.tokens(table(spark, sf, "pages"), "page_id", "html")


@query("""SELECT tag, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<script.*?</script>', '<script>', 'g'), '<([a-z][a-z0-9]*)[ >]', 1)) AS tag FROM pages) GROUP BY tag""")
def dom_tag_counts(spark, sf):
    return _tokens(spark, sf).filter("kind IN ('open', 'void')").groupBy("tag").agg(count().alias("n"))


@query("""SELECT page_id, CAST(i - 1 AS BIGINT) AS ord, hrefs[i] AS href FROM (
  SELECT page_id, h AS hrefs, unnest(range(1, len(h) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages))""")
def link_extract(spark, sf):
    links = _tokens(spark, sf).filter("tag = 'a' AND kind = 'open'").select("page", "ord", trees.attribute(F.col("attrs"), "href").alias("href")).filter("href IS NOT NULL")
    listed = links.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "href"))), lambda x: x["href"]).alias("h"))
    return listed.select(F.col("page").alias("page_id"), F.posexplode("h").alias("ord", "href")).select("page_id", long("ord").alias("ord"), "href")


_PARTS = {"nav": "regexp_extract(h, '(?s)<nav>(.*?)</nav>', 1)", "article": "regexp_extract(h, '(?s)<article>(.*?)</article>', 1)", "footer": "regexp_extract(h, '(?s)<footer>(.*)', 1)"}


@query(f"""SELECT page_id, part, n FROM (
  SELECT page_id, unnest({list(_PARTS)}) AS part, unnest([{', '.join(f"CAST(len(regexp_extract_all({p}, '<(a|b|p)[ >]')) AS BIGINT)" for p in _PARTS.values())}]) AS n FROM (SELECT page_id, {_CLEAN} AS h FROM pages)) WHERE n > 0""")
def nearest_part(spark, sf):
    """Of each link, paragraph and bold text the part of the page that it stands in, by page."""
    n = trees.tasks(table(spark, sf, "pages"), "html")
    nodes = trees.elements(_tokens(spark, sf), n)
    found = trees.nearest_ancestor(nodes.filter(F.col("tag").isin(*_PARTS)), nodes.filter(F.col("tag").isin("a", "b", "p")), n, ("tag",))
    return found.groupBy(F.col("page").alias("page_id"), F.col("tag").alias("part")).agg(count().alias("n"))


@query(f"""SELECT page_id, CAST(count(*) AS BIGINT) AS pairs FROM (
  SELECT page_id, unnest(regexp_extract_all({_PARTS['nav']}, '(?s)<li>.*?</li>')) AS li FROM (SELECT page_id, {_CLEAN} AS h FROM pages)), (SELECT unnest(range(3)) AS i) WHERE contains(li, '<a ') GROUP BY page_id""")
def structural_pairs(spark, sf):
    """(ancestor, link) for the lists, items and bars above each link: three each."""
    n = trees.tasks(table(spark, sf, "pages"), "html")
    nodes = trees.elements(_tokens(spark, sf), n)
    found = trees.structural_join(nodes.filter(F.col("tag").isin("ul", "li", "nav")), nodes.filter("tag = 'a'"), n)
    return found.groupBy(F.col("page").alias("page_id")).agg(count().alias("pairs"))


@query(f"""WITH p AS (
  SELECT page_id, string_split(regexp_replace(regexp_replace({_CLEAN}, '</?({'|'.join(trees.INLINE)})([ /][^>]*)?>', chr(1), 'g'), '<[^>]*>', chr(2), 'g'), chr(2)) AS parts FROM pages
), r AS (
  SELECT page_id, part, len(list_filter(string_split(part, chr(1)), lambda t: regexp_matches(t, '[A-Za-z]'))) AS texts FROM (SELECT page_id, unnest(parts) AS part FROM p)
)
SELECT page_id, CAST(count(*) AS BIGINT) AS runs, CAST(sum(texts) AS BIGINT) AS texts, CAST(sum(length(replace(part, chr(1), ''))) AS BIGINT) AS chars FROM r WHERE texts >= 1 GROUP BY page_id""")
def inline_runs(spark, sf):
    found = trees.inline_runs(_tokens(spark, sf), "[A-Za-z]", least=1)
    return found.groupBy(F.col("page").alias("page_id")).agg(count().alias("runs"), F.sum("texts").alias("texts"), F.sum(F.length("text")).cast("long").alias("chars"))


_NAMES = """names AS (SELECT DISTINCT substr(href, 2) AS term FROM (SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) WHERE length(href) > 3),
pattern AS (SELECT string_agg(regexp_escape(term), '|' ORDER BY length(term) DESC, term) AS p FROM names)"""


def _names(spark, sf):
    """The names that pages link to, each with itself in brackets."""
    links = _tokens(spark, sf).filter("tag = 'a' AND kind = 'open'").select(trees.attribute(F.col("attrs"), "href").alias("href"))
    terms = links.filter(F.length("href") > 3).select(F.substring("href", 2, 1 << 30).alias("term")).distinct()
    return terms.withColumn("value", F.concat(F.lit("<"), "term", F.lit(">")))


@query(f"""WITH {_NAMES} SELECT m AS term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(regexp_extract_all(text, p)) AS m FROM documents, pattern) GROUP BY m""")
def dictionary_matches(spark, sf):
    """How often each linked name stands in the documents, where longer names win."""
    found = dictionary.find(table(spark, sf, "documents"), "doc_id", "text", _names(spark, sf))
    return found.groupBy("term").agg(count().alias("n"), F.count_distinct("key").alias("docs"))


@query(f"""WITH {_NAMES} SELECT doc_id, md5(regexp_replace(text, p, '<\\0>', 'g')) AS digest FROM documents, pattern""")
def dictionary_replaced(spark, sf):
    done = dictionary.substitute(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", _names(spark, sf))
    return done.select("doc_id", F.md5(F.encode("replaced", "UTF-8")).alias("digest"))
