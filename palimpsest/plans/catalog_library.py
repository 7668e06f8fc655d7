"""More queries, each of which calls one function of the library over given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import render, text
from ..operators import joins, store
from ..sources import files
from . import entities, localize, registry, reports
from .catalog import _KIT_SQL, _kit, long, query, table

BASE = "https://wiki.example/index.php"


# ------------------------------------------------------------------ names and texts


_LETTER = "chr(CAST(65 + {} % 26 AS INTEGER))"


@query("""SELECT page_id, 'https://wiki.example/index.php?' || replace(replace(url_encode(t), '%2F', '/'), '%7E', '~') AS url FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)', 1) AS t FROM pages)""")
def page_addresses(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.page_url(F.regexp_extract("html", "<title>([^<]*)", 1), BASE).alias("url"))


@query("""SELECT doc_id, md5(trim(replace(replace(text, chr(13), ''), chr(10), ' '), ' ')) AS digest FROM documents""")
def single_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(F.encode(text.one_line(F.col("text")), "UTF-8")).alias("digest"))


@query("""SELECT page_id, md5(regexp_replace(html, '(?s)^(.*)<', '\\1[T]<')) AS digest FROM pages""")
def page_tails(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(F.encode(render.put_tail(F.col("html"), "[T]"), "UTF-8")).alias("digest"))


@query("""SELECT doc_id, CAST(len(string_split_regex(' ' || regexp_replace(text, '[^A-Za-z0-9]', '  ', 'g') || ' ', ' the ')) - 1 AS BIGINT) AS n FROM documents""")
def whole_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", long(text.whole_word_count(F.col("text"), "the")).alias("n"))


# ------------------------------------------------------------------ numbers in texts


@query(f"""WITH {_KIT_SQL} SELECT name, CASE WHEN m > 0 THEN '输出' END AS "primary", CASE WHEN p_size * 2.0 >= 60 THEN '連撃' ELSE '横列' END AS sub, CASE WHEN heal OR immune OR no_retreat OR revive OR g > 0 THEN '生存' WHEN ab > 0 OR dd > 0 OR ss > 0 THEN '辅助' ELSE '其他' END AS without
FROM k JOIN (SELECT p_partkey, p_size FROM part) ON p_partkey = name""")
def classes(spark, sf):
    """Classes of parts with an ultimate, and of the same without one."""
    kit = _kit(spark, sf).withColumn("target", F.lit("横一列")).withColumn("charge", F.lit(0.0))
    none = entities.classified(kit.withColumn("has_ult", F.lit(False))).select(F.col("name").alias("_name"), F.col("primary").alias("without"))
    return entities.classified(kit.withColumn("has_ult", F.lit(True))).join(none, F.col("name") == F.col("_name")).select("name", "primary", "sub", "without")


@query(f"""WITH {_KIT_SQL}, z AS (SELECT *, base * 1.2::DOUBLE * (1 + ab + 0.5::DOUBLE) * (1 + du) * (1 - 0.5::DOUBLE * (1 - least(1.0, dd))) AS hit FROM y),
d AS (SELECT name, team, (hit * 1.25::DOUBLE + hit * (cm - 1)) * (1::DOUBLE / iv) + hit * m * 3 * CASE WHEN hardcc THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END * (ch / 100 / iv) AS dps,
  100 * revive::INT + 60 * no_retreat::INT + 40 * immune::INT + 35 * heal::INT + 30 * dec_cc::INT + 25 * hardcc::INT + 30 * g AS util FROM z),
s AS (SELECT name, team, 0.7::DOUBLE * (dps / (SELECT max(dps) FROM d) * 100) + 0.3::DOUBLE * (util / (SELECT max(util) FROM d) * 100) AS v FROM d)
SELECT CAST(row_number() OVER (ORDER BY v DESC, name) AS BIGINT) AS rank, name, team AS rarity, round(v, 4) AS strength FROM s QUALIFY rank <= 40""")
def strongest(spark, sf):
    return entities.top_list(entities.scored(_kit(spark, sf))).select("rank", "name", "rarity", F.round("strength", 4).alias("strength"))


@query("""WITH r AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS name, ['SSR', 'SR', 'R'][p_size % 3 + 1] AS rarity, p_size % 3 AS o, """ + " + ".join(f"(p_partkey % {i + 3} = 0)::INT" for i in range(8)) + """ AS n FROM part)
SELECT name, rarity, CAST(n AS INTEGER) AS n, CAST(row_number() OVER (ORDER BY n DESC, rarity, name) AS BIGINT) AS place FROM r WHERE n >= 3""")
def versatile(spark, sf):
    from .catalog import _members

    return reports.versatile(_members(spark, sf).select("name", "rarity", "roles"))


@query("""WITH r AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS name, p_brand, p_size, p_retailprice FROM part)
SELECT name, p_brand AS rarity, 'size' AS field, CAST(p_size AS VARCHAR) AS value FROM r WHERE name IN ('000000003', '000000017', '000000150') UNION ALL SELECT name, p_brand, 'price', printf('%.2f', p_retailprice) FROM r WHERE name IN ('000000003', '000000017', '000000150')""")
def details(spark, sf):
    rows = table(spark, sf, "part").select(F.format_string("%09d", "p_partkey").alias("name"), F.col("p_brand").alias("rarity"), F.col("p_size").cast("string").alias("size"), F.format_string("%.2f", "p_retailprice").alias("price"))
    return reports.details(rows, ["000000003", "000000017", "000000150", "unknown"], ["size", "price"])


@query("""SELECT p_brand AS rarity, split_part(p_type, ' ', 1) AS obtain, count(*) AS n FROM part GROUP BY ALL""")
def obtain_by_rarity(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_brand").alias("rarity"), F.substring_index("p_type", " ", 1).alias("obtain"))
    return reports.cross_counts(rows, "rarity", "obtain")


@query("""SELECT source AS folder, max(lang || '-' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.txt') AS file FROM documents GROUP BY 1""")
def latest_by_name(spark, sf):
    paths = table(spark, sf, "documents").select(F.concat("source", F.lit("/"), "lang", F.lit("-"), F.format_string("%09d", "doc_id"), F.lit(".txt")).alias("path"))
    return reports.latest_by_name(paths)


# ------------------------------------------------------------------ joins and trees


@query("""SELECT p_partkey, coalesce(CASE p_name WHEN 'red widget' THEN 'E1' WHEN 'small ring' THEN 'E2' END, CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'E1' WHEN 'small' THEN 'E2' WHEN 'blue' THEN 'E3' END) AS value FROM part""")
def two_level_lookup(spark, sf):
    known = spark.createDataFrame([("red widget", "red", "E1", 1), ("small ring", "small", "E2", 2), ("blue x", "blue", "E3", 3), ("blue y", "blue", "E4", 4)], "exact string, loose string, value string, ord int")
    rows = table(spark, sf, "part").select("p_partkey", "p_name", F.substring_index("p_name", " ", 1).alias("word"))
    return joins.two_level_lookup(rows, "p_name", "word", known).select("p_partkey", "value")


@query("""SELECT s_suppkey AS supplier, n_regionkey AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def nearest_ancestor(spark, sf):
    """Suppliers below nations below regions: each supplier's region."""
    region, nation, supplier = (table(spark, sf, t) for t in ("region", "nation", "supplier"))
    nodes = region.select(F.lit(0).alias("page"), F.col("r_regionkey").cast("long").alias("node"), F.lit(-1).cast("long").alias("parent"), F.lit("region").alias("tag"))
    nodes = nodes.unionByName(nation.select(F.lit(0).alias("page"), (F.col("n_nationkey") + 1000).cast("long").alias("node"), F.col("n_regionkey").cast("long").alias("parent"), F.lit("nation").alias("tag")))
    nodes = nodes.unionByName(supplier.select(F.lit(0).alias("page"), (F.col("s_suppkey") + 100000).alias("node"), (F.col("s_nationkey") + 1000).cast("long").alias("parent"), F.lit("supplier").alias("tag")))
    found = joins.nearest_ancestor(nodes, F.col("tag") == "region")
    return found.filter("node >= 100000").select((F.col("node") - 100000).alias("supplier"), F.col("ancestor").cast("int").alias("region"))


@query("""WITH i AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS c FROM conversations WHERE role = 'user'),
l AS (SELECT conv_id, md5(text) AS line, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS c FROM conversations WHERE role = 'assistant')
SELECT i.conv_id, CAST(i.turn AS BIGINT) AS turn, coalesce(line, '') AS zh FROM i LEFT JOIN l ON i.conv_id = l.conv_id AND i.n = l.n AND i.c = l.c""")
def filled_by_position(spark, sf):
    turns = table(spark, sf, "conversations")
    items = turns.filter("role = 'user'").select(F.col("conv_id").alias("slug"), F.col("turn").alias("id"), F.lit("").alias("zh"))
    lines = turns.filter("role = 'assistant'").select(F.col("conv_id").alias("slug"), F.col("turn").alias("n"), F.md5(F.encode("text", "UTF-8")).alias("line"))
    return store.fill_by_position(items, lines).select(F.col("slug").alias("conv_id"), long("id").alias("turn"), "zh")


# ------------------------------------------------------------------ the registry and updates


@query("""WITH m AS (SELECT page_id, url AS name, CASE page_id % 4 WHEN 0 THEN 'missing' ELSE 'ok' END AS status, CASE WHEN page_id % 3 = 0 THEN sha256(html) END AS parsed, sha256(html) AS sha FROM pages) SELECT page_id FROM m WHERE status = 'ok' AND parsed IS DISTINCT FROM sha""")
def pages_to_parse(spark, sf):
    sha = F.sha2(F.encode("html", "UTF-8"), 256)
    manifest = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 4 == 0, "missing").otherwise("ok").alias("status"), sha.alias("sha256"), F.when(F.col("page_id") % 3 == 0, sha).alias("parsed_sha256"))
    return registry.to_parse(manifest).select("page_id")


_UPDATE = """m AS (SELECT c_name AS name, CASE c_custkey % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'missing' ELSE 'ok' END AS status, CAST(c_custkey % 4 AS INTEGER) AS attempts, c_mktsegment AS at FROM customer WHERE c_custkey % 7 <> 0),
n AS (SELECT c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'new' END AS at FROM customer)"""


@query(f"""WITH {_UPDATE} SELECT n.name FROM n LEFT JOIN m USING (name) WHERE NOT (coalesce(m.status, 'ok') <> 'ok' AND attempts >= 3) AND (m.name IS NULL OR n.at <> m.at OR m.status <> 'ok')""")
def pages_to_update(spark, sf):
    """Customers as watched pages: new ones, changed ones, and failed ones that haven't been given up."""
    rows = table(spark, sf, "customer").select(F.col("c_name").alias("name"), "c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    manifest = rows.filter(k % 7 != 0).select("name", F.when(k % 5 == 0, "error").when(k % 5 == 1, "missing").otherwise("ok").alias("status"), (k % 4).cast("int").alias("attempts"), F.col("c_mktsegment").alias("wiki_last_modified"))
    now = rows.select("name", F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("new").alias("wiki_last_modified"))
    return registry.incremental_update(rows.select("name"), rows.select("name", F.lit("watch").alias("mode")), manifest, now)


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def queue_left(spark, sf):
    done = table(spark, sf, "orders").select(F.col("o_custkey").alias("name"), (F.col("o_orderstatus") == "F").alias("ok"))
    return registry.drain_queue(table(spark, sf, "customer").select(F.col("c_custkey").alias("name")), done).select(F.col("name").alias("c_custkey"))


@query("""SELECT r_name AS group_name, coalesce(string_agg(n_name || '|' || n_nationkey || '|https://wiki.example/index.php?' || url_encode(n_name), ',' ORDER BY n_nationkey), '') AS pages FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1""")
def mirrored_groups(spark, sf):
    region = table(spark, sf, "region")
    groups = region.select(F.col("r_regionkey").alias("position"), F.col("r_name").alias("group_name"))
    rows = table(spark, sf, "nation").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", F.col("n_nationkey").alias("ord"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("slug"))
    plan = registry.mirror_plan(rows, F.col("r_name"), groups, BASE)
    return plan.select("group_name", F.array_join(F.transform("members", lambda m: F.concat_ws("|", m["name"], m["slug"], m["url"])), ",").alias("pages"))


@query("""SELECT path, sha256 FROM (SELECT CASE WHEN length(c) <= 180 THEN c ELSE substr(sha1(url), 1, 16) || '.html' END AS path, sha256(html) AS sha256 FROM (SELECT html, url, replace(url_encode(url), '%7E', '~') || '.html' AS c FROM pages))""")
def snapshot_files(spark, sf):
    return localize.snapshots(table(spark, sf, "pages").select(F.col("url").alias("name"), F.encode("html", "UTF-8").alias("content"))).select("path", "sha256")


@query("""WITH a AS (SELECT DISTINCT url, substr(sha256(url), 1, 16) || '.' || CASE WHEN contains(string_split(url, '/')[-1], '.') AND regexp_replace(lower(string_split(url, '.')[-1]), '[^a-z0-9]', '', 'g') <> '' THEN substr(regexp_replace(lower(string_split(url, '.')[-1]), '[^a-z0-9]', '', 'g'), 1, 5) ELSE 'png' END AS file, min(page_id) OVER (PARTITION BY url) % 2 AS there FROM pages) SELECT url, file FROM a WHERE there = 1""")
def assets_left(spark, sf):
    pages = table(spark, sf, "pages")
    present = pages.groupBy("url").agg(F.min("page_id").alias("first")).filter("first % 2 = 0").select(text.asset_name(F.col("url")).alias("file"))
    return localize.pending_assets(pages.select("url"), present)


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'zh' || page_id WHEN page_id % 3 = 1 THEN 'ja' || page_id ELSE '' END AS html, page_id % 3 = 0 AS translated FROM pages""")
def fragments_by_language(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("slug"))
    side = lambda name, keep: pages.filter(keep).select("slug", F.concat(F.lit(name), F.col("slug").cast("string")).alias("html"))
    return localize.read_fragments(pages, side("zh", "slug % 3 = 0"), side("ja", "slug % 3 < 2")).select(F.col("slug").alias("page_id"), "html", "translated")


@query("""SELECT slug, ja, zh, href FROM (SELECT 'p' AS slug, c_mktsegment AS ja, 'old' AS zh, 'h' AS href FROM customer WHERE c_custkey <= 3 UNION ALL SELECT 'p', min(c_mktsegment), 'new' || c_nationkey, 'h' FROM customer GROUP BY c_nationkey)""")
def merged_links(spark, sf):
    rows = table(spark, sf, "customer")
    link = lambda rows, zh: rows.select(F.lit("p").alias("slug"), F.col("c_mktsegment").alias("ja"), zh.alias("zh"), F.lit("h").alias("href"))
    truth = link(rows.filter("c_custkey <= 3"), F.lit("old"))
    found = link(rows, F.concat(F.lit("new"), F.col("c_nationkey").cast("string"))).unionByName(link(rows, F.lit("old")))
    return localize.merge_links(truth, found)


# ------------------------------------------------------------------ formats


@query("""WITH t AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS i FROM (SELECT DISTINCT source FROM documents)), l AS (SELECT source, chr(CAST(65 + i AS INTEGER)) AS label, i FROM t),
b AS (SELECT l.label, l.source, l.i, string_agg('[' || d.doc_id || '] ' || d.lang, chr(10) ORDER BY d.doc_id) AS body FROM documents d JOIN l USING (source) GROUP BY ALL)
SELECT md5('# MAP ' || string_agg(label || '=' || source, ' ' ORDER BY i) || chr(10) || string_agg('===' || label || '===' || chr(10) || body, chr(10) ORDER BY i) || chr(10)) AS digest FROM b""")
def worklist_file(spark, sf):
    items = table(spark, sf, "documents").select(F.col("source").alias("slug"), F.col("doc_id").alias("n"), F.col("lang").alias("ja"))
    return files.worklist_text(items).select(F.md5(F.encode("text", "UTF-8")).alias("digest"))


@query("""SELECT page_id || '.md' AS path, md5('---' || chr(10) || 'title: "' || t || '"' || chr(10) || 'layout: doc' || chr(10) || '---' || chr(10) || chr(10) || html || chr(10) || chr(10) || '<div class="search-text" hidden>' || trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) || '</div>' || chr(10)) AS digest
FROM (SELECT page_id, html, replace(regexp_extract(html, '<title>([^<]*)', 1), '"', '\\"') AS t FROM pages)""")
def markdown_pages(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("slug"), F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"), "html")
    return files.markdown(pages).select("path", F.md5(F.encode("body", "UTF-8")).alias("digest"))


@query("""WITH d AS (SELECT source AS slug, doc_id, lang FROM documents) SELECT slug, doc_id AS n, lang AS ja, upper(lang) AS zh, CAST(doc_id % 10 AS INTEGER) AS first FROM d""")
def stored_pages(spark, sf):
    """The translation store written as JSON and read back."""
    docs = table(spark, sf, "documents").select(F.concat("source", F.lit("-"), F.col("doc_id").cast("string")).alias("slug"), "source", "doc_id", "lang")
    keys = docs.select("slug", (F.col("doc_id") % 10).cast("int").alias("key_no"), F.col("lang").alias("ja"), F.upper("lang").alias("zh"))
    blocks = docs.select("slug", F.lit(1).alias("blk_no"), F.col("lang").alias("ja"), F.lit("").alias("zh"), F.array((F.col("doc_id") % 10).cast("int")).alias("keys"))
    written = files.store_json(keys, blocks).select(F.concat("slug", F.lit(".json")).alias("path"), F.col("json").alias("text"))
    k, b = files.store_rows(written)
    both = k.join(b.select(F.col("slug").alias("_slug"), F.get("keys", F.lit(0)).alias("first")), F.col("slug") == F.col("_slug"))
    return both.select(F.substring_index("slug", "-", 1).alias("slug"), F.substring_index("slug", "-", -1).cast("long").alias("n"), "ja", "zh", "first")


# ------------------------------------------------------------------ pages' trees


