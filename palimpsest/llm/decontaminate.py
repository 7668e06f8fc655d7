"""Benchmark decontamination by winnowing, in DataFrame functions alone.

A window is ``span`` consecutive words of a benchmark item; an item of fewer words is one window of its own length. Of each
window's ``k``-grams the least hash is its fingerprint. Documents keep the least hash of every run of ``span - k + 1`` of their
k-grams, so a document that holds a window holds its fingerprint, wherever the window begins: nothing that is long enough is
missed. Each length that windows have is winnowed by itself (``k`` is the length where that is shorter).

1. One scan stores the documents' texts with their distinct fingerprints.
2. Fingerprints are joined with those of the benchmark. A hit names a document's row and the fingerprint.
3. In rows with hits, each run whose least hash is one of them is extended to its window, and the windows' words are joined
   with the benchmark's: the words themselves decide, no hash does.
4. Hit words are the union of a row's windows; its items those that have one of them.

The benchmark's fingerprints and windows are broadcast only up to ``MOST_BROADCAST`` of them, counted before; beyond, they are
shuffled, where adaptive execution splits what a very common passage makes large. Rows of documents are told apart by a number
of their own, so copies of a text and rows that share an id never meet in one group.

Edge cases: a null or empty text, or one without words, has no words and no hits. Items that are null or hold no words have no
windows; benchmark rows that share an id are one item, those without id one item that has no place in the list of ids. Documents
that share an id have a result each. Empty tables give no rows, or rows without hits. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Bytes that are neither a letter nor a digit part words, once A-Z are lower-cased; all other characters make them.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The benchmark's rows (a hash, or a window's words) that a broadcast may have.
MOST_BROADCAST = 200_000


def words(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(WORD), 0)


def _places(count: Column, length: int) -> Column:
    """0 to ``count - length``, or nothing."""
    return F.when(count >= length, F.sequence(F.lit(0), count - length)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, k: int) -> Column:
    """The hash of each k-gram from those of the words."""
    return F.transform(_places(F.size(hashes), k), lambda i: F.xxhash64(F.lit(k), *(F.get(hashes, i + j) for j in range(k))))


def _least(grams: Column, length: int, k: int) -> Column:
    """The fingerprint of each window of ``length`` words; hashes of windows of other lengths are others."""
    run = length - k + 1
    if run == 1:
        return F.transform(grams, lambda g: F.xxhash64(F.lit(length), g))
    return F.transform(_places(F.size(grams), run), lambda i: F.xxhash64(F.lit(length), F.least(*(F.get(grams, i + j) for j in range(run)))))


def fingerprints(df: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """``df``, which has ``w`` (words), with ``f<length>``: the fingerprint of each window of that length."""
    df = df.withColumn("_h", F.transform("w", lambda w: F.xxhash64(w)))
    for size in sorted({min(k, n) for n in lengths}):
        df = df.withColumn(f"_g{size}", _grams(F.col("_h"), size))
    for n in lengths:
        df = df.withColumn(f"f{n}", _least(F.col(f"_g{min(k, n)}"), n, min(k, n)))
    return df.drop("_h", *(f"_g{size}" for size in range(1, k + 1)))


def _window_rows(df: DataFrame, n: int, keep: Column | None, *columns: str) -> DataFrame:
    """A row for each window of ``n`` words (whose fingerprint is in ``keep``): its place, its fingerprint, its words."""
    at = F.arrays_zip(_places(F.size("w"), n).alias("p"), F.col(f"f{n}").alias("f"))
    if keep is not None:
        at = F.filter(at, lambda x: F.array_contains(keep, x["f"]))
    rows = df.select(*columns, "w", F.explode(at).alias("_x"))
    return rows.select(*columns, F.col("_x.p").alias("p"), F.lit(n).alias("n"), F.col("_x.f").alias("f"), F.array_join(F.slice("w", F.col("_x.p") + 1, n), " ").alias("window"))


def benchmark_windows(benchmark: DataFrame, span: int, k: int) -> DataFrame:
    """``item_id, n, f, window`` for each window of each item, stored."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    parts = []
    for n in range(1, span + 1):
        mine = items.filter(F.size("w") >= n) if n == span else items.filter(F.size("w") == n)
        parts.append(_window_rows(fingerprints(mine, [n], k), n, None, "item_id"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return materialize(found.select("item_id", "n", "f", "window").distinct(), "benchmark")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def decontaminate(documents: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each document."""
    known = benchmark_windows(benchmark, span, k)
    lengths = [r.n for r in known.select("n").distinct().orderBy("n").collect()]  # ``span`` at most
    docs = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", words(F.col("text")).alias("w"))
    marked = fingerprints(docs, lengths, k).withColumn("n_words", F.size("w").cast("long"))
    prints = F.array_distinct(F.concat(*(F.col(f"f{n}") for n in lengths))) if lengths else F.array().cast("array<bigint>")
    stored = materialize(marked.select("row", "doc_id", "n_words", "text", prints.alias("prints")), "prints")

    hashes = _small(materialize(known.select("f").distinct(), "hashes"))
    hits = stored.select("row", F.explode("prints").alias("f")).join(hashes, "f").groupBy("row").agg(F.collect_list("f").alias("hit"))
    hits = materialize(hits, "hits")
    held = fingerprints(stored.select("row", "text").join(hits, "row").select("row", "hit", words(F.col("text")).alias("w")), lengths, k)
    windows = _small(materialize(known.select("window").distinct(), "windows"))
    parts = [_window_rows(held, n, F.col("hit"), "row").select("row", "p", "n", "window") for n in lengths]
    if not parts:
        return stored.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"), F.lit(False).alias("contaminated"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = materialize(found.join(windows, "window"), "found")

    # a row's words at window ends reach further than all before by what isn't covered yet
    end = F.col("p") + F.col("n")
    until = F.max(end).over(Window.partitionBy("row").orderBy("p", "n").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(end - F.greatest(F.col("p"), F.coalesce(until, F.lit(0))), F.lit(0))
    covered = found.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))
    pairs = found.select("row", "window").distinct().join(_small(known.select("window", "item_id")), "window").select("row", "item_id").distinct()
    items = pairs.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"))
    out = stored.select("row", "doc_id", "n_words").join(covered.join(items, "row"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def oracle(span: int = 10) -> str:
    """SQL that compares all windows."""
    split = r"regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents
), i AS (
  SELECT item_id, {split} AS w FROM benchmark
), known AS MATERIALIZED (
  SELECT DISTINCT item_id, n, array_to_string(w[p + 1:p + n], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(len(w) - n + 1)) AS p FROM (SELECT *, least(len(w), {span}) AS n FROM i WHERE len(w) > 0))
), found AS MATERIALIZED (
  SELECT r, p, n, win FROM (
    SELECT r, n, p, array_to_string(w[p + 1:p + n], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM known) WHERE len(w) >= n))
  SEMI JOIN known USING (win)
), hit AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS pos FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT r, item_id FROM found JOIN known USING (win)) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit, COALESCE(n_items, 0)::BIGINT AS n_items,
  sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
