"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``docs``; where a stage changes a text, ``n_chars`` follows.

Edge cases are those of the operators. A document whose lines all go, or that has no text, stays until the mix, which
takes no words of it. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import line_dedup, mixing, near_dup, packing, toxicity
from palimpsest.llm.common import discard, materialize, table
from palimpsest.llm.queries import tokenizer_files

#: SQL can express neither the first stage's model nor the last one's tokenizer.
ORACLE_SQL = None


def _split(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``doc_id, text`` and the other columns under numbers, so that none clashes with an operator's."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(f"_column{i}") for i, c in enumerate(others))), others


def _restore(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` again, ``n_chars`` following the text."""
    _, others = _split(docs)
    at = {c: F.col(f"_column{i}") for i, c in enumerate(others)}
    at |= {"doc_id": F.col("doc_id"), "text": F.col(text)}
    if "n_chars" in at and text != "text":
        at["n_chars"] = F.length(text).cast(dict(docs.dtypes)["n_chars"])
    return rows.select(*(at[c].alias(c) for c in docs.columns))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model takes for toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rows, others = _split(docs)
    scored = toxicity.score(rows, model, ("doc_id", "text", *(f"_column{i}" for i in range(len(others)))))
    return _restore(scored.filter("predicted = 0"), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents repeat go, but for one copy."""
    rows, others = _split(docs)
    return _restore(line_dedup.dedup_lines(rows, carry=tuple(f"_column{i}" for i in range(len(others)))), docs, "kept_text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once for each of its texts in the group."""
    rows, _ = _split(docs)
    rows = rows.withColumn("_text", F.xxhash64("text"))  # rows that share an id may be in different groups
    groups = near_dup.NearDuplicates(docs.select("doc_id", "text"), k=5, num=8, den=10).documents(texts=True)
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_first"), F.col("t").alias("_its")).distinct()
    kept = rows.join(first, F.col("doc_id").eqNullSafe(F.col("_first")) & F.col("_text").eqNullSafe(F.col("_its")), "left_semi")
    return _restore(kept.dropDuplicates(["doc_id", "text"]), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions, in training order."""
    mixed = mixing.mixture(docs)
    return mixed.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else mixed


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens."""
    return packing.pack(docs, *tokenizer_files())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(before)  # the next stage reads this one's table alone
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
