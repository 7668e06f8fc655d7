"""The queries of this subpackage, each over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, digest, kd_means, license_scan, line_dedup, mixing, near_dup, packing, sessions, substrings, topk, toxicity, warc
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"), F.to_json("spans").alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), text_out=False)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.curriculum(table(spark, sf_dir, "documents"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), bytes_out=False)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))


def op7_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.successors(table(spark, sf_dir, "documents"))


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_files())


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_means.kd_means(table(spark, sf_dir, "embeddings"))


def op12_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.close_sessions(table(spark, sf_dir, "clicks"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_mixing": op3_mixing,
    "op4_substrings": op4_substrings,
    "op5_license_scan": op5_license_scan,
    "op6_top_k": op6_top_k,
    "op7_digest": op7_digest,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_centroids": op11_centroids,
    "op12_sessions": op12_sessions,
    "op13_decontaminate": op13_decontaminate,
}
ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op5_license_scan": license_scan.oracle(),
    "op6_top_k": topk.ORACLE,
    "op9_warc": warc.ORACLE,
    "op11_centroids": kd_means.oracle(),
    "op12_sessions": sessions.ORACLE,
    "op13_decontaminate": decontaminate.oracle(),
}
