"""The command verbs over stored tables."""

import pytest

from palimpsest.__main__ import main


@pytest.fixture
def stored(spark, tmp_path):
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    put("keys", [("p", 1, "一つ目の文です。", ""), ("q", 1, "一つ目の文です。", None), ("q", 2, "剣を持つ人の長い文。", "")], "slug string, key_no int, ja string, zh string")
    put("blocks", [("p", 1, "塊", "done", [9])], "slug string, blk_no int, ja string, zh string, keys array<int>")
    put("dictionary", [("剣を持つ人の長い文。", "剑")], "key string, value string")
    put("done", [("一つ目の文です。", "第一句。", 1)], "ja string, zh string, ord int")
    put("pages", [("p", "same text")], "slug string, text string")
    put("other", [("p", "0123456789")], "slug string, text string")
    return str(tmp_path)


def run(spark, stored, verb, **more):
    return main([verb, "--store", stored, "--out", f"{stored}/out", *(x for k, v in more.items() for x in (f"--{k}", v))], spark)


def test_worklists(spark, stored):
    assert run(spark, stored, "worklist", date="2024-01-01") == 0
    assert spark.read.text(f"{stored}/out/2024-01-01", wholetext=True).first()[0].strip() == "# MAP A=p B=q\n===A===\n[1] 一つ目の文です。\n===B===\n[1] 一つ目の文です。"
    assert run(spark, stored, "extract-dedup", date="d") == 0
    assert sorted((r.slug, r.id, r.occurrences) for r in spark.read.parquet(f"{stored}/out/d").collect()) == [("p", 1, 2), ("q", 1, 2)]


def test_fills(spark, stored):
    assert run(spark, stored, "apply-dedup", input=f"{stored}/done") == 0
    assert sorted((r.slug, r.kind, r.id, r.zh) for r in spark.read.parquet(f"{stored}/out").collect()) == [("p", "blk", 1, "done"), ("p", "key", 1, "第一句。"), ("q", "key", 1, "第一句。"), ("q", "key", 2, "")]
    assert run(spark, stored, "glossary-fill") == 0
    assert {(r.slug, r.id): r.zh for r in spark.read.parquet(f"{stored}/out").filter("kind = 'key'").collect()}[("q", 2)] == "剑"
    assert run(spark, stored, "coverage") == 0 and spark.read.parquet(f"{stored}/out").count() == 2


def test_failures(spark, stored):
    assert run(spark, stored, "apply-dedup", input=f"{stored}/nothing") == 1
    assert main(["check", "--input", f"{stored}/pages", "--out", f"{stored}/pages"], spark) == 0
    assert main(["check", "--input", f"{stored}/pages", "--out", f"{stored}/other"], spark) == 1
