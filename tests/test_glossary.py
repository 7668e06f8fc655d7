"""Filling, migration, merging and building of dictionaries."""

import pytest

from palimpsest.functions.python import norm
from palimpsest.plans import glossary
from palimpsest.sources import files


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_fill(spark):
    items = spark.createDataFrame([("p", "剣 ", ""), ("p", "盾", None), ("q", "剣", "kept"), ("q", "弓", "")], "slug string, ja string, zh string")
    layer = lambda *r: spark.createDataFrame(list(r), "key string, value string")
    once = glossary.filled_from(items, [layer(("剣", "old"), ("盾", "盾牌")), layer(("剣", "剑"))], norm)
    assert rows(once, "slug", "ja", "zh") == sorted([("p", "剣 ", "剑"), ("p", "盾", "盾牌"), ("q", "剣", "kept"), ("q", "弓", "")], key=str)


def test_migrate(spark):
    items = spark.createDataFrame([("p", "一", ""), ("p", "かな", ""), ("p", "漢字", ""), ("p", "三", "kept"), ("q", "一", "")], "slug string, ja string, zh string")
    chunks = spark.createDataFrame([("p", 0, "一", True), ("p", 1, "skip", False), ("p", 2, "かな", True), ("p", 3, "漢字", True), ("p", 4, "一", True), ("q", 0, "一", True)], "slug string, i int, text string, translate boolean")
    texts = spark.createDataFrame([("p.txt", "[0] one †\n[1] かな\n[key7] x\n"), ("p-1.txt", "[2] 漢字\n[3] second\n")], "path string, text string")
    entries = files.numbered_entries(texts).join(files.split_files(texts).select("path", "base", "part"), "path").withColumnRenamed("base", "slug")
    out = glossary.migrated(items, chunks, entries, norm)
    assert rows(out, "slug", "ja", "zh") == sorted([("p", "一", "one"), ("p", "かな", ""), ("p", "漢字", "漢字"), ("p", "三", "kept"), ("q", "一", "")], key=str)


def test_terms(spark):
    listed = spark.createDataFrame([(0, 9, "つるぎ"), (1, 7, "剣"), (2, 5, "たて"), (3, 5, "大きい盾")], "ord int, freq int, ja string")
    lines = lambda text: files.tab_lines(spark.createDataFrame([("f", text)], "path string, text string"))
    by_number = glossary.merged_terms(listed, lines("9\t剑\n7\t剣\n5\t\n5\t大盾"))
    want = [(0, "つるぎ", "剑", "done"), (1, "剣", "剣", "same"), (2, "たて", "", "missing"), (3, "大きい盾", "大盾", "done")]
    assert rows(by_number, "ord", "ja", "zh", "state") == sorted(want, key=str)
    by_source = glossary.merged_terms(listed, lines("# c\nつるぎ\t剑\n剣\t剣\nたて\n大きい盾\tx\n大きい盾\t大盾\n新\t new "), lines("たて\t盾\n剣\t剣"))
    assert rows(by_source, "ord", "ja", "zh", "state") == sorted([*want[:2], (2, "たて", "盾", "done"), want[3], (None, "新", "new", "done")], key=str)
    with pytest.raises(ValueError, match="length"):
        glossary.merged_terms(listed, lines("9\t剑"))
    assert rows(glossary.built(by_source), "rank", "ja") == sorted([(1, "大きい盾"), (2, "つるぎ"), (3, "たて"), (4, "新")], key=str)
    assert glossary.term_file(by_number.filter("state <> 'missing'"), "pairs").first()[0] == "# pairs\n\nつるぎ\t剑\n剣\t剣\n大きい盾\t大盾\n"
    assert glossary.term_file(by_number.filter("state = 'missing'"), "to do", blank=True).first()[0] == "# to do\n\nたて\t\n"
