"""One file a row: round trips, failed tasks, modes."""

import pytest
from pyspark.sql import functions as F

from palimpsest.sources import files, tree


@pytest.fixture
def folder(spark, tmp_path):
    tree.register(spark)
    return f"file://{tmp_path}/site"


def there(tmp_path):
    return {str(p.relative_to(tmp_path)): p.read_bytes().decode() for p in tmp_path.rglob("*") if p.is_file()}


def test_round_trip_of_the_store(spark, folder):
    keys = spark.createDataFrame([(f"p{i}", 1, f"日本{i}", "x") for i in range(20)], "slug string, key_no int, ja string, zh string")
    blocks = spark.createDataFrame([(f"p{i}", 1, "b", "", [1]) for i in range(20)], "slug string, blk_no int, ja string, zh string, keys array<int>")
    stored = files.store_json(keys, blocks).select(F.concat(F.lit("deep/"), "slug", F.lit(".json")).alias("path"), F.col("json").alias("body"))
    stored.repartition(3).write.format("tree").mode("overwrite").save(folder)
    read, _ = files.store_rows(files.whole_texts(spark, f"{folder}/deep/*.json"))
    assert sorted((r.slug, r.ja) for r in read.collect()) == sorted((f"p{i}", f"日本{i}") for i in range(20))


def test_modes(spark, folder, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "path string, body string, more int")
    rows(("a/1.txt", "one", 1), ("b.txt", None, 1)).write.format("tree").mode("append").save(folder)
    rows(("a/2.txt", "two", 1), ("b.txt", "new", 1)).write.format("tree").mode("append").save(folder)
    assert there(tmp_path) == {"site/a/1.txt": "one", "site/a/2.txt": "two", "site/b.txt": "new"}
    rows(("c.txt", "only", 1)).write.format("tree").mode("overwrite").save(folder)
    assert there(tmp_path) == {"site/c.txt": "only"}
    rows().write.format("tree").mode("overwrite").save(folder)
    assert there(tmp_path) == {}


@pytest.mark.parametrize("bad", [None, "", "../x", "/x", "."])
def test_a_failed_task_leaves_nothing(spark, folder, tmp_path, bad):
    spark.createDataFrame([("a.txt", "old")], "path string, body string").write.format("tree").mode("overwrite").save(folder)
    rows = spark.createDataFrame([(f"{i}.txt", "new") for i in range(50)] + [(bad, "x")], "path string, body string").repartition(4)
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="not a path"):
            rows.write.format("tree").mode(mode).save(folder)
        assert there(tmp_path / "site") == {"a.txt": "old"}  # a task that still ran may have staged more beside it
