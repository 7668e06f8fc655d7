"""Streams give what their batch twins give."""

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from palimpsest.operators.store import latest
from palimpsest.streaming.changes import archive_source, changed_pages, debounced, upsert_into, upserted, vacuum

ROWS = [("a", "1", 0), ("b", None, 1), ("a", "1", 2), ("a", "2", 3), ("b", None, 4), ("b", "x", 5), ("a", None, 6), ("a", None, 7), ("c", "1", 8)]


def _events(spark):
    start = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(n, s, start + datetime.timedelta(seconds=t)) for n, s, t in ROWS], "name string, state string, ts timestamp")


def _stream(spark, tmp_path):
    events = _events(spark)
    for i, cut in enumerate([(0, 3), (3, 5), (5, 9)]):
        lo, hi = (F.lit(f"2024-01-01 00:00:0{x}").cast("timestamp") for x in cut)
        events.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"b{i}"))
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))


def test_changed_pages(spark, tmp_path):
    window = Window.partitionBy("name").orderBy("ts")
    batch = _events(spark).withColumn("_n", F.row_number().over(window)).withColumn("_b", F.lag("state").over(window))
    want = {(r.name, r.state, r.ts) for r in batch.filter((F.col("_n") == 1) | ~F.col("state").eqNullSafe(F.col("_b"))).collect()}
    query = changed_pages(_stream(spark, tmp_path)).writeStream.format("memory").queryName("changed").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert {(r.name, r.state, r["at"]) for r in spark.table("changed").collect()} == want


def test_upsert(spark, tmp_path):
    rows = _stream(spark, tmp_path)
    out = str(tmp_path / "out")
    rows.writeStream.foreachBatch(upsert_into(out, ["name"], "ts", ["state"])).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    schema = _events(spark).schema
    got = {tuple(r) for r in upserted(spark, out, schema).select("name", "state").collect()}
    upsert_into(out, ["name"], "ts", ["state"])(_events(spark).limit(1), 2)  # again, and something else: an epoch overwrites itself
    for epoch in range(3, 7):
        upsert_into(out, ["name"], "ts", ["state"])(_events(spark), epoch)
    assert vacuum(spark, out, schema) > 0 and {tuple(r) for r in upserted(spark, out, schema).select("name", "state").collect()} == got
    assert got == {tuple(r) for r in latest(_events(spark), ["name"], "ts", ["state"]).select("name", "state").collect()}


def test_debounce(spark, tmp_path):
    want = {(r.start, r.n) for r in debounced(_events(spark).withWatermark("ts", "0 seconds"), gap="1.5 seconds").collect()}
    assert len(want) == 1
    stream = debounced(_stream(spark, tmp_path).withWatermark("ts", "10 seconds"), gap="0.5 seconds", keys=("name",))
    stream.writeStream.format("memory").queryName("bursts").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    got = {(r.name, r.start, r.n) for r in spark.table("bursts").collect()}
    assert got <= {(r.name, r.start, r.n) for r in debounced(_events(spark), gap="0.5 seconds", keys=("name",)).collect()}
    assert archive_source(spark.readStream.format("text"), "/x") is not None
