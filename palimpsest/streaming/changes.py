"""Changes as a stream: what differs from the last state, debounced rebuilds, keyed upserts, a work queue.

State is keyed and small; each operator has a batch twin in ``plans.registry`` and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.store import latest


def changed_pages(events: DataFrame, key: str = "name", state: str = "state", order: str = "ts") -> DataFrame:
    """(key, state, order) of events whose state differs from the key's last one; the first of a key differs. Two null
    states are equal. ``events`` may be a stream; within a batch, events of a key are taken by ``order``."""

    def update(name: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        seen, last = (True, held.get[0]) if held.exists else (False, None)
        rows = pd.concat(list(batches)).sort_values([order], kind="stable")
        out = []
        for value, at in zip(rows[state], rows[order], strict=True):
            value = None if pd.isna(value) else value
            if not seen or value != last:
                out.append((name[0], value, at))
            seen, last = True, value
        held.update((last,))
        yield pd.DataFrame(out, columns=["name", "state", "at"])

    kinds = dict(events.dtypes)
    rows = events.select(F.col(key).alias("name"), F.col(state).cast("string").alias(state), F.col(order).alias(order))
    return rows.groupBy("name").applyInPandasWithState(update, f"name {kinds[key]}, state string, at {kinds[order]}", "last string", "append", GroupStateTimeout.NoTimeout)


def debounced(events: DataFrame, at: str = "ts", gap: str = "1.5 seconds", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, start, end, n): bursts of events with less than ``gap`` between them; one rebuild for each.
    A stream needs a key and a watermark."""
    window = F.session_window(at, gap)
    return events.groupBy(*keys, window.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


BUCKETS = 64


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def _versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField("epoch", LongType()), StructField("bucket", IntegerType())])).parquet(path)


def upserted(spark: SparkSession, path: str, schema: StructType, below: int | None = None) -> DataFrame:
    """The table that :func:`upsert_into` keeps: of each bucket its newest version (before the one of epoch ``below``)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = _versions(spark, path, schema)
    rows = rows if below is None else rows.filter(F.col("epoch") < below)
    newest = rows.groupBy(F.col("bucket").alias("_bucket")).agg(F.max("epoch").alias("_epoch"))  # BUCKETS rows at most
    return rows.join(F.broadcast(newest), (F.col("bucket") == F.col("_bucket")) & (F.col("epoch") == F.col("_epoch"))).select(*schema.fieldNames())


def upsert_into(path: str, key: list[str], at: str, ties: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keeps the newest row of each key under ``path``; a repeated batch changes nothing.

    Keys are dealt into buckets. A batch writes a new version of the buckets that it touches alone, from the versions
    before it, so a retry overwrites its own version only. Read it by :func:`upserted`, shrink it by :func:`vacuum`.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
        touched = [r[0] for r in batch.select(bucket.alias("b")).distinct().collect()]  # numbers below ``buckets``
        before = upserted(spark, path, batch.schema, epoch).filter(bucket.isin(touched)) if touched else batch.limit(0)
        rows = latest(before.unionByName(batch), key, at, ties).select(*batch.columns).withColumn("bucket", bucket)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/epoch={epoch}")

    return write


def vacuum(spark: SparkSession, path: str, schema: StructType, keep: int = 1) -> int:
    """Delete versions of buckets that ``keep`` newer ones have replaced; returns how many. A reader or a retry may still
    need the last ones, so ``keep`` is 1 at least."""
    held = _versions(spark, path, schema).select("epoch", "bucket").distinct().collect()  # a row for each version of a bucket
    by_bucket: dict[int, list[int]] = {}
    for epoch, bucket in sorted(held, reverse=True):
        by_bucket.setdefault(bucket, []).append(epoch)
    gone = [f"{path}/epoch={e}/bucket={b}" for b, epochs in by_bucket.items() for e in epochs[1 + max(1, keep) :]]
    for folder in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
    return len(gone)


def archive_source(reader, folder: str):
    """Options of a file source that moves read files to ``folder``."""
    return reader.option("cleanSource", "archive").option("sourceArchiveDir", folder)
