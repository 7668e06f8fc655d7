"""Sessions of rows that come out of order, closed by a stream whose state is their complement.

For each client the state stores the gaps of over 30 minutes between its rows, in order, with cumulative totals (clicks,
checksums, merges) up to each. A client without rows is one endless gap. An arriving row that falls in a gap cuts it in two,
and of the pieces those over 30 minutes stay: the gap shrinks (one piece), is split (two) or is deleted (none). A deleted gap
is a merge of the two sessions that it parted; differences of neighbouring totals are a session's own.

The rows are cut into batches, which one Structured Streaming query reads in order, started anew for each on one checkpoint.

* Before rows are shuffled, those of a client within one half hour of the clock become one (they share a session whatever
  else arrives), so a client of a third of all rows has 48 rows a day at most, however many it clicks.
* A group of the state is a bucket of clients by hash, one for every ``bucket_rows`` clicks, so none grows with the input. A mark for each bucket follows each batch, so that every bucket closes its sessions with the batch.
* The driver gets the extremes of arrival and one largest time a batch. The contract's late-row bound is exact to the
  microsecond and counts whole batches, so it is a filter of its own, not Spark's watermark of whole milliseconds.

Edge cases: rows without click id, client or time take no part; a row without time of arrival counts as arrived at its time.
Of rows that share a click id the one with the least (arrival, time, client) counts. Equal times are one place. Empty tables
give an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .common import delete, discard, materialize, partitions, shared_dir

MINUTE = 60_000_000
HOUR = 60 * MINUTE
#: The ends of an endless gap; their difference fits 64 bits.
NEVER, EVER = -(1 << 62), (1 << 62) - 1
RESULT = "client_id long, first_us long, last_us long, n_clicks long, ids_crc32 long, n_merges long, close_batch long"
_SUMMARY = "bucket int, client long, first long, last long, n long, crc long"
_STATE = "client binary, start binary, end binary, n binary, crc binary, merges binary"


class Gaps(NamedTuple):
    """Gaps in order of client and start; ``n``, ``crc`` and ``merges`` are the client's totals up to the gap."""

    client: np.ndarray
    start: np.ndarray
    end: np.ndarray
    n: np.ndarray
    crc: np.ndarray
    merges: np.ndarray

    @classmethod
    def none(cls) -> Gaps:
        return cls(*(np.zeros(0, np.int64) for _ in cls._fields))


class Sessions(NamedTuple):
    client: np.ndarray
    first: np.ndarray
    last: np.ndarray
    n: np.ndarray
    crc: np.ndarray
    merges: np.ndarray


def arrive(gaps: Gaps, client: np.ndarray, first: np.ndarray, last: np.ndarray, n: np.ndarray, crc: np.ndarray, apart: int) -> Gaps:
    """The gaps after rows arrived: each stands for ``n`` clicks from ``first`` to ``last``, no more than ``apart`` apart."""
    new = np.setdiff1d(client, gaps.client)
    if len(new):
        zero = np.zeros(len(new), np.int64)
        gaps = Gaps(*map(np.concatenate, zip(gaps, (new, zero + NEVER, zero + EVER, zero, zero, zero), strict=True)))
        order = np.lexsort((gaps.start, gaps.client))
        gaps = Gaps(*(x[order] for x in gaps))
    none, known = np.zeros(len(first), np.int64), np.zeros(len(gaps.client), np.int64)
    who = np.concatenate([gaps.client, client, client])
    time = np.concatenate([gaps.start, first, last])
    point = np.concatenate([known, none + 1, none + 1])
    order = np.lexsort((point, time, who))
    who, time, point = who[order], time[order], point[order]
    clicks = np.cumsum(np.concatenate([known, n, none])[order])
    sums = np.cumsum(np.concatenate([known, crc, none])[order])
    at = np.cumsum(point == 0) - 1  # the last gap that begins before
    piece = np.flatnonzero(time < gaps.end[at])  # gaps and the rows that fall in one; other rows lie within a session
    gap, begin = at[piece], time[piece]
    end = gaps.end[gap].copy()
    same = gap[1:] == gap[:-1]
    end[:-1][same] = begin[1:][same]
    stays = end - begin > apart
    deleted = np.bincount(gap[stays], minlength=len(gaps.client)) == 0
    merged = np.zeros(len(who), np.int64)
    merged[np.flatnonzero(point == 0)] = deleted
    merged = np.cumsum(merged)
    head = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
    before = head[np.searchsorted(head, piece, "right") - 1]  # a client's first event is its endless first gap, which adds nothing
    kept = (who[piece], begin, end, gaps.n[gap] + clicks[piece] - clicks[before], gaps.crc[gap] + sums[piece] - sums[before], gaps.merges[gap] + merged[piece] - merged[before])
    return Gaps(*(x[stays] for x in kept))


def close(gaps: Gaps, bound: int) -> tuple[Gaps, Sessions]:
    """What stays open, and the sessions whose last row is before ``bound``."""
    inner = np.flatnonzero(gaps.client[1:] == gaps.client[:-1])  # a session lies between two gaps of a client
    done = inner[gaps.start[inner + 1] < bound]
    after = done + 1
    found = Sessions(gaps.client[done], gaps.end[done], gaps.start[after], gaps.n[after] - gaps.n[done], gaps.crc[after] - gaps.crc[done], gaps.merges[after] - gaps.merges[done])
    start = gaps.start.copy()
    start[after] = NEVER  # nothing arrives any more where closed sessions were
    stay = np.ones(len(start), bool)
    stay[done] = False
    stay &= (start != NEVER) | (gaps.end != EVER)
    return Gaps(*(x[stay] for x in gaps._replace(start=start))), found


def _step(batch: int, bound: int | None, final: int | None, apart: int) -> Callable:
    """The stateful function of a batch: its rows arrive in their buckets, then sessions before ``bound`` close; with
    ``final`` the others close as that batch."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f[f["n"] > 0] for f in frames])
        gaps = Gaps(*(np.frombuffer(x, np.int64) for x in state.get)) if state.exists else Gaps.none()
        if len(rows):
            gaps = arrive(gaps, *(rows[c].to_numpy(np.int64) for c in ("client", "first", "last", "n", "crc")), apart)
        closed = []
        for limit, label in ((bound, batch), (EVER if final is not None else None, final)):
            if limit is not None:
                gaps, found = close(gaps, limit)
                closed.append((found, label))
        if len(gaps.client):
            state.update(tuple(x.astype(np.int64).tobytes() for x in gaps))
        elif state.exists:
            state.remove()
        for found, label in closed:
            if len(found.client):
                names = [c.split()[0] for c in RESULT.split(", ")]
                yield pd.DataFrame(dict(zip(names, (*found, np.full(len(found.client), label, np.int64)), strict=True)))

    return step


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a client within one slot become one; marks have no clicks."""

    def summed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).group_by(["bucket", "client", "slot"], use_threads=False)
        t = t.aggregate([("t", "min"), ("t", "max"), ("t", "count"), ("crc", "sum")]).select(["bucket", "client", "t_min", "t_max", "t_count", "crc_sum"])
        t = pa.table([c if c.null_count == 0 else c.fill_null(0) for c in t.columns], names=[c.split()[0] for c in _SUMMARY.split(", ")])
        yield from t.combine_chunks().to_batches()

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 1 << 19:
            yield from summed(held)
            held = []
    if held:
        yield from summed(held)


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp; one without a zone is in UTC whatever the session's zone."""
    at = F.col(f"`{name}`")
    if dict(df.dtypes)[name] == "timestamp_ntz":
        day = F.unix_date(F.to_date(at)).cast("long") * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60
        return (day * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000)).cast("long")
    return F.unix_micros(at.cast("timestamp"))


def _whole(column: str, unit: int) -> str:
    """Floor division of a long."""
    return f"(({column} - pmod({column}, {unit}L)) div {unit}L)"


def _cut(clicks: DataFrame, batches: int) -> DataFrame | None:
    """``click_id, client, t, batch`` of the rows that count, stored; None where there are none."""
    rows = clicks.select(F.col("click_id").cast("long").alias("click_id"), F.col("client_id").cast("long").alias("client"), micros(clicks, "ts").alias("t"), micros(clicks, "arrived_at").alias("arrived"))
    rows = rows.filter("click_id IS NOT NULL AND client IS NOT NULL AND t IS NOT NULL").withColumn("arrived", F.coalesce("arrived", "t"))
    once = rows.groupBy("click_id").agg(F.min(F.struct("arrived", "t", "client")).alias("r"))
    once = materialize(once.select("click_id", "r.client", "r.t", F.expr(_whole("r.arrived", HOUR)).alias("h")), "clicks")
    lo, hi = once.agg(F.min("h"), F.max("h")).first()
    if lo is None:
        return None
    batch = F.expr(f"({batches} * (h - {lo}L)) div {hi - lo + 1}L")
    late = F.crc32(F.concat_ws(":", F.col("client").cast("string"), F.expr(_whole("t", HOUR)).cast("string"))) % 7 == 0
    return once.withColumn("batch", F.when(late, F.least(batch + 1, F.lit(batches - 1))).otherwise(batch).cast("int")).drop("h")


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Publish a folder by one rename; a batch without rows and marks has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path(target).getParent())
    if not files.rename(path(source), path(target)):
        raise OSError(f"{source} can't be moved to {target}")


def _run(writer: DataStreamWriter) -> None:
    """Read what is there. Checksum files of the checkpoint, which this call deletes, would double what each task creates."""
    conf, name = writer._spark.conf, "spark.sql.streaming.checkpoint.fileChecksum.enabled"
    was = conf.get(name)
    conf.set(name, "false")
    try:
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(name, was)


def close_sessions(clicks: DataFrame, batches: int = 12, delay_hours: int = 120, apart_minutes: int = 30, bucket_rows: int = 50_000) -> DataFrame:
    """Sessions of ``clicks`` as the stream closes them, one row each (:data:`RESULT`).

    ``bucket_rows`` is about how many clicks, over all batches, share a group of the state.
    """
    spark = clicks.sparkSession
    cut = _cut(clicks, batches)
    if cut is None:
        return spark.createDataFrame([], RESULT)
    apart, latest, total = apart_minutes * MINUTE, {}, 0
    for row in cut.groupBy("batch").agg(F.max("t").alias("latest"), F.count(F.lit(1)).alias("n")).collect():  # a row a batch
        latest[row.batch], total = row.latest, total + row.n
    buckets = -(-total // bucket_rows)
    slot = F.expr(_whole("t", apart)).alias("slot")
    rows = cut.select("click_id", "client", "t", F.pmod(F.xxhash64("client"), F.lit(buckets)).cast("int").alias("bucket"), slot, "batch")
    marks = spark.range(batches * buckets).select(*(F.lit(None).cast("long").alias(c) for c in ("click_id", "client", "t")), F.expr(f"cast(id div {batches} as int)").alias("bucket"), F.lit(None).cast("long").alias("slot"), F.expr(f"cast(id % {batches} as int)").alias("batch"))
    # a client's slot goes to one file, so that it becomes one row before the state's shuffle; the clock's slots spread a client
    spread = F.pmod(F.xxhash64("client", "slot"), F.lit(-(-2 * partitions(spark) // batches)))
    every = materialize(rows.unionByName(marks).repartition(partitions(spark), "batch", spread), "batches", "batch")
    discard(cut)

    root = f"{shared_dir(spark)}/sessions-{uuid.uuid4().hex}"
    fields = every.drop("batch").schema
    before = None  # the late-row bound of the batches so far
    for batch in range(batches):
        _move(spark, f"{every._stored_at}/batch={batch}", f"{root}/in/batch={batch}")
        seen = [t for b, t in latest.items() if b <= batch]
        bound = max(seen) - delay_hours * HOUR if seen else None
        stream = spark.readStream.schema(fields).parquet(f"{root}/in/*")
        if before is not None:
            stream = stream.filter(F.col("t").isNull() | (F.col("t") >= before))
        stream = stream.select("bucket", "client", "slot", "t", F.crc32(F.col("click_id").cast("string")).alias("crc")).mapInArrow(_combine, _SUMMARY)
        step = _step(batch, None if bound is None else bound - apart, batches if batch == batches - 1 else None, apart)
        closed = stream.groupBy("bucket").applyInPandasWithState(step, RESULT, _STATE, "append", GroupStateTimeout.NoTimeout)
        _run(closed.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint"))
        before = bound
    for done in (every._stored_at, f"{root}/in", f"{root}/checkpoint"):
        delete(spark, done)
    return spark.read.schema(RESULT).parquet(f"{root}/out")


def _crc(text: str) -> str:
    """SQL of the CRC-32 of an ASCII text: a fold over its bytes, eight steps each."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, v: xor(xor(a, v) >> 1, 3988292384 * (xor(a, v) & 1))), 4294967295)"


#: Sessions of the rows that came through each batch: where two of one batch lie in one of the next, that is a merge.
ORACLE = f"""
WITH once AS (
  SELECT DISTINCT ON (click_id) click_id, client_id, epoch_us(ts) AS t, epoch_us(COALESCE(arrived_at, ts)) // 3600000000 AS h
  FROM clicks WHERE click_id IS NOT NULL AND client_id IS NOT NULL AND ts IS NOT NULL
  ORDER BY click_id, COALESCE(arrived_at, ts), ts, client_id
), span AS (
  SELECT min(h) AS lo, max(h) AS hi FROM once
), cut AS (
  SELECT click_id, client_id, t, b + CASE WHEN b < 11 AND {_crc("client_id::VARCHAR || ':' || (t // 3600000000)::VARCHAR")} % 7 = 0 THEN 1 ELSE 0 END AS batch
  FROM (SELECT *, 12 * (h - lo) // (hi - lo + 1) AS b FROM once, span)
), bounds AS (
  SELECT b, (SELECT max(t) FROM cut WHERE batch <= b) - 432000000000 AS w FROM range(12) r(b)
), kept AS (
  SELECT c.*, {_crc("click_id::VARCHAR")} AS crc FROM cut c LEFT JOIN bounds ON b = batch - 1 WHERE w IS NULL OR t >= w
), levels AS (
  SELECT kept.*, b, CASE WHEN t - lag(t) OVER (PARTITION BY b, client_id ORDER BY t) <= 1800000000 THEN 0 ELSE 1 END AS head
  FROM kept, range(12) r(b) WHERE batch <= b
), numbered AS (
  SELECT *, sum(head) OVER (PARTITION BY b, client_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS s FROM levels
), placed AS (
  SELECT l.*, max(CASE WHEN b = 11 THEN s END) OVER (PARTITION BY click_id) AS final FROM numbered l
), merges AS (
  SELECT p.client_id, p.final, count(DISTINCT (p.b, p.s)) - count(DISTINCT (q.b, q.s)) AS n_merges
  FROM placed p JOIN placed q ON p.click_id = q.click_id AND q.b = p.b + 1 GROUP BY ALL
), whole AS (
  SELECT client_id, final, min(t) AS first_us, max(t) AS last_us, count(*) AS n_clicks, sum(crc)::BIGINT AS ids_crc32
  FROM placed WHERE b = 11 GROUP BY ALL
)
SELECT client_id, first_us, last_us, n_clicks, ids_crc32, COALESCE(n_merges, 0)::BIGINT AS n_merges,
  COALESCE((SELECT min(b) FROM bounds WHERE w - 1800000000 > last_us), 12)::BIGINT AS close_batch
FROM whole LEFT JOIN merges USING (client_id, final)
"""
