"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE)] = True
#: ASCII lower-casing by table; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local session that names none gets a temporary one; a cluster's
    has to name it, as executors don't see the driver's folders."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="palimpsest-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def materialize(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder, in a folder for each value of ``folders``, and read it back, so that
    later jobs start from files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(stored: DataFrame | None) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    if stored is not None and (path := getattr(stored, "_stored_at", None)):
        delete(stored.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def numbered(df: DataFrame, name: str, column: str, *order) -> DataFrame:
    """``df`` as a stored table with its rows' places 0, 1, ... in ``order``; a count for each partition comes to the driver."""
    spark = df.sparkSession
    stored = materialize(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), name)
    held = stored.groupBy(F.shiftright("_id", 33).alias("_part")).count().orderBy("_part").collect()
    begin, before = [], 0
    for part, n in held:
        begin.append((part, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(begin, "_part long, _begin long"))
    placed = stored.join(offsets, F.shiftright("_id", 33) == F.col("_part"))
    return placed.withColumn(column, F.col("_begin") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "_begin")


#: A key with over 1 / HOT of all rows is hot, so there are HOT such keys at most, whatever the input.
HOT = 4096


def skew_join(rows: DataFrame, table: DataFrame, keys: list[str], hot: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has a key once. The keys for which ``hot`` holds (HOT at most) are broadcast, so that
    rows of a hot key stay where they are; the others are shuffled. ``table`` is stored first."""
    table = materialize(table, "keys")
    heavy = table.filter(hot)
    if not heavy.count():
        return rows.join(table, keys, how)
    hit = rows.join(F.broadcast(heavy), keys)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(table.filter(~hot), keys, how)
    return hit.unionByName(rest)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried_row(carry: tuple[str, ...]) -> Column:
    """The columns an operator carries, as one column ``carried``, so that none clashes with its own."""
    return (F.struct(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry))) if carry else F.lit(None).cast("string")).alias("carried")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its values; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    start, n = column.offset, len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[start : start + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def runs(column: pa.Array, most_bytes: int = 1 << 20, most_rows: int = 256) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs with about ``most_bytes`` of text at most; a longer text is alone."""
    sizes = np.diff(flat(column)[1])
    at = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and (total + size > most_bytes or i - at == most_rows):
            yield at, i - at
            at, total = i, 0
        total += size
    if len(sizes):
        yield at, len(sizes) - at


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the constants are those of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
#: A prime modulus beside 2**64: a polynomial modulo a power of two collides on long words of two letters in the order of
#: Thue and Morse, whatever its base; modulo a prime it doesn't.
_PRIME, _PRIME_BASE = (1 << 31) - 1, 0x4C957F2D % ((1 << 31) - 1)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, and of a base modulo a prime and of its inverse, n of each
    at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size, tables = 1 << max(20, (n - 1).bit_length()), []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        for base in (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME)):
            steps = np.ones(1, np.uint64)
            while len(steps) < size:
                steps = np.concatenate([steps, steps * np.uint64(pow(base, len(steps), _PRIME)) % np.uint64(_PRIME)])
            tables.append(steps)
        _POWERS[:] = tables
    return _POWERS


class Ranges:
    """64-bit hashes of byte ranges of ``data``; equal bytes give equal hashes. Both polynomials and the length count."""

    def __init__(self, data: np.ndarray):
        self.tables = powers(len(data) + 1)
        values = data.astype(np.uint64) + np.uint64(1)
        self.wide, self.prime = np.zeros(len(data) + 1, np.uint64), np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * self.tables[0][: len(data)], out=self.wide[1:])
        terms = values * self.tables[2][: len(data)]  # under 2**40, so sums of under 2**24 of them fit even where the total doesn't
        np.cumsum(terms if len(data) < 1 << 24 else terms % np.uint64(_PRIME), out=self.prime[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        wide = (self.wide[end] - self.wide[start]) * self.tables[1][start]
        prime = (self.prime[end] - self.prime[start]) % np.uint64(_PRIME) * self.tables[3][start] % np.uint64(_PRIME)
        return mix64(wide + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) ^ mix64(prime))


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Ranges(data).hashes(start, end)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, which holds texts back to back, and each text's first word (n + 1)."""
    space = IS_SPACE[data]
    edge = np.ones(len(data) + 1, bool)  # True where a text begins
    edge[:] = False
    edge[offsets[:-1]] = True
    word = ~space
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    if len(data):
        after[-1] = False
        after[:-1] = word[1:]
    last = np.zeros(len(data) + 1, bool)
    last[offsets[1:]] = True
    ends = np.flatnonzero(word & (~after | last[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_count(column) -> F.Column:
    """The number of words of a text; null counts none."""
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
