"""A polite HTTP source: one partition a host, throttled, with retries; and planning of what to fetch."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import is_challenge, is_missing

# Seconds between requests, retries and their waits, timeout.
LEAST_WAIT, MOST_WAIT = 2.0, 4.0
RETRIES, FIRST_BACKOFF, TIMEOUT = 3, 10.0, 30.0
SCHEMA = "url string, status int, content binary, last_modified string, error string"


class Fatal(Exception):
    """A status that a retry doesn't change."""


def request(url: str) -> tuple[int, bytes, str | None]:
    with urllib.request.urlopen(url, timeout=TIMEOUT) as r:  # noqa: S310
        return r.status, r.read(), r.headers.get("Last-Modified")


def fetch(url: str, get: Callable[[str], tuple[int, bytes, str | None]] = request, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """A row of SCHEMA: 429, 5xx and network errors are tried again after 10, 20 and 40 seconds, other statuses are final."""
    error = ""
    for attempt in range(RETRIES + 1):
        sleep(random.uniform(LEAST_WAIT, MOST_WAIT) if not attempt else FIRST_BACKOFF * 2 ** (attempt - 1))  # noqa: S311
        try:
            status, content, modified = get(url)
            return url, status, content, modified, None
        except urllib.error.HTTPError as e:
            error = f"status {e.code}"
            if e.code != 429 and e.code < 500:
                return url, e.code, None, None, error
        except OSError as e:
            error = str(e)
    return url, None, None, None, error


class HostPartition(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class PoliteReader(DataSourceReader):
    def __init__(self, urls: list[str]):
        self.urls = urls

    def partitions(self) -> list[HostPartition]:
        hosts: dict[str, list[str]] = {}
        for u in self.urls:
            hosts.setdefault(urlsplit(u).netloc, []).append(u)
        return [HostPartition(x) for x in hosts.values()]

    def read(self, partition: HostPartition) -> Iterator[tuple]:
        for u in partition.urls:
            yield fetch(u)


class PoliteHttp(DataSource):
    """``spark.dataSource.register(PoliteHttp)``, then ``format("polite_http")`` with addresses, one a line, as ``urls``."""

    @classmethod
    def name(cls) -> str:
        return "polite_http"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PoliteReader:
        return PoliteReader([u for u in self.options.get("urls", "").split("\n") if u])


def _fetch_in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for url in batch.column(0).to_pylist():
            row = fetch(url)
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, (pa.string(), pa.int32(), pa.binary(), pa.string(), pa.string()), strict=True)], [c.split(" ")[0] for c in SCHEMA.split(", ")])


def fetch_all(pages: DataFrame, url: str = "url") -> DataFrame:
    """Rows of SCHEMA for a column of addresses: a host's are in one partition, in turn, so that each host waits for itself."""
    rows = pages.select(F.col(url).alias("url")).distinct().withColumn("host", F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")))
    return rows.repartition("host").sortWithinPartitions("host", "url").select("url").mapInArrow(_fetch_in_turn, SCHEMA)


def to_fetch(pages: DataFrame, snapshots: DataFrame, mode: str | None = None, force: bool = False) -> DataFrame:
    """Registered pages of a mode that have no snapshot yet, or all on request."""
    wanted = pages if mode is None else pages.filter(F.col("mode") == mode)
    return wanted if force else wanted.join(snapshots.select("name").distinct(), "name", "left_anti")


def page_status(html, error):
    """error, challenged, missing or ok."""
    return F.when(error.isNotNull(), "error").when(is_challenge(html), "challenged").when(is_missing(html), "missing").otherwise("ok")
