"""One version of many tables: a log whose entries each name all tables' files, so that what belongs together appears together.

A folder holds ``data/<table>/<run>`` (Parquet) and ``log/<number>.json``. A commit writes its runs first and then publishes the
next entry by a rename that fails where another one came first. Readers see the tables of one entry. A crash before the rename
leaves files that no entry names (:meth:`Commits.sweep` deletes them) and the old version.

A table with a key is a list of runs, oldest first: an upsert adds a run of its own rows, and reading takes the newest row of each
key. While the last run is at least half as large as the one before, the two become one, so a table of n rows has about log n runs
and a row is rewritten about log n times, however many commits there are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(Exception):
    """Another commit changed what this one read."""


@dataclass
class Change:
    """Rows of a table. With ``key`` they replace the rows of their keys, else the whole table."""

    rows: DataFrame
    key: list[str] = field(default_factory=list)


class Commits:
    """The log at ``folder``, a path of Hadoop's that all machines reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(folder).toUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        for part in ("log", "data"):
            self._files.mkdirs(self._path(f"{self.folder}/{part}"))

    # ---- reading

    def version(self) -> int:
        """The newest entry's number; 0 before the first."""
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(f"{self.folder}/log"))]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def tables(self, version: int | None = None) -> dict[str, dict]:
        """Each table's key, schema and runs (folder, rows) at a version."""
        version = self.version() if version is None else version
        if not version:
            return {}
        return json.loads(self.spark.read.text(self._entry(version), wholetext=True).first()[0])["tables"]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self._merged(self.tables(version)[name])

    def _entry(self, version: int) -> str:
        return f"{self.folder}/log/{version:012d}.json"

    def _run(self, table: dict, run: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{run['folder']}")

    def _merged(self, table: dict) -> DataFrame:
        runs = [self._run(table, r) for r in table["runs"]]
        if len(runs) == 1:
            return runs[0]
        columns, every = runs[0].columns, None
        for i, rows in enumerate(runs):
            rows = rows.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"), F.lit(i).alias("_run"))
            every = rows if every is None else every.unionByName(rows)
        newest = every.groupBy(*(F.col("_row")[k].alias(f"_k{i}") for i, k in enumerate(table["key"]))).agg(F.max_by("_row", "_run").alias("_row"))
        return newest.select("_row.*")

    # ---- writing

    def _written(self, name: str, rows: DataFrame) -> dict:
        folder = f"data/{name}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{folder}")
        return {"folder": folder, "rows": self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{folder}").count()}

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` as files that no entry names: what must be made once (answers of the network) before it is used twice."""
        run = self._written(name, rows)
        return self._run({"schema": rows.schema.json()}, run)

    def commit(self, changes: dict[str, Change], read: int | None = None, retries: int = 10) -> int:
        """Publish all changes as one entry and return its number. ``read``: the version that they were made from; where a later
        one changed one of the tables, :class:`Conflict` is raised, else the changes go on top of it."""
        base = self.version() if read is None else read
        made = {name: self._written(name, c.rows) for name, c in changes.items()}
        before = self.tables(base)
        for _ in range(retries):
            latest = self.version()
            now = self.tables(latest)
            if latest != base and any(now.get(n) != before.get(n) for n in changes):
                raise Conflict(f"version {latest} changed {sorted(n for n in changes if now.get(n) != before.get(n))}")
            tables = dict(now)
            for name, c in changes.items():
                runs = [*now[name]["runs"], made[name]] if c.key and name in now else [made[name]]
                tables[name] = self._tiered(name, {"key": c.key, "schema": c.rows.schema.json(), "runs": runs})
            if self._publish(latest + 1, tables):
                return latest + 1
        raise Conflict("other commits came first each time")

    def _tiered(self, name: str, table: dict) -> dict:
        while len(table["runs"]) > 1 and table["runs"][-2]["rows"] <= 2 * table["runs"][-1]["rows"]:
            pair = table | {"runs": table["runs"][-2:]}
            table = table | {"runs": [*table["runs"][:-2], self._written(name, self._merged(pair))]}
        return table

    def _publish(self, version: int, tables: dict) -> bool:
        draft = self._path(f"{self.folder}/log/.{uuid.uuid4().hex}")
        out = self._files.create(draft)
        out.write(bytearray(json.dumps({"tables": tables}).encode()))
        out.close()
        try:
            self._context.rename(draft, self._path(self._entry(version)), self._no_options)
            return True
        except Exception as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def sweep(self, keep: int = 1) -> list[str]:
        """Delete the runs that none of the last ``keep`` entries names; while no commit is under way."""
        newest = self.version()
        named = {r["folder"] for v in range(max(1, newest - keep + 1), newest + 1) for t in self.tables(v).values() for r in t["runs"]}
        gone = []
        for table in self._files.listStatus(self._path(f"{self.folder}/data")):
            for run in self._files.listStatus(table.getPath()):
                folder = f"data/{table.getPath().getName()}/{run.getPath().getName()}"
                if folder not in named:
                    self._files.delete(run.getPath(), True)
                    gone.append(folder)
        return gone


def retried(commits: Commits, change: Callable[[int], dict[str, Change]], times: int = 5) -> int:
    """Commit what ``change`` makes of a version; made anew from the newer one after a conflict."""
    for left in range(times - 1, -1, -1):
        version = commits.version()
        try:
            return commits.commit(change(version), read=version)
        except Conflict:
            if not left:
                raise
    raise AssertionError
