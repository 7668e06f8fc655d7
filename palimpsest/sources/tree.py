"""A file for each row: a sink in two phases.

``rows.write.format("tree").mode("overwrite").save(folder)`` writes column ``body`` (text or bytes) of each row to the file ``path``
below ``folder``. Tasks write into a staging folder beside it, each attempt into its own; when all are done, the driver moves what
the successful attempts wrote into place: with ``overwrite`` the whole tree by one rename, with ``append`` task by task. A job that
fails leaves the folder as it was; a task of it that runs on for a moment may leave a staging folder, which nothing reads. The
folder is any that ``pyarrow.fs`` reaches from all machines (``file://``, ``hdfs://``, ``s3://`` and so on).

Paths are relative, with ``/`` between their parts; absolute ones and ``..`` are errors. Of rows with one path in one task the last
counts, over tasks the one of the highest task number. Null bodies are empty files; a null or empty path is an error.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType


@dataclass
class Written(WriterCommitMessage):
    task: int
    folder: str
    files: int


def _checked(path: str | None) -> str:
    clean = posixpath.normpath(path or "")
    if not path or clean.startswith(("/", "..")) or clean == ".":
        raise ValueError(f"not a path below the folder: {path!r}")
    return clean


class TreeWriter(DataSourceWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite = folder.rstrip("/"), overwrite
        self.job = f".staging-{uuid.uuid4().hex}"

    def _open(self) -> tuple[fs.FileSystem, str, str]:
        files, root = fs.FileSystem.from_uri(self.folder)
        return files, root, posixpath.join(posixpath.dirname(root), self.job)

    def write(self, iterator: Iterator[Row]) -> Written:
        from pyspark import TaskContext

        files, _, stage = self._open()
        task = TaskContext.get()
        mine, made, n = f"{stage}/{task.partitionId()}-{task.attemptNumber()}", set(), 0
        files.create_dir(mine, recursive=True)
        for row in iterator:
            target = f"{mine}/{_checked(row['path'])}"
            if (above := posixpath.dirname(target)) not in made:
                files.create_dir(above, recursive=True)
                made.add(above)
            body = row["body"]
            with files.open_output_stream(target) as out:
                out.write(b"" if body is None else body.encode() if isinstance(body, str) else bytes(body))
            n += 1
        return Written(task.partitionId(), mine, n)

    def commit(self, messages: list[Written | None]) -> None:
        files, root, stage = self._open()
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        if not self.overwrite:
            files.create_dir(root, recursive=True)
            for m in parts:
                self._move(files, m.folder, root)
        else:
            whole = f"{stage}/whole"
            files.create_dir(whole, recursive=True)
            for m in parts:
                self._move(files, m.folder, whole)
            old = f"{stage}/old"
            if files.get_file_info(root).type != fs.FileType.NotFound:
                files.move(root, old)
            files.move(whole, root)
        files.delete_dir(stage)

    def _move(self, files: fs.FileSystem, source: str, target: str) -> None:
        """The entries of a folder into another one; folders that both have are joined."""
        for entry in files.get_file_info(fs.FileSelector(source)):
            to = f"{target}/{entry.base_name}"
            there = files.get_file_info(to).type
            if entry.type == fs.FileType.Directory and there == fs.FileType.Directory:
                self._move(files, entry.path, to)
            else:
                files.move(entry.path, to)

    def abort(self, messages: list[Written | None]) -> None:
        files, _, stage = self._open()
        if files.get_file_info(stage).type != fs.FileType.NotFound:
            files.delete_dir(stage)


class Tree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tree"

    def schema(self) -> str:
        return "path string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> TreeWriter:
        missing = {"path", "body"} - set(schema.names)
        if missing:
            raise ValueError(f"columns {sorted(missing)} are missing")
        return TreeWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Tree)
