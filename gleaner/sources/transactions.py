"""Appends of text lines as transactions, through a data source with commit and abort.

A folder holds ``parts/<attempt>-<partition>.json`` and ``commits/<name>.json``. Tasks write parts; the driver's
commit puts one small file in place, by a rename, that names the attempt and its time. Lines count once their attempt is committed:

* an append reads nothing of what was written before, and writers that run at once don't meet;
* a job that is aborted takes its parts away (an empty file in ``aborts`` tells its last tasks), one that dies leaves parts that no commit names;
* a task that runs twice leaves two parts, and only the one that its commit lists counts;
* a transaction with a name is committed once: when a stream repeats a batch, the second commit finds the
  first one's file and takes its own parts away.

Any file system that Spark's Python workers reach through Arrow will do (``file``, ``hdfs``, ``s3``, ``gs``).
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass
from weakref import WeakSet

from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "gleaner_lines"
COMMIT = "name string, stamp bigint, parts array<string>"


def _open(path: str):  # noqa: ANN202
    """The Arrow file system of a path or address, and the path in it."""
    from pyarrow import fs

    local = path.removeprefix("file://").removeprefix("file:") if path.startswith("file:") else path
    return (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(local)


def _parts(folder: str, older_than: float = 0.0) -> list[str]:
    """Names of the part files that were last changed at least so many seconds ago."""
    from pyarrow.fs import FileSelector

    files, place = _open(folder)
    found = files.get_file_info(FileSelector(f"{place}/parts", allow_not_found=True))
    return [f.base_name for f in found if time.time_ns() - (f.mtime_ns or 0) >= older_than * 1e9]


@dataclass
class Part(WriterCommitMessage):
    name: str | None


class LineWriter(DataSourceWriter):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.attempt = uuid.uuid4().hex
        self.name = options.get("transaction") or self.attempt
        self.stamp = time.time_ns()

    def write(self, rows: Iterator[Row]) -> Part:
        files, folder = _open(self.folder)
        first = next(rows, None)
        if first is None:
            return Part(None)
        context = TaskContext.get()
        name = f"{self.attempt}-{context.partitionId():06d}-{context.taskAttemptId()}.json"
        files.create_dir(f"{folder}/parts", recursive=True)
        try:
            with files.open_output_stream(f"{folder}/parts/{name}") as out:
                out.write(f"{first[0]}\n".encode())
                for row in rows:
                    out.write(f"{row[0]}\n".encode())
            if self._aborted():
                raise RuntimeError("the job was aborted")
        except BaseException:
            self._drop([name])
            raise
        return Part(name)

    def _drop(self, parts: list[str]) -> None:
        files, folder = _open(self.folder)
        for name in parts:
            with suppress(FileNotFoundError):
                files.delete_file(f"{folder}/parts/{name}")

    def _aborted(self) -> bool:
        from pyarrow.fs import FileType

        files, folder = _open(self.folder)
        return files.get_file_info(f"{folder}/aborts/{self.attempt}").type != FileType.NotFound

    def commit(self, messages: list[Part | None]) -> None:
        from pyarrow.fs import FileType

        files, folder = _open(self.folder)
        parts = sorted(m.name for m in messages if m and m.name)
        place = f"{folder}/commits/{self.name}.json"
        if files.get_file_info(place).type != FileType.NotFound:
            self._drop(parts)
            return
        files.create_dir(f"{folder}/commits", recursive=True)
        with files.open_output_stream(f"{folder}/commits/_{self.attempt}") as out:  # readers pass over names with an underscore
            out.write(json.dumps({"name": self.name, "stamp": self.stamp, "parts": parts}).encode())
        files.move(f"{folder}/commits/_{self.attempt}", place)

    def abort(self, messages: list[Part | None]) -> None:
        """Parts of tasks that Spark has no message of, as they ended while others failed, go too.

        Tasks may still be running: those that have opened their part are seen in the listing, and those that open one later
        find the mark that was set before it.
        """
        files, folder = _open(self.folder)
        files.create_dir(f"{folder}/aborts", recursive=True)
        with files.open_output_stream(f"{folder}/aborts/{self.attempt}") as out:
            out.write(b"")
        self._drop([name for name in _parts(self.folder) if name.startswith(f"{self.attempt}-")])


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: object, overwrite: bool) -> LineWriter:
        if overwrite:
            raise ValueError("lines are appended, never overwritten")
        return LineWriter(self.options)


_REGISTER, _REGISTERED = threading.Lock(), WeakSet()


def append_lines(lines: DataFrame, folder: str, transaction: str | None = None) -> None:
    """Add the one text column of ``lines`` to the folder, all of it or nothing.

    With the name of a transaction that was committed before nothing is added. Null lines are not allowed; an empty table is committed too.
    """
    spark = lines.sparkSession
    with _REGISTER:  # registering again would take the source away for a moment from other threads
        if spark not in _REGISTERED:
            spark.dataSource.register(Lines)
            _REGISTERED.add(spark)
    # Spark looks sources up in the session that is active in this thread, and a thread of the caller's own has none.
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)
    writer = lines.write.format(FORMAT).mode("append").option("path", folder)
    (writer.option("transaction", transaction) if transaction else writer).save()


def committed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(value, stamp): the lines of committed transactions with their times; no rows where there is none."""
    try:
        commits = spark.read.schema(COMMIT).json(f"{folder}/commits")
        parts = spark.read.text(f"{folder}/parts")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, stamp bigint")
    listed = commits.select("stamp", F.explode("parts").alias("part"))
    return parts.select("value", F.col("_metadata.file_name").alias("part")).join(listed, "part").select("value", "stamp")


def remove_stray_parts(spark: SparkSession, folder: str, older_than: float = 86400.0) -> int:
    """Take away parts that no commit lists, left by jobs that died; how many. Running jobs' parts are younger than ``older_than`` seconds."""
    files, place = _open(folder)
    old = spark.createDataFrame([(name,) for name in _parts(folder, older_than)], "part string")
    try:
        listed = spark.read.schema(COMMIT).json(f"{folder}/commits").select(F.explode("parts").alias("part"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = old.limit(0)
    stray = [r["part"] for r in old.join(listed, "part", "left_anti").collect()]
    for name in stray:
        files.delete_file(f"{place}/parts/{name}")
    return len(stray)
