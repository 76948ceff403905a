"""A small table with optimistic commits: readers take a version, writers claim the next one.

Layout under ``root``: ``data-<id>/`` folders and ``_commits/<version>``, a file that names the folder of
that version. A commit writes its folder first and then creates the next commit file; creation
fails where the file exists, so of several writers that read one version exactly one commits and the
others get ``CommitConflict``, read again and decide again. This is what a transaction around a job
ledger gives: two runs never start from the same state.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class CommitConflict(Exception):
    """Another writer has committed since the version was read."""


def _path(spark: SparkSession, text: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)  # noqa: SLF001 - Hadoop's public file API
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text``; False where it exists. One of several callers succeeds."""
    target, fs = _path(spark, path)
    if fs.getUri().getScheme() == "file":  # Hadoop's local files have no exclusive create
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{uuid.uuid4().hex}"
        with open(part, "w") as f:
            f.write(text)
        try:
            os.link(part, local)  # whole or not at all
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()) or fs.exists(target):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


@contextmanager
def exclusive(spark: SparkSession, path: str, lease: float = 900.0, wait: float = 1800.0) -> Iterator[None]:
    """Hold the lock file ``path`` for a short change of metadata (a switch of partitions, not a job). One
    that is older than ``lease`` seconds was left by a driver that died, and is taken over."""
    deadline = time.monotonic() + wait
    mine = uuid.uuid4().hex
    while not claim(spark, path, mine):
        target, fs = _path(spark, path)
        try:
            age = time.time() - fs.getFileStatus(target).getModificationTime() / 1000
        except Py4JJavaError:  # released meanwhile
            continue
        if age > lease:
            fs.delete(target, False)
        elif time.monotonic() > deadline:
            raise TimeoutError(f"{path} is held by another writer")
        else:
            time.sleep(0.2)
    try:
        yield
    finally:
        target, fs = _path(spark, path)
        fs.delete(target, False)


class VersionedTable:
    """A table of numbered versions under ``root`` (module docstring); version 0 is the empty table."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def version(self) -> int:
        folder, fs = _path(self.spark, f"{self.root}/_commits")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def read(self, version: int | None = None) -> tuple[int, DataFrame]:
        """(version, rows): the newest version, or the one given."""
        version = self.version() if version is None else version
        if version == 0:
            return 0, self.spark.createDataFrame([], self.schema)
        name = self.spark.read.text(f"{self.root}/_commits/{version:012}").first()[0]
        return version, self.spark.read.schema(self.schema).parquet(f"{self.root}/{name}")

    def commit(self, version: int, rows: DataFrame) -> int:
        """Make ``rows``, derived from ``version``, the next version. ``CommitConflict`` if it exists by now."""
        name = f"data-{uuid.uuid4().hex[:16]}"
        rows.write.parquet(f"{self.root}/{name}")
        if not claim(self.spark, f"{self.root}/_commits/{version + 1:012}", name):
            raise CommitConflict(f"{self.root}: version {version + 1} was committed by another writer")
        return version + 1

    def update(self, change: Callable[[int, DataFrame], DataFrame], tries: int = 20) -> int:
        """Commit ``change(version, newest rows)``; on a conflict read again and apply ``change`` again."""
        for _ in range(tries):
            version, rows = self.read()
            try:
                return self.commit(version, change(version, rows))
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.root}: no commit after {tries} tries")
