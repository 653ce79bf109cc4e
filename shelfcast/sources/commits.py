"""Numbered commits of a stored state: which of its runs holds, decided by one rename.

A writer puts its files into a folder of its own and commits last, under the number that
follows the one it read. A reader follows the highest number. A writer that stops early leaves
files that nobody reads, and of two writers that began with the same state only one can commit.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

NUMBERED = re.compile(r"\d{10}")


class Overtaken(RuntimeError):
    """Another writer committed first; what this one wrote is not read."""


@dataclass(frozen=True)
class Commit:
    """A number and the run that it stands for; number 0 is the state before any commit."""

    number: int = 0
    run: str | None = None


def new_run() -> str:
    return uuid.uuid4().hex


def last_commit(spark: SparkSession, folder: str) -> Commit:
    """The commit that holds now, in any file system that Spark reads."""
    path, files = _files(spark, folder)
    if not files.exists(path):
        return Commit()
    names = [status.getPath().getName() for status in files.listStatus(path)]
    numbers = [name for name in names if NUMBERED.fullmatch(name)]
    if not numbers:
        return Commit()
    last = max(numbers)
    return Commit(int(last), read_text(spark, f"{folder}/{last}"))


def commit(spark: SparkSession, folder: str, before: Commit, run: str) -> Commit:
    """Make ``run`` the state that follows ``before``; raises ``Overtaken`` if that place is taken."""
    after = Commit(before.number + 1, run)
    if not put_new(spark, folder, f"{after.number:010d}", run):
        raise Overtaken(f"{folder}: commit {after.number} was made by another writer")
    return after


def put_new(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write a file unless there is one of that name, and say whether it was written.

    The file is complete before it gets its name, and a rename onto a taken name is refused: at
    once by a distributed file system, after a look by a local one. An object store that cannot
    do that needs one writer at a time.
    """
    path, files = _files(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = files.create(path, False)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{folder}/{name}")
    context = hadoop.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    never_replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(path, target, never_replace)
    except Py4JJavaError as fault:
        files.delete(path, False)
        if "FileAlreadyExistsException" not in fault.java_exception.getClass().getName():
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None without the file."""
    place, files = _files(spark, path)
    try:
        opened = files.open(place)
    except Py4JJavaError as fault:
        if "FileNotFoundException" not in fault.java_exception.getClass().getName():
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def remove(spark: SparkSession, path: str) -> None:
    place, files = _files(spark, path)
    files.delete(place, False)


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
