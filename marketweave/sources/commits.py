"""A log of numbered commits in a folder, for readers that go by the last one and writers that may run at once.

A commit is a JSON file ``000000000042.json``. It is written aside and put in its place only if no file has that name, by a
hard link on local disks and by a rename without overwriting on other stores; a writer that comes second reads what the
first one left and tries the next number. So the order of commits is that of their numbers, whatever the clocks say.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Tries before a writer gives up; each one means that another writer got a commit in.
TRIES = 100


class Conflict(OSError):
    """Other writers took every number that was tried."""


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, files = _hadoop(spark, path)
    return files.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, files = _hadoop(spark, path)
    files.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    p, files = _hadoop(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(p)) if files.exists(p) else []


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Whether ``source`` became ``target``; false if that is there already. Parents are made."""
    jvm = spark._jvm.org.apache.hadoop.fs
    a, files = _hadoop(spark, source)
    b, _ = _hadoop(spark, target)
    files.mkdirs(b.getParent())
    if files.getUri().getScheme() == "file" and not files.getFileStatus(a).isDirectory():
        try:
            os.link(a.toUri().getPath(), b.toUri().getPath())
        except FileExistsError:
            return False
        os.unlink(a.toUri().getPath())
        return True
    context = jvm.FileContext.getFileContext(files.makeQualified(a).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(a), files.makeQualified(b), spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0))
    except Exception:
        if files.exists(b):
            return False
        raise
    return True


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` where ``target`` is or may be."""
    jvm = spark._jvm.org.apache.hadoop.fs
    a, files = _hadoop(spark, source)
    kinds = getattr(jvm, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE
    context = jvm.FileContext.getFileContext(files.makeQualified(a).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(a), files.makeQualified(jvm.Path(target)), options)


def _write(spark: SparkSession, path: str, text: str) -> None:
    p, files = _hadoop(spark, path)
    out = files.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read(spark: SparkSession, folder: str, number: int) -> dict:
    p, files = _hadoop(spark, f"{folder}/{number:012d}.json")
    stream = files.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def last(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """Number and content of the last commit; 0 and None before the first."""
    numbers = [int(n[:12]) for n in names(spark, folder) if len(n) == 17 and n[:12].isdigit() and n.endswith(".json")]
    return (max(numbers), read(spark, folder, max(numbers))) if numbers else (0, None)


def commit(spark: SparkSession, folder: str, make: Callable[[int, dict | None], dict]) -> int:
    """Append what ``make`` returns for the last number and content; it is asked again whenever another writer was first."""
    for _ in range(TRIES):
        number, before = last(spark, folder)
        aside = f"{folder}/_{uuid.uuid4().hex}"
        _write(spark, aside, json.dumps(make(number, before), sort_keys=True))
        try:
            if rename(spark, aside, f"{folder}/{number + 1:012d}.json"):
                return number + 1
        finally:
            delete(spark, aside)
    raise Conflict(f"{folder}: {TRIES} tries")
