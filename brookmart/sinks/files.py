"""Small files beside tables, by the session's own file systems."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def write_json(spark: SparkSession, path: str, value) -> None:
    """Write under another name and rename, so that a reader sees the whole file or none."""
    fs, where = _at(spark, path)
    _, aside = _at(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    fs.delete(where, False)
    if not fs.rename(aside, where):
        raise OSError(f"could not publish {path}")


def read_json(spark: SparkSession, path: str):
    fs, where = _at(spark, path)
    source = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def date_files(spark: SparkSession, folder: str, suffix: str, first: int, dated: Iterable[str] = ()) -> int:
    """Give the files of a folder, but those ``dated`` before, modification times one second apart from ``first`` (epoch milliseconds) on, in the order of
    their names; their number."""
    names = [n for n in children(spark, folder) if n.endswith(suffix) and n not in dated]
    for i, name in enumerate(names):
        fs, where = _at(spark, f"{folder}/{name}")
        fs.setTimes(where, first + 1000 * i, -1)
    return len(names)
