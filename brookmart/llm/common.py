"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library where it lies in the same folder, installed or not."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


_in_worker: dict[tuple, object] = {}


def in_worker(make: Callable, *key):
    """``make(*key)``, kept by this Python worker until something else is asked for: workers live on from stage to stage."""
    if (make, *key) not in _in_worker:
        _in_worker.clear()
        _in_worker[(make, *key)] = make(*key)
    return _in_worker[(make, *key)]


class Scratch:
    """Written tables of one run, below the shared folder, so that no step depends on a lost executor.

    ``keep`` writes a table and reads it again. ``drop`` deletes one that no later step reads.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        importable(spark)
        self.spark = spark
        self.folder = shared_folder(spark, purpose)
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.folder}/{self._n:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in tables:
            for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                if folder.removeprefix("file:").lstrip("/").startswith(self.folder.removeprefix("file:").lstrip("/")):
                    path = jvm.org.apache.hadoop.fs.Path(folder)
                    path.getFileSystem(conf).delete(path, True)
