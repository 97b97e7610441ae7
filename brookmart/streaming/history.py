"""Inner joins of streams without a time bound, over written history instead of state.

A state store costs several reads and writes of single keys for every row, which is right for an always-on job of small micro-batches. A job that
catches up on a large backlog has few, large micro-batches, and there a join of whole tables is many times cheaper. Every batch is written as it is;
its results are those of the batch plan over what is new on one side and all there is on the others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from brookmart.sinks.append import _trigger
from brookmart.sinks.files import children
from brookmart.sinks.versions import batch_path

INPUT = "_input"


class History:
    """The rows of every batch below ``root``, each in the folder of its batch number. A batch that runs again overwrites its own."""

    def __init__(self, root: str, schema: T.StructType):
        self.root, self.schema = root, schema

    def write(self, rows: DataFrame, batch_id: int, *parts: str) -> None:
        rows.write.mode("overwrite").partitionBy(*parts).parquet(batch_path(self.root, batch_id))

    def read(self, spark: SparkSession, first: int, last: int, part: str = "") -> DataFrame | None:
        """Rows of the batches ``first`` to ``last``, with their ``batch_id``, of all folders or of the one named; None if there are none."""
        numbers = [int(n.rpartition("=")[2]) for n in children(spark, self.root) if n.startswith("batch_id=")]
        folders = [batch_path(self.root, n) for n in sorted(numbers) if first <= n <= last]
        if part:
            folders = [f"{f}/{part}" for f in folders if part in children(spark, f)]
        layout = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        return spark.read.schema(layout).option("basePath", self.root).parquet(*folders) if folders else None


@dataclass
class Joined:
    """A job's input in place of a stream: ``plan(*inputs)``, which must be an inner join (with projections and filters) of all ``inputs``.

    Partners may come at any time. ``start`` runs ``work`` on each batch's new results. The history is in ``root/history`` and is read by every batch,
    so this is for catching up; an always-on job joins the streams themselves.
    """

    inputs: list[DataFrame]
    plan: Callable[..., DataFrame]
    root: str

    def columns(self) -> list[str]:
        return self.plan(*[df.sparkSession.createDataFrame([], df.schema) for df in self.inputs]).columns

    def start(self, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping | None = None, persist: bool = False) -> StreamingQuery:
        rows = None
        for i, df in enumerate(self.inputs):
            tagged = df.select(F.lit(i).alias(INPUT), F.struct(*df.columns).alias(f"_{i}"))
            rows = tagged if rows is None else rows.unionByName(tagged, allowMissingColumns=True)
        history = History(f"{self.root}/history", rows.drop(INPUT).schema)

        def joined(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            history.write(batch, batch_id, INPUT)

            def rows_of(i: int, first: int, last: int) -> DataFrame | None:
                found = history.read(spark, first, last, f"{INPUT}={i}")
                if found and first == batch_id:
                    # All of them are; the condition tells Spark that it may filter the history by what is new before it is shuffled.
                    found = found.where(F.col("batch_id") == batch_id)
                return found and found.select(f"_{i}.*")

            results = None
            for i, _ in enumerate(self.inputs):
                # What is new on side i, with all of the sides after it and what was there before on those before it.
                sides = [rows_of(j, batch_id if j == i else 0, batch_id - 1 if j < i else batch_id) for j, _ in enumerate(self.inputs)]
                if all(s is not None for s in sides):
                    part = self.plan(*sides)
                    results = part if results is None else results.unionByName(part)
            if results is None:
                return
            if persist:
                results.persist()
            try:
                work(results, batch_id)
            finally:
                results.unpersist()

        writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(joined)
        return _trigger(writer, trigger).start()
