"""Starting queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from brookmart.sinks.append import _trigger
from brookmart.sinks.files import children, read_json, write_json
from brookmart.streaming.history import Joined


def start_batches(
    df: DataFrame | Joined, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Run ``work`` on every micro-batch, which is persisted while it runs (several reads of it). ``df`` may be a ``history.Joined``."""
    if isinstance(df, Joined):
        return df.start(work, checkpoint, trigger, persist=True)

    def persisted(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            work(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(persisted)
    return _trigger(writer, trigger).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an availableNow query; its failure is raised here."""
    query.awaitTermination()


class LateRows(StreamingQueryListener):
    """A written count of rows dropped for being older than the watermark, from every progress report of every query.

    A query keeps only its last reports; here each batch with late rows leaves a file named by its number, which a batch that runs again
    replaces. Add it with ``spark.streams.addListener``. Counts are by the query's checkpoint, so they go on over restarts.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if late:
            write_json(self.spark, f"{self.folder}/{p.id}/{p.batchId}.json", late)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query_id) -> int:
        folder = f"{self.folder}/{query_id}"
        return sum(read_json(self.spark, f"{folder}/{n}") for n in children(self.spark, folder) if not n.startswith("_"))


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped so far for being older than the watermark, over the kept progress reports. ``LateRows`` counts over all of them.
    """
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
