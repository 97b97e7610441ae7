"""Upsert sink: the newest version per key, in a table that compacts while the stream runs (see sinks.versions)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from brookmart.sinks.append import _trigger
from brookmart.sinks.versions import VersionedTable, batch_path

__all__ = ["batch_path", "compact_upsert", "read_upsert", "upsert_batch", "write_upsert"]


def upsert_batch(
    batch: DataFrame, batch_id: int, path: str, pk: Iterable[str], seq: Iterable[str], retain: int | None = 8, reduced: bool = True
) -> None:
    """Write one batch, reduced to the newest version per key (unless ``reduced`` is off), and merge parts that have come together."""
    VersionedTable(path, pk, seq, retain=retain, reduced=reduced).commit(batch, batch_id)


def write_upsert(
    df: DataFrame,
    path: str,
    pk: Iterable[str],
    seq: Iterable[str],
    checkpoint: str,
    output_mode: str = "append",
    trigger: Mapping | None = None,
    retain: int | None = 8,
) -> StreamingQuery:
    """Start an upsert query keyed by ``pk``; among versions of a key the greatest ``seq`` wins.

    With ``output_mode='update'`` results of open windows are written early and replaced later. With ``retain=None`` the
    rows of every batch stay in ``path/batch_id=*``, for a stream that reads them; else they go some batches after they are merged.
    ``df`` may be a ``streaming.history.Joined``; the rows of its batches are written as they are, and versions of a key meet when parts are merged or read.
    """
    pk, seq = list(pk), list(seq)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, path, pk, seq, retain, isinstance(df, DataFrame))

    if not isinstance(df, DataFrame):
        return df.start(write, checkpoint, trigger)
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, trigger).start()


def read_upsert(spark: SparkSession, path: str, pk: Iterable[str], seq: Iterable[str]) -> DataFrame:
    """The newest version per key; for equal ``seq`` the later batch wins. What later batches change is not seen."""
    return VersionedTable(path, pk, seq).read(spark)


def compact_upsert(spark: SparkSession, path: str, target: str, pk: Iterable[str], seq: Iterable[str]) -> None:
    """Copy the newest version into a new table with one row per key; the stream may go on there with later batches."""
    table = VersionedTable(path, pk, seq)
    VersionedTable(target, pk, seq).commit(table.read(spark), table.manifest(spark)["batch"])
