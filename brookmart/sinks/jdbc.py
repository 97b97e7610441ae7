"""Batched JDBC result sink."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from brookmart.sinks.append import _trigger


def jdbc_options(url: str, table: str, batch_size: int = 1000, **options: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **options}


def write_jdbc_batch(
    df: DataFrame,
    options: Mapping[str, str],
    columns: Iterable[str],
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery | None:
    """Insert ``columns`` (bound by name; helper columns are left out) from a batch or a stream.

    A repeated micro-batch inserts its rows again, so the target table should replace rows by the
    result key: window bounds plus dimensions.
    """
    columns = list(columns)

    def write(batch: DataFrame, _batch_id: int = 0) -> None:
        batch.select(*columns).write.format("jdbc").options(**options).mode("append").save()

    if not df.isStreaming:
        write(df)
        return None
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, trigger).start()
