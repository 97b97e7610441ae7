"""Append-only sinks for streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from brookmart.operators.parse import to_json_value


def kafka_sink(servers: str, topic: str, **options: str) -> dict[str, str]:
    """Options of a Kafka sink. Spark writes it at least once; readers must accept repeated records."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **options}


def _trigger(writer, trigger: Mapping | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def write_append(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    trigger: Mapping | None = None,
    as_json: bool = False,
) -> StreamingQuery:
    """Start an append query. File sinks are exactly once; ``as_json`` writes one JSON text per row."""
    out = to_json_value(df) if as_json else df
    writer = out.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = _trigger(writer.options(**(options or {})), trigger)
    return writer.start(path) if path else writer.start()


def write_console(df: DataFrame, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    return write_append(df, "console", checkpoint, trigger=trigger)
