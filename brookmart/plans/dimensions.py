"""Dimension synchronisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brookmart.operators import latest_by_key, route_dims


def dim_sync(changes: DataFrame, config: DataFrame) -> DataFrame:
    """The current rows of all routed dimension tables: (sink_table, pk, data). Stream: upsert_dims."""
    rows = route_dims(changes, config).select("sink_table", "pk", "data", "ts")
    newest: list[str | Column] = ["ts", F.to_json("data")]
    return latest_by_key(rows, ["sink_table", "pk"], newest)


def dim_rows(synced: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """One table of ``dim_sync`` with its columns as text."""
    return synced.where(F.col("sink_table") == sink_table).select(*[F.col("data")[c].alias(c) for c in columns])
