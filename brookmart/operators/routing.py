"""Config-driven routing of change rows to dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

UPSERTS = ("insert", "update", "bootstrap-insert")


def latest_config(events: DataFrame) -> DataFrame:
    """Current route per source table, from Debezium rows; a delete removes the route."""
    table = F.coalesce("after.source_table", "before.source_table")
    newest = events.groupBy(table.alias("source_table")).agg(
        F.max_by(F.struct("op", "after"), "ts_ms").alias("_r")
    )
    live = newest.where((F.col("_r.op") != "d") & F.col("_r.after").isNotNull())
    return live.select(
        "source_table",
        "_r.after.sink_table",
        "_r.after.sink_columns",
        F.coalesce("_r.after.sink_pk", F.lit("id")).alias("sink_pk"),
        F.coalesce("_r.after.sink_extend", F.lit("")).alias("sink_extend"),
    )


def route_dims(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Rows for the configured tables: target table, key, configured columns only, and change time.

    Rows of tables without a route, and deletes, are dropped. The routes, a row per table, are broadcast whatever their estimated size:
    a join by the name of the table would put all changes of a table into one task.
    """
    routes = config.select(
        F.col("source_table").alias("table"),
        "sink_table",
        F.coalesce("sink_pk", F.lit("id")).alias("_pk"),
        F.split("sink_columns", r"\s*,\s*").alias("_columns"),
    )
    rows = changes.where(F.col("type").isin(*UPSERTS)).join(F.broadcast(routes), "table", "inner")
    kept = F.map_filter("data", lambda name, _: F.array_contains("_columns", name))
    return rows.select(
        "sink_table",
        F.element_at("data", F.col("_pk")).alias("pk"),
        kept.alias("data"),
        *[c for c in changes.columns if c not in ("database", "table", "type", "data", "old")],
    )
