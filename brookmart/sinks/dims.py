"""Dimension tables, kept as one versioned change table that is split by target table.

All tables of a micro-batch are written by one job, however many there are, and are merged as the stream goes on (see sinks.versions).
A row holds the key and the configured columns as a text map; reading a table turns the map into text columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from brookmart import schemas
from brookmart.operators.routing import route_dims
from brookmart.sinks.append import _trigger
from brookmart.sinks.files import children, delete, exists, read_json, write_json
from brookmart.sinks.versions import VersionedTable

KEYLESS = "rows_without_key"
CONFIG = "_config"
#: Stored configurations kept behind the newest batch.
KEPT_CONFIGS = 8

_ROWS = T.StructType([
    T.StructField("pk", T.StringType()),
    T.StructField("data", schemas.STRING_MAP),
    T.StructField("ts", T.LongType()),
    T.StructField("sink_table", T.StringType()),
])


def _table(root: str) -> VersionedTable:
    # Of rows with equal time in one batch the one with the greatest text counts.
    return VersionedTable(root, ["sink_table", "pk"], ["ts", F.to_json("data")], split="sink_table", loose=True, spread=True)


def ensure_dim_table(spark: SparkSession, root: str, sink_table: str, columns: Iterable[str] = ()) -> None:
    """Let an empty root know the table. Tables of a running stream become known with its batches."""
    _table(root).note(spark, _ROWS, tables={sink_table: list(columns)})


def known_tables(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The columns that each table was last configured with."""
    manifest = _table(root).manifest(spark)
    return manifest["notes"].get("tables", {}) if manifest else {}


def upsert_batch(changes: DataFrame, config: DataFrame, batch_id: int, root: str) -> None:
    """Route one batch of change rows and write the newest row per table and key.

    Every configured table is known afterwards, with its columns, empty or not; that takes no write of its own. Rows without a key are kept
    whole, in the table KEYLESS.
    """
    routes = config.select("sink_table", "sink_columns").collect()  # a row per configured table
    tables = {**known_tables(changes.sparkSession, root), **{r[0]: [c.strip() for c in (r[1] or "").split(",") if c.strip()] for r in routes}}
    rows = route_dims(changes, config).select("pk", "data", "ts", "sink_table")
    _table(root).commit(rows.withColumn("sink_table", F.when(F.col("pk").isNull(), KEYLESS).otherwise(F.col("sink_table"))), batch_id, tables=tables)


def pinned_config(spark: SparkSession, read_config, root: str, batch_id: int) -> DataFrame:
    """The configuration of a batch: as it was stored before the batch first ran, or else as it is now, which is stored."""
    path = f"{root}/{CONFIG}/{batch_id}.json"
    if not exists(spark, path):
        now = read_config(spark)
        write_json(spark, path, {"schema": now.schema.jsonValue(), "rows": [list(r) for r in now.collect()]})  # a row per route
        for name in children(spark, f"{root}/{CONFIG}"):
            if name.removesuffix(".json").isdigit() and int(name.removesuffix(".json")) < batch_id - KEPT_CONFIGS:
                delete(spark, f"{root}/{CONFIG}/{name}")
    stored = read_json(spark, path)
    return spark.createDataFrame([tuple(r) for r in stored["rows"]], T.StructType.fromJson(stored["schema"]))


def upsert_dims(
    changes: DataFrame,
    read_config,
    root: str,
    checkpoint: str,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Keep the dimension tables up to date.

    ``read_config(spark)`` is called for every new micro-batch, so a changed route takes effect with the next batch, and rows never wait
    for their configuration. What it returns is stored before the batch runs: a batch that runs again is routed as before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, pinned_config(batch.sparkSession, read_config, root, batch_id), batch_id, root)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, trigger).start()


def read_dim_table(spark: SparkSession, root: str, sink_table: str, columns: Iterable[str]) -> DataFrame:
    """The current rows of one dimension table, every column as text. Only the parts of this table are read.

    Enrichment reads this each time it runs, so there is no cache that could be out of date.
    """
    newest = _table(root).read(spark, splits=[sink_table])
    return newest.select(*[F.col("data")[c].alias(c) for c in columns])
