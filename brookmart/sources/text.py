"""Text records: one column ``value``, from Kafka or from files, as stream or batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def kafka_source(servers: str, topics: str | list[str], group: str, **options: str) -> dict[str, str]:
    """Options of a Kafka stream that starts at the newest records. Offsets live in the checkpoint.

    ``options`` adds or replaces, for example ``maxOffsetsPerTrigger`` to bound a micro-batch.
    """
    if not isinstance(topics, str):
        topics = ",".join(topics)
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "groupIdPrefix": group,
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        **options,
    }


def read_text_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """A stream of text records. A record without a value stays a null value."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if fmt == "text":
        return reader.load(path)
    return reader.schema(T.StructType([T.StructField("value", T.StringType())])).load(path)


def read_text(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    return spark.read.format(fmt).schema("value string").load(path)


def read_delimited(df: DataFrame, schema: T.StructType, sep: str = ",", column: str = "value") -> DataFrame:
    """Lines of separated values to typed columns; a value that does not fit its type becomes null."""
    parts = F.split(F.col(column), f"\\Q{sep}\\E")
    return df.select(*[
        F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)
    ])
