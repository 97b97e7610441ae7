"""JSON text to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_BAD = "_corrupt_record"


def parse_or_quarantine(df: DataFrame, schema: T.StructType, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rows whose text is not a record of ``schema``). Null texts go to neither.

    Both results read the same input; inside ``foreachBatch`` persist the batch first.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    rest = [c for c in df.columns if c != column]
    # A generator is evaluated once per row; filters on its output are not pushed below it, where
    # they would parse the text a second time.
    parsed = df.where(F.col(column).isNotNull()).select(
        *rest, F.col(column).alias("_text"), F.inline(F.array(F.from_json(column, with_bad, options)))
    )
    good = parsed.where(F.col(_BAD).isNull()).select(*rest, *[f.name for f in schema.fields])
    bad = parsed.where(F.col(_BAD).isNotNull()).select(*rest, F.col("_text").alias(column))
    return good, bad


def parse_or_drop(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    return parse_or_quarantine(df, schema, column)[0]


def parse_or_fail(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parsed rows; a malformed text fails the job."""
    rest = [c for c in df.columns if c != column]
    parsed = df.where(F.col(column).isNotNull()).withColumn("_r", F.from_json(column, schema, {"mode": "FAILFAST"}))
    return parsed.select(*rest, *[f"_r.{f.name}" for f in schema.fields])


def to_json_value(df: DataFrame, column: str = "value") -> DataFrame:
    """The whole row as one JSON text, ready for a text or Kafka sink."""
    return df.select(F.to_json(F.struct("*")).alias(column))
