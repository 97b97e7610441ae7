"""Column naming."""

from __future__ import annotations

from pyspark.sql import DataFrame


def camel_case(name: str) -> str:
    """order_unique_user_count -> orderUniqueUserCount."""
    head, *rest = name.lower().split("_")
    return head + "".join(w.capitalize() for w in rest)


def camel_case_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: camel_case(c) for c in df.columns})
