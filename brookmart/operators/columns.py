"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [as_col(c) for c in cs]


def assign(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Set a column, or a field of a struct column when ``path`` has a dot."""
    head, _, rest = path.partition(".")
    if rest:
        value = F.col(head).withField(rest, value)
    return df.withColumn(head, value)


def amount(text) -> Column:
    """Money text -> DECIMAL(18,2). Decimal sums do not depend on the order of addition."""
    return as_col(text).try_cast("decimal(18,2)")
