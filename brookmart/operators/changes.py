"""Selecting rows from a stream of database change events."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def change_rows(table: str, types: Iterable[str] | None = None, database: str | None = None) -> Column:
    """The predicate that routes change events by database, table and type."""
    cond = F.col("table") == table
    if types is not None:
        cond &= F.col("type").isin(*types)
    if database is not None:
        cond &= F.col("database") == database
    return cond


def _project(df: DataFrame, columns: Iterable[str], keep: Iterable[str]) -> DataFrame:
    return df.selectExpr(*[f"data['{c}'] AS `{c}`" for c in columns], *keep)


def cdc_select(
    df: DataFrame,
    table: str,
    columns: Iterable[str],
    types: Iterable[str] | None = ("insert",),
    database: str | None = None,
    keep: Iterable[str] = ("ts",),
) -> DataFrame:
    """Rows of one table and the given change types, with ``columns`` taken out of the data map."""
    return _project(df.where(change_rows(table, types, database)), columns, keep)


def transition(column: str, to_code: str | None) -> Column:
    """An update that changed ``column`` (to ``to_code`` when given)."""
    cond = (F.col("type") == "update") & F.col("old")[column].isNotNull()
    if to_code is not None:
        cond &= F.col("data")[column] == to_code
    return cond


def cdc_transition(
    df: DataFrame,
    table: str,
    column: str,
    to_code: str | None,
    columns: Iterable[str],
    database: str | None = None,
    keep: Iterable[str] = ("ts",),
) -> DataFrame:
    """Updates of one table whose ``column`` changed to ``to_code``."""
    rows = df.where(change_rows(table, None, database) & transition(column, to_code))
    return _project(rows, columns, keep)


def cdc_increase(
    df: DataFrame,
    table: str,
    column: str,
    columns: Iterable[str],
    database: str | None = None,
    keep: Iterable[str] = ("ts",),
) -> DataFrame:
    """Inserts, plus updates that raised the integer ``column``; it then holds the rise only."""
    new = F.col("data")[column].try_cast("int")
    old = F.col("old")[column].try_cast("int")
    inserted = F.col("type") == "insert"
    raised = (F.col("type") == "update") & (new > old)
    value = F.when(inserted, F.col("data")[column]).otherwise((new - old).cast("string"))
    rows = df.where(change_rows(table, None, database) & (inserted | raised))
    return rows.select(*[(value if c == column else F.col("data")[c]).alias(c) for c in columns], *keep)
