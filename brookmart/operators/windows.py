"""Tumbling event-time windows and row measures."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from brookmart.functions.dates import DATETIME, now_millis
from brookmart.operators.columns import as_col


def measures(df: DataFrame, dims: Mapping[str, str | Column], **values: int | str | Column) -> DataFrame:
    """One narrow row per input row: the dimensions, then the measures (constants or columns)."""
    def value(v):
        return F.lit(v).cast("long") if isinstance(v, int) else as_col(v)

    return df.select(*[as_col(c).alias(n) for n, c in dims.items()], *[value(v).alias(n) for n, v in values.items()])


def tumble(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Iterable[str] = (),
    aggs: Mapping[str, Column] | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Aggregates per window and keys, with the window bounds as text columns ``stt`` and ``edt``.

    Windows are aligned to the epoch. Aggregation is partial before the shuffle, also without keys.
    Streams need a watermark, here or upstream; late rows are dropped.
    """
    if df.isStreaming and watermark:
        df = df.withWatermark(ts, watermark)
    keys = list(keys)
    grouped = df.groupBy(F.window(F.col(ts), size).alias("_w"), *keys)
    out = grouped.agg(*[c.alias(n) for n, c in aggs.items()])
    return _with_bounds(out, keys + list(aggs))


def tumble_distinct(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Iterable[str],
    distinct: str,
    count_as: str,
    sums: Mapping[str, Column] | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Like ``tumble``, counting the distinct values of one column next to plain sums.

    Two grouping levels, (window, keys, value) and then (window, keys): no group holds a set of
    values, a hot key is spread over its values, and the same plan runs on streams.
    """
    if df.isStreaming and watermark:
        df = df.withWatermark(ts, watermark)
    keys, sums = list(keys), dict(sums or {})
    inner = df.groupBy(F.window(F.col(ts), size).alias("_w"), *keys, F.col(distinct).alias("_v")).agg(
        F.count("*").alias("_rows"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    if df.isStreaming:
        inner = inner.withColumn("_t", F.window_time("_w")).drop("_w")
        outer = inner.groupBy(F.window("_t", size).alias("_w"), *keys)
    else:
        outer = inner.groupBy("_w", *keys)
    out = outer.agg(F.count("_v").alias(count_as), *[F.sum(n).alias(n) for n in sums])
    return _with_bounds(out, [*keys, count_as, *sums])


def emitted(df: DataFrame) -> DataFrame:
    """Add ``ts``, the emission time in epoch milliseconds, to the results of a live job."""
    return df.withColumn("ts", now_millis())


def _with_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(
        F.date_format("_w.start", DATETIME).alias("stt"), F.date_format("_w.end", DATETIME).alias("edt"), *columns
    )
