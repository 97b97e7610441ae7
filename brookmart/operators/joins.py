"""Joins: dimension lookups, wide fact joins, interval joins, and a split join for hot keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from brookmart.functions.dates import seconds_of
from brookmart.operators.columns import as_col

BROADCAST_LIMIT = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of the optimized plan (file sizes, scaled to the read columns).

    Filters and aggregates keep their input's size and joins multiply, so it errs to the large side.
    """
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size allows it, else ``df`` as it is.

    Without the hint Spark shuffles both sides, and adaptive execution splits skewed partitions.
    """
    if df.isStreaming or estimated_bytes(df) > limit:
        return df
    return F.broadcast(df)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | Column,
    dim_key: str,
    outputs: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Add ``outputs`` (new name -> column of ``dim``) for the dimension row whose key equals ``key``.

    On a stream this is a stream-static join, and the dimension is read anew by every micro-batch.
    Null keys never match; ``how='left'`` keeps unmatched rows with nulls.
    """
    side = dim.select(F.col(dim_key).alias("_dk"), *[F.col(src).alias(f"_d_{out}") for out, src in outputs.items()])
    joined = df.join(small_side(side), as_col(key) == F.col("_dk"), how)
    replaced = [c for c in df.columns if c not in outputs]
    return joined.select(*[df[c] for c in replaced], *[F.col(f"_d_{out}").alias(out) for out in outputs])


def enrich(df: DataFrame, dim: DataFrame, key: str | Column, outputs: Mapping[str, str], dim_key: str = "id") -> DataFrame:
    """Dimension enrichment: a left lookup, so that an unknown key leaves the row in place."""
    return lookup(df, dim, key, dim_key, outputs, how="left")


def lookup_as_of(
    df: DataFrame,
    history: DataFrame,
    key: str | Column,
    ts: str | Column,
    dim_key: str,
    valid_from: str,
    outputs: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """``lookup`` in the version of a dimension row that held at the time ``ts`` of each row, so that a replay gives the same names.

    ``history`` has a row per key and version, which holds from ``valid_from`` (of the type of ``ts``) until the next one of its key. Of versions
    with equal ``valid_from`` the one with the greatest output values counts. Before a key's first version, and for null keys and
    times, nothing matches. A key's versions travel as one row with a sorted array, so a row of ``df`` meets one row, however many
    versions there are.
    """
    version = F.struct(F.col(valid_from).alias("_from"), *[F.col(src).alias(out) for out, src in outputs.items()])
    side = history.where(F.col(valid_from).isNotNull()).groupBy(F.col(dim_key).alias("_dk")).agg(F.sort_array(F.collect_set(version)).alias("_versions"))
    joined = df.join(small_side(side), as_col(key) == F.col("_dk"), how).withColumn("_at", as_col(ts))
    held = F.filter("_versions", lambda v: v["_from"] <= F.col("_at"))
    joined = joined.withColumn("_v", F.try_element_at(held, F.lit(-1)))
    if how == "inner":
        joined = joined.where(F.col("_v").isNotNull())
    replaced = [c for c in df.columns if c not in outputs]
    return joined.select(*replaced, *[F.col(f"_v.{out}").alias(out) for out in outputs])


@dataclass
class Step:
    """One link of an enrichment chain."""

    dim: DataFrame
    key: str
    outputs: Mapping[str, str] = field(default_factory=dict)
    dim_key: str = "id"


def enrich_chain(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Snowflake enrichment; a step may use keys that an earlier step added."""
    for s in steps:
        df = enrich(df, s.dim, s.key, s.outputs, s.dim_key)
    return df


def wide_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    left_time: str | None = None,
    right_time: str | None = None,
    horizon: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Equi-join of two fact tables on ``on`` (left column -> right column, which is dropped).

    On streams an inner join without ``horizon`` is complete: both sides stay in state, and a partner may
    come at any time. With ``horizon`` both sides get a watermark, a pair must lie within it in event
    time, and later partners are lost, so that the state is bounded. A left join needs a horizon; it
    emits the null side once, after it. ``live.order_lines`` is the left join without one.
    """
    right_keys = {r: f"_rk_{r}" for r in on.values()}
    r = right.withColumnsRenamed(right_keys)
    l = left
    cond = None
    for lk, rk in on.items():
        c = F.col(lk) == F.col(right_keys[rk])
        cond = c if cond is None else cond & c
    drop = list(right_keys.values())
    if left.isStreaming and right.isStreaming:
        if horizon and not (left_time and right_time):
            raise ValueError("a horizon needs left_time and right_time")
        if not horizon and how != "inner":
            raise ValueError("an outer stream-stream join needs a horizon")
        if horizon:
            if watermark:
                l = l.withWatermark(left_time, watermark)
                r = r.withWatermark(right_time, watermark)
            span = F.expr(f"INTERVAL {horizon}")
            cond &= (F.col(right_time) >= F.col(left_time) - span) & (F.col(right_time) <= F.col(left_time) + span)
        if right_time:
            drop.append(right_time)
    elif right_time and right_time in right.columns:
        drop.append(right_time)
    return l.join(r, cond, how).drop(*drop)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    lower: str,
    upper: str,
    watermark: str | None = None,
    spans_per_bucket: int = 4,
) -> DataFrame:
    """Pairs of equal ``key`` whose right time lies in [left + lower, left + upper], both ends included.

    ``key`` is a column of both sides and kept once; other columns must differ in name. Time is cut
    into buckets a few spans wide and the join runs on (key, bucket): a key holding a large share of
    the rows is spread over its buckets, and only rows near in time meet.
    """
    lo, hi = round(seconds_of(lower) * 1_000_000), round(seconds_of(upper) * 1_000_000)
    if lo > hi:
        raise ValueError("lower bound above upper bound")
    width = max(1, (hi - lo) * spans_per_bucket)
    if left.isStreaming and right.isStreaming and watermark:
        left, right = left.withWatermark(left_time, watermark), right.withWatermark(right_time, watermark)

    def bucket(c: Column) -> Column:
        return F.floor(c / F.lit(width)).cast("long")

    lt = F.unix_micros(F.col(left_time))
    l = left.withColumn("_bucket", F.explode(F.sequence(bucket(lt + lo), bucket(lt + hi))))
    r = right.withColumn("_r_bucket", bucket(F.unix_micros(F.col(right_time)))).withColumnRenamed(key, "_r_key")
    cond = (
        (F.col(key) == F.col("_r_key"))
        & (F.col("_bucket") == F.col("_r_bucket"))
        & (F.col(right_time) >= F.col(left_time) + F.expr(f"INTERVAL {lower}"))
        & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {upper}"))
    )
    return l.join(r, cond, "inner").drop("_r_key", "_bucket", "_r_bucket")
