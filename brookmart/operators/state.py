"""Per-key logic over time: first rows, latest versions, new visitors, bounces, returning users.

Everything here is the batch form, also used per micro-batch by ``brookmart.streaming``. No form
sorts all rows of one key in one task: ``row_number() = 1`` is cut to one row per key before the
shuffle, and look-ahead runs inside (key, time bucket).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from brookmart.functions.dates import seconds_of
from brookmart.operators.columns import as_col, as_cols, assign
from brookmart.operators.joins import small_side


def first_by(df: DataFrame, keys, order) -> DataFrame:
    """The first row per ``keys`` in the given order, which should be total.

    The filter on row_number becomes a group limit in every map task, so at most one row per key and
    task is shuffled.
    """
    w = Window.partitionBy(*as_cols(keys)).orderBy(*as_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_per_day(df: DataFrame, key: str, ts: str, tiebreak: Iterable = (), salts: int = 8) -> DataFrame:
    """The first row of each key on each day. On streams: the first to arrive (see streaming.dedup)."""
    if df.isStreaming:
        from brookmart.streaming.dedup import first_per_day_stream

        return first_per_day_stream(df, key, ts, salts=salts)
    return first_by(df, [as_col(key), F.to_date(ts)], [ts, *tiebreak])


def first_ever(df: DataFrame, key: str, ts: str, tiebreak: Iterable = ()) -> DataFrame:
    """The first row of each key. Streams keep a table of seen keys instead (streaming.ledger)."""
    return first_by(df, key, [ts, *tiebreak])


def latest_by_key(df: DataFrame, keys, newest: Iterable) -> DataFrame:
    """The newest version per key, by the columns ``newest`` compared from left to right."""
    return first_by(df, keys, [as_col(c).desc_nulls_last() for c in newest])


def first_state(df: DataFrame, key: str, ts: str, flag: str, tiebreak: Iterable = ()) -> DataFrame:
    """(_key, first_day): the day a device counts as new. Pre-aggregated before the shuffle.

    It is the day of the first row if that row says it is new, and the day before it otherwise.
    """
    first = F.min(F.struct(F.col(ts).alias("ts"), *tiebreak, as_col(flag).alias("flag")))
    per_key = (
        df.where(as_col(key).isNotNull())
        .groupBy(as_col(key).alias("_key"))
        .agg(first.alias("_f"))
    )
    new = F.to_date("_f.ts")
    day = F.when(F.col("_f.flag") == "1", new).otherwise(F.to_date(F.col("_f.ts") - F.expr("INTERVAL 24 HOURS")))
    return per_key.select("_key", day.alias("first_day"))


def repair_is_new(
    df: DataFrame,
    key: str,
    ts: str,
    flag: str,
    tiebreak: Iterable = (),
    state: DataFrame | None = None,
) -> DataFrame:
    """Set a device's 'new' flag to '0' on every day but its first. ``flag`` may be a struct field.

    ``df`` is read twice: for the state, and for the join. The state has one row per device, so a hot
    device's rows are split by adaptive execution. Rows without the flag cannot change; they get keys
    that match no device and are spread evenly. ``state`` (_key, first_day) replaces the state computed
    from ``df`` itself.
    """
    if state is None:
        state = first_state(df, key, ts, flag, tiebreak)
    columns = df.columns
    is_set = as_col(flag) == "1"
    elsewhere = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(key, ts), F.lit(65_536)))
    marked = df.withColumn("_k", F.when(is_set & as_col(key).isNotNull(), as_col(key)).otherwise(elsewhere))
    joined = marked.join(state, F.col("_k") == F.col("_key"), "left")
    stale = F.coalesce(F.to_date(ts) != F.col("first_day"), F.lit(False))
    return assign(joined, flag, F.when(stale, F.lit("0")).otherwise(as_col(flag))).select(*columns)


def bounces(
    df: DataFrame,
    key: str,
    ts: str,
    last_page: str,
    within: str = "10 seconds",
    tiebreak: Iterable = (),
    bucket: str | None = None,
) -> DataFrame:
    """Session starts (no last page) with no further page of the session inside ``within``.

    A start bounces if the key's next row is itself a start, comes ``within`` or more later, or does
    not exist. A row only needs to see ``within`` ahead, so rows are grouped by (key, time bucket),
    and rows early in a bucket are repeated in the one before as look-ahead only.
    """
    if df.isStreaming:
        from brookmart.streaming.bounces import bounces_stream

        return bounces_stream(df, key, ts, last_page, within, bucket, tiebreak)
    limit = round(seconds_of(within) * 1_000_000)
    width = round(seconds_of(bucket) * 1_000_000) if bucket else 64 * limit
    if width < limit:
        raise ValueError("the bucket must be at least as wide as the time limit")
    t = F.unix_micros(F.col(ts))
    b = F.floor(t / F.lit(width)).cast("long")
    own = F.struct(b.alias("b"), F.lit(True).alias("own"))
    ahead = F.struct((b - 1).alias("b"), F.lit(False).alias("own"))
    places = F.when(t - b * width < limit, F.array(own, ahead)).otherwise(F.array(own))
    is_start = as_col(last_page).isNull()
    order = [f"_o{i}" for i, _ in enumerate(tiebreak)]
    placed = df.withColumn("_place", F.explode(places))
    # Only a start in its own bucket can come out; of all other rows just the order is needed.
    rows = placed.select(
        as_col(key).alias("_k"), t.alias("_t"), is_start.alias("_start"), "_place",
        *[as_col(c).alias(n) for c, n in zip(tiebreak, order)],
        F.when(is_start & F.col("_place.own"), F.struct(*df.columns)).alias("_row"),
    )
    w = Window.partitionBy("_k", "_place.b").orderBy("_t", *order)
    seen = rows.withColumns({"_next": F.lead("_t").over(w), "_next_start": F.lead("_start").over(w)})
    bounced = F.col("_next").isNull() | (F.col("_next") - F.col("_t") >= limit) | F.col("_next_start")
    return seen.where(F.col("_row").isNotNull() & bounced).select("_row.*")


def of_keys(known: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a large ``known`` table whose keys occur in ``rows``.

    When the keys are few they are broadcast, and ``known`` is filtered where it is read.
    """
    return known.join(small_side(rows.select(*keys).distinct()), keys, "left_semi")


def daily_first_times(df: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, day, ts): each key's first time on each day, pre-aggregated before the shuffle."""
    return df.groupBy(as_col(key).alias(_name(key)), F.to_date(ts).alias("day")).agg(F.min(ts).alias(ts))


def returning_users(df: DataFrame, key: str, ts: str, gap_days: int = 7, known: DataFrame | None = None) -> DataFrame:
    """One row per key and day: (key, day, ts, uu_ct = 1, back_ct = 1 if away for over ``gap_days``).

    ``known`` (key, day) holds days seen in earlier batches; those days are not emitted again. The
    window runs over days, so a key has at most one row per calendar day in it.
    """
    name = _name(key)
    days = daily_first_times(df, key, ts).where(F.col(name).isNotNull())
    if known is not None:
        past = of_keys(known.select(name, "day"), days, [name])
        fresh = days.join(past, [name, "day"], "left_anti")
        days = fresh.unionByName(past.withColumn(ts, F.lit(None).cast("timestamp")))
    w = Window.partitionBy(name).orderBy("day")
    away = F.datediff("day", F.lag("day").over(w))
    out = days.withColumn("back_ct", F.when(away > gap_days, 1).otherwise(0).cast("long"))
    return out.where(F.col(ts).isNotNull()).withColumn("uu_ct", F.lit(1).cast("long"))


def _name(key: str | Column) -> str:
    return key.rpartition(".")[2] if isinstance(key, str) else "key"
