"""Cart, orders and payments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from brookmart.functions.dates import event_time, parse_time
from brookmart.operators import (
    Step, amount, cdc_increase, cdc_select, cdc_transition, enrich, enrich_chain, first_by, first_per_day,
    latest_by_key, lookup, lookup_as_of, of_keys, tumble, tumble_distinct, wide_join,
)
from brookmart.schemas import ORDER_CANCELLED, PAYMENT_DONE, TABLE_COLUMNS


def timed(df: DataFrame, name: str) -> DataFrame:
    """On a stream, the change time as event time ``name``, for bounded joins."""
    return df.withColumn(name, event_time("ts")) if df.isStreaming else df


def cart_adds(changes: DataFrame, codes: DataFrame, database: str | None = None) -> DataFrame:
    """Cart additions; of a raised quantity the rise only."""
    rows = cdc_increase(changes, "cart_info", "sku_num", TABLE_COLUMNS["cart_info"], database)
    return lookup(rows, codes, "source_type", "dic_code", {"source_name": "dic_name"})


def cart_adds_as_of(changes: DataFrame, history: DataFrame, database: str | None = None) -> DataFrame:
    """Cart additions with the source name that held when they were made; ``history`` has dic_code, dic_name and valid_from (milliseconds)."""
    rows = cdc_increase(changes, "cart_info", "sku_num", TABLE_COLUMNS["cart_info"], database)
    return lookup_as_of(rows, history, "source_type", "ts", "dic_code", "valid_from", {"source_name": "dic_name"})


def cart_users(carts: DataFrame, tiebreak=()) -> DataFrame:
    """Each user's first addition of the day: (user_id, et). Stream: live.cart_users."""
    return first_per_day(with_cart_time(carts), "user_id", "et", tiebreak).select("user_id", "et")


def with_cart_time(carts: DataFrame) -> DataFrame:
    return carts.withColumn("et", F.coalesce(parse_time("operate_time"), parse_time("create_time")))


def cart_uniques(users: DataFrame, size: str = "10 seconds", watermark: str = "2 seconds") -> DataFrame:
    """Daily unique users adding to the cart per window, from ``cart_users``."""
    return tumble(users, "et", size, [], {"cart_add_uu_ct": F.count("*")}, watermark)


def order_wide(
    changes: DataFrame, codes: DataFrame, horizon: str | None = None, watermark: str = "5 seconds",
    database: str | None = None, orders_first: bool = False,
    lines_by_order: bool = False, among: DataFrame | None = None, extras: DataFrame | None = None,
) -> DataFrame:
    """Order lines with their order, activity, coupon and source name; one row per order change.

    The narrow line-level joins come first, so the wide order columns are shuffled once. With ``orders_first`` (tables only) they come last: for
    plans that go on by line and take few columns of the order, as rows then lie by line already. With ``lines_by_order`` (tables only) the lines are shuffled
    by their order alone and their activities and coupons come to them there: less is shuffled where most columns are taken, at the cost of more sorting of pairs.
    ``among`` (order_id, sku_id; with ``lines_by_order``) leaves out lines of other orders and SKUs, for plans that join on these.
    ``extras`` (likewise) are the rows of ``line_extras``, where these have been written before.
    ``horizon`` and ``watermark`` apply to streams, where the left joins need a horizon; ``live.order_wide``
    is the job without one.
    """
    detail = timed(cdc_select(changes, "order_detail", TABLE_COLUMNS["order_detail"], database=database), "et")
    info = cdc_select(
        changes, "order_info", [c for c in TABLE_COLUMNS["order_info"] if c != "create_time"],
        ("insert", "update"), database, keep=("ts", "type", "old"),
    )
    info = timed(info, "info_et").withColumnRenamed("ts", "change_ts")
    activity = timed(_activities(changes, database), "activity_et").drop("ts")
    coupon = timed(_coupons(changes, database), "coupon_et").drop("ts")
    if changes.isStreaming and horizon:
        detail, info = detail.withWatermark("et", watermark), info.withWatermark("info_et", watermark)
        activity, coupon = activity.withWatermark("activity_et", watermark), coupon.withWatermark("coupon_et", watermark)
    if orders_first:
        detail = lookup(wide_join(detail, info, {"order_id": "id"}), codes, "source_type", "dic_code", {"source_name": "dic_name"})
    if lines_by_order:
        lines = by_order(detail)
        if among is not None:
            # Not a semi join: Spark would make it before the lines are laid by order, and shuffle them twice.
            wanted = by_order(among.toDF("_order", "_sku"), "_order").distinct()
            lines = wide_join(lines, wanted, {"order_id": "_order", "sku_id": "_sku"})
        if extras is None:
            extras = _extras(detail, {"activity": activity, "coupon": coupon})
        lines = _with_extras(lines, extras)
    else:
        lines = wide_join(detail, activity, {"id": "order_detail_id"}, "left", "et", "activity_et", horizon)
        lines = wide_join(lines, coupon, {"id": "order_detail_id"}, "left", "et", "coupon_et", horizon)
    if orders_first:
        return lines
    wide = wide_join(lines, info, {"order_id": "id"}, "inner", "et", "info_et", horizon)
    return lookup(wide, codes, "source_type", "dic_code", {"source_name": "dic_name"})


def by_order(rows: DataFrame, order: str = "order_id") -> DataFrame:
    """Rows of a table that lie by order: joins on the order, and on it with other columns, shuffle neither of two such sides again."""
    return rows.where(F.col(order).isNotNull()).repartition(order)


def _activities(changes: DataFrame, database: str | None) -> DataFrame:
    return cdc_select(changes, "order_detail_activity", ["order_detail_id", "activity_id", "activity_rule_id"], database=database)


def _coupons(changes: DataFrame, database: str | None) -> DataFrame:
    return cdc_select(changes, "order_detail_coupon", ["order_detail_id", "coupon_id", "coupon_use_id"], database=database)


def line_extras(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Activities and coupons by id and order of their lines, for ``order_wide``."""
    pairs = cdc_select(changes, "order_detail", ["id", "order_id"], database=database)
    return _extras(pairs, {"activity": _activities(changes, database).drop("ts"), "coupon": _coupons(changes, database).drop("ts")})


def _extras(pairs: DataFrame, extras: dict[str, DataFrame]) -> DataFrame:
    """What ``extras`` have for the lines of which ``pairs`` has id and order. Only these pairs are shuffled by line."""
    found = pairs.select("id", "order_id").repartition("id").distinct()
    some = F.lit(False)
    for name, rows in extras.items():
        found = wide_join(found, rows.withColumn(f"_{name}", F.lit(True)), {"id": "order_detail_id"}, "left")
        some |= F.col(f"_{name}").isNotNull()
    return found.where(some).drop(*[f"_{name}" for name in extras])


def _with_extras(lines: DataFrame, extras: DataFrame) -> DataFrame:
    """Lines that lie by order, left-joined to their ``extras``, which are laid by order, too."""
    found = by_order(extras).withColumnsRenamed({"id": "_id", "order_id": "_order"})
    return lines.join(found, (F.col("order_id") == F.col("_order")) & (F.col("id") == F.col("_id")), "left").drop("_id", "_order")


def orders_placed(wide: DataFrame) -> DataFrame:
    return wide.where(F.col("type") == "insert").drop("type", "old")


def orders_cancelled(wide: DataFrame) -> DataFrame:
    cancelled = (
        (F.col("type") == "update")
        & (F.col("order_status") == ORDER_CANCELLED)
        & F.col("old")["order_status"].isNotNull()
    )
    return wide.where(cancelled).drop("type", "old")


# Columns of the payment that an order line also has get a prefix.
_PAYMENT_NAMES = {
    "out_trade_no": "payment_out_trade_no", "user_id": "payment_user_id",
    "total_amount": "payment_total_amount", "create_time": "payment_create_time", "ts": "payment_ts",
}


def payments_succeeded(
    changes: DataFrame, placed: DataFrame, codes: DataFrame, horizon: str | None = None, watermark: str = "5 seconds",
    database: str | None = None,
) -> DataFrame:
    """Successful payments, one row per paid order line, with the names of status and type.

    On streams ``placed`` carries ``et``; it is dropped here, the next job takes its own.
    """
    paid = cdc_transition(
        changes, "payment_info", "payment_status", PAYMENT_DONE, TABLE_COLUMNS["payment_info"], database
    )
    paid = timed(paid, "payment_et").withColumnsRenamed({**_PAYMENT_NAMES, "order_id": "paid_order_id"})
    rows = wide_join(
        placed, paid, {"order_id": "paid_order_id"}, "inner", "et", "payment_et", horizon, watermark
    )
    rows = lookup(rows, codes, "payment_status", "dic_code", {"payment_status_name": "dic_name"})
    return lookup(rows, codes, "payment_type", "dic_code", {"payment_type_name": "dic_name"})


def user_firsts(df: DataFrame, key: str, ts: str, tiebreak=(), known: DataFrame | None = None) -> DataFrame:
    """One row per user and day: (key, day, ts, day_ct = 1, new_ct = 1 on the user's first day ever).

    ``known`` (key, day) holds days of earlier batches; they are not emitted again. The second step
    runs over a user's days, of which there is at most one per calendar day.
    Stream: live.user_firsts.
    """
    days = first_per_day(df.where(F.col(key).isNotNull()), key, ts, tiebreak)
    days = days.select(key, F.to_date(ts).alias("day"), ts)
    if known is not None:
        known = of_keys(known.select(key, "day"), days, [key])
        days = days.join(known, [key, "day"], "left_anti")
    order = Window.partitionBy(key).orderBy(ts)
    new = F.row_number().over(order) == 1
    if known is not None:
        past = known.select(key).distinct().withColumn("_past", F.lit(True))
        days = days.join(past, key, "left")
        new = new & F.col("_past").isNull()
    return days.withColumn("_new", new).select(
        key, "day", ts, F.lit(1).cast("long").alias("day_ct"), F.col("_new").cast("long").alias("new_ct")
    )


def order_users(firsts: DataFrame, ts: str = "et", size: str = "2 seconds", watermark: str = "2 seconds") -> DataFrame:
    """Daily unique and first-ever ordering users per window, from ``user_firsts``."""
    aggs = {"order_unique_user_count": F.sum("day_ct"), "order_new_user_count": F.sum("new_ct")}
    return tumble(firsts, ts, size, [], aggs, watermark)


def payment_users(firsts: DataFrame, ts: str = "et", size: str = "2 seconds", watermark: str = "2 seconds") -> DataFrame:
    """Daily unique and first-ever paying users per window, from ``user_firsts``."""
    aggs = {"payment_suc_unique_user_count": F.sum("day_ct"), "payment_suc_new_user_count": F.sum("new_ct")}
    return tumble(firsts, ts, size, [], aggs, watermark)


# The newest version comes first; versions of equal time are told apart by their columns.
LINE_VERSION = [
    "change_ts", "ts", "sku_id", "order_price", "sku_num", "split_total_amount", "split_activity_amount",
    "split_coupon_amount", "activity_id", "coupon_id",
]


def newest_lines(placed: DataFrame) -> DataFrame:
    """The newest version per order line. Stream: live.newest_lines."""
    return latest_by_key(placed, "id", LINE_VERSION)


def sku_chain(dims: dict[str, DataFrame]) -> list[Step]:
    """SKU -> SPU, category 3 -> 2 -> 1, trademark. ``dims`` maps table name to its rows."""
    return [
        Step(dims["sku_info"], "sku_id",
             {"sku_name": "sku_name", "spu_id": "spu_id", "category3_id": "category3_id", "trademark_id": "tm_id"}),
        Step(dims["spu_info"], "spu_id", {"spu_name": "spu_name"}),
        *category_chain(dims),
    ]


def category_chain(dims: dict[str, DataFrame]) -> list[Step]:
    return [
        Step(dims["base_category3"], "category3_id", {"category3_name": "name", "category2_id": "category2_id"}),
        Step(dims["base_category2"], "category2_id", {"category2_name": "name", "category1_id": "category1_id"}),
        Step(dims["base_category1"], "category1_id", {"category1_name": "name"}),
        Step(dims["base_trademark"], "trademark_id", {"trademark_name": "tm_name"}),
    ]


_SKU_ID_COLUMNS = [
    "stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id",
    "category2_name", "category3_id", "category3_name", "sku_id", "sku_name", "spu_id", "spu_name",
]
_SKU_AMOUNTS = ["original_amount", "activity_amount", "coupon_amount", "order_amount"]


def _line_amounts() -> dict:
    zero = F.lit(0).cast("decimal(18,2)")
    return {
        "original_amount": (amount("order_price") * F.col("sku_num").try_cast("decimal(10,0)")).cast("decimal(18,2)"),
        "activity_amount": F.coalesce(amount("split_activity_amount"), zero),
        "coupon_amount": F.coalesce(amount("split_coupon_amount"), zero),
        "order_amount": F.coalesce(amount("split_total_amount"), zero),
    }


def _sku_result(windowed: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    named = enrich_chain(windowed, sku_chain(dims))
    return named.select(*_SKU_ID_COLUMNS, "order_count", *[F.col(a).cast("double").alias(a) for a in _SKU_AMOUNTS])


def sku_orders(
    lines: DataFrame, dims: dict[str, DataFrame], size: str = "10 seconds", watermark: str = "2 seconds"
) -> DataFrame:
    """Orders and amounts per SKU and window, with the SKU's dimensions, from ``newest_lines``.

    Enrichment comes after aggregation, on result rows only.
    """
    rows = lines.select(parse_time("create_time").alias("et"), "sku_id", "order_id", *[
        c.alias(n) for n, c in _line_amounts().items()
    ])
    sums = {a: F.col(a) for a in _SKU_AMOUNTS}
    return _sku_result(tumble_distinct(rows, "et", size, ["sku_id"], "order_id", "order_count", sums, watermark), dims)


def earliest_lines(lines: DataFrame, horizon: str, watermark: str = "2 seconds") -> DataFrame:
    """On a stream, the earliest line per order and SKU, let out once: when the watermark shows that no earlier one can come.

    Lines of an order and SKU that follow within ``horizon`` of each other are one session, whose state is the earliest line
    and is dropped when the session has ended. A line more than ``horizon`` after the others begins a new one. Write the result out
    and give the next job a watermark of its own, which covers ``horizon``.
    """
    timed_lines = lines.withColumn("_et", parse_time("create_time")).withWatermark("_et", watermark)
    first = F.min(F.struct("_et", "id", *[c for c in lines.columns if c != "id"])).alias("_first")
    sessions = timed_lines.groupBy(F.session_window("_et", horizon), F.col("order_id").alias("_order"), F.col("sku_id").alias("_sku")).agg(first)
    return sessions.select(*[F.col(f"_first.{c}").alias(c) for c in lines.columns])


def sku_orders_dedup(
    lines: DataFrame, dims: dict[str, DataFrame], size: str = "10 seconds", watermark: str = "2 seconds"
) -> DataFrame:
    """Variant that keeps one line per order and SKU, the earliest, and counts lines.

    Amounts of the other lines of the same order and SKU are left out by design. A stream takes the rows that
    ``earliest_lines`` has let out.
    """
    rows = lines.select(parse_time("create_time").alias("et"), "id", "sku_id", "order_id", *[
        c.alias(n) for n, c in _line_amounts().items()
    ])
    one = rows if rows.isStreaming else first_by(rows, ["order_id", "sku_id"], ["et", "id"])
    aggs = {"order_count": F.count("*"), **{a: F.sum(a) for a in _SKU_AMOUNTS}}
    return _sku_result(tumble(one, "et", size, ["sku_id"], aggs, watermark), dims)


def province_orders(
    changes: DataFrame, provinces: DataFrame, size: str = "10 seconds", watermark: str = "2 seconds"
) -> DataFrame:
    """Orders and amount per province and window."""
    rows = cdc_select(changes, "order_info", ["province_id", "total_amount"])
    rows = rows.select(event_time("ts").alias("et"), "province_id", amount("total_amount").alias("total_amount"))
    aggs = {"order_count": F.count("*"), "order_amount": F.sum("total_amount")}
    out = enrich(tumble(rows, "et", size, ["province_id"], aggs, watermark), provinces, "province_id", {"province_name": "name"})
    return out.select(
        "stt", "edt", "province_id", "province_name", "order_count", F.col("order_amount").cast("double").alias("order_amount")
    )
