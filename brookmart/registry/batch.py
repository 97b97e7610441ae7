"""Batch queries: every operator and plan, run over whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brookmart import samples
from brookmart.operators import (
    Step, enrich_chain, first_ever, interval_join, latest_by_key, latest_config, parse_or_quarantine,
)
from brookmart.plans import coupons, dimensions, refunds, trade, traffic, users
from brookmart.session import shared_folder
from brookmart.sinks.files import delete
from brookmart.sources import read_changes, read_log

# Windows of seconds would hold one row each on these tables, so sizes are scaled up.
HOUR, DAY, MONTH, YEAR = "1 hour", "1 day", "30 days", "365 days"
BOUNCE = "6 hours"


def _pages(s: SparkSession, d: str) -> DataFrame:
    return traffic.with_event_time(samples.pages(samples.reader(s, d)))


# ---- parsing and logs --------------------------------------------------------------------------

def json_props(s, d):
    e = samples.table(s, d, "events").select("event_id", F.col("props").alias("value"))
    good, _ = parse_or_quarantine(e, T.StructType([T.StructField("k", T.IntegerType())]))
    return good.select("event_id", "k")


def quarantined_logs(s, d):
    good, bad = read_log(samples.log_texts(samples.reader(s, d)))
    return good.select("seq", F.lit("good").alias("verdict")).unionByName(bad.select("seq", F.lit("bad").alias("verdict")))


def _split(s, d):
    good, _ = read_log(samples.log_texts(samples.reader(s, d)))
    return traffic.log_split(good, ["seq"])


def log_split_counts(s, d):
    good, _ = read_log(samples.log_texts(samples.reader(s, d)))
    rows = traffic.log_split_rows(good, ["seq"])
    return rows.groupBy("kind", F.col("common.is_new").alias("is_new")).agg(F.count("*").alias("n"))


def log_pages(s, d):
    return _split(s, d)["page"].select("seq", "common.mid", "common.is_new", "page.page_id", "page.last_page_id", "ts")


def log_errors(s, d):
    return _split(s, d)["error"].select(
        "seq", "common.mid", "err.error_code", "err.msg", F.col("start").isNotNull().cast("int").alias("on_start"), "ts"
    )


def log_starts(s, d):
    return _split(s, d)["start"].select("seq", "common.mid", "common.is_new", "start.loading_time", "start.open_ad_id", "ts")


def log_displays(s, d):
    return _split(s, d)["display"].select(
        "seq", "display_type", "item", "item_type", F.col("order").alias("display_order"), "pos_id",
        F.col("page.page_id").alias("page_id"), F.col("common.mid").alias("mid"), "ts",
    )


def log_actions(s, d):
    return _split(s, d)["action"].select(
        "seq", "action_id", "item", "item_type", F.col("page.page_id").alias("page_id"), F.col("common.mid").alias("mid"), "ts"
    )


def changes_by_table(s, d):
    """All change events, through their JSON text. The sum of times is a long while all of them fit one, else a decimal."""
    rows = read_changes(samples.change_texts(samples.reader(s, d)))
    counts = rows.groupBy("table", "type").agg(
        F.count("*").alias("n"), F.sum(F.col("ts").cast("decimal(19,0)")).alias("ts_sum"), F.count(F.col("old")).alias("with_old")
    )
    out = f"{shared_folder(s, 'changes-by-table')}/counts"
    counts.write.parquet(out)
    told = s.read.schema(counts.schema).parquet(out)
    return _long_if_fits(told, "ts_sum")


def _long_if_fits(rows: DataFrame, column: str) -> DataFrame:
    """A decimal column of whole numbers as long, unless a value passes 64 bits."""
    wide = rows.where(F.col(column).isNotNull() & F.col(column).try_cast("long").isNull())
    return rows if wide.limit(1).count() else rows.withColumn(column, F.col(column).cast("long"))


# ---- visits and traffic ------------------------------------------------------------------------

_VISIT = ["common.mid", "common.ch", "ts", "seq"]


def unique_visits(s, d):
    return traffic.unique_visits(_pages(s, d), ["seq"]).select(*_VISIT)


def bounce_visits(s, d):
    return traffic.bounce_visits(_pages(s, d), BOUNCE, ["seq"]).select(*_VISIT)


def is_new_repair(s, d):
    from brookmart.operators import repair_is_new

    rows = repair_is_new(_pages(s, d), "common.mid", "et", "common.is_new", ["seq"])
    return rows.select(F.col("common.mid").alias("mid"), "ts", "seq", F.col("common.is_new").alias("is_new"))


def traffic_by_segment(s, d):
    p = _pages(s, d)
    return traffic.traffic_by_segment(
        p, traffic.unique_visits(p, ["seq"]), traffic.bounce_visits(p, BOUNCE, ["seq"]), HOUR
    )


def page_uniques(s, d):
    return traffic.page_uniques(traffic.page_visitors(_pages(s, d), ["seq"]), HOUR)


def keyword_counts(s, d):
    return traffic.keyword_counts(traffic.with_event_time(samples.search_pages(samples.reader(s, d))), "1 minute")


def keyword_counts_parts(s, d):
    return traffic.keyword_counts(traffic.with_event_time(samples.part_search_pages(samples.reader(s, d))), MONTH)


# ---- users -------------------------------------------------------------------------------------

def users_registered(s, d):
    return users.users_registered(samples.changes(samples.reader(s, d), "user_info"))


def favourites_added(s, d):
    return users.favourites_added(samples.changes(samples.reader(s, d), "favor_info"))


def comments_added(s, d):
    return users.comments_added(samples.changes(samples.reader(s, d), "comment_info"), samples.codes(s))


def registrations(s, d):
    return users.registrations(users_registered(s, d), HOUR)


def returning_users(s, d):
    days = users.login_days(_pages(s, d))
    return days.select("uid", F.date_format("day", "yyyy-MM-dd").alias("day"), F.unix_millis("et").alias("ts"), "uu_ct", "back_ct")


def login_activity(s, d):
    return users.login_activity(users.login_days(_pages(s, d)), HOUR)


# ---- trade -------------------------------------------------------------------------------------

def cart_adds(s, d):
    return trade.cart_adds(samples.changes(samples.reader(s, d), "cart_info"), samples.codes(s), samples.DATABASE)


def cart_adds_as_of(s, d):
    """Through the JSON text of the changes."""
    return trade.cart_adds_as_of(read_changes(samples.change_texts(samples.reader(s, d), "cart_info")), samples.code_history(s), samples.DATABASE)


def cart_uniques(s, d):
    return trade.cart_uniques(trade.cart_users(cart_adds(s, d), ["id"]), MONTH)


_WIDE = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")


#: Off: two sides that lie by order are not shuffled again for a join on the order and another column.
ALL_JOIN_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


#: Order lines that a wide query joins at once.
LINES_AT_ONCE = 120_000_000
#: Joins whose results are written take no room on disk when they are there, and their results little.
WRITTEN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd", ALL_JOIN_KEYS: "false",
}


@contextmanager
def _writing(s: SparkSession) -> Iterator[None]:
    before = {name: s.conf.get(name, None) for name in WRITTEN}
    for name, value in WRITTEN.items():
        s.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            s.conf.unset(name) if value is None else s.conf.set(name, value)


def _written(s: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return s.read.schema(rows.schema).parquet(path)


def _all(rows: DataFrame) -> DataFrame:
    return rows


def _by_orders(s: SparkSession, d: str, plan: Callable[..., DataFrame], **few) -> DataFrame:
    """``plan(of, **options)`` with the options of ``_wide``: those given in ``few``, or, of many lines, by parts of the orders one after the other.

    A part takes the changes of some orders (``of`` selects them), so that only a part's lines are shuffled at a time. The parts are written; activities and coupons,
    which meet their lines by id, are written before them. Plans must join on the order.
    """
    parts = math.ceil(samples.table(s, d, "lineitem").count() / LINES_AT_ONCE)
    if parts <= 1:
        return plan(_all, **few)
    root = shared_folder(s, "by-orders")
    order = F.when(F.col("table") == "order_info", F.col("data")["id"]).otherwise(F.col("data")["order_id"])
    with _writing(s):
        extras = _written(s, trade.line_extras(samples.changes(samples.reader(s, d), *_WIDE), samples.DATABASE), f"{root}/extras")
        for i in range(parts):
            def part(key: Column) -> Column:
                return F.pmod(F.xxhash64(key), F.lit(parts)) == i

            rows = plan(lambda changes: changes.where(part(order)), lines_by_order=True, extras=extras.where(part(F.col("order_id"))))
            rows.write.parquet(f"{root}/rows/part={i}")
    delete(s, f"{root}/extras")
    return s.read.schema(rows.schema).parquet(f"{root}/rows/part=*")


def _wide(s, d, of=_all, **options):
    if options.get("lines_by_order"):
        s.conf.set(ALL_JOIN_KEYS, "false")
    return trade.order_wide(of(samples.changes(samples.reader(s, d), *_WIDE)), samples.codes(s), database=samples.DATABASE, **options)


def order_wide(s, d):
    return _by_orders(s, d, lambda of, **options: _wide(s, d, of, **options).drop("old"))


def _placed(s, d, of=_all, **options):
    return trade.orders_placed(_wide(s, d, of, **options))


def orders_placed(s, d):
    return _by_orders(s, d, lambda of, **options: _placed(s, d, of, **options), lines_by_order=True)


def orders_cancelled(s, d):
    return _by_orders(s, d, lambda of, **options: trade.orders_cancelled(_wide(s, d, of, **options)))


def _paid(s, d, placed):
    return trade.payments_succeeded(samples.changes(samples.reader(s, d), "payment_info"), placed, samples.codes(s))


def payments_succeeded(s, d):
    return _paid(s, d, _placed(s, d, lines_by_order=True))


def order_users(s, d):
    placed = _placed(s, d).select("user_id", trade.parse_time("create_time").alias("et"), "id")
    return trade.order_users(trade.user_firsts(placed, "user_id", "et", ["id"]), size=DAY)


def payment_users(s, d):
    paid = _paid(s, d, _placed(s, d)).select("user_id", trade.parse_time("callback_time").alias("et"), "id")
    return trade.payment_users(trade.user_firsts(paid, "user_id", "et", ["id"]), size=DAY)


#: What the order of a line's versions and the queries over its newest one need.
_LINE = list(dict.fromkeys(["id", "order_id", "create_time", *trade.LINE_VERSION]))


def _newest_lines(s, d):
    lines = _by_orders(s, d, lambda of, **options: _placed(s, d, of, **options).select(*_LINE), orders_first=True)
    newest = trade.newest_lines(lines)
    if samples.table(s, d, "lineitem").count() <= LINES_AT_ONCE:
        return newest
    with _writing(s):
        return _written(s, newest, f"{shared_folder(s, 'newest-lines')}/rows")


def newest_order_lines(s, d):
    return _newest_lines(s, d).select(
        "id", "order_id", "sku_id", "order_price", "sku_num", "create_time", "activity_id", "coupon_id", "change_ts"
    )


def sku_orders(s, d):
    return trade.sku_orders(_newest_lines(s, d), samples.dims(s, d), YEAR)


def sku_orders_dedup(s, d):
    return trade.sku_orders_dedup(_newest_lines(s, d), samples.dims(s, d), YEAR)


def province_orders(s, d):
    return trade.province_orders(samples.changes(samples.reader(s, d), "order_info"), samples.dims(s, d)["base_province"], MONTH)


# ---- coupons and refunds -----------------------------------------------------------------------

def coupons_received(s, d):
    return coupons.coupons_received(samples.changes(samples.reader(s, d), "coupon_use"))


def coupons_ordered(s, d):
    return coupons.coupons_ordered(samples.changes(samples.reader(s, d), "coupon_use"))


def coupons_paid(s, d):
    return coupons.coupons_paid(samples.changes(samples.reader(s, d), "coupon_use"))


def _refunds_wide(s, d, of, **options):
    requests = of(samples.changes(samples.reader(s, d), "order_refund_info"))
    placed = _placed(s, d, of, among=refunds.requested(requests), **options)
    return refunds.refund_requests_wide(requests, placed, samples.codes(s), lines_by_order=True)


def refund_requests_wide(s, d):
    return _by_orders(s, d, lambda of, **options: _refunds_wide(s, d, of, **options).drop("old"), lines_by_order=True)


def refund_requests(s, d):
    return refunds.refund_requests(samples.changes(samples.reader(s, d), "order_refund_info", "order_info"), samples.codes(s))


def refunds_paid_wide(s, d):
    def paid(of, **options):
        payments = of(samples.changes(samples.reader(s, d), "refund_payment"))
        return refunds.refunds_paid_wide(payments, _refunds_wide(s, d, of, **options), samples.codes(s), lines_by_order=True)

    return _by_orders(s, d, paid, lines_by_order=True)


def refunds_paid(s, d):
    return refunds.refunds_paid(
        samples.changes(samples.reader(s, d), "refund_payment", "order_info", "order_refund_info"), samples.codes(s)
    )


def refunds_by_brand_category_user(s, d):
    # A request and the later change of its status are one refund.
    requests = samples.changes(samples.reader(s, d), "order_refund_info")
    rows = refunds.refund_requests_wide(requests, _placed(s, d), samples.codes(s)).where("type = 'insert'").select(
        "user_id", "sku_id", "refund_amount", F.col("refund_create_time").alias("create_time")
    )
    return refunds.refunds_by_brand_category_user(rows, samples.dims(s, d), MONTH)


# ---- joins, versions, dimensions ---------------------------------------------------------------

def interval_pairs(s, d):
    e = samples.table(s, d, "events")
    clicks = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    buys = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"), F.col("ts").alias("buy_ts"))
    return interval_join(clicks, buys, "user_id", "click_ts", "buy_ts", "-2 hours", "1 hour").select(
        "user_id", "click_id", "buy_id"
    )


def customer_geography(s, d):
    c = samples.table(s, d, "customer")
    n = samples.table(s, d, "nation").where("n_nationkey <> 7")
    return enrich_chain(c.select("c_custkey", "c_nationkey"), [
        Step(n, "c_nationkey", {"nation_name": "n_name", "region_key": "n_regionkey"}, "n_nationkey"),
        Step(samples.table(s, d, "region"), "region_key", {"region_name": "r_name"}, "r_regionkey"),
    ])


def sku_enriched(s, d):
    part = samples.table(s, d, "part").select(F.col("p_partkey").cast("string").alias("sku_id"))
    return enrich_chain(part, trade.sku_chain(samples.dims(s, d)))


def first_orders(s, d):
    o = samples.table(s, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return first_ever(o, "o_custkey", "o_orderdate", ["o_orderkey"]).select("o_custkey", "o_orderkey")


def latest_order_status(s, d):
    rows = samples.changes(samples.reader(s, d), "order_info")
    rows = rows.select(F.col("data")["id"].alias("id"), F.col("data")["order_status"].alias("order_status"), "ts")
    return latest_by_key(rows, "id", ["ts"])


def dim_sync(s, d):
    synced = dimensions.dim_sync(
        samples.changes(samples.reader(s, d), "user_info", "sku_info", "order_info"), latest_config(samples.config_events(s, d))
    )
    return synced.select(
        "sink_table", "pk", F.size("data").cast("long").alias("n_columns"),
        F.coalesce(F.col("data")["nick_name"], F.col("data")["sku_name"]).alias("name"), "ts",
    )


BATCH = {f.__name__: f for f in (
    json_props, quarantined_logs, log_split_counts, log_pages, log_errors, log_starts,
    log_displays, log_actions, changes_by_table, unique_visits,
    bounce_visits, is_new_repair, traffic_by_segment, page_uniques, keyword_counts, keyword_counts_parts,
    users_registered, favourites_added, comments_added, registrations, returning_users, login_activity, cart_adds, cart_adds_as_of,
    cart_uniques, order_wide, orders_placed, orders_cancelled, payments_succeeded, order_users, payment_users,
    newest_order_lines, sku_orders, sku_orders_dedup, province_orders, coupons_received, coupons_ordered,
    coupons_paid, refund_requests_wide, refund_requests, refunds_paid_wide, refunds_paid,
    refunds_by_brand_category_user, interval_pairs, customer_geography, sku_enriched, first_orders, latest_order_status, dim_sync,
)}
