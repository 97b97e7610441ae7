"""The same jobs on streams, with their results read back.

The records derived from the given tables are written as topics in about the order of their time, and read in ``FILES``
micro-batches. Each query runs in a fresh folder below ``spark.checkpoint.dir``; the jobs behind the order lines share
one run of the join that they all follow. Windowed results come in update mode into an upsert table, so open windows are there too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from brookmart import samples
from brookmart.operators import bounces, interval_join, latest_config
from brookmart.operators.windows import emitted
from brookmart.plans import live, refunds, trade, traffic, users
from brookmart.registry.batch import BOUNCE, DAY, HOUR, MONTH, YEAR
from brookmart.session import SETTINGS, shared_folder
from brookmart.sinks.files import children, date_files, delete, exists, write_json
from brookmart.sinks import read_dim_table, read_upsert, upsert_dims, write_append, write_upsert
from brookmart.sinks.versions import batch_path
from brookmart.streaming.dedup import earliest_per_day_stream
from brookmart.streaming.history import Joined
from brookmart.streaming.jobs import run_to_end, start_batches


#: Rows of a topic's file, and of the given tables for each state partition.
ROWS = 250_000
#: Rows of a topic that are shuffled at once; of a larger one a micro-batch at a time.
AT_ONCE = 20_000_000
#: Bytes of long texts in a topic's file.
TEXT = 8 << 20


def _given_rows(s: SparkSession, d: str) -> int:
    """Rows of the large given tables, as their files' footers tell it."""
    there = [t for t in ("events", "orders", "lineitem", "documents") if exists(s, f"{d}/{t}.parquet")]
    return sum(samples.table(s, d, t).count() for t in there)


@contextmanager
def _stream_session(s: SparkSession, d: str, per_core: int = 2) -> Iterator[None]:
    """Settings that jobs take from the session, for the runs here: the state store, and as many state partitions as the tables need.

    Each partition is committed in every micro-batch, so small tables get few; beyond those the number grows with the rows, so that a task's state,
    sorts and files do not. The session may come from elsewhere, with a store that has no room for lists and timers.
    """
    few = min(int(s.conf.get(PARTITIONS)), per_core * s.sparkContext.defaultParallelism)
    rows = _given_rows(s, d)
    items = min(max(rows // 4, 1_000_000), KEYS)
    settings = {
        PARTITIONS: max(few, math.ceil(rows / ROWS / 2)),
        STATE_STORE: SETTINGS[STATE_STORE],
        "spark.sql.files.maxPartitionBytes": 16 << 20,
        # What a micro-batch has shuffled goes when its job has ended, not when the driver happens to collect garbage.
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
        "spark.sql.streaming.stateStore.compression.codec": "zstd",
        "spark.sql.streaming.minBatchesToRetain": 2,  # runs here go on from their last batch only
        # Of the written history only rows that a batch's new rows may meet are shuffled.
        f"{BLOOM}.enabled": "true",
        f"{BLOOM}.applicationSideScanSizeThreshold": MET,
        f"{BLOOM}.creationSideThreshold": 1 << 40,
        f"{BLOOM}.expectedNumItems": items,
        f"{BLOOM}.numBits": 8 * items,
        f"{BLOOM}.maxNumItems": KEYS,
        f"{BLOOM}.maxNumBits": 8 * KEYS,
    }
    before = {name: s.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        s.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            s.conf.unset(name) if value is None else s.conf.set(name, value)


PARTITIONS = "spark.sql.shuffle.partitions"
#: Spark's filters of one join side by the keys of the other, before it is shuffled.
BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
#: Keys that a filter is made for at most (a byte each), and bytes of a side from which it is filtered.
KEYS, MET = 16_000_000, 8 << 20
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Micro-batches of a topic.
FILES = 3
#: Rows stand up to this many milliseconds behind rows of later time: across files too, within what the watermarks wait for.
DISORDER = 1500
#: When a topic's first file is said to be written, in epoch milliseconds.
FIRST_FILE = 1_700_000_000_000
#: After all rows of the given tables, in epoch milliseconds: 2100-01-01.
CLOSING = 4_102_444_800_000


def _topic(s: SparkSession, rows: DataFrame, root: str, name: str, ts: str = "ts", batches: int = FILES, per_file: int = ROWS, long: str | None = None) -> DataFrame:
    """Rows as a stream of ``batches`` micro-batches, by their time ``ts`` in milliseconds with some disorder.

    A micro-batch has as many files as its rows, or the texts of the column ``long``, need, each written by a task of its own. Quantiles of the time
    cut the micro-batches, and a hash deals a micro-batch's rows to its files: ranges of files would make every row twice, as Spark takes samples first.
    """
    path = f"{root}/topic-{name}"
    plain = [c for c, t in rows.dtypes if not t.startswith("map")]
    shift = F.pmod(F.xxhash64(*plain), F.lit(DISORDER))
    timed = rows.withColumn("_at", F.col(ts) + shift)
    cuts = F.percentile_approx("_at", [i / batches for i in range(1, batches)])
    n, size, bounds = timed.agg(F.count("*"), F.sum(F.octet_length(long)) if long else F.lit(0), cuts).first()
    each = max(1, math.ceil(n / batches / per_file), math.ceil((size or 0) / batches / TEXT))
    batch = sum((F.coalesce(F.col("_at") > b, F.lit(False)).cast("long") for b in bounds or []), F.lit(0))
    content = [F.map_values(c) if t.startswith("map") else F.col(c) for c, t in rows.dtypes]
    file = F.pmod(F.xxhash64(*content), F.lit(each)).cast("int")
    if n > AT_ONCE:  # one micro-batch after the other, so that the shuffle of one is on disk
        written = 0
        for b in range(batches):
            before = set(children(s, path))
            timed.where(batch == b).repartitionById(each, file).drop("_at").write.mode("append").parquet(path)
            written += date_files(s, path, ".parquet", FIRST_FILE + 1000 * written, before)
    else:
        timed.repartitionById(batches * each, (batch * each + file).cast("int")).drop("_at").write.parquet(path)
        written = date_files(s, path, ".parquet", FIRST_FILE)
    if each > 1 and written < batches * each:  # a micro-batch must not begin amid the files of another
        timed.repartitionByRange(batches * each, "_at").drop("_at").write.mode("overwrite").parquet(path)
        written = date_files(s, path, ".parquet", FIRST_FILE)
    return _read_topic(s, path, rows.schema, max(1, math.ceil(written / batches)))


def _read_topic(s: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    return s.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _close(s: SparkSession, topic: DataFrame, root: str, name: str, row: dict) -> None:
    """Append a last file with one row of some given columns, the others null."""
    values = [F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in topic.schema.fields]
    s.range(1).select(*values).coalesce(1).write.mode("append").parquet(f"{root}/topic-{name}")  # now, so after the others


def _spent(s: SparkSession, root: str, *names: str) -> None:
    """Delete what a job that has come to its end needs no more, so that jobs after it find the room."""
    for name in names:
        delete(s, f"{root}/{name}")


def _store(df: DataFrame, root: str, name: str) -> str:
    """Run an append query to its end; its output folder."""
    path = f"{root}/{name}"
    run_to_end(write_append(df, "parquet", f"{root}/checkpoint-{name}", path))
    return path


def _table(s: SparkSession, df: DataFrame, root: str, name: str) -> DataFrame:
    """A query's output; its checkpoint and topics go."""
    path = _store(df, root, name)
    _spent(s, root, f"checkpoint-{name}", *(n for n in children(s, root) if n.startswith("topic-")))
    return s.read.schema(df.schema).parquet(path)


def _restream(s: SparkSession, df: DataFrame, root: str, name: str, per_file: int = ROWS) -> DataFrame:
    """A stream of the output of the stream ``df``: a topic between two jobs.

    A batch's rows are cut into files by their time ``et``, in the order of which the files are dated, so that no file is late after the one before it.
    """
    path, files = f"{root}/{name}", []

    def work(batch: DataFrame, batch_id: int) -> None:
        if n := batch.count():
            files.append(math.ceil(n / per_file))
            batch.repartitionByRange(files[-1], "et").write.mode("overwrite").parquet(batch_path(path, batch_id))

    run_to_end(start_batches(df, work, f"{root}/checkpoint-{name}"))
    first = FIRST_FILE
    for folder in sorted(children(s, path), key=lambda f: int(f.rpartition("=")[2])):
        first += 1000 * date_files(s, f"{path}/{folder}", ".parquet", first)
    return _read_topic(s, f"{path}/batch_id=*", df.schema, max(files, default=1))


def _windows(s: SparkSession, df: DataFrame, root: str, keys: list[str]) -> DataFrame:
    """Results of all windows, open ones included, by their keys; written with their emission time."""
    run_to_end(write_upsert(emitted(df), f"{root}/windows", keys, ["ts"], f"{root}/checkpoint-windows", "update"))
    _spent(s, root, "checkpoint-windows", *(n for n in children(s, root) if n.startswith("topic-")))
    return _emitted(s, root, keys)


def _emitted(s: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Windows without the emission time, which differs from run to run; one without it counts as no result."""
    return read_upsert(s, f"{root}/windows", keys, ["ts"]).where("ts IS NOT NULL").drop("ts")


def _pages(s, d, root: str) -> DataFrame:
    return traffic.with_event_time(_topic(s, samples.pages(samples.reader(s, d)), root, "pages"))


def _changes(s, d, root: str, *tables: str) -> DataFrame:
    return _topic(s, samples.changes(samples.reader(s, d), *tables), root, _topic_of(*tables).removeprefix("topic-"))


def _topic_of(*tables: str) -> str:
    return "topic-changes-" + "-".join(tables)


def live_unique_visits(s, d):
    root = shared_folder(s, "unique-visits")
    visits = traffic.unique_visits(_pages(s, d, root).withWatermark("et", "2 seconds"))
    return _table(s, visits, root, "visits").select("common.mid", F.date_format("et", "yyyy-MM-dd").alias("day"))


def _closed_pages(s, d, root: str, watermark: str) -> DataFrame:
    """Pages with a watermark, and a last row of null columns that moves it behind all others, so that the last results come out."""
    pages = _pages(s, d, root)
    _close(s, pages.drop("et"), root, "pages", {"ts": CLOSING})
    return pages.withWatermark("et", watermark)


def _visits(s, d, root: str) -> DataFrame:
    """The earliest visit of each device and day as a stream."""
    first = earliest_per_day_stream(traffic.visit_starts(_closed_pages(s, d, root, "2 seconds")), "common.mid", "et", ["seq"])
    return first.where("common IS NOT NULL")


def live_daily_visits(s, d):
    root = shared_folder(s, "daily-visits")
    return _table(s, _visits(s, d, root), root, "visits").select("common.mid", "common.ch", "ts", "seq")


def _bounced(s, d, root: str) -> DataFrame:
    last = F.when(F.col("common").isNull(), F.lit("closed")).otherwise(F.col("page.last_page_id"))
    return bounces(_closed_pages(s, d, root, "5 seconds"), "common.mid", "et", last, BOUNCE, ["seq"])


def live_bounce_visits(s, d):
    root = shared_folder(s, "bounces")
    rows = _table(s, _bounced(s, d, root), root, "bounces")
    return rows.select("common.mid", "common.ch", "ts", "seq")


def live_traffic_by_segment(s, d):
    """Pages, visits and bounces as three streams under one watermark, which waits for the slowest of them."""
    root = shared_folder(s, "traffic")
    visits = _restream(s, _visits(s, d, f"{root}/v"), root, "visits")
    bounced = _restream(s, _bounced(s, d, f"{root}/b"), root, "bounced")
    out = traffic.traffic_by_segment(_pages(s, d, f"{root}/p"), visits, bounced, HOUR, "7 hours")
    return _windows(s, out, root, ["stt", *traffic.SEGMENT])


def live_page_uniques(s, d):
    root = shared_folder(s, "page-uniques")
    visitors = _restream(s, live.page_visitors(_pages(s, d, root)), root, "visitors")
    return _windows(s, traffic.page_uniques(visitors, DAY), root, ["stt"])


def live_keyword_counts(s, d):
    root = shared_folder(s, "keywords")
    pages = traffic.with_event_time(_topic(s, samples.search_pages(samples.reader(s, d)), root, "searches", long="page.item"))
    return _windows(s, traffic.keyword_counts(pages, "1 minute"), root, ["stt", "source", "keyword"])


def _split_log(s, d) -> str:
    root = shared_folder(s, "log-split")
    texts = samples.log_texts(samples.reader(s, d))
    run_to_end(live.log_split(_topic(s, texts, root, "texts", "seq"), root, f"{root}/checkpoint", ["seq"]))
    return root


def live_log_split_counts(s, d):
    rows = live.committed(s, _split_log(s, d), "logs").select("kind", F.col("common.is_new").alias("is_new"))
    return rows.groupBy("kind", "is_new").agg(F.count("*").alias("n"))


def live_log_pages(s, d):
    """The page rows of the log split, by their content."""
    rows = live.committed(s, _split_log(s, d), "logs").where("kind = 'page'")
    return rows.select("seq", "common.mid", "common.is_new", "page.page_id", "page.last_page_id", "ts")


def live_returning_users(s, d):
    root = shared_folder(s, "logins")
    run_to_end(live.login_days(_pages(s, d, root), root, f"{root}/checkpoint"))
    rows = s.read.parquet(f"{root}/rows")
    return rows.select("uid", F.date_format("day", "yyyy-MM-dd").alias("day"), F.unix_millis("et").alias("ts"), "uu_ct", "back_ct")


def live_province_orders(s, d):
    root = shared_folder(s, "provinces")
    out = trade.province_orders(_changes(s, d, root, "order_info"), samples.dims(s, d)["base_province"], MONTH)
    return _windows(s, out, root, ["stt", "province_id"])


def live_registrations(s, d):
    root = shared_folder(s, "registrations")
    return _windows(s, users.registrations(users.users_registered(_changes(s, d, root, "user_info")), "1 hour"), root, ["stt"])


def live_cart_adds(s, d):
    root = shared_folder(s, "carts")
    return _table(s, trade.cart_adds(_changes(s, d, root, "cart_info"), samples.codes(s)), root, "carts")


def live_cart_adds_as_of(s, d):
    root = shared_folder(s, "carts-as-of")
    return _table(s, trade.cart_adds_as_of(_changes(s, d, root, "cart_info"), samples.code_history(s)), root, "carts")


def live_cart_uniques(s, d):
    root = shared_folder(s, "cart-uniques")
    carts = trade.cart_adds(_changes(s, d, root, "cart_info"), samples.codes(s), samples.DATABASE)
    firsts = _restream(s, live.cart_users(carts), root, "users")
    return _windows(s, trade.cart_uniques(firsts, MONTH), root, ["stt"])


def live_login_activity(s, d):
    root = shared_folder(s, "login-windows")
    run_to_end(live.login_days(_pages(s, d, root), root, f"{root}/checkpoint"))
    stored = s.read.parquet(f"{root}/rows").drop("batch_id")
    days = s.readStream.schema(stored.schema).parquet(f"{root}/rows/*")
    return _windows(s, users.login_activity(days, HOUR), root, ["stt"])


def live_sku_order_lines(s, d):
    """The two-level window count on a stream: orders and amounts per SKU and year, closed years only."""
    root = shared_folder(s, "sku-orders")
    lines = _changes(s, d, root, "order_detail").selectExpr(
        *[f"data['{c}'] AS {c}" for c in (
            "id", "order_id", "sku_id", "create_time", "order_price", "sku_num", "split_total_amount",
            "split_activity_amount", "split_coupon_amount")]
    )
    out = trade.sku_orders(lines, samples.dims(s, d), YEAR)
    rows = _table(s, out, root, "windows")
    return rows.select("stt", "edt", "sku_id", "trademark_name", "order_count", "original_amount", "order_amount")


def live_refunds_paid(s, d):
    """Two chained stream-stream joins."""
    root = shared_folder(s, "refunds")
    rows = refunds.refunds_paid(_changes(s, d, root, "refund_payment", "order_info", "order_refund_info"), samples.codes(s))
    return _table(s, rows, root, "refunds")


_chains: dict[tuple[str, str], str] = {}


def _order_chain(s, d) -> str:
    """The folder of the five-way order join, two stream jobs. Jobs that follow it read the same output, as they would the same topic."""
    run = (s.sparkContext.applicationId, d)
    if run in _chains and exists(s, f"{_chains[run]}/done"):
        return _chains[run]
    root = shared_folder(s, "orders")
    parts = ("order_detail", "order_detail_activity", "order_detail_coupon")
    run_to_end(live.order_lines(_changes(s, d, root, *parts), root, f"{root}/checkpoint-lines", database=samples.DATABASE, catch_up=True))
    _spent(s, root, _topic_of(*parts), "line-parts")
    stored = s.read.parquet(f"{root}/lines").drop("batch_id")
    versions = s.readStream.schema(stored.schema).parquet(f"{root}/lines/*")
    run_to_end(live.order_wide(_changes(s, d, root, "order_info"), versions, samples.codes(s), root, f"{root}/checkpoint-wide", database=samples.DATABASE, catch_up=True))
    _spent(s, root, _topic_of("order_info"), "lines", "joined")
    write_json(s, f"{root}/done", True)
    _chains[run] = root
    return root


def _order_wide(s, d) -> DataFrame:
    return read_upsert(s, f"{_order_chain(s, d)}/wide", live.ORDER_KEY, ["line_version"])


def _placed(s, d) -> DataFrame:
    """All versions of placed order lines, as a stream in the batches they were written in."""
    root = _order_chain(s, d)
    folder = f"{root}/wide"
    stored = s.read.parquet(f"{folder}/batch_id=*")
    files = sum(n.endswith(".parquet") for f in children(s, folder) if f.startswith("batch_id=") for n in children(s, f"{folder}/{f}"))
    # Every micro-batch reads the history, so their number must not grow with the files.
    versions = s.readStream.schema(stored.schema).option("maxFilesPerTrigger", max(8, math.ceil(files / FILES)))
    return trade.orders_placed(versions.parquet(f"{folder}/batch_id=*"))


def live_order_wide(s, d):
    return _order_wide(s, d).drop("old", "line_version")


def live_orders_placed(s, d):
    return trade.orders_placed(_order_wide(s, d)).drop("line_version")


def live_orders_cancelled(s, d):
    return trade.orders_cancelled(_order_wide(s, d)).drop("line_version")


def _paid(s, d, root: str) -> DataFrame:
    """Payments joined to the stream of order-line versions, in their newest version."""
    paid = Joined([_changes(s, d, root, "payment_info"), _placed(s, d)], lambda c, placed: trade.payments_succeeded(c, placed, samples.codes(s)), root)
    key = ["id", "change_ts", "payment_ts"]
    run_to_end(write_upsert(paid, f"{root}/paid", key, ["line_version"], f"{root}/checkpoint-paid"))
    _spent(s, root, "history", _topic_of("payment_info"))
    return read_upsert(s, f"{root}/paid", key, ["line_version"]).drop("line_version")


def live_payments_succeeded(s, d):
    return _paid(s, d, shared_folder(s, "payments"))


def _user_windows(s, rows: DataFrame, root: str, windows) -> DataFrame:
    """Users' days by a stream; which day is a user's first is told when the windows are read, as an earlier one may come late."""
    run_to_end(live.user_firsts(rows, "user_id", "et", root, f"{root}/checkpoint", ["id"], memory=36_500))
    _spent(s, root, "history", _topic_of("payment_info"))
    return windows(trade.user_firsts(s.read.parquet(f"{root}/rows"), "user_id", "et"), size=DAY)


def live_order_users(s, d):
    placed = _placed(s, d).select("user_id", trade.parse_time("create_time").alias("et"), "id")
    return _user_windows(s, placed, shared_folder(s, "order-users"), trade.order_users)


def live_payment_users(s, d):
    root = shared_folder(s, "payment-users")
    def paid(changes: DataFrame, placed: DataFrame) -> DataFrame:
        rows = trade.payments_succeeded(changes, placed, samples.codes(s))
        return rows.select("user_id", trade.parse_time("callback_time").alias("et"), "id")

    return _user_windows(s, Joined([_changes(s, d, root, "payment_info"), _placed(s, d)], paid, root), root, trade.payment_users)


#: What the windows per SKU and the order of a line's versions need.
_SKU_LINE = list(dict.fromkeys(["id", "order_id", "create_time", *trade.LINE_VERSION]))


def _line_windows(s, d, name: str, touches, plan) -> DataFrame:
    root = shared_folder(s, name)
    dims = samples.dims(s, d)
    run_to_end(live.versioned_windows(
        _placed(s, d).select(*_SKU_LINE), ["id"], trade.LINE_VERSION, touches, lambda lines: plan(lines, dims, YEAR), ["stt", "sku_id"], root, f"{root}/checkpoint"))
    _spent(s, root, "rows")
    return _emitted(s, root, ["stt", "sku_id"])


def live_sku_orders(s, d):
    """Orders and amounts per SKU and window over the newest versions of order lines, with all dimensions; open windows too."""
    window = F.window(trade.parse_time("create_time"), YEAR)["start"]
    return _line_windows(s, d, "sku-windows", [window, F.col("sku_id")], trade.sku_orders)


def live_sku_orders_dedup(s, d):
    """As live_sku_orders, of one line per order and SKU. A new earliest line may lie in another window, so a SKU's windows are told together."""
    return _line_windows(s, d, "sku-dedup", [F.col("sku_id")], trade.sku_orders_dedup)


def live_refund_requests(s, d):
    root = shared_folder(s, "requests")
    changes = _changes(s, d, root, "order_refund_info", "order_info")
    return _table(s, refunds.refund_requests(changes, samples.codes(s)), root, "requests")


#: What a later version of an order line may change.
_LATER = ["activity_id", "activity_rule_id", "coupon_id", "coupon_use_id", "line_version"]


def _newest_wide(s, rows: Joined, root: str) -> DataFrame:
    """Wide rows in their newest line version; rows are told apart by all other columns."""
    key = [c for c in rows.columns() if c not in _LATER]
    run_to_end(write_upsert(rows, f"{root}/wide", key, ["line_version"], f"{root}/checkpoint-wide"))
    _spent(s, root, "history", _topic_of("order_refund_info"), _topic_of("refund_payment"))
    return read_upsert(s, f"{root}/wide", key, ["line_version"]).drop("line_version")


def _refunds_wide(s, changes: DataFrame, placed: DataFrame) -> DataFrame:
    return refunds.refund_requests_wide(changes, placed, samples.codes(s)).drop("old")


def live_refund_requests_wide(s, d):
    root = shared_folder(s, "refunds-wide")
    rows = Joined([_changes(s, d, root, "order_refund_info"), _placed(s, d)], lambda c, placed: _refunds_wide(s, c, placed), root)
    return _newest_wide(s, rows, root)


def live_refunds_paid_wide(s, d):
    """The request join and the payment join in one query."""
    root = shared_folder(s, "refunds-paid-wide")
    def paid(payments: DataFrame, requests: DataFrame, placed: DataFrame) -> DataFrame:
        return refunds.refunds_paid_wide(payments, _refunds_wide(s, requests, placed).withColumn("old", F.lit(None)), samples.codes(s))

    inputs = [_changes(s, d, root, "refund_payment"), _changes(s, d, root, "order_refund_info"), _placed(s, d)]
    return _newest_wide(s, Joined(inputs, paid, root), root)


def live_refunds_by_brand_category_user(s, d):
    root = shared_folder(s, "refunds-brand")
    def requested(changes: DataFrame, placed: DataFrame) -> DataFrame:
        return _refunds_wide(s, changes, placed).where("type = 'insert'").select(
            "id", "refund_ts", "line_version", "user_id", "sku_id", "refund_amount", "refund_num", F.col("refund_create_time").alias("create_time"))

    rows = Joined([_changes(s, d, root, "order_refund_info"), _placed(s, d)], requested, root)
    dims = samples.dims(s, d)
    touches = [F.window(trade.parse_time("create_time"), MONTH)["start"], F.col("user_id")]
    keys = ["stt", "trademark_id", "category3_id", "user_id"]
    run_to_end(live.versioned_windows(
        rows, ["id", "refund_ts", "refund_amount", "refund_num"], ["line_version"], touches,
        lambda r: refunds.refunds_by_brand_category_user(r, dims, MONTH), keys, root, f"{root}/checkpoint"))
    _spent(s, root, "history", "rows", _topic_of("order_refund_info"))
    return _emitted(s, root, keys)


def live_interval_pairs(s, d):
    root = shared_folder(s, "pairs")
    events = samples.table(s, d, "events").withColumn("ms", F.unix_millis("ts"))

    def of(kind: str) -> DataFrame:
        return _topic(s, events.where(F.col("event_type") == kind), root, kind, "ms")

    clicks = of("click").selectExpr("user_id", "event_id AS click_id", "ts AS click_ts")
    buys = of("purchase").selectExpr("user_id", "event_id AS buy_id", "ts AS buy_ts")
    pairs = interval_join(clicks, buys, "user_id", "click_ts", "buy_ts", "-2 hours", "1 hour", watermark="2 seconds")
    return _table(s, pairs.select("user_id", "click_id", "buy_id"), root, "pairs")


def live_dim_sync(s, d):
    root = shared_folder(s, "dims")
    changes = _changes(s, d, root, "user_info", "sku_info", "order_info")

    def config(spark: SparkSession) -> DataFrame:
        return latest_config(samples.config_events(spark, d))

    run_to_end(upsert_dims(changes, config, f"{root}/tables", f"{root}/checkpoint"))
    user = read_dim_table(s, f"{root}/tables", "dim_user_info", ["id", "nick_name", "user_level"])
    sku = read_dim_table(s, f"{root}/tables", "dim_sku_info", ["id", "sku_name", "spu_id"])
    return user.toDF("id", "name", "attribute").unionByName(sku.toDF("id", "name", "attribute"))


def _sized(query):
    def run(s: SparkSession, d: str) -> DataFrame:
        with _stream_session(s, d):
            return query(s, d)

    return run


STREAMS = {f.__name__: _sized(f) for f in (
    live_unique_visits, live_daily_visits, live_bounce_visits, live_traffic_by_segment, live_page_uniques, live_keyword_counts, live_log_split_counts, live_log_pages,
    live_returning_users, live_order_users, live_payment_users, live_province_orders, live_registrations, live_cart_adds, live_cart_adds_as_of,
    live_cart_uniques, live_login_activity, live_sku_order_lines, live_sku_orders, live_sku_orders_dedup, live_refund_requests, live_refunds_paid,
    live_refund_requests_wide, live_refunds_paid_wide, live_refunds_by_brand_category_user, live_order_wide,
    live_orders_placed, live_orders_cancelled, live_payments_succeeded, live_interval_pairs, live_dim_sync,
)}
