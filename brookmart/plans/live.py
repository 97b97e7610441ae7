"""Stream jobs that need more than one query stage or state without a time limit.

The other plans run on streams as they are. Here, work per micro-batch uses the batch plans together
with a ledger of what was seen before; every write goes to the partition of its batch number, so a
batch that runs again replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from brookmart.operators import cdc_select, first_per_day, first_state, lookup, small_side, wide_join
from brookmart.operators.columns import as_col
from brookmart.operators.windows import emitted
from brookmart.plans import trade, traffic, users
from brookmart.schemas import TABLE_COLUMNS
from brookmart.sinks.append import _trigger
from brookmart.sinks.files import children, delete, write_json
from brookmart.sinks.upsert import upsert_batch, write_upsert
from brookmart.sinks.versions import VersionedTable, batch_path, published
from brookmart.sources.events import read_log
from brookmart.streaming.history import History, Joined
from brookmart.streaming.jobs import start_batches
from brookmart.streaming.ledger import Ledger


def _write(rows: DataFrame, out: str, batch_id: int, *parts: str) -> None:
    rows.write.mode("overwrite").partitionBy(*parts).parquet(batch_path(out, batch_id))


COMMITTED = "_committed"
#: Batches listed by number; the ones before are listed by the greatest of them.
LISTED = 100


def commit(spark: SparkSession, root: str, batch_id: int) -> None:
    """Tell readers of ``root`` that all outputs of a batch are there. To be called when they are."""
    write_json(spark, f"{root}/{COMMITTED}/{batch_id}.json", {"batch": batch_id})
    old = [int(n.removesuffix(".json")) for n in children(spark, f"{root}/{COMMITTED}") if n.endswith(".json") and not n.startswith("_")]
    for n in sorted(old)[:-LISTED]:  # batches come in order, so the newest one tells of all before
        delete(spark, f"{root}/{COMMITTED}/{n}.json")


def committed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The output ``root/name`` of a job with several outputs, of those batches only whose outputs are all there."""
    newest = published(spark, f"{root}/{COMMITTED}")
    rows = spark.read.parquet(f"{root}/{name}")
    return rows.where(F.col("batch_id") <= (-1 if newest is None else newest))


def log_split(
    texts: DataFrame, root: str, checkpoint: str, tiebreak=(), trigger: Mapping | None = None
) -> StreamingQuery:
    """Behaviour log texts -> ``root/logs`` (partitioned by kind) and ``root/dirty``; read them with ``committed``.

    Known devices, logs and malformed texts are three outputs. A batch that stops between them is in none of its readers' sight until it has
    run again: devices are looked up as they were before the batch, and logs and texts are read up to the last batch with all three.
    """
    devices = Ledger(f"{root}/devices", T.StructType([
        T.StructField("_key", T.StringType()), T.StructField("first_day", T.DateType()),
    ]), ["_key"])

    def work(batch: DataFrame, batch_id: int) -> None:
        good, bad = read_log(batch)
        timed = traffic.with_event_time(good)
        first = first_state(timed, "common.mid", "et", "common.is_new", tiebreak)
        devices.record(first, batch_id, ["first_day"])
        state = devices.matching(first, batch_id)
        _write(traffic.log_split_rows(good, tiebreak, state), f"{root}/logs", batch_id, "kind")
        _write(bad, f"{root}/dirty", batch_id)
        commit(batch.sparkSession, root, batch_id)

    return start_batches(texts, work, checkpoint, trigger)


def page_visitors(pages: DataFrame, watermark: str = "2 seconds") -> DataFrame:
    """First row to arrive per device, day and page; write it out, then ``traffic.page_uniques``."""
    wanted = pages.where(F.col("page.page_id").isin(traffic.HOME, traffic.DETAIL)).withWatermark("et", watermark)
    keyed = wanted.withColumn("_visitor", F.struct("common.mid", "page.page_id"))
    return first_per_day(keyed, "_visitor", "et").drop("_visitor")


def cart_users(carts: DataFrame, watermark: str = "2 seconds") -> DataFrame:
    """First addition to arrive per user and day; write it out, then ``trade.cart_uniques``."""
    timed = trade.with_cart_time(carts).withWatermark("et", watermark)
    return first_per_day(timed, "user_id", "et").select("user_id", "et")


def _recent(key: str, memory: int):
    """Of each key's days in some merged rows, those not over ``memory`` days before its last one."""
    last = F.max("day").over(Window.partitionBy(key))

    def prune(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_last", last).where(F.col("day") >= F.date_sub("_last", memory)).drop("_last")

    return prune


def _per_day(
    df: DataFrame, key: str, source: str, root: str, checkpoint: str, plan: Callable[[DataFrame, DataFrame], DataFrame],
    trigger: Mapping | None, memory: int,
) -> StreamingQuery:
    """Run ``plan(batch, days known before)`` per batch, and remember the days it returns.

    Of a user the days of the last ``memory`` days before the newest one are remembered. A day before those is late: it is not emitted.
    """
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("day", T.DateType())])
    seen = Ledger(f"{root}/seen", schema, [key, "day"], by=[key], prune=_recent(key, memory))

    def work(batch: DataFrame, batch_id: int) -> None:
        known = seen.known_of(batch.select(as_col(source).alias(key)), batch_id).persist()
        last = known.groupBy(key).agg(F.date_sub(F.max("day"), memory).alias("_from"))
        days = plan(batch, known).join(last, key, "left").where("_from IS NULL OR day >= _from").drop("_from").persist()
        try:
            seen.record(days, batch_id, ["day"])
            _write(days, f"{root}/rows", batch_id)
        finally:
            days.unpersist()
            known.unpersist()

    return start_batches(df, work, checkpoint, trigger)


def login_days(
    pages: DataFrame, root: str, checkpoint: str, gap_days: int = 7, trigger: Mapping | None = None, memory: int = 400
) -> StreamingQuery:
    """Login days with the returning flag -> ``root/rows``; then ``users.login_activity``."""
    def plan(batch: DataFrame, known: DataFrame) -> DataFrame:
        return users.login_days(batch, gap_days, known)

    return _per_day(pages, "uid", "common.uid", root, checkpoint, plan, trigger, memory)


def user_firsts(
    df: DataFrame, key: str, ts: str, root: str, checkpoint: str, tiebreak=(), trigger: Mapping | None = None, memory: int = 400
) -> StreamingQuery:
    """First of the day and first ever -> ``root/rows``; then ``order_users`` or ``payment_users``."""
    def plan(batch: DataFrame, known: DataFrame) -> DataFrame:
        return trade.user_firsts(batch, key, ts, tiebreak, known)

    return _per_day(df, key, key, root, checkpoint, plan, trigger, memory)


def order_lines(changes: DataFrame, root: str, checkpoint: str, trigger: Mapping | None = None, database: str | None = None, catch_up: bool = False) -> StreamingQuery:
    """Order lines with their activity and coupon -> ``root/lines``, a new version whenever one of the three arrives.

    The three share the line's id, so one grouping holds the newest of each: a line comes out at once, with nulls for what
    is missing, and again when that arrives, however late. State is one row per line and is kept for ever. With ``catch_up`` it is
    written history instead (``streaming.history``), which every batch reads: for few and large batches.
    """
    parts = {
        "line": cdc_select(changes, "order_detail", TABLE_COLUMNS["order_detail"], database=database),
        "activity": cdc_select(changes, "order_detail_activity", ["order_detail_id", "activity_id", "activity_rule_id"], database=database),
        "coupon": cdc_select(changes, "order_detail_coupon", ["order_detail_id", "coupon_id", "coupon_use_id"], database=database),
    }
    rows = None
    for name, df in parts.items():
        columns = [F.struct("ts", *[c for c in df.columns if c not in ("ts", "order_detail_id")]).alias(name)]
        part = df.select(F.col("id" if name == "line" else "order_detail_id").alias("_id"), *columns)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    newest = [F.max(n).alias(n) for n in parts]

    def lines(groups: DataFrame) -> DataFrame:
        return groups.where("line IS NOT NULL").select(
            "line.*", "activity.activity_id", "activity.activity_rule_id", "coupon.coupon_id", "coupon.coupon_use_id")

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("line_version", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(batch_path(f"{root}/lines", batch_id))

    if catch_up:
        history = History(f"{root}/line-parts", rows.schema)

        def merge(batch: DataFrame, batch_id: int) -> None:
            history.write(batch, batch_id)
            spark = batch.sparkSession
            rows = history.read(spark, batch_id, batch_id)
            if batch_id and (past := history.read(spark, 0, batch_id - 1)):
                # Of the history only lines that the batch touches; the condition tells Spark to filter by them before the shuffle.
                new = history.read(spark, 0, batch_id).where(F.col("batch_id") == batch_id).select(F.col("_id").alias("_new"))
                rows = rows.unionByName(past.join(new, F.col("_id").eqNullSafe(F.col("_new")), "left_semi"))
            # Shuffled as it is: groups are small, so reducing them first would only sort the rows once more.
            groups = rows.repartition("_id").groupBy("_id").agg(*newest)
            work(lines(groups), batch_id)

        return _trigger(rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge), trigger).start()

    writer = lines(rows.groupBy("_id").agg(*newest)).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(work)
    return _trigger(writer, trigger).start()


ORDER_KEY = ["id", "change_ts", "type", "order_status"]


def order_wide(
    changes: DataFrame, lines: DataFrame, codes: DataFrame, root: str, checkpoint: str, trigger: Mapping | None = None,
    database: str | None = None, catch_up: bool = False,
) -> StreamingQuery:
    """Order lines with each change of their order -> upsert table ``root/wide`` (key ORDER_KEY, newest ``line_version``).

    ``lines`` is a stream of what ``order_lines`` writes. The join has no time bound; both sides stay in state, or with
    ``catch_up`` in written history. The rows of each batch
    stay in ``root/wide/batch_id=*``, for jobs that go on from the versions as a stream.
    """
    info = cdc_select(
        changes, "order_info", [c for c in TABLE_COLUMNS["order_info"] if c != "create_time"], ("insert", "update"), database,
        keep=("ts", "type", "old"),
    ).withColumnRenamed("ts", "change_ts")

    def plan(lines: DataFrame, info: DataFrame) -> DataFrame:
        return lookup(wide_join(lines, info, {"order_id": "id"}), codes, "source_type", "dic_code", {"source_name": "dic_name"})

    wide = Joined([lines, info], plan, f"{root}/joined") if catch_up else plan(lines, info)
    return write_upsert(wide, f"{root}/wide", ORDER_KEY, ["line_version"], checkpoint, trigger=trigger, retain=None)


def newest_lines(placed: DataFrame, out: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """The newest version per order line and micro-batch -> upsert table ``out``.

    Live jobs pass ``trigger={"processingTime": "5 seconds"}``. A version arriving in a later batch is written again; readers take the newest (``read_upsert``).
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, out, ["id"], trade.LINE_VERSION)

    return start_batches(placed, work, checkpoint, trigger)


def versioned_windows(
    rows: DataFrame, pk: list[str], seq: list[str], touches: list[Column], plan: Callable[[DataFrame], DataFrame], keys: list[str],
    root: str, checkpoint: str, trigger: Mapping | None = None,
) -> StreamingQuery:
    """Windows over rows of which newer versions may come at any time -> upsert table ``root/windows`` (keys ``keys``, with emission time ``ts``).

    Rows are kept by ``pk``, newest ``seq``, in ``root/rows``. A batch computes anew, by the batch plan ``plan``, just the results that its rows
    touch: ``touches`` are expressions over rows that every row of a result shares, such as its window and group. What a row touched before
    its newest version is computed anew as well.
    """
    names = [f"_t{i}" for i in range(len(touches))]

    def touched(of: DataFrame) -> DataFrame:
        return of.select(*[c.alias(n) for c, n in zip(touches, names)])

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = VersionedTable(f"{root}/rows", pk, seq)
        hit = touched(batch)
        if table.manifest(spark, batch_id - 1) is not None:
            before = table.read(spark, batch_id - 1)
            hit = hit.union(touched(before.join(batch.select(*pk).distinct(), pk, "left_semi")))
        table.commit(batch, batch_id)
        now = table.read(spark, batch_id)
        for c, n in zip(touches, names):
            now = now.withColumn(n, c)
        hit = small_side(hit.distinct().withColumnsRenamed({n: f"_h{n}" for n in names}))
        affected = now.join(hit, [F.col(n).eqNullSafe(F.col(f"_h{n}")) for n in names], "left_semi").drop(*names)
        upsert_batch(emitted(plan(affected)), batch_id, f"{root}/windows", keys, ["ts"])

    return start_batches(rows, work, checkpoint, trigger)
