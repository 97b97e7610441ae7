"""What a run leaves and shuffles: consumed folders, history that meets nothing new, keys that come once."""

import pytest
from pyspark.sql import functions as F

from brookmart.plans import live
from brookmart.registry import batch, streams
from brookmart.sinks import versions
from brookmart.sinks.files import children
from brookmart.sinks.versions import VersionedTable
from brookmart.streaming.history import Joined
from brookmart.streaming.jobs import start_batches

SF = "/root/testdata/sf0.001"


def _stream(spark, path, batches):
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_the_order_chain_leaves_only_what_others_read(spark):
    with streams._stream_session(spark, SF):
        root = streams._order_chain(spark, SF)
    left = children(spark, root)
    assert "wide" in left and not [n for n in left if n.startswith("topic") or n in ("line-parts", "lines", "joined")]


def test_streams_drop_what_a_micro_batch_has_shuffled(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with streams._stream_session(spark, SF):
        assert spark.conf.get(name) == "true" and spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"
    assert spark.conf.get(name) == before


def test_written_history_is_filtered_by_what_is_new(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "MET", 1)
    side = lambda n, first: [spark.range(first + i * 100, first + i * 100 + 100).selectExpr(f"id AS {n}", f"id * 2 AS {n}_row") for i in range(3)]
    sides = [_stream(spark, f"{tmp_path}/a", side("a", 0)), _stream(spark, f"{tmp_path}/b", side("b", 50))]
    out, plans = [], []

    def work(rows, n):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        out.extend(tuple(r) for r in rows.collect())

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with streams._stream_session(spark, SF):
            start_batches(Joined(sides, lambda a, b: a.join(b, F.col("a") == F.col("b")), f"{tmp_path}/run"), work, f"{tmp_path}/cp").awaitTermination()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(out) == [(i, i * 2, i, i * 2) for i in range(50, 300)]
    assert "might_contain" in plans[-1]


def test_lines_of_a_backlog_come_again_with_late_parts_only(spark, tmp_path):
    def change(table, **data):
        pairs = ", ".join(f"'{k}', {'cast(null AS string)' if v is None else repr(v)}" for k, v in data.items())
        return f"SELECT 'shop' AS database, '{table}' AS `table`, 'insert' AS type, 1L AS ts, map({pairs}) AS data"

    batches = [
        [change("order_detail", id="a", order_id="1"), change("order_detail", id="b", order_id="1"), change("order_detail", id=None, order_id="9")],
        [change("order_detail_coupon", order_detail_id="a", coupon_id="c"), change("order_detail", id="d", order_id="2")],
        [change("order_detail_activity", order_detail_id="a", activity_id="x"), change("order_detail_activity", order_detail_id=None, activity_id="n")],
    ]
    changes = _stream(spark, f"{tmp_path}/in", [spark.sql(" UNION ALL ".join(b)) for b in batches])
    live.order_lines(changes, str(tmp_path), f"{tmp_path}/cp", catch_up=True).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/lines").select("line_version", "id", "activity_id", "coupon_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        (0, "a", None, None), (0, "b", None, None), (0, None, None, None), (1, "a", None, "c"), (1, "d", None, None),
        (2, "a", "x", "c"), (2, None, "n", None)]))


def test_only_keys_that_come_again_are_shuffled_whole(spark, tmp_path, monkeypatch):
    table = VersionedTable(str(tmp_path), ["k", "n"], ["v"], reduced=False)
    rows = spark.range(1_000).selectExpr("id AS k", "if(id % 3 = 0, null, id % 5) AS n", "1L AS v", "cast(id AS string) AS text")
    table.commit(rows, 0)
    table.commit(rows.where("k < 10").withColumn("v", F.lit(2).cast("long")).withColumn("text", F.lit("new")), 1)
    want = sorted(map(str, table.read(spark).collect()))
    assert len(want) == 1_000
    for more in (versions.MORE, 3):  # 3: too many to tell apart, all are shuffled
        monkeypatch.setattr(versions, "WHOLE", 0)
        monkeypatch.setattr(versions, "MORE", more)
        read = table.read(spark)
        assert sorted(map(str, read.collect())) == want
        assert ("LeftAnti" in read._jdf.queryExecution().optimizedPlan().toString()) == (more > 3)
    once = VersionedTable(f"{tmp_path}/once", ["k"], ["v"], reduced=False)
    once.commit(rows, 0)
    monkeypatch.setattr(versions, "MORE", 100)
    plan = once.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and once.read(spark).count() == 1_000


def test_a_large_topic_is_written_one_micro_batch_after_the_other(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 9_000).select("id", (F.col("id") * 60_000).alias("ts"))
    monkeypatch.setattr(streams, "AT_ONCE", 100)
    shuffled = []
    whole = type(rows).repartitionById
    monkeypatch.setattr(type(rows), "repartitionById", lambda df, *a: shuffled.append(a[0]) or whole(df, *a))
    topic, spans = streams._topic(spark, rows, str(tmp_path), "t", per_file=500), []
    topic.writeStream.foreachBatch(lambda b, n: spans.append(tuple(b.agg(F.count("*"), F.min("id"), F.max("id")).first()))).trigger(
        availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start().awaitTermination()
    assert shuffled == [6] * streams.FILES and len(spark.read.parquet(f"{tmp_path}/topic-t").inputFiles()) == 18
    assert len(spans) == streams.FILES and sum(n for n, _, _ in spans) == 9_000 and all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_stream_queries_leave_no_topic_or_state(spark, tmp_path, monkeypatch):
    for name in ("live_sku_order_lines", "live_registrations"):
        monkeypatch.setattr(streams, "shared_folder", lambda s, purpose: f"{tmp_path}/{name}")
        assert streams.STREAMS[name](spark, SF).count() > 0
        assert children(spark, f"{tmp_path}/{name}") == ["windows"]


@pytest.mark.parametrize("name", [
    "order_wide", "orders_placed", "orders_cancelled", "refund_requests_wide", "refunds_paid_wide", "sku_orders", "sku_orders_dedup"])
def test_wide_queries_of_many_lines_by_parts_of_the_orders(spark, name, tmp_path, monkeypatch):
    text = lambda df: sorted(map(str, df.collect()))
    whole = batch.BATCH[name](spark, SF)
    want = text(whole)
    monkeypatch.setattr(batch, "LINES_AT_ONCE", 2_500)
    monkeypatch.setattr(batch, "shared_folder", lambda s, purpose: f"{tmp_path}/{purpose}")
    settings = {n: spark.conf.get(n, None) for n in batch.WRITTEN}
    got = batch.BATCH[name](spark, SF)
    assert children(spark, f"{tmp_path}/by-orders") == ["rows"] and len(children(spark, f"{tmp_path}/by-orders/rows")) == 3
    assert got.columns == whole.columns and text(got) == want and len(want) > 0
    assert {n: spark.conf.get(n, None) for n in batch.WRITTEN} == settings
