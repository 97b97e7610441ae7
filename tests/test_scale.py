"""What held on small tables only: the session's state store, files of a topic, sums past 64 bits."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as driver
from brookmart import samples
from brookmart.operators import latest_config, route_dims
from brookmart.plans import trade
from brookmart.registry import streams
from brookmart.registry.batch import changes_by_table
from brookmart.sinks import dims, read_dim_table
from brookmart.sinks.files import exists
from brookmart.streaming.history import Joined
from brookmart.streaming.jobs import start_batches

SF = "/root/testdata/sf0.001"
HDFS_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def test_stream_queries_bring_their_state_store(spark):
    before = spark.conf.get(streams.STATE_STORE)
    spark.conf.set(streams.STATE_STORE, HDFS_STORE)
    try:
        got = driver.queries()["live_bounce_visits"](spark, SF).count()
        assert spark.conf.get(streams.STATE_STORE) == HDFS_STORE
    finally:
        spark.conf.set(streams.STATE_STORE, before)
    assert got == driver.queries()["bounce_visits"](spark, SF).count() > 0


def test_a_topic_has_more_files_for_more_rows_in_the_same_batches(spark, tmp_path):
    rows = spark.range(0, 9_000).select("id", (F.col("id") * 60_000).alias("ts"))
    topic = streams._topic(spark, rows, str(tmp_path), "t", per_file=500)
    files = spark.read.parquet(f"{tmp_path}/topic-t").groupBy(F.input_file_name()).count()
    assert files.count() == 18 and files.agg(F.max("count")).first()[0] < 1_000
    sizes = []
    query = topic.writeStream.foreachBatch(lambda b, n: sizes.append((b.count(), b.agg(F.min("id"), F.max("id")).first()))).trigger(
        availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    query.awaitTermination()
    assert len(sizes) == streams.FILES and sum(n for n, _ in sizes) == 9_000
    assert all(a[1] < b[0] for (_, a), (_, b) in zip(sizes, sizes[1:]))


def test_a_topic_of_long_texts_has_files_by_their_bytes(spark, tmp_path):
    rows = spark.range(0, 600).selectExpr("id", "id * 60000 AS ts", "repeat('word ', 20000) AS text")
    streams._topic(spark, rows, str(tmp_path), "t", long="text")
    assert len(spark.read.parquet(f"{tmp_path}/topic-t").inputFiles()) > streams.FILES


def test_order_chain_keeps_no_state_store(spark):
    """Every line and change of a backlog in a state store took most of the time."""
    root = streams._order_chain(spark, SF)
    for name in ("lines", "wide"):
        assert exists(spark, f"{root}/checkpoint-{name}/commits") and not exists(spark, f"{root}/checkpoint-{name}/state")


def test_joined_streams_give_each_pair_once(spark, tmp_path):
    def side(name, value):  # keys of one micro-batch come in other ones on the other side; the last have no partner there
        for n in range(3):
            rows = spark.range(n * 10, n * 10 + 10).selectExpr(f"(id * {value}) % 30 AS {name}", f"id AS {name}_row")
            rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")

    sides, out = [side("a", 7), side("b", 2), side("c", 11)], []
    plan = lambda a, b, c: a.join(b, F.col("a") == F.col("b")).join(c, F.col("a") == F.col("c"))
    start_batches(Joined(sides, plan, f"{tmp_path}/run"), lambda rows, n: out.append([tuple(r) for r in rows.collect()]), f"{tmp_path}/cp").awaitTermination()
    want = [tuple(r) for r in plan(*[spark.read.parquet(f"{tmp_path}/{n}") for n in "abc"]).collect()]
    assert len(out) == 3 and sorted(sum(out, [])) == sorted(want) and len(want) > 20


def test_newest_lines_are_not_shuffled_again_after_their_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = driver.queries()["newest_order_lines"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 5


def test_sums_of_times_past_64_bits(spark, tmp_path):
    for name, layout in samples.LAYOUT.items():
        spark.createDataFrame([], layout).write.parquet(f"{tmp_path}/{name}.parquet")
    line = {"l_orderkey": "id", "l_linenumber": "1", "l_shipdate": "TIMESTAMP_NTZ'9999-01-01 00:00:00'"}
    columns = [c.split() for c in samples.LAYOUT["lineitem"].split(", ")]
    for n, kind in ((40_000, "decimal(29,0)"), (4, "bigint")):
        spark.range(n).selectExpr(*[f"cast({line.get(c, 'null')} as {t}) AS {c}" for c, t in columns]).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
        got = changes_by_table(spark, str(tmp_path))
        sums = {r["table"]: int(r["ts_sum"]) for r in got.collect()}
        assert sums["order_detail"] == n * 253_370_764_800_000
        assert dict(got.dtypes)["ts_sum"] == kind


def test_a_stream_between_jobs_has_files_in_order_of_time(spark, tmp_path):
    rows = spark.range(0, 6_000).select("id", (F.col("id") * 60_000).alias("ts"))
    topic = streams._topic(spark, rows, str(tmp_path), "t").withColumn("et", F.timestamp_millis("ts"))
    again = streams._restream(spark, topic, str(tmp_path), "again", per_file=500)
    spans = []
    again.writeStream.foreachBatch(lambda b, n: spans.append(tuple(b.agg(F.count("*"), F.min("id"), F.max("id")).first()))).trigger(
        availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start().awaitTermination()
    assert sum(n for n, _, _ in spans) == 6_000
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
    assert len(spark.read.parquet(f"{tmp_path}/again/batch_id=*").inputFiles()) >= 12


def test_one_dimension_table_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).selectExpr("'dim' AS sink_table", "cast(id AS string) AS pk", "map('id', cast(id AS string)) AS data", "id AS ts")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a stream; small partitions are not joined then
    try:
        dims._table(str(tmp_path)).commit(rows.select("pk", "data", "ts", "sink_table"), 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(spark.read.parquet(f"{tmp_path}/batch_id=0").inputFiles()) > 1
    assert read_dim_table(spark, str(tmp_path), "dim", ["id"]).count() == 400


def test_changes_are_routed_without_a_shuffle_by_table(spark):
    changes = samples.changes(samples.reader(spark, SF), "user_info", "sku_info")
    stored = latest_config(samples.config_events(spark, SF))
    config = spark.createDataFrame([tuple(r) for r in stored.collect()], stored.schema)  # of unknown size, as in a micro-batch
    routed = route_dims(changes, config)
    assert "Exchange hashpartitioning" not in routed._jdf.queryExecution().executedPlan().toString()
    assert routed.count() == route_dims(changes, stored).count() > 0


def test_a_topic_of_few_large_rows_keeps_its_micro_batches_apart(spark, tmp_path):
    """Rows dealt to files by a hash may leave a file empty; then the next file would begin another micro-batch."""
    rows = spark.range(0, 12).select("id", (F.col("id") * 60_000).alias("ts"))
    topic, spans = streams._topic(spark, rows, str(tmp_path), "t", per_file=1), []
    topic.writeStream.foreachBatch(lambda b, n: spans.append(tuple(b.agg(F.count("*"), F.min("id"), F.max("id")).first()))).trigger(
        availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start().awaitTermination()
    assert sum(n for n, _, _ in spans) == 12 and all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_topics_are_cut_without_samples_of_their_rows(spark, tmp_path, monkeypatch):
    def ranges(*_):
        raise AssertionError("ranges make every row twice")

    rows = spark.range(0, 3_000).select("id", (F.col("id") * 60_000).alias("ts"))
    monkeypatch.setattr(type(rows), "repartitionByRange", ranges)
    streams._topic(spark, rows, str(tmp_path), "t", per_file=500)
    assert spark.read.parquet(f"{tmp_path}/topic-t").count() == 3_000


def test_micro_batches_of_line_versions_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    spark.range(400).selectExpr("id", "'insert' AS type", "null AS old").repartition(40).write.parquet(f"{tmp_path}/wide/batch_id=0")
    monkeypatch.setattr(streams, "_order_chain", lambda s, d: str(tmp_path))
    sizes = []
    streams._placed(spark, SF).writeStream.foreachBatch(lambda b, n: sizes.append(b.count())).trigger(
        availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start().awaitTermination()
    assert len(sizes) == streams.FILES and sum(sizes) == 400


def _changes_of(spark, table, rows):
    data = ", ".join(f"('{table}', 'insert', {n}L, map({', '.join(repr(x) if x else 'null' for kv in r.items() for x in kv)}))" for n, r in enumerate(rows))
    return spark.sql(f"SELECT 'shop' AS database, `table`, type, ts, cast(data AS map<string,string>) AS data, cast(null AS map<string,string>) AS old FROM VALUES {data} AS t(`table`, type, ts, data)")


def test_lines_by_order_are_those_joined_by_line(spark):
    line = lambda i, o, sku="s": {"id": i, "order_id": o, "sku_id": sku, "source_type": "2401"}
    changes = _changes_of(spark, "order_detail", [line("a", "1"), line("a", "1"), line("a", "2", "t"), line("b", "1"), line("c", "2"), line(None, "2"), line("d", None)])
    for table, ids in (("order_detail_activity", ["a", "a", "b", "d", None, "x"]), ("order_detail_coupon", ["a", "c", "a", None])):
        key = "activity_id" if table.endswith("activity") else "coupon_id"
        changes = changes.unionByName(_changes_of(spark, table, [{"order_detail_id": i, key: None if n == 1 else f"{n}"} for n, i in enumerate(ids)]))
    changes = changes.unionByName(_changes_of(spark, "order_info", [{"id": o, "user_id": "u"} for o in ("1", "1", "2", None)]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = trade.order_wide(changes, samples.codes(spark))
        wanted = spark.sql("SELECT * FROM VALUES ('1', 's'), ('1', 's'), ('2', 't'), (null, 's') AS t(order_id, sku_id)")
        text = lambda df: sorted(str(r) for r in df.collect())
        got = trade.order_wide(changes, samples.codes(spark), lines_by_order=True)
        assert got.columns == plain.columns and text(got) == text(plain) and len(text(got)) > 10
        some = trade.order_wide(changes, samples.codes(spark), lines_by_order=True, among=wanted)
        assert text(some) == text(plain.where("(order_id = '1' AND sku_id = 's') OR (order_id = '2' AND sku_id = 't')"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_lines_are_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {n: driver.queries()[n](spark, SF)._jdf.queryExecution().executedPlan().toString()
                 for n in ("orders_placed", "payments_succeeded", "refund_requests_wide", "refunds_paid_wide")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name, plan in plans.items():  # the lines and the pairs of order and line; nothing by order and another column
        assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", plan)) == 2, name
        assert not re.search(r"Exchange hashpartitioning\(order_id#\d+, [a-z_]+#", plan), name
