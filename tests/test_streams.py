"""Streams: parity with the batch form over several files, late rows, restarts and replays."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F, types as T

from brookmart import schemas
from brookmart.functions import event_time
from brookmart.operators import bounces, first_per_day, interval_join, tumble, tumble_distinct, wide_join
from brookmart.plans import live, traffic, trade
from brookmart.session import shared_folder
from brookmart.sinks import (
    compact_upsert, ensure_dim_table, kafka_sink, read_dim_table, read_upsert, upsert_batch, write_append, write_upsert,
)
from brookmart.sinks.dims import KEYLESS, upsert_batch as upsert_dims_batch
from brookmart.sources import read_text_stream
from brookmart.streaming.dedup import first_per_day_stream
from brookmart.streaming.jobs import late_rows, run_to_end, start_batches
from brookmart.streaming.ledger import Ledger
from tests.test_operators import T0, brute_bounces, change, changes, rows, visits

LAYOUT = "mid string, ts timestamp, last string, seq int"


class Feed:
    """A folder that grows by one file per ``add``, read as a stream with one file per micro-batch."""

    def __init__(self, spark, path, layout=LAYOUT):
        self.spark, self.path, self.layout, self.n = spark, str(path), layout, 0

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.path)
        self.n += 1
        return self

    def stream(self):
        return self.spark.readStream.schema(self.layout).option("maxFilesPerTrigger", 1).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def drain(spark, df, root, name="out"):
    run_to_end(write_append(df, "parquet", f"{root}/cp-{name}", f"{root}/{name}"))
    return spark.read.schema(df.schema).parquet(f"{root}/{name}")


def at(k, s, last=None):
    return (k, s, last)


def test_first_per_day_stream_matches_days_of_batch(spark, feed, tmp_path):
    h = 3600
    feed.add(visits(spark, at("a", h), at("a", 2 * h), at("hot", 5), *[at("hot", i) for i in range(50)]))
    feed.add(visits(spark, at("a", 3 * h), at("b", 23 * h), at("hot", 24 * h)))
    feed.add(visits(spark, at("b", 25 * h), at("a", 50 * h)))
    df = feed.stream().withWatermark("ts", "2 seconds")
    for salts in (1, 8):
        got = drain(spark, first_per_day_stream(df, "mid", "ts", salts), tmp_path, f"out{salts}")
        batch = first_per_day(spark.read.schema(LAYOUT).parquet(feed.path), "mid", "ts", ["seq"])
        assert rows(got, "mid", F.to_date("ts")) == rows(batch, "mid", F.to_date("ts"))


def test_first_per_day_state_is_dropped(spark, feed, tmp_path):
    for day in range(4):
        feed.add(visits(spark, *[at(f"m{i}", day * 86400 + i) for i in range(20)]))
    df = first_per_day_stream(feed.stream().withWatermark("ts", "2 seconds"), "mid", "ts", 1)
    q = write_append(df, "parquet", str(tmp_path / "cp"), str(tmp_path / "out"))
    run_to_end(q)
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal <= 40


def test_tumble_closed_windows_and_late_rows(spark, feed, tmp_path):
    feed.add(visits(spark, at("a", 1), at("a", 9), at("b", 15)))
    feed.add(visits(spark, at("b", 30)))
    feed.add(visits(spark, at("a", 2), at("b", 31)))  # 2 s is late by now
    feed.add(visits(spark, at("z", 1000)))  # sentinel, closes the windows before it
    df = tumble(feed.stream(), "ts", "10 seconds", ["mid"], {"n": F.count("*")}, "2 seconds")
    q = write_append(df, "parquet", str(tmp_path / "cp"), str(tmp_path / "out"))
    run_to_end(q)
    got = rows(spark.read.parquet(str(tmp_path / "out")), "stt", "mid", "n")
    assert got == [("2024-01-01 00:00:00", "a", 2), ("2024-01-01 00:00:10", "b", 1), ("2024-01-01 00:00:30", "b", 2)]
    assert late_rows(q) == 1


def test_tumble_distinct_stream_equals_batch(spark, feed, tmp_path):
    feed.add(visits(spark, at("a", 1, "o1"), at("a", 2, "o1"), at("b", 3, "o1")))
    feed.add(visits(spark, at("a", 4, "o2"), at("a", 14, "o1")))
    feed.add(visits(spark, at("z", 1000, "o9")))

    def plan(df):
        return tumble_distinct(df, "ts", "10 seconds", ["mid"], "last", "orders", {"s": F.col("seq")}, "2 seconds")

    got = drain(spark, plan(feed.stream()), tmp_path)
    want = plan(spark.read.schema(LAYOUT).parquet(feed.path)).where("mid <> 'z'")
    assert rows(got, "stt", "edt", "mid", "orders", "s") == rows(want, "stt", "edt", "mid", "orders", "s")


def test_bounces_stream_over_batches(spark, feed, tmp_path):
    import random

    rnd = random.Random(5)
    events = [at(rnd.choice(["hot", "hot", "m1", "m2", "m3", "m4"]), s, rnd.choice([None, None, "p"]))
              for s in sorted(rnd.sample(range(2000), 400))]
    for i in range(0, 400, 100):
        part = events[i:i + 100]
        rnd.shuffle(part)  # disorder inside a micro-batch
        df = visits(spark, *part)
        feed.add(df)
    feed.add(visits(spark, at("z", 100_000, "end")))
    pages = feed.stream().withWatermark("ts", "5 seconds")
    for bucket in (None, "25 seconds"):
        got = drain(spark, bounces(pages, "mid", "ts", "last", "10 seconds", bucket=bucket), tmp_path, f"out{bucket}".replace(" ", ""))
        assert got.columns == ["mid", "ts", "last", "seq"]
        want = sorted((events[i][0], events[i][1]) for (i,) in brute_bounces(events, 10))
        assert rows(got, "mid", F.unix_timestamp("ts") - int(T0.timestamp())) == want


def test_interval_join_stream(spark, tmp_path):
    l = Feed(spark, tmp_path / "l", "k string, lt timestamp").add(
        spark.createDataFrame([("a", T0), ("b", T0)], "k string, lt timestamp"))
    r = Feed(spark, tmp_path / "r", "k string, rt timestamp").add(
        spark.createDataFrame([("a", T0 - timedelta(seconds=2)), ("a", T0 + timedelta(seconds=2))], "k string, rt timestamp"))
    got = drain(spark, interval_join(l.stream(), r.stream(), "k", "lt", "rt", "-2 seconds", "1 second", "0 seconds"), tmp_path)
    assert rows(got, "k", "rt") == [("a", T0 - timedelta(seconds=2))]


def test_left_wide_join_stream_emits_the_null_side_after_the_horizon(spark, tmp_path):
    l = Feed(spark, tmp_path / "l", "k string, lt timestamp")
    r = Feed(spark, tmp_path / "r", "rk string, rt timestamp, v int")
    l.add(spark.createDataFrame([("a", T0), ("b", T0), ("c", T0)], "k string, lt timestamp"))
    r.add(spark.createDataFrame([("a", T0, 1), ("b", T0 + timedelta(hours=9), 2)], "rk string, rt timestamp, v int"))
    l.add(spark.createDataFrame([("z", T0 + timedelta(days=9))], "k string, lt timestamp"))
    r.add(spark.createDataFrame([("y", T0 + timedelta(days=9), 3)], "rk string, rt timestamp, v int"))
    df = wide_join(l.stream(), r.stream(), {"k": "rk"}, "left", "lt", "rt", "1 hour", "5 seconds")
    assert rows(drain(spark, df, tmp_path), "k", "v") == [("a", 1), ("b", None), ("c", None)]
    with pytest.raises(ValueError):
        wide_join(l.stream(), r.stream(), {"k": "rk"}, "left")


def test_inner_wide_join_stream_keeps_partners_that_come_days_late(spark, tmp_path):
    l = Feed(spark, tmp_path / "l", "k string, lt timestamp")
    r = Feed(spark, tmp_path / "r", "rk string, rt timestamp, v int")
    l.add(spark.createDataFrame([("a", T0), ("b", T0)], "k string, lt timestamp"))
    r.add(spark.createDataFrame([("z", T0 + timedelta(days=90), 0)], "rk string, rt timestamp, v int"))
    r.add(spark.createDataFrame([("a", T0 + timedelta(days=40), 1), ("b", T0 - timedelta(days=40), 2)], "rk string, rt timestamp, v int"))
    df = wide_join(l.stream(), r.stream(), {"k": "rk"}, "inner", "lt", "rt")
    assert rows(drain(spark, df, tmp_path), "k", "v") == [("a", 1), ("b", 2)]


def test_order_lines_come_at_once_and_again_with_what_arrives_later(spark, tmp_path):
    layout = changes(spark).schema
    feed = Feed(spark, tmp_path / "in", layout)
    line = {"id": "1", "order_id": "o", "sku_id": "s"}
    feed.add(changes(spark, change("order_detail", "insert", line, ts=1), change("order_detail_activity", "insert", {"order_detail_id": "2", "activity_id": "x"}, ts=1)))
    feed.add(changes(spark, change("order_detail_coupon", "insert", {"order_detail_id": "1", "coupon_id": "c"}, ts=9 * 86_400_000)))
    feed.add(changes(spark, change("order_detail_activity", "insert", {"order_detail_id": "1", "activity_id": "a"}, ts=99 * 86_400_000)))
    run_to_end(live.order_lines(feed.stream(), str(tmp_path), f"{tmp_path}/cp"))
    got = spark.read.parquet(f"{tmp_path}/lines")
    assert rows(got, "line_version", "id", "activity_id", "coupon_id") == [(0, "1", None, None), (1, "1", None, "c"), (2, "1", "a", "c")]


def test_upsert_restart_and_compaction(spark, feed, tmp_path):
    table, cp = str(tmp_path / "t"), str(tmp_path / "cp")
    feed.add(visits(spark, at("a", 1, "v1"), at("a", 2, "v2"), at("b", 1, "v1")))
    run_to_end(write_upsert(feed.stream(), table, ["mid"], ["ts"], cp))
    feed.add(visits(spark, at("b", 0, "older"), at("c", 1, "v1"), at("a", 2, "again")))
    run_to_end(write_upsert(feed.stream(), table, ["mid"], ["ts"], cp))  # goes on from the checkpoint
    want = [("a", "again"), ("b", "v1"), ("c", "v1")]
    assert rows(read_upsert(spark, table, ["mid"], ["ts"]), "mid", "last") == want
    assert spark.read.parquet(table).count() == 5
    # The same batch once more replaces its own rows only.
    upsert_batch(visits(spark, at("b", 0, "older"), at("c", 1, "v1"), at("a", 2, "again")), 1, table, ["mid"], ["ts"])
    assert spark.read.parquet(table).count() == 5
    compact_upsert(spark, table, str(tmp_path / "t2"), ["mid"], ["ts"])
    assert spark.read.parquet(str(tmp_path / "t2")).count() == 3
    assert rows(read_upsert(spark, str(tmp_path / "t2"), ["mid"], ["ts"]), "mid", "last") == want


def test_update_mode_upsert_replaces_open_windows(spark, feed, tmp_path):
    feed.add(visits(spark, at("a", 1))).add(visits(spark, at("a", 2)))
    df = tumble(feed.stream(), "ts", "10 seconds", ["mid"], {"n": F.count("*")}, "2 seconds")
    run_to_end(write_upsert(df, str(tmp_path / "t"), ["stt", "mid"], ["n"], str(tmp_path / "cp"), "update"))
    assert rows(read_upsert(spark, str(tmp_path / "t"), ["stt", "mid"], ["n"]), "mid", "n") == [("a", 2)]


def test_ledger_replay(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "l"), T.StructType.fromDDL("mid string, last string"), ["mid"])
    one = visits(spark, at("a", 1, "x"), at("a", 2, "y"), at("b", 1, "x"))
    two = visits(spark, at("b", 1, "z"), at("c", 1, "x"))
    assert rows(ledger.record(one, 0, ["ts"])) == [("a", "x"), ("b", "x")]
    for _ in range(2):
        assert rows(ledger.record(two, 1, ["ts"])) == [("c", "x")]
    assert rows(ledger.matching(two, 1)) == [("b", "x"), ("c", "x")]
    assert rows(ledger.known(spark, 1)) == [("a", "x"), ("b", "x")]


def test_login_days_over_batches(spark, tmp_path):
    layout = "common struct<uid string>, page struct<last_page_id string>, ts long, et timestamp"

    def pages(*logins):
        data = [((u,), (None,), 0, T0 + timedelta(days=d)) for u, d in logins]
        return spark.createDataFrame(data, layout)

    f = Feed(spark, tmp_path / "in", layout)
    f.add(pages(("a", 0), ("a", 0.5), ("b", 1))).add(pages(("a", 9), ("b", 1.2))).add(pages(("b", 8), ("a", 9.5)))
    run_to_end(live.login_days(f.stream(), str(tmp_path / "o"), str(tmp_path / "cp")))
    got = rows(spark.read.parquet(str(tmp_path / "o/rows")), "uid", "day", "back_ct")
    assert [(u, d.day, b) for u, d, b in got] == [("a", 1, 0), ("a", 10, 1), ("b", 2, 0), ("b", 9, 0)]


def test_user_firsts_over_batches(spark, feed, tmp_path):
    d = 86400
    feed.add(visits(spark, at("a", 5), at("a", 6), at("b", 5))).add(visits(spark, at("a", 7), at("a", d), at("c", d)))
    run_to_end(live.user_firsts(feed.stream(), "mid", "ts", str(tmp_path / "o"), str(tmp_path / "cp"), ["seq"]))
    got = rows(spark.read.parquet(str(tmp_path / "o/rows")), "mid", "day", "new_ct")
    assert [(u, t.day, n) for u, t, n in got] == [("a", 1, 1), ("a", 2, 0), ("b", 1, 1), ("c", 2, 1)]


def test_log_split_over_batches(spark, tmp_path):
    def logs(*texts):
        return spark.createDataFrame([(t,) for t in texts], "value string")

    def log(mid, new, day, extra=""):
        ts = int((T0 + timedelta(days=day)).timestamp() * 1000)
        return f'{{"common":{{"mid":"{mid}","is_new":"{new}"}},"page":{{"page_id":"p"}}{extra},"ts":{ts}}}'

    f = Feed(spark, tmp_path / "in", "value string")
    f.add(logs(log("a", 1, 0), log("b", 0, 0), "broken {")).add(logs(log("a", 1, 1), log("b", 1, 0), log("c", 1, 1, ',"display":[{"item":"7"}]')))
    root = str(tmp_path / "o")
    run_to_end(live.log_split(f.stream(), root, str(tmp_path / "cp")))
    out = spark.read.parquet(f"{root}/logs")
    got = rows(out.where("kind = 'page'"), "common.mid", F.to_date(event_time("ts")), "common.is_new")
    assert [(m, d.day, n) for m, d, n in got] == [("a", 1, "1"), ("a", 2, "0"), ("b", 1, "0"), ("b", 1, "0"), ("c", 2, "1")]
    assert out.where("kind = 'display'").count() == 1
    assert rows(spark.read.parquet(f"{root}/dirty"), "value") == [("broken {",)]


def test_newest_lines_stream(spark, tmp_path):
    layout = "id string, " + ", ".join(f"{c} {'long' if c in ('ts', 'change_ts') else 'string'}" for c in trade.LINE_VERSION)
    columns = ["id", *trade.LINE_VERSION]

    def lines(*versions):
        data = [tuple({"id": i, "change_ts": v, "sku_id": s}.get(c) for c in columns) for i, v, s in versions]
        return spark.createDataFrame(data, layout)

    f = Feed(spark, tmp_path / "in", layout)
    f.add(lines(("1", 1, "a"), ("1", 2, "b"), ("2", 1, "a"))).add(lines(("2", 3, "c")))
    run_to_end(live.newest_lines(f.stream(), str(tmp_path / "o"), str(tmp_path / "cp")))
    assert rows(read_upsert(spark, str(tmp_path / "o"), ["id"], trade.LINE_VERSION), "id", "sku_id") == [("1", "b"), ("2", "c")]


def test_traffic_over_three_streams(spark, tmp_path):
    def pages(*at):
        ts = [int((T0 + timedelta(seconds=s)).timestamp() * 1000) for _, s, _ in at]
        return spark.createDataFrame(
            [((None,) * 2 + ("c",) + ("1", None, m, None, "u", "v"), (100, last, "p", None, None), t)
             for (m, _, last), t in zip(at, ts)], schemas.PAGE_LOG)

    f = Feed(spark, tmp_path / "in", schemas.PAGE_LOG)
    f.add(pages(("a", 1, None), ("a", 3, "home"), ("b", 2, None)))
    f.add(pages(("b", 30, None), ("b", 31, "x")))
    f.add(pages(("end", 9000, "x")))

    def stream():
        return traffic.with_event_time(f.stream())

    marked = traffic.with_event_time(f.stream(), "5 seconds")
    root = str(tmp_path)
    visits_ = traffic.unique_visits(marked)
    bounced = traffic.bounce_visits(marked, "10 seconds")
    for name, df in (("uv", visits_), ("uj", bounced)):
        drain(spark, df, root, name)
    uv, uj = (spark.readStream.schema(df.schema).parquet(f"{root}/{n}") for n, df in (("uv", visits_), ("uj", bounced)))
    # Visits and bounces stand still at the end; heartbeats tell that nothing older will come.
    beats = Feed(spark, tmp_path / "beats", "et timestamp").add(spark.createDataFrame([(T0 + timedelta(seconds=9000),)], "et timestamp"))
    out = drain(spark, traffic.traffic_by_segment(stream(), uv, uj, heartbeats={"visits": beats.stream(), "bounced": beats.stream()}), root, "out")
    idle = drain(spark, traffic.traffic_by_segment(stream(), uv, uj), root, "idle")
    batch = traffic.with_event_time(spark.read.schema(schemas.PAGE_LOG).parquet(f.path))
    want = traffic.traffic_by_segment(batch, traffic.unique_visits(batch), traffic.bounce_visits(batch))
    columns = ["stt", *traffic.TRAFFIC]
    want = [r for r in rows(want, *columns) if r[0] < "2024-01-01 01:00:00"]
    got = rows(out, *columns)
    assert [r[0] for r in want] == ["2024-01-01 00:00:00", "2024-01-01 00:00:30"]
    assert got == want
    # Without them the watermark waits for the slowest input, and windows stay open.
    assert len(rows(idle, *columns)) < len(want)


def test_dims_of_several_batches(spark, tmp_path):
    root = str(tmp_path / "dims")
    config = spark.createDataFrame([("user", "dim_user", "id,name", None, None)], schemas.ROUTE)
    ensure_dim_table(spark, root, "dim_user")
    ensure_dim_table(spark, root, "dim_user")
    assert rows(read_dim_table(spark, root, "dim_user", ["id", "name"])) == []
    upsert_dims_batch(changes(spark, change("user", "insert", {"id": "1", "name": "x"}, ts=5),
                              change("user", "insert", {"id": "2", "name": "y"}, ts=5)), config, 0, root)
    upsert_dims_batch(changes(spark, change("user", "update", {"id": "1", "name": "z"}, {"name": "x"}, ts=6),
                              change("user", "update", {"id": "2", "name": "old"}, ts=4)), config, 1, root)
    assert rows(read_dim_table(spark, root, "dim_user", ["id", "name"])) == [("1", "z"), ("2", "y")]


def test_dims_create_configured_tables_and_keep_rows_without_key(spark, tmp_path):
    root = str(tmp_path / "dims")
    config = spark.createDataFrame(
        [("user", "dim_user", "id,name", None, None), ("sku", "dim_sku", "id", None, None)], schemas.ROUTE)
    upsert_dims_batch(changes(spark, change("user", "insert", {"name": "x"}), change("user", "insert", {"name": "y"}),
                              change("user", "insert", {"id": "1", "name": "z"})), config, 0, root)
    assert rows(read_dim_table(spark, root, "dim_user", ["id", "name"])) == [("1", "z")]
    assert read_dim_table(spark, root, "dim_sku", ["id"]).count() == 0
    kept = spark.read.parquet(root).where(F.col("sink_table") == KEYLESS)
    assert rows(kept, F.col("data")["name"]) == [("x",), ("y",)]


def test_text_stream_and_json_append(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("one\ntwo\n")
    df = read_text_stream(spark, "text", {}, str(tmp_path / "in"))
    run_to_end(write_append(df, "text", str(tmp_path / "cp"), str(tmp_path / "o"), as_json=True))
    assert rows(spark.read.text(str(tmp_path / "o"))) == [('{"value":"one"}',), ('{"value":"two"}',)]
    assert kafka_sink("b:1", "t", acks="all") == {"kafka.bootstrap.servers": "b:1", "topic": "t", "acks": "all"}


def test_batches_are_persisted_while_they_run(spark, feed, tmp_path):
    feed.add(visits(spark, at("a", 1)))
    seen = []

    def work(batch, batch_id):
        seen.append((batch_id, batch.is_cached, batch.count()))

    run_to_end(start_batches(feed.stream(), work, str(tmp_path / "cp")))
    assert seen == [(0, True, 1)]


def test_jdbc_sink_options_and_columns(spark, monkeypatch):
    from brookmart.sinks import jdbc

    assert jdbc.jdbc_options("jdbc:x", "t")["batchsize"] == "1000"
    df = spark.createDataFrame([(1, 2, 3)], "b int, helper int, a int")
    with pytest.raises(Exception) as e:  # no such driver here; the columns are resolved before that
        jdbc.write_jdbc_batch(df, jdbc.jdbc_options("jdbc:none:", "t"), ["missing"])
    assert "missing" in str(e.value)


def test_shared_folder_is_below_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(base + "/x-")


def test_login_windows_run_on_a_stream(spark, monkeypatch):
    from brookmart.registry import streams

    seen, windows = [], streams._windows
    monkeypatch.setattr(streams, "_windows", lambda s, df, *rest: seen.append(df.isStreaming) or windows(s, df, *rest))
    assert streams.live_login_activity(spark, "/root/testdata/sf0.001").count() > 0 and seen == [True]
