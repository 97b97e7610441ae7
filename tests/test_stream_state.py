"""Operators with state between batches: ties, arrival order, versions, and what is left in state."""

import itertools
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from brookmart.operators import bounces, first_per_day, latest_by_key, lookup_as_of, tumble
from brookmart.plans import live, trade
from brookmart.sinks import read_upsert, write_append
from brookmart.streaming import LateRows, earliest_per_day_stream
from brookmart.streaming.jobs import run_to_end
from tests.test_operators import T0, rows, visits
from tests.test_streams import Feed, at, drain


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def test_bounces_of_equal_times_do_not_depend_on_arrival(spark, tmp_path):
    # Two starts and a following page at one time: their order is told by seq alone.
    data = [("a", 5, None, 1), ("a", 5, "p", 2), ("a", 5, None, 3), ("b", 5, None, 2), ("b", 5, None, 1), ("b", 5, "p", 3), ("c", 5, None, None), ("c", 5, "p", 1)]
    data = [(k, T0 + timedelta(seconds=s), last, seq) for k, s, last, seq in data]
    want = rows(bounces(spark.createDataFrame(data, "mid string, ts timestamp, last string, seq int"), "mid", "ts", "last", tiebreak=["seq"]), "mid", "seq")
    assert want == [("a", 3), ("b", 1)]
    for n, order in enumerate(itertools.islice(itertools.permutations(data), 0, 40_000, 9_973)):
        f = Feed(spark, tmp_path / f"in{n}")
        for part in (order[:3], order[3:6], order[6:]):
            f.add(spark.createDataFrame(part, f.layout))
        f.add(visits(spark, at("z", 100_000, "end")))
        q = write_append(bounces(f.stream().withWatermark("ts", "5 seconds"), "mid", "ts", "last", tiebreak=["seq"]), "parquet", str(tmp_path / f"cp{n}"), str(tmp_path / f"o{n}"))
        run_to_end(q)
        assert rows(spark.read.parquet(str(tmp_path / f"o{n}")), "mid", "seq") == want


def test_the_earliest_of_the_day_whatever_comes_first(spark, feed, tmp_path):
    h = 3600
    feed.add(visits(spark, at("a", 5 * h, "late"), at("b", h, "first")))
    feed.add(visits(spark, at("a", 2 * h, "early"), at("b", 3 * h), at("b", 30 * h, "next day")))
    feed.add(visits(spark, at("z", 1000 * h)))
    df = earliest_per_day_stream(feed.stream().withWatermark("ts", "1 day"), "mid", "ts", ["seq"])
    q = write_append(df, "parquet", str(tmp_path / "cp"), str(tmp_path / "o"))
    run_to_end(q)
    want = first_per_day(spark.read.schema(feed.layout).parquet(feed.path), "mid", "ts", ["seq"]).where("mid <> 'z'")
    assert rows(spark.read.schema(feed.layout).parquet(str(tmp_path / "o"))) == rows(want)
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal == 1  # the day of the last row


LINES = "id string, order_id string, sku_id string, create_time string, change_ts long"


def lines(spark, *data):
    return spark.createDataFrame([(str(i), o, s, f"2024-01-{d:02} 00:00:00", v) for i, o, s, d, v in data], LINES)


def test_the_earliest_line_is_let_out_once_and_state_is_dropped(spark, tmp_path):
    f = Feed(spark, tmp_path / "in", LINES)
    f.add(lines(spark, (1, "o1", "s", 5, 0), (2, "o2", "s", 3, 0)))
    f.add(lines(spark, (3, "o1", "s", 4, 0), (4, "o1", "t", 6, 0), (5, "o2", "s", 3, 0)))
    f.add(lines(spark, (6, "o1", "s", 6, 0)))
    f.add(lines(spark, (9, "end", "s", 31, 0)))
    q = write_append(trade.earliest_lines(f.stream(), "2 days", "3 days"), "parquet", str(tmp_path / "cp"), str(tmp_path / "o"))
    run_to_end(q)
    assert rows(spark.read.parquet(str(tmp_path / "o")), "order_id", "sku_id", "id") == [("o1", "s", "3"), ("o1", "t", "4"), ("o2", "s", "2")]
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal == 1  # that of the closing line


def test_windows_follow_the_newest_versions(spark, tmp_path):
    f = Feed(spark, tmp_path / "in", LINES)
    f.add(lines(spark, (1, "o1", "s", 5, 1), (2, "o2", "s", 5, 1), (3, "o3", "t", 5, 1)))
    f.add(lines(spark, (1, "o1", "u", 5, 2), (3, "o3", "t", 5, 0)))  # a line moves to another SKU, an older version comes late
    f.add(lines(spark, (4, "o4", "t", 9, 1), (2, "o5", "s", 5, 3)))

    def plan(df):
        return tumble(df.withColumn("et", trade.parse_time("create_time")), "et", "1 day", ["sku_id"], {"n": F.count("*"), "orders": F.max("order_id")})

    touches = [F.window(trade.parse_time("create_time"), "1 day")["start"], F.col("sku_id")]
    run_to_end(live.versioned_windows(f.stream(), ["id"], ["change_ts"], touches, plan, ["stt", "sku_id"], str(tmp_path / "o"), str(tmp_path / "cp")))
    got = read_upsert(spark, str(tmp_path / "o/windows"), ["stt", "sku_id"], ["ts"])
    assert got.where("ts IS NULL").count() == 0
    want = rows(plan(latest_by_key(spark.read.schema(LINES).parquet(f.path), "id", ["change_ts"])), "stt", "sku_id", "n", "orders")
    assert rows(got, "stt", "sku_id", "n", "orders") == want


def test_late_rows_are_counted_over_all_batches(spark, feed, tmp_path):
    feed.add(visits(spark, at("a", 10_000)))
    for n in range(30):
        feed.add(visits(spark, *[at("late", i) for i in range(1 + n % 3)], at("a", 10_000 + n)))
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    listener = LateRows(spark, str(tmp_path / "late"))
    spark.streams.addListener(listener)
    try:
        df = tumble(feed.stream(), "ts", "10 seconds", [], {"n": F.count("*")}, "2 seconds")
        q = write_append(df, "parquet", str(tmp_path / "cp"), str(tmp_path / "o"))
        run_to_end(q)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert len(q.recentProgress) <= 5
        # Late rows are dropped once they are reduced to one for each window and task: one a batch here. Rows are late by the
        # watermark of the batch before, so those of the first batch of late rows are still counted in their window.
        kept = spark.read.parquet(str(tmp_path / "o")).where("stt = '2024-01-01 00:00:00'")
        assert rows(kept, "n") == [(1,)] and listener.total(q.id) == 30 - 1
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_lookup_as_of(spark):
    facts = spark.createDataFrame([("x", 0), ("x", 5), ("x", 9), ("x", 10), ("y", 3), ("none", 3), (None, 3), ("x", None)], "code string, t long")
    history = spark.createDataFrame([("x", "one", 1), ("x", "two", 10), ("x", "b", 5), ("x", "a", 5), ("y", "late", 4), ("y", None, 0), ("x", "lost", None)], "k string, name string, f long")
    got = lookup_as_of(facts, history, "code", "t", "k", "f", {"name": "name"})
    assert rows(got) == [("x", 5, "b"), ("x", 9, "b"), ("x", 10, "two"), ("y", 3, None)]
    left = lookup_as_of(facts, history, "code", "t", "k", "f", {"name": "name"}, "left")
    assert left.count() == 8 and left.where("name IS NULL").count() == 5
    assert lookup_as_of(facts, history.where("false"), "code", "t", "k", "f", {"name": "name"}).count() == 0
