"""Edge cases of the operators, on hand-written rows and against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from brookmart import schemas
from brookmart.functions import (
    camel_case, camel_case_columns, datetime_text, day_text, event_time, millis_of, seconds_of, tokenize,
)
from brookmart.operators import (
    Step, bounces, cdc_increase, cdc_select, cdc_transition, enrich, enrich_chain, first_by, first_ever, first_per_day,
    interval_join, latest_by_key, latest_config, log_rows, lookup, parse_or_drop, parse_or_fail, parse_or_quarantine,
    repair_is_new, returning_users, route_dims, split_log, tumble, tumble_distinct, wide_join,
)
from brookmart.operators.joins import estimated_bytes, small_side
from brookmart.sources import kafka_source, read_changes, read_delimited, read_dim, read_text
from brookmart.plans import refunds, trade, traffic, users

T0 = datetime(2024, 1, 1)


def rows(df, *columns):
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: [(x is None, x) for x in r])


def change(table, kind, data, old=None, ts=0, database="shop"):
    return (database, table, kind, ts, data, old)


def changes(spark, *events):
    return spark.createDataFrame(list(events), schemas.CHANGE_EVENT)


# ---- functions ---------------------------------------------------------------------------------

def test_dates(spark):
    df = spark.createDataFrame([("2024-03-01 10:20:30",), ("2024-03-01",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(millis_of("s")).collect()]
    assert got == [1709288430000, 1709251200000, None, None]
    df = spark.createDataFrame([(1709288430123,)], "ts long")
    assert tuple(df.select(day_text("ts"), datetime_text("ts")).first()) == ("2024-03-01", "2024-03-01 10:20:30")
    assert df.select(F.unix_millis(event_time("ts"))).first()[0] == 1709288430123
    assert [seconds_of(x) for x in ("10 seconds", "1 hour", "-2 seconds", "1 day")] == [10, 3600, -2, 86400]
    with pytest.raises(ValueError):
        seconds_of("soon")


def test_camel_case(spark):
    assert camel_case("ORDER_unique_USER_count") == "orderUniqueUserCount"
    assert camel_case_columns(spark.range(1).toDF("uv_ct")).columns == ["uvCt"]


def test_tokenize(spark):
    df = spark.createDataFrame([(1, "Red CAR, blue-car 42"), (2, ""), (3, None), (4, "Été")], "id int, s string")
    assert rows(tokenize(df, "s"), "id", "keyword") == [(1, "42"), (1, "blue"), (1, "car"), (1, "car"), (1, "red"), (4, "été")]


def test_tokenize_with_segmenter_emits_the_text_on_error(spark):
    def halves(text):
        if "!" in text:
            raise ValueError
        return [text[:2], text[2:]]

    df = spark.createDataFrame([(1, "ABcd"), (2, "no!"), (3, None)], "id int, s string")
    assert rows(tokenize(df, "s", segmenter=halves), "id", "keyword") == [(1, "ab"), (1, "cd"), (2, "no!")]


# ---- sources and parsing -----------------------------------------------------------------------

def test_parse_good_and_bad(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), (None,), ("{}",), ('{"a": "x"}',)], "value string")
    good, bad = parse_or_quarantine(df, schema)
    assert rows(good) == [(1,), (None,)]
    assert set(rows(bad)) == {('{"a": ',), ('{"a": "x"}',)}
    assert parse_or_drop(df, schema).count() == 2
    with pytest.raises(Exception):
        parse_or_fail(df, schema).collect()


def test_read_changes_takes_ts_as_number_or_text(spark):
    df = spark.createDataFrame([
        ('{"database":"shop","table":"t","type":"update","ts":5,"data":{"id":"1","n":2},"old":{"n":"1"}}',),
        ('{"database":"shop","table":"t","type":"insert","ts":"6","data":{"id":"2"}}',), ("nonsense",),
    ], "value string")
    got = rows(read_changes(df), "ts", F.col("data")["id"], F.col("data")["n"], F.col("old")["n"])
    assert got == [(5, "1", "2", "1"), (6, "2", None, None)]


def test_read_delimited_and_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1,ann,100\n2,bob\nx,eve,7\n")
    layout = T.StructType.fromDDL("id int, name string, ts long")
    got = rows(read_delimited(read_text(spark, str(tmp_path)), layout))
    assert got == [(1, "ann", 100), (2, "bob", None), (None, "eve", 7)]


def test_kafka_options():
    o = kafka_source("b:9092", ["x", "y"], "g", maxOffsetsPerTrigger="10")
    assert o["subscribe"] == "x,y" and o["startingOffsets"] == "latest" and o["maxOffsetsPerTrigger"] == "10"


def test_read_dim_is_all_text(spark, tmp_path):
    spark.createDataFrame([(1, 2.5)], "id int, price double").write.parquet(str(tmp_path / "d"))
    assert read_dim(spark, str(tmp_path / "d")).dtypes == [("id", "string"), ("price", "string")]
    with pytest.raises(ValueError):
        read_dim(spark)


# ---- change events -----------------------------------------------------------------------------

def test_cdc_select_filters_database_table_and_type(spark):
    df = changes(
        spark, change("a", "insert", {"id": "1"}), change("a", "update", {"id": "2"}), change("b", "insert", {"id": "3"}),
        change("a", "insert", {"id": "4"}, database="other"),
    )
    assert rows(cdc_select(df, "a", ["id", "missing"]), "id", "missing") == [("1", None), ("4", None)]
    assert rows(cdc_select(df, "a", ["id"], database="shop"), "id") == [("1",)]
    assert rows(cdc_select(df, "a", ["id"], None), "id") == [("1",), ("2",), ("4",)]


def test_cdc_transition_needs_the_column_in_old(spark):
    df = changes(
        spark,
        change("o", "update", {"id": "1", "s": "9"}, {"s": "8"}),
        change("o", "update", {"id": "2", "s": "9"}, {"x": "8"}),
        change("o", "update", {"id": "3", "s": "7"}, {"s": "8"}),
        change("o", "insert", {"id": "4", "s": "9"}, {"s": "8"}),
        change("o", "update", {"id": "5", "s": "9"}),
    )
    assert rows(cdc_transition(df, "o", "s", "9", ["id"]), "id") == [("1",)]
    assert rows(cdc_transition(df, "o", "s", None, ["id"]), "id") == [("1",), ("3",)]


def test_cdc_increase(spark):
    df = changes(
        spark,
        change("c", "insert", {"id": "1", "n": "3"}),
        change("c", "update", {"id": "2", "n": "10"}, {"n": "9"}),
        change("c", "update", {"id": "3", "n": "2"}, {"n": "5"}),
        change("c", "update", {"id": "4", "n": "2"}, {"n": "2"}),
        change("c", "update", {"id": "5", "n": "2"}, {"m": "1"}),
        change("c", "update", {"id": "6", "n": "many"}, {"n": "1"}),
    )
    assert rows(cdc_increase(df, "c", "n", ["id", "n"]), "id", "n") == [("1", "3"), ("2", "1")]


def test_refund_requests_let_no_other_table_through(spark):
    base = {c: None for c in schemas.TABLE_COLUMNS["order_refund_info"]}
    df = changes(
        spark,
        change("order_refund_info", "insert", {**base, "order_id": "1"}),
        change("order_refund_info", "update", {**base, "order_id": "2"}, {"refund_status": "0701"}),
        change("order_refund_info", "update", {**base, "order_id": "3"}, {"refund_num": "1"}),
        change("refund_payment", "update", {**base, "order_id": "4"}, {"refund_status": "0701"}),
    )
    assert rows(refunds._requests(df), "order_id") == [("1",), ("2",)]


# ---- routing -----------------------------------------------------------------------------------

def config_event(op, ts, table, sink="t", columns="id,name", pk=None):
    route = (table, sink, columns, pk, None)
    return (route, None, op, ts) if op == "d" else (None, route, op, ts)


def test_routing(spark):
    events = spark.createDataFrame([
        config_event("r", 1, "user", "dim_old"), config_event("u", 2, "user", "dim_user", "code, name", "code"),
        config_event("c", 1, "gone"), config_event("d", 3, "gone"), config_event("c", 1, "sku", "dim_sku"),
    ], schemas.CONFIG_EVENT)
    config = latest_config(events)
    assert rows(config, "source_table", "sink_table", "sink_pk", "sink_extend") == [
        ("sku", "dim_sku", "id", ""), ("user", "dim_user", "code", "")]
    df = changes(
        spark,
        change("user", "insert", {"id": "1", "code": "A", "name": "x", "extra": "e"}),
        change("user", "delete", {"id": "2", "code": "B"}),
        change("sku", "bootstrap-insert", {"id": "7", "name": None, "extra": "e"}),
        change("gone", "insert", {"id": "3"}), change("unknown", "insert", {"id": "4"}),
    )
    got = {(r.sink_table, r.pk, tuple(sorted(r.data.items()))) for r in route_dims(df, config).collect()}
    assert got == {("dim_user", "A", (("code", "A"), ("name", "x"))), ("dim_sku", "7", (("id", "7"), ("name", None)))}


# ---- joins -------------------------------------------------------------------------------------

def test_lookup_is_inner_and_enrich_is_left(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, k string")
    dim = spark.createDataFrame([("a", "Ann"), ("z", "Zoe")], "id string, name string")
    assert rows(lookup(df, dim, "k", "id", {"who": "name"})) == [(1, "a", "Ann")]
    assert rows(enrich(df, dim, "k", {"who": "name"})) == [(1, "a", "Ann"), (2, "b", None), (3, None, None)]
    # An output may replace a column of the same name.
    assert rows(enrich(df, dim, "k", {"k": "name"}), "n", "k") == [(1, "Ann"), (2, None), (3, None)]


def test_enrich_chain_with_a_gap(spark):
    df = spark.createDataFrame([("s1",), ("s2",)], "sku string")
    sku = spark.createDataFrame([("s1", "c1"), ("s2", "c9")], "id string, cat string")
    cat = spark.createDataFrame([("c1", "toys")], "id string, name string")
    got = enrich_chain(df, [Step(sku, "sku", {"cat": "cat"}), Step(cat, "cat", {"cat_name": "name"})])
    assert rows(got) == [("s1", "c1", "toys"), ("s2", "c9", None)]


def test_wide_join_left(spark):
    l = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, k string")
    r = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "rk string, v int")
    assert rows(wide_join(l, r, {"k": "rk"}, "left")) == [(1, "a", 10), (1, "a", 11), (2, "b", None), (3, None, None)]


def test_size_check_decides_on_broadcast(spark):
    big, small = spark.range(10**9), spark.range(10)
    assert estimated_bytes(big) > estimated_bytes(small)
    assert small_side(big) is big
    plan = spark.range(5).join(small_side(small), "id")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_interval_join_bounds_are_included(spark):
    at = [T0 + timedelta(seconds=s) for s in (7, 8, 10, 11, 12)]
    l = spark.createDataFrame([("k", T0 + timedelta(seconds=10))], "k string, lt timestamp")
    r = spark.createDataFrame([("k", t) for t in at] + [("other", at[2])], "k string, rt timestamp")
    got = interval_join(l, r, "k", "lt", "rt", "-2 seconds", "1 second")
    assert [x[0] for x in rows(got, "rt")] == at[1:4]
    with pytest.raises(ValueError):
        interval_join(l, r, "k", "lt", "rt", "1 second", "-2 seconds")


def test_interval_join_brute_force(spark):
    rnd = random.Random(1)
    ls = [("hot" if rnd.random() < .4 else f"k{rnd.randrange(5)}", T0 + timedelta(milliseconds=rnd.randrange(60_000)), i)
          for i in range(150)]
    rs = [("hot" if rnd.random() < .4 else f"k{rnd.randrange(5)}", T0 + timedelta(milliseconds=rnd.randrange(60_000)), i)
          for i in range(150)]
    l = spark.createDataFrame(ls, "k string, lt timestamp, li int")
    r = spark.createDataFrame(rs, "k string, rt timestamp, ri int")
    want = sorted((a[2], b[2]) for a in ls for b in rs
                  if a[0] == b[0] and timedelta(seconds=-2) <= b[1] - a[1] <= timedelta(seconds=1))
    for spans in (1, 4):
        got = interval_join(l, r, "k", "lt", "rt", "-2 seconds", "1 second", spans_per_bucket=spans)
        assert sorted(tuple(x) for x in got.select("li", "ri").collect()) == want


# ---- windows -----------------------------------------------------------------------------------

def test_tumble_bounds_and_keys(spark):
    df = spark.createDataFrame([
        ("a", T0, 1), ("a", T0 + timedelta(seconds=9, milliseconds=999), 2), ("a", T0 + timedelta(seconds=10), 4), ("b", T0, 8),
    ], "k string, ts timestamp, v int")
    got = rows(tumble(df, "ts", "10 seconds", ["k"], {"s": F.sum("v"), "n": F.count("*")}))
    assert got == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", "a", 3, 2), ("2024-01-01 00:00:00", "2024-01-01 00:00:10", "b", 8, 1),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "a", 4, 1)]
    assert rows(tumble(df, "ts", "1 day", [], {"s": F.sum("v")}), "s") == [(15,)]


def test_tumble_distinct(spark):
    df = spark.createDataFrame([("a", T0, "o1", 1), ("a", T0, "o1", 2), ("a", T0, "o2", 4), ("a", T0, None, 8)],
                               "k string, ts timestamp, o string, v int")
    got = tumble_distinct(df, "ts", "10 seconds", ["k"], "o", "orders", {"s": F.col("v")})
    assert rows(got, "k", "orders", "s") == [("a", 2, 15)]


# ---- state -------------------------------------------------------------------------------------

def visits(spark, *at):
    """(key, second, last page) rows; seq is the arrival number."""
    return spark.createDataFrame(
        [(k, T0 + timedelta(seconds=s), last, i) for i, (k, s, last) in enumerate(at)],
        "mid string, ts timestamp, last string, seq int")


def test_first_per_day_and_ever(spark):
    h = 3600
    df = visits(spark, ("a", 23 * h, None), ("a", 24 * h, None), ("a", 24 * h, "x"), ("a", 1 * h, None), ("b", 5, None))
    assert rows(first_per_day(df, "mid", "ts", ["seq"]), "seq") == [(1,), (3,), (4,)]
    assert rows(first_ever(df, "mid", "ts", ["seq"]), "seq") == [(3,), (4,)]


def test_first_by_is_cut_before_the_shuffle(spark):
    plan = first_by(spark.range(100).withColumn("k", F.col("id") % 3), "k", ["id"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "Partial" in plan


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m")], "k string, seq int, v string")
    assert rows(latest_by_key(df, "k", ["seq", "v"]), "k", "v") == [("a", "z"), ("b", "m")]


def flagged(spark, *at):
    return spark.createDataFrame(
        [(k, T0 + timedelta(hours=h), flag, i) for i, (k, h, flag) in enumerate(at)],
        "mid string, ts timestamp, is_new string, seq int")


def test_repair_is_new(spark):
    df = flagged(
        spark,
        ("a", 1, "1"), ("a", 2, "1"), ("a", 25, "1"), ("a", 26, "0"),  # new on day one only
        ("b", 1, "0"), ("b", 2, "1"), ("b", 30, "1"),  # known before: never new
        ("c", 49, "1"), (None, 3, "1"),
    )
    got = dict(rows(repair_is_new(df, "mid", "ts", "is_new", ["seq"]), "seq", "is_new"))
    assert got == {0: "1", 1: "1", 2: "0", 3: "0", 4: "0", 5: "0", 6: "0", 7: "1", 8: "1"}


def test_repair_is_new_brute_force_with_a_hot_device(spark):
    rnd = random.Random(2)
    at = [("hot" if rnd.random() < .5 else f"m{rnd.randrange(20)}", rnd.randrange(200), rnd.choice("01")) for _ in range(600)]
    first = {}
    for i, (k, h, flag) in sorted(enumerate(at), key=lambda x: (x[1][1], x[0])):
        first.setdefault(k, h // 24 if flag == "1" else h // 24 - 1)
    want = {i: "0" if flag == "1" and h // 24 != first[k] else flag for i, (k, h, flag) in enumerate(at)}
    got = repair_is_new(flagged(spark, *at), "mid", "ts", "is_new", ["seq"])
    assert dict(rows(got, "seq", "is_new")) == want


def test_bounces(spark):
    df = visits(
        spark,
        ("a", 0, None), ("a", 10, "home"),   # next row exactly at the limit: bounce
        ("b", 0, None), ("b", 9, "home"),    # goes on
        ("c", 0, None), ("c", 3, None), ("c", 5, "home"),  # start, then a start that goes on
        ("d", 0, None), ("d", 0, "home"),    # same time: arrival order decides
        ("e", 0, "home"),                    # no start at all
        ("f", 0, None),                      # nothing follows
    )
    assert rows(bounces(df, "mid", "ts", "last", "10 seconds", ["seq"]), "seq") == [(0,), (4,), (10,)]


def brute_bounces(at, within):
    out = []
    by_key = {}
    for i, (k, s, last) in enumerate(at):
        by_key.setdefault(k, []).append((s, i, last))
    for seq in by_key.values():
        seq.sort(key=lambda r: r[:2])
        for a, b in zip(seq, seq[1:] + [None]):
            if a[2] is None and (b is None or b[0] - a[0] >= within or b[2] is None):
                out.append((a[1],))
    return sorted(out)


@pytest.mark.parametrize("bucket", ["10 seconds", "37 seconds", None])
def test_bounces_brute_force(spark, bucket):
    rnd = random.Random(3)
    at = [("hot" if rnd.random() < .4 else f"m{rnd.randrange(30)}", rnd.randrange(900), rnd.choice([None, None, "p"]))
          for _ in range(500)]
    got = bounces(visits(spark, *at), "mid", "ts", "last", "10 seconds", ["seq"], bucket)
    assert rows(got, "seq") == brute_bounces(at, 10)


def test_returning_users_gap_of_seven_and_eight_days(spark):
    d = 86400
    df = visits(spark, ("a", 0, None), ("a", 7 * d, None), ("a", 15 * d, None), ("a", 15 * d + 5, None), ("b", 3, None))
    got = rows(returning_users(df, "mid", "ts"), "mid", "day", "back_ct", "uu_ct")
    assert [(r[0], r[1].day, r[2], r[3]) for r in got] == [("a", 1, 0, 1), ("a", 8, 0, 1), ("a", 16, 1, 1), ("b", 1, 0, 1)]


def test_returning_users_with_known_days(spark):
    d = 86400
    df = visits(spark, ("a", 9 * d, None), ("b", 9 * d, None), ("b", d, None))
    known = spark.createDataFrame([("a", T0.date()), ("b", (T0 + timedelta(days=1)).date())], "mid string, day date")
    got = rows(returning_users(df, "mid", "ts", known=known), "mid", "day", "back_ct")
    assert [(r[0], r[1].day, r[2]) for r in got] == [("a", 10, 1), ("b", 10, 1)]


# ---- logs --------------------------------------------------------------------------------------

def behaviour(spark, *texts):
    return parse_or_drop(spark.createDataFrame([(t,) for t in texts], "value string"), schemas.BEHAVIOUR_LOG)


LOGS = (
    '{"common":{"mid":"m"},"page":{"page_id":"home"},"display":[{"item":"1"},{"item":"2"}],"action":[{"item":"3","ts":9}],"ts":1}',
    '{"common":{"mid":"m"},"start":{"entry":"icon"},"err":{"error_code":5},"ts":2}',
    '{"common":{"mid":"m"},"page":{"page_id":"list"},"err":{"error_code":6},"display":[],"ts":3}',
    '{"common":{"mid":"m"},"page":{"page_id":"x"},"action":[{"item":"4"}],"ts":4}',
)


def test_split_log(spark):
    parts = split_log(behaviour(spark, *LOGS))
    assert {k: rows(v, "ts") for k, v in parts.items()} == {
        "error": [(2,), (3,)], "start": [(2,)], "page": [(1,), (3,), (4,)], "display": [(1,), (1,)], "action": [(4,), (9,)]}
    assert rows(parts["display"], "item", "page.page_id", "common.mid") == [("1", "home", "m"), ("2", "home", "m")]
    assert parts["page"].columns == ["common", "page", "ts"]


def test_log_rows_equals_split_log(spark):
    logs = behaviour(spark, *LOGS)
    one_pass = log_rows(logs)
    for kind, part in split_log(logs).items():
        assert rows(one_pass.where(F.col("kind") == kind), "ts", "page.page_id") == (
            rows(part, "ts", "page.page_id") if "page" in part.columns else rows(part, "ts", F.lit(None).alias("page_id")))
    errors = split_log(logs)["error"]
    whole = [F.to_json(F.struct(*errors.columns)).alias("log")]
    assert rows(one_pass.where("kind = 'error'").select(*errors.columns), *whole) == rows(errors, *whole)
    assert one_pass.where("kind <> 'error' AND (display IS NOT NULL OR action IS NOT NULL OR err IS NOT NULL)").count() == 0


# ---- plans -------------------------------------------------------------------------------------

def test_logins_need_a_user_and_a_fresh_start(spark):
    texts = [
        '{"common":{"uid":"1"},"page":{},"ts":1}', '{"common":{"uid":"2"},"page":{"last_page_id":"login"},"ts":2}',
        '{"common":{"uid":"3"},"page":{"last_page_id":"home"},"ts":3}', '{"common":{},"page":{},"ts":4}',
    ]
    pages = traffic.with_event_time(parse_or_drop(spark.createDataFrame([(t,) for t in texts], "value string"), schemas.PAGE_LOG))
    assert rows(users.logins(pages), "uid") == [("1",), ("2",)]


def test_user_firsts_with_known_days(spark):
    d = 86400
    df = visits(spark, ("a", 5, None), ("a", 9, None), ("a", d, None), ("b", d, None), ("c", 2 * d, None))
    known = spark.createDataFrame([("b", T0.date()), ("c", (T0 + timedelta(days=2)).date())], "mid string, day date")
    plain = rows(trade.user_firsts(df, "mid", "ts", ["seq"]), "mid", "day_ct", "new_ct")
    assert plain == [("a", 1, 0), ("a", 1, 1), ("b", 1, 1), ("c", 1, 1)]
    later = rows(trade.user_firsts(df, "mid", "ts", ["seq"], known), "mid", "day_ct", "new_ct")
    assert later == [("a", 1, 0), ("a", 1, 1), ("b", 1, 0)]


def test_cart_time_prefers_the_operation(spark):
    df = spark.createDataFrame([("u", "2024-01-02 00:00:00", None), ("u", "2024-01-02 00:00:00", "2024-01-03 00:00:00")],
                               "user_id string, create_time string, operate_time string")
    assert [x[0].day for x in rows(trade.with_cart_time(df), "et")] == [2, 3]
