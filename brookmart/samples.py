"""Shop records derived from the given star-schema tables.

The warehouse reads behaviour logs and database change events. Here both are derived, by Spark, from
the tables ``events orders lineitem part customer documents ...``: every event becomes a log record,
every order, line, customer or document a change row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brookmart import schemas
from brookmart.functions.dates import DATETIME
from brookmart.operators.parse import to_json_value


# The columns of the given tables that are read here.
LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}

DATABASE = "shop"


Reader = Callable[[str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with zone-less times as timestamps of the session zone (UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _zoned(spark.read.schema(LAYOUT[name]).parquet(f"{sf_dir}/{name}.parquet"))


def reader(spark: SparkSession, sf_dir: str) -> Reader:
    return lambda name: table(spark, sf_dir, name)


def stream_reader(spark: SparkSession, sf_dir: str) -> Reader:
    """The given tables as streams."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    def read(name: str) -> DataFrame:
        files = spark.readStream.schema(LAYOUT[name]).option("pathGlobFilter", f"{name}.parquet")
        return _zoned(files.parquet(sf_dir))

    return read


def _zoned(df: DataFrame) -> DataFrame:
    zoneless = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---- behaviour logs ---------------------------------------------------------------------------

def logs(read: Reader) -> DataFrame:
    """One behaviour log per event, plus ``seq``, its arrival number."""
    e = read("events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    kind, k = F.col("event_type"), F.col("k")

    def when(**by_kind: str | None) -> Column:
        out = None
        for name, value in by_kind.items():
            out = (F if out is None else out).when(kind == name, F.lit(value))
        return out

    common = F.struct(
        F.concat(F.lit("ar"), F.col("user_id") % 5).alias("ar"),
        F.lit("brand").alias("ba"),
        F.concat(F.lit("ch"), F.col("event_id") % 4).alias("ch"),
        F.when(kind.isin("view", "signup"), "1").otherwise("0").alias("is_new"),
        F.lit("model").alias("md"),
        F.concat(F.lit("mid_"), F.col("user_id")).alias("mid"),
        F.lit("os").alias("os"),
        F.when(kind != "error", text("user_id")).alias("uid"),
        F.concat(F.lit("v"), F.col("user_id") % 3).alias("vc"),
    )
    page = F.struct(
        (k * 1000).alias("during_time"),
        when(view=None, click="home", purchase="good_detail", signup="login", error="search").alias("last_page_id"),
        when(view="home", click="good_detail", purchase="trade", signup="login", error="good_list").alias("page_id"),
        F.lit(None).cast("string").alias("item"),
        F.lit(None).cast("string").alias("item_type"),
    )
    start = F.when(kind == "signup", F.struct(
        F.lit("icon").alias("entry"), (k * 10).alias("loading_time"), k.alias("open_ad_id"),
        F.lit(0).cast("long").alias("open_ad_ms"), F.lit(0).cast("long").alias("open_ad_skip_ms"),
    ))
    err = F.when((kind == "error") | ((kind == "signup") & (k % 10 == 0)), F.struct(
        k.alias("error_code"), F.concat(F.lit("error "), k).alias("msg"),
    ))
    shown = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long")), lambda i: F.struct(
        F.lit("query").alias("display_type"), text(k + i).alias("item"), F.lit("sku_id").alias("item_type"),
        i.alias("order"), (k % 5).alias("pos_id"),
    ))
    display = F.when(kind.isin("click", "purchase"), F.slice(shown, 1, (k % 4).cast("int")))
    done = F.array(F.struct(
        F.lit("cart_add").alias("action_id"), text(k).alias("item"), F.lit("sku_id").alias("item_type"),
        F.when(k % 3 != 0, F.unix_millis("ts") + k).alias("ts"),
    ))
    return e.select(
        common.alias("common"),
        F.when(kind != "signup", page).alias("page"),
        start.alias("start"),
        err.alias("err"),
        display.alias("display"),
        F.when(kind == "purchase", done).alias("action"),
        F.unix_millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def log_texts(read: Reader) -> DataFrame:
    """The logs as JSON text; one in 25 is cut off and so malformed."""
    rows = logs(read)
    whole = rows.select("seq", F.to_json(F.struct(*[c for c in rows.columns if c != "seq"])).alias("v"))
    cut = F.when(F.col("seq") % 25 == 0, F.expr("left(v, length(v) - 5)")).otherwise(F.col("v"))
    return whole.select("seq", cut.alias("value"))


def pages(read: Reader) -> DataFrame:
    """The page log: every event as a page row (also sign-ups, as views of the login page)."""
    e = logs(read)
    login = F.struct(
        F.lit(0).cast("long").alias("during_time"), F.lit("login").alias("last_page_id"), F.lit("login").alias("page_id"),
        F.lit(None).cast("string").alias("item"), F.lit(None).cast("string").alias("item_type"),
    )
    return e.select("common", F.coalesce("page", login).alias("page"), "ts", "seq")


def search_pages(read: Reader) -> DataFrame:
    """Documents as searches: one per second, with the whole text as the searched words."""
    d = read("documents")
    return d.select(
        F.struct(F.concat(F.lit("mid_"), F.col("doc_id") % 100).alias("mid")).alias("common"),
        F.struct(
            F.col("text").alias("item"), F.lit("keyword").alias("item_type"), F.lit("search").alias("last_page_id"),
        ).alias("page"),
        (F.lit(1704067200000) + F.col("doc_id") * 1000).alias("ts"),
    )


def part_search_pages(read: Reader) -> DataFrame:
    """Order lines as searches for the part's name."""
    lines, part = read("lineitem"), read("part")
    rows = lines.join(part, lines.l_partkey == part.p_partkey)
    return rows.select(
        F.struct(F.col("p_name").alias("item"), F.lit("keyword").alias("item_type"), F.lit("search").alias("last_page_id"))
        .alias("page"),
        F.unix_millis("l_shipdate").alias("ts"),
    )


# ---- change events ----------------------------------------------------------------------------
# Values are SQL expressions over the table the change comes from.

def _map(values: dict[str, str]) -> str:
    return "map(" + ", ".join(f"'{name}', cast({value} as string)" for name, value in values.items()) + ")"


def _change(rows: DataFrame, name: str, kind: str, time: str, data: dict[str, str],
            old: dict[str, str] | None = None) -> DataFrame:
    data = {c: data.get(c, "null") for c in schemas.TABLE_COLUMNS.get(name, list(data))}
    return rows.selectExpr(
        f"'{DATABASE}' as database",
        f"'{name}' as table",
        f"'{kind}' as type",
        f"unix_millis({time}) as ts",
        f"{_map(data)} as data",
        f"{_map(old) if old else 'cast(null as map<string,string>)'} as old",
    )


def dt(time: str) -> str:
    return f"date_format({time}, '{DATETIME}')"


def later(time: str, days: int) -> str:
    return f"{time} + INTERVAL {days} DAYS"


def money(x: str) -> str:
    return f"cast({x} as decimal(18,2))"


# Order and line number alone repeat in the given tables.
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, unix_millis(l_shipdate))"
PRICE, DISCOUNT, TAX = money("l_extendedprice"), "cast(l_discount as decimal(4,2))", "cast(l_tax as decimal(4,2))"


def _order_changes(read: Reader) -> list[DataFrame]:
    o = read("orders")
    t = "o_orderdate"

    def data(status: str, **more: str) -> dict[str, str]:
        return {
            "id": "o_orderkey", "consignee": "concat('consignee ', o_custkey)", "total_amount": money("o_totalprice"),
            "order_status": f"'{status}'", "user_id": "o_custkey", "payment_way": "substring(o_orderpriority, 1, 1)",
            "out_trade_no": "concat('T', o_orderkey)", "create_time": dt(t), "province_id": "o_custkey % 28",
            "original_total_amount": money("o_totalprice"), **more,
        }

    def update(rows, status: str, after: int, old: dict[str, str]) -> DataFrame:
        time = later(t, after)
        return _change(rows, "order_info", "update", time, data(status, operate_time=dt(time)), old)

    finished, cancelled, open_ = (o.where(f"o_orderstatus = '{x}'") for x in "FPO")
    return [
        _change(o, "order_info", "insert", t, data("1001")),
        update(cancelled, "1003", 1, {"order_status": "'1001'"}),
        update(finished, "1005", 2, {"order_status": "'1002'"}),
        update(finished.where("o_orderkey % 2 = 0"), "1006", 3, {"order_status": "'1005'"}),
        # An update of another column of an order that is cancelled already: not a cancellation.
        update(open_, "1003", 4, {"consignee_tel": "'0'"}),
    ]


def _line_changes(read: Reader) -> list[DataFrame]:
    l = read("lineitem")
    return [_change(l, "order_detail", "insert", "l_shipdate", {
        "id": LINE_ID, "order_id": "l_orderkey", "sku_id": "l_partkey", "sku_name": "concat('sku ', l_partkey)",
        "order_price": PRICE, "sku_num": "cast(l_quantity as int)", "create_time": dt("l_shipdate"),
        "source_type": "concat('240', l_linenumber % 3 + 1)", "source_id": "l_suppkey",
        "split_total_amount": money(f"{PRICE} * (1 - {DISCOUNT})"),
        "split_activity_amount": f"CASE WHEN {DISCOUNT} > 0 THEN {money(f'{PRICE} * {DISCOUNT}')} END",
        "split_coupon_amount": f"CASE WHEN {TAX} > 0 THEN {money(f'{PRICE} * {TAX}')} END",
    })]


def _activity_changes(read: Reader) -> list[DataFrame]:
    l = read("lineitem").where("l_discount > 0.05D")
    return [_change(l, "order_detail_activity", "insert", "l_shipdate", {
        "order_id": "l_orderkey", "order_detail_id": LINE_ID, "sku_id": "l_partkey", "activity_id": "l_partkey % 10",
        "activity_rule_id": "l_suppkey % 10", "create_time": dt("l_shipdate"),
    })]


def _coupon_line_changes(read: Reader) -> list[DataFrame]:
    l = read("lineitem").where("l_tax > 0.04D")
    return [_change(l, "order_detail_coupon", "insert", "l_shipdate", {
        "order_id": "l_orderkey", "order_detail_id": LINE_ID, "sku_id": "l_partkey", "coupon_id": "l_partkey % 7",
        "coupon_use_id": "l_suppkey % 7", "create_time": dt("l_shipdate"),
    })]


def _payment_changes(read: Reader) -> list[DataFrame]:
    o = read("orders")
    t = "o_orderdate"

    def data(status: str) -> dict[str, str]:
        return {
            "out_trade_no": "concat('P', o_orderkey)", "order_id": "o_orderkey", "user_id": "o_custkey",
            "payment_type": "concat('110', substring(o_orderpriority, 1, 1))", "trade_no": "concat('N', o_orderkey)",
            "total_amount": money("o_totalprice"), "subject": "'order'", "payment_status": f"'{status}'",
            "create_time": dt(t), "callback_time": dt(later(t, 1)),
        }

    return [
        _change(o, "payment_info", "insert", t, data("1001")),
        _change(o.where("o_orderstatus = 'F'"), "payment_info", "update", later(t, 1), data("1002"),
                {"payment_status": "'1001'"}),
        _change(o.where("o_orderstatus = 'O'"), "payment_info", "update", later(t, 1), data("1002"), {"subject": "'x'"}),
    ]


def _refund_changes(read: Reader) -> list[DataFrame]:
    l = read("lineitem").where("l_returnflag = 'R'")
    t = "l_shipdate"

    def data(status: str) -> dict[str, str]:
        return {
            "id": LINE_ID, "user_id": "l_suppkey", "order_id": "l_orderkey", "sku_id": "l_partkey",
            "refund_type": "concat('150', l_linenumber % 2 + 1)", "refund_num": "cast(l_quantity as int)",
            "refund_amount": PRICE, "refund_reason_type": "concat('130', l_partkey % 5 + 1)",
            "refund_reason_txt": "concat('reason ', l_partkey % 9)", "refund_status": f"'{status}'", "create_time": dt(t),
        }

    return [
        _change(l, "order_refund_info", "insert", t, data("0701")),
        _change(l.where("l_linestatus = 'F'"), "order_refund_info", "update", later(t, 1), data("0705"),
                {"refund_status": "'0701'"}),
        _change(l.where("l_linestatus = 'O'"), "order_refund_info", "update", later(t, 1), data("0705"),
                {"refund_num": "'0'"}),
    ]


def _refund_payment_changes(read: Reader) -> list[DataFrame]:
    l = read("lineitem").where("l_returnflag = 'R' and l_linestatus = 'F'")
    t = "l_shipdate"

    def data(status: str) -> dict[str, str]:
        return {
            "id": LINE_ID, "out_trade_no": "concat('R', l_orderkey)", "order_id": "l_orderkey", "sku_id": "l_partkey",
            "payment_type": "concat('110', l_suppkey % 3 + 1)", "trade_no": "concat('RN', l_orderkey)",
            "total_amount": PRICE, "subject": "'refund'", "refund_status": f"'{status}'", "create_time": dt(t),
            "callback_time": dt(later(t, 2)),
        }

    return [
        _change(l, "refund_payment", "insert", t, data("0701")),
        _change(l, "refund_payment", "update", later(t, 2), data("0705"), {"refund_status": "'0701'"}),
    ]


def _cart_changes(read: Reader) -> list[DataFrame]:
    l = read("lineitem")
    t = "l_shipdate"

    def data(**more: str) -> dict[str, str]:
        return {
            "id": LINE_ID, "user_id": "l_orderkey % 500", "sku_id": "l_partkey", "cart_price": PRICE,
            "sku_num": "cast(l_quantity as int)", "sku_name": "concat('sku ', l_partkey)", "is_checked": "'1'",
            "create_time": dt(t), "is_ordered": "'0'", "source_type": "concat('240', l_linenumber % 4 + 1)",
            "source_id": "l_suppkey", **more,
        }

    added, changed = l.where("l_linestatus = 'O'"), l.where("l_linestatus = 'F'")
    day_after = data(operate_time=dt(later(t, 1)))
    return [
        _change(added, "cart_info", "insert", t, data()),
        _change(changed.where("l_partkey % 3 <> 0"), "cart_info", "update", later(t, 1), day_after,
                {"sku_num": "l_linenumber * 7"}),
        _change(changed.where("l_partkey % 3 = 0"), "cart_info", "update", later(t, 1), day_after, {"is_checked": "'0'"}),
    ]


def _coupon_changes(read: Reader) -> list[DataFrame]:
    o = read("orders")
    t = "o_orderdate"

    def data(status: str, **more: str) -> dict[str, str]:
        return {
            "id": "o_orderkey", "coupon_id": "o_custkey % 20", "user_id": "o_custkey", "order_id": "o_orderkey",
            "coupon_status": f"'{status}'", "create_time": dt(t), "get_time": dt(t), "expire_time": dt(later(t, 30)), **more,
        }

    return [
        _change(o, "coupon_use", "insert", t, data("1401")),
        _change(o.where("o_orderstatus <> 'P'"), "coupon_use", "update", later(t, 1),
                data("1402", using_time=dt(later(t, 1))), {"coupon_status": "'1401'"}),
        _change(o.where("o_orderstatus = 'F'"), "coupon_use", "update", later(t, 2),
                data("1403", used_time=dt(later(t, 2))), {"coupon_status": "'1402'"}),
        _change(o.where("o_orderstatus = 'P'"), "coupon_use", "update", later(t, 3), data("1403"), {"expire_time": dt(t)}),
    ]


def _favour_changes(read: Reader) -> list[DataFrame]:
    e = read("events")
    data = {
        "id": "event_id", "user_id": "user_id", "sku_id": "event_id % 200", "spu_id": "event_id % 20", "is_cancel": "'0'",
        "create_time": dt("ts"),
    }
    return [
        _change(e.where("event_type = 'click'"), "favor_info", "insert", "ts", data),
        _change(e.where("event_type = 'purchase'"), "favor_info", "update", "ts",
                {**data, "is_cancel": "'1'", "cancel_time": dt("ts")}, {"is_cancel": "'0'"}),
    ]


def _comment_changes(read: Reader) -> list[DataFrame]:
    t = "timestamp_seconds(1704067200 + doc_id)"
    return [_change(read("documents"), "comment_info", "insert", t, {
        "id": "doc_id", "user_id": "doc_id % 150", "nick_name": "source", "sku_id": "doc_id % 200", "spu_id": "doc_id % 20",
        "order_id": "doc_id % 999", "appraise": "concat('120', doc_id % 5 + 1)", "comment_txt": "text", "create_time": dt(t),
    })]


def _user_changes(read: Reader) -> list[DataFrame]:
    c = read("customer")
    t = "timestamp_seconds(1704067200 + c_custkey * 97)"
    data = {
        "id": "c_custkey", "login_name": "lower(c_name)", "nick_name": "c_mktsegment", "name": "c_name",
        "user_level": "c_nationkey % 3", "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END", "create_time": dt(t),
    }
    changed = {**data, "nick_name": "concat('new ', c_mktsegment)", "operate_time": dt(later(t, 1))}
    return [
        _change(c, "user_info", "insert", t, data),
        _change(c.where("c_custkey % 2 = 0"), "user_info", "update", later(t, 1), changed, {"nick_name": "c_mktsegment"}),
        _change(c.where("c_custkey % 10 = 0"), "user_info", "delete", later(t, 2), data),
    ]


def _sku_changes(read: Reader) -> list[DataFrame]:
    p = read("part")
    t = "timestamp_seconds(1704067200 + p_partkey)"
    data = {
        "id": "p_partkey", "sku_name": "p_name", "price": money("p_retailprice"), "category3_id": "p_size",
        "tm_id": "substring_index(p_brand, '#', -1)", "spu_id": "p_partkey % 50",
    }
    return [
        _change(p, "sku_info", "bootstrap-insert", t, data),
        _change(p.where("p_partkey % 4 = 0"), "sku_info", "update", later(t, 1),
                {**data, "sku_name": "concat(p_name, ' v2')"}, {"sku_name": "p_name"}),
    ]


_SOURCES = {
    "order_info": _order_changes, "order_detail": _line_changes, "order_detail_activity": _activity_changes,
    "order_detail_coupon": _coupon_line_changes, "payment_info": _payment_changes,
    "order_refund_info": _refund_changes, "refund_payment": _refund_payment_changes, "cart_info": _cart_changes,
    "coupon_use": _coupon_changes, "favor_info": _favour_changes, "comment_info": _comment_changes,
    "user_info": _user_changes, "sku_info": _sku_changes,
}


def changes(read: Reader, *tables: str) -> DataFrame:
    """The change events of the named tables (all when none is named), as one table."""
    out = None
    for name in tables or _SOURCES:
        for part in _SOURCES[name](read):
            out = part if out is None else out.unionByName(part)
    return out


def change_texts(read: Reader, *tables: str) -> DataFrame:
    return to_json_value(changes(read, *tables))


# ---- dimensions -------------------------------------------------------------------------------

def codes(spark: SparkSession) -> DataFrame:
    """The code table. Codes 2404 and 1205 are missing on purpose: inner lookups drop their rows."""
    names = {
        # Codes used by the derived change events.
        "2401": "search", "2402": "promotion", "2403": "recommendation",
        "1101": "card", "1102": "transfer", "1103": "wallet", "1104": "voucher", "1105": "cash",
        "1001": "unpaid", "1002": "paid",
        "0701": "requested", "0705": "paid out",
        "1501": "refund", "1502": "return",
        "1301": "quality", "1302": "size", "1303": "late", "1304": "changed mind", "1305": "other",
        "1201": "good", "1202": "fair", "1203": "poor", "1204": "none",
    }
    rows = ", ".join(f"('{c}', '{n}', '{c[:2]}', cast(null as string), cast(null as string))" for c, n in names.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(dic_code, dic_name, parent_code, create_time, operate_time)")


#: The time at which two codes change their names, in epoch milliseconds.
RENAMED = 896_486_400_000


def code_history(spark: SparkSession) -> DataFrame:
    """Versions of the code table, each with the time from which it holds: search and recommendation are renamed half way."""
    now = codes(spark).select("dic_code", "dic_name", F.lit(0).cast("long").alias("valid_from"))
    later = now.where("dic_code IN ('2401', '2403')").select("dic_code", F.concat("dic_name", F.lit(" (new)")).alias("dic_name"), F.lit(RENAMED).alias("valid_from"))
    return now.unionByName(later)


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimension tables by name, every column as text. Category 13 has no row."""
    p = table(spark, sf_dir, "part")
    brand = F.substring_index("p_brand", "#", -1)
    size = F.col("p_size")
    n = table(spark, sf_dir, "nation")
    return {
        "sku_info": p.select(text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                             text("p_size").alias("category3_id"), brand.alias("tm_id"),
                             text(F.col("p_partkey") % 50).alias("spu_id")),
        "spu_info": p.select((F.col("p_partkey") % 50).alias("k")).distinct().select(
            text("k").alias("id"), F.concat(F.lit("spu "), F.col("k")).alias("spu_name")),
        "base_category3": p.where("p_size <> 13").select(size).distinct().select(
            text(size).alias("id"), F.concat(F.lit("category "), size).alias("name"), text(size % 10).alias("category2_id")),
        "base_category2": p.select((size % 10).alias("k")).distinct().select(
            text("k").alias("id"), F.concat(F.lit("group "), F.col("k")).alias("name"), text(F.col("k") % 3).alias("category1_id")),
        "base_category1": p.select((size % 10 % 3).alias("k")).distinct().select(
            text("k").alias("id"), F.concat(F.lit("section "), F.col("k")).alias("name")),
        "base_trademark": p.select("p_brand").distinct().select(brand.alias("id"), F.col("p_brand").alias("tm_name")),
        "base_province": n.select(text("n_nationkey").alias("id"), F.col("n_name").alias("name")),
    }


def config_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debezium rows of the routing table: users are routed twice (the later row counts), one route is deleted."""
    users = "id,login_name,nick_name,name,user_level,gender,create_time,operate_time"
    rows = [
        ("user_info", "dim_user_old", "id,name", None, "c", 1),
        ("user_info", "dim_user_info", users, None, "u", 2),
        ("sku_info", "dim_sku_info", "id, sku_name, category3_id, tm_id, spu_id", "id", "r", 1),
        ("order_info", "dim_order", "id", "id", "c", 1),
    ]

    def route(r) -> str:
        pk = "cast(null as string)" if r[3] is None else f"'{r[3]}'"
        return (f"named_struct('source_table', '{r[0]}', 'sink_table', '{r[1]}', 'sink_columns', '{r[2]}', "
                f"'sink_pk', {pk}, 'sink_extend', cast(null as string))")

    values = [f"(cast(null as struct<source_table:string,sink_table:string,sink_columns:string,sink_pk:string,"
              f"sink_extend:string>), {route(r)}, '{r[4]}', {r[5]}L)" for r in rows]
    values.append(f"({route(rows[3])}, cast(null as struct<source_table:string,sink_table:string,sink_columns:string,"
                  f"sink_pk:string,sink_extend:string>), 'd', 5L)")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS t(before, after, op, ts_ms)")
