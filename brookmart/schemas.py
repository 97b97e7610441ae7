"""Record layouts. They are fixed here and never inferred, so streams and batches agree."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


STRING_MAP = T.MapType(T.StringType(), T.StringType())

CHANGE_EVENT = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("data", STRING_MAP),
    T.StructField("old", STRING_MAP),
])

COMMON = strings("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc")

PAGE = T.StructType([
    T.StructField("during_time", T.LongType()),
    *strings("last_page_id", "page_id", "item", "item_type").fields,
])

DISPLAY = T.StructType([
    *strings("display_type", "item", "item_type").fields,
    T.StructField("order", T.LongType()),
    T.StructField("pos_id", T.LongType()),
])

ACTION = T.StructType([
    *strings("action_id", "item", "item_type").fields,
    T.StructField("ts", T.LongType()),
])

START = T.StructType([
    T.StructField("entry", T.StringType()),
    T.StructField("loading_time", T.LongType()),
    T.StructField("open_ad_id", T.LongType()),
    T.StructField("open_ad_ms", T.LongType()),
    T.StructField("open_ad_skip_ms", T.LongType()),
])

ERROR = T.StructType([
    T.StructField("error_code", T.LongType()),
    T.StructField("msg", T.StringType()),
])

PAGE_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("ts", T.LongType()),
])

BEHAVIOUR_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", START),
    T.StructField("err", ERROR),
    T.StructField("display", T.ArrayType(DISPLAY)),
    T.StructField("action", T.ArrayType(ACTION)),
    T.StructField("ts", T.LongType()),
])

ROUTE = strings("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")

CONFIG_EVENT = T.StructType([
    T.StructField("before", ROUTE),
    T.StructField("after", ROUTE),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])

CODE_TABLE = strings("dic_code", "dic_name", "parent_code", "create_time", "operate_time")

# The columns each source table carries in a change event.
TABLE_COLUMNS = {
    "order_info": [
        "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id", "payment_way",
        "delivery_address", "order_comment", "out_trade_no", "trade_body", "create_time", "operate_time",
        "expire_time", "process_status", "tracking_no", "parent_order_id", "province_id",
        "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee",
        "feight_fee_reduce", "refundable_time",
    ],
    "order_detail": [
        "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "source_type",
        "source_id", "split_total_amount", "split_activity_amount", "split_coupon_amount",
    ],
    "order_detail_activity": [
        "order_id", "order_detail_id", "activity_id", "activity_rule_id", "sku_id", "create_time",
    ],
    "order_detail_coupon": [
        "order_id", "order_detail_id", "coupon_id", "coupon_use_id", "sku_id", "create_time",
    ],
    "payment_info": [
        "out_trade_no", "order_id", "user_id", "payment_type", "trade_no", "total_amount", "subject",
        "payment_status", "create_time", "callback_time", "callback_content",
    ],
    "order_refund_info": [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "refund_status", "create_time",
    ],
    "refund_payment": [
        "id", "out_trade_no", "order_id", "sku_id", "payment_type", "trade_no", "total_amount", "subject",
        "refund_status", "create_time", "callback_time", "callback_content",
    ],
    "cart_info": [
        "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked", "create_time",
        "operate_time", "is_ordered", "order_time", "source_type", "source_id",
    ],
    "coupon_use": [
        "id", "coupon_id", "user_id", "order_id", "coupon_status", "create_time", "get_time", "using_time",
        "used_time", "expire_time",
    ],
    "favor_info": ["id", "user_id", "sku_id", "spu_id", "is_cancel", "create_time", "cancel_time"],
    "comment_info": [
        "id", "user_id", "nick_name", "head_img", "sku_id", "spu_id", "order_id", "appraise", "comment_txt",
        "create_time", "operate_time",
    ],
    "user_info": [
        "id", "login_name", "nick_name", "passwd", "name", "phone_num", "email", "head_img", "user_level",
        "birthday", "gender", "create_time", "operate_time", "status",
    ],
}

# Status codes the plans look for.
ORDER_CANCELLED = "1003"
ORDER_REFUND_REQUESTED = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_DONE = "1002"
REFUND_PAID = "0705"
COUPON_USED_ON_ORDER = "1402"
COUPON_USED_BY_PAYMENT = "1403"
