"""Coupons: received, used on an order, consumed by the payment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from brookmart.operators import cdc_select, cdc_transition
from brookmart.schemas import COUPON_USED_BY_PAYMENT, COUPON_USED_ON_ORDER, TABLE_COLUMNS

_COLUMNS = TABLE_COLUMNS["coupon_use"]


def coupons_received(changes: DataFrame, database: str | None = None) -> DataFrame:
    return cdc_select(changes, "coupon_use", _COLUMNS, database=database)


def coupons_ordered(changes: DataFrame, database: str | None = None) -> DataFrame:
    return cdc_transition(changes, "coupon_use", "coupon_status", COUPON_USED_ON_ORDER, _COLUMNS, database)


def coupons_paid(changes: DataFrame, database: str | None = None) -> DataFrame:
    return cdc_transition(changes, "coupon_use", "coupon_status", COUPON_USED_BY_PAYMENT, _COLUMNS, database)
