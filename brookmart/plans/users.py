"""Users: registrations, favourites, comments, logins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brookmart.functions.dates import parse_time
from brookmart.operators import cdc_select, lookup, returning_users, tumble
from brookmart.schemas import TABLE_COLUMNS


def users_registered(changes: DataFrame, database: str | None = None) -> DataFrame:
    return cdc_select(changes, "user_info", TABLE_COLUMNS["user_info"], database=database)


def favourites_added(changes: DataFrame, database: str | None = None) -> DataFrame:
    return cdc_select(changes, "favor_info", TABLE_COLUMNS["favor_info"], database=database)


def comments_added(changes: DataFrame, codes: DataFrame, database: str | None = None) -> DataFrame:
    """New comments with the name of their rating; an unknown rating drops the row (inner lookup)."""
    rows = cdc_select(changes, "comment_info", TABLE_COLUMNS["comment_info"], database=database)
    return lookup(rows, codes, "appraise", "dic_code", {"appraise_name": "dic_name"})


def registrations(users: DataFrame, size: str = "10 seconds", watermark: str = "2 seconds") -> DataFrame:
    """New users per window, from ``users_registered``."""
    timed = users.select(parse_time("create_time").alias("et"))
    return tumble(timed, "et", size, [], {"register_ct": F.count("*")}, watermark)


def logins(pages: DataFrame) -> DataFrame:
    """(uid, et) of page rows that show a login: first page, or coming from the login page."""
    rows = pages.where(
        F.col("common.uid").isNotNull()
        & (F.col("page.last_page_id").isNull() | (F.col("page.last_page_id") == "login"))
    )
    return rows.select(F.col("common.uid").alias("uid"), "et")


def login_days(pages: DataFrame, gap_days: int = 7, known: DataFrame | None = None) -> DataFrame:
    """One row per user and login day. Stream: live.login_days."""
    return returning_users(logins(pages), "uid", "et", gap_days, known)


def login_activity(days: DataFrame, size: str = "10 seconds", watermark: str = "2 seconds") -> DataFrame:
    """Daily unique logins and returning users per window, from ``login_days``."""
    return tumble(days, "et", size, [], {"back_ct": F.sum("back_ct"), "uu_ct": F.sum("uu_ct")}, watermark)
