"""Page traffic: log split, unique visits, bounces, keywords, and their windowed counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from brookmart.functions.dates import event_time
from brookmart.functions.text import tokenize
from brookmart.operators import (
    bounces, first_by, first_per_day, log_rows, measures, repair_is_new, split_log, tumble,
)

HOME, DETAIL = "home", "good_detail"


def with_event_time(logs: DataFrame, watermark: str | None = None) -> DataFrame:
    """Add ``et``, the event time of the epoch-millisecond column ``ts``."""
    out = logs.withColumn("et", event_time("ts"))
    return out.withWatermark("et", watermark) if watermark and logs.isStreaming else out


def repaired_logs(logs: DataFrame, tiebreak=(), state: DataFrame | None = None) -> DataFrame:
    """Logs with the new-visitor flag put right."""
    return repair_is_new(with_event_time(logs), "common.mid", "et", "common.is_new", tiebreak, state).drop("et")


def log_split(logs: DataFrame, tiebreak=(), state: DataFrame | None = None) -> dict[str, DataFrame]:
    """Repair the new-visitor flag, then split the log by kind. Stream: live.log_split.

    To write all kinds at once use ``log_split_rows``, which reads the log once.
    """
    return split_log(repaired_logs(logs, tiebreak, state))


def log_split_rows(logs: DataFrame, tiebreak=(), state: DataFrame | None = None) -> DataFrame:
    return log_rows(repaired_logs(logs, tiebreak, state))


def visit_starts(pages: DataFrame) -> DataFrame:
    """Page rows without a page before them."""
    return pages.where(F.col("page.last_page_id").isNull())


def unique_visits(pages: DataFrame, tiebreak=()) -> DataFrame:
    """The first visit of each device on each day. ``pages`` carries ``et``."""
    return first_per_day(visit_starts(pages), "common.mid", "et", tiebreak)


def bounce_visits(pages: DataFrame, within: str = "10 seconds", tiebreak=(), bucket: str | None = None) -> DataFrame:
    """Visits that end after one page. ``pages`` carries ``et``."""
    return bounces(pages, "common.mid", "et", "page.last_page_id", within, tiebreak, bucket)


SEGMENT = {"vc": "common.vc", "ch": "common.ch", "ar": "common.ar", "is_new": "common.is_new"}
TRAFFIC = ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]


def traffic_by_segment(
    pages: DataFrame, visits: DataFrame, bounced: DataFrame, size: str = "10 seconds", watermark: str = "14 seconds",
    heartbeats: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Visitors, sessions, pages, time on page and bounces per version, channel, area and is_new.

    The three inputs carry ``et``. On streams they are separate tables, each with a watermark of its own, and the job's watermark is
    the least of these (Spark's policy ``min``): no row is late because another input is further on. So an input that stands still holds all
    windows open. ``heartbeats`` may hold a stream of times ``et`` for each of "pages", "visits" and "bounced", by which the job that
    writes it tells that nothing older will come; its rows move that input's watermark and are not counted.
    """
    dims = {**SEGMENT, "et": "et"}
    session = F.when(F.col("page.last_page_id").isNull(), 1).otherwise(0).cast("long")
    stay = F.coalesce("page.during_time", F.lit(0)).cast("long")
    pv = measures(pages, dims, uv_ct=0, sv_ct=session, pv_ct=1, dur_sum=stay, uj_ct=0)
    uv = measures(visits, dims, uv_ct=1, sv_ct=0, pv_ct=0, dur_sum=0, uj_ct=0)
    uj = measures(bounced, dims, uv_ct=0, sv_ct=0, pv_ct=0, dur_sum=0, uj_ct=1)
    parts = {"pages": pv, "visits": uv, "bounced": uj}
    if pages.isStreaming:
        parts = {name: _marked(df, watermark, (heartbeats or {}).get(name)) for name, df in parts.items()}
    rows = parts["pages"].unionByName(parts["visits"]).unionByName(parts["bounced"])
    return tumble(rows, "et", size, list(SEGMENT), {m: F.sum(m) for m in TRAFFIC})


def _marked(rows: DataFrame, watermark: str, beats: DataFrame | None) -> DataFrame:
    """A watermark over rows and heartbeats, and then the rows alone."""
    if beats is None:
        return rows.withWatermark("et", watermark)
    both = rows.withColumn("_beat", F.lit(False)).unionByName(beats.select("et", F.lit(True).alias("_beat")), allowMissingColumns=True)
    # The condition names the time, so that it is not moved in front of the watermark.
    return both.withWatermark("et", watermark).where(F.when(F.col("et").isNotNull(), ~F.col("_beat"))).drop("_beat")


def page_visitors(pages: DataFrame, tiebreak=()) -> DataFrame:
    """First row per device, day and page, for the home and detail pages. Stream: live.page_visitors."""
    wanted = pages.where(F.col("page.page_id").isin(HOME, DETAIL))
    keys = ["common.mid", "page.page_id", F.to_date("et")]
    return first_by(wanted, keys, ["et", *tiebreak])


def page_uniques(visitors: DataFrame, size: str = "10 seconds", watermark: str = "2 seconds") -> DataFrame:
    """Daily unique visitors of the home and detail pages per window, from ``page_visitors``."""
    def flag(page):
        return F.sum(F.when(F.col("page.page_id") == page, 1).otherwise(0)).cast("long")

    return tumble(visitors, "et", size, [], {"home_uv_ct": flag(HOME), "good_detail_uv_ct": flag(DETAIL)}, watermark)


def searched_words(pages: DataFrame, segmenter=None) -> DataFrame:
    """(et, keyword) for every word of every search."""
    searches = pages.where(
        F.col("page.item").isNotNull()
        & (F.col("page.item_type") == "keyword")
        & (F.col("page.last_page_id") == "search")
    )
    return tokenize(searches.select("et", F.col("page.item").alias("item")), "item", segmenter=segmenter).drop("item")


def keyword_counts(pages: DataFrame, size: str = "10 seconds", watermark: str = "2 seconds", segmenter=None) -> DataFrame:
    """Search words per window."""
    counts = tumble(searched_words(pages, segmenter), "et", size, ["keyword"], {"keyword_count": F.count("*")}, watermark)
    return counts.withColumn("source", F.lit("search")).select("stt", "edt", "source", "keyword", "keyword_count")
