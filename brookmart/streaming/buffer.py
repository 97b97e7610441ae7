"""The newest version of a key within a pause of processing time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from brookmart.functions.dates import seconds_of
from brookmart.operators.columns import as_col

#: Times in row texts; by default these would be cut to milliseconds.
MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def newest_after_pause(df: DataFrame, key: str, version: str, pause: str = "5 seconds") -> DataFrame:
    """The newest row of each key, let out ``pause`` after the first row that waits; later rows start a new pause.

    ``version`` is a whole number; null is the oldest, and of equal versions the greater row text counts, whatever comes first. The state
    holds one row per waiting key and is dropped when the row is let out. Rows of null keys share one pause. Columns are those of ``df``.
    """
    rows = df.select(
        as_col(key).cast("string").alias("k"),
        F.coalesce(as_col(version).cast("long"), F.lit(-(2**63))).alias("version"),
        F.to_json(F.struct(*df.columns), MICROSECONDS).alias("row"),
    )
    out = rows.groupBy("k").transformWithStateInPandas(
        statefulProcessor=_Newest(round(seconds_of(pause) * 1000)),
        outputStructType=T.StructType.fromDDL("row string"),
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    return out.select(F.from_json("row", df.schema, MICROSECONDS).alias("r")).select("r.*")


class _Newest(StatefulProcessor):
    def __init__(self, pause_ms: int):
        self.pause_ms = pause_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "version long, row string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting = self.newest.get() if self.newest.exists() else None
        best = tuple(waiting) if waiting else None
        for pdf in rows:
            top = pdf[pdf["version"] == pdf["version"].max()]
            found = (int(top["version"].iloc[0]), top["row"].max())
            best = found if best is None or found > best else best
        if best:
            self.newest.update(best)
            if not waiting:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.pause_ms)
        yield pd.DataFrame({"row": pd.Series(dtype="object")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        row = self.newest.get()[1]
        self.newest.clear()
        yield pd.DataFrame({"row": [row]})

    def close(self) -> None:
        pass
