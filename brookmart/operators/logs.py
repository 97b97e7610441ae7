"""Splitting one behaviour log into its five kinds of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def split_log(df: DataFrame) -> dict[str, DataFrame]:
    """error (any log with err), start, or page with its display and action rows.

    A log is either a start log or a page log. Displays and actions carry common and page of their
    log, and its ts where they have none of their own; a missing or empty array gives no rows. All
    five read the same input: persist it first when more than one is written.
    """
    carried = [c for c in df.columns if c not in ("err", "start", "display", "action", "page", "common", "ts")]
    pages = df.where(F.col("start").isNull())

    def items(name: str) -> DataFrame:
        rows = pages.select("common", "page", "ts", *carried, F.explode(name).alias("_i"))
        fields = df.schema[name].dataType.elementType.names
        time = F.coalesce("_i.ts", "ts") if "ts" in fields else F.col("ts")
        return rows.select(
            *[f"_i.{f}" for f in fields if f != "ts"], "common", "page", time.alias("ts"), *carried
        )

    return {
        "error": df.where(F.col("err").isNotNull()),
        "start": df.where(F.col("start").isNotNull()).drop("err", "display", "action", "page"),
        "page": pages.select("common", "page", "ts", *carried),
        "display": items("display"),
        "action": items("action"),
    }


def log_rows(df: DataFrame) -> DataFrame:
    """The same five kinds of rows in one table and one pass, for ``write.partitionBy("kind")``.

    Columns: kind, item (the display or action, as JSON text), err, start, display, action, common, page,
    ts. Columns that a kind does not have are null; an error row is the whole log, with its arrays.
    """
    carried = [c for c in df.columns if c not in ("err", "start", "display", "action", "page", "common", "ts")]
    is_page = F.col("start").isNull()

    def one(kind: str, cond):
        row = F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("item"), F.col("ts").alias("ts"))
        return F.when(cond, F.array(row)).otherwise(F.array())

    def many(kind: str):
        has_ts = "ts" in df.schema[kind].dataType.elementType.names
        rows = F.transform(kind, lambda i: F.struct(
            F.lit(kind).alias("kind"), F.to_json(i).alias("item"),
            (F.coalesce(i["ts"], F.col("ts")) if has_ts else F.col("ts")).alias("ts"),
        ))
        return F.when(is_page & F.col(kind).isNotNull(), rows).otherwise(F.array())

    kinds = F.concat(
        one("error", F.col("err").isNotNull()), one("start", ~is_page), one("page", is_page), many("display"), many("action")
    )
    rows = df.select(F.explode(kinds).alias("_k"), *[c for c in df.columns if c != "ts"])
    kind = F.col("_k.kind")
    return rows.select(
        kind.alias("kind"), "_k.item", F.when(kind == "error", F.col("err")).alias("err"),
        F.when(kind.isin("start", "error"), F.col("start")).alias("start"),
        *[F.when(kind == "error", F.col(c)).alias(c) for c in ("display", "action")], "common", "page", "_k.ts", *carried,
    )
