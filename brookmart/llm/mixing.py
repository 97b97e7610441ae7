"""Mix sources to target weights with Efraimidis-Spirakis sampling.

Every document draws an exponential key scaled by its quality weight, -ln(u) / w. In the order of
these keys a prefix of a source is a weighted sample without replacement, so the words that remain of a
source's target after its complete epochs are filled from the front of that order.

A source may hold any share of the rows: the order is made by a range shuffle over (source, key), the
sums per range are added up in a small table, and only rows of one range meet in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, whole, word_count

WEIGHTS = (5.0, 2.0, 1.0)
NOT_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]"


def letter_share(text: Column, words: Column) -> Column:
    """Quality weight in [0.05, 1]: the share of letters among all characters but one white space for each word."""
    t = whole(text)
    shown = F.greatest(F.length(t) - words, F.lit(1))
    letters = F.length(F.regexp_replace(t, NOT_LETTERS, ""))
    return 0.05 + 0.95 * F.least(letters / shown, F.lit(1.0))


def uniform(name: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the name and the seed alone; null counts as a name."""
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digits, 1, 13), 16, 10).cast("long") + 0.5) / float(2**52)


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources by code point, null last, take the weights in turn and share ``budget`` times all words. No
    target is above ``most`` times its source; what is cut off goes to the others by weight. That is
    min(most * size, weight * level) for one common level. With sources in the order in which they
    reach their limit, the level left by those before a source rises up to the first that is not
    limited and falls after it, so the level is the largest of these.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", "n").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("n", F.row_number().over(by_name))
        .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.col("n") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("all_size", F.sum("source_size").over(all_rows))
        .withColumn("all_w", F.sum("w").over(all_rows))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("capped_w", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    )
    level = F.max((F.lit(budget) * F.col("all_size") - F.col("capped")) / (F.col("all_w") - F.col("capped_w"))).over(all_rows)
    return ranked.withColumn("level", level).select(
        "source", "source_size", F.least(F.col("cap"), F.col("w") * F.col("level")).alias("target"),
    )


def mix_sources(docs: DataFrame, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weight: str | None = None, weights=WEIGHTS, budget: float = 1.5,
                most: float = 2.0, seed: int = 17) -> DataFrame:
    """How many words of each document the mix takes.

    Returns a row for every row of ``docs``: ``row`` (a struct of the columns in ``carry``, all by default, so
    no name can clash), size and source_size (words), target, taken and copies. ``taken`` adds up
    to the target of each source, rounded to a word: whole epochs first, then documents in the order of their keys; the
    last of these may be taken in part. ``copies`` is taken / size to the nearest number, for writers of
    whole documents.

    ``weight`` names a column of ``carry`` with the documents' quality weights; without it ``letter_share`` is taken.
    Null sources are one source of their own, the last. Null and empty texts have size 0 and take 0.
    Rows with equal identifiers have equal keys and are ordered by size; equal rows are interchangeable.
    No rows give no rows. Reruns give the same result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    order = ["source", "key", F.col("id").asc_nulls_last(), "size"]
    # Texts are read for their statistics once; the range shuffle then samples the kept columns alone.
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry or docs.columns)).alias("row"), F.col(source_col).alias("source"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), word_count(F.col(text_col)).alias("size"),
    )
    w = letter_share(F.col("text"), F.col("size")) if weight is None else F.col(f"row.{weight}").cast("double")
    keyed = scratch.keep(
        keyed.withColumn("key", -F.log(uniform(F.col("id"), seed)) / F.greatest(w, F.lit(1e-9))).drop("text"), "keyed",
    )
    placed = scratch.keep(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "placed",
    )
    scratch.drop(keyed)

    parts = placed.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    goals = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, budget, most)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.withColumn("before_part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
        .join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("source").alias("s"), F.col("part").alias("p"), "before_part", "source_size", "target")
    )
    in_part = Window.partitionBy("part", "source").orderBy("key", F.col("id").asc_nulls_last(), "size")
    before = F.sum("size").over(in_part.rowsBetween(Window.unboundedPreceding, -1))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long")
    part_taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before_part") - F.col("before")))
    return (
        placed.join(offsets, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .withColumn("epochs", epochs.cast("long")).withColumn("rest", rest)
        .withColumn("taken", (F.col("epochs") * F.col("size") + part_taken).cast("long"))
        .withColumn("copies", F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int"))
        .select("row", "size", "source_size", "target", "taken", "copies")
    )
