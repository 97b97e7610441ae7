"""Exact deduplication with keyed streaming state that never expires.

The stream keeps, for each SHA-256 of a normalised text, the stable identifier of the row that stays,
the locator of its content (file and row number) and the number of rows seen. State is in RocksDB on
the executors' disks and is uploaded to the checkpoint folder, so a lost executor loses nothing. Map
tasks reduce their rows to one per digest first; a text with a third of all rows sends one row per task.

A digest seen more than once is a hit, not yet a copy: its rows are compared byte for byte with the
content at the locator, and texts that only share a digest are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.llm.common import SPACE, Scratch, whole

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(whole(text), SPACE, " ")


def digest_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = normalised(F.col(text_col))
    return df.select(
        F.col(id_col).alias("doc_id"), norm.alias("norm"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    ).withColumn("digest", digest_of(F.col("norm")))


def _first() -> Column:
    """Orders rows of one text: smallest identifier (null last), then place."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")


def digest_state(spark: SparkSession, path: str, scratch: Scratch, id_col: str, text_col: str,
                 digest=digest_of, **source_options: str) -> DataFrame:
    """Run the stream over the files of a table until all are read: (digest, first, n), one row per digest.

    A run that is started again with the same scratch folder goes on where it stopped; batches
    overwrite their own folder, so a repeated batch changes nothing.
    """
    updates, checkpoint = f"{scratch.folder}/updates", f"{scratch.folder}/checkpoint"
    schema = spark.read.parquet(path).schema
    own = spark.newSession()  # settings of the caller's session stay as they are
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Else every state partition sets aside megabytes of disk for its log before it holds a row.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # As a pattern, so that a table of one file is accepted as well as a folder of files.
    parent, _, name = path.rstrip("/").rpartition("/")
    stream = own.readStream.schema(schema).options(**source_options).parquet(f"{parent}/{{{name}}}")
    state = (
        _rows(stream, id_col, text_col).withColumn("digest", digest(F.col("norm")))
        .groupBy("digest").agg(F.min(_first()).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    own.createDataFrame([], state.schema).write.mode("overwrite").parquet(f"{updates}/batch=-1")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    query = (
        state.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = spark.read.schema(state.schema).parquet(f"{updates}/batch=*")
    return scratch.keep(seen.groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n")), "state")


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                digest=digest_of, **source_options: str) -> DataFrame:
    """Which row of each text stays, for the table of Parquet files at ``path``.

    Returns one row per row read: doc_id, keep_id (identifier of the row that stays), group_size,
    kept, text_sha256. The row that stays has the smallest identifier; null identifiers come last, and
    rows with equal identifiers are ordered by file and row number, so one row is kept always. Null
    and empty texts are one text. No rows give no rows. Other columns are not read.

    ``digest`` may be replaced by a weaker one (tests do so to force collisions); ``source_options``
    go to the stream's file source, such as maxFilesPerTrigger.
    """
    scratch = Scratch(spark, "dedup")
    state = digest_state(spark, path, scratch, id_col, text_col, digest, **source_options)
    rows = _rows(spark.read.parquet(path), id_col, text_col).withColumn("key", digest(F.col("norm")))

    # Rows of texts that came more than once, with their bytes.
    again = state.where("n > 1").select(F.col("digest").alias("key"), "first")
    hits = scratch.keep(rows.join(again, "key").select(
        "key", "norm", "doc_id", "file", "row", "first",
        ((F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))).alias("stays"),
    ), "hits")
    content = hits.where("stays").select("key", F.col("norm").alias("stored"))
    # Distinct only after writing: a step that needs the join's partitions would keep a hot text's rows from being split.
    clash = scratch.keep(hits.where("NOT stays").join(content, "key").where(F.col("norm") != F.col("stored")).select("key"), "clash").distinct()

    # Texts that share a digest: grouped by their bytes. Empty unless the digest is weak.
    parted = (
        hits.join(clash, "key").groupBy("key", "norm").agg(F.min(_first()).alias("own_first"), F.count(F.lit(1)).alias("own_n"))
    )
    parted = scratch.keep(parted.select("key", digest_of(F.col("norm")).alias("text_sha256"), "own_first", "own_n"), "parted")
    scratch.drop(hits)

    whole_rows = (
        rows.select("key", "doc_id", "file", "row", F.col("digest").alias("text_sha256"))
        .join(state.withColumnRenamed("digest", "key"), "key")
        .join(F.broadcast(parted) if parted.isEmpty() else parted, ["key", "text_sha256"], "left")
    )
    first, n = F.coalesce("own_first", "first"), F.coalesce("own_n", "n")
    return whole_rows.select(
        "doc_id", first["doc_id"].alias("keep_id"), n.alias("group_size"),
        ((F.col("file") == first["file"]) & (F.col("row") == first["row"])).alias("kept"), "text_sha256",
    )
