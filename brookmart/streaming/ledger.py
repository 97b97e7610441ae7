"""A written table of keys seen so far, for operators that must remember a key without a time limit.

Used inside ``foreachBatch``. Keys are dealt to buckets by their hash, each bucket is a folder of a versioned table (sinks.versions),
and a batch reads only the buckets that its own keys fall in, as they were before it: a batch that runs again after a failure gives the same
result. Parts are merged as batches come, so a bucket has a number of files that grows with the logarithm of the batches.
Lookups are joins over the whole micro-batch; a hot key reaches the join as one pre-reduced row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brookmart.operators.state import first_by, of_keys
from brookmart.sinks.versions import VersionedTable, batch_path

BUCKET = "_bucket"


class Ledger:
    """``keys`` identify a row; ``by`` (all keys, if not given) are those whose hash tells the bucket, so that lookups may be by them alone.

    ``prune`` may drop rows that no lookup needs any more; it sees some of the rows of a bucket when they are merged.
    """

    def __init__(self, path: str, schema: T.StructType, keys: list[str], by: list[str] | None = None, buckets: int = 64,
                 prune: Callable[[DataFrame], DataFrame] | None = None):
        self.path, self.schema, self.keys, self.by, self.buckets = path, schema, keys, by or keys, buckets
        self.table = VersionedTable(path, keys, [], keep="first", split=BUCKET, prune=prune)

    def _bucket(self) -> Column:
        # As the ledger's own types, whatever those of the looked-up rows: other types have other hashes.
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.by]), F.lit(self.buckets)).cast("int")

    def _read(self, spark: SparkSession, upto: int, buckets: list[int] | None = None) -> DataFrame:
        if self.table.manifest(spark, upto) is None:
            return spark.createDataFrame([], self.schema)
        return self.table.read(spark, upto, buckets).select(*self.schema.names)

    def known(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """All keys recorded before this batch."""
        return self._read(spark, batch_id - 1)

    def near(self, rows: DataFrame, upto: int) -> DataFrame:
        """What was recorded up to batch ``upto`` in the buckets that the keys of ``rows`` fall in."""
        touched = [r[0] for r in rows.select(self._bucket()).distinct().collect()]  # at most ``buckets``
        return self._read(rows.sparkSession, upto, touched)

    def known_of(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows recorded before this batch for the keys (``by``) that occur in ``rows``."""
        return of_keys(self.near(rows, batch_id - 1), rows, self.by)

    def record(self, rows: DataFrame, batch_id: int, order: list[str]) -> DataFrame:
        """Write the keys of ``rows`` that are new, one row each, and return the written rows."""
        spark = rows.sparkSession
        first = first_by(rows, self.keys, order).select(*self.schema.names)
        fresh = first.join(of_keys(self.near(rows, batch_id - 1), rows, self.by), self.keys, "left_anti")
        self.table.commit(fresh.select(*self.schema.names, self._bucket().alias(BUCKET)), batch_id)
        layout = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return spark.read.schema(layout).parquet(batch_path(self.path, batch_id)).select(*self.schema.names)

    def matching(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Recorded rows, up to and including this batch, for the keys that occur in ``rows``."""
        return of_keys(self.near(rows, batch_id), rows, self.by)
