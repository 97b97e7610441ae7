"""A table of newest rows per key that a stream writes batch by batch, and that compacts while it does.

Every batch adds one part. When ``fan`` parts of a level have come together they become one part of the next level, with one row
per key, inside the batch that fills it up; so after n batches a read meets fan * log(n) parts at most. A manifest lists the parts of a
version and is published last. Readers take one manifest and see just its parts, whatever is written or merged meanwhile; old
parts go when ``retain`` later manifests no longer name them.

A batch that failed before its manifest overwrites its own parts when it runs again. One that had published is left as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brookmart.operators.joins import estimated_bytes
from brookmart.operators.state import first_by, latest_by_key
from brookmart.sinks.files import children, delete, read_json, write_json

MANIFESTS = "_manifests"
#: Bytes of rows below which all are shuffled to find the newest of a key, and hashes of keys that a read may send to all tasks.
WHOLE, MORE = 32 << 20, 500_000


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def published(spark: SparkSession, folder: str, upto: int | None = None) -> int | None:
    """The newest number published in a folder of numbered files, not above ``upto``."""
    numbers = [int(name.removesuffix(".json")) for name in children(spark, folder) if name.endswith(".json") and not name.startswith("_")]
    return max((n for n in numbers if upto is None or n <= upto), default=None)


class VersionedTable:
    """See the module. ``seq`` orders the versions of a key; with ``keep='last'`` the greatest counts, with 'first' the least, and of equal ones the later batch.

    ``split`` names a column by whose values parts are cut into folders, which may be read alone. With ``loose`` rows that have a null in
    ``keys`` are no versions of each other and are all kept. With ``spread`` the folder of one value is written by
    many tasks, for values that are few and have many rows. ``prune`` may drop rows when parts are merged. ``retain=None`` keeps all parts, as for a table whose parts are the source of another stream.
    Without ``reduced`` the part of a batch has its rows as they are, for batches with few versions of a key; merges and reads reduce them.
    """

    def __init__(self, root: str, keys: Iterable[str], seq: Iterable[str], keep: str = "last", split: str | None = None,
                 fan: int = 8, retain: int | None = 8, loose: bool = False, prune: Callable[[DataFrame], DataFrame] | None = None,
                 spread: bool = False, reduced: bool = True):
        self.root, self.keys, self.seq, self.keep = root.rstrip("/"), list(keys), list(seq), keep
        self.split, self.fan, self.retain, self.loose, self.prune, self.spread = split, fan, retain, loose, prune or (lambda rows: rows), spread
        self.reduced = reduced

    def manifest(self, spark: SparkSession, upto: int | None = None) -> dict | None:
        """The newest version, or the newest not after batch ``upto``."""
        n = published(spark, f"{self.root}/{MANIFESTS}", upto)
        return None if n is None else read_json(spark, f"{self.root}/{MANIFESTS}/{n}.json")

    def reduce(self, rows: DataFrame) -> DataFrame:
        """One row per key."""
        known = rows
        if self.loose:
            has_key = F.lit(True)
            for k in self.keys:
                has_key &= F.col(k).isNotNull()
            known, rest = rows.where(has_key), rows.where(~has_key)
        if self.keep == "first":
            one = first_by(known, self.keys, [*self.seq, F.col("batch_id").desc()])
        else:
            one = latest_by_key(known, self.keys, [*self.seq, "batch_id"])
        return one.unionByName(rest) if self.loose else one

    def _newest(self, rows: DataFrame) -> DataFrame:
        """``reduce`` for many rows, most of them the only ones of their keys: just the others are shuffled whole.

        Hashes of all keys tell which may come more than once. Where these are many, all rows are shuffled.
        """
        if self.loose or estimated_bytes(rows) < WHOLE:
            return self.reduce(rows)
        key = F.xxhash64(*self.keys)
        more = rows.groupBy(key.alias("_hash")).count().where("count > 1").select("_hash").limit(MORE + 1).toArrow()
        if more.num_rows == 0:
            return rows
        if more.num_rows > MORE:
            return self.reduce(rows)
        few = F.broadcast(rows.sparkSession.createDataFrame(more))
        single, several = (rows.join(few, key == F.col("_hash"), how) for how in ("left_anti", "left_semi"))
        return single.unionByName(self.reduce(several))

    def _store(self, rows: DataFrame, folder: str, level: int) -> dict:
        spark, writer = rows.sparkSession, rows
        if self.split:
            tasks = [F.pmod(F.xxhash64(*self.keys), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))] if self.spread else []
            writer = rows.repartition(self.split, *tasks)
        out = writer.write.mode("overwrite")
        (out.partitionBy(self.split) if self.split else out).parquet(f"{self.root}/{folder}")
        part = {"folder": folder, "level": level}
        if self.split:
            part["splits"] = [name.partition("=")[2] for name in children(spark, f"{self.root}/{folder}") if name.startswith(f"{self.split}=")]
        return part

    def commit(self, rows: DataFrame, batch_id: int, **notes) -> None:
        """Add a batch of rows and publish the version with it. ``notes`` are kept in this and later manifests."""
        spark = rows.sparkSession
        newest = self.manifest(spark)
        if newest and newest["batch"] == batch_id:
            return
        if newest and newest["batch"] > batch_id:
            raise ValueError(f"batch {batch_id} is older than batch {newest['batch']} of {self.root}: was the stream's checkpoint replaced?")
        parts = list(newest["parts"]) if newest else []
        new = self.reduce(rows.withColumn("batch_id", F.lit(batch_id).cast("long"))).drop("batch_id") if self.reduced else rows
        parts.append(self._store(new, f"batch_id={batch_id}", 0))
        made = {"batch": batch_id, "schema": rows.schema.jsonValue(), "parts": parts, "merged": [], "notes": {**(newest["notes"] if newest else {}), **notes}}
        level = 0
        while len(full := [p for p in parts if p["level"] == level]) >= self.fan:
            merged = self._store(self.prune(self._newest(self._rows(spark, made, full))), f"_merged/{batch_id}-{level + 1}", level + 1)
            made["merged"] += [p["folder"] for p in full]  # of these the new ones are in no manifest's parts
            parts[:] = [p for p in parts if p["level"] > level] + [merged]
            level += 1
        write_json(spark, f"{self.root}/{MANIFESTS}/{batch_id}.json", made)
        self._sweep(spark)

    def note(self, spark: SparkSession, schema: T.StructType, **notes) -> None:
        """Publish notes alone, before the first batch."""
        if self.manifest(spark) is None:
            write_json(spark, f"{self.root}/{MANIFESTS}/-1.json", {"batch": -1, "schema": schema.jsonValue(), "parts": [], "merged": [], "notes": notes})

    def _sweep(self, spark: SparkSession) -> None:
        """Delete manifests before the last ``retain`` ones, and the parts that only they name."""
        if self.retain is None:
            return
        folder = f"{self.root}/{MANIFESTS}"
        numbers = sorted(int(n.removesuffix(".json")) for n in children(spark, folder) if n.endswith(".json") and not n.startswith("_"))
        old, kept = numbers[:-self.retain], numbers[-self.retain:]
        if old:
            named = {p["folder"] for n in kept for p in read_json(spark, f"{folder}/{n}.json")["parts"]}
            for n in old:
                past = read_json(spark, f"{folder}/{n}.json")
                gone = {*(p["folder"] for p in past["parts"]), *past["merged"]} - named
                delete(spark, f"{folder}/{n}.json")  # before its parts, so that no reader finds it without them
                for part in sorted(gone):
                    delete(spark, f"{self.root}/{part}")

    def _rows(self, spark: SparkSession, manifest: dict, parts: list[dict], splits: Iterable | None = None) -> DataFrame:
        """All rows of some parts, with the batch that each came with."""
        layout = T.StructType.fromJson(manifest["schema"])
        with_batch = T.StructType([*layout.fields, T.StructField("batch_id", T.LongType())])
        wanted = None if splits is None else {str(x) for x in splits}
        out = spark.createDataFrame([], with_batch)
        new = [p for p in parts if p["level"] == 0]
        for base, group in [(self.root, new), *((f"{self.root}/{p['folder']}", [p]) for p in parts if p["level"])]:
            paths = []
            for p in group:
                folder = f"{self.root}/{p['folder']}"
                paths += [folder] if wanted is None else [f"{folder}/{self.split}={x}" for x in p["splits"] if x in wanted]
                if self.split and not p["splits"] and wanted is None:
                    paths.remove(folder)
            if paths:
                out = out.unionByName(spark.read.schema(with_batch).option("basePath", base).parquet(*paths))
        return out

    def read(self, spark: SparkSession, upto: int | None = None, splits: Iterable | None = None, with_batch: bool = False) -> DataFrame:
        """One row per key, of the newest version (or the newest not after batch ``upto``), of all folders or those of the values ``splits``."""
        manifest = self.manifest(spark, upto)
        if manifest is None:
            raise ValueError(f"nothing published in {self.root}")
        rows = self._newest(self._rows(spark, manifest, manifest["parts"], splits))
        return rows if with_batch else rows.drop("batch_id")
