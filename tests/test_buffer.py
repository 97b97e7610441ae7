"""The buffer of processing time before the newest version of a key."""

import time
from datetime import datetime

from brookmart.streaming.buffer import newest_after_pause
from tests.test_streams import Feed

LAYOUT = "id string, v long, name string, et timestamp"
ET = datetime(2024, 1, 1, 0, 0, 0, 123_456)


def versions(spark, *data):
    return spark.createDataFrame([(*d, ET) for d in data], LAYOUT)


def test_the_newest_inside_the_pause_and_again_after_it(spark, tmp_path):
    f = Feed(spark, tmp_path / "in", LAYOUT)
    f.add(versions(spark, ("a", 1, "old"), ("b", 7, "only"), (None, None, "none"), ("c", 2, "x"), ("c", 2, "y")))
    out = str(tmp_path / "o")
    df = newest_after_pause(f.stream(), "id", "v", "15 seconds")
    assert df.dtypes == f.stream().dtypes
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start()

    def told(n):
        end = time.time() + 60
        while time.time() < end and q.isActive:
            try:
                rows = spark.read.schema(LAYOUT).parquet(out).collect()
            except Exception:  # nothing is written yet
                rows = []
            if len(rows) >= n:
                assert {r["et"] for r in rows} == {ET}
                return sorted((tuple(r)[:3] for r in rows), key=str)
            time.sleep(0.5)
        raise AssertionError(q.exception() or f"fewer than {n} rows")

    try:
        while not q.lastProgress or not q.lastProgress.numInputRows and q.lastProgress.batchId < 1:
            time.sleep(0.1)
        f.add(versions(spark, ("a", 3, "new"), ("a", 2, "late")))  # inside the pause
        first = told(4)
        assert first == sorted([("a", 3, "new"), ("b", 7, "only"), (None, None, "none"), ("c", 2, "y")], key=str)
        f.add(versions(spark, ("a", 4, "newest")))  # outside: a pause of its own
        assert told(5) == sorted([*first, ("a", 4, "newest")], key=str)
    finally:
        q.stop()
