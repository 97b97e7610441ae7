"""Versioned tables and what is built on them: upserts, dimensions, ledgers, joint commits."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from brookmart import schemas
from brookmart.plans import live
from brookmart.sinks import read_dim_table, read_upsert, upsert_batch, upsert_dims
from brookmart.sinks.dims import known_tables, upsert_batch as upsert_dims_batch
from brookmart.sinks.files import children, exists, read_json, write_json
from brookmart.sinks.versions import VersionedTable, batch_path
from brookmart.streaming.jobs import run_to_end
from brookmart.streaming.ledger import Ledger
from tests.test_operators import change, changes, rows
from tests.test_streams import Feed


def table_of(spark, *data):
    return spark.createDataFrame(data, "k string, seq int, v string")


def test_a_hundred_batches_are_read_from_few_parts(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), ["k"], ["seq"], fan=4, retain=3)
    r, want = random.Random(1), {}
    for n in range(100):
        batch = [(f"k{r.randrange(30)}", r.randrange(50), f"{n}") for _ in range(5)]
        table.commit(table_of(spark, *batch).coalesce(1), n)
        best = {}
        for k, seq, v in batch:
            best[k] = max(best.get(k, (-1, "")), (seq, v))
        for k, (seq, v) in best.items():
            if seq >= want.get(k, (-1, ""))[0]:
                want[k] = (seq, v)
    got = table.read(spark)
    assert {x.k: (x.seq, x.v) for x in got.collect()} == want
    assert len(table.manifest(spark)["parts"]) <= 3 * 4
    assert len(got.inputFiles()) <= 3 * 4
    assert len(children(spark, f"{table.root}/_manifests")) == 3
    assert len([n for n in children(spark, table.root) if n.startswith("batch_id=")]) <= 4 + 3 * 2


def test_a_reader_sees_one_version_whatever_is_merged(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), ["k"], ["seq"], fan=3, retain=3)
    for n in range(4):
        table.commit(table_of(spark, ("a", n, f"v{n}"), (f"b{n}", 0, "x")), n)
    before = table.read(spark)
    want = rows(before)
    table.commit(table_of(spark, ("a", 9, "v9")), 4)
    table.commit(table_of(spark, ("a", 10, "v10")), 5)  # merges
    assert rows(before) == want
    assert rows(table.read(spark, upto=3)) == want
    assert rows(table.read(spark).where("k = 'a'"), "v") == [("v10",)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_batch(table_of(spark, ("a", 1, "x")), 0, path, ["k"], ["seq"])
    # A try of batch 1 that stopped before its manifest: its rows are there, but no reader sees them.
    table_of(spark, ("a", 5, "half")).write.parquet(batch_path(path, 1))
    assert rows(read_upsert(spark, path, ["k"], ["seq"]), "v") == [("x",)]
    for _ in range(2):
        upsert_batch(table_of(spark, ("a", 2, "y")), 1, path, ["k"], ["seq"])
        assert rows(read_upsert(spark, path, ["k"], ["seq"]), "v") == [("y",)]
    with pytest.raises(ValueError, match="older"):
        upsert_batch(table_of(spark, ("a", 3, "z")), 0, path, ["k"], ["seq"])


def test_a_failure_while_merging_is_repeated_from_the_last_version(spark, tmp_path, monkeypatch):
    table = VersionedTable(str(tmp_path / "t"), ["k"], ["seq"], fan=2)
    table.commit(table_of(spark, ("a", 1, "x"), ("b", 1, "x")), 0)
    with monkeypatch.context() as m:
        m.setattr("brookmart.sinks.versions.write_json", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            table.commit(table_of(spark, ("a", 2, "y")), 1)
    assert rows(table.read(spark), "k", "v") == [("a", "x"), ("b", "x")]
    table.commit(table_of(spark, ("a", 2, "y")), 1)
    assert rows(table.read(spark), "k", "v") == [("a", "y"), ("b", "x")]
    assert [p["level"] for p in table.manifest(spark)["parts"]] == [1]


def test_nulls_ties_and_empty_batches(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), ["k"], ["seq"], fan=2)
    with pytest.raises(ValueError, match="nothing published"):
        table.read(spark)
    table.commit(table_of(spark), 0)
    assert rows(table.read(spark)) == []
    table.commit(table_of(spark, (None, None, "n"), ("a", None, "first")), 1)
    table.commit(table_of(spark, ("a", None, "tie"), (None, 1, "m")), 2)
    assert sorted(x.v for x in table.read(spark).collect()) == ["m", "tie"]


def test_dimension_tables_compact_and_know_their_columns(spark, tmp_path):
    root = str(tmp_path / "dims")
    config = spark.createDataFrame([("user", "dim_user", "id, name", None, None), ("sku", "dim_sku", "id", None, None)], schemas.ROUTE)
    for n in range(20):
        upsert_dims_batch(changes(spark, change("user", "insert", {"id": "1", "name": f"n{n}"}, ts=n), change("user", "insert", {"name": f"lost{n}"}, ts=n)), config, n, root)
    got = read_dim_table(spark, root, "dim_user", ["id", "name"])
    assert rows(got) == [("1", "n19")]
    assert len(got.inputFiles()) <= 2 * 8 and all("sink_table=dim_user" in f for f in got.inputFiles())
    assert rows(read_dim_table(spark, root, "dim_sku", ["id"])) == []
    assert known_tables(spark, root) == {"dim_user": ["id", "name"], "dim_sku": ["id"]}
    assert read_dim_table(spark, root, "rows_without_key", ["name"]).count() == 20


def test_a_batch_that_runs_again_keeps_its_configuration(spark, tmp_path):
    root, layout = str(tmp_path / "dims"), changes(spark).schema
    feed = Feed(spark, tmp_path / "in", layout)
    feed.add(changes(spark, change("user", "insert", {"id": "1", "name": "x"}, ts=1)))
    routes, fail = ["old_table"], [True]

    def config(session):
        return session.createDataFrame([("user", routes[0], "id,name", None, None)], schemas.ROUTE)

    def changed(session):
        out = config(session)
        if fail[0]:
            fail[0] = False
            routes[0] = "new_table"  # the route changes after the batch has taken its own
            write_json(session, f"{root}/stop", 1)
        return out

    import brookmart.sinks.dims as dims

    real = dims.upsert_batch

    def failing(batch, conf, batch_id, where):
        if exists(spark, f"{root}/stop"):
            dims.delete(spark, f"{root}/stop")
            raise OSError("executor lost")
        real(batch, conf, batch_id, where)

    dims.upsert_batch = failing
    try:
        with pytest.raises(Exception, match="executor lost"):
            run_to_end(upsert_dims(feed.stream(), changed, root, str(tmp_path / "cp")))
        run_to_end(upsert_dims(feed.stream(), changed, root, str(tmp_path / "cp")))
        feed.add(changes(spark, change("user", "insert", {"id": "2", "name": "y"}, ts=2)))
        run_to_end(upsert_dims(feed.stream(), changed, root, str(tmp_path / "cp")))
    finally:
        dims.upsert_batch = real
    assert rows(read_dim_table(spark, root, "old_table", ["id"])) == [("1",)]
    assert rows(read_dim_table(spark, root, "new_table", ["id"])) == [("2",)]
    assert read_json(spark, f"{root}/_config/0.json")["rows"][0][1] == "old_table"


def test_a_ledger_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "l"), T.StructType.fromDDL("k string, v string"), ["k"], buckets=16)
    r, seen = random.Random(3), {}
    for n in range(20):
        batch = [(f"k{r.randrange(60)}", n, f"{n}") for _ in range(3)]
        fresh = {}
        for k, _, v in batch:
            if k not in seen:
                fresh.setdefault(k, v)
        got = ledger.record(table_of(spark, *batch), n, ["seq"])
        assert {x.k: x.v for x in got.collect()} == fresh
        seen |= fresh
        near = ledger.near(table_of(spark, *batch), n)
        touched = {f.partition("_bucket=")[2].partition("/")[0] for f in near.inputFiles()}
        assert len(touched) <= 3 and len(near.inputFiles()) <= 3 * 2 * 8
        assert {x.k: x.v for x in ledger.matching(table_of(spark, *batch), n).collect()} == {k: seen[k] for k, _, _ in batch}
    assert {x.k: x.v for x in ledger.known(spark, 20).collect()} == seen


def test_a_ledger_forgets_old_days_when_it_merges(spark, tmp_path):
    layout = "common struct<uid string>, page struct<last_page_id string>, ts long, et timestamp"
    f = Feed(spark, tmp_path / "in", layout)
    for day in range(1, 20):
        f.add(spark.sql(f"SELECT named_struct('uid', 'u') AS common, named_struct('last_page_id', cast(null as string)) AS page, 0L AS ts, timestamp'2024-01-{day:02} 08:00:00' AS et"))
    f.add(spark.sql("SELECT named_struct('uid', 'u') AS common, named_struct('last_page_id', cast(null as string)) AS page, 0L AS ts, timestamp'2024-01-03 09:00:00' AS et"))
    run_to_end(live.login_days(f.stream(), str(tmp_path / "o"), str(tmp_path / "cp"), memory=5))
    got = spark.read.parquet(str(tmp_path / "o/rows"))
    assert got.count() == got.select("day").distinct().count() == 19
    kept = Ledger(str(tmp_path / "o/seen"), T.StructType.fromDDL("uid string, day date"), ["uid", "day"], by=["uid"]).known(spark, 99)
    assert kept.count() < 19 and rows(kept.agg(F.max(F.dayofmonth("day")))) == [(19,)]


def test_outputs_of_a_job_appear_together(spark, tmp_path, monkeypatch):
    def log(mid, extra=""):
        return f'{{"common":{{"mid":"{mid}","is_new":"1"}},"page":{{"page_id":"p"}}{extra},"ts":1704067200000}}'

    f = Feed(spark, tmp_path / "in", "value string")
    f.add(spark.createDataFrame([(log("a"),), ("broken {",)], "value string"))
    root, cp = str(tmp_path / "o"), str(tmp_path / "cp")
    run_to_end(live.log_split(f.stream(), root, cp))
    f.add(spark.createDataFrame([(log("a"),), (log("b"),), ("bad {",)], "value string"))
    real, calls = live._write, []

    def stops(rows_, out, *rest):
        calls.append(out)
        if out.endswith("/dirty"):
            raise OSError("killed between the writes")
        real(rows_, out, *rest)

    monkeypatch.setattr(live, "_write", stops)
    with pytest.raises(Exception, match="killed between"):
        run_to_end(live.log_split(f.stream(), root, cp))
    assert [c.rpartition("/")[2] for c in calls] == ["logs", "dirty"]
    assert spark.read.parquet(f"{root}/logs").count() == 3  # written, but not committed
    assert live.committed(spark, root, "logs").count() == 1 and live.committed(spark, root, "dirty").count() == 1
    monkeypatch.setattr(live, "_write", real)
    run_to_end(live.log_split(f.stream(), root, cp))
    assert live.committed(spark, root, "logs").count() == 3 and live.committed(spark, root, "dirty").count() == 2
