import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st

from lakeops.operators import upsert
from lakeops.sources import buckets, ingest, tables

DDL = "k int, k2 string, v int"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in (columns or df.columns)) for r in df.collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "a", 20), (None, "a", 30), (3, None, 40)], DDL)


def test_key_expression():
    assert upsert.key_columns("a|b ") == ["a", "b"]
    assert upsert.match_condition("a|b") == "old.`a` = updates.`a` and old.`b` = updates.`b`"
    with pytest.raises(ValueError):
        upsert.key_columns("a||b")


def test_upsert_all_with_null_keys(spark, target):
    updates = spark.createDataFrame([(2, "a", 21), (9, "a", 90), (None, "a", 31), (3, None, 41)], DDL)
    out = upsert.upsert_all(target, updates, ["k", "k2"], with_op=True)
    assert rows(out) == sorted(
        [
            (1, "a", 10, "kept"), (2, "a", 21, "updated"), (9, "a", 90, "inserted"),
            (None, "a", 30, "kept"), (None, "a", 31, "inserted"), (3, None, 40, "kept"), (3, None, 41, "inserted"),
        ],
        key=str,
    )
    assert rows(upsert.upsert_all(target, updates, ["k", "k2"])) == rows(out.drop("_op"))


def test_empty_sides(spark, target):
    none = spark.createDataFrame([], DDL)
    assert rows(upsert.upsert_all(target, none, ["k", "k2"])) == rows(target)
    assert rows(upsert.upsert_all(none, target, ["k", "k2"])) == rows(target)


keyed = st.dictionaries(st.integers(0, 6), st.integers(0, 99), max_size=6)


@settings(max_examples=6, deadline=None)
@given(keyed, keyed)
def test_upsert_is_idempotent_and_keeps_keys_unique(spark, old, new):
    t = spark.createDataFrame([(k, "x", v) for k, v in old.items()], DDL)
    u = spark.createDataFrame([(k, "x", v) for k, v in new.items()], DDL)
    once = upsert.upsert_all(t, u, ["k"])
    twice = upsert.upsert_all(once, u, ["k"])
    want = sorted(((k, "x", v) for k, v in {**old, **new}.items()), key=str)
    assert rows(once) == want and rows(twice) == want


def test_evolving_adds_and_keeps_columns(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "old", 2)], "k int, kept string, v int")
    updates = spark.createDataFrame([(2, 22, "n"), (3, 33, "n")], "k int, v int, added string")
    out = upsert.upsert_evolving(target, updates, ["k"])
    assert out.columns == ["k", "kept", "v", "added"]
    assert rows(out) == [(1, "old", 1, None), (2, "old", 22, "n"), (3, None, 33, "n")]


def test_adding_follows_sql_nulls(spark):
    t = spark.createDataFrame([("a", 1), ("b", None), ("c", 5), (None, 7)], "k string, total int")
    u = spark.createDataFrame([("a", 2), ("b", 2), ("d", 4), (None, 1)], "k string, total int")
    out = upsert.upsert_adding(t, u, ["k"], ["total"])
    assert rows(out) == sorted([("a", 3), ("b", None), ("c", 5), ("d", 4), (None, 7), (None, 1)], key=str)


def test_replay_is_latest_wins(spark):
    history = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z"), (None, 1, "p"), (None, 2, "q")], "k int, load int, v string")
    assert rows(upsert.replay_latest(history, ["k"], ["load"]), "k", "v") == sorted([(1, "y"), (2, "z"), (None, "p"), (None, "q")], key=str)


def test_hash_merge_metrics(spark):
    ddl = "row_key string, row_bucket string, v int, first_load_id string, last_load_id string"
    t = spark.createDataFrame([("a1", "a", 1, "l1", "l1"), ("b1", "b", 2, "l1", "l1")], ddl)
    u = spark.createDataFrame([("b1", "b", 2, "l2", "l2"), ("c1", "c", 3, "l2", "l2")], ddl)
    merged = upsert.merge_by_hash(t, u, with_op=True)
    assert rows(merged, "row_key", "first_load_id", "last_load_id") == [("a1", "l1", "l1"), ("b1", "l1", "l2"), ("c1", "l2", "l2")]
    assert upsert.merge_metrics(merged).first().asDict() == {"rows_kept": 1, "rows_updated": 1, "rows_inserted": 1}


def files_of(path):
    return {p.name for p in path.rglob("*.parquet")}


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = tmp_path / "t"
    first = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b"), (3, 2022, "c"), (4, 2022, "d"), (5, None, "e")], "k int, y int, v string")
    tables.create_or_upsert(spark, str(path), first, ["k"], ["y"])
    untouched = files_of(path / "y=2020")
    batch = spark.createDataFrame([(2, 2022, "moved"), (3, 2022, "C"), (6, 2023, "new")], "k int, y int, v string")
    tables.create_or_upsert(spark, str(path), batch, ["k"], ["y"])
    want = sorted([(1, 2020, "a"), (2, 2022, "moved"), (3, 2022, "C"), (4, 2022, "d"), (5, None, "e"), (6, 2023, "new")], key=str)
    assert rows(spark.read.parquet(str(path)), "k", "y", "v") == want
    assert files_of(path / "y=2020") == untouched
    tables.create_or_upsert(spark, str(path), batch, ["k"], ["y"])
    assert rows(spark.read.parquet(str(path)), "k", "y", "v") == want
    gone = spark.createDataFrame([(5, 2020, "was null")], "k int, y int, v string")
    tables.create_or_upsert(spark, str(path), gone, ["k"], ["y"])
    assert rows(spark.read.parquet(str(path)), "k", "y", "v") == sorted(
        [r for r in want if r[0] != 5] + [(5, 2020, "was null")], key=str
    )


def test_unpartitioned_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    for values in ([(1, "a"), (2, "b")], [(2, "B"), (3, "c")]):
        tables.create_or_upsert(spark, path, spark.createDataFrame(values, "k int, v string"), ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "B"), (3, "c")]


def test_partition_values_stay_as_written(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "k int, v string, m string"
    first = spark.createDataFrame([(1, "x", "01"), (2, "x", "02"), (3, "x", "a:b"), (4, "x", ""), (5, "x", None)], ddl)
    tables.create_or_upsert(spark, path, first, ["k"], ["m"])
    tables.create_or_upsert(spark, path, spark.createDataFrame([(1, "NEW", "01"), (3, "NEW", "c"), (6, "NEW", "")], ddl), ["k"], ["m"])
    got = rows(tables.read_partitioned(spark, path, first.schema, ["m"]), "k", "v", "m")
    assert got == sorted([(1, "NEW", "01"), (2, "x", "02"), (3, "NEW", "c"), (4, "x", None), (5, "x", None), (6, "NEW", None)], key=str)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("parts", [[], ["m"]])
def test_a_failed_write_leaves_the_table(spark, tmp_path, monkeypatch, parts):
    path, ddl = str(tmp_path / "t"), "k int, m string"
    tables.create_or_upsert(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], ddl), ["k"], parts)
    batch = spark.createDataFrame([(2, "c"), (3, "c")], ddl)
    for step in ("overwrite", "_finish", "_move"):
        with monkeypatch.context() as patched:
            patched.setattr(tables, step, lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                tables.create_or_upsert(spark, path, batch, ["k"], parts)
        assert rows(spark.read.parquet(path), "k", "m") == [(1, "a"), (2, "b")]
        if step == "_finish":
            tables.recover(spark, path)
            assert rows(spark.read.parquet(path), "k", "m") == [(1, "a"), (2, "c"), (3, "c")]
            tables.create_or_upsert(spark, path, spark.createDataFrame([(2, "b")], ddl), ["k"], parts)
            tables.replace_whole(spark, spark.read.parquet(path).filter("k < 3"), path, parts)
    tables.create_or_upsert(spark, path, batch, ["k"], parts)
    assert rows(spark.read.parquet(path), "k", "m") == [(1, "a"), (2, "c"), (3, "c")]


def test_repeated_keys_in_a_batch_raise(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    with pytest.raises(ValueError):
        tables.create_or_upsert(spark, str(tmp_path / "t"), batch, ["k"])
    assert not list(tmp_path.iterdir())


def test_treatments():
    assert ingest.action_for("append") == "merge" and ingest.action_for("reload") == "overwrite"
    with pytest.raises(ValueError):
        ingest.action_for("sideways")


def test_log_grows(spark):
    log = ingest.write_log(None, ingest.log_rows(spark, [{"load_id": "1", "status": "started"}], "load_id string, status string"))
    log = ingest.write_log(log, ingest.log_rows(spark, [{"load_id": "1", "status": "done", "n": 5}, {"load_id": "2", "status": "started", "n": None}],
                                                "load_id string, status string, n int"))
    assert rows(log) == [("1", "done", 5), ("2", "started", None)]


def test_pending_and_dataset(spark):
    files = spark.createDataFrame([("/in/sales/a.csv",), ("/in/sales/eu/b.csv",), ("/x/Crm__2024.csv",), ("/nowhere/c.csv",)], "file_path string")
    loads = spark.createDataFrame([("/in/sales/a.csv", "success"), ("/in/sales/eu/b.csv", "failed")], "file_path string, load_status string")
    assert len(rows(ingest.pending_files(files, loads))) == 3
    roots = spark.createDataFrame([("/in/sales/", "sales"), ("/in/sales/eu", "sales_eu"), ("/in/sal", "no")], "root string, dataset_id string")
    got = dict(rows(ingest.with_dataset(files, roots), "file_path", "dataset_id"))
    assert got == {"/in/sales/a.csv": "sales", "/in/sales/eu/b.csv": "sales_eu", "/x/Crm__2024.csv": "crm", "/nowhere/c.csv": None}


def test_file_time(spark):
    from pyspark.sql import functions as F

    when = dt.datetime(2024, 5, 6, 7, 8, 9)
    df = spark.createDataFrame([("a_20240102_030405.csv", when), ("a.csv", when), ("a_20241399_030405.csv", when)], "p string, m timestamp")
    out = df.select(ingest.file_time(F.col("p"), F.col("m")).cast("string").alias("t")).collect()
    assert [r["t"] for r in out] == ["2024-01-02 03:04:05", "2024-05-06 07:08:09", "2024-05-06 07:08:09"]


def test_load_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "`Row ID` int, v string")
    assert ingest.load(spark, first, path, "l1", "append", buckets=4).first()["rows_inserted"] == 3
    again = ingest.load(spark, first, path, "l2", "append").first().asDict()
    assert again == {"rows_kept": 0, "rows_updated": 3, "rows_inserted": 0, "load_id": "l2"}
    more = ingest.load(spark, spark.createDataFrame([(3, "c")], "`Row ID` int, v string"), path, "l3", "delta").first().asDict()
    assert more == {"rows_kept": 3, "rows_updated": 0, "rows_inserted": 1, "load_id": "l3"}
    got = rows(buckets.read(spark, path), "row_id", "v", "first_load_id", "last_load_id")
    assert got == sorted([(1, "a", "l1", "l2"), (2, None, "l1", "l2"), (2, None, "l1", "l2"), (3, "c", "l3", "l3")], key=str)
    ingest.load(spark, first.limit(1), path, "l4", "truncate_load")
    assert buckets.read(spark, path).count() == 1
    assert buckets.read(spark, path).columns == ["row_id", "v", "row_key", "row_bucket", "first_load_id", "last_load_id"]


ROW = "k int, v string"


def test_bucketed_upsert_rewrites_what_the_batch_hits(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(i, "old") for i in range(400)] + [(None, "n")]
    buckets.upsert(spark, path, spark.createDataFrame(first, ROW), ["k"], 32)
    opened = buckets.read(spark, path)
    before = buckets.current(spark, path)[1]["folders"]
    batch = spark.createDataFrame([(7, "new"), (1_000, "added"), (None, "m")], ROW)
    written = buckets.upsert(spark, path, batch, ["k"])
    after = buckets.current(spark, path)[1]["folders"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 3 and written.count() < 100
    want = [(i, "new" if i == 7 else "old") for i in range(400)] + [(1_000, "added"), (None, "n"), (None, "m")]
    assert rows(buckets.read(spark, path), "k", "v") == sorted(want, key=str)
    # A reader that began before the merge, and one that asks for the version, still see all of the first one.
    assert rows(opened, "k", "v") == rows(buckets.read(spark, path, 0), "k", "v") == sorted(first, key=str)
    buckets.upsert(spark, path, batch.filter("k IS NOT NULL"), ["k"])
    assert rows(buckets.read(spark, path), "k", "v") == sorted(want, key=str)
    buckets.drop_old_versions(spark, path, 1)
    assert rows(buckets.read(spark, path), "k", "v") == sorted(want, key=str)
    assert buckets.upsert(spark, path, batch.limit(0), ["k"]).count() == 0 and buckets.current(spark, path)[0] == 2


def test_bucketed_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.createDataFrame([(1, "a"), (2, "b")], ROW)
    buckets.upsert(spark, path, start, ["k"], 4)

    def slow(old, batch):
        buckets.upsert(spark, path, spark.createDataFrame([(3, "fast")], ROW), ["k"])
        return old.unionByName(batch)

    with pytest.raises(buckets.Conflict):
        buckets.merge(spark, path, spark.createDataFrame([(4, "slow")], ROW), ["k"], slow)
    with pytest.raises(ValueError):
        buckets.upsert(spark, path, spark.createDataFrame([(5, "x"), (5, "y")], ROW), ["k"])

    def broken(old, batch):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        buckets.merge(spark, path, start, ["k"], broken)
    assert rows(buckets.read(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "fast")]
