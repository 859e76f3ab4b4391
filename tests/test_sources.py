import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from lakeops.operators import quality, reshape, summaries
from lakeops.session import cut_lineage, local_table, scratch_path, shared_dir
from lakeops.sources import bus, files, jdbc, tables


def test_paths():
    assert files.daily_drop_path("/l/", "obj", dt.date(2022, 2, 1)) == "/l/obj/2022/02/01/obj*.parquet"
    assert files.daily_drop_path("/l", "obj") == "/l/obj/*/*/*/obj*.parquet"


def test_daily_drops_and_history(spark, tmp_path):
    root = str(tmp_path)
    for day, value in (("2022/01/01", 1), ("2022/01/02", 2)):
        spark.createDataFrame([(value,)], "v int").write.parquet(f"{root}/obj/{day}/obj_1.parquet")
    assert files.read_daily_drop(spark, root, "obj", dt.date(2022, 1, 2)).first()[0] == 2
    assert files.read_daily_drop(spark, root, "obj").count() == 2
    history = files.read_history(spark, root)
    assert {"file_path", "file_name", "file_size", "file_modified_at"} < set(history.columns) and history.count() == 2


def test_partition_columns_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "01"), (2, "02")], "v int, m string").write.partitionBy("m").parquet(path)
    spark.createDataFrame([(3, "x", "03")], "v int, extra string, m string").write.mode("append").partitionBy("m").parquet(path)
    out = files.read_partitions(spark, path, [f"{path}/m=01", f"{path}/m=03"])
    assert dict(out.dtypes)["m"] == "string" and out.count() == 2 and "extra" in out.columns
    assert sorted(r.m for r in out.collect()) == ["01", "03"]
    odd = [(1, "a:b"), (2, "50% +x"), (3, None)]
    spark.createDataFrame(odd, "v int, m string").write.partitionBy("m").parquet(f"{path}-odd")
    parts = [p for p in (tmp_path / "t-odd").iterdir() if p.is_dir()]
    read = files.read_partitions(spark, f"{path}-odd", [str(p) for p in parts])
    assert sorted((r.v, r.m) for r in read.collect()) == odd


def test_microseconds_count(spark):
    from lakeops.functions.hashing import row_hash
    from lakeops.sources.bus import as_messages

    rows = spark.sql("SELECT struct(t) AS s FROM VALUES (TIMESTAMP_NTZ '2022-01-01 00:00:00.000001'), (TIMESTAMP_NTZ '2022-01-01 00:00:00.000002') AS v(t)")
    assert rows.select(row_hash(rows)).distinct().count() == 2
    assert quality.duplicate_counts(rows.select("s.t")).first()["rows_after"] == 2
    assert "000001" in as_messages(rows.select("s.t")).agg({"value": "min"}).first()[0]


def test_fingerprint_of_repeated_rows(spark):
    one, two = (spark.createDataFrame([(i,), (i,)], "a int") for i in (1, 2))
    assert quality.fingerprint(one).first() != quality.fingerprint(two).first()


def test_delimited(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_bytes("nom;prix €\nété – “x”;1,5\n".encode("cp1252"))
    out = files.read_delimited(spark, str(path), encoding="cp1252")
    assert out.columns == ["nom", "prix €"] and tuple(out.first()) == ("été – “x”", "1,5")
    typed = files.read_delimited(spark, str(path), "nom string, prix string", encoding="cp1252")
    assert tuple(typed.first()) == ("été – “x”", "1,5")
    path.write_bytes("n;v\né;1\n".encode())
    assert tuple(files.read_delimited(spark, str(path), encoding="UTF-8", infer=True).first()) == ("é", 1)


def test_dispatch(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n')
    (tmp_path / "a.csv").write_text("a\n1\n")
    assert files.read_any(spark, str(tmp_path / "a.jsonl")).first()["a"] == 1
    assert files.read_any(spark, str(tmp_path / "a.csv")).first()["a"] == "1"
    with pytest.raises(ValueError):
        files.read_any(spark, "/x/a.xlsx")


def test_schema_store(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, b struct<c string, d array<date>>")
    files.save_schema(spark, schema, str(tmp_path / "s"))
    assert files.load_schema(spark, str(tmp_path / "s")) == schema
    (tmp_path / "twice.json").write_text(json.dumps(schema.json()))
    assert files.load_schema(spark, str(tmp_path / "twice.json")) == schema
    assert files.empty(spark, "a int").count() == 0


def test_jdbc_options():
    assert jdbc.query_options("u", "select 1;", user="x") == {"url": "u", "dbtable": "(select 1) q", "user": "x"}
    assert jdbc.table_options("u", "s.t") == {"url": "u", "dbtable": "s.t"}
    assert jdbc.sink_options("u", "t")["truncate"] == "true"
    assert jdbc.split_options("id", 1, 9, 3) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "3"}


def test_bus_options_and_messages(spark):
    options = bus.consumer_options("h:1", "t", per_trigger=5)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5"
    assert bus.producer_options("h:1", "t", "/cp")["checkpointLocation"] == "/cp"
    df = spark.createDataFrame([("k", 1, ("p", "c"))], "id string, n int, geo struct<place string, country string>")
    message = bus.as_messages(df, "id")
    flat = bus.flatten_body(message.withColumn("body", F.col("value").cast("binary")).drop("value"), df.schema)
    assert flat.columns == ["key", "id", "n", "geo_place", "geo_country"]
    assert tuple(flat.first()) == ("k", "k", 1, "p", "c")


def test_tables_and_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    tables.overwrite(df, path, ["b"])
    tables.append(spark.createDataFrame([(3, "x")], "a int, b string"), path, ["b"])
    assert spark.read.parquet(path).count() == 3
    tables.overwrite(df.withColumn("c", F.lit(1)), path)
    assert spark.read.parquet(path).columns == ["a", "b", "c"]
    tables.create_database(spark, "ops")
    tables.register(spark, "ops.t", path)
    tables.register(spark, "ops.t", path)
    assert [r["tableName"] for r in tables.list_tables(spark, "ops").collect()] == ["t"]
    assert tables.describe(spark, "ops.t").count() > 3
    tables.refresh(spark, "ops.t")
    assert tables.maintenance_statements(spark, "ops", {"k": "v"}) == ["ALTER TABLE `ops`.`t` SET TBLPROPERTIES ('k' = 'v')"]
    found = quality.find_columns(spark, "B", ["ops"]).collect()
    assert [(r["table"], r["column"]) for r in found] == [("t", "b")]
    (tmp_path / "e.csv").write_text("h\n1\n")
    tables.register(spark, "ops.e", str(tmp_path / "e.csv"), "csv", header="true")
    assert spark.table("ops.e").first()["h"] == "1"
    tables.drop_with_files(spark, "ops.t", path)
    assert not tables.path_exists(spark, path)
    tables.drop_with_files(spark, "ops.e")
    spark.sql("DROP DATABASE ops")


def test_export_compact_and_cache(spark, tmp_path):
    df = spark.range(100).repartition(10)
    tables.overwrite(df, str(tmp_path / "small"))
    tables.compact(spark, str(tmp_path / "small"), str(tmp_path / "big"), 2, ["id"])
    assert quality.file_stats(spark.read.parquet(str(tmp_path / "big"))).first()["files"] == 2
    tables.export_delimited(df, str(tmp_path / "out"), single_file=True)
    parts = list((tmp_path / "out").glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[0] == "id"
    assert tables.cache_as(df, "named").count() == 100
    assert tables.cache_now(df).is_cached and df.unpersist() is df
    tables.save_mart(df, "mart_t")
    tables.save_mart(df.limit(3), "mart_t")
    assert tables.read_table(spark, "mart_t").count() == 3 and tables.read_table(spark, str(tmp_path / "big")).count() == 100
    tables.drop_with_files(spark, "mart_t")
    spark.catalog.uncacheTable("named")
    assert cut_lineage(df).count() == 100
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_local_table_has_a_known_size(spark):
    df = local_table(spark, [("a", 1), (None, 2)], "x string, y int")
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString() and df.count() == 2


def test_profiles(spark):
    df = spark.createDataFrame([(1, ("x", [(2,)])), (1, ("x", [(2,)]))], "a int, s struct<t string, l array<struct<u int>>>")
    assert list(dict(quality.field_paths(df.schema))) == ["a", "s", "s.t", "s.l", "s.l.u"]
    assert quality.schema_text(df).startswith("a int|s struct<")
    assert [r["warehouse_type"] for r in quality.warehouse_columns(df).collect()] == ["int", "nvarchar(max)"]
    assert quality.warehouse_type(T.DecimalType(19, 0)) == "decimal(19,0)"
    assert quality.schema_rows(df).count() == 2
    assert tuple(quality.duplicate_counts(df).first()) == (2, 1)
    assert [r["ok"] for r in quality.expect_schema(df, {"a": "int", "b": "int"}).collect()] == [True, False]
    prints = quality.fingerprint(df.select("a")).first()
    assert quality.expect_fingerprint(df.select("a"), "a", prints["fingerprint"]).first()["ok"]
    assert quality.timed_count(df)[0] == 2
    assert sum(r["rows"] for r in quality.rows_per_partition(df).collect()) == 2


def test_unions(spark):
    left = spark.createDataFrame([(1, "a")], "id int, t string")
    right = spark.createDataFrame([(2, 5, dt.date(2024, 1, 1))], "id int, n int, d date")
    out = reshape.harmonised_union(left, right, typed_defaults=True).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "a", 0, dt.date(1970, 1, 1)), (2, "missing", 5, dt.date(2024, 1, 1))]
    plain = reshape.harmonised_union(left, right).orderBy("id").collect()
    assert plain[0]["n"] is None and plain[1]["t"] is None
    with pytest.raises(TypeError):
        reshape.harmonised_union(left, spark.createDataFrame([("x",)], "id string"))
    with pytest.raises(TypeError):
        reshape.harmonised_union(left, left.select(F.lit(1).alias("id"), "t"), strict_nullability=True)
    assert reshape.harmonised_union(left.limit(0), right).count() == 1


def test_melt_round_trip(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 3.0, 4.0)], "id int, a double, b double")
    long = reshape.melt(df, ["id"], ["a", "b"])
    assert long.count() == 4 and reshape.melt(df, ["id"], ["a", "b"], drop_nulls=True).count() == 3
    back = long.groupBy("id").pivot("variable", ["a", "b"]).agg(F.first("value")).orderBy("id")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("slots,levels,groups", [(1, 1, ["g"]), (4, 2, ["g"]), (16_384, 2, ["g"]), (5, 3, []), (16_384, 2, [])])
def test_quantiles_are_exact(spark, slots, levels, groups):
    import random

    r = random.Random(3)
    rows = [(r.choice(["hot", "hot", "b", None]), r.choice([r.uniform(-50, 50), 7.0, None, 1e-9 * r.random(), 1e12 * r.random()])) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = summaries.exact_quantiles(df, "v", {"p0": "0", "p30": "0.3", "p50": "0.5", "p100": "1"}, groups, slots, levels).collect()
    for row in got:
        values = sorted(v for g, v in rows if v is not None and (not groups or g == row["g"]))
        rank = lambda p: values[max(1, -(-p * len(values) // 100)) - 1]
        assert tuple(row)[len(groups):] == (values[0], rank(30), rank(50), values[-1])
    assert len(got) == (3 if groups else 1)


def test_quantiles_of_many_values_in_few_slots(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    found = summaries.exact_quantiles(df, "v", {"m": "0.5"}, slots=100)
    assert found.first()["m"] == df.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)")).first()[0]


def test_shares_text_and_members(spark):
    counts = spark.createDataFrame([(1, 3), (0, 0)], "a int, b int")
    out = summaries.shares_within(counts, {"g": ["a", "b"]}).collect()
    assert (out[0]["part_a"], out[1]["part_a"]) == (0.25, None)
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", None)], "k string, v string")
    assert summaries.ordered_text(df, ["k"], "v", "t", ";").first()["t"] == "a;b"
    assert [r[0] for r in summaries.first_values(df.filter("v is not null"), "v", 1, descending=True).collect()] == ["b"]
    assert summaries.with_catch_all(df, "k", {"v": "all"}).filter("v = 'all'").count() == 1


def test_compaction_packs_small_files_and_leaves_large_ones(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    spark.range(200_000).selectExpr("id", "0 AS p").repartition(1).write.partitionBy("p").parquet(path)
    large = {f for f in os.listdir(f"{path}/p=0") if f.endswith(".parquet")}
    spark.range(1_000, 1_050).selectExpr("id", "id % 2 AS p").repartition(5).write.mode("append").partitionBy("p").parquet(path)
    before = sorted(tuple(r) for r in spark.read.parquet(path).groupBy("p").agg(F.count("id"), F.sum("id")).collect())
    replaced = tables.compact_small(spark, path, target=100_000, small=20_000, partition_by=["p"])
    assert replaced >= 8 and sorted(tuple(r) for r in spark.read.parquet(path).groupBy("p").agg(F.count("id"), F.sum("id")).collect()) == before
    left = {p: {f for f in os.listdir(f"{path}/p={p}") if f.endswith(".parquet")} for p in (0, 1)}
    assert large < left[0] and len(left[0]) == 2 and len(left[1]) == 1
    assert tables.compact_small(spark, path, target=100_000, small=20_000, partition_by=["p"]) == 0


def test_ordered_text_of_a_key_in_parts(spark):
    rows = [("hot", f"v{i:04d}") for i in range(900)] * 2 + [("b", "x"), ("b", None), (None, "n"), (None, "a")]
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r["k"]: r["t"] for r in summaries.ordered_text(df, ["k"], "v", "t", ";", size=64).collect()}
    assert got == {"hot": ";".join(f"v{i:04d}" for i in range(900)), "b": "x", None: "a;n"}


def test_unknown_warehouse_type_raises():
    with pytest.raises(ValueError):
        quality.warehouse_type(T.MapType(T.StringType(), T.StringType()))
