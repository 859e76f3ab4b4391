"""Plans at a size where nothing can be broadcast."""

import pytest

import __spark_entry__ as contract

FOLDER = contract.SMOKE_DIR
from lakeops.registry import QUERIES  # noqa: E402
# These write tables or train a model when called.
EAGER = ("stream_", "tree_", "factor_importance", "upsert_partitioned", "csv_", "json_round", "hive_", "compacted", "daily_drop", "lineage")


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(EAGER)))
def test_no_nested_loops_or_row_python(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text, operator


def test_inline_rules_are_the_broadcast_side(spark):
    text = plan(QUERIES["hour_band_range_join"](spark, FOLDER.replace("sf0.001", "sf0.1")))
    assert "BuildRight" in text and "BuildLeft" not in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["one_state_periods", "contract_features", "bands_of_any_length"])
def test_bands_of_a_table_broadcast_no_side(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


@pytest.mark.parametrize("name", ["one_state_periods", "contract_features"])
def test_periods_and_days_are_shuffled_once_not_once_a_level(spark, name):
    exchanges = [line for line in plan(QUERIES[name](spark, FOLDER)).splitlines() if "Exchange " in line]
    assert exchanges and not [line for line in exchanges if "__cell" in line or "__level" in line]


def test_percentile_ranks_gather_no_group(no_broadcast):
    text = plan(QUERIES["approximate_percentile_ranks"](no_broadcast, FOLDER))
    assert "Join" not in text and "Window" not in text


def test_headway_uses_one_window_per_level(spark):
    text = plan(QUERIES["headway"](spark, FOLDER))
    assert text.count("+- Window [") == 2, "one over chunk summaries, one over rows"


@pytest.mark.parametrize("name,columns", [
    ("headway", {"event_id", "ts", "user_id", "event_type", "value"}),
    ("monthly_sales", {"l_partkey", "l_shipdate", "l_quantity", "l_extendedprice"}),
    ("code_map", {"p_brand", "p_type", "p_size"}),
])
def test_scans_read_only_what_they_need(spark, name, columns):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    read = {part.split(":")[0] for part in schemas[0].split("struct<")[1].rstrip(">").split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["star_left_counts"](spark, FOLDER))
    assert "PushedFilters: [In(o_orderstatus, [F,O])" in text or "In(o_orderstatus, [F,O])" in text
    assert "LeftOuter" not in text.split("n_name")[0] or "Inner" in text
