"""Every registered query against its SQL twin on the smallest scale."""

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

FOLDER = contract.SMOKE_DIR
from lakeops.registry import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    verdict, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], FOLDER)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["day", "line", "stop", "band", "regular", "counted", "regularity"]
    assert df.count() > 0


def test_no_orphan_oracle():
    assert set(ORACLE) <= set(QUERIES)
