"""Every registered query against its SQL twin, and the shape of all plans."""

from __future__ import annotations

import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as registered  # noqa: E402
from fieldcatch.workload import catalogue  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables not present")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_agrees_with_its_twin(spark, con, name):
    df = registered.queries()[name](spark, FOLDER)
    assert check_oracle.compare(df, con, registered.oracle_sql()[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    # no Python in any task but the joining of lines, no joins without an equality, and windows only over tables of
    # one row per range, split of a file or load, or over the values next to a quantile
    assert not re.search(r"Python|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin", initial)
    for line in initial.splitlines():
        if "Window " in line and "windowspecdefinition(" in line:
            assert any(m in line for m in ("_range", "_block", "_file#", "_fits", "_near")), line


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["SPECIES_CODE", "mean_cpue", "n_sites", "stdev", "ci_95", "ci_low", "ci_high"]
    assert df.count() == 6


def test_every_query_has_a_twin():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(registered.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = registered.queries()["recaps"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and not any("l_comment" in s or "l_discount" in s or "l_tax" in s for s in scans)
    plan = registered.queries()["scan_sites"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "csv" in plan.lower()
