"""The plans that whole loads and streams run: what they write is caught as it is planned."""

import os
import re

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

LOADS = [n for n in entry.queries() if re.match(r"q\d\d_", n) and ("25" <= n[1:3] <= "25" or n[1:3] >= "35") and n not in ("q40_date_shapes", "q58_mixed_schemas")]


@pytest.fixture
def written(monkeypatch):
    plans = []
    parquet = DataFrameWriter.parquet

    def catch(self, path, *args, **kwargs):
        plans.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", catch)
    return plans


@pytest.mark.parametrize("name", LOADS)
def test_loads_stay_native_and_never_multiply(spark, written, name):
    entry.queries()[name](spark, SF)
    assert written
    for path, plan in written:
        for operator in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window", "CollectLimit"):
            assert operator not in plan, path


@pytest.mark.parametrize("name", ["q36_history_reference", "q43_live_bonus"])
def test_loads_read_the_columns_they_need(spark, written, name):
    entry.queries()[name](spark, SF)
    facts = [plan for path, plan in written if "fct_bien_etre" in path]
    assert facts
    undated = [plan for path, plan in written if "/undated/" in path]
    assert undated
    for plan in undated:  # only the employee and the date are read
        read = re.search(r"ReadSchema: struct<([^>]*)>", plan)
        assert read is None or {c.split(":")[0] for c in read.group(1).split(",")} == {"id_salarie", "date_activite"}


def test_merging_a_batch_touches_only_its_years(spark, written):
    lake = entry._two_drops(spark, SF, "years", entry.REPLACE)
    state = lake.eligibility._state()
    assert len(set(state["parts"].values())) <= 2
    upserts = [plan for path, plan in written if "fct_bien_etre" in path and "FullOuter" in plan]
    assert upserts
    for plan in upserts:
        # One for the stored rows, one for the facts from the kept summary, one to even out the files.
        assert plan.split("InMemoryRelation")[0].count("Exchange hashpartitioning") == 3
