"""Every registered query against its SQL, and the shape of its plan."""

import os
import re

import check_queries
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# Queries whose frame is built when they are called: streams and whole loads.
NAMED = [n for n in entry.queries() if re.match(r"q\d\d_", n)]
EAGER = {n for n in NAMED if n[:3] in ("q24", "q25", "q28") or n[1:3] >= "31"} - {"q40_date_shapes", "q58_mixed_schemas"}
LAZY = sorted(set(NAMED) - EAGER)


@pytest.fixture(scope="module")
def con():
    return check_queries.oracle(SF)


@pytest.mark.parametrize("name", NAMED)
def test_query_equals_its_sql(spark, con, name):
    assert check_queries.compare(spark, con, name, SF) is None


def test_every_query_has_sql():
    assert set(NAMED) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_window(spark, name):
    text = plan(spark, name)
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window", "CollectLimit"):
        assert operator not in text


@pytest.mark.parametrize(
    ("name", "columns", "pushed"),
    [
        ("q01_bonus_rate", "o_orderkey o_custkey o_totalprice o_orderdate o_orderpriority", "In(o_orderpriority"),
        ("q02_bonus_distance", "o_custkey o_totalprice o_orderdate o_orderpriority", "In(o_orderpriority"),
        ("q03_eligibility", "ts user_id event_type", "IsNotNull(ts)"),
        ("q06_latest_per_key", "o_orderkey o_custkey o_totalprice o_orderdate", None),
        ("q07_distinct_pairs", "user_id event_type", None),
        ("q11_key_violations", "o_custkey o_orderdate o_orderpriority", "IsNotNull(o_custkey)"),
        ("q13_quarantine", "c_custkey c_acctbal", "Or(LessThan(c_acctbal,0.0),GreaterThan(c_acctbal,9500.0))"),
        ("q26_table_counts", "", None),
        ("q29_unprocessed", "o_orderkey", None),
    ],
)
def test_scans_read_and_filter_only_what_is_needed(spark, name, columns, pushed):
    df = entry.queries()[name](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert [c.split(":")[0] for c in read.split(",") if c] == columns.split()
    if pushed:
        assert pushed in text


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("q01_bonus_rate", 1),
        ("q02_bonus_distance", 1),
        ("q03_eligibility", 1),
        ("q05_messages", 0),
        ("q06_latest_per_key", 1),
        ("q08_upsert_partial", 2),  # the aggregates' shuffles serve the join
        ("q13_quarantine", 0),
        ("q17_haversine", 0),
        ("q19_conform", 0),
        ("q22_wire_decode", 0),
        ("q23_apply_changes", 1),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    assert plan(spark, name).count("Exchange hashpartitioning") == shuffles


@pytest.mark.parametrize("name", ["q02_bonus_distance", "q03_eligibility", "q07_distinct_pairs", "q11_key_violations"])
def test_counts_aggregate_by_hash_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
