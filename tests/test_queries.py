"""Every registered query against its SQL form, and its plan against the rules of the house."""

import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from workloads import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# retrieval by matrix product is the one place where Python sees rows
PYTHON_QUERIES = {"q19_nearest_vectors_per_label"}
ROWS_ONLY = {"s14_first_rows", "q13_mean_file_size"}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{SF_SMALL}/{name}.parquet'")
    return con


def _cell(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _sorted(rows, columns):
    positions = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(_cell(r[i]) for i in positions) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, plan_of, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _sorted(df.collect(), df.columns)
    if name in ORACLES:
        cursor = sql.execute(ORACLES[name])
        columns = [c[0] for c in cursor.description]
        expected = _sorted(cursor.fetchall(), columns)
        assert sorted(columns) == sorted(df.columns)
        assert list(map(repr, got)) == list(map(repr, expected))
    else:
        assert name in ROWS_ONLY and got
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in PYTHON_QUERIES:
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_inventory_is_covered():
    """One query at least per row of the inventory."""
    sizes = {"s": 15, "w": 15, "p": 19, "j": 7, "a": 20, "d": 5, "o": 6, "u": 4, "f": 20, "t": 11, "k": 10, "q": 19}
    ids = {name.split("_")[0] for name in QUERIES}
    assert [f"{kind}{i}" for kind, n in sizes.items() for i in range(1, n + 1) if f"{kind}{i}" not in ids] == []


# ---- plans ----

def _plan(spark, plan_of, name):
    return plan_of(QUERIES[name](spark, SF_SMALL))


def test_filters_and_columns_reach_the_scan(spark, plan_of):
    plan = _plan(spark, plan_of, "p13_month_text")
    assert "GreaterThanOrEqual(o_orderdate,1998-11-01T00:00)" in plan and "LessThan(o_orderdate,1998-12-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<l_suppkey:bigint>" in _plan(spark, plan_of, "p19_one_column")
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in _plan(spark, plan_of, "p12_calendar_day")


def test_staging_filters_reach_the_scan(spark, plan_of):
    plan = _plan(spark, plan_of, "q11_staged_trips_of_an_interval")
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan and "WindowGroupLimit" in plan


def test_partitioned_table_is_pruned(spark, plan_of):
    assert "PartitionFilters: [isnotnull(day" in _plan(spark, plan_of, "q6_vendors_in_range_partitioned")


def test_zones_are_broadcast_and_trips_shuffled_once(spark, plan_of):
    plan = _plan(spark, plan_of, "q8_fact_trips")
    tree = plan[:plan.index("(1)")]
    assert tree.count("BroadcastHashJoin LeftOuter") == 3
    assert tree.count("+- Exchange") == 1  # the dedup


def test_revenue_is_summed_before_the_zone_is_joined(spark, plan_of):
    plan = _plan(spark, plan_of, "a8_monthly_zone_revenue")
    tree = plan[:plan.index("(1)")]
    joins = [i for i, line in enumerate(tree.splitlines()) if "Join" in line]
    sums = [i for i, line in enumerate(tree.splitlines()) if "HashAggregate" in line]
    assert sum(i < max(sums) for i in joins) == 1  # above the first sum; what the trips themselves need lies below


def test_top_k_is_taken_per_task(spark, plan_of):
    assert "TakeOrderedAndProject" in _plan(spark, plan_of, "o3_top_windows")


def test_share_has_no_single_task_window(spark, plan_of):
    df = QUERIES["d3_share_of_total"](spark, SF_SMALL)
    plan = plan_of(df, executed=True)
    assert "Window" not in plan and "ReusedExchange" in plan  # the total comes from the same shuffle


def test_footer_count(spark, plan_of):
    from farebox.session import use_footer_counts
    use_footer_counts(spark)
    try:
        plan = plan_of(spark.read.parquet(f"{SF_SMALL}/orders.parquet").groupBy().count())
        assert "PushedAggregation: [COUNT(*)]" in plan
    finally:
        use_footer_counts(spark, False)
