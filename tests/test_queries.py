import subprocess
import sys
from pathlib import Path

import pytest
from check_oracles import connect, difference

import __spark_entry__ as driver
from visitlake.plans import queries as registered

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="the driver's tables are not here")

# The others run in tests/check_oracles.py and in the driver. Lake runs are checked on more rows: months meet in few visits.
LARGER = "/root/testdata/sf0.01"
LAKE = ["erase_visit", "run_report", "run_increment", "lake_profile", "lake_products", "lake_calendar", "lake_daily_visits",
        "lake_visit_depth_funnel", "lake_bounce_rate_by_product", "lake_visits_by_country_and_device", "silver_file_order"]
CHECKED = ["atomic_month", "file_difference", "gate_checks", "source_plain", "local_to_utc", "rejected_clicks", "silver_clicks",
           "visits", "products", "daily_visits", "visit_depth_funnel", "synthetic_fields", "dataset_profile", "mask_text"]
LAZY = ["dedup_resends", "silver_clicks", "rejected_clicks", "visits", "products", "daily_visits", "visit_depth_funnel",
        "visits_by_country_and_device", "category_mismatches", "remove_deleted_visits", "synthetic_fields", "reconcile_months",
        "constancy_violations", "pick_visit"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, name):
    assert difference(spark, SMALL, name, driver.queries()[name], driver.oracle_sql()[name], connect(SMALL)) is None


@pytest.mark.parametrize("name", LAKE)
def test_lake_query_equals_its_sql(spark, name):
    assert difference(spark, LARGER, name, driver.queries()[name], driver.oracle_sql()[name], connect(LARGER)) is None


def test_every_sql_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(registered.queries()) <= set(driver.oracle_sql())


def test_queries_are_listed_without_a_session():
    code = "import __spark_entry__ as driver; assert driver.queries() and driver.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=Path(driver.__file__).parent, check=True)


def test_bronze_is_read_once_for_silver(spark):
    """Bronze is scanned, and resends are removed, for the staged rows only; the outputs read those."""
    for name in ("silver_clicks", "rejected_clicks", "category_mismatches", "remove_deleted_visits", "counts_without_visit"):
        plan = plan_of(driver.queries()[name](spark, SMALL))
        assert "/bronze-" not in plan and "WindowGroupLimit" not in plan, name


def test_entry(spark):
    assert driver.entry(spark).columns == ["visit_date", "visits", "clicks", "bounce_rate"]


def test_no_cross_joins_and_no_python_in_plans(spark):
    for name in LAZY:
        plan = plan_of(driver.queries()[name](spark, SMALL))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert operator not in plan, name


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(driver.queries()["dedup_resends"](spark, SMALL))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_funnel_reads_one_column_of_visits_and_month_scan_prunes(spark):
    plan = plan_of(driver.queries()["month_scan"](spark, SMALL))
    assert "click_month" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "2024-03" in plan
    plan = plan_of(driver.queries()["bronze_rows_by_month"](spark, SMALL))
    assert "ReadSchema: struct<year:bigint,month:bigint>" in plan


def test_visits_and_products_are_combined_by_hash_first(spark):
    for name in ("visits", "products"):
        plan = plan_of(driver.queries()[name](spark, SMALL))
        assert "ObjectHashAggregate" not in plan and plan.count("HashAggregate") >= 2
