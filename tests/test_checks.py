from conftest import clean_clicks, click, raw_frame, rows_of, silver
from pyspark.sql import functions as F

from visitlake.operators import checks, gold, quality
from visitlake.operators.erasure import deleted_visit_ids, remove_deleted_visits
from visitlake.sources.raw_clicks import to_plain_columns


def counts(spark, pairs):
    return spark.createDataFrame(pairs, "month string, rows bigint")


def test_one_sided_months_are_mismatches(spark):
    found = checks.reconcile(counts(spark, [("04", 3), ("05", 4)]), counts(spark, [("04", 3), ("06", 1)]), "month", "rows")
    assert rows_of(found, "month", "matches") == [("04", True), ("05", False), ("06", False)]


def test_checks_need_a_fact(spark):
    equal = checks.check_counts("same", counts(spark, [("04", 3)]), counts(spark, [("04", 3)]), "month", "rows")
    nothing = checks.check_counts("none", counts(spark, []), counts(spark, []), "month", "rows")
    wrong = checks.check("wrong", F.lit(0), counts(spark, [("04", 3)]).select(F.col("rows").alias("value")))
    table = checks.all_checks([equal, nothing, wrong])
    assert {row["check"]: (row["actual"], row["pass"]) for row in table.collect()} == {
        "same": ("0", True), "none": (None, False), "wrong": ("3", False)}


def test_picked_visit_is_repeatable_and_outside_the_month(spark):
    clicks = clean_clicks(spark, [click(visit, 1, month=4 + visit % 2) for visit in range(1, 20)])
    first = checks.pick_visit(clicks, 1, "2008-05").collect()
    assert first == checks.pick_visit(clicks.repartition(5), 1, "2008-05").collect() and first[0].click_month == "2008-04"


def test_rows_of_visits_lists_every_table(spark):
    found = silver(spark, [click(1, 1), click(1, 2), click(2, 1)])
    picked = found.clicks.filter("visit_id = 1").select("visit_id")
    table = checks.rows_of_visits(picked, silver=found.clicks, rejected=found.rejected)
    assert rows_of(table, "table_name", "row_count") == [("rejected", 0), ("silver", 2)]


def test_suppression_list(spark):
    clicks = clean_clicks(spark, [click(1, 1), click(2, 1)])
    nobody = spark.createDataFrame([], "visit_id bigint")
    assert remove_deleted_visits(clicks, deleted_visit_ids(nobody)).count() == 2
    listed = spark.createDataFrame([(1,), (1,)], "visit_id bigint")
    kept = remove_deleted_visits(clicks, deleted_visit_ids(listed))
    assert rows_of(kept, "visit_id") == [(2,)] and kept.columns == clicks.columns


def test_quality_counts(spark):
    found = silver(spark, [click(1, 1), click(2, 1), click(2, 2), click(3, 2)])
    visits = gold.build_visits(found.clicks)
    table = quality.quality_counts(found.clicks, found.clicks, found.duplicates_removed, found.rejected, found.clicks, visits,
                                   quality.category_mismatches(found.clicks, gold.build_products(found.clicks)))
    assert dict(rows_of(table, "metric", "value")) == {
        "source_rows": 3, "bronze_rows": 3, "duplicates_removed": 0, "rejected_rows": 1, "silver_clicks": 3,
        "visits": 2, "one_click_visits": 1, "category_mismatches": 0}


def test_profile_and_constancy(spark):
    rows = [click(1, 1), click(1, 1), click(1, 2, product_code=None), click(2, 1, price_usd=5), click(2, 2, country_code=3)]
    plain = to_plain_columns(raw_frame(spark, rows))
    profile = dict(rows_of(quality.dataset_profile(plain), "metric", "value"))
    assert (profile["rows"], profile["nulls"], profile["duplicate_rows"], profile["visits"]) == (5, 1, 1, 2)
    assert (profile["longest_visit"], profile["median_visit"], profile["days"]) == (3, 2.5, 1)
    assert (profile["distinct_product_code"], profile["distinct_price_usd"], profile["distinct_country_code"]) == (1, 2, 2)
    assert rows_of(quality.constancy_violations(plain), "key", "attribute", "distinct_values") == [
        ("2", "country_code", 2), ("A13", "price_usd", 2)]


def test_null_share_and_rule_mismatches(spark):
    frame = spark.createDataFrame([("a", True), ("a", None), ("b", None)], "click_month string, flag boolean")
    assert rows_of(quality.null_share_by_month(frame, "flag"), "click_month", "null_share") == [("a", 0.5), ("b", 1.0)]
    assert tuple(checks.mismatched_rows(frame, F.col("flag"), F.lit(True)).head()) == (2, 3)


def test_profile_lists_values_of_combinations_not_of_clicks(spark):
    """Visits, products and click numbers are counted apart before their values are listed."""
    rows = [click(visit, number) for visit in range(3) for number in range(1, 41)] + [click(1, 1)]
    counts = quality.value_counts(to_plain_columns(raw_frame(spark, rows)))
    found = {(row["column"], row["item"]): row["rows"] for row in counts.collect()}
    assert found["product_code", "A13"] == found["price_usd", "28"] == 121 and found["visit_id", "1"] == 41
    assert found["click_number_in_visit", "1"] == 4 and found[quality.REPEATS, None] == 1
    plan = counts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for place, line in enumerate(plan):
        if "Expand [" in line:
            counted = next(below for below in plan[place + 1:] if "Aggregate [" in below)
            keys = counted.split("Aggregate [")[1].split("]")[0]
            assert not ("visit_id" in keys and "product_code" in keys)
