import random
from zoneinfo import ZoneInfo

import pytest
from conftest import RUN, bronze_frame, click, reasons, rows_of, silver
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.operators import rules
from visitlake.operators.resends import count_resends, remove_resends
from visitlake.operators.silver import add_weekend_click, build_silver
from visitlake.sources.raw_clicks import append_resends


def test_edge_rows(spark):
    rows = [
        click(1, 1), click(1, 2, product_code="B4", category_code=2, page_number_in_shop=3), click(2, 1),
        click(3, 1, day=31), click(4, 1, country_code=48), click(5, 1), click(5, 3),
        click(6, 1), click(6, 2, category_code=9), click(7, 1, product_code=None),
        click(8, 1, month=5), click(8, 2, month=5), click(8, 3, month=5)]
    found = silver(spark, rows)
    assert found.clicks.schema.simpleString() == S.SILVER_SCHEMA.simpleString()
    assert found.rejected.schema.simpleString() == S.REJECTED_SCHEMA.simpleString()
    assert rows_of(found.clicks, "visit_id", "click_number_in_visit") == [(1, 1), (1, 2), (2, 1), (8, 1), (8, 2), (8, 3)]
    assert reasons(found.rejected) == sorted([
        (3, 1, S.INVALID_DATE), (4, 1, "country_code outside 1-47"), (5, 1, S.NOT_CONTIGUOUS), (5, 3, S.NOT_CONTIGUOUS),
        (6, 1, S.OTHER_CLICK), (6, 2, "category_code outside 1-4"), (7, 1, S.MISSING_FIELD)], key=str)
    assert found.duplicates_removed.head()[0] == 0
    stamped = found.rejected.selectExpr("source_month", "date_format(rejected_time, 'yyyy-MM-dd HH:mm')").distinct()
    assert [tuple(row) for row in stamped.collect()] == [("2008-04", "2024-09-01 12:05")]


def test_each_code_range(spark):
    bad = {"country_code": 0, "category_code": 5, "colour_code": 15, "photo_position_code": 7, "photo_angle_code": 3,
           "price_above_category_average_code": 0, "page_number_in_shop": 6}
    assert list(bad) == list(S.CODE_RANGES)
    rows = [click(visit, 1, **{column: value}) for visit, (column, value) in enumerate(bad.items(), start=1)]
    assert reasons(silver(spark, rows).rejected) == [
        (visit, 1, f"{column} outside {low}-{high}") for visit, (column, (low, high)) in enumerate(S.CODE_RANGES.items(), start=1)]


def test_each_required_field(spark):
    rows = [click(visit, 1, **{column: None}) for visit, column in enumerate(S.PLAIN_COLUMNS, start=1)] + [click(99, 1)]
    found = silver(spark, rows)
    assert [reason for *_, reason in reasons(found.rejected)] == [S.MISSING_FIELD] * len(S.PLAIN_COLUMNS)
    assert rows_of(found.clicks, "visit_id") == [(99,)]


def test_first_failing_rule_is_recorded(spark):
    assert reasons(silver(spark, [click(1, 1, country_code=99, colour_code=99)]).rejected) == [
        (1, 1, "country_code outside 1-47")]


def test_decoded_columns(spark):
    row = silver(spark, [click(1, 1, category_code=4, day=5)]).clicks.head()
    assert (row.category, row.colour, row.photo_position_on_page, row.photo_angle) == (
        "sale", "beige", "bottom in the middle", "front")
    assert row.priced_above_category_average is False and row.click_month == "2008-04"
    assert 0 <= row.click_hour_shop_time_synthetic <= 23 and row.seconds_late > 0


def test_resends_keep_the_earliest_copy(spark):
    once = bronze_frame(spark, [click(1, 1), click(1, 2)])
    found = build_silver(append_resends(once, F.lit(True)), RUN)
    assert found.duplicates_removed.head()[0] == 2
    assert rows_of(found.clicks.selectExpr("date_format(received_time, 'HH:mm:ss') AS t"), "t") == [("12:00:00",)] * 2


def test_copies_with_equal_times_leave_one_row(spark):
    bronze = bronze_frame(spark, [click(1, 1, price_usd=10), click(1, 1, price_usd=20)])
    assert remove_resends(bronze).count() == 1
    found = build_silver(bronze, RUN)
    assert found.clicks.count() == 1
    assert rows_of(found.clicks, "price_usd") == rows_of(remove_resends(bronze), "price_usd")


def test_rows_without_identity_are_never_merged_or_dropped(spark):
    bronze = bronze_frame(spark, [click(None, 1), click(None, 1), click(4, None), click(4, None), click(4, 1)])
    assert remove_resends(bronze).count() == 5 and count_resends(bronze).head()[0] == 0
    found = build_silver(bronze, RUN)
    assert found.clicks.count() == 0
    assert [reason for *_, reason in reasons(found.rejected)].count(S.MISSING_FIELD) == 4
    assert (4, 1, S.NOT_CONTIGUOUS) in reasons(found.rejected)


def test_extreme_click_numbers_do_not_overflow(spark):
    rows = [click(1, 2 ** 63 - 1), click(1, 2 ** 63 - 2), click(2, -2 ** 63), click(3, 0), click(3, 1)]
    assert {reason for *_, reason in reasons(silver(spark, rows).rejected)} == {S.NOT_CONTIGUOUS}


def test_time_rules(spark):
    bronze = bronze_frame(spark, [click(1, 1), click(1, 2), click(2, 1), click(3, 1), click(3, 2)])
    day_later = F.col("click_time_synthetic") + F.expr("INTERVAL 1 DAY")
    first = bronze.filter("visit_id = 1 AND click_number_in_visit = 1").head().click_time_synthetic
    changed = (F.when(F.col("click_id") == "uci553-2-1", day_later)
               .when(F.col("click_id") == "uci553-1-2", F.lit(first))
               .when(F.col("click_id") != "uci553-3-2", F.col("click_time_synthetic")))
    found = build_silver(bronze.withColumn("click_time_synthetic", changed), RUN)
    assert reasons(found.rejected) == [
        (1, 1, S.OTHER_CLICK), (1, 2, S.NOT_INCREASING), (2, 1, S.OUTSIDE_DATE),
        (3, 1, S.OTHER_CLICK), (3, 2, S.OUTSIDE_DATE)]


def test_fraction_of_a_second_later_is_later(spark):
    bronze = bronze_frame(spark, [click(1, 1), click(1, 2)])
    first = F.lit(bronze.filter("click_number_in_visit = 1").head().click_time_synthetic)
    close = bronze.withColumn("click_time_synthetic", F.when(
        F.col("click_number_in_visit") == 2, first + F.expr("INTERVAL 1 MILLISECOND")).otherwise(first))
    assert build_silver(close, RUN).clicks.count() == 2


def test_empty_input(spark):
    found = silver(spark, [])
    assert found.clicks.count() == 0 and found.rejected.count() == 0 and found.duplicates_removed.head()[0] == 0


def test_weekend_column_comes_last(spark):
    clicks = silver(spark, [click(1, 1, day=5), click(2, 1, day=7)]).clicks
    flagged = add_weekend_click(clicks)
    assert flagged.columns == [*S.SILVER_COLUMNS, "weekend_click"]
    assert rows_of(flagged, "visit_id", "weekend_click") == [(1, True), (2, False)]


def dirty_rows(seed):
    """Many short and a few long visits with every kind of defect."""
    pick = random.Random(seed)
    rows = []
    for visit in range(1, 60):
        numbers = list(range(1, pick.choice([1, 2, 3, 5, 30]) + 1))
        if pick.random() < 0.2:
            numbers.remove(pick.choice(numbers))
        if pick.random() < 0.1:
            numbers = [number + 1 for number in numbers]
        for number in numbers:
            row = click(visit, number)
            if pick.random() < 0.03:
                row[pick.choice(list(S.CODE_RANGES))] = 77
            if pick.random() < 0.02:
                row[pick.choice(["product_code", "price_usd", "visit_id", "click_number_in_visit"])] = None
            if pick.random() < 0.01:
                row["day"] = 31
            rows.append(row)
    return rows


def expected_reasons(rows):
    """The rules once more, row by row, on collected rows without resends."""
    by_visit = {}
    for row in rows:
        by_visit.setdefault(row["visit_id"], []).append(row)
    own = {}
    for visit, members in by_visit.items():
        numbers = [row["click_number_in_visit"] for row in members]
        contiguous = None not in numbers and sorted(numbers) == list(range(1, len(numbers) + 1))
        ordered = sorted(members, key=lambda row: (row["click_number_in_visit"] is None, row["click_number_in_visit"]))
        for before, row in zip([None] + ordered, ordered):
            own[id(row)] = _first_failure(row, before, contiguous)
    found = []
    for visit, members in by_visit.items():
        failed = any(own[id(row)] for row in members)
        found += [(visit, row["click_number_in_visit"], own[id(row)] or (S.OTHER_CLICK if failed else None))
                  for row in members]
    return sorted(found, key=str)


def _first_failure(row, before, contiguous):
    if any(row[name] is None for name in S.REQUIRED_COLUMNS):
        return S.MISSING_FIELD
    if row["month"] == 4 and row["day"] > 30:
        return S.INVALID_DATE
    for name, (low, high) in S.CODE_RANGES.items():
        if not low <= row[name] <= high:
            return f"{name} outside {low}-{high}"
    if not contiguous:
        return S.NOT_CONTIGUOUS
    time = row["click_time_synthetic"]
    local = time and time.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(S.SHOP_TIMEZONE))
    if local is None or (local.year, local.month, local.day) != (row["year"], row["month"], row["day"]):
        return S.OUTSIDE_DATE
    if before and before["click_time_synthetic"] and time <= before["click_time_synthetic"]:
        return S.NOT_INCREASING
    return None


@pytest.mark.parametrize("seed, bits", [(1, 13), (2, 2), (3, 1)])
def test_rules_equal_brute_force(spark, seed, bits):
    bronze = bronze_frame(spark, dirty_rows(seed))
    # Every 40th click or so gets a wrong time.
    off = F.pmod(F.xxhash64("click_id", F.lit(seed)), F.lit(40))
    moved = (F.when(off == 0, F.col("click_time_synthetic") - F.expr("INTERVAL 1 HOUR"))
             .when(off == 1, F.col("click_time_synthetic") + F.expr("INTERVAL 1 DAY"))
             .when(off != 2, F.col("click_time_synthetic")))
    rows = [row.asDict() for row in bronze.withColumn("click_time_synthetic", moved).collect()]
    bronze = spark.createDataFrame([tuple(row.values()) for row in rows], S.BRONZE_SCHEMA)
    expected = expected_reasons(rows)
    assert reasons(rules.with_rejection_reason(bronze)) == expected
    found = build_silver(bronze, RUN, bits)
    assert reasons(found.rejected) == [row for row in expected if row[2]]
    assert rows_of(found.clicks, "visit_id", "click_number_in_visit") == sorted(
        row[:2] for row in expected if not row[2])
    assert {reason for *_, reason in expected} >= {None, S.NOT_CONTIGUOUS, S.OTHER_CLICK, S.MISSING_FIELD}


def test_one_visit_with_most_rows(spark):
    """A visit far longer than a piece, clean, and one with a single late click in another piece."""
    rows = [click(1, number) for number in range(1, 200)] + [click(2, 1)]
    bronze = bronze_frame(spark, rows)
    assert build_silver(bronze, RUN, bits=3).problems.count() == 0
    late = bronze.withColumn("click_time_synthetic", F.when(
        F.col("click_id") == "uci553-1-152", F.col("click_time_synthetic") - F.expr("INTERVAL 600 SECONDS"))
        .otherwise(F.col("click_time_synthetic")))
    found = build_silver(late, RUN, bits=3).problems
    assert rows_of(found, "click_number_in_visit", "not_later") == [(152, True)]
