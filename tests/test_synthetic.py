from collections import defaultdict

import pytest
from conftest import click, raw_frame
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import shop_local_time
from visitlake.operators.synthetic import add_synthetic_fields, click_times
from visitlake.sources.raw_clicks import to_plain_columns


def plain(spark, rows):
    return to_plain_columns(raw_frame(spark, rows))


def fifty_visits(spark):
    return plain(spark, [click(visit, number) for visit in range(1, 51) for number in (1, 2, 3)])


def collected(frame):
    return sorted(tuple(row) for row in frame.select(
        "visit_id", "click_number_in_visit", "click_time_synthetic", "device_type_synthetic").collect())


def test_same_seed_same_values_other_seed_other_values(spark):
    source = fifty_visits(spark)
    first = collected(add_synthetic_fields(source, 553))
    assert first == collected(add_synthetic_fields(source.repartition(7), 553))
    assert first != collected(add_synthetic_fields(source, 554))


def test_gaps_devices_and_columns(spark):
    enriched = add_synthetic_fields(fifty_visits(spark))
    assert enriched.schema.simpleString() == S.ENRICHED_SCHEMA.simpleString()
    times, devices = defaultdict(list), defaultdict(set)
    for visit, _, time, device in collected(enriched):
        times[visit].append(time)
        devices[visit].add(device)
    gaps = [(b - a).total_seconds() for seen in times.values() for a, b in zip(seen, seen[1:])]
    assert len(gaps) == 100 and all(5 <= gap <= 300 for gap in gaps)
    assert all(len(names) == 1 for names in devices.values())
    assert set().union(*devices.values()) <= set(S.DEVICE_WEIGHTS)


def test_long_visit_stays_on_its_date(spark):
    rows = [click(visit, number, day=13, month=8) for visit in range(20) for number in range(1, 196)]
    enriched = add_synthetic_fields(plain(spark, rows))
    days = enriched.select(F.to_date(shop_local_time("click_time_synthetic")).cast("string")).distinct().collect()
    assert [row[0] for row in days] == ["2008-08-13"]


@pytest.mark.parametrize("bits", [1, 2, 5])
def test_pieces_do_not_change_times(spark, bits):
    rows = [click(visit, number) for visit in (1, 2) for number in range(visit, 40, visit)]
    rows += [click(3, -7), click(3, 0), click(3, 9)]
    source = plain(spark, rows)
    whole, pieces = click_times(source).collect(), click_times(source, bits=bits).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, pieces)) and len(whole) == len(rows)


@pytest.mark.parametrize("bits", [1, 3])
def test_visits_of_one_piece_need_no_join(spark, bits):
    rows = [click(visit, number, day=visit) for visit in (1, 2, 5) for number in range(visit, 30, visit)]
    rows += [click(2, 2, day=1), click(3, 0), click(3, 9), click(4, 1, month=13)]
    source = plain(spark, rows)
    one, pieces = click_times(source), click_times(source, bits=bits)
    plans = [frame._jdf.queryExecution().optimizedPlan().toString() for frame in (one, pieces)]
    assert "Join" not in plans[0] and "Join" in plans[1]
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, pieces.collect())) and one.count() == len(rows) - 2


def test_rows_without_visit_or_date_get_no_values(spark):
    rows = [click(None, 1), click(2, 1, month=13), click(3, 1)]
    found = {row["visit_id"]: row for row in add_synthetic_fields(plain(spark, rows)).collect()}
    assert found[None]["click_id"] is None and found[None]["click_time_synthetic"] is None
    assert found[2]["click_time_synthetic"] is None and found[2]["device_type_synthetic"] is None
    assert found[3]["click_time_synthetic"] is not None


def test_copies_of_a_click_share_its_time_and_are_all_kept(spark):
    enriched = collected(add_synthetic_fields(plain(spark, [click(1, 1), click(1, 1), click(1, 2)])))
    assert len(enriched) == 3 and enriched[0] == enriched[1]


def test_empty_input(spark):
    empty = add_synthetic_fields(plain(spark, []))
    assert empty.count() == 0 and empty.columns == S.ENRICHED_SCHEMA.fieldNames()
