"""Lake runs over several months: verdicts over all landed months, resuming, streams, atomic months, manifests."""

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import RUN, clean_clicks, click, rows_of
from pyspark.sql import functions as F
from test_lake import APRIL, land, new_lake

from visitlake import schemas as S
from visitlake.operators import quality
from visitlake.plans import lake as lakes
from visitlake.session import staged
from visitlake.sources import manifest, tables
from visitlake.sources.raw_clicks import read_raw_clicks, to_plain_columns
from visitlake.streaming.lake_stream import run_batch, run_stream

# Visit 40 has a click that landed in a month that does not exist; 41 goes on in May; 42 is whole in May.
FIRST = [*APRIL, click(40, 1), click(40, 3), click(41, 1), click(41, 2)]
LATER = {"2008-05": [click(41, 3, month=5, day=2), click(42, 1, month=5), click(41, 2, month=5)], "2008-13": [click(40, 2, month=13)]}


def layers(spark, lake):
    clicks = spark.table(lake.tables.clicks).select("visit_id", "click_number_in_visit", "click_month", "click_time_synthetic")
    rejected = spark.table(lake.tables.rejected).select("visit_id", "click_number_in_visit", "source_month", "rejection_reason")
    visits = spark.table(lake.tables.gold_visits).select("visit_id", "visit_month", "clicks_in_visit")
    copies = spark.table(lake.tables.gold_clicks).select("click_id")
    return [sorted((tuple(row) for row in frame.collect()), key=str) for frame in (clicks, rejected, visits, copies)]


@pytest.fixture(scope="module")
def one_run(spark, tmp_path_factory):
    lake = new_lake(spark, tmp_path_factory.mktemp("one_run"))
    for month, rows in {"2008-04": FIRST, **LATER}.items():
        land(spark, lake, month, rows)
    report = dict(rows_of(lakes.run_new_files(spark, lake, RUN), "metric", "value"))
    return lake, report, layers(spark, lake)


def test_one_run_judges_visits_over_all_months(one_run):
    _, report, (clicks, rejected, visits, copies) = one_run
    assert report["unaccounted"] == 0 and report["source_rows"] == 18 and "context_rows" not in report
    assert {row[0] for row in clicks} == {1, 2, 3, 4, 5, 42} and len(copies) == len(clicks) == 11
    reasons = {row[:3]: row[3] for row in rejected}
    assert reasons[40, 2, "2008-13"] == S.INVALID_DATE and reasons[40, 1, "2008-04"] == S.OTHER_CLICK
    assert {row[0] for row in visits} == {1, 2, 3, 4, 5, 42}


def test_months_in_several_runs_give_the_rows_of_one_run(spark, tmp_path, one_run):
    """The first run takes visit 40 for one with a gap and visit 41 for a clean one; later months overrule both."""
    lake = new_lake(spark, tmp_path)
    land(spark, lake, "2008-04", FIRST)
    lakes.run_new_files(spark, lake, RUN)
    first = layers(spark, lake)
    assert 41 in {row[0] for row in first[0]} and {row[3] for row in first[1] if row[0] == 40} == {S.NOT_CONTIGUOUS}
    for month, rows in LATER.items():
        land(spark, lake, month, rows)
        report = dict(rows_of(lakes.run_new_files(spark, lake, RUN), "metric", "value"))
        assert report["unaccounted"] == 0 and report["context_rows"] == 2
    assert layers(spark, lake) == one_run[2]
    # The month that failed visit 40 is landed again without its row: the verdict is taken back.
    land_again(spark, lake, "2008-13", [click(43, 1, month=13)])
    lakes.run_new_files(spark, lake, RUN)
    assert {row[3] for row in layers(spark, lake)[1] if row[0] == 40} == {S.NOT_CONTIGUOUS}
    # Erasing another visit of a month, and running again, leaves all other verdicts as they were.
    before = layers(spark, lake)
    lakes.erase_visits(spark, lake, spark.createDataFrame([(3,)], "visit_id bigint"), RUN, "request")
    lakes.run_new_files(spark, lake, RUN)
    assert layers(spark, lake) == [[row for row in rows if row[0] not in (3, "uci553-3-1", "uci553-3-2")] for rows in before]
    # The merged profile is that of the rows that are landed now.
    landed = to_plain_columns(read_raw_clicks(spark, lake.landing))
    assert rows_of(lakes.lake_profile(spark, lake), "metric", "value") == rows_of(quality.dataset_profile(landed), "metric", "value")
    assert spark.table(lake.tables.profile_months).filter("column = 'visit_id' AND item = '3'").count() == 0
    index = spark.table(lake.tables.landed_visits)
    assert index.filter("visit_id = 3").count() == 0 and index.filter("visit_id = 41").count() == 2


def land_again(spark, lake, month, rows):
    from conftest import raw_frame
    raw_frame(spark, rows).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").option("sep", ";").option(
        "header", True).csv(f"{lake.landing}/source_month={month}")


def test_a_run_goes_on_behind_its_last_finished_step(spark, tmp_path, one_run):
    lake = new_lake(spark, tmp_path)
    for month, rows in {"2008-04": FIRST, **LATER}.items():
        land(spark, lake, month, rows)

    def stop(step):
        raise KeyboardInterrupt(step)

    with pytest.raises(KeyboardInterrupt, match="silver"):
        lakes.run_new_files(spark, lake, RUN, on_step=stop)
    assert spark.table(lake.tables.gold_visits).count() == 0
    silver = tables.month_locations(spark, lake.tables.clicks)
    done = []
    report = dict(rows_of(lakes.run_new_files(spark, lake, RUN, on_step=done.append), "metric", "value"))
    assert done == ["gold"] and report == one_run[1] and layers(spark, lake) == one_run[2]
    assert tables.month_locations(spark, lake.tables.clicks) == silver
    assert lakes.run_new_files(spark, lake, RUN).head()["metric"] == "status: nothing new landed"


def test_stream_runs_equal_other_runs_and_a_batch_given_again_changes_nothing(spark, tmp_path, one_run):
    lake = new_lake(spark, tmp_path)
    land(spark, lake, "2008-04", FIRST)
    run_stream(spark, lake, f"{tmp_path}/checkpoint", RUN)
    for month, rows in LATER.items():
        land(spark, lake, month, rows)
    batches = []
    original = run_batch.__globals__["run_increment"]

    def noted(*given):
        batches.append(given[4])
        return original(*given)

    run_batch.__globals__["run_increment"] = noted
    try:
        run_stream(spark, lake, f"{tmp_path}/checkpoint", RUN, files_per_batch=1)
        assert layers(spark, lake) == one_run[2] and sorted(batches) == [["2008-05"], ["2008-13"]]
        files = tables.month_locations(spark, lake.tables.clicks)
        listed = (spark.readStream.schema("x string").option("recursiveFileLookup", True).csv(f"{lake.landing}/source_month=2008-13")
                  .select(F.lit("2008-13").alias("source_month"), F.col("_metadata.file_path").alias("path"),
                          F.col("_metadata.file_modification_time").alias("time")))
        again = []
        for _ in range(2):
            query = listed.writeStream.foreachBatch(lambda batch, _: again.append(run_batch(batch, 7, lake, RUN))).option(
                "checkpointLocation", f"{tmp_path}/again-{len(again)}").trigger(availableNow=True).start()
            query.awaitTermination()
        assert len(again) == 2 and batches[2:] == [["2008-13"]]
    finally:
        run_batch.__globals__["run_increment"] = original
    assert layers(spark, lake) == one_run[2] and files.keys() == tables.month_locations(spark, lake.tables.clicks).keys()
    assert lakes.run_new_files(spark, lake, RUN).head()["metric"] == "status: nothing new landed"


def test_readers_see_a_month_as_it_was_or_as_it_is(spark, tmp_path, monkeypatch):
    lake = new_lake(spark, tmp_path)
    table = lake.tables.clicks
    tables.write_months_to_table(clean_clicks(spark, APRIL), table)
    planned, seen = spark.table(table), []
    point_at = tables._point_at

    def watched(*given):
        seen.append(planned.agg(F.sum("price_usd")).first()[0])
        point_at(*given)

    monkeypatch.setattr(tables, "_point_at", watched)
    started = spark.table(table)
    plan = started._jdf.queryExecution().executedPlan()
    tables.write_months_to_table(spark.table(table).withColumn("price_usd", F.lit(1).cast("bigint")), table)
    assert seen == [280] and spark.table(table).agg(F.sum("price_usd")).first()[0] == 10 and plan
    # Old files are there for readers that planned before, and go when the next run says so.
    old = tables.remove_old_versions(spark, table)
    assert len(old) == 1 and old[0].endswith("click_month=2008-04") and tables.remove_old_versions(spark, table) == []
    assert spark.table(table).count() == 10


def test_a_failing_write_changes_no_month(spark, tmp_path):
    table = new_lake(spark, tmp_path).tables.clicks
    tables.write_months_to_table(clean_clicks(spark, [*APRIL, click(9, 1, month=5)]), table)
    before = sorted(spark.table(table).collect())
    bad = spark.table(table).withColumn("price_usd", F.when(F.col("visit_id") == 9, F.raise_error(F.lit("stop"))).otherwise(F.lit(5)).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        tables.replace_months_in_table(bad, table, ["2008-04", "2008-05"])
    assert sorted(spark.table(table).collect()) == before


def test_manifest_difference_and_order_in_files(spark, tmp_path):
    table = new_lake(spark, tmp_path).tables.clicks
    rows = clean_clicks(spark, [*APRIL, click(9, 1, month=5), click(9, 1, month=6)])
    tables.write_months_to_table(rows, table, lakes.CLICK_ORDER)
    before = staged(manifest.file_manifest(spark.table(table), "click_month"), "manifest")
    same = manifest.manifest_difference(before, manifest.file_manifest(spark.table(table), "click_month"), "click_month")
    assert rows_of(same, "click_month", "status", "record_count") == [
        ("2008-04", "unchanged", 10), ("2008-05", "unchanged", 1), ("2008-06", "unchanged", 1)]
    assert rows_of(manifest.order_in_files(spark.table(table), lakes.CLICK_ORDER, "click_month"), "click_month", "rows", "inversions") == [
        ("2008-04", 10, 0), ("2008-05", 1, 0), ("2008-06", 1, 0)]
    april = spark.table(table).filter("click_month = '2008-04'")
    tables.replace_months_in_table(april.orderBy(F.desc("visit_id")), table, ["2008-05"], None)
    after = manifest.manifest_difference(before, manifest.file_manifest(spark.table(table), "click_month"), "click_month")
    assert rows_of(after, "click_month", "status") == [
        ("2008-04", "added"), ("2008-04", "removed"), ("2008-05", "removed"), ("2008-06", "unchanged")]
    nothing = manifest.manifest_difference(before.limit(0), before.limit(0), "click_month")
    assert manifest.files_with_status(nothing, manifest.ADDED).first()["value"] is None


def test_a_point_lookup_pushes_its_filter(spark, one_run):
    plan = spark.table(one_run[0].tables.clicks).filter("visit_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(visit_id,3)" in plan.split("PushedFilters")[1]


def test_order_in_files_finds_inversions_over_range_ends(spark, tmp_path, monkeypatch):
    size = 1 << 16
    frame = spark.range(0, size + 10, 1, 1).withColumn("n", F.when(F.col("id") == size, 0).otherwise(F.col("id") + 1))
    frame.write.parquet(f"{tmp_path}/rows")
    assert rows_of(manifest.order_in_files(spark.read.parquet(f"{tmp_path}/rows"), ["n"]), "rows", "inversions") == [(size + 10, 1)]


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from visitlake.session import configure
from visitlake.sources import tables

spark = configure(SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
                  .config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", sys.argv[1]).getOrCreate())
spark.sql("CREATE TABLE retried (n BIGINT, month STRING) USING parquet PARTITIONED BY (month)")

def failing(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

frame = spark.range(1000).select(F.col("id").alias("n"), F.lit("a").alias("month"))
counted = Observation("counted")
# The rows fail behind the last shuffle, where they are written and observed.
original = tables.fit_to_table
late = lambda rows: rows.mapInArrow(failing, rows.schema)
from pyspark.sql import DataFrame
drop = DataFrame.drop
DataFrame.drop = lambda self, *names: drop(late(self), *names) if names == (tables.NEW,) else drop(self, *names)
tables.replace_months_in_table(frame, "retried", ["a"], None, None, counted, (F.count_if(F.col(tables.NEW)).alias("rows"),))
DataFrame.drop = drop
print("observed", counted.get["rows"], spark.table("retried").count())
"""


def test_a_task_tried_again_counts_once(tmp_path):
    done = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path / "warehouse")], cwd=tmp_path, capture_output=True, text=True,
                          env={**__import__("os").environ, "PYTHONPATH": str(Path(lakes.__file__).resolve().parents[2])}, timeout=300)
    assert "observed 1000 1000" in done.stdout, done.stderr[-3000:]
