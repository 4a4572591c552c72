"""The registered queries: every operator as a query over the driver's tables.

Bronze click rows are derived from ``events`` once per application and table folder and written to the shared scratch
folder; the other queries read that Bronze table, as a lake job would. Queries about storage write to fresh scratch
folders and catalog databases and return what they read back.
"""

import uuid
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import (
    click_id, decode, is_weekend, mask_arns, mask_emails, mask_text, mask_visit, mask_visit_fields, month_of, real_date, shop_local_time,
    shop_time_to_utc, source_month,
)
from visitlake.operators import checks, gold, quality, resends, rules, silver, summaries
from visitlake.operators.erasure import deleted_visit_ids, remove_deleted_visits
from visitlake.operators.synthetic import add_synthetic_fields
from visitlake.plans import lake as lakes
from visitlake.plans.increment import build_increment, source_months
from visitlake.plans.oracles import ERASED_COUNTRY, MONTHS, PICK_SEED
from visitlake.session import configure, scratch_folder, staged
from visitlake.sources import event_clicks as fixture
from visitlake.sources import landing, ledger, manifest, raw_clicks, reference, tables
from visitlake.streaming.lake_stream import run_batch, run_stream
from visitlake.streaming.new_files import process_available, stream_raw_clicks

RECEIVED = datetime(2024, 7, 1, 12, 0, tzinfo=timezone.utc)
RUN_TIME = datetime(2024, 7, 2, tzinfo=timezone.utc)
LANDED = [*MONTHS, "2024-13"]  # the months of the data; some rows carry a month that does not exist
_kept: dict[tuple[str, str, str], object] = {}


# Inputs

def once(name, build):
    """``build(spark, sf_dir)``, made once per application and table folder, as the tables of a lake are."""
    def find(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in _kept:
            _kept[key] = build(spark, sf_dir)
        return _kept[key]
    return find


def stored(name, build):
    """A frame written once and read back by the queries that ask a finished table."""
    return once(name, lambda spark, sf_dir: staged(build(spark, sf_dir), name))


bronze = stored("bronze", fixture.bronze_clicks)


def received_once(spark, sf_dir):
    """Bronze without resends: the frame before arrival columns, received in one go."""
    return raw_clicks.add_arrival(
        bronze(spark, sf_dir).filter(F.col("received_time") == raw_clicks.utc_literal(RECEIVED))
        .select(S.ENRICHED_SCHEMA.fieldNames()), RECEIVED)


silver_of = once("silver", lambda spark, sf_dir: silver.build_silver(bronze(spark, sf_dir), RUN_TIME))


def clicks(spark, sf_dir):
    return silver_of(spark, sf_dir).clicks


def rejected(spark, sf_dir):
    return silver_of(spark, sf_dir).rejected


def visits(spark, sf_dir):
    return gold.build_visits(clicks(spark, sf_dir))


stored_clicks, stored_rejected = stored("clicks", clicks), stored("rejected", rejected)
stored_visits = stored("visits", visits)
stored_gold_clicks = stored("gold_clicks", lambda spark, sf_dir: gold.build_gold_clicks(stored_clicks(spark, sf_dir)))


def products(spark, sf_dir):
    return gold.build_products(clicks(spark, sf_dir))


def plain(spark, sf_dir):
    return fixture.plain_clicks(spark, sf_dir)


def rejected_for(*reasons):
    return lambda spark, sf_dir: (rejected(spark, sf_dir).filter(F.col("rejection_reason").isin(*reasons))
                                  .select("click_id", "rejection_reason"))


# Sources and sinks

def _database(spark, name) -> str:
    database = f"visitlake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_folder(spark, name)}'")
    return database


def _source_files(spark, sf_dir) -> str:
    """The raw click file set: ``;``-delimited text with a header."""
    path = scratch_folder(spark, "source")
    fixture.raw_text_clicks(spark, sf_dir).write.option("sep", S.SOURCE_SEPARATOR).option("header", True).csv(path)
    return path


def source_scan(spark, sf_dir):
    return raw_clicks.read_raw_files(spark, _source_files(spark, sf_dir))


def source_plain(spark, sf_dir):
    """Prices below 20 are given as words, which do not read as numbers."""
    raw = fixture.raw_text_clicks(spark, sf_dir)
    low = F.col("price").cast("bigint") < 20
    return raw_clicks.to_plain_columns(raw.withColumn("price", F.when(low, "unknown").otherwise(F.col("price"))))


def _landed(spark, sf_dir, months) -> tuple[str, str]:
    source, folder = _source_files(spark, sf_dir), scratch_folder(spark, "landing")
    landing.land_months(spark, source, folder, months, "first delivery")
    return source, folder


def land_by_month(spark, sf_dir):
    return raw_clicks.read_raw_clicks(spark, _landed(spark, sf_dir, MONTHS)[1])


def incremental_new_files(spark, sf_dir):
    """Three months are landed and marked as processed; only the files of the next three months are new then."""
    source, folder = _landed(spark, sf_dir, MONTHS[:3])
    seen = f"{folder}-ledger"
    ledger.mark_processed(ledger.new_files(spark, folder, seen), seen)
    landing.land_months(spark, source, folder, MONTHS, "first delivery")
    months = ledger.touched_months(ledger.new_files(spark, folder, seen))
    return quality.rows_by_month(raw_clicks.read_raw_clicks(spark, folder, months), "source_month")


def stream_new_files(spark, sf_dir):
    """The file stream runs twice around a second landing, of all other months; each landed row arrives once."""
    source, folder = _landed(spark, sf_dir, MONTHS[:3])
    received, checkpoint = f"{folder}-received", f"{folder}-checkpoint"

    def keep(batch: DataFrame, batch_id: int) -> None:
        (raw_clicks.to_plain_columns(batch, keep=("source_month",)).withColumn("batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(received))

    process_available(stream_raw_clicks(spark, folder), checkpoint, keep)
    landing.land_months(spark, source, folder, LANDED, "first delivery")
    process_available(stream_raw_clicks(spark, folder), checkpoint, keep)
    return spark.read.parquet(received).groupBy("source_month").agg(
        F.count("*").alias("row_count"), F.sum("price_usd").alias("price_usd"))


def month_overwrite(spark, sf_dir):
    path = scratch_folder(spark, "months")
    rows = clicks(spark, sf_dir).select("click_id", "price_usd", "click_month")
    tables.write_months(rows, path, "click_month")
    raised = spark.read.parquet(path).filter("click_month = '2024-02'").withColumn("price_usd", F.col("price_usd") + 1000)
    tables.write_months(raised, path, "click_month")
    return spark.read.parquet(path)


def whole_rebuild(spark, sf_dir):
    path = scratch_folder(spark, "whole")
    frame = products(spark, sf_dir)
    tables.write_whole(frame.filter("category = 'sale'"), path)
    tables.write_whole(frame, path)
    return spark.read.schema(S.PRODUCTS_SCHEMA).parquet(path)


def _silver_table(spark, sf_dir) -> str:
    """A catalog table with the 19 Silver columns, filled from a frame that has one column more."""
    table = f"{_database(spark, 'silver')}.silver_clicks"
    tables.create_table(spark, table, S.SILVER_SCHEMA, "click_month")
    tables.write_months_to_table(silver.add_weekend_click(clicks(spark, sf_dir)), table)
    return table


def schema_following_write(spark, sf_dir):
    return spark.table(_silver_table(spark, sf_dir))


def _evolved(spark, sf_dir):
    """The weekend column is added to the table, then the last two months are written again."""
    table = _silver_table(spark, sf_dir)
    tables.add_column(spark, table, "weekend_click", "boolean")
    last = spark.table(table).filter(F.col("click_month").isin(MONTHS[4:])).drop("weekend_click")
    tables.write_months_to_table(silver.add_weekend_click(last), table)
    return spark.table(table)


def schema_evolution(spark, sf_dir):
    return _evolved(spark, sf_dir).select(*S.SILVER_COLUMNS, "weekend_click")


def read_all_months(spark, sf_dir):
    path = scratch_folder(spark, "visits")
    tables.write_months(visits(spark, sf_dir), path, "visit_month")
    return tables.read_months(spark, path, S.VISITS_SCHEMA)


def month_scan(spark, sf_dir):
    path = scratch_folder(spark, "clicks")
    tables.write_months(clicks(spark, sf_dir), path, "click_month")
    return spark.read.schema(S.SILVER_SCHEMA).parquet(path).filter("click_month = '2024-03'")


def files_for_month(spark, sf_dir):
    """Data files of each month: their rows, and whether each file has a size and a name of its own."""
    path = scratch_folder(spark, "clicks")
    tables.write_months(stored_clicks(spark, sf_dir), path, "click_month")
    files = tables.data_files(spark.read.schema(S.SILVER_SCHEMA).parquet(path))
    month = F.regexp_extract("file_path", "click_month=([^/]+)/", 1).alias("click_month")
    sound = F.bool_and(F.col("file_size_in_bytes") > 0) & (F.count_distinct("file_path") == F.count("*"))
    return files.groupBy(month).agg(F.sum("record_count").alias("record_count"), sound.alias("sound"))


def compact_month(spark, sf_dir):
    table = _silver_table(spark, sf_dir)
    for month in MONTHS:
        tables.compact_month(spark, table, month)
    return spark.table(table)


def ref_countries(spark, sf_dir):
    """Every country of the code table with its number of clean clicks."""
    counted = clicks(spark, sf_dir).groupBy("country_code").agg(F.count("*").alias("clicks"))
    return (reference.build_countries(spark).join(counted, "country_code", "left")
            .withColumn("clicks", F.coalesce("clicks", F.lit(0))))


def ref_devices(spark, sf_dir):
    counted = (clicks(spark, sf_dir).groupBy(F.col("device_type_synthetic").alias("device_type"))
               .agg(F.count("*").alias("clicks")))
    return (reference.build_devices(spark).join(counted, "device_type", "left")
            .withColumn("clicks", F.coalesce("clicks", F.lit(0))))


# Scalar functions

def decode_codes(spark, sf_dir):
    return fixture.event_clicks(spark, sf_dir).select(
        "event_id", decode(S.CATEGORIES, "category_code").alias("category"), decode(S.COLOURS, "colour_code").alias("colour"),
        decode(S.PHOTO_POSITIONS, "photo_position_code").alias("photo_position"),
        decode(S.PHOTO_ANGLES, "photo_angle_code").alias("photo_angle"))


def real_dates(spark, sf_dir):
    return fixture.event_clicks(spark, sf_dir).select("event_id", real_date().alias("real_date"))


def shop_local_hour(spark, sf_dir):
    local = shop_local_time("click_time")
    return fixture.event_clicks(spark, sf_dir).select(
        "event_id", local.alias("shop_time"), F.hour(local).cast("bigint").alias("shop_hour"))


def local_to_utc(spark, sf_dir):
    """Event times taken as shop wall clock. Half of them are moved to autumn, so that both clock changes are met."""
    moved = F.when(F.col("price_usd") % 2 == 0, 240).otherwise(0)
    wall = F.timestamp_add("DAY", moved, F.col("click_time"))
    return fixture.event_clicks(spark, sf_dir).select("event_id", shop_time_to_utc(wall).alias("utc_time"))


def click_ids(spark, sf_dir):
    """Rows without a product are given no click number, so their id must be missing."""
    number = F.when(F.col("product_code").isNotNull(), F.col("click_number_in_visit"))
    return fixture.event_clicks(spark, sf_dir).select("event_id", click_id(number=number).alias("click_id"))


def month_keys(spark, sf_dir):
    month = F.when(F.col("product_code").isNotNull(), F.col("month"))
    return fixture.event_clicks(spark, sf_dir).select(
        "event_id", month_of(real_date()).alias("click_month"), source_month(month=month).alias("source_month"))


def summary_types(spark, sf_dir):
    """A caller's own summary text: its decimal becomes double and its int becomes bigint."""
    sql = """SELECT visit_month, CAST(sum(clicks_in_visit) AS DECIMAL(18, 0)) / 100 AS hundred_clicks,
                    CAST(count(*) AS INT) AS visits
             FROM visits GROUP BY visit_month"""
    return summaries.run_summary_sql({"visits": visits(spark, sf_dir)}, {"by_month": sql})["by_month"]


# Joins, aggregates, checks

def mismatches(spark, sf_dir):
    rows = stored_clicks(spark, sf_dir)
    return quality.category_mismatches(rows, gold.build_products(rows))


def _erased(spark, sf_dir):
    """The suppression list of these tables: every visit of unidentified origin."""
    return stored_visits(spark, sf_dir).filter(F.col("country_code") == ERASED_COUNTRY)


def without_deleted_visits(spark, sf_dir):
    return remove_deleted_visits(clicks(spark, sf_dir), deleted_visit_ids(_erased(spark, sf_dir)))


def reconcile_months(spark, sf_dir):
    received = received_once(spark, sf_dir).groupBy(source_month().alias("month")).agg(F.count("*").alias("rows"))
    clean = clicks(spark, sf_dir).groupBy(F.col("click_month").alias("month")).agg(F.count("*").alias("rows"))
    return checks.reconcile(received, clean, "month", "rows")


def quality_counts(spark, sf_dir):
    return quality.quality_counts(
        received_once(spark, sf_dir), bronze(spark, sf_dir), silver_of(spark, sf_dir).duplicates_removed,
        stored_rejected(spark, sf_dir), stored_clicks(spark, sf_dir), stored_visits(spark, sf_dir), mismatches(spark, sf_dir))


def picked_from(rows):
    return checks.pick_visit(rows, PICK_SEED, MONTHS[-1])


def picked(spark, sf_dir):
    return picked_from(clicks(spark, sf_dir))


def visit_row_counts(spark, sf_dir):
    clean = stored_clicks(spark, sf_dir)
    return checks.rows_of_visits(picked_from(clean), silver_clicks=clean, silver_clicks_rejected=stored_rejected(spark, sf_dir),
                                 gold_visits=stored_visits(spark, sf_dir))


def weekend_mismatches(spark, sf_dir):
    return checks.mismatched_rows(_evolved(spark, sf_dir), F.col("weekend_click"), is_weekend("click_date"))


def counts_without_visit(spark, sf_dir):
    clean = stored_clicks(spark, sf_dir)
    kept = remove_deleted_visits(clean, picked_from(clean).select("visit_id"))
    return quality.rows_by_month(kept, "click_month", "clicks")


def counts_from_source(spark, sf_dir):
    """Four counts with and without one visit, each after Silver and Gold were built from the source rows that are left."""
    rows = bronze(spark, sf_dir)
    visit = picked_from(stored_clicks(spark, sf_dir)).select("visit_id")

    def counted(scope, left):
        found, count = silver.build_silver(left, RUN_TIME), F.count("*")
        frames = [quality.metric(left, bronze_rows=count), quality.metric(found.clicks, silver_clicks=count),
                  quality.metric(found.rejected, rejected_rows=count),
                  quality.metric(gold.build_visits(found.clicks), visits=count)]
        return checks.all_checks(frames).withColumn("scope", F.lit(scope))

    return counted("all", rows).unionByName(counted("without_visit", rows.join(visit, "visit_id", "left_anti")))


def _read_again(spark, sf_dir) -> DataFrame:
    """Months of the files that a second run reads after a second landing, which leaves the first months' files alone."""
    source, folder = _landed(spark, sf_dir, MONTHS[:3])
    seen = f"{folder}-ledger"
    ledger.mark_processed(ledger.new_files(spark, folder, seen), seen)
    landing.land_months(spark, source, folder, LANDED, "first delivery")
    return ledger.new_files(spark, folder, seen).agg(F.count_distinct("source_month").alias("value"))


def gate_checks(spark, sf_dir):
    """Ten release checks; some fail here: rejects exist, a fact is missing, and only two months were migrated."""
    clean, bad, whole = (read(spark, sf_dir) for read in (stored_clicks, stored_rejected, stored_visits))
    grain = clean.groupBy(F.col("click_month").alias("month")).agg(F.count_distinct("visit_id").alias("visits"))
    built = whole.groupBy(F.col("visit_month").alias("month")).agg(F.count("*").alias("visits"))
    picked_visit = picked_from(clean).select("visit_id")
    kept = remove_deleted_visits(clean, picked_visit)
    left = checks.rows_of_visits(picked_visit, silver=kept)
    weekend = checks.mismatched_rows(_evolved(spark, sf_dir), F.col("weekend_click"), is_weekend("click_date"))
    nothing = bad.filter("rejection_reason IS NULL").select(F.lit(1).alias("value"))
    of_others = [frame.join(picked_visit, "visit_id", "left_anti").groupBy("visit_id").agg(F.count("*").alias("clicks"))
                 for frame in (clean, kept)]
    table = _silver_table(spark, sf_dir)
    before = staged(manifest.file_manifest(spark.table(table)), "manifest")
    tables.add_column(spark, table, "weekend_click", "boolean")
    migrated = staged(manifest.manifest_difference(before, manifest.file_manifest(spark.table(table))), "difference")
    for month in MONTHS:
        tables.compact_month(spark, table, month)
    compacted = manifest.manifest_difference(before, manifest.file_manifest(spark.table(table)))
    read_again = _read_again(spark, sf_dir)
    erased_rows = clean.join(picked_visit, "visit_id", "left_semi").select(F.lit(-1).alias("rows"))
    expected_rows = clean.select(F.lit(1).alias("rows")).unionByName(erased_rows).agg(F.sum("rows")).scalar()
    return checks.all_checks([
        checks.check("files_unchanged_across_migration", F.lit(0), manifest.files_with_status(
            migrated, manifest.CHANGED, manifest.ADDED, manifest.REMOVED)),
        checks.check("files_replaced", F.lit(0), manifest.files_with_status(compacted, manifest.UNCHANGED, manifest.CHANGED)),
        checks.check("run_input_files", F.lit(len(LANDED) - 3), read_again),
        checks.check_counts("other_visits_unchanged", *of_others, "visit_id", "clicks"),
        checks.check("final_clicks", expected_rows, kept.agg(F.count("*").alias("value"))),
        checks.check_counts("visits_match_clicks", grain, built, "month", "visits"),
        checks.check("weekend_values", F.lit(0), weekend.select(F.col("mismatched_rows").alias("value"))),
        checks.check("no_rejects", F.lit(0), bad.agg(F.count("*").alias("value"))),
        checks.check("visit_removed", F.lit(0), left.select(F.col("row_count").alias("value"))),
        checks.check("missing_fact", F.lit(1), nothing),
    ])


# Composite operators and lake runs

def rejection_reasons(spark, sf_dir):
    return rules.with_rejection_reason(resends.remove_resends(bronze(spark, sf_dir))).select("click_id", "rejection_reason")


def synthetic_fields(spark, sf_dir):
    return add_synthetic_fields(plain(spark, sf_dir))


def increment(spark, sf_dir):
    raw = raw_clicks.read_raw_clicks(spark, _landed(spark, sf_dir, LANDED)[1])
    built = build_increment(raw, RUN_TIME)
    count = F.count("*")
    parts = dict(source_rows=built.source, bronze_rows=built.bronze, silver_clicks=built.silver.clicks,
                 rejected_rows=built.silver.rejected, gold_clicks=built.gold_clicks, visits=built.visits,
                 source_months=built.source_months)
    frames = [quality.metric(frame, **{name: count}) for name, frame in parts.items()]
    return checks.all_checks(frames)


def _new_lake(spark, sf_dir, months) -> tuple[lakes.Lake, str]:
    """A lake with landed months that no run has seen yet, and its source files."""
    source, folder = _landed(spark, sf_dir, months)
    names = tables.LakeTables.within(_database(spark, "lake"))
    tables.create_lake_tables(spark, names)
    tables.add_column(spark, names.clicks, "weekend_click", "boolean")
    return lakes.Lake(folder, names, f"{folder}-gold", f"{folder}-ledger"), source


def _two_runs(spark, sf_dir) -> lakes.Lake:
    """Two runs: three months, then all others."""
    lake, source = _new_lake(spark, sf_dir, MONTHS[:3])
    lakes.run_new_files(spark, lake, RUN_TIME)
    landing.land_months(spark, source, lake.landing, LANDED, "first delivery")
    lakes.run_new_files(spark, lake, RUN_TIME)
    return lake


lake_of = once("lake", _two_runs)


def lake_table(name):
    """A whole-dataset table of the lake, read back after both runs."""
    return lambda spark, sf_dir: spark.read.parquet(f"{lake_of(spark, sf_dir).gold}/{name}")


def run_report(spark, sf_dir):
    """The report of a run over all months, with the visits of one country on the list of erased visits before it."""
    lake, _ = _new_lake(spark, sf_dir, LANDED)
    listed = plain(spark, sf_dir).filter(F.col("country_code") == ERASED_COUNTRY).select("visit_id").distinct()
    entries = listed.select("visit_id", raw_clicks.utc_literal(RUN_TIME).alias("deleted_time"), F.lit("request").alias("reason"),
                            F.lit("list").alias("bronze_key"))
    tables.fit_to_table(entries, lake.tables.deleted_visits).write.insertInto(lake.tables.deleted_visits)
    return lakes.run_new_files(spark, lake, RUN_TIME)


def _lake_counts(spark, lake) -> DataFrame:
    count, silver_clicks = F.count("*"), spark.table(lake.tables.clicks)
    return checks.all_checks([
        quality.metric(silver_clicks, total_silver_clicks=count, weekend_clicks=F.count_if("weekend_click"),
                       clicks_of_may=F.count_if(F.col("click_month") == "2024-05"), seconds_late=F.sum("seconds_late")),
        quality.metric(spark.table(lake.tables.gold_visits), total_visits=count),
        quality.metric(spark.table(lake.tables.rejected), total_rejected=count),
        quality.metric(spark.read.parquet(f"{lake.gold}/products"), products=count),
        quality.metric(spark.read.parquet(f"{lake.gold}/calendar_days"), calendar_days=count),
    ])


def run_increment(spark, sf_dir):
    """Counts of the lake after two runs."""
    return _lake_counts(spark, lake_of(spark, sf_dir))


def stream_increment(spark, sf_dir):
    """Counts of a lake that the file stream filled in two goes. The second go's first batch is then handed over again."""
    lake, source = _new_lake(spark, sf_dir, MONTHS[:3])
    checkpoint = f"{lake.landing}-checkpoint"
    run_stream(spark, lake, checkpoint, RUN_TIME)
    landing.land_months(spark, source, lake.landing, LANDED, "first delivery")
    run_stream(spark, lake, checkpoint, RUN_TIME)
    listed = ledger.list_files(spark, lake.landing).filter(~F.col("source_month").isin(MONTHS[:3]))
    run_batch(listed.select("source_month", "path", F.col("modificationTime").alias("time")), 1, lake, RUN_TIME)
    return _lake_counts(spark, lake)


class _Stopped(Exception):
    """The run was stopped on purpose."""


def run_resume(spark, sf_dir):
    """Counts of lakes whose run over all months was stopped after each step in turn and then called again."""
    counted = []
    for stop in ("silver", "gold"):
        lake, _ = _new_lake(spark, sf_dir, LANDED)

        def on_step(step, stop=stop):
            if step == stop:
                raise _Stopped(step)

        try:
            lakes.run_new_files(spark, lake, RUN_TIME, on_step=on_step)
        except _Stopped:
            lakes.run_new_files(spark, lake, RUN_TIME)
        counted.append(_lake_counts(spark, lake).withColumn("stopped_after", F.lit(stop)))
    return checks.all_checks(counted)


def atomic_month(spark, sf_dir):
    """The replacement of a month fails while it writes; the table still has the month's old rows."""
    table = _silver_table(spark, sf_dir)
    price = F.when(F.col("page_number_in_shop") == 5, F.raise_error(F.lit("stopped on purpose"))).otherwise(F.lit(0))
    february = spark.table(table).filter("click_month = '2024-02'").withColumn("price_usd", price.cast("bigint"))
    try:
        tables.write_months_to_table(february, table)
    except PySparkException as error:
        if "stopped on purpose" not in str(error):
            raise
    return spark.table(table).select(S.SILVER_COLUMNS)


def file_difference(spark, sf_dir):
    """Rows of each month by what became of their files, after one month was written again and another one was removed."""
    table = _silver_table(spark, sf_dir)
    before = staged(manifest.file_manifest(spark.table(table), "click_month"), "manifest")
    tables.compact_month(spark, table, "2024-02")
    tables.replace_months_in_table(spark.table(table).limit(0), table, ["2024-03"])
    after = manifest.file_manifest(spark.table(table), "click_month")
    return (manifest.manifest_difference(before, after, "click_month").groupBy("click_month", "status")
            .agg(F.sum("record_count").alias("record_count")))


def silver_file_order(spark, sf_dir):
    """Rows of each month of a lake's Silver, and how many of them have a smaller key than the row before them in their file."""
    stored = spark.table(lake_of(spark, sf_dir).tables.clicks)
    return manifest.order_in_files(stored, lakes.CLICK_ORDER, "click_month")


def erase_visit(spark, sf_dir):
    """Visits of unidentified origin are erased from every layer, then the rewritten months are run again."""
    lake, _ = _new_lake(spark, sf_dir, LANDED)
    lakes.run_new_files(spark, lake, RUN_TIME)
    erased = spark.table(lake.tables.gold_visits).filter(F.col("country_code") == ERASED_COUNTRY)
    lakes.erase_visits(spark, lake, erased, RUN_TIME, "request")
    lakes.run_new_files(spark, lake, RUN_TIME)
    return spark.table(lake.tables.clicks).select(S.SILVER_COLUMNS)


IDENTIFIERS = (
    " arn:aws:s3:::b%1$d/k arn:awful x%1$d-Silverbucket-q%1$d silverbucket-z %2$s 1%2$s u%1$d@mail.example u%1$d@x"
    ' uci553-%1$d-3 uci553-%1$d1-3 "VersionId": "v%1$d" {"visit_id": %1$d, "visit_id":"%1$d", "id": %1$d}')


def masked(expression):
    """Whole texts with identifiers of the document behind them; each kind has one that only looks like it."""
    def run(spark, sf_dir):
        added = F.format_string(IDENTIFIERS, F.col("doc_id"), F.lpad(F.col("doc_id").cast("string"), 12, "7"))
        documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
        return documents.select("doc_id", expression(F.concat("text", added)).alias("masked"))
    return run


def _plainly(query):
    """Run with the library's session settings; timestamps come out as UTC wall clock, as the lake tables hold them."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = query(configure(spark), sf_dir)
        return frame.select([F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp"
                             else F.col(f"`{name}`") for name, kind in frame.dtypes])
    return run


def queries():
    rows_by_month = quality.rows_by_month
    found = {
        "source_scan": source_scan,
        "source_plain": source_plain,
        "incremental_new_files": incremental_new_files,
        "stream_new_files": stream_new_files,
        "land_by_month": land_by_month,
        "month_overwrite": month_overwrite,
        "whole_rebuild": whole_rebuild,
        "schema_following_write": schema_following_write,
        "read_all_months": read_all_months,
        "month_scan": month_scan,
        "files_for_month": files_for_month,
        "schema_evolution": schema_evolution,
        "ref_countries": ref_countries,
        "ref_devices": ref_devices,
        "bronze_arrival": received_once,
        "decode_codes": decode_codes,
        "real_date": real_dates,
        "shop_local_hour": shop_local_hour,
        "local_to_utc": local_to_utc,
        "click_id": click_ids,
        "month_key": month_keys,
        "weekend_click": lambda s, d: silver.add_weekend_click(clicks(s, d)).select("click_id", "weekend_click"),
        "seconds_late": lambda s, d: clicks(s, d).select("click_id", "seconds_late"),
        "calendar_days": lambda s, d: gold.build_calendar_days(clicks(s, d)),
        "summary_types": summary_types,
        "reject_missing": rejected_for(S.MISSING_FIELD, S.INVALID_DATE),
        "reject_ranges": rejected_for(*[rules.range_reason(column) for column in S.CODE_RANGES]),
        "gold_clicks": lambda s, d: gold.build_gold_clicks(clicks(s, d)),
        "category_mismatches": mismatches,
        "remove_deleted_visits": without_deleted_visits,
        "visits_by_country_and_device":
            lambda s, d: summaries.visits_by_country_and_device(visits(s, d), reference.build_countries(s)),
        "visit_depth_funnel": lambda s, d: summaries.visit_depth_funnel(stored_visits(s, d)),
        "reconcile_months": reconcile_months,
        "visits": visits,
        "products": products,
        "bronze_rows_by_month":
            lambda s, d: rows_by_month(bronze(s, d).select(source_month().alias("source_month")), "source_month"),
        "silver_clicks_by_month": lambda s, d: rows_by_month(stored_clicks(s, d), "click_month", "clicks"),
        "rejected_by_month": lambda s, d: rows_by_month(stored_rejected(s, d), "source_month", "rejected"),
        "gold_visits_by_month": lambda s, d: rows_by_month(stored_visits(s, d), "visit_month", "visits"),
        "gold_clicks_by_month": lambda s, d: rows_by_month(stored_gold_clicks(s, d), "click_month", "clicks"),
        "daily_visits": lambda s, d: summaries.daily_visits(visits(s, d)),
        "bounce_rate_by_product": lambda s, d: summaries.bounce_rate_by_product(visits(s, d)),
        "null_share_by_month": lambda s, d: quality.null_share_by_month(_evolved(s, d), "weekend_click"),
        "quality_counts": quality_counts,
        "rejections_by_reason": lambda s, d: quality.rejections_by_reason(rejected(s, d)),
        "source_months": lambda s, d: source_months(bronze(s, d)),
        "rejected_rows": lambda s, d: stored_rejected(s, d).agg(F.count("*").alias("rejected")).select(
            F.lit("all").alias("scope"), "rejected"),
        "visit_row_counts": visit_row_counts,
        "weekend_mismatches": weekend_mismatches,
        "dataset_profile": lambda s, d: quality.dataset_profile(plain(s, d)),
        "constancy_violations": lambda s, d: quality.constancy_violations(plain(s, d)),
        "dedup_resends": lambda s, d: resends.remove_resends(bronze(s, d)),
        "duplicates_removed": lambda s, d: resends.count_resends(bronze(s, d)),
        "reject_contiguity": rejected_for(S.NOT_CONTIGUOUS),
        "reject_time_order": rejected_for(S.OUTSIDE_DATE, S.NOT_INCREASING),
        "reject_whole_visit": rejected_for(S.OTHER_CLICK),
        "pick_visit": picked,
        "simulate_resends":
            lambda s, d: raw_clicks.with_resends(received_once(s, d), 50).select("click_id", "received_time"),
        "rejection_reasons": rejection_reasons,
        "rejected_clicks": rejected,
        "silver_clicks": clicks,
        "synthetic_fields": synthetic_fields,
        "increment": increment,
        "run_increment": run_increment,
        "run_report": run_report,
        "run_resume": run_resume,
        "stream_increment": stream_increment,
        "atomic_month": atomic_month,
        "file_difference": file_difference,
        "silver_file_order": silver_file_order,
        "lake_profile": lambda s, d: lakes.lake_profile(s, lake_of(s, d)),
        "lake_products": lake_table("products"),
        "lake_calendar": lake_table("calendar_days"),
        "lake_daily_visits": lake_table("summaries/daily_visits"),
        "lake_visit_depth_funnel": lake_table("summaries/visit_depth_funnel"),
        "lake_bounce_rate_by_product": lake_table("summaries/bounce_rate_by_product"),
        "lake_visits_by_country_and_device": lake_table("summaries/visits_by_country_and_device"),
        "erase_visit": erase_visit,
        "compact_month": compact_month,
        "mask_email": masked(mask_emails),
        "mask_arn": masked(mask_arns),
        "mask_text": masked(mask_text),
        "mask_visit": masked(lambda text: mask_visit(text, F.col("doc_id"))),
        "mask_visit_fields": masked(mask_visit_fields),
        "gate_checks": gate_checks,
        "counts_from_source": counts_from_source,
        "counts_without_visit": counts_without_visit,
    }
    return {name: _plainly(query) for name, query in found.items()}
