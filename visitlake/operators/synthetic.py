"""The fields the source lacks, generated repeatably per visit: click id, click time and device.

Rules: a visit starts in an hour drawn by the hour weights, at a drawn second; each later click follows its
predecessor by a drawn gap; the visit is moved so that it stays inside its day as far as it fits; one device per visit.
Rows without visit, click number or real date get no time and no device, and Silver rejects them.

A click's time is its visit's start plus the sum of the gaps up to it. The sum runs over bounded pieces of a visit
(see ``sequence``); the totals of the pieces, one row each, are summed per visit. Copies of a click share its time.
"""

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import click_id, draw, real_date, shop_time_to_utc
from visitlake.operators.sequence import PIECE_BITS, piece_of

LAST_SECOND = 86_399


def start_second(seed: int) -> Column:
    """Second of the day a visit would start at: weighted hour, then a second within it.

    Every hour fills as many slots of a lookup array as its weight, so one draw picks a slot.
    """
    slots = [hour for hour, weight in enumerate(S.HOUR_WEIGHTS) for _ in range(weight)]
    slot = F.floor(draw(seed, "visit_id", "hour") * len(slots)).cast("int")
    hour = F.get(F.expr(f"array({', '.join(map(str, slots))})"), slot)
    return hour * 3600 + F.floor(draw(seed, "visit_id", "sec") * 3600)


def gap_seconds(seed: int) -> Column:
    shortest, longest = S.SECONDS_BETWEEN_CLICKS
    slot = F.concat(F.lit("gap"), F.col("click_number_in_visit").cast("string"))
    return shortest + F.floor(draw(seed, "visit_id", slot) * (longest - shortest + 1))


def device(seed: int) -> Column:
    drawn = draw(seed, "visit_id", "device")
    names = list(S.DEVICE_WEIGHTS)
    bounds = [round(bound, 6) for bound in accumulate(S.DEVICE_WEIGHTS.values())]
    chosen = F.when(drawn < bounds[0], names[0])
    for name, bound in zip(names[1:-1], bounds[1:-1]):
        chosen = chosen.when(drawn < bound, name)
    return chosen.otherwise(names[-1])


def click_times(source: DataFrame, seed: int = S.DEFAULT_SEED, bits: int = PIECE_BITS) -> DataFrame:
    """``visit_id, click_number_in_visit, click_time_synthetic`` for every distinct datable click."""
    number = F.col("click_number_in_visit")
    clicks = (source.withColumn("_date", real_date())
              .filter("visit_id IS NOT NULL AND click_number_in_visit IS NOT NULL AND _date IS NOT NULL")
              .groupBy("visit_id", "click_number_in_visit").agg(F.min("_date").alias("_date"))
              .withColumns({"_piece": piece_of(number, bits), "_gap": gap_seconds(seed)}))
    if _one_piece(clicks):
        return _times_of_whole_visits(clicks, seed)
    in_piece = Window.partitionBy("visit_id", "_piece").orderBy("click_number_in_visit")
    pieces = clicks.groupBy("visit_id", "_piece").agg(
        F.sum("_gap").alias("_sum"), F.min(F.struct("click_number_in_visit", "_gap", "_date")).alias("_first"))
    visit = Window.partitionBy("visit_id")
    before = visit.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    first = F.min("_first").over(visit)
    starts = (pieces
              .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)) - first["_gap"])
              .withColumn("_length", F.sum("_sum").over(visit) - first["_gap"])
              .withColumn("_day", first["_date"])
              .withColumn("_start", F.greatest(F.lit(0), F.least(start_second(seed), LAST_SECOND - F.col("_length"))))
              .select("visit_id", "_piece", "_day", (F.col("_start") + F.col("_base")).alias("_offset")))
    second = F.col("_offset") + F.col("_elapsed")
    local = F.timestamp_add("SECOND", second, F.col("_day").cast("timestamp"))
    return (clicks.withColumn("_elapsed", F.sum("_gap").over(in_piece))
            .join(starts, ["visit_id", "_piece"])
            .select("visit_id", "click_number_in_visit", shop_time_to_utc(local).alias("click_time_synthetic")))


def _one_piece(clicks: DataFrame) -> bool:
    """Whether all clicks lie in the first piece of their visit, so that a visit is bounded as a piece is."""
    return clicks.filter("_piece <> 0").isEmpty()


def _times_of_whole_visits(clicks: DataFrame, seed: int) -> DataFrame:
    """The same times if no visit has a second piece: no totals of pieces have to be joined."""
    in_order = Window.partitionBy("visit_id").orderBy("click_number_in_visit")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = clicks.select("visit_id", "click_number_in_visit", F.sum("_gap").over(in_order).alias("_elapsed"),
                           F.sum("_gap").over(whole).alias("_sum"), F.first("_gap").over(whole).alias("_gap"),
                           F.first("_date").over(whole).alias("_day"))
    start = F.greatest(F.lit(0), F.least(start_second(seed), LAST_SECOND - (F.col("_sum") - F.col("_gap"))))
    local = F.timestamp_add("SECOND", start + F.col("_elapsed") - F.col("_gap"), F.col("_day").cast("timestamp"))
    return placed.select("visit_id", "click_number_in_visit", shop_time_to_utc(local).alias("click_time_synthetic"))


def add_synthetic_fields(source: DataFrame, seed: int = S.DEFAULT_SEED, bits: int = PIECE_BITS) -> DataFrame:
    """Source columns plus ``click_id``, ``click_time_synthetic`` and ``device_type_synthetic``."""
    times = click_times(source, seed, bits)
    datable = F.col("visit_id").isNotNull() & real_date().isNotNull()
    extra = [name for name in source.columns if name not in S.PLAIN_COLUMNS]
    return (source.join(times, ["visit_id", "click_number_in_visit"], "left")
            .withColumns({
                "click_id": click_id(),
                "click_time_synthetic": F.when(datable, F.col("click_time_synthetic")),
                "device_type_synthetic": F.when(datable, device(seed)),
            })
            .select(*S.ENRICHED_SCHEMA.fieldNames(), *extra))
