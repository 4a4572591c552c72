"""Ordered work inside a group without ever holding a whole group in one task.

A group (one visit, one user day) may hold a large share of all rows. Ordered windows therefore run over pieces of a
group: a piece is a fixed range of the order, so it is bounded, and pieces of one group spread over all tasks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.session import staged

# A piece is a range of 2 ** PIECE_BITS click numbers, 8,192 of them. Almost every visit is one piece.
PIECE_BITS = 13
# Rows of a piece where the order is not a range of numbers, and the characters by which a full one is divided further.
PIECE_ROWS, PART_STEP = 50_000, 3


def piece_of(number: Column, bits: int = PIECE_BITS) -> Column:
    return F.shiftright(number, bits)


def with_previous_click(clicks: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """Add ``previous_number`` and ``previous_time``: the click before in the visit's number order.

    Expects ``visit_id``, ``click_number_in_visit`` and ``click_time_synthetic``, with neither key NULL. The last click
    number of a piece is also handed to the next piece as context, so no piece needs to see another one.
    """
    number = F.col("click_number_in_visit")
    piece = piece_of(number, bits)
    last_in_piece = (1 << bits) - 1
    ends_piece = number.bitwiseAND(F.lit(last_in_piece)) == last_in_piece
    handed = clicks.withColumn("_piece", F.explode(F.when(ends_piece, F.array(piece, piece + 1)).otherwise(F.array(piece))))
    in_order = (Window.partitionBy("visit_id", "_piece")
                .orderBy("click_number_in_visit", "click_time_synthetic"))
    return (handed
            .withColumn("previous_number", F.lag("click_number_in_visit").over(in_order))
            .withColumn("previous_time", F.lag("click_time_synthetic").over(in_order))
            .filter(F.col("_piece") == piece)
            .drop("_piece"))


def sort_text(frame: DataFrame, names: list[str]) -> Column:
    """Whole numbers and times as text that sorts as they do, missing values first; 17 characters each."""
    def digits(name: str) -> Column:
        kind = frame.schema[name].dataType
        number = F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name).cast("bigint")
        # Without its sign bit turned, a negative number would sort behind.
        turned = number.bitwiseXOR(F.lit(-(1 << 63)))
        return F.coalesce(F.concat(F.lit("1"), F.lpad(F.hex(turned), 16, "0")), F.rpad(F.lit("0"), 17, "0"))
    return F.concat(*map(digits, names))


def bounded_pieces(frame: DataFrame, group: list[str], piece: Column, order: list[str], most: int = PIECE_ROWS) -> DataFrame:
    """Add ``_piece``, which rises with the order and of which no group has more than ``most`` rows.

    ``piece`` is a first division that rises with the order. A piece with more rows is divided by the first characters of its
    rows' place in the order, again and again, until all parts are small enough. Counts, combined before their shuffle,
    say which pieces are too full: that list has at most one row for each ``most`` rows, and is empty as a rule. Only
    rows that are equal in the whole order stay together.
    """
    places = frame.withColumn("_piece", F.struct(piece.alias("piece"), F.lit("").alias("part")))
    whole, size = 17 * len(order), 0
    while size < whole:
        full = staged(places.groupBy(*group, "_piece").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > most)
                      .select(*group, "_piece", F.lit(True).alias("_full")), "full-pieces")
        if full.isEmpty():
            break
        size = min(whole, size + PART_STEP)
        finer = F.struct(F.col("_piece.piece").alias("piece"), F.substring(sort_text(frame, order), 1, size).alias("part"))
        places = (places.join(full, [*group, "_piece"], "left")
                  .withColumn("_piece", F.when(F.col("_full"), finer).otherwise(F.col("_piece"))).drop("_full"))
    return places


def _has_full(frame: DataFrame, group: list[str], most: int) -> bool:
    counted = frame.groupBy(*group).agg(F.count("*").alias("_rows"))
    return not counted.filter(F.col("_rows") > most).isEmpty()


def with_position(frame: DataFrame, group: list[str], piece: Column, order: list[str], most: int = PIECE_ROWS) -> DataFrame:
    """Add ``position`` (1..n in the group's order) and ``group_rows`` (n). Rows without a group are left out.

    Rows are numbered inside of bounded pieces (see ``bounded_pieces``) if a group has more than ``most`` rows; the per-piece
    counts, one row each, give the number at which a piece starts.
    """
    in_piece = Window.partitionBy(*group, "_piece").orderBy(*order)
    whole = Window.partitionBy(*group)
    if not _has_full(frame, group, most):
        # Every group is a piece of its own: no counts have to be joined.
        return frame.dropna(subset=group).withColumns({
            "position": F.row_number().over(whole.orderBy(*order)).cast("bigint"), "group_rows": F.count("*").over(whole)})
    pieces = bounded_pieces(frame, group, piece, order, most)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = (pieces.groupBy(*group, "_piece").agg(F.count("*").alias("_rows"))
              .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
              .withColumn("group_rows", F.sum("_rows").over(whole))
              .drop("_rows"))
    return (pieces.withColumn("_row", F.row_number().over(in_piece))
            .join(counts, [*group, "_piece"])
            .withColumn("position", F.col("_start") + F.col("_row"))
            .drop("_piece", "_row", "_start"))
