"""Numbering of large groups in bounded pieces."""

import random

from pyspark.sql import functions as F

from visitlake.operators.sequence import bounded_pieces, sort_text, with_position

MOST = 20


def events(spark):
    """A third of all events lies in one minute of one user's day, and many of those in one microsecond."""
    draw = random.Random(6)
    rows = [(number, draw.randint(1, 3), 60_000_000 * draw.randint(-300, 300) + draw.randint(0, 59_999_999)) for number in range(400)]
    rows += [(1000 + number, 1, 30_000_000 + draw.choice([0, 0, draw.randint(0, 9), draw.randint(0, 20_000_000)])) for number in range(200)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "event_id long, user_id long, micros long").withColumn("ts", F.timestamp_micros("micros"))


def minute():
    return F.floor(F.unix_seconds("ts") / 60)


def test_positions_with_a_third_of_all_events_in_one_minute(spark):
    frame = events(spark)
    rows = sorted((row["user_id"], row["micros"], row["event_id"]) for row in frame.collect())
    expected = {}
    for user in (1, 2, 3):
        own = [row for row in rows if row[0] == user]
        expected |= {row[2]: (place, len(own)) for place, row in enumerate(own, 1)}
    found = with_position(frame, ["user_id"], minute(), ["ts", "event_id"], MOST).collect()
    assert {row["event_id"]: (row["position"], row["group_rows"]) for row in found} == expected


def test_groups_within_the_bound_need_no_pieces(spark):
    """Small groups are numbered in one shuffle: nothing is joined, and rows without a group are left out as before."""
    frame = events(spark).unionByName(spark.createDataFrame([(9999, None, 5)], "event_id long, user_id long, micros long")
                                      .withColumn("ts", F.timestamp_micros("micros")))
    small = with_position(frame, ["user_id"], minute(), ["ts", "event_id"], 1000)
    assert "Join" not in small._jdf.queryExecution().optimizedPlan().toString()
    pieces = with_position(frame, ["user_id"], minute(), ["ts", "event_id"], MOST)
    columns = ["event_id", "position", "group_rows"]
    assert sorted(map(tuple, small.select(columns).collect())) == sorted(map(tuple, pieces.select(columns).collect()))


def test_no_piece_exceeds_the_bound(spark):
    frame = events(spark)
    assert frame.groupBy("user_id", minute()).count().agg(F.max("count")).first()[0] > 5 * MOST
    sizes = bounded_pieces(frame, ["user_id"], minute(), ["ts", "event_id"], MOST).groupBy("user_id", "_piece").count()
    assert sizes.agg(F.max("count")).first()[0] <= MOST


def test_equal_rows_stay_together_and_the_numbering_ends(spark):
    frame = spark.createDataFrame([(1, 1)] * 50, "user_id long, event_id long").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    found = with_position(frame, ["user_id"], minute(), ["ts", "event_id"], MOST)
    assert sorted(row["position"] for row in found.collect()) == [*range(1, 51)]


def test_texts_sort_as_their_numbers_do(spark):
    values = [None, -(1 << 63), -5, -1, 0, 1, 12, 1 << 40, (1 << 63) - 1]
    frame = spark.createDataFrame([(value,) for value in values], "n long")
    texts = [row["text"] for row in frame.select("n", sort_text(frame, ["n"]).alias("text")).collect()]
    assert texts == sorted(texts) and len(set(texts)) == len(values) and {len(text) for text in texts} == {17}
