"""Random order over shards by a two-pass external shuffle.

First pass: each row goes to a bucket by a seeded hash of its place in the input, so that buckets are uniform samples and
fit memory whatever the rows hold. Second pass: each bucket is shuffled by Fisher-Yates (Spark's ``shuffle``) and written.
The buckets one after the other are then one random order of all rows; shards are equal parts of it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX_GROUP = 1024


def shuffle_to_shards(docs: DataFrame, path: str, shards: int = 16, bucket_bytes: int = 16 << 20, seed: int = 17,
                      text_column: str = "text") -> None:
    """Write all rows in random order to ``shards`` folders ``shard=...`` below the path, with their ``slot``.

    Shards differ by one row at most; slots run from 0 in each. ``bucket_bytes`` is the aim for the UTF-8 text of a bucket.
    Rows may repeat, and missing or empty texts are rows as any other; an empty table writes no rows. Columns named
    ``shard`` or ``slot`` are replaced. The input must be a frame whose partitions keep their rows when it is read again,
    such as a table's scan; otherwise the number of rows of a bucket changes and the run stops.
    """
    docs = docs.drop("shard", "slot")
    size = F.coalesce(F.octet_length(text_column), F.lit(0)) + 1
    rows, total = docs.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    bucket = F.pmod(key, F.lit(buckets)).alias("bucket")
    offsets = _offsets(docs.select(bucket).groupBy("bucket").agg(F.count("*").alias("rows")))
    # Rows stay nested until they are written, so their columns may have any names.
    row = F.struct(key.alias("key"), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    packed = docs.select(bucket, row.alias("entry")).groupBy("bucket").agg(F.collect_list("entry").alias("entries"))
    steady = F.when(F.size("entries") == F.col("rows"), F.sort_array("entries")).otherwise(
        F.raise_error(F.lit("the input gave other rows when it was read again")))
    placed = (packed.join(offsets, "bucket").select("offset", F.posexplode(F.shuffle(steady, seed)))
              .select((F.col("offset") + F.col("pos")).alias("place"), F.col("col.row").alias("row")))
    shard = F.expr(f"place * {shards}L div {max(rows, 1)}L")
    slot = F.expr(f"place - (shard * {rows}L + {shards - 1}L) div {shards}L")
    (placed.withColumn("shard", shard.cast("int")).withColumn("slot", slot).select("row.*", "slot", "shard")
     .write.partitionBy("shard").parquet(path))


def read_shards(spark: SparkSession, path: str, schema) -> DataFrame:
    """The written rows with ``slot`` and ``shard``; ``schema`` is that of the input."""
    own = [field for field in schema if field.name not in ("slot", "shard")]
    fields = T.StructType([*own, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(fields).parquet(path)


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows before each bucket. Sums of groups come first, so that no task gets more than a fraction of all buckets."""
    group = F.floor(F.col("bucket") / PREFIX_GROUP).alias("group")
    grouped = counts.select("bucket", "rows", group)
    totals = grouped.groupBy("group").agg(F.sum("rows").alias("total"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("group", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (grouped.withColumn("inner", F.coalesce(F.sum("rows").over(within), F.lit(0))).join(totals, "group")
            .select("bucket", "rows", (F.col("first") + F.col("inner")).alias("offset")))
