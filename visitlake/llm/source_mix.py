"""Mixing sources to target weights by fixed-length blocks of words.

The words of a source's documents, one after the other in a hashed order, are cut into blocks. An output shard draws its
source counts from a multinomial: each of its slots draws a source, with the share that the source has of all slots. The
slots of a source are numbered over all shards, and its pseudorandom index permutation maps numbers to blocks: each
round of the source, all its blocks, has a permutation of its own. Slots and blocks are joined by source and block number.

The draws of all shards together give a source a few slots more or less than it shall have. Slots drawn beyond a
source's number go to the sources that lack some, so every source gets its number exactly, and no block is in more than
one slot of a round. The last slot of a source is cut where its target is reached.

Only narrow rows are shuffled. A hot source is dealt out: its documents are numbered in hashed buckets of bounded size and
its slots within shards, whose counts are summed up before; pieces and slots meet by source and block.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlake.llm.columns import WORD, words_of
from visitlake.session import staged

BUCKET_ROWS = 2048
# An interval of numbers is looked up by the cells that it touches, of which there are so many.
CELLS = 4096
ROUNDS = 24
SLOTS_IN_PARTITION = 1 << 20


@dataclass(frozen=True)
class Mixture:
    """``documents``: a row per document with ``doc``, ``source``, ``size``, ``source_size``, ``target``, ``key`` and
    ``start`` (words of its source before it; missing if it has none itself). ``spans``: the mix, a row per piece of a
    document in a slot: ``shard``, ``slot``, ``offset`` (words of the slot before it), ``key``, ``start``, ``doc``,
    ``first`` (words of the document before it), ``length`` and, if asked for, ``text`` (its words, with single spaces).
    """

    documents: DataFrame
    spans: DataFrame

    def taken(self) -> DataFrame:
        """``documents`` with ``taken``, the words that the mix has from each, repeats counted."""
        found = self.spans.groupBy("key", "start").agg(F.sum("length").alias("taken"))
        return self.documents.join(found, ["key", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def mix(docs: DataFrame, weights: tuple[int, ...], share: float = 1.5, rounds: int = 2, block_words: int = 128,
        shard_blocks: int = 1024, seed: int = 11, with_text: bool = False, id_column: str = "doc_id",
        source_column: str = "source", text_column: str = "text") -> Mixture:
    """Mix all documents; see ``Mixture``.

    The sources, by code point and the missing one last, weigh ``weights`` in turn. They divide ``share`` of all words, but
    none gets more than ``rounds`` times its own; what lies beyond goes to the others by weight. So no document is taken
    more than ``rounds`` times. Targets are met to the word, rounded. ``share`` must not exceed ``rounds``.

    A missing source is a source of its own. Texts that are missing, empty or without words have size 0 and are in
    no block. Rows with equal or missing ids, and repeated rows, are documents of their own. An empty table gives an empty
    mix. Other columns are left out and may have any name. All draws come from hashes: equal rows give an equal mix.
    A document of any length is cut at blocks. One row per source passes through one task.
    """
    if share > rounds:
        raise ValueError("the sources cannot fill more than so many rounds")
    spark = docs.sparkSession
    sized = staged(_sized(docs, seed, with_text, id_column, source_column, text_column), "mix-sized")
    sources = staged(_sources(sized, weights, share, rounds, block_words, seed), "mix-sources")
    placed = staged(_placed(sized, sources, block_words, with_text), "mix-placed")
    spans = _joined(_slots(spark, sources, shard_blocks, block_words, seed), _pieces(placed, block_words, with_text), with_text)
    return Mixture(placed.select("doc", "source", "size", "source_size", "target", "key", "start"), spans)


# Documents and sources

def _sized(docs, seed, with_text, id_column, source_column, text_column) -> DataFrame:
    """``doc``, ``source``, ``key`` (never missing), ``size`` in words, ``tie`` for the order."""
    doc, source, text = (F.col(f"`{name}`") for name in (id_column, source_column, text_column))
    whole = F.coalesce(text, F.lit(""))
    found = docs.select(
        doc.alias("doc"), source.cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n")).alias("key"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), doc.cast("string"), whole).alias("tie"), whole.alias("text"))
    return found if with_text else found.drop("text")


def _sources(sized: DataFrame, weights, share, rounds, block_words, seed) -> DataFrame:
    """One row per source: sizes, ``target``, its blocks and slots, and its ``keys`` for the permutation of each round."""
    counted = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    everything, by_name = Window.partitionBy(), Window.orderBy(F.asc_nulls_last("source"))
    turn = F.row_number().over(by_name) - 1
    weighed = counted.withColumns({
        "rank": turn.cast("long"), "weight": F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")),
        "all": F.lit(share) * F.sum("source_size").over(everything)})
    # Sources in the order in which a rising level, the words for a unit of weight, reaches their bounds.
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("bound").over(by_bound.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_bound.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    leveled = weighed.withColumn("bound", rounds * F.col("source_size")).withColumn("level", (F.col("all") - before) / left)
    stops = F.col("bound") / F.col("weight") <= F.col("level")
    level = F.max(F.when(~stops, F.col("level"))).over(everything)
    target = F.when(stops, F.col("bound").cast("double")).otherwise(level * F.col("weight"))
    keys = F.array(*[F.array(*[F.xxhash64(F.lit(seed), F.lit(turn), F.lit(step), F.col("key")) for step in range(ROUNDS)])
                     for turn in range(rounds)])
    sized_blocks = leveled.withColumn("target", target).withColumns({
        "wanted": F.floor(F.col("target") + 0.5), "keys": keys,
        "blocks": F.ceil(F.col("source_size") / block_words)})
    # The short last block of a source is met once a round, at a place that the permutation's way back tells.
    last = F.array(*[turn * F.col("blocks") + permuted(F.col("blocks") - 1, F.col("blocks"), F.col("keys")[turn], back=True)
                     for turn in range(rounds)])
    lacking = F.col("blocks") * block_words - F.col("source_size")
    words = lambda slots: slots * block_words - lacking * F.size(F.filter("last", lambda place: place < slots))
    fewest = F.ceil(F.col("wanted") / block_words)
    numbers = F.filter(F.transform(F.sequence(F.lit(0), F.lit(rounds)), lambda more: fewest + more),
                       lambda slots: words(slots) >= F.col("wanted"))
    return (sized_blocks.withColumn("last", F.when(F.col("blocks") > 0, last).otherwise(F.array().cast("array<bigint>")))
            .withColumn("slots", numbers[0]).withColumn("excess", words(F.col("slots")) - F.col("wanted"))
            .select("key", "rank", "rows", "source_size", "target", "blocks", "slots", "excess", "keys"))


def permuted(index: Column, size: Column, keys: Column, back: bool = False) -> Column:
    """A pseudorandom permutation of 0..size-1 by swap-or-not steps: in each, an index and its mirror image at a keyed
    point change places or do not, as a hash of the larger one says. ``back`` gives the way back.
    """
    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(at: Column, number: Column) -> Column:
        key = keys[number]
        mirror = F.pmod(F.pmod(key, size) - at, size)
        swaps = F.xxhash64(key, F.greatest(at, mirror)).bitwiseAND(F.lit(1)) == 1
        return F.when(swaps, mirror).otherwise(at)

    return F.aggregate(steps, index.cast("long"), step)


def _placed(sized: DataFrame, sources: DataFrame, block_words: int, with_text: bool) -> DataFrame:
    """Documents with what is known of their source, and ``start``: the words before them in it."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS))
    known = sized.join(sources.select("key", "rank", "rows", "source_size", "target"), "key")
    known = known.withColumn("bucket", F.pmod(F.col("tie"), buckets)).drop("rows")
    sums = known.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    up_to_bucket = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "bucket", F.coalesce(F.sum("words").over(up_to_bucket), F.lit(0)).alias("before"))
    inside = Window.partitionBy("key", "bucket").orderBy("tie", "doc").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    found = known.join(sums, ["key", "bucket"]).withColumn("start", F.when(F.col("size") > 0, start))
    return found.select("doc", "source", "key", "rank", "size", "source_size", "target", "start", *["text"] * with_text)


def _pieces(placed: DataFrame, block_words: int, with_text: bool) -> DataFrame:
    """What each block holds: a row per document in it."""
    end, block = F.col("start") + F.col("size"), F.col("block")
    cut = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))))
    first = F.greatest(block * block_words - F.col("start"), F.lit(0))
    found = cut.withColumns({
        "offset": F.greatest(F.col("start") - block * block_words, F.lit(0)), "first": first,
        "length": F.least(end, (block + 1) * block_words) - F.greatest(F.col("start"), block * block_words)})
    if with_text:
        words = F.slice(words_of(F.col("text")), (F.col("first") + 1).cast("int"), F.col("length").cast("int"))
        found = found.withColumn("words", words)
    return found.select("rank", "block", "key", "start", "doc", "first", "offset", "length", *["words"] * with_text)


# Slots

def _slots(spark: SparkSession, sources: DataFrame, shard_blocks: int, block_words: int, seed: int) -> DataFrame:
    """``shard``, ``slot``, ``rank``, ``block`` and ``most`` (words that the slot takes of it) for every slot of the mix."""
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    own = staged(_laid_out(sources.select("rank", "slots"), "slots"), "mix-shares")
    slots = spark.range(0, total, 1, max(spark.sparkContext.defaultParallelism, -(-total // SLOTS_IN_PARTITION))).select(
        F.floor(F.col("id") / shard_blocks).alias("shard"), F.pmod("id", F.lit(shard_blocks)).alias("slot"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1))).alias("number"))
    # The multinomial draw: a slot's number falls into the interval of one source.
    drawn = staged(_located(slots, own, total).select("shard", "slot", "rank"), "mix-drawn")
    counts = drawn.groupBy("rank", "shard").agg(F.count("*").alias("count"))
    up_to_shard = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged(counts.withColumn("before", F.coalesce(F.sum("count").over(up_to_shard), F.lit(0))), "mix-counts")
    in_shard = Window.partitionBy("rank", "shard").orderBy("slot")
    numbered = (drawn.withColumn("row", F.row_number().over(in_shard) - 1).join(counts, ["rank", "shard"])
                .select("shard", "slot", "rank", (F.col("before") + F.col("row")).alias("index")))
    # Slots beyond a source's number are laid out over what other sources lack.
    totals = sources.select("rank", "slots").join(counts.groupBy("rank").agg(F.sum("count").alias("drawn")), "rank", "left")
    totals = totals.withColumn("drawn", F.coalesce("drawn", F.lit(0))).withColumns({
        "lacks": F.greatest(F.col("slots") - F.col("drawn"), F.lit(0)),
        "beyond": F.greatest(F.col("drawn") - F.col("slots"), F.lit(0))})
    lacks = staged(_laid_out(totals.select("rank", "lacks", "drawn"), "lacks"), "mix-lacks")
    beyond = totals.select("rank", "slots", (F.coalesce(F.sum("beyond").over(
        Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("beyond_before"))
    numbered = numbered.join(staged(beyond, "mix-beyond"), "rank")
    within = numbered.filter("index < slots").select("shard", "slot", "rank", "index")
    over = numbered.filter("index >= slots").select(
        "shard", "slot", (F.col("beyond_before") + F.col("index") - F.col("slots")).alias("number"))
    missing = lacks.agg(F.coalesce(F.sum("lacks"), F.lit(0))).first()[0]
    moved = _located(over, lacks, missing).select(
        "shard", "slot", "rank", (F.col("drawn") + F.col("number") - F.col("from")).alias("index"))
    placed = within.unionByName(moved).join(sources, "rank")
    turn, place = F.floor(F.col("index") / F.col("blocks")), F.pmod(F.col("index"), F.col("blocks"))
    ends = F.when(F.col("index") == F.col("slots") - 1, F.col("excess")).otherwise(0)
    block = permuted(place, F.col("blocks"), F.col("keys")[turn.cast("int")])
    return placed.withColumn("block", block).select("shard", "slot", "rank", "block", (F.least(
        F.lit(block_words), F.col("source_size") - F.col("block") * block_words) - ends).alias("most"))


def _laid_out(sources: DataFrame, length: str) -> DataFrame:
    """Add ``from``: intervals of the given length, one after the other by rank."""
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return sources.withColumn("from", F.coalesce(F.sum(length).over(before), F.lit(0))).withColumn("to", F.col("from") + F.col(length))


def _located(rows: DataFrame, intervals: DataFrame, total: int) -> DataFrame:
    """Rows with the interval that holds their ``number``, of intervals that fill 0..total-1. Joined by cells of equal length."""
    cell = lambda number: F.floor(number * CELLS / max(total, 1))
    held = F.struct(*intervals.columns)
    cells = (intervals.filter(F.col("from") < F.col("to"))
             .withColumn("cell", F.explode(F.sequence(cell(F.col("from")), cell(F.col("to") - 1))))
             .groupBy("cell").agg(F.collect_list(held).alias("held")))
    number = F.col("number")
    found = rows.withColumn("cell", cell(number)).join(staged(cells, "mix-cells"), "cell")
    own = F.filter("held", lambda one: (one["from"] <= number) & (number < one["to"]))[0]
    return found.withColumn("own", own).select(*rows.columns, "own.*")


def _joined(slots: DataFrame, pieces: DataFrame, with_text: bool) -> DataFrame:
    """Blocks and slots by index. A slot that takes less than its block has its first words."""
    length = F.least(F.col("length"), F.col("most") - F.col("offset"))
    found = slots.join(pieces, ["rank", "block"]).withColumn("length", length).filter("length > 0")
    if with_text:
        found = found.withColumn("text", F.array_join(F.slice("words", F.lit(1), F.col("length").cast("int")), " "))
    return found.select("shard", "slot", "offset", "key", "start", "doc", "first", "length", *["text"] * with_text)
