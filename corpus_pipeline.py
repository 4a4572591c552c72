"""The training-corpus pipeline: language, quality, near-duplicates, packing. Each stage works on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame with the columns of ``documents``, the last one packed pieces.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm import language_crf, near_copies, packing, quality_rules
from visitlake.llm.batches import bound_batches
from visitlake.llm.queries import VOCABULARY, fold, table
from visitlake.session import scratch_folder

# A text with its words spread over more than two languages has no language of its own.
LEAST_LANGUAGE = 0.35
# SQL cannot express the learned, the similarity and the packing stages; tests hold them against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters at all, or no language with ``LEAST_LANGUAGE`` of the words.

    The model is fitted to labelled documents of the stage's input. What is kept stays as it is.
    """
    bound_batches(spark)
    model = language_crf.fit(docs, fold(4) != 2)
    # Under plain names, so that those of the columns cannot clash with the verdict's.
    plain = docs.toDF(*[f"c{place}" for place in range(len(docs.columns))])
    judged = language_crf.with_language(plain, model, "language", plain.columns[docs.columns.index("text")])
    known = (F.col("language.lang_pred") != language_crf.UNKNOWN) & (F.col("language.score") >= LEAST_LANGUAGE)
    return judged.filter(known).select(plain.columns).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line rules reject; the others keep the lines that pass, and ``n_chars`` follows them."""
    cleaned = quality_rules.clean(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns \
        else cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose runs of five words are common to 0.8 or more."""
    bound_batches(spark)
    return near_copies.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    bound_batches(spark)
    pieces = packing.pack(docs, VOCABULARY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("quality_rules", quality), ("near_duplicates", near_duplicates), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order, each written as Parquet and read again."""
    folder = scratch_folder(spark, "pipeline")

    def staged(docs: DataFrame, stage) -> DataFrame:
        name, function = stage
        function(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return reduce(staged, STAGES, table(spark, sf_dir, "documents"))
