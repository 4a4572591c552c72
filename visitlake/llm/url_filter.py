"""URL verdicts by host rules and by a list, in built-in functions.

Rules are few and become one expression. The list may be long: a blocked Bloom filter of its canonical URLs, built by
an aggregation per block, is read by every task and passes each listed URL and few others. Only what passes is shuffled
to an exact hash join with the list, which removes the false positives.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.session import staged

LANES = 8  # 64-bit words of a block; a key sets one bit in each
BITS_PER_KEY = 16
# At most 8 MB of filter reach a task. A longer list makes the filter pass more, not the result wrong.
MAX_BLOCKS = 1 << 17
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that say where a visitor came from, not what is shown.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), CAPITALS, SMALL)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Without scheme, ``www.`` or ``m.``, standard port, fragment, tracking parameters and last slash; parameters sorted.

    NULL for a missing URL and one without ``://``.
    """
    plain_host = F.regexp_replace(F.regexp_replace(host(url), "^(www|m)[.]", ""), ":(80|443)$", "")
    query = F.regexp_extract(url, "://[^?#]*[?]([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda part: (part != "") & ~part.rlike(TRACKING)))
    parameters = F.when(F.size(kept) == 0, "").otherwise(F.concat(F.lit("?"), F.array_join(kept, "&")))
    return F.when(url.contains("://"), F.concat(plain_host, F.regexp_replace(path(url), "/+$", ""), parameters))


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule (verdict, host, path) that fits; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:])):
        fits = ((host_ == rule_host) | host_.endswith(f".{rule_host}")) & path_.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """The key's bit in each lane, from six bits each of a second hash."""
    drawn = F.xxhash64(key, F.lit(1))
    bits = [F.shiftrightunsigned(drawn, 6 * lane).bitwiseAND(F.lit(63)).cast("int") for lane in range(LANES)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), bit) for bit in bits]


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row with ``words``: an array of blocks, each an array of its lanes; ``keys`` has one column ``canonical``."""
    lanes = [bit.alias(f"lane{lane}") for lane, bit in enumerate(_bits(F.col("canonical")))]
    empty = keys.sparkSession.range(blocks).select(
        F.col("id").cast("int").alias("block"), *[F.lit(0).cast("long").alias(f"lane{lane}") for lane in range(LANES)])
    filled = keys.select(_block(F.col("canonical"), blocks).alias("block"), *lanes).unionByName(empty)
    joined = filled.groupBy("block").agg(*[F.bit_or(f"lane{lane}").alias(f"lane{lane}") for lane in range(LANES)])
    row = F.struct("block", F.array(*[f"lane{lane}" for lane in range(LANES)]).alias("lanes"))
    return joined.agg(F.sort_array(F.collect_list(row)).alias("rows")).select(
        F.transform("rows", lambda found: found["lanes"]).alias("words"))


def may_hold(words: Column, blocks: int, key: Column) -> Column:
    """Whether a filter's ``words`` say that the key may be one of theirs; true for each of them."""
    lanes = words[_block(key, blocks)]
    return reduce(Column.__and__, [lanes[lane].bitwiseAND(bit) == bit for lane, bit in enumerate(_bits(key))])


def blocks_for(count: int) -> int:
    return min(MAX_BLOCKS, max(1, -(-count * BITS_PER_KEY // (64 * LANES))))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame, url_column: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` (allow or block) to every row; columns of these names are replaced, all
    others are kept whatever their names.

    The longest fitting rule decides, else the list (column ``url``) blocks, compared by canonical URLs. A missing URL, or
    one without ``://``, has an empty host and path, fits no rule and is not on the list: it is allowed. Rows may repeat,
    and so may the list, whose missing URLs count for nothing. An empty list blocks nothing.
    """
    list_ = staged(listed.select(canonical(F.col("url")).alias("canonical")).filter("canonical IS NOT NULL").distinct(), "listed")
    blocks = blocks_for(list_.count())
    words = bloom_filter(list_, blocks).scalar()
    url, key = F.col(f"`{url_column}`"), F.col("canonical")
    rule, decision = rule_of(F.col("host"), F.col("path"), rules)
    # The row is nested, so its columns' names cannot clash with those made here.
    row = F.struct(*[F.col(f"`{name}`") for name in pages.columns]).alias("row")
    prepared = (pages.select(row, host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
                .withColumns({"rule": rule, "verdict": decision}))
    passes = F.coalesce(F.col("verdict").isNull() & key.isNotNull() & may_hold(words, blocks, key), F.lit(False))
    decided = prepared.filter(~passes).withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    found = list_.select("canonical", F.lit("block").alias("found")).hint("shuffle_hash")
    checked = (prepared.filter(passes).join(found, "canonical", "left")
               .withColumn("verdict", F.coalesce("found", F.lit("allow"))).select(decided.columns))
    made = ["host", "path", "rule", "verdict"]
    return decided.unionByName(checked).select(*[F.col("row")[name].alias(name) for name in pages.columns if name not in made], *made)
