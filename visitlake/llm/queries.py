"""The registered queries of this package and the SQL they are checked against."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlake.llm import (
    bpe, covering_simhash, dimension_scan, language_crf, packing, prefix_trie, quality_rules, reply_trees, source_mix,
    token_alignment, toxicity, two_pass_shuffle, url_filter,
)
from visitlake.session import scratch_folder, staged

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[f"quality.{name}" for name in names])


def op2_nearest(spark, sf_dir):
    return dimension_scan.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Three equal symbols in a row, as in pages of noise; so many make a page's URL listed.
NOISE, NOISY = r"[*]{3}|%{3}|#{3}|[$]{3}|(&amp;){3}", 20


def op3_urls(spark, sf_dir):
    """The list holds the URLs of pages that are full of noise; it blocks every page with such a canonical URL."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(F.regexp_count("html", F.lit(NOISE)) >= NOISY).select("url")
    return url_filter.judge(pages.select("page_id", "url"), URL_RULES, listed).drop("url")


def op4_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_bpe(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op6_conversations(spark, sf_dir):
    """Each conversation is a tree with one branch: a row replies to the row before it."""
    added = spark.sql(r"""SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
                          FROM VALUES (0L, 'user'), (1L, 'assistant') AS added(turn, role)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    rows = rows.withColumn("tree", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = staged(rows.withColumn("node", F.row_number().over(order).cast("long")), "turns")
    replies = numbered.select("tree", "node", (F.col("node") - 1).alias("parent"), F.length("text").alias("score"), "role", "text")
    found = reply_trees.conversations(replies).withColumn("turns", reply_trees.turns_of(F.col("formatted")))
    plain = F.array_join(F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), "")
    learned = reply_trees.learned_text(F.col("formatted"), F.col("loss_mask"))
    return found.withColumn("learned", learned).select(
        F.expr("try_cast(tree AS bigint)").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op7_simhash(spark, sf_dir):
    rows = covering_simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_shuffle(spark, sf_dir):
    docs, path = table(spark, sf_dir, "documents"), scratch_folder(spark, "shards")
    two_pass_shuffle.shuffle_to_shards(docs, path)
    text = F.coalesce("text", F.lit(""))
    return two_pass_shuffle.read_shards(spark, path, docs.schema).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def fold(parts: int):
    """The fold of a row: crc32 of its doc_id as text, modulo ``parts``; rows without id are in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts, F.lit(0))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    return toxicity.score(docs, model).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_crf.fit(docs, fold(4) != 2)
    return language_crf.identify(docs, model).withColumn("held_out", fold(4) == 2).select(
        "doc_id", "held_out", "lang_pred", "score")


MIX_WEIGHTS = (3, 1, 2)


def op11_mix(spark, sf_dir):
    mixture = source_mix.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS)
    return mixture.taken().select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken")


def op12_alignment(spark, sf_dir):
    return token_alignment.align(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)


def op13_prefix_trie(spark, sf_dir):
    """Conversations begin with the first turns of the first of their hundred, as many as their number says."""
    own = staged(prefix_trie.turns_of(table(spark, sf_dir, "conversations")), "turns")
    conv_id = F.col("conv_id")
    heads = own.select(conv_id.alias("first_id"), F.slice("turns", 1, 5).alias("head"))
    shared = (F.crc32(conv_id.cast("string")) % 6).cast("int")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), shared)).otherwise(F.array().cast(own.schema["turns"].dataType))
    rest = F.slice("turns", shared + 1, F.greatest(F.size("turns") - shared, F.lit(0)))
    rebuilt = (own.withColumn("first_id", conv_id - conv_id % 100).join(heads, "first_id", "left")
               .select("conv_id", F.concat(head, rest).alias("turns")))
    return prefix_trie.prefix_trie(rebuilt)


def queries():
    return {
        "op1_quality": op1_quality,
        "op2_nearest": op2_nearest,
        "op3_urls": op3_urls,
        "op4_packing": op4_packing,
        "op5_bpe": op5_bpe,
        "op6_conversations": op6_conversations,
        "op7_simhash": op7_simhash,
        "op8_shuffle": op8_shuffle,
        "op9_toxicity": op9_toxicity,
        "op10_language": op10_language,
        "op11_mix": op11_mix,
        "op12_alignment": op12_alignment,
        "op13_prefix_trie": op13_prefix_trie,
    }


# SQL of the queries that SQL can express. Word and blank classes are those of the queries' contract, written out.

QUALITY_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS part
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM texts WHERE len(words) >= 8)),
repeated AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM windows SEMI JOIN (
        SELECT doc_id, part FROM windows GROUP BY ALL HAVING count(*) > 1) AS twice USING (doc_id, part),
        (SELECT unnest(range(0, 8)) AS j) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
judged AS (
    SELECT doc_id, line, length(line) AS chars, words, (separators >= 2 AND separators * 4 >= words)
        OR symbols * 10 > length(line) OR marks * 2 > words
        OR regexp_matches(lower(line), 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|accept cookies|enable javascript|lorem ipsum|click here|sign up for|log in to|subscribe to our|under the mit license|apache license|creative commons')
        OR (words < 4 AND NOT regexp_matches(line, '[.!?:;…''"”’»)\]][\x20\x09-\x0D]*$')) AS failed
    FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
                 len(regexp_extract_all(line, '[|»›•·]')) AS separators,
                 len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(line, '!')) AS marks FROM lines)
    WHERE words > 0),
by_lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(chars) AS chars,
           coalesce(sum(chars) FILTER (failed), 0) AS lost FROM judged GROUP BY doc_id),
counted AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost, coalesce(chars, 0) AS chars
    FROM texts LEFT JOIN repeated USING (doc_id) LEFT JOIN by_lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * lost <= chars AS kept
FROM counted
"""


URLS_SQL = r"""
WITH parts AS (
    SELECT page_id, html, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, url LIKE '%://%' AS whole,
           list_sort(list_filter(string_split(regexp_extract(url, '://[^?#]*[?]([^#]*)', 1), '&'),
               lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) AS parameters FROM pages),
keyed AS (
    SELECT *, CASE WHEN whole THEN regexp_replace(regexp_replace(host, '^(www|m)[.]', ''), ':(80|443)$', '')
        || regexp_replace(path, '/+$', '') || CASE WHEN len(parameters) = 0 THEN '' ELSE '?' || array_to_string(parameters, '&') END
        END AS canonical FROM parts),
listed AS (
    SELECT DISTINCT canonical FROM keyed WHERE canonical IS NOT NULL
        AND len(regexp_extract_all(html, '[*]{3}|%{3}|#{3}|[$]{3}|(&amp;){3}')) >= 20),
ruled AS (
    SELECT page_id, host, path, canonical, CASE
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM keyed)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

CONVERSATIONS_SQL = r"""
WITH added AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           len(regexp_extract_all(coalesce(text, ''), '\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS escapes FROM added),
joined AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS plain,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '') AS learned,
           sum(10 + length(url_encode(role)) + length(text) + escapes) AS formatted_chars FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(plain) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""


# crc32 bit by bit; a node is named by the digest of its first turns.
TRIE_SQL = r"""
WITH rows AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS first_id, xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
            lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM rows)),
turns AS (
    SELECT c.conv_id, r.n, r.role, r.text FROM convs c JOIN rows r ON r.conv_id = c.first_id AND r.n <= c.h
    UNION ALL SELECT c.conv_id, r.n, r.role, r.text FROM convs c JOIN rows r ON r.conv_id = c.conv_id AND r.n > c.h),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n) AS depth, count(*) OVER (PARTITION BY conv_id) AS depths,
           length(text) AS chars FROM turns),
paths AS (
    SELECT conv_id, depth, depths, chars, sha256(string_agg(sha256(length(role) || ':' || role || text), '')
        OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM placed),
members AS (
    SELECT conv_id, depth, chars, node, depth = depths AS ends,
           coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent FROM paths
    UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM placed), NULL FROM convs),
nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(chars) AS chars, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), ''))
           AS ends_sha256 FROM members GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (node)),
below AS (
    SELECT DISTINCT a.node AS top, b.node FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
    SELECT top AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
    FROM below JOIN counted USING (node) GROUP BY top)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN sums s USING (node) LEFT JOIN counted p ON p.node = c.parent
"""


def oracle_sql():
    return {
        "op13_prefix_trie": TRIE_SQL,
        "op3_urls": URLS_SQL,
        "op6_conversations": CONVERSATIONS_SQL,
        "op1_quality": QUALITY_SQL,
    }
