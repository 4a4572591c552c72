"""Line-first quality rules in built-in functions.

Each line with a word is judged on its own; failing lines are removed, and a document that loses too much of its text is
rejected. Nothing is shuffled: all counts are made within the row, in time n log n of its length at most.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.columns import WORD, let, words_of

SYMBOLS = "[#*$%&|<>]"
SEPARATORS = "[|»›•·]"
LINE_END = r"[.!?:;…'\"”’»)\]][\x20\x09-\x0D]*\z"
WINDOW = 8
# Phrases of page furniture, in lower case.
BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "enable javascript", "lorem ipsum", "click here", "sign up for", "log in to", "subscribe to our", "under the mit license",
    "apache license", "creative commons",
]


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def line_failure(line: Column) -> Column:
    """The rule that a line with a word fails, or NULL.

    ``symbols``: more than a tenth of its characters are symbols. ``shouting``: more exclamation marks than half its words.
    ``unfinished``: fewer than four words and no punctuation at the end. ``navigation``: two or more separators, and one
    for every four words at least. ``boilerplate``: it holds a phrase of page furniture.
    """
    words, separators = count(line, WORD), count(line, SEPARATORS)
    return (F.when((separators >= 2) & (separators * 4 >= words), "navigation")
            .when(count(line, SYMBOLS) * 10 > F.length(line), "symbols")
            .when(count(line, "!") * 2 > words, "shouting")
            .when(F.lower(line).rlike("|".join(BOILERPLATE)), "boilerplate")
            .when((words < 4) & ~line.rlike(LINE_END), "unfinished"))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in windows of so many words found twice or more, the first of them included.

    Windows are compared by a 64-bit hash of their words' hashes. Only where one repeats are they sorted: then repeats
    are neighbours, and each adds the words up to the next one, or its whole length.
    """
    def hashes(of_words):
        places = F.sequence(F.lit(0), F.size(of_words) - window)
        return F.transform(places, lambda at: F.xxhash64(*[of_words[at + i] for i in range(window)]))

    def covered(found):
        def same(ordered, at, other):
            return F.get(ordered, other)["window"].eqNullSafe(ordered[at]["window"])

        ordered = F.sort_array(F.transform(found, lambda value, at: F.struct(value.alias("window"), at.alias("at"))))
        places = let(ordered, lambda rows: F.sort_array(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda at: same(rows, at, at - 1) | same(rows, at, at + 1)),
            lambda at: rows[at]["at"])))
        return let(places, lambda starts: F.aggregate(
            F.transform(starts, lambda start, at: F.least(F.lit(window), F.coalesce(F.get(starts, at + 1) - start, F.lit(window)))),
            F.lit(0).cast("long"), lambda total, added: total + added))

    counted = let(F.transform(words, lambda word: F.xxhash64(word)), lambda of_words: let(
        hashes(of_words), lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long"))
        .otherwise(covered(found))))
    return F.when(F.size(words) < window, F.lit(0).cast("long")).otherwise(counted)


def judge(docs: DataFrame, text_column: str = "text", max_lost: float = 0.5) -> DataFrame:
    """Add ``quality``, a struct of the counts, the verdict and the cleaned text, to every row.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` count over the whole text, whose words
    lie between ASCII white space. ``base_failed``: fewer than 20 words, or more than 30 in 100 of them in repeated windows.
    ``kept``: not ``base_failed``, and the lines that fail a rule hold at most ``max_lost`` of the characters of all lines
    with a word. ``clean_text`` is the text without failing lines. A missing or empty text counts 0 everywhere, fails the
    base rules and has an empty clean text. Rows are judged one by one, so repeated rows get equal results.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))

    def counted(words, lines):
        full = F.filter(lines, lambda line: line.rlike(WORD))
        judged = F.transform(lines, lambda line: F.struct(
            line.alias("line"), F.length(line).cast("long").alias("chars"), line.rlike(WORD).alias("full"),
            F.coalesce(line.rlike(WORD) & line_failure(line).isNotNull(), F.lit(False)).alias("failed")))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            count(text, SYMBOLS).alias("n_symbols"),
            (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            judged.alias("lines"))

    def total(lines, chosen):
        return F.aggregate(lines, F.lit(0).cast("long"), lambda chars, line: chars + F.when(chosen(line), line["chars"]).otherwise(0))

    def verdict(found):
        base_failed = (found["n_words"] < 20) | (100 * found["n_repeat_words"] > 30 * found["n_words"])
        lost, whole = total(found["lines"], lambda line: line["failed"]), total(found["lines"], lambda line: line["full"])
        return F.struct(
            *[found[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            base_failed.alias("base_failed"), (~base_failed & (lost <= max_lost * whole)).alias("kept"), lost.alias("lost_chars"),
            F.array_join(F.transform(F.filter(found["lines"], lambda line: ~line["failed"]), lambda line: line["line"]), "\n")
            .alias("clean_text"))

    measured = let(words_of(text), lambda words: let(F.split(text, "\n"), lambda lines: counted(words, lines)))
    others = [F.col(f"`{name}`") for name in docs.columns if name != "quality"]
    # As a generator's output the struct is made once per row, also where a filter and several columns use it.
    return docs.select(*others, F.explode(F.array(let(measured, verdict))).alias("quality"))


def clean(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Kept documents with their cleaned text; the columns stay as they are, whatever their names."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    judged = judge(docs.select(row, F.col(f"`{text_column}`").alias("text"))).filter("quality.kept")
    return judged.select([(F.col("quality.clean_text") if name == text_column else F.col("row")[name]).alias(name) for name in docs.columns])
