"""Column expressions that several operators share."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII white space that separates words, as characters and as a class of a pattern.
BLANKS = " \t\n\x0b\f\r"
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used, also inside of lambdas."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for a missing one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK))
