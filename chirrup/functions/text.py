"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def space_words(text: Column) -> Column:
    """Split on single spaces; repeated, leading and trailing spaces give empty words."""
    return F.split(text, " ")


def letter_tokens(text: Column) -> Column:
    """Lower-cased runs of letters of any script; a null text has no tokens."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    return F.coalesce(runs, F.array().cast("array<string>"))


def word_counts(words: Column) -> Column:
    """The distinct words of an array, sorted, as `(word, uses)`; counted in the row, by the ends of equal words in order."""

    def counted(ordered: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(ordered), F.lit(1)))
        last = F.filter(places, lambda i: F.get(ordered, i - 1).isNotNull() & ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)))
        return F.transform(F.array(last), lambda ends: _lengths(ordered, ends))[0]

    return F.transform(F.array(F.sort_array(words)), counted)[0]


def _lengths(ordered: Column, ends: Column) -> Column:
    def run(end: Column, i: Column) -> Column:
        before = F.coalesce(F.get(ends, i - 1), F.lit(0))
        return F.struct(F.get(ordered, end - 1).alias("word"), (end - before).cast("long").alias("uses"))

    return F.transform(ends, run)
