"""Word error rate: built-in edit distance over words written as single characters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import words


def _letter(place: Column) -> Column:
    """A code point for a 1-based place, past ASCII and around the surrogates."""
    point = place + 0xFF
    point = F.when(point >= 0xD800, point + 0x800).otherwise(point)
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def array_edit_distance(a: Column, b: Column) -> Column:
    """Insertions, deletions and substitutions between two arrays of words.

    The pair's distinct words become one character each, which leaves the distance to the built-in
    ``levenshtein``. There are code points for a million distinct words in a pair.
    """
    known = F.array_distinct(F.concat(a, b))

    def coded(side: Column, vocabulary: Column) -> Column:
        return F.array_join(
            F.transform(side, lambda w: _letter(F.array_position(vocabulary, w))), ""
        )

    # bind the three arrays once
    bound = F.transform(
        F.array(F.struct(a.alias("a"), b.alias("b"), known.alias("known"))),
        lambda p: F.levenshtein(coded(p["a"], p["known"]), coded(p["b"], p["known"])),
    )
    return F.get(bound, F.lit(0)).cast("bigint")


def word_edit_distance(reference: Column | str, hypothesis: Column | str) -> Column:
    return array_edit_distance(words(reference), words(hypothesis))


def word_errors(df: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """Add the word edits and the reference length of each row."""
    return df.withColumn("edits", word_edit_distance(reference, hypothesis)).withColumn(
        "ref_words", F.size(words(reference)).cast("bigint")
    )


def wer(
    df: DataFrame, reference: str, hypothesis: str, by: Sequence[str] = ()
) -> DataFrame:
    """Edits per 100 reference words over the whole corpus; NULL where there is no reference word."""
    rate = F.sum("edits") * 100.0 / F.nullif(F.sum("ref_words"), F.lit(0))
    aggregates = [
        rate.alias("wer"),
        F.sum("edits").alias("edits"),
        F.sum("ref_words").alias("ref_words"),
        F.count("*").alias("num_samples"),
    ]
    return word_errors(df, reference, hypothesis).groupBy(*by).agg(*aggregates)
