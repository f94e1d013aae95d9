"""Summary scores: n-gram overlap and longest common subsequence, row by row without a shuffle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.porter import stem_word
from corpusloom.functions.text import summary_tokens

UNSTEMMED_LENGTH = 3  # fixed value: tokens up to this length stay as they are
MEMO_TOKENS = 200_000
STEMMED_ROWS = 1_024  # rows of a batch whose tokens are looked up at once
LISTED_ROWS = 256  # rows of a batch whose tokens are Python strings at once


def _stemmer():
    memo: dict[str, str] = {}

    def stem(token: str) -> str:
        if len(token) <= UNSTEMMED_LENGTH:
            return token
        known = memo.get(token)
        if known is None:
            known = stem_word(token)
            if len(memo) >= MEMO_TOKENS:
                memo.clear()
            memo[token] = known
        return known

    def stem_lists(tokens: pa.Array) -> pa.Array:
        """Stem each distinct token of some rows of a batch once."""
        parts = [stem_some(tokens.slice(i, STEMMED_ROWS)) for i in range(0, len(tokens), STEMMED_ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    def stem_some(tokens: pa.Array) -> pa.Array:
        coded = tokens.flatten().dictionary_encode()
        stems = pa.array([stem(t) for t in coded.dictionary.to_pylist()], pa.string())
        lengths = np.asarray(tokens.value_lengths().fill_null(0), dtype=np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        missing = tokens.is_null() if tokens.null_count else None
        return pa.ListArray.from_arrays(offsets, stems.take(coded.indices), mask=missing)

    return stem_lists


def score_tokens(col: Column | str, stem: bool = True) -> Column:
    tokens = summary_tokens(col)
    return F.arrow_udf(_stemmer(), "array<string>")(tokens) if stem else tokens


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens."""
    runs = tokens
    for k in range(2, n + 1):
        left = F.greatest(F.size(tokens) - k + 1, F.lit(0))
        runs = F.zip_with(
            F.slice(runs, F.lit(1), left),
            F.slice(tokens, F.lit(k), left),
            lambda run, token: F.concat(run, F.lit(" "), token),
        )
    return runs


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbered(grams: Column) -> Column:
    """The grams with ``1``, ``2``, ... for their occurrences, so that no two entries are equal.

    Runs of equal grams are found in the sorted array, which keeps the work linear.
    """

    def runs(ordered: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )

    def spread(ordered: Column, starts: Column) -> Column:
        def occurrences(at: Column, k: Column) -> Column:
            length = F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at
            return F.transform(
                F.sequence(F.lit(1), length),
                lambda c: F.concat(F.get(ordered, at), F.lit(" "), c.cast("string")),
            )

        return F.flatten(F.transform(starts, occurrences))

    counted = _bind(
        F.sort_array(grams), lambda o: _bind(runs(o), lambda starts: spread(o, starts))
    )
    return F.when(F.size(grams) > 0, counted).otherwise(F.array().cast("array<string>"))


def clipped_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection."""
    return F.size(F.array_intersect(numbered(a), numbered(b)))


def f_measure(hits: Column, reference_size: Column, hypothesis_size: Column) -> Column:
    precision = hits / F.greatest(hypothesis_size, F.lit(1))
    recall = hits / F.greatest(reference_size, F.lit(1))
    return F.when(hits > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one bit per token of ``a``."""
    places: dict[str, int] = {}
    for i, token in enumerate(a):
        places[token] = places.get(token, 0) | (1 << i)
    everything = (1 << len(a)) - 1
    open_places = everything
    for token in b:
        hit = open_places & places.get(token, 0)
        open_places = ((open_places + hit) | (open_places - hit)) & everything
    return len(a) - open_places.bit_count()


def _lcs_lengths(a: pa.Array, b: pa.Array) -> pa.Array:
    found: list[int | None] = []
    for start in range(0, len(a), LISTED_ROWS):
        rows = zip(*(side.slice(start, LISTED_ROWS).to_pylist() for side in (a, b)))
        found += [None if x is None or y is None else common_subsequence(x, y) for x, y in rows]
    return pa.array(found, pa.int32())


def lcs_length(a: Column, b: Column) -> Column:
    return F.arrow_udf(_lcs_lengths, "int")(a, b)


def rouge_scores(
    df: DataFrame,
    reference: str,
    hypothesis: str,
    kinds: tuple[str, ...] = ("rouge1", "rouge2", "rougeL"),
    stem: bool = True,
) -> DataFrame:
    """Add the F measure of each kind to each row."""
    out = df.withColumn("_r", score_tokens(reference, stem)).withColumn(
        "_h", score_tokens(hypothesis, stem)
    )
    r, h = F.col("_r"), F.col("_h")
    for kind in kinds:
        if kind == "rougeL":
            hits, m, n = lcs_length(r, h), F.size(r), F.size(h)
        else:
            size = int(kind.removeprefix("rouge"))
            hits = clipped_overlap(ngrams(r, size), ngrams(h, size))
            m, n = (F.greatest(F.size(t) - size + 1, F.lit(0)) for t in (r, h))
        # a column of its own, since the measure uses it several times
        out = out.withColumn("_hits", hits)
        out = out.withColumn(kind, f_measure(F.col("_hits"), m, n)).drop("_hits")
    return out.drop("_r", "_h")


def rouge_report(
    scored: DataFrame, kinds: tuple[str, ...] = ("rouge1", "rouge2", "rougeL")
) -> DataFrame:
    """Mean of the row scores, and how many rows there are."""
    return scored.agg(F.count("*").alias("num_samples"), *[F.avg(k).alias(k) for k in kinds])
