"""Balanced samples, ratio splits and their size reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import BUCKET_DIGITS, rows_at, shuffle_place
from corpusloom.session import broadcast_if_small

SPLITS = ("train", "validation", "test")


def balanced_sample(
    df: DataFrame,
    label: str,
    n: int,
    keys: Sequence[str],
    seed: int = 42,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """The first ``n`` rows of each class in the seeded shuffle; a smaller class gives all its rows.

    The ``n``-th place of each class is found among the keys; the table is then filtered in place,
    so a class with most of the rows never meets in one task.
    """
    if n < 1:
        return df.where(F.lit(False))
    cut = rows_at(
        df,
        keys,
        seed,
        lambda totals: totals.select(label, F.lit(0).alias("_cut"), F.lit(n).alias("_position")),
        group=[label],
        digits=digits,
    ).select(label, F.col("_place").alias("_last"))
    joined = df.join(broadcast_if_small(cut), label, "left")
    kept = F.col("_last").isNull() | (shuffle_place(keys, seed) <= F.col("_last"))
    return joined.where(F.col(label).isNotNull() & kept).select(df.columns)


def _double(value: float) -> Column:
    return F.lit(float(value))


def cut_splits(
    df: DataFrame,
    ends: Callable[[Column], Sequence[Column]],
    keys: Sequence[str],
    seed: int = 42,
    names: Sequence[str] = SPLITS,
    split: str = "split",
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Cut the seeded shuffle at the positions ``ends(total)`` and name the parts.

    Adds the split as a column without moving a row. The places of the cuts are looked up at once; a
    cut at position 0 has none and leaves its part empty.
    """

    def wanted(totals: DataFrame) -> DataFrame:
        positions = F.array(*[p.cast("bigint") for p in ends(F.col("_total"))])
        return totals.select(F.posexplode(positions).alias("_cut", "_position"))

    found = rows_at(df, keys, seed, wanted, digits=digits)
    # one row per cut at most; as constants they leave the result a plain projection of the table
    places = {row["_cut"]: row["_place"] for row in found.collect()}
    types = {f.name: f.dataType for f in found.schema["_place"].dataType.fields}
    here = shuffle_place(keys, seed)
    name = F.lit(names[-1])
    for cut in sorted(places, reverse=True):
        fields = [
            F.lit(value).cast(types[f]).alias(f) for f, value in places[cut].asDict().items()
        ]
        name = F.when(here <= F.struct(*fields), F.lit(names[cut])).otherwise(name)
    return df.withColumn(split, name)


def ratio_split(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 42,
    cuts: Sequence[float] = (0.95, 0.975),
    **options,
) -> DataFrame:
    """Split at ``floor(cut * total)``, in double arithmetic."""
    return cut_splits(
        df, lambda total: [F.floor(_double(c) * total) for c in cuts], keys, seed, **options
    )


def resplit(
    df: DataFrame, keys: Sequence[str], seed: int = 42, train_ratio: float = 0.95, **options
) -> DataFrame:
    """Split pooled rows anew; the second cut is the first plus ``floor((1 - r) / 2 * total)``."""

    def ends(total: Column) -> list[Column]:
        first = F.floor(_double(train_ratio) * total)
        return [first, first + F.floor(_double((1 - train_ratio) / 2) * total)]

    return cut_splits(df, ends, keys, seed, **options)


def split_report(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Rows of each split (and class), and their share of the total in percent."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("rows"))
    total = sizes.agg(F.sum("rows")).scalar()
    return sizes.withColumn("percent", F.col("rows") * 100.0 / total)
