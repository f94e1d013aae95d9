"""Mini-batches over a shuffle rank, and what a collator does inside a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import mask_labels, pad_ids
from corpusloom.operators.ordering import rows_at, shuffle_place, shuffle_rank

MEGA_BATCHES = 50  # fixed value: batches per window inside which rows are sorted by length


def assign_batches(
    df: DataFrame,
    size: int,
    drop_last: bool = False,
    rank: str = "rank",
    base: DataFrame | None = None,
) -> DataFrame:
    """Number the batches along a 1-based rank; ``drop_last`` leaves out an unfilled last batch.

    ``base`` is the table before it was ranked: counting it spares ranking the rows a second time.
    """
    batched = df.withColumn("batch_id", F.floor((F.col(rank) - 1) / size))
    if not drop_last:
        return batched
    full = (df if base is None else base).agg(F.floor(F.count("*") / size)).scalar()
    return batched.where(F.col("batch_id") < full)


def length_grouped_batches(
    df: DataFrame,
    length: str,
    size: int,
    keys: Sequence[str],
    seed: int = 42,
    mega_batches: int = MEGA_BATCHES,
) -> DataFrame:
    """Batches of similar length: shuffle, sort each window of ``mega_batches`` by length, longest first.

    Training libraries take fewer batches to a window where the table is small; the caller says so.

    The longest row of all changes places with the first row, so that the most memory is needed at once.
    Adds ``position`` (0-based) and ``batch_id``.
    """
    window_rows = mega_batches * size
    ranked = shuffle_rank(df, keys, seed, rank="_rank").withColumn(
        "_mega", F.floor((F.col("_rank") - 1) / window_rows)
    )
    inside = Window.partitionBy("_mega").orderBy(F.desc(length), "_rank")
    placed = ranked.withColumn(
        "_place", F.col("_mega") * window_rows + F.row_number().over(inside) - 1
    )
    # the longest row that comes first in the shuffle, and how many rows come before it: two narrow scans
    here = shuffle_place(keys, seed)
    known = df.where(F.col(length).isNotNull())
    first = known.agg(F.min(F.struct((-F.col(length)).alias("n"), here.alias("place"))).alias("f")).scalar()
    earlier = df.where(here < first["place"]).agg(F.count("*")).scalar()
    peak = F.floor(earlier / window_rows) * window_rows
    swapped = (
        F.when(F.col("_place") == 0, peak)
        .when(F.col("_place") == peak, F.lit(0))
        .otherwise(F.col("_place"))
    )
    return (
        placed.withColumn("position", swapped.cast("bigint"))
        .withColumn("batch_id", F.floor(F.col("position") / size))
        .drop("_rank", "_mega", "_place")
    )


def pad_to_batch_max(df: DataFrame, col: str, pad: int, batch: str = "batch_id") -> DataFrame:
    """Pad each sequence to the longest of its batch and keep its own length as ``<col>_length``."""
    longest = F.max(F.size(col)).over(Window.partitionBy(batch))
    return df.withColumn(f"{col}_length", F.size(col)).withColumn(
        col, pad_ids(F.col(col), longest, pad)
    )


def strip_common_bos(df: DataFrame, col: str, bos: int, batch: str = "batch_id") -> DataFrame:
    """Cut off the first id where every sequence of the batch begins with ``bos``."""
    shared = F.bool_and(F.coalesce(F.get(col, F.lit(0)) == bos, F.lit(False))).over(
        Window.partitionBy(batch)
    )
    rest = F.slice(col, F.lit(2), F.greatest(F.size(col) - 1, F.lit(0)))
    return df.withColumn(col, F.when(shared, rest).otherwise(F.col(col)))


def collate_labels(
    df: DataFrame, col: str, pad: int, bos: int | None = None, batch: str = "batch_id"
) -> DataFrame:
    """What a collator does to labels: pad to the batch, ignore the padding, drop a shared first id.

    All windows are over the batch, so the rows are shuffled once.
    """
    out = pad_to_batch_max(df, col, pad, batch)
    out = out.withColumn(col, mask_labels(col, f"{col}_length")).drop(f"{col}_length")
    return out if bos is None else strip_common_bos(out, col, bos, batch)


def step_plan(df: DataFrame, batch_size: int, epochs: int) -> DataFrame:
    """Steps per epoch of full batches, and in total."""
    per_epoch = F.floor(F.count("*") / batch_size)
    return df.agg(
        per_epoch.alias("steps_per_epoch"), (per_epoch * epochs).alias("total_steps")
    )


def first_shuffled_batches(
    df: DataFrame, k: int, size: int, keys: Sequence[str], seed: int = 42
) -> DataFrame:
    """The first ``k`` batches of the seeded shuffle, with ``rank`` and ``batch_id``.

    The place of the last row is looked up among the keys; only the rows before it are ranked.
    """
    last = rows_at(
        df,
        keys,
        seed,
        lambda totals: totals.select(
            F.lit(0).alias("_cut"), F.least(F.col("_total"), F.lit(k * size)).alias("_position")
        ),
    )
    kept = df.where(shuffle_place(keys, seed) <= last.agg(F.max("_place")).scalar())
    return assign_batches(shuffle_rank(kept, keys, seed), size)


def first_batches(df: DataFrame, k: int, batch: str = "batch_id") -> DataFrame:
    """The rows of the first ``k`` batches, for a partial evaluation."""
    return df.where(F.col(batch) < k)
