"""Losses, accuracies and pooled vectors as aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_table(
    df: DataFrame, metrics: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Any set of named aggregate columns, over the table or per group, in one pass."""
    named = [m.alias(name) for name, m in metrics.items()]
    return df.groupBy(*by).agg(*named) if by else df.agg(*named)


def mean_loss(loss: Column | str) -> Column:
    """Loss per row; 0 where there is no row. Weighting batch means by size comes to the same."""
    return F.coalesce(F.avg(loss), F.lit(0.0))


def accuracy(prediction: Column | str, label: Column | str) -> Column:
    """Share of rows whose prediction is the label; 0 where there is no row."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    y = F.col(label) if isinstance(label, str) else label
    return F.coalesce(F.avg((p == y).cast("double")), F.lit(0.0))


def masked_mean_of_means(
    df: DataFrame, batch: str, loss: str, target: str, pad: int
) -> DataFrame:
    """Mean over batches of each batch's mean token loss, padding and null targets left out.

    A batch of nothing but padding has no mean: its loss is NaN, and so is the mean over all batches.
    """
    counted = F.when(F.col(target) != pad, F.col(loss))
    per_batch = df.groupBy(batch).agg(
        F.coalesce(F.avg(counted), F.lit(float("nan"))).alias("batch_loss")
    )
    return per_batch.agg(
        F.avg("batch_loss").alias("loss"), F.count("*").alias("batches")
    )


def pool_vectors(
    df: DataFrame,
    group: str,
    position: str,
    vector: str,
    mode: str = "mean",
    mask: str | None = None,
) -> DataFrame:
    """One vector per group: the one at the first position (``cls``) or the mean over positions.

    The mean counts every position, padding too, unless a 0/1 ``mask`` column is named. Sums are built
    per dimension on the map side, so a group of any size shuffles one row per task and dimension.
    """
    if mode == "cls":
        return df.groupBy(group).agg(F.min_by(vector, position).alias(vector))
    if mode != "mean":
        raise ValueError(f"unknown pooling: {mode}")
    rows = df if mask is None else df.where(F.col(mask) == 1)
    dims = (
        rows.select(group, F.posexplode(vector).alias("_dim", "_x"))
        .groupBy(group, "_dim")
        .agg(F.avg(F.col("_x").cast("double")).alias("_mean"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("_dim", "_mean")))
    return dims.groupBy(group).agg(F.transform(ordered, lambda s: s["_mean"]).alias(vector))
