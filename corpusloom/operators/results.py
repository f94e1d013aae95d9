"""Metadata and results records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.sampling import SPLITS


def build_metadata(
    df: DataFrame,
    facts: Mapping[str, Column | int | float | str | None],
    split: str = "split",
    total: str | None = "total_samples",
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row: the size of the whole and of each split, then the given facts."""
    names = names or dict(zip(SPLITS, ("train_samples", "val_samples", "test_samples")))
    sizes = [F.count_if(F.col(split) == s).alias(name) for s, name in names.items()]
    whole = [F.count("*").alias(total)] if total else []
    given = [
        (v if isinstance(v, Column) else F.lit(v)).alias(name) for name, v in facts.items()
    ]
    return df.agg(*whole, *sizes).select("*", *given)


def results_record(
    scalars: DataFrame,
    nested: Mapping[str, Mapping[str, Column]] | None = None,
    lists: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]] | None = None,
) -> DataFrame:
    """A nested record from a one-row table of scalars.

    ``nested`` adds structs. ``lists`` adds arrays of structs from tables of a fixed number of rows, such as
    the first examples, each given as (table, order columns, struct columns). The record is one row
    whatever the length of a training history, which is a table of its own (``traininglog.history``).
    """
    out = scalars
    for name, fields in (nested or {}).items():
        out = out.withColumn(name, F.struct(*[c.alias(f) for f, c in fields.items()]))
    for name, (table, order, columns) in (lists or {}).items():
        rows = F.array_sort(
            F.collect_list(F.struct(F.struct(*order).alias("at"), F.struct(*columns).alias("row")))
        )
        packed = table.agg(F.transform(rows, lambda r: r["row"]))
        out = out.withColumn(name, packed.scalar())
    return out
