"""Row identities and gapless numbers that no hot key can slow down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

ROW = "__row"  # a unique long for each row of a written table
CHUNK_BITS = 16  # rows are numbered in chunks of 2 ** 16


def with_rows(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` with a unique number per row, so that repeated rows and equal keys stay apart.

    The numbers are read from the written copy and do not change when a task runs again.
    """
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), name)


def gapless(df: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in the order of their row numbers.

    Rows are counted in chunks of consecutive row numbers, so a window never holds more than
    2 ** 16 rows, whatever the share of one group; only chunk totals are accumulated per group.
    """
    groups = list(groups)
    chunked = df.withColumn("__chunk", F.shiftright(ROW, CHUNK_BITS))
    totals = chunked.groupBy(*groups, "__chunk").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups, "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy(*groups, "__chunk").orderBy(ROW)
    numbered = chunked.withColumn("__inside", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, [*groups, "__chunk"])
        .withColumn(name, F.col("__inside") + F.col("__before"))
        .drop("__chunk", "__inside", "__before")
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
