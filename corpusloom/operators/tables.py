"""Column selection, length filters, row functions, corpus lines and example rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import clip_text
from corpusloom.operators.ordering import head_n

MAX_INPUT_LENGTH = 480_000  # fixed value: 30 seconds at 16 kHz
MAX_LABEL_LENGTH = 448  # fixed value
SERIES_ROWS = 512  # rows of a batch that are Python values at once
# Types whose Arrow values become the same series with and without Spark's own conversion.
_PLAIN = (T.StringType, T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType)


def keep_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Drop every column that is not in the keep-list; names the table lacks are ignored."""
    return df.select(*[c for c in df.columns if c in set(keep)])


def filter_length(
    df: DataFrame,
    col: Column | str,
    lo: float | None = 0,
    hi: float | None = MAX_INPUT_LENGTH,
) -> DataFrame:
    """Rows whose length lies strictly between the bounds; ``None`` leaves a side open."""
    n = F.col(col) if isinstance(col, str) else col
    if lo is not None:
        df = df.where(n > lo)
    if hi is not None:
        df = df.where(n < hi)
    return df


def filter_rows(df: DataFrame, fn: Callable[..., Column], columns: Sequence[str]) -> DataFrame:
    """Keep the rows for which ``fn`` of the named columns, a Column expression, holds."""
    return df.where(fn(*[F.col(c) for c in columns]))


def filter_batches(
    df: DataFrame, fn: Callable[..., Sequence[bool] | pd.Series], columns: Sequence[str]
) -> DataFrame:
    """Keep the rows for which a Python predicate of the named columns holds.

    ``fn`` gets one series for each column and returns one truth value for each row; null drops the row.
    Texts and numbers are handed over a few rows of a batch at a time, so that long texts are not all
    Python strings at once.
    """

    @F.pandas_udf("boolean")
    def holds(*series: pd.Series) -> pd.Series:
        return pd.Series(fn(*series)).astype("boolean")

    if columns and all(isinstance(df.select(c).schema[0].dataType, _PLAIN) for c in columns):

        @F.arrow_udf("boolean")
        def holds(*arrays: pa.Array) -> pa.Array:
            kept = []
            for start in range(0, len(arrays[0]), SERIES_ROWS):
                series = (a.slice(start, SERIES_ROWS).to_pandas() for a in arrays)
                kept.append(pa.array(pd.Series(fn(*series)).astype("boolean"), pa.bool_()))
            return pa.concat_arrays(kept) if kept else pa.array([], pa.bool_())

    return df.where(holds(*[F.col(c) for c in columns]))


def map_rows(
    df: DataFrame,
    fn: Callable[[dict], Mapping],
    schema: T.StructType | str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Call a Python function on every row and keep only the columns of ``schema``.

    The columns the function needs can be named, so that the scan reads no others. Rows stay in their
    partitions and travel in Arrow batches.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [fn(row) for row in batch.to_dict("records")]
            yield pd.DataFrame([[row[c] for c in names] for row in rows], columns=names)

    source = df if columns is None else df.select(*columns)
    return source.mapInPandas(run, schema)


def corpus_lines(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One text per row; several columns give their texts one after another."""
    return df.select(F.explode(F.array(*columns)).alias("value"))


def examples(
    df: DataFrame,
    k: int,
    order: Sequence[str],
    columns: Mapping[str, str] | Sequence[str],
    clip: Mapping[str, int] | None = None,
) -> DataFrame:
    """The first ``k`` rows in order, renamed, with long columns cut to a preview."""
    named = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    clip = clip or {}
    shown = [
        (clip_text(c, clip[c]) if c in clip else F.col(c)).alias(name) for c, name in named.items()
    ]
    extra = [c for c in order if c not in named.values()]
    return head_n(df, k, order).select(*extra, *shown)
