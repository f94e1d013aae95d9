"""Split files as CSV, Parquet, JSON and plain text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources.files import existing

# Free text holds commas, quotes and line breaks; a cell that reads NA is text, not a missing value.
CSV_READ = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
CSV_WRITE = {"header": True, "quoteAll": True, "quote": '"', "escape": '"', "emptyValue": ""}
# keep leading and trailing blanks of a text
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

LABELED = "text string, label int"
PAIRS = "article string, summary string"
LOG_HISTORY = "step bigint, loss double, eval_loss double, eval_wer double"


def read_split_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str
) -> DataFrame:
    """A CSV split with a fixed schema; an empty cell is an empty text."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    read = spark.read.options(**CSV_READ, **_KEEP_BLANKS).schema(schema)
    table = read.csv(path if isinstance(path, str) else list(path))
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return table.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in texts})


def read_union(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | str,
    require_any: bool = True,
) -> DataFrame:
    """All the CSV files that exist, as one table. None at all is an error or an empty table."""
    found = existing(spark, paths)
    if found:
        return read_split_csv(spark, found, schema)
    if require_any:
        raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")
    return spark.createDataFrame([], schema)


def union_splits(
    tables: Mapping[str, DataFrame], columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Named splits as one table with a ``split`` column, keeping and renaming the given columns."""

    def part(name: str, df: DataFrame) -> DataFrame:
        kept = [F.col(c).alias(new) for c, new in columns.items()] if columns else [F.col("*")]
        return df.select(*kept, F.lit(name).alias("split"))

    return reduce(DataFrame.unionByName, [part(n, df) for n, df in tables.items()])


def read_splits(
    spark: SparkSession, paths: Mapping[str, str], columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Parquet splits, one path each, as one table."""
    return union_splits({name: spark.read.parquet(p) for name, p in paths.items()}, columns)


def write_splits_csv(
    df: DataFrame, path: str, columns: Sequence[str], split: str = "split", mode: str = "errorifexists"
) -> None:
    """The chosen columns as CSV, one folder per split, without an index column."""
    writer = df.select(*columns, split).write.mode(mode).partitionBy(split)
    writer.options(**CSV_WRITE, **_KEEP_BLANKS).csv(path)


def write_dataset(
    df: DataFrame, path: str, split: str = "split", mode: str = "errorifexists"
) -> None:
    """The whole table as Parquet, one folder per split."""
    df.write.mode(mode).partitionBy(split).parquet(path)


def read_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A saved dataset, or one split of it; other splits' files are not read then."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def write_corpus_text(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text per line, for the output of ``corpus_lines``."""
    lines.select("value").write.mode(mode).text(path)


def write_record(record: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A metadata or results record as JSON; absent values are written as null."""
    record.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_record(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_log_history(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str = LOG_HISTORY,
    multi_line: bool = True,
) -> DataFrame:
    """Trainer logs; a key a record lacks is NULL.

    A file is one array of records, over any number of lines, or with ``multi_line=False`` holds an array
    or a record on each line and can be read in parts.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
