"""Pools of CSV files whose rows have no key: a row is known by where it stands.

Exact copies are common in a pool of split files, so that no column and no hash tells rows apart. The place
of a row does: its file, the block of the file it was read from, and its number in that block. Blocks are
read from start to end by one task each, and a task that runs again counts the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import broadcast_if_small, materialize
from corpusloom.sources.files import below, existing
from corpusloom.sources.tabular import read_split_csv

FILE, ROW = "row_file", "row_number"
_BLOCK = "row_block"


def numbered_in_blocks(scan: DataFrame) -> DataFrame:
    """Number the rows of each (``row_file``, ``row_block``) from 0, in the order they are read.

    ``scan`` must come from the files by projections alone: then a task holds whole blocks, one after
    another. The rows pass through in Arrow batches.
    """
    schema = T.StructType([*scan.schema.fields, T.StructField(ROW, T.LongType())])
    file, block = scan.columns.index(FILE), scan.columns.index(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            files = batch.column(file).dictionary_encode()
            names = files.dictionary.to_pylist()
            codes, blocks = files.indices.to_numpy(), batch.column(block).to_numpy()
            change = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            starts = np.concatenate([[0], change])
            before = np.zeros(len(starts), np.int64)
            if (names[codes[0]], blocks[0]) == last:
                before[0] = seen
            sizes = np.diff(np.concatenate([starts, [n]]))
            numbers = np.arange(n) - np.repeat(starts - before, sizes)
            last, seen = (names[codes[-1]], blocks[-1]), int(numbers[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=schema.names)

    return scan.mapInArrow(run, schema)


def read_pool(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | str,
    require_any: bool = True,
) -> DataFrame:
    """The rows of all the CSV files that exist, with ``row_file`` and ``row_number``, which identify a row.

    ``row_file`` is the place of the given path among all, and the file below it, so that moving the folders
    changes no identity. ``row_number`` counts a file's rows from 0: rows are numbered in their block, and
    the rows of the blocks before are added, a table of one row per block. The pool is written to the
    shared folder once, and not parsed again by what follows. None of the paths existing is an error, or
    an empty pool.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if clash := {FILE, ROW, _BLOCK} & {c.lower() for c in schema.fieldNames()}:
        raise ValueError(f"there is a column {min(clash)} already")
    scans = []
    for place, path in enumerate(paths):
        if not existing(spark, [path]):
            continue
        name = below(spark, path, F.col("_metadata.file_path"))
        scans.append(
            read_split_csv(spark, path, schema).select(
                *schema.fieldNames(),
                F.concat_ws(":", F.lit(str(place)), name).alias(FILE),
                F.col("_metadata.file_block_start").alias(_BLOCK),
            )
        )
    if not scans:
        if require_any:
            raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")
        return spark.createDataFrame([], schema.add(FILE, "string").add(ROW, "long"))
    pool = materialize(numbered_in_blocks(reduce(DataFrame.unionByName, scans)), "pool")
    # one row for each block: its rows, then the rows before it in its file
    blocks = pool.groupBy(FILE, _BLOCK).agg(F.count("*").alias("n"))
    if blocks.groupBy(FILE).count().where("count > 1").isEmpty():
        return pool.drop(_BLOCK)
    upto = Window.partitionBy(FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(FILE, _BLOCK, F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    joined = pool.join(broadcast_if_small(offsets), [FILE, _BLOCK])
    return joined.select(
        *schema.fieldNames(), FILE, (F.col(ROW) + F.col("before")).alias(ROW)
    )
