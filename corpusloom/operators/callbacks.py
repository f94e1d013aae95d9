"""Any Python metric and any Python collator, called with whole Arrow tables.

A metric is four functions: a first state, a state updated with some rows, two states merged, and the result
of a state. Tasks update a state of their own for each group and send it once; states are merged in two
rounds, so that no task gathers one from every other. A collator gets all rows of a batch at once; rows are
dealt out by ranges of their batch, so that neighbouring batches share a task and none is split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUPS = 10_000  # states a task holds before it sends them
MERGERS = 64  # tasks that merge the states of a group in the first round
ROWS = 4_096  # rows a state is updated with at once, at most


@dataclass(frozen=True)
class Metric:
    """``start()``, ``update(state, rows)``, ``merge(state, state)`` and ``finish(state)``.

    ``rows`` is an Arrow table of the columns asked for. A state may be any object that can be pickled.
    ``finish`` gives a value for each field of ``schema``. The order of updates and merges is not set.
    """

    start: Callable[[], Any]
    update: Callable[[Any, pa.Table], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Mapping[str, Any]]
    schema: str


def evaluate(df: DataFrame, metric: Metric, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by``, null being a group too, or one row for the table, even an empty one."""
    columns, by = list(columns), list(by)
    result = T.StructType.fromDDL(metric.schema)
    named = [f"_by{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(by, named)], *[F.col(c) for c in columns])
    groups = [T.StructField(n, df.schema[c].dataType) for c, n in zip(by, named)]
    states = T.StructType([*groups, T.StructField("_merger", T.IntegerType()), T.StructField("_state", T.BinaryType())])
    final = T.StructType([*groups, *result.fields])

    def sent(held: dict[tuple, Any], kinds: list[pa.DataType]) -> pa.RecordBatch:
        merger = TaskContext.get().partitionId() % MERGERS
        arrays = [pa.array([key[i] for key in held], kind) for i, kind in enumerate(kinds)]
        arrays.append(pa.array([merger] * len(held), pa.int32()))
        arrays.append(pa.array([cloudpickle.dumps(state) for state in held.values()], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, names=[*named, "_merger", "_state"])

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.schema.field(n).type for n in named]
            for start in range(0, batch.num_rows, ROWS):
                part = pa.Table.from_batches([batch.slice(start, ROWS)])
                for key, own in _groups(part, named):
                    state = held[key] if key in held else metric.start()
                    held[key] = metric.update(state, own.select(columns))
                if len(held) > GROUPS:
                    yield sent(held, kinds)
                    held = {}
        if held:
            yield sent(held, kinds)

    def merged(table: pa.Table) -> Any:
        first, *others = map(cloudpickle.loads, table.column("_state").to_pylist())
        for state in others:
            first = metric.merge(first, state)
        return first

    def merge(table: pa.Table) -> pa.Table:
        state = pa.array([cloudpickle.dumps(merged(table))], pa.binary())
        return table.slice(0, 1).set_column(table.schema.get_field_index("_state"), "_state", state)

    def finish(table: pa.Table) -> pa.Table:
        found = metric.finish(merged(table))
        keys = {n: table.column(n).slice(0, 1) for n in named}
        kinds = _arrow_types(result)
        return pa.table(keys | {f.name: pa.array([found[f.name]], kinds[f.name]) for f in result.fields})

    partial = rows.mapInArrow(update, states)
    if not by:
        # a state of no rows, so that an empty table has a result
        nothing = [(0, cloudpickle.dumps(metric.start()))]
        partial = partial.unionByName(df.sparkSession.createDataFrame(nothing, states))
    reduced = partial.groupBy(*named, "_merger").applyInArrow(merge, states)
    out = reduced.groupBy(*named).applyInArrow(finish, final)
    return out.select(*[F.col(n).alias(c) for c, n in zip(by, named)], *result.fieldNames())


def _groups(table: pa.Table, by: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each group, in their order."""
    if not by:
        yield (), table
        return
    places: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*[table.column(n).to_pylist() for n in by])):
        places.setdefault(key, []).append(i)
    for key, own in places.items():
        yield key, table.take(pa.array(own))


def _arrow_types(schema: T.StructType) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return {f.name: to_arrow_type(f.dataType) for f in schema.fields}


def collate(
    df: DataFrame,
    collator: Callable[[pa.Table], pa.Table],
    schema: T.StructType | str,
    batch: str = "batch_id",
    order: Sequence[str] = (),
) -> DataFrame:
    """Call ``collator`` with the rows of each batch, in ``order``; its tables are the result.

    A batch is held in memory as a whole, as it is in training. Rows without a batch are one batch. The
    collator may give any number of rows, with the columns of ``schema``.
    """
    placed = df.repartitionByRange(batch).sortWithinPartitions(batch, *order)
    names = T.StructType.fromDDL(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames()
    at = df.columns.index(batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def called() -> Iterator[pa.RecordBatch]:
            out = collator(pa.Table.from_batches(waiting)).select(names)
            yield from out.combine_chunks().to_batches()

        last = None
        for part in batches:
            numbers = part.column(at).to_pylist()
            start = 0
            for i, number in enumerate(numbers):
                if waiting and i == start and number != last:
                    yield from called()
                    waiting = []
                if i + 1 == len(numbers) or numbers[i + 1] != number:
                    waiting.append(part.slice(start, i + 1 - start))
                    last, start = number, i + 1
        if waiting:
            yield from called()

    return placed.mapInArrow(run, schema)
