"""Labelled directories: one text file per row.

A file for each row makes files by the million. On a mounted folder, local or shared, the tasks list, read and
write them; the driver holds no file's name. Spark's own text source, which lists on the driver and plans a
task for every few files, reads and writes the other stores.
"""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import map_label
from corpusloom.sources.files import files_below, matching, mounted, packed_endings

TASK_FILES = 8_192  # files that a task reads, and
TASK_BYTES = 64 << 20  # their bytes, on average
BATCH_BYTES = 8 << 20  # text that leaves a worker at once


def _read_by_spark(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    files = spark.read.text(list(folders), wholetext=True, recursiveFileLookup=True)
    # paths come percent-encoded; a plus in a name is a plus
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return files.select(F.col("value").alias("text"), path.alias("path"))


def _read_by_tasks(spark: SparkSession, folders: Sequence[str]) -> DataFrame | None:
    """``(text, path)`` of the files below mounted folders, None if there are packed files among them."""
    listed = spark.sparkContext.parallelize(folders, len(folders)).flatMap(files_below)
    packed = packed_endings(spark)
    files, size, unpack = listed.aggregate(
        (0, 0, False),
        lambda sums, file: (sums[0] + 1, sums[1] + file[1], sums[2] or file[0].endswith(packed)),
        lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] or b[2]),
    )
    if unpack:
        return None
    most = max(spark.sparkContext.defaultParallelism, -(-files // TASK_FILES), -(-size // TASK_BYTES))
    # dealt out as an RDD, whose size Spark does not guess: a join would else broadcast texts for small paths
    dealt = listed.map(lambda file: (file[0],)).repartition(max(1, min(files, most)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths, held = [], [], 0
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    texts.append(file.read())
                paths.append(path)
                held += len(texts[-1])
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(paths)], ["text", "path"])
                    texts, paths, held = [], [], 0
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(paths)], ["text", "path"])

    rows = spark.createDataFrame(dealt, "path string").mapInArrow(read, "text binary, path string")
    return rows.select(F.col("text").cast("string"), F.concat(F.lit("file:"), "path").alias("path"))


def read_labeled_dirs(
    spark: SparkSession,
    root: str,
    labels: Mapping[str, int] | None = None,
    subsets: Sequence[str] = ("train", "test"),
) -> DataFrame:
    """``(text, label, subset, path)`` of every file in ``<root>/<subset>/<class>/``.

    Files are listed when this is called for their number, and again when the rows are read.
    """
    labels = labels or {"pos": 1, "neg": 0}  # fixed values: class folders and their codes
    folders = [f"{root.rstrip('/')}/{s}/{name}" for s in subsets for name in labels]
    found = [matching(spark, folder) for folder in folders]
    places = [mounted(spark, place) for some in found for place in some]
    files = None
    # Spark's reader names a folder that is missing
    if all(found) and None not in places:
        files = _read_by_tasks(spark, places)
    if files is None:
        files = _read_by_spark(spark, folders)
    steps = F.split("path", "/")
    return files.select(
        "text",
        map_label(F.element_at(steps, -2), labels).alias("label"),
        F.element_at(steps, -3).alias("subset"),
        "path",
    )


def write_labeled_dirs(rows: DataFrame, root: str, folders: Sequence[str], end: str = "\n") -> None:
    """Write the ``text`` of each row, and ``end``, to a file of its own in the row's ``folder`` below ``root``.

    The folders are all those of the rows; none may exist. A null text is an empty one.

    On a mounted folder a task that runs again writes the same files: a name is the task's number, the text's
    digest and which of the equal texts it is. A file appears when it is whole.
    """
    spark = rows.sparkSession
    top = mounted(spark, root)
    if top is None:
        for folder in folders:
            writer = rows.where(F.col("folder") == folder).select("text").write
            writer = writer.option("maxRecordsPerFile", 1).option("lineSep", end)
            # tasks move their own files into place; else the driver moves them all, one after another
            writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            writer.text(f"{root}/{folder}")
        return
    for folder in folders:
        os.makedirs(f"{top}/{folder}")
    tail = end.encode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        equal: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for folder, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                content = (text or b"") + tail
                digest = hashlib.md5(content).hexdigest()
                name = f"part-{task.partitionId():05d}-{digest}-{equal[folder, digest]}.txt"
                equal[folder, digest] += 1
                written = f"{top}/{folder}/.{task.taskAttemptId()}-{name}"
                with open(written, "wb") as file:
                    file.write(content)
                os.replace(written, f"{top}/{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([equal.total()], pa.int64())], ["files"])

    sent = rows.select("folder", F.col("text").cast("binary"))
    sent.mapInArrow(write, "files long").agg(F.sum("files")).first()
