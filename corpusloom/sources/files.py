"""Which files there are, and streams onto them from inside tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a path or glob pattern matches."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return [] if found is None else [status.getPath().toString() for status in found]


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The given paths and glob patterns that match something, in the given order."""
    return [path for path in paths if matching(spark, path)]


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as tasks open it, or None in a store that only Hadoop's file systems reach."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = system.makeQualified(place).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def packed_endings(spark: SparkSession) -> tuple[str, ...]:
    """Ends of the names of files that Spark's readers unpack."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    kinds = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return tuple(hadoop.util.ReflectionUtils.newInstance(kind, conf).getDefaultExtension() for kind in kinds)


def files_below(top: str) -> Iterator[tuple[str, int]]:
    """Path and bytes of the files below a mounted folder that Spark's readers take: not empty, not hidden."""
    if not os.path.isdir(top):
        size = os.path.getsize(top)
        if size and not _hidden(os.path.basename(top)):
            yield top, size
        return
    folders = [top]
    while folders:
        with os.scandir(folders.pop()) as entries:
            for entry in entries:
                if entry.is_dir():
                    # Spark looks into folders of these two names
                    if not _hidden(entry.name) or entry.name.startswith(("_metadata", "_common_metadata")):
                        folders.append(entry.path)
                elif not _hidden(entry.name) and entry.is_file() and (size := entry.stat().st_size):
                    yield entry.path, size


def _hidden(name: str) -> bool:
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


def below(spark: SparkSession, path: str, file: Column) -> Column:
    """A file's path below a given path, or below the last folder before the first wildcard of a pattern."""
    fixed = path
    for mark in "*?[{":
        if mark in fixed:
            fixed = fixed[: fixed.index(mark)].rpartition("/")[0]
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(fixed)
    root = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place)
    # Hadoop writes file:/ or file:/// for one and the same, and both encode odd characters
    whole = F.regexp_replace(file, "^([a-z0-9]+):/+", "$1:/")
    start = re.sub("^([a-z0-9]+):/+", r"\1:/", root.toUri().toString())
    return F.when(F.startswith(whole, F.lit(start)), F.substr(whole, F.lit(len(start) + 2))).otherwise(whole)


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, length)`` of the matching files, spread over tasks; no content is read."""
    files = existing(spark, paths)
    if not files:
        return spark.createDataFrame([], "path string, length bigint")
    listed = spark.read.format("binaryFile").load(files).select("path", "length")
    return listed.repartition(F.col("path"))


def open_stream(path: str):
    """A forward-only stream onto a file of any storage the Arrow file systems know."""
    from urllib.parse import unquote

    from pyarrow import fs

    if path.startswith("file:"):
        local = unquote(path[len("file:") :])
        return open("/" + local.lstrip("/"), "rb")
    if ":" not in path.split("/", 1)[0]:
        return open(path, "rb")
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner)
