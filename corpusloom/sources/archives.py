"""Members of many compressed archives, one archive to a task at a time."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusloom.sources.files import list_files, open_stream

MEMBERS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)


def read_tar_members(
    spark: SparkSession, paths: Sequence[str], on_error: str = "skip"
) -> DataFrame:
    """``(archive, member, content, error)`` of every file in the archives.

    Archives that do not exist are left out. With ``skip`` an unreadable archive gives the members
    before the fault and one row that holds the error; with ``fail`` the job ends. Archives are read as
    streams, so only one member is in memory at a time.
    """
    if on_error not in ("skip", "fail"):
        raise ValueError(on_error)

    def members(path: str) -> Iterator[tuple]:
        with open_stream(path) as raw, tarfile.open(fileobj=raw, mode="r|*") as archive:
            for entry in archive:
                if entry.isfile():
                    yield path, entry.name, archive.extractfile(entry).read(), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = MEMBERS.fieldNames()
        for batch in batches:
            for path in batch["path"]:
                try:
                    for row in members(path):
                        yield pd.DataFrame([row], columns=names)
                except Exception as fault:
                    if on_error == "fail":
                        raise
                    message = f"{type(fault).__name__}: {fault}"
                    yield pd.DataFrame([(path, None, None, message)], columns=names)

    return list_files(spark, paths).select("path").mapInPandas(run, MEMBERS)
