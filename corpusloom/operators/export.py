"""Batches as files in the order of training, with a manifest from which reading resumes at any batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.batching import assign_batches

MANIFEST = "file long, first_batch long, last_batch long, rows long"


def export_batches(
    ranked: DataFrame,
    path: str,
    size: int,
    batches_per_file: int = 1_000,
    drop_last: bool = False,
    rank: str = "rank",
    base: DataFrame | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """Write rows in the order of ``rank``, whole batches to a file, and the manifest; returns the manifest.

    A file holds ``batches_per_file`` batches, the last one what is left, and is written by one task. Data
    come first and the manifest last: a folder without one is not finished. The manifest has a row per
    file: its number, first and last batch, and rows.
    """
    batched = assign_batches(ranked, size, drop_last, rank, base)
    placed = batched.withColumn("file", F.floor(F.col("batch_id") / batches_per_file))
    written = placed.repartitionByRange("file").sortWithinPartitions("file", rank)
    written.write.mode(mode).partitionBy("file").parquet(f"{path}/data")
    spark = ranked.sparkSession
    manifest = (
        spark.read.schema(placed.schema).parquet(f"{path}/data")
        .groupBy("file")
        .agg(F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"), F.count("*").alias("rows"))
    )
    # one row per file
    manifest.write.mode(mode).parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_batches(
    spark: SparkSession, path: str, from_batch: int = 0, to_batch: int | None = None
) -> DataFrame:
    """The rows of the batches from ``from_batch`` on, up to ``to_batch`` if given, that one not included.

    Only the files that hold them are read: files are folders, which the scan leaves out by their number,
    and the manifest tells the numbers of the first and the last.
    """
    manifest = read_manifest(spark, path)
    wanted = manifest.where(F.col("last_batch") >= from_batch)
    here = F.col("batch_id") >= from_batch
    if to_batch is not None:
        wanted = wanted.where(F.col("first_batch") < to_batch)
        here = here & (F.col("batch_id") < to_batch)
    files = wanted.agg(F.min("file").alias("a"), F.max("file").alias("b")).first()
    rows = spark.read.parquet(f"{path}/data")
    if files["a"] is None:
        return rows.where(F.lit(False)).drop("file")
    return rows.where(F.col("file").between(files["a"], files["b"]) & here).drop("file")
