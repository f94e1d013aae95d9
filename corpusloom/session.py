"""Session helper and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table, in rows and bytes, that is ever broadcast on the strength of a count.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20
SPREAD_BYTES = 1 << 30  # largest scan that is dealt out anew for its work


def build_session(
    app: str = "corpusloom", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the settings the operators assume; master is left to the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only a session whose driver is its one executor may leave it unset: it gets a local folder, removed
    at exit. Any other session raises, since executors would write to disks of their own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        # "local", "local[8]" and the like; "local-cluster[...]" has executors of its own
        if context.master.split("[")[0] != "local":
            raise ValueError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
        own = tempfile.mkdtemp(prefix="corpusloom-")
        context.setCheckpointDir(own)
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return context.getCheckpointDir()


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder of this application when Python ends, through Hadoop's file systems.

    Once the session is stopped only a mounted folder can be deleted; another store keeps it.
    """
    context = spark.sparkContext

    def remove() -> None:
        if context._jsc is None:
            mounted = path.removeprefix("file:")
            if "://" not in mounted:
                shutil.rmtree(mounted, ignore_errors=True)
            return
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)

    atexit.register(remove)


_ROOTS: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's own part of it.

    The part is removed when the application ends: results are lazy, so that a written table may be
    read until then.
    """
    root = f"{shared_dir(spark).rstrip('/')}/corpusloom-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        _remove_at_exit(spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(written: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing reads any more; without it tables stay to the end."""
    spark = written.sparkSession
    for folder in {path.rpartition("/")[0] for path in written.inputFiles()}:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose DataFrames are gone.

    Its cleaner follows the driver's garbage collection, which a step of long tasks and small plans may
    not see for many minutes; between the steps of an iterative operator, the disk waits for it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Materialise a table of per-group facts on the driver and broadcast it, if it is small.

    Rows and bytes are counted where they are; only a table within both bounds travels. A larger one is
    returned as it is, without a hint, so that the join shuffles and AQE splits hot keys.
    """
    first = df.limit(max_rows + 1).persist()
    try:
        size = F.sum(F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0)))
        rows, held = first.agg(F.count("*"), size).first()
        if rows > max_rows or (held or 0) > max_bytes:
            return df
        return F.broadcast(df.sparkSession.createDataFrame(first.collect(), df.schema))
    finally:
        first.unpersist()


def spread(scan: DataFrame, max_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Spread a scan of few, small files over all cores, for work that costs more than its bytes.

    A scan of more than ``max_bytes``, or with a partition for each core, passes as it is: moving its text
    would cost more than idle cores.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    plan = scan._jdf.queryExecution()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) > max_bytes:
        return scan
    if plan.toRdd().getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)
