"""Training-log analytics: sampled steps, running means, best checkpoints, history series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import running_aggregates


def every_n(df: DataFrame, step: str, n: int) -> DataFrame:
    """The steps at which an evaluation would run."""
    return df.where(F.col(step) % n == 0)


def _number(col: str) -> Column:
    """A metric that is not a number is no metric: NaN counts as null."""
    return F.when(~F.isnan(F.col(col).cast("double")), F.col(col))


def running_epoch_mean(
    df: DataFrame,
    epoch: str,
    step: str,
    loss: str,
    name: str = "running_mean",
    width: int = 65_536,
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean loss of an epoch so far, at each step; ``by`` names the columns of a run."""
    value = F.col(loss).cast("double")
    return (
        running_aggregates(
            df, step, {"_sum": ("sum", value), "_n": ("count", value)}, [*by, epoch], width=width
        )
        .withColumn(name, F.col("_sum") / F.nullif(F.col("_n"), F.lit(0)))
        .drop("_sum", "_n")
    )


def epoch_mean(df: DataFrame, epoch: str, loss: str, by: Sequence[str] = ()) -> DataFrame:
    grouped = df.groupBy(*by, epoch)
    return grouped.agg(F.avg(loss).alias("mean_loss"), F.count("*").alias("steps"))


def improvements(
    df: DataFrame,
    step: str,
    metric: str,
    greater_is_better: bool,
    start: float | None = None,
    width: int = 65_536,
    by: Sequence[str] = (),
) -> DataFrame:
    """The steps at which a checkpoint would be saved: a strict improvement on all steps before.

    The start value is 0 for a maximum and infinity for a minimum, unless given. NaN never improves.
    """
    if start is None:
        start = 0.0 if greater_is_better else float("inf")
    kind = "max" if greater_is_better else "min"
    best = running_aggregates(
        df, step, {"_best": (kind, _number(metric))}, by, include_current=False, width=width
    )
    bound = F.coalesce(
        (F.greatest if greater_is_better else F.least)(F.col("_best"), F.lit(start)), F.lit(start)
    )
    value = _number(metric)
    return best.where(value > bound if greater_is_better else value < bound).drop("_best")


def best_checkpoint(
    df: DataFrame, step: str, metric: str, greater_is_better: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Step and value of the best metric, of each run; the first of equal ones. NaN is no value."""
    rows = df.withColumn("_m", _number(metric)).where(F.col("_m").isNotNull()).groupBy(*by)
    if greater_is_better:
        place = F.struct(F.col("_m"), -F.col(step))
        return rows.agg(F.max_by(step, place).alias("step"), F.max("_m").alias("value"))
    place = F.struct(F.col("_m"), F.col(step))
    return rows.agg(F.min_by(step, place).alias("step"), F.min("_m").alias("value"))


def log_series(
    df: DataFrame,
    step: str,
    keys: Sequence[str] = ("loss", "eval_loss", "eval_wer"),
    by: Sequence[str] = (),
) -> DataFrame:
    """``(series, step, value)`` for each key a log record has, after the columns of the run."""
    values = [F.col(k).cast("double").alias(k) for k in keys]
    return (
        df.select(*by, F.col(step).alias("step"), *values)
        .unpivot([*by, "step"], list(keys), "series", "value")
        .where(F.col("value").isNotNull())
        .select(*by, "series", "step", "value")
    )


def history(
    df: DataFrame, step: str, series: Sequence[str], points: int = 10_000, by: Sequence[str] = ()
) -> DataFrame:
    """History arrays in step order, of ``points`` consecutive steps to a part, for each run.

    A history of up to ``points`` steps that count from 0 is the single part 0. Longer ones continue in
    further parts, so that no row or task has to hold a history of unknown length; the steps of a run must
    be its own.
    """
    part = F.floor(F.col(step) / points)
    ordered = F.array_sort(F.collect_list(F.struct(step, *series)))
    grouped = df.groupBy(*by, part.alias("part")).agg(ordered.alias("_points"))
    return grouped.select(
        *by,
        "part",
        F.col(f"_points.{step}").alias("steps"),
        *[F.col(f"_points.{s}").alias(s) for s in series],
    )


def elapsed(start: Column | str, end: Column | str, unit: str = "seconds") -> Column:
    """Time between two timestamps as a fraction of a unit."""
    # fixed values: seconds to a unit
    seconds = {"seconds": 1.0, "minutes": 60.0, "hours": 3600.0}[unit]
    a = F.col(start) if isinstance(start, str) else start
    b = F.col(end) if isinstance(end, str) else end
    micros = F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))
    return micros / F.lit(1_000_000.0 * seconds)
