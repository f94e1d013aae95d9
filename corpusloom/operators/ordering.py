"""Deterministic orders at scale: seeded shuffle ranks, n-th row thresholds, running aggregates.

A row's place in a seeded shuffle is the order of ``md5(seed:key)`` and then of the key itself, which
depends neither on partitioning nor on retries. No operator here sorts a whole table in one task: ranks
come from hash buckets and their offsets, and where only a cut is needed (a sample, a split) the row at
the cut is searched among keys alone and the table itself is only filtered, without a shuffle.

Keys must be unique: they are the identity of a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small, materialize

# Hash prefixes of three hex digits give 4,096 buckets, of four 65,536: also the size of the offset table.
# A rank sorts whole rows in every bucket, a cut only keys in the few buckets it needs.
RANK_DIGITS = 4
BUCKET_DIGITS = 3
SORTED_KEYS = 1 << 20  # keys of one range that a task sorts, at most
MOST_RANGES = 4_096
RANGE_ROWS = 65_536  # rows of a range of a running aggregate, unless given
RUNNING_RANGES = 1_024  # narrower ranges than that are not made beyond so many


def shuffle_hash(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def shuffle_place(keys: Sequence[str], seed: int) -> Column:
    """The comparable value that orders a seeded shuffle."""
    return F.struct(shuffle_hash(keys, seed).alias("h"), *[F.col(k) for k in keys])


def _with_cumulative(buckets: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows before each bucket. One row per group and bucket: at most 16 ** digits rows per group."""
    before = (
        Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    return buckets.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def shuffle_rank(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 42,
    rank: str = "rank",
    digits: int = RANK_DIGITS,
) -> DataFrame:
    """Add the 1-based rank of each row in the seeded shuffle."""
    hashed = df.withColumn("_h", shuffle_hash(keys, seed)).withColumn(
        "_bucket", F.substring("_h", 1, digits)
    )
    buckets = (
        df.select(F.substring(shuffle_hash(keys, seed), 1, digits).alias("_bucket"))
        .groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
    )
    # 16 ** digits rows at most, whatever the table's size
    offsets = F.broadcast(_with_cumulative(buckets, []).select("_bucket", "_before"))
    inside = Window.partitionBy("_bucket").orderBy("_h", *keys)
    return (
        hashed.withColumn("_row", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .withColumn(rank, (F.col("_row") + F.col("_before")).cast("bigint"))
        .drop("_h", "_bucket", "_row", "_before")
    )


def rows_at(
    df: DataFrame,
    keys: Sequence[str],
    seed: int,
    wanted: DataFrame,
    group: Sequence[str] = (),
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """The shuffle place of the rows at the wanted positions.

    ``wanted`` takes the table of totals per group (``group``, ``_total``) to rows
    (``group``, ``_cut``, ``_position``). Returned are (``group``, ``_cut``, ``_place``); a position
    outside 1..total gives no row. Only keys are read, and only the buckets that hold a cut are sorted.
    """
    group = list(group)
    placed = df.select(
        *group, shuffle_place(keys, seed).alias("_place")
    ).withColumn("_bucket", F.substring("_place.h", 1, digits))
    buckets = _with_cumulative(
        placed.groupBy(*group, "_bucket").agg(F.count("*").alias("_n")), group
    )
    totals = buckets.groupBy(*group).agg(F.sum("_n").alias("_total"))
    cuts = totals.transform(wanted)
    if group:
        hit = buckets.join(cuts, group)
    else:
        # the few cuts travel inside one array, so that no join is needed
        listed = cuts.agg(F.collect_list(F.struct("_cut", "_position")))
        hit = buckets.select("*", F.explode(listed.scalar()).alias("_c")).select(
            "_bucket", "_n", "_before", "_c._cut", "_c._position"
        )
    hit = hit.where(
        (F.col("_position") > F.col("_before"))
        & (F.col("_position") <= F.col("_before") + F.col("_n"))
    ).select(*group, "_bucket", "_cut", (F.col("_position") - F.col("_before")).alias("_local"))
    inside = Window.partitionBy(*group, "_bucket", "_cut").orderBy("_place")
    return (
        placed.join(broadcast_if_small(hit), [*group, "_bucket"])
        .withColumn("_row", F.row_number().over(inside))
        .where(F.col("_row") == F.col("_local"))
        .select(*group, "_cut", "_place")
    )


def head_n(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the given unique order; ``None`` keeps all.

    The order columns alone are searched for the ``n``-th row; the rows themselves are only filtered. The
    search counts ranges of the order and goes on inside the range that holds the row, until that has
    ``SORTED_KEYS`` keys or fewer, which one task sorts: each round leaves about a partition's share of the
    keys, so that a few rounds do for any table.
    """
    if n is None:
        return df
    if n < 1:
        return df.where(F.lit(False))
    place = F.struct(*[F.col(c) for c in order])
    keys, before, held = df.select(place.alias("_place")), 0, None
    while True:
        # as many ranges as the shuffle has, then as many as the keys need
        parts = [] if held is None else [min(MOST_RANGES, max(2, -(-2 * held // SORTED_KEYS)))]
        placed = materialize(
            keys.repartitionByRange(*parts, F.col("_place")).withColumn("_part", F.spark_partition_id()), "places"
        )
        # a row for each range
        counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        cut = (
            counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + before)
            .where((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n))
            .first()
        )
        if cut is None:
            return df
        before = cut["_before"]
        keys = placed.where(F.col("_part") == cut["_part"]).select("_place")
        # unique keys split again and again; where copies of one key fill a range, it is sorted as it is
        if cut["_n"] <= SORTED_KEYS or cut["_n"] == held:
            break
        held = cut["_n"]
    last = (
        keys.withColumn("_row", F.row_number().over(Window.orderBy("_place")))
        .where(F.col("_row") == n - before)
        .agg(F.max("_place").alias("_last"))
    )
    return df.where(place <= last.scalar())


def running_aggregates(
    df: DataFrame,
    order: str,
    aggregates: dict[str, tuple[str, Column]],
    group: Sequence[str] = (),
    include_current: bool = True,
    width: int = RANGE_ROWS,
) -> DataFrame:
    """Running ``sum``, ``count``, ``min`` or ``max`` along an order column.

    ``aggregates`` maps a new column to (function name, value). Rows are dealt into ranges of (group,
    order), each of about ``width`` rows whatever the values present, or of up to ``RANGE_ROWS`` where that
    would make more than ``RUNNING_RANGES``: each range is a task and a file; totals of ranges are accumulated
    first and added to the running values inside each range, so that a group of any size, and any number
    of rows with one order value, is spread over tasks. Rows with a null group are a group, rows with a
    null order come last in theirs, and rows of equal order come in the order of a hash of the row.
    """
    functions = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    merge = {
        "sum": lambda a, b: F.coalesce(a + b, a, b),
        "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        "min": F.least,
        "max": F.greatest,
    }
    group = list(group)
    rows = df.count()
    ranges = max(1, min(-(-rows // width), max(RUNNING_RANGES, -(-rows // RANGE_ROWS))))
    valued = df.withColumns({f"_v_{name}": value for name, (_, value) in aggregates.items()})
    tie = F.xxhash64(*[c for c, kind in valued.dtypes if "map<" not in kind and kind != "variant"])
    along = [F.col(order).asc_nulls_last(), F.col("_tie")]
    placed = materialize(
        valued.withColumn("_tie", tie)
        .repartitionByRange(ranges, *group, *along)
        .withColumn("_chunk", F.spark_partition_id()),
        "running",
    )
    totals = placed.groupBy(*group, "_chunk").agg(
        *[functions[f](f"_v_{name}").alias(f"_t_{name}") for name, (f, _) in aggregates.items()]
    )
    # at most one row for each range and group
    earlier = (
        Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    offsets = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_chunk").alias("_c"),
        *[
            carry[f](f"_t_{name}").over(earlier).alias(f"_o_{name}")
            for name, (f, _) in aggregates.items()
        ],
    )
    inside = (
        Window.partitionBy(*group, "_chunk")
        .orderBy(*along)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    same = F.col("_chunk") == F.col("_c")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = placed.join(offsets, same)
    new = {}
    for name, (f, _) in aggregates.items():
        local = functions[f](f"_v_{name}").over(inside)
        new[name] = merge[f](F.col(f"_o_{name}"), local)
    return joined.withColumns(new).select(*df.columns, *new)
