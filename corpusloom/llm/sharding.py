"""Shards by weighted rendezvous hashing of stable record keys, in DataFrame functions only.

Each shard draws a number from the hash of the key and the shard's own name; the record goes to the
shard with the largest weighted draw. Nothing but the key, the shard and its weight enters a draw, so a
further shard takes records only into itself, and a record moves between old shards never.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import gapless, with_rows


def rendezvous(keys: Sequence[str], weights: Mapping[int, float]) -> Column:
    """The shard of a record: the largest of ``-weight / ln(u)``, with ``u`` drawn per key and shard.

    A null key is a key of its own: all records with it meet in one shard. Weights must be positive;
    equal draws go to the smaller shard number.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("give at least one shard, and positive weights")
    place = F.concat_ws(
        "\x1f", *[F.coalesce(F.hex(F.col(k).cast("string")), F.lit("null")) for k in keys]
    )
    draws = []
    for shard, weight in sorted(weights.items()):
        bits = F.shiftrightunsigned(F.xxhash64(place, F.lit(int(shard))), 11)
        u = (bits + F.lit(0.5)) / F.lit(float(2**53))
        draws.append(
            F.struct((F.lit(-float(weight)) / F.log(u)).alias("draw"), F.lit(-int(shard)).alias("less"))
        )
    best = draws[0] if len(draws) == 1 else F.greatest(*draws)
    return (-best["less"]).cast("int")


def assign_shards(
    docs: DataFrame, keys: Sequence[str], weights: Mapping[int, float], shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """Add the shard of each row and its slot there, gapless from 0.

    All columns stay. Repeated rows and equal keys share a shard and get slots of their own. An empty
    table gives an empty table. Slots are counted chunk by chunk, so a shard or key with a third of all
    rows is spread over tasks.
    """
    placed = with_rows(docs.withColumn(shard, rendezvous(keys, weights)), "shards")
    return gapless(placed, [shard], slot).drop("__row")


def write_shards(assigned: DataFrame, path: str, shard: str = "shard", format: str = "parquet") -> None:
    """Write one folder per shard, each in as many files as its tasks hold."""
    assigned.write.partitionBy(shard).format(format).save(path)
