"""Exact duplicates by distributed radix partitioning on the texts' own bytes.

Documents are split by their next bytes, most significant first. A group of one document is settled; in
a group whose members have no byte left all texts are equal; every other group is split again by the
following bytes. No digest takes part. The bytes of a step grow fourfold, so that a text of ``n`` bytes
takes about ``log4(n / 64)`` steps, and only documents that still share all their bytes so far are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import ROW, with_rows
from corpusloom.session import discard, materialize, release

WHITE_SPACE = " \t\n\x0b\f\r"  # fixed value: the characters that do not count


def squeezed(text: str | Column) -> Column:
    """The text without white space; null counts as empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(col, F.lit("")), WHITE_SPACE, "")


def _written(docs: DataFrame, key: str, text: str, columns: Sequence[str], name: str) -> DataFrame:
    points = F.char_length(F.coalesce(F.col(text), F.lit("")))
    return with_rows(
        docs.select(
            F.col(key).alias("__id"), points.alias("__points"), F.col(text).alias("__text"), *columns
        ),
        name,
    )


def _decided(base: DataFrame, first_bytes: int, growth: int) -> DataFrame:
    """Of rows that are not alone: (row, ``__keep`` and ``__stays``, key and row of the one that stays, size)."""
    state = base.select(
        ROW, F.lit(0).cast("long").alias("__group"), squeezed("__text").cast("binary").alias("__rest")
    )
    width, settled, steps = first_bytes, [], []
    while True:
        digit = F.substring("__rest", 1, width)
        placed = state.withColumn("__digit", digit)
        shared = materialize(
            placed.groupBy("__group", "__digit")
            .agg(F.count("*").alias("__n"), F.min(ROW).alias("__next"))
            .where(F.col("__n") > 1)
            .select("__group", "__digit", "__next"),
            "radix-groups",
        )
        steps.append(shared)
        if shared.isEmpty():
            break
        # read back from the written table, so that a group with a third of all rows can be split, and
        # merged whatever the size: a small table of shared digits must not hide what a large one costs
        state = materialize(
            placed.join(shared.hint("merge"), ["__group", "__digit"]).select(
                ROW,
                F.col("__next").alias("__group"),
                (F.octet_length("__digit") < width).alias("__ended"),
                F.expr(f"substring(__rest, {width + 1})").alias("__rest"),
            ),
            "radix-state",
        )
        steps.append(state)
        del placed
        release(base.sparkSession)
        settled.append(state.where("__ended").select(ROW, "__group"))
        state = state.where(~F.col("__ended")).drop("__ended")
        width *= growth
    members = base.select(ROW, F.col(ROW).alias("__group")).where(F.lit(False))
    for more in settled:
        members = members.unionByName(more)
    members = materialize(members.join(base.select(ROW, "__id", "__points"), ROW), "radix-members")
    # the bytes that were still shared are read no more
    for step in steps:
        discard(step)
    order = F.struct(
        (-F.col("__points")).alias("a"),
        F.col("__id").isNull().alias("b"),
        F.col("__id").alias("c"),
        F.col(ROW).alias("d"),
    )
    keepers = materialize(
        members.groupBy("__group").agg(F.min(order).alias("__first"), F.count("*").alias("__size")),
        "radix-keepers",
    )
    return members.join(keepers, "__group").select(
        ROW, F.col("__first.c").alias("__keep"), F.col("__first.d").alias("__stays"), "__size"
    )


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    first_bytes: int = 64,
    growth: int = 4,
) -> DataFrame:
    """One row per input row: the key, ``keep_id``, ``group_size``, ``kept`` and the carried columns.

    Texts are equal when they agree without white space. Of equal ones the row with the most code points
    stays, then the smallest key (null last), then the first row. Null texts are empty texts, and equal
    each other. Repeated rows are rows of their own: one stays. An empty table gives an empty table.
    """
    carry = list(carry)
    base = _written(docs, key, text, carry, "radix-base")
    return (
        base.drop("__points", "__text")
        .join(_decided(base, first_bytes, growth), ROW, "left")
        .select(
            F.col("__id").alias(key),
            F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep")).alias("keep_id"),
            F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("__stays") == F.col(ROW), F.lit(True)).alias("kept"),
            *carry,
        )
    )


def drop_exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", first_bytes: int = 64, growth: int = 4
) -> DataFrame:
    """The rows that stay, with all their columns."""
    rest = [c for c in docs.columns if c not in (key, text)]
    base = _written(docs, key, text, rest, "radix-docs")
    decided = _decided(base, first_bytes, growth)
    dropped = materialize(decided.where(F.col("__stays") != F.col(ROW)).select(ROW), "radix-dropped")
    discard(decided)
    release(base.sparkSession)
    kept = base.join(dropped, ROW, "left_anti")
    named = {key: "__id", text: "__text"}
    return kept.select(*[F.col(named.get(c, c)).alias(c) for c in docs.columns])
