import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ordering
from corpusloom.operators.ordering import head_n, running_aggregates, shuffle_rank
from corpusloom.operators.sampling import balanced_sample, ratio_split, resplit


def _shuffled(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.fixture(scope="module")
def rows(spark):
    """Two thirds of the rows in one class."""
    return spark.range(3000).withColumn("label", (F.col("id") % 3 == 0).cast("int"))


@pytest.mark.parametrize("partitions", [1, 17])
def test_rank_is_the_global_order(rows, partitions):
    ranked = shuffle_rank(rows.repartition(partitions), ["id"], seed=7).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 3001))
    assert [r["id"] for r in ranked] == _shuffled(range(3000), 7)


@pytest.mark.parametrize("n", [0, 1, 500, 5000])
def test_balanced_sample(rows, n):
    kept = balanced_sample(rows, "label", n, ["id"]).collect()
    for label in (0, 1):
        members = _shuffled(i for i in range(3000) if (i % 3 == 0) == bool(label))
        assert {r["id"] for r in kept if r["label"] == label} == set(members[:n])


@pytest.mark.parametrize("total", [0, 1, 3, 40, 999])
def test_ratio_split_partitions_the_rows(spark, total):
    parts = ratio_split(spark.range(total), ["id"]).collect()
    order = _shuffled(range(total))
    first, second = int(0.95 * total), int(0.975 * total)
    expected = {k: "train" for k in order[:first]}
    expected |= {k: "validation" for k in order[first:second]}
    expected |= {k: "test" for k in order[second:]}
    assert {r["id"]: r["split"] for r in parts} == expected


def test_cuts_differ_between_the_two_splits(spark):
    def sizes(df):
        return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}

    rows = spark.range(49_999)
    assert sizes(ratio_split(rows, ["id"])) == {"train": 47_499, "validation": 1_250, "test": 1_250}
    assert sizes(resplit(rows, ["id"])) == {"train": 47_499, "validation": 1_249, "test": 1_251}
    # int((1 - 0.9) / 2 * 20) is 0 in double arithmetic
    assert sizes(resplit(spark.range(20), ["id"], train_ratio=0.9)) == {"train": 18, "test": 2}


def test_head_n(spark):
    rows = spark.range(100).repartition(7)
    assert sorted(r["id"] for r in head_n(rows, 5, ["id"]).collect()) == [0, 1, 2, 3, 4]
    assert head_n(rows, None, ["id"]).count() == 100
    assert head_n(rows, 0, ["id"]).count() == 0


@pytest.mark.parametrize("width", [1, 7, 1000])
@pytest.mark.parametrize("current", [True, False])
def test_running_aggregates(spark, width, current):
    values = [(i, (i * 37) % 11 if i % 5 else None) for i in range(60)]
    rows = spark.createDataFrame(values, "step bigint, v bigint")
    wanted = {k: (k, F.col("v")) for k in ("sum", "count", "min", "max")}
    got = running_aggregates(rows, "step", wanted, include_current=current, width=width)
    for row in got.collect():
        seen = [v for s, v in values if s < row["step"] + current and v is not None]
        assert row["count"] == len(seen)
        assert row["sum"] == (sum(seen) if seen else None)
        assert (row["min"], row["max"]) == ((min(seen), max(seen)) if seen else (None, None))


def test_head_n_narrows_range_after_range(spark, monkeypatch):
    """No task sorts more than a stated number of keys."""
    monkeypatch.setattr(ordering, "SORTED_KEYS", 50)
    rows = spark.range(20_000).select((F.col("id") * 7_919 % 20_011).alias("id"))
    ids = sorted(r["id"] for r in rows.collect())
    for n in (1, 777, 19_999):
        assert sorted(r["id"] for r in head_n(rows, n, ["id"]).collect()) == ids[:n]
    copies = spark.range(300).select(F.when(F.col("id") < 250, 5).otherwise(F.col("id")).alias("id"))
    assert head_n(copies, 100, ["id"]).count() == 250  # copies of a key are not told apart


def test_head_n_beyond_one_range(spark):
    rows = spark.range(5_000).repartition(3)
    for n in (1, 2_499, 4_999, 5_000, 9_000):
        assert head_n(rows, n, ["id"]).count() == min(n, 5_000)


def test_sparse_and_repeated_steps(spark):
    rows = spark.createDataFrame([(i * 10**9, 1) for i in range(300)] + [(7, 1)] * 50, "step bigint, v int")
    got = running_aggregates(rows, "step", {"n": ("count", F.col("v"))}, width=20).collect()
    assert sorted(r["n"] for r in got) == list(range(1, 351))


def test_equal_rows_are_all_kept(spark):
    rows = spark.createDataFrame([(1, 2)] * 5, "step bigint, v int")
    got = running_aggregates(rows, "step", {"s": ("sum", F.col("v"))}, width=2).collect()
    assert sorted(r["s"] for r in got) == [2, 4, 6, 8, 10]


def test_narrow_ranges_are_only_so_many(spark, monkeypatch):
    """A range is a task and a file; rows, not the width asked for, set their number in the end."""
    monkeypatch.setattr(ordering, "RUNNING_RANGES", 4)
    rows = spark.range(600).select(F.col("id").alias("step"), (F.col("id") % 7).alias("v"))
    made = []
    keep = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df, name: made.append(keep(df, name)) or made[-1])
    got = running_aggregates(rows, "step", {"s": ("sum", F.col("v"))}, width=2).collect()
    assert made[0].select("_chunk").distinct().count() <= 4
    assert all(r["s"] == sum(i % 7 for i in range(r["step"] + 1)) for r in got) and len(got) == 600
