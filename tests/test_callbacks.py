"""Python metrics and collators, exported batches, the CTC chain."""

import os
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import callbacks, export
from corpusloom.operators.ordering import shuffle_rank
from corpusloom.plans.speech import score_ctc


def _distinct():
    """Distinct values and the sum: a state that is no number."""

    def update(state, rows):
        values = rows.column("v").to_pylist()
        return state[0] | set(values), state[1] + sum(v or 0 for v in values)

    return callbacks.Metric(
        start=lambda: (frozenset(), 0),
        update=update,
        merge=lambda a, b: (a[0] | b[0], a[1] + b[1]),
        finish=lambda s: {"distinct": len(s[0]), "total": s[1], "some": sorted(x for x in s[0] if x is not None)[:2]},
        schema="distinct int, total long, some array<long>",
    )


@pytest.mark.parametrize("parts", [1, 7, 150])
def test_metric_of_a_table_and_of_groups(spark, parts, monkeypatch):
    monkeypatch.setattr(callbacks, "GROUPS", 3)
    monkeypatch.setattr(callbacks, "ROWS", 11)
    rows = [(None if i % 5 == 0 else f"g{i % 5}", None if i % 50 == 0 else i % 17) for i in range(1_000)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(parts)
    whole = callbacks.evaluate(df, _distinct(), ["v"]).collect()
    assert [tuple(r) for r in whole] == [(18, sum(v or 0 for _, v in rows), [0, 1])]
    got = {r["g"]: tuple(r)[1:] for r in callbacks.evaluate(df, _distinct(), ["v"], ["g"]).collect()}
    for group in {g for g, _ in rows}:
        own = [v for g, v in rows if g == group]
        assert got[group] == (len(set(own)), sum(v or 0 for v in own), sorted({v for v in own if v is not None})[:2])
    none = df.where("v > 99")
    assert [tuple(r) for r in callbacks.evaluate(none, _distinct(), ["v"]).collect()] == [(0, 0, [])]
    assert callbacks.evaluate(none, _distinct(), ["v"], ["g"]).count() == 0


def test_collator_gets_whole_batches_in_order(spark, monkeypatch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).select(
            F.when(F.col("id") < 480, F.floor(F.col("id") / 30)).alias("batch_id"), (500 - F.col("id")).alias("place"), "id"
        )

        def summary(rows: pa.Table) -> pa.Table:
            ids = rows.column("id").to_pylist()
            return pa.table({"n": [len(ids)], "first": [ids[0]], "sorted": [ids == sorted(ids, reverse=True)]})

        got = callbacks.collate(df.repartition(9), summary, "n long, first long, sorted boolean", order=["place"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert Counter(r["n"] for r in got) == {30: 16, 20: 1}
    assert all(r["sorted"] for r in got)
    assert {r["first"] for r in got} == {30 * i + 29 for i in range(16)} | {499}


def test_export_and_resume(spark, tmp_path):
    df = spark.range(1_003).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    ranked = shuffle_rank(df, ["doc_id"])
    manifest = export.export_batches(ranked, str(tmp_path / "out"), 10, batches_per_file=7).collect()
    held = sorted(map(tuple, manifest))
    assert [h[:3] for h in held[:2]] == [(0, 0, 6), (1, 7, 13)] and held[-1] == (14, 98, 100, 23)
    assert sum(h[3] for h in held) == 1_003
    # one file for each number, in the order of the ranks
    for number in (0, 14):
        files = [f for f in os.listdir(tmp_path / f"out/data/file={number}") if f.endswith(".parquet")]
        assert len(files) == 1
        ranks = [r["rank"] for r in spark.read.parquet(str(tmp_path / f"out/data/file={number}")).collect()]
        assert ranks == sorted(ranks)
    whole = export.read_batches(spark, str(tmp_path / "out"))
    assert sorted(whole.columns) == ["batch_id", "doc_id", "rank", "text"]
    rest = export.read_batches(spark, str(tmp_path / "out"), 38)
    assert {r["batch_id"] for r in rest.collect()} == set(range(38, 101))
    part = export.read_batches(spark, str(tmp_path / "out"), 20, 38)
    assert {r["batch_id"] for r in part.collect()} == set(range(20, 38))
    # files before the batch are not read
    assert all(int(f.split("file=")[1].split("/")[0]) >= 5 for f in _scanned(rest))
    assert export.read_batches(spark, str(tmp_path / "out"), 101).count() == 0


def _scanned(df):
    return {r["f"] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_ctc_chain(spark):
    letters = F.create_map(*[x for i, c in enumerate(" abc") for x in (F.lit(i + 1), F.lit(c))])
    rows = [
        ([2, 2, 0, 2, 1, 1, 3], [2, 2, 1, 3, -100, -100], "aa b", "aa b", 0, 2),
        ([2, 2, 2, 1, 3, 0, 3], [2, 2, 1, 3, -100, -100], "aa b", "a bb", 2, 2),
        ([], [-100], "", "", 0, 0),
        ([0, 0], [2], "a", "", 1, 1),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "frames array<int>, labels array<int>")
    got = score_ctc(df, "frames", "labels", 0, lambda x: letters[x]).collect()
    assert [(r["reference"], r["prediction"], r["edits"], r["ref_words"]) for r in got] == [r[2:] for r in rows]
