"""Shapes of physical plans, the classifier, and Column functions on a stream."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF
from corpusloom.functions import arrays, text
from corpusloom.operators import classifier
from corpusloom.operators.bpe import BpeTokenizer
from corpusloom.operators.encode import decode_column, encode
from corpusloom.operators.rouge import rouge_scores
from corpusloom.operators.sampling import balanced_sample, ratio_split
from corpusloom.operators.tables import filter_length
from corpusloom.operators.wer import word_errors
from corpusloom.session import broadcast_if_small


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_splits_only_project(documents):
    plan = _plan(ratio_split(documents, ["doc_id"]))
    assert "Exchange" not in plan and "Window" not in plan


def test_samples_only_filter(documents):
    plan = _plan(balanced_sample(documents, "lang", 5, ["doc_id"]))
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1


def test_a_large_table_is_not_broadcast(spark):
    table = spark.range(10).withColumnRenamed("id", "k")
    assert "ResolvedHint" not in broadcast_if_small(table, 3)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in broadcast_if_small(table, 10)._jdf.queryExecution().analyzed().toString()


def test_samples_with_many_classes(spark, monkeypatch):
    """More classes than may be broadcast: the join shuffles and the sample is the same."""
    from corpusloom.operators import ordering, sampling

    rows = spark.range(200).withColumn("label", F.col("id") % 20)
    expected = sorted(r["id"] for r in balanced_sample(rows, "label", 3, ["id"]).collect())
    for module in (ordering, sampling):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df: broadcast_if_small(df, 5))
    assert sorted(r["id"] for r in balanced_sample(rows, "label", 3, ["id"]).collect()) == expected
    assert len(expected) == 60


def test_row_scores_do_not_shuffle(spark, documents):
    pair = documents.select("doc_id", "text", F.reverse("text").alias("other"))
    tokenizer = BpeTokenizer(("[PAD]", "[UNK]", "[CLS]", "[SEP]", "a", "b", "ab"), ((4, 5, 6),))
    encoded = encode(documents, "text", tokenizer).withColumn("t", decode_column("input_ids", tokenizer))
    for df in (rouge_scores(pair, "text", "other"), word_errors(pair, "text", "other"), encoded):
        assert "Exchange" not in _plan(df)


def test_scans_read_only_what_they_need(spark):
    plan = _plan(entry.input_length_filter(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in plan
    assert "GreaterThan(n_chars,0)" in plan and "LessThan(n_chars,1200)" in plan


def test_classifier(spark):
    rows = [(i, "good fine nice" if i % 2 else "bad poor sad", i % 2, "train" if i < 30 else "test") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, text string, label int, split string")
    model = classifier.fit_text_classifier(df.where("split = 'train'"), features=64)
    report = {r["split"]: r for r in classifier.classification_report(classifier.score(model, df)).collect()}
    assert {s: (r["accuracy"], r["samples"]) for s, r in report.items()} == {"train": (1.0, 30), "test": (1.0, 10)}
    assert 0 < report["test"]["loss"] < 0.2
    assert classifier.parameter_count(model) == 2 * 64 + 2


def test_column_functions_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("Hello, World!\nx\n")
    stream = spark.readStream.text(str(tmp_path / "in"))
    ids = F.transform(text.pretokenize("value"), lambda t: F.length(t))
    out = filter_length(stream, F.length("value"), 1, None).select(
        text.clean_transcript("value").alias("clean"), arrays.pad_ids(ids, 6, 0).alias("ids")
    )
    query = (
        out.writeStream.format("memory")
        .queryName("cleaned")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(60)
    assert [tuple(r) for r in spark.table("cleaned").collect()] == [("hello world", [5, 1, 5, 1, 0, 0])]
