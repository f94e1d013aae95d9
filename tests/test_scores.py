import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import arrays
from corpusloom.functions.porter import stem_word
from corpusloom.operators import batching, metrics, traininglog
from corpusloom.operators.rouge import common_subsequence, rouge_report, rouge_scores
from corpusloom.operators.wer import wer, word_errors


def _edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.fixture(scope="module")
def pairs(spark):
    chance = random.Random(5)
    words = "the cat cats sat on mats running runs éa \U0001f600".split()

    def sentence():
        return "  ".join(chance.choices(words, k=chance.randint(0, 30)))

    rows = [(i, sentence(), sentence()) for i in range(60)]
    return rows, spark.createDataFrame(rows, "id int, r string, h string")


def test_word_edits(pairs):
    rows, df = pairs
    expected = {i: (_edit_distance(r.split(), h.split()), len(r.split())) for i, r, h in rows}
    got = word_errors(df, "r", "h").collect()
    assert {x["id"]: (x["edits"], x["ref_words"]) for x in got} == expected
    total = wer(df, "r", "h").first()
    assert total["wer"] == pytest.approx(
        100 * sum(e for e, _ in expected.values()) / sum(n for _, n in expected.values())
    )


def test_wer_of_equal_and_empty(spark, pairs):
    _, df = pairs
    assert wer(df.where("r <> ''"), "r", "r").first()["wer"] == 0
    empty = spark.createDataFrame([("", "a b")], "r string, h string")
    assert wer(empty, "r", "h").first()["wer"] is None


def test_single_line_breaks_join_words(spark):
    rows = spark.createDataFrame([("a\nb c", "a\nb  c"), ("a\n\nb", "a b")], "r string, h string")
    assert [r["edits"] for r in word_errors(rows, "r", "h").collect()] == [0, 0]


def test_many_distinct_words(spark):
    """Past the surrogate gap of the code points."""
    n = 56_000
    rows = spark.range(1).select(
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: i.cast("string")), " ").alias("r"),
        F.lit("55999 56000").alias("h"),
    )
    assert word_errors(rows, "r", "h").first()["edits"] == n - 2


STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "dies": "die", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "sized": "size", "hopping": "hop", "falling": "fall", "filing": "file",
    "happy": "happi", "enjoy": "enjoy", "relational": "relat", "conditional": "condit",
    "generalization": "gener", "triplicate": "triplic", "electrical": "electr",
    "adjustable": "adjust", "adoption": "adopt", "probate": "probat", "controlling": "control",
    "rate": "rate", "cease": "ceas", "skies": "sky", "dying": "die", "news": "news", "is": "is",
}


def test_stems():
    assert {w: stem_word(w) for w in STEMS} == STEMS


def test_common_subsequence():
    chance = random.Random(1)
    for _ in range(50):
        a = chance.choices("abcd", k=chance.randint(0, 90))
        b = chance.choices("abcd", k=chance.randint(0, 90))
        row = [0] * (len(b) + 1)
        for x in a:
            before, row = row, [0]
            for j, y in enumerate(b, 1):
                row.append(before[j - 1] + 1 if x == y else max(before[j], row[-1]))
        assert common_subsequence(a, b) == row[-1]


def test_rouge_of_equal_texts_is_one(pairs):
    _, df = pairs
    long_enough = df.where(F.size(F.split("r", " +")) > 4)
    for row in rouge_scores(long_enough, "r", "r").collect():
        assert [row["rouge1"], row["rouge2"], row["rougeL"]] == [1.0, 1.0, 1.0]


def test_rouge_by_hand(spark):
    rows = spark.createDataFrame(
        [("The cats sat on the mat", "a cat sat on a mat mat"), ("", "x"), ("a", "b")],
        "r string, h string",
    )
    got = rouge_scores(rows, "r", "h").collect()
    # stems cat, sat, on, mat: 4 of 6 and 4 of 7; bigrams "cat sat", "sat on": 2 of 5 and 2 of 6
    assert got[0]["rouge1"] == pytest.approx(2 * (4 / 6) * (4 / 7) / (4 / 6 + 4 / 7))
    assert got[0]["rouge2"] == pytest.approx(2 * (2 / 5) * (2 / 6) / (2 / 5 + 2 / 6))
    assert got[0]["rougeL"] == pytest.approx(2 * (4 / 6) * (4 / 7) / (4 / 6 + 4 / 7))
    assert [tuple(r)[2:] for r in got[1:]] == [(0.0, 0.0, 0.0)] * 2
    unstemmed = rouge_scores(rows.limit(1), "r", "h", stem=False).first()
    assert unstemmed["rouge1"] < got[0]["rouge1"]
    assert rouge_report(rouge_scores(rows, "r", "h")).first()["num_samples"] == 3


def test_shapes(spark):
    row = spark.createDataFrame([([2, 7, 8, 9, 3],)], "ids array<int>")
    out = row.select(
        arrays.fit_length("ids", 4, 0, 3).alias("cut"),
        arrays.fit_length("ids", 7, 0, 3).alias("padded"),
        arrays.attention_mask("ids", 7).alias("mask"),
        arrays.attention_mask("ids", 4).alias("full"),
        arrays.seq_pair_side("ids", 6, 2, 3, 0).alias("side"),
        arrays.decoder_input("ids").alias("i"),
        arrays.decoder_target("ids").alias("o"),
    ).first()
    assert out["cut"] == [2, 7, 8, 3]
    assert out["padded"] == [2, 7, 8, 9, 3, 0, 0]
    assert out["mask"] == [1, 1, 1, 1, 1, 0, 0] and out["full"] == [1, 1, 1, 1]
    assert out["side"] == [2, 2, 7, 8, 9, 3]
    assert out["i"] == [2, 7, 8, 9] and out["o"] == [7, 8, 9, 3]


def test_collator(spark):
    rows = spark.createDataFrame(
        [(0, 0, [1, 5]), (1, 0, [1, 6, 7]), (2, 1, [1]), (3, 1, [4, 4]), (4, 2, [])],
        "id int, batch_id int, ids array<int>",
    )
    got = {r["id"]: r["ids"] for r in batching.collate_labels(rows, "ids", 0, bos=1).collect()}
    assert got == {0: [5, -100], 1: [6, 7], 2: [1, -100], 3: [4, 4], 4: []}


def test_batches_cover_each_rank_once(spark):
    ranked = spark.range(1, 24).withColumnRenamed("id", "rank")
    kept = batching.assign_batches(ranked, 5).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in kept) == [3, 5, 5, 5, 5]
    assert batching.assign_batches(ranked, 5, drop_last=True).count() == 20


def test_losses(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 2.0], 1), ([1000.0, 0.0, 0.0], 0)], "z array<double>, y int")
    out = rows.select(arrays.argmax("z").alias("p"), arrays.cross_entropy("z", "y").alias("l")).collect()
    assert [r["p"] for r in out] == [1, 0]
    assert out[0]["l"] == pytest.approx(0.8619948) and out[1]["l"] == 0
    empty = metrics.evaluate_table(rows.where("y > 5"), {"l": metrics.mean_loss("y"), "a": metrics.accuracy("y", "y")})
    assert tuple(empty.first()) == (0.0, 0.0)


def test_improvements_are_strict(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 0.5), (3, 0.5), (4, 0.4), (5, 0.9)], "step bigint, acc double")
    up = traininglog.improvements(rows, "step", "acc", True, width=2).orderBy("step").collect()
    assert [r["step"] for r in up] == [2, 5]
    down = traininglog.improvements(rows, "step", "acc", False, width=2).collect()
    assert [r["step"] for r in down] == [1]
    assert traininglog.improvements(rows.where("acc = 0"), "step", "acc", True).count() == 0
    best = traininglog.best_checkpoint(rows, "step", "acc", greater_is_better=True).first()
    assert tuple(best) == (5, 0.9)


def test_pooling_modes(spark):
    rows = spark.createDataFrame(
        [(1, 0, [1.0, 2.0], 1), (1, 1, [3.0, 6.0], 1), (1, 2, [0.0, 0.0], 0)],
        "g int, p int, v array<double>, m int",
    )
    pool = lambda **k: metrics.pool_vectors(rows, "g", "p", "v", **k).first()["v"]
    assert pool(mode="cls") == [1.0, 2.0]
    assert pool(mode="mean") == pytest.approx([4 / 3, 8 / 3])
    assert pool(mode="mean", mask="m") == [2.0, 4.0]


def test_nan_never_improves(spark):
    rows = spark.createDataFrame(
        [(1, 0.5), (2, float("nan")), (3, 0.9), (4, None)], "step bigint, acc double"
    )
    up = traininglog.improvements(rows, "step", "acc", True).collect()
    assert sorted(r["step"] for r in up) == [1, 3]
    best = traininglog.best_checkpoint(rows, "step", "acc", greater_is_better=True).first()
    assert (best["step"], best["value"]) == (3, 0.9)


def test_rows_without_group_or_step_stay(spark):
    values = [("a", 1, 1.0), (None, 1, 3.0), (None, 2, 5.0), ("a", None, 7.0), ("a", 10**12, 5.0)]
    rows = spark.createDataFrame(values, "epoch string, step bigint, loss double")
    got = traininglog.running_epoch_mean(rows, "epoch", "step", "loss", width=2).collect()
    means = {(r["epoch"], r["step"]): r["running_mean"] for r in got}
    assert len(got) == 5
    assert means["a", 1] == 1.0 and means["a", 10**12] == 3.0
    assert means[None, 1] == 3.0 and means[None, 2] == 4.0
    assert means["a", None] == pytest.approx(13 / 3)


def test_a_batch_of_padding_has_no_mean(spark):
    rows = spark.createDataFrame([(0, 1.0, 5), (1, 2.0, 0), (1, 2.0, None)], "b int, l double, t int")
    loss = metrics.masked_mean_of_means(rows, "b", "l", "t", 0).first()
    assert loss["batches"] == 2 and loss["loss"] != loss["loss"]


def test_references_are_not_grouped(spark):
    row = spark.sql("SELECT array(1, 1, 0, 1, 2, 2) AS ids")
    got = row.select(arrays.ctc_collapse("ids", 0).alias("a"), arrays.ctc_collapse("ids", 0, group=False).alias("b")).first()
    assert (got["a"], got["b"]) == ([1, 1, 2], [1, 1, 1, 2, 2])


def test_batches_are_scored_some_rows_after_another(monkeypatch):
    """Only so many rows are Python lists at once; nulls and empty rows keep their places."""
    import pyarrow as pa

    from corpusloom.operators import rouge

    monkeypatch.setattr(rouge, "LISTED_ROWS", 2)
    monkeypatch.setattr(rouge, "STEMMED_ROWS", 2)
    a = pa.array([["running", "dogs"], None, [], ["x"], ["running", "cats", "sat"]], pa.list_(pa.string()))
    b = pa.array([["dogs"], ["y"], ["y"], None, ["running", "sat"]], pa.list_(pa.string()))
    assert rouge._lcs_lengths(a, b).to_pylist() == [1, None, 0, None, 2]
    want = [["run", "dog"], None, [], ["x"], ["run", "cat", "sat"]]
    assert rouge._stemmer()(a).to_pylist() == want
    assert rouge._stemmer()(a.slice(1, 4)).to_pylist() == want[1:]
