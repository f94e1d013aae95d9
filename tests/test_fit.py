"""The step-logged fit against NumPy, its log through the log analytics, and resumption."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import traininglog
from corpusloom.operators.fit import FitOptions, fit_steps, predict, token_slots
from corpusloom.operators.ordering import shuffle_rank
from corpusloom.plans.labeled import train_with_history

OPTIONS = FitOptions(features=64, batch_size=16, epochs=3, evaluate_every=7, learning_rate=0.05)


@pytest.fixture(scope="module")
def rows(spark):
    words = ["good fine great", "bad poor awful", "film story actor scene"]
    data = []
    for i in range(130):
        label = i % 2
        text = f"{words[label]} {words[2]} number {i % 7} " * (1 + i % 3)
        split = "train" if i < 90 else "validation" if i < 110 else "test"
        data.append((i, None if i == 3 else "" if i == 4 else text, None if i == 5 else label, split))
    return spark.createDataFrame(data, "id long, text string, label int, split string").cache()


def numpy_fit(rows, o):
    """The same fit in plain loops: (weights, [(step, epoch, loss, rows, eval_loss, eval_accuracy)])."""
    train = rows.where("split = 'train' and label is not null")
    held = rows.where("split = 'validation' and label is not null")
    cols = [F.col("label"), token_slots("text", o.features).alias("slots")]
    held_rows = [(r["label"], r["slots"]) for r in held.select(*cols).collect()]

    def vector(slots):
        x = np.zeros(o.features + 1)
        for slot, n in Counter(slots).items():
            x[slot] = n / len(slots)
        x[-1] = 1
        return x

    def loss_of(w, x, y):
        z = x @ w
        p = np.exp(z - z.max())
        p /= p.sum()
        return -math.log(p[y]), p

    w, m, v = (np.zeros((o.features + 1, o.classes)) for _ in range(3))
    log, step = [], 0
    n = train.count()
    last = -(-n // o.batch_size) * o.epochs
    for epoch in range(o.epochs):
        ranked = shuffle_rank(train, ["id"], o.seed + epoch).orderBy("rank").select(*cols).collect()
        for start in range(0, n, o.batch_size):
            batch = [(r["label"], vector(r["slots"])) for r in ranked[start : start + o.batch_size]]
            g, total = np.zeros_like(w), 0.0
            for y, x in batch:
                one, p = loss_of(w, x, y)
                total += one
                g += np.outer(x, p - np.eye(o.classes)[y])
            g /= len(batch)
            step += 1
            m = o.decay_first * m + (1 - o.decay_first) * g
            v = o.decay_second * v + (1 - o.decay_second) * g * g
            w = w * (1 - o.learning_rate * o.weight_decay)
            w = w - o.learning_rate * (m / (1 - o.decay_first**step)) / (
                np.sqrt(v / (1 - o.decay_second**step)) + o.epsilon
            )
            record = [step, epoch, total / len(batch), len(batch), None, None]
            if step % o.evaluate_every == 0 or step == last:
                scored = [loss_of(w, vector(s), y) + (y,) for y, s in held_rows]
                record[4] = sum(s[0] for s in scored) / len(scored)
                record[5] = sum(s[1].argmax() == s[2] for s in scored) / len(scored)
            log.append(record)
    return w, log


def fitted(rows, path, **more):
    parts = [rows.where(F.col("split") == s) for s in ("train", "validation")]
    return fit_steps(*parts, ["id"], str(path), options=OPTIONS, **more)


@pytest.fixture(scope="module")
def whole(rows, tmp_path_factory):
    return fitted(rows, tmp_path_factory.mktemp("fit"))


def test_equals_numpy(rows, whole):
    weights, log = numpy_fit(rows, OPTIONS)
    got = [list(r) for r in whole.log.orderBy("step").collect()]
    assert [r[:2] + r[3:4] for r in got] == [r[:2] + r[3:4] for r in log]
    for a, b in zip(got, log):
        for i in (2, 4, 5):
            assert (a[i] is None) == (b[i] is None)
            assert a[i] is None or math.isclose(a[i], b[i], rel_tol=1e-9)
    assert np.allclose(whole.state.weights, weights, rtol=1e-8, atol=1e-12)


def test_resumed_run_is_the_same_run(rows, whole, tmp_path):
    early = fitted(rows, tmp_path, stop_after=10)
    # only what was saved with a state counts
    assert early.log.count() == 7
    again = fitted(rows, tmp_path)
    assert sorted(map(tuple, again.log.collect())) == sorted(map(tuple, whole.log.collect()))
    assert np.array_equal(again.state.weights, whole.state.weights)
    done = fitted(rows, tmp_path)
    assert done.state.step == again.state.step and np.array_equal(done.state.weights, again.state.weights)


def test_log_analytics_run_on_the_log(whole):
    log = whole.log
    held = [r.asDict() for r in log.orderBy("step").collect()]
    assert traininglog.every_n(log, "step", 7).count() == len(held) // 7
    means = {r["epoch"]: r["mean_loss"] for r in traininglog.epoch_mean(log, "epoch", "loss").collect()}
    for epoch, mean in means.items():
        own = [r["loss"] for r in held if r["epoch"] == epoch]
        assert math.isclose(mean, sum(own) / len(own))
    best = traininglog.best_checkpoint(log, "step", "eval_loss").first()
    evaluated = [(r["eval_loss"], r["step"]) for r in held if r["eval_loss"] is not None]
    assert (best["value"], best["step"]) == min(evaluated)
    better = {r["step"] for r in traininglog.improvements(log, "step", "eval_loss", False).collect()}
    low, want = math.inf, set()
    for value, step in sorted(evaluated, key=lambda x: x[1]):
        if value < low:
            low, want = value, want | {step}
    assert better == want
    series = traininglog.log_series(log, "step", ("loss", "eval_loss", "eval_accuracy"))
    assert series.count() == len(held) + 2 * len(evaluated)
    parts = traininglog.history(log, "step", ["loss"], points=5).collect()
    assert sum(len(r["steps"]) for r in parts) == len(held)


def test_plan_reports_the_best_state(rows, tmp_path):
    trained = train_with_history(rows, ["id"], str(tmp_path), options=OPTIONS)
    best = trained.fitted.at(trained.best_step)
    scored = predict(rows.where("label is not null"), best)
    want = {
        r["split"]: r["a"]
        for r in scored.groupBy("split").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).collect()
    }
    got = {r["split"]: r["accuracy"] for r in trained.report.collect()}
    assert got == want and want["test"] > 0.9
    record = trained.record.first()
    assert record["best_step"] == trained.best_step and record["architecture"]["features"] == 64
    assert record["train_samples"] == 89


def test_no_rows(rows, tmp_path):
    none = fitted(rows.where("false"), tmp_path)
    assert none.state.step == 0 and none.log.count() == 0


def test_rounds_take_many_steps_in_one_job(rows, whole, tmp_path, monkeypatch):
    from corpusloom.operators import fit

    jobs = []
    take = fit._take_steps
    monkeypatch.setattr(fit, "_take_steps", lambda *a: jobs.append(a[1:3]) or take(*a))
    again = fitted(rows, tmp_path)
    # an epoch of 89 rows is six steps, one job
    assert jobs == [(0, 6)] * OPTIONS.epochs
    assert sorted(map(tuple, again.log.collect())) == sorted(map(tuple, whole.log.collect()))
    assert np.array_equal(again.at(14).weights, whole.at(14).weights)
    with pytest.raises(ValueError):
        again.at(13)


def test_large_batches_and_short_rounds_are_the_same_fit(rows, whole, tmp_path, monkeypatch):
    from corpusloom.operators import fit

    monkeypatch.setattr(fit, "ROUND_ROWS", 32)
    monkeypatch.setattr(fit, "SCORED_VALUES", 64)
    short = fitted(rows, tmp_path / "short")
    assert np.allclose(short.state.weights, whole.state.weights, rtol=1e-12, atol=1e-15)
    monkeypatch.setattr(fit, "ALONE_ROWS", 1)
    spread = fitted(rows, tmp_path / "spread")
    assert np.allclose(spread.state.weights, whole.state.weights, rtol=1e-9, atol=1e-12)
    for got in (short, spread):
        for a, b in zip(got.log.orderBy("step").collect(), whole.log.orderBy("step").collect()):
            assert a["step"] == b["step"] and a["rows"] == b["rows"] and a["eval_accuracy"] == b["eval_accuracy"]
            assert math.isclose(a["loss"], b["loss"], rel_tol=1e-9)
