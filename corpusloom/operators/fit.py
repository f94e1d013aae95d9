"""A classifier fitted step by step: every step logged, evaluated and saved every so many steps, resumable.

Rows are hashed token counts, written once. An epoch is a seeded shuffle cut into batches and written in
the order of its batches, so that a step reads its own rows alone. A step needs the weights of the one
before, and a small batch is no work for a job of its own: steps are taken in rounds of bounded rows and
states, one job each, whose task reads its batches in order. A batch of more than ``ALONE_ROWS`` rows is one
job: tasks add up the gradient of their rows and send one sum each; the driver applies it to the weights.
All evaluations of a round are one job over the evaluation rows, spread over all tasks. What travels is set
by ``features`` and ``classes`` and not by the data. Shuffles, batches and sums are the same in every run,
so a run that resumes goes on as the one that was stopped would have.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import pretokenize
from corpusloom.operators.batching import assign_batches
from corpusloom.operators.ordering import shuffle_rank
from corpusloom.session import materialize
from corpusloom.sources.files import matching

LOG = "step long, epoch int, loss double, rows long, eval_loss double, eval_accuracy double"
_STATE = "step long, weights binary, first binary, second binary"
_SUMS = "rows long, loss double, gradient binary"
_TAKEN = "step long, loss double, rows long, weights binary, first binary, second binary"
_SCORES = "place int, rows long, loss double, correct long"

ALONE_ROWS = 4_096  # a batch of more rows is summed by many tasks
ROUND_ROWS = 1 << 16  # rows that the task of a round reads
ROUND_BYTES = 8 << 20  # states of a round
SCORED_VALUES = 1 << 20  # weights that an evaluation looks up at once


@dataclass(frozen=True)
class FitOptions:
    """Sizes and rates of a fit. The optimiser is Adam with decoupled weight decay."""

    features: int = 1 << 14
    classes: int = 2
    batch_size: int = 32
    epochs: int = 3
    learning_rate: float = 0.01
    weight_decay: float = 0.01
    decay_first: float = 0.9
    decay_second: float = 0.999
    epsilon: float = 1e-8
    evaluate_every: int = 50
    seed: int = 42


@dataclass
class FitState:
    """Weights (a row per feature and one for the bias, a column per class) and both moments, after a step."""

    step: int
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray

    @staticmethod
    def start(options: FitOptions) -> FitState:
        shape = (options.features + 1, options.classes)
        return FitState(0, np.zeros(shape), np.zeros(shape), np.zeros(shape))

    def moved(self, gradient: np.ndarray, o: FitOptions) -> FitState:
        step = self.step + 1
        first = o.decay_first * self.first + (1 - o.decay_first) * gradient
        second = o.decay_second * self.second + (1 - o.decay_second) * gradient**2
        rate = first / (1 - o.decay_first**step)
        scale = np.sqrt(second / (1 - o.decay_second**step)) + o.epsilon
        kept = self.weights * (1 - o.learning_rate * o.weight_decay)
        return FitState(step, kept - o.learning_rate * rate / scale, first, second)


@dataclass(frozen=True)
class Fitted:
    """The last state, the log of all steps, and where the states are."""

    state: FitState
    log: DataFrame
    path: str
    options: FitOptions = field(default_factory=FitOptions)

    def at(self, step: int) -> FitState:
        """The state saved after a step."""
        return _read_state(self.log.sparkSession, self.path, step, self.options)


def token_slots(text: Column | str, features: int) -> Column:
    """The slot of each token of a text, lower-cased; null texts have none."""
    tokens = pretokenize(F.lower(F.coalesce(text, F.lit(""))))
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(features)).cast("int"))


def _tokens(slots: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The slots of all rows one after another, and how many each row has."""
    lengths = np.asarray(slots.value_lengths().fill_null(0), np.int64)
    return slots.flatten().to_numpy(zero_copy_only=False), lengths


def _sums(slots: pa.Array, labels: np.ndarray, weights: np.ndarray) -> tuple[int, float, np.ndarray]:
    """Rows, summed loss and the summed gradient of some rows; a row is the mean of its tokens."""
    n, classes = len(labels), range(weights.shape[1])
    flat, lengths = _tokens(slots)
    of = np.repeat(np.arange(n), lengths)
    share = np.repeat(1.0 / np.maximum(lengths, 1), lengths)
    means = [np.bincount(of, weights[flat, c] * share, minlength=n) for c in classes]
    logits = np.stack(means, axis=1) + weights[-1]
    logits -= logits.max(axis=1, keepdims=True)
    odds = np.exp(logits)
    total = odds.sum(axis=1, keepdims=True)
    loss = np.log(total[:, 0]) - logits[np.arange(n), labels]
    miss = odds / total
    miss[np.arange(n), labels] -= 1
    slopes = [np.bincount(flat, miss[of, c] * share, minlength=len(weights)) for c in classes]
    slope = np.stack(slopes, axis=1)
    slope[-1] = miss.sum(axis=0)
    return n, float(loss.sum()), slope


def _summed(rows: DataFrame, weights: np.ndarray) -> tuple[int, float, np.ndarray]:
    """The sums over all rows; each task sends one row."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, count, loss, slope = sent.value, 0, 0.0, np.zeros_like(sent.value)
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            n, part, gradient = _sums(batch.column(0), labels, w)
            count, loss, slope = count + n, loss + part, slope + gradient
        if count:
            gradient = pa.array([slope.tobytes()], pa.binary())
            yield pa.RecordBatch.from_pydict({"rows": [count], "loss": [loss], "gradient": gradient})

    # in a fixed order, so that a resumed run adds up alike
    parts = rows.select("slots", "label").mapInArrow(run, _SUMS).collect()
    parts = sorted(parts, key=lambda r: (r["rows"], r["loss"], r["gradient"]))
    sent.destroy()
    slope = sum((np.frombuffer(r["gradient"]).reshape(weights.shape) for r in parts), np.zeros_like(weights))
    return sum(r["rows"] for r in parts), sum(r["loss"] for r in parts), slope


_Taken = tuple[int, float, int, FitState | None]


def _take_steps(batches: DataFrame, number: int, end: int, state: FitState, o: FitOptions, last: int) -> list[_Taken]:
    """Steps over the batches from ``number`` to before ``end`` in one task: (step, mean loss, rows, state).

    States come with the steps after which an evaluation is due, and with the last one.
    """
    sent = batches.sparkSession.sparkContext.broadcast(state)
    final = state.step + end - number

    def run(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = sent.value

        def stepped(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal now
            # a batch that came in pieces is summed whole, so that sums do not depend on the cuts
            rows = pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]
            labels = rows.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            n, loss, slope = _sums(rows.column("slots"), labels, now.weights)
            now = now.moved(slope / n, o)
            kept = now.step == final or _due(now.step, o, last)
            arrays = {c: pa.array([getattr(now, c).tobytes() if kept else None], pa.binary()) for c in _ARRAYS}
            return pa.RecordBatch.from_pydict({"step": [now.step], "loss": [loss / n], "rows": [n], **arrays})

        held: list[pa.RecordBatch] = []
        current = None
        for piece in arrived:
            ids = piece.column("batch_id").to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and ids[a] != current:
                    yield stepped(held)
                    held = []
                current = ids[a]
                held.append(piece.slice(a, b - a))
        if held:
            yield stepped(held)

    wanted = batches.where((F.col("batch_id") >= number) & (F.col("batch_id") < end))
    ordered = wanted.coalesce(1).sortWithinPartitions("rank").select("batch_id", "slots", "label")
    taken = ordered.mapInArrow(run, _TAKEN).collect()
    sent.destroy()
    return [
        (r["step"], r["loss"], r["rows"], _as_state(r, o) if r["weights"] is not None else None)
        for r in sorted(taken, key=lambda r: r["step"])
    ]


def _scores(rows: DataFrame, states: Sequence[FitState]) -> list[tuple[int, float, int]]:
    """Rows, summed loss and hits of each state, in one job; each task sends a row for each state."""
    classes = states[0].weights.shape[1]
    sent = rows.sparkSession.sparkContext.broadcast(np.concatenate([s.weights for s in states], axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        count, loss, hits = 0, np.zeros(w.shape[1] // classes), np.zeros(w.shape[1] // classes, np.int64)
        for batch in batches:
            slots = batch.column(0)
            every = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.maximum(np.asarray(slots.value_lengths().fill_null(0), np.int64), 1)
            # rows whose first token falls into the same so many weights are scored together
            group = (np.cumsum(sizes) - sizes) * w.shape[1] // SCORED_VALUES
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(sizes)]
            for a, b in zip(cuts, cuts[1:]):
                labels, n = every[a:b], b - a
                flat, lengths = _tokens(slots.slice(a, n))
                means = np.zeros((n, w.shape[1]))
                filled = lengths > 0
                if filled.any():
                    starts = (np.cumsum(lengths) - lengths)[filled]
                    means[filled] = np.add.reduceat(w[flat], starts, axis=0) / lengths[filled, None]
                logits = (means + w[-1]).reshape(n, -1, classes)
                logits -= logits.max(axis=2, keepdims=True)
                lost = np.log(np.exp(logits).sum(axis=2)) - logits[np.arange(n), :, labels]
                # each state's rows side by side: the sum does not depend on how many states there are
                loss += np.ascontiguousarray(lost.T).sum(axis=1)
                hits += (logits.argmax(axis=2) == labels[:, None]).sum(axis=0)
                count += n
        if count:
            places = pa.array(range(len(loss)), pa.int32())
            columns = {"place": places, "rows": [count] * len(loss), "loss": loss, "correct": hits}
            yield pa.RecordBatch.from_pydict(columns)

    partial = rows.select("slots", "label").mapInArrow(run, _SCORES)
    found = partial.groupBy("place").agg(F.sum("rows"), F.sum("loss"), F.sum("correct")).collect()
    sent.destroy()
    by_place = {r[0]: (r[1], r[2], r[3]) for r in found}
    return [by_place.get(i, (0, 0.0, 0)) for i in range(len(states))]


_ARRAYS = ("weights", "first", "second")


def _due(step: int, o: FitOptions, last: int) -> bool:
    return step % o.evaluate_every == 0 or step == last


def _as_state(row, o: FitOptions) -> FitState:
    arrays = [np.frombuffer(row[c]).reshape(o.features + 1, o.classes) for c in _ARRAYS]
    return FitState(row["step"], *arrays)


def _saved_rounds(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """The steps whose states were written to the end, with the folders that have them."""
    ends = [p.removesuffix("/_SUCCESS") for p in matching(spark, f"{path}/state-*/_SUCCESS")]
    found: dict[int, list[str]] = {}
    if ends:
        states = spark.read.schema(_STATE).parquet(*ends)
        for step, file in states.select("step", "_metadata.file_path").collect():
            found.setdefault(step, []).append(file.rsplit("/", 2)[-2])
    return found


def _read_state(spark: SparkSession, path: str, step: int, o: FitOptions) -> FitState:
    folders = _saved_rounds(spark, path).get(step)
    if not folders:
        raise ValueError(f"no state was saved after step {step}")
    row = spark.read.schema(_STATE).parquet(f"{path}/{folders[0]}").where(F.col("step") == step).first()
    return _as_state(row, o)


def _save(spark: SparkSession, path: str, states: list[FitState], log: list[tuple]) -> None:
    """The steps since the last save, then their states: what has no state is not part of the log."""
    end = states[-1].step
    spark.createDataFrame(log, LOG).coalesce(1).write.mode("overwrite").json(f"{path}/log-{end}")
    rows = [(s.step, *(getattr(s, c).tobytes() for c in _ARRAYS)) for s in states]
    spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/state-{end}")


def fit_steps(
    train: DataFrame,
    evaluation: DataFrame,
    keys: Sequence[str],
    path: str,
    text: str = "text",
    label: str = "label",
    options: FitOptions | None = None,
    stop_after: int | None = None,
) -> Fitted:
    """Fit on ``train``, evaluate on ``evaluation``, keep states and log below ``path``.

    A step is a batch; the last batch of an epoch may be smaller. After every ``evaluate_every`` steps and
    after the last the evaluation rows are scored and the state is saved; the states of a round, and the log
    up to them, are written together. A path that holds states is gone on with after the last of them;
    ``stop_after`` ends a run early. Labels are whole numbers from 0; rows without one are left out. ``keys``
    identify a row. The log has a record for each step: its epoch, the mean loss and the rows of its batch,
    and at evaluations their mean loss and share of hits.
    """
    o = options or FitOptions()
    spark = train.sparkSession
    slots = token_slots(text, o.features).alias("slots")
    known = F.col(label).isNotNull()
    rows = materialize(train.where(known).select(*keys, slots, F.col(label).cast("int").alias("label")), "fit-rows")
    held_out = materialize(evaluation.where(known).select(slots, F.col(label).cast("int").alias("label")), "fit-held-out")
    per_epoch = -(-rows.count() // o.batch_size)
    last = per_epoch * o.epochs
    saved = [step for step in _saved_rounds(spark, path) if step <= last]
    state = _read_state(spark, path, max(saved), o) if saved else FitState.start(o)
    log: list[tuple] = []
    batches, epoch_of_batches = None, None
    end = last if stop_after is None else min(last, stop_after)
    saves = max(1, ROUND_BYTES // (3 * state.weights.nbytes))
    while state.step < end:
        epoch, number = divmod(state.step, per_epoch)
        if epoch != epoch_of_batches:
            ranked = shuffle_rank(rows, keys, o.seed + epoch)
            batches = materialize(
                assign_batches(ranked, o.batch_size)
                .select("batch_id", "slots", "label", "rank")
                .repartitionByRange("batch_id")
                .sortWithinPartitions("rank"),
                "fit-epoch",
            )
            epoch_of_batches = epoch
        if o.batch_size > ALONE_ROWS:
            count, loss, slope = _summed(batches.where(F.col("batch_id") == number), state.weights)
            state = state.moved(slope / count, o)
            taken = [(state.step, loss / count, count, state)]
        else:
            # to the end of the epoch, or as far as rows and states allow
            most = min(saves * o.evaluate_every - state.step % o.evaluate_every, max(1, ROUND_ROWS // o.batch_size))
            stop = number + min(most, per_epoch - number, end - state.step)
            taken = _take_steps(batches, number, stop, state, o, last)
            state = taken[-1][3]
        due = [after for step, _, _, after in taken if _due(step, o, last)]
        scored = {s.step: x for s, x in zip(due, _scores(held_out, due))} if due else {}
        written = 0
        for step, loss, count, _ in taken:
            n, total, hits = scored.get(step, (0, 0.0, 0))
            log.append((step, epoch, loss, count, total / n if n else None, hits / n if n else None))
            written = len(log) if step in scored else written
        if due:
            _save(spark, path, due, log[:written])
            log = log[written:]
    kept = {step: folders for step, folders in _saved_rounds(spark, path).items() if step <= last}
    if not kept:
        return Fitted(state, spark.createDataFrame([], LOG), path, o)
    logs = sorted({f"{path}/{f.replace('state-', 'log-')}" for folders in kept.values() for f in folders})
    return Fitted(state, spark.read.schema(LOG).json(logs).where(F.col("step") <= max(kept)), path, o)


def predict(df: DataFrame, state: FitState, text: str = "text", prediction: str = "prediction") -> DataFrame:
    """Add ``logits`` and the predicted class of each row."""
    features = len(state.weights) - 1
    sent = df.sparkSession.sparkContext.broadcast(state.weights)

    def logits(slots: pa.Array) -> pa.Array:
        w = sent.value
        lengths = np.asarray(slots.value_lengths().fill_null(0), np.int64)
        flat = slots.flatten().to_numpy(zero_copy_only=False)
        out = np.tile(w[-1], (len(slots), 1))
        share = np.repeat(1.0 / np.maximum(lengths, 1), lengths)
        np.add.at(out, np.repeat(np.arange(len(slots)), lengths), w[flat] * share[:, None])
        return pa.array(list(out), pa.list_(pa.float64()))

    scored = df.withColumn("logits", F.arrow_udf(logits, "array<double>")(token_slots(text, features)))
    best = F.array_position("logits", F.array_max("logits")) - 1
    return scored.withColumn(prediction, best.cast("int"))
