"""Labelled corpus: balance, split, train a tokenizer, encode to one length, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.arrays import attention_mask, fit_length
from corpusloom.functions.text import pretokenize
from corpusloom.operators import traininglog
from corpusloom.operators.bpe import CLASSIFIER_SPECIALS, BpeTokenizer, train_bpe, word_counts
from corpusloom.operators.classifier import (
    classification_report,
    fit_text_classifier,
    parameter_count,
    score,
)
from corpusloom.operators.encode import encode_column, max_token_length
from corpusloom.operators.fit import FitOptions, Fitted, fit_steps, predict
from corpusloom.operators.results import build_metadata, results_record
from corpusloom.operators.sampling import balanced_sample, ratio_split, resplit
from corpusloom.session import cut_lineage
from corpusloom.sources import pool
from corpusloom.sources.tabular import LABELED, write_record, write_splits_csv


@dataclass(frozen=True)
class PreparedCorpus:
    rows: DataFrame
    tokenizer: BpeTokenizer
    metadata: DataFrame


def fit_shape(df: DataFrame, text: str, tokenizer: BpeTokenizer, length: int) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` of one length."""
    ids = df.withColumn("_ids", encode_column(text, tokenizer))
    return (
        ids.withColumn("input_ids", fit_length("_ids", length, tokenizer.pad_id, tokenizer.last_id))
        .withColumn("attention_mask", attention_mask("_ids", length))
        .drop("_ids")
    )


def prepare_labeled_corpus(
    df: DataFrame,
    keys: Sequence[str],
    per_class: int,
    text: str = "text",
    label: str = "label",
    vocab_size: int = 8_000,
    max_length: int | None = None,
    seed: int = 42,
    tokenizer: BpeTokenizer | None = None,
) -> PreparedCorpus:
    """Rows with their split, the tokenizer trained on all rows, and the metadata record.

    Without ``max_length`` the longest text of the balanced rows sets it.
    """
    if tokenizer is None:
        tokenizer = train_bpe(word_counts(df, [text]), vocab_size, CLASSIFIER_SPECIALS)
    balanced = balanced_sample(df, label, per_class, keys, seed)
    rows = cut_lineage(ratio_split(balanced, keys, seed).select(*keys, text, label, "split"))
    if max_length is None:
        max_length = max_token_length(rows, text, tokenizer).first()["max_length"]
    metadata = build_metadata(
        rows,
        {
            "num_samples_per_class": per_class,
            "vocab_size": len(tokenizer.tokens),
            "max_length": max_length,
            "pad_token_id": tokenizer.pad_id,
            "cls_token_id": tokenizer.first_id,
            "sep_token_id": tokenizer.last_id,
            "unk_token_id": tokenizer.unk_id,
        },
    )
    return PreparedCorpus(rows, tokenizer, metadata)


def write_prepared(corpus: PreparedCorpus, path: str, columns: Sequence[str] = ("text", "label")) -> None:
    """Split CSVs, the tokenizer and the metadata below one path."""
    write_splits_csv(corpus.rows, f"{path}/splits", columns)
    corpus.tokenizer.save(corpus.rows.sparkSession, f"{path}/tokenizer")
    write_record(corpus.metadata, f"{path}/metadata")


def resplit_pool(
    spark: SparkSession,
    paths: Sequence[str],
    schema: str = LABELED,
    train_ratio: float = 0.95,
    seed: int = 42,
    require_any: bool = True,
) -> DataFrame:
    """The CSV files of earlier splits as one pool, split anew by position in a seeded shuffle.

    The rows need no key: equal rows are told apart by file and row number, so that the sizes of the parts
    are exact whatever the copies. Adds ``row_file``, ``row_number`` and ``split``.
    """
    rows = pool.read_pool(spark, paths, schema, require_any)
    return resplit(rows, [pool.FILE, pool.ROW], seed, train_ratio)


def split_word_report(
    df: DataFrame, keys: Sequence[str], text: str, label: str, per_class: int, seed: int = 42
) -> DataFrame:
    """Rows, words, distinct words and the 95th percentile of words, per split and class."""
    balanced = balanced_sample(df.select(*keys, text, label), label, per_class, keys, seed)
    split = cut_lineage(ratio_split(balanced, keys, seed))
    tokens = split.select("split", label, pretokenize(text).alias("tokens"))
    sizes = tokens.groupBy("split", label).agg(
        F.count("*").alias("rows"),
        F.sum(F.size("tokens")).alias("words"),
        F.percentile(F.size("tokens"), F.lit(0.95)).cast("int").alias("p95_words"),
    )
    distinct = (
        tokens.select("split", label, F.explode("tokens").alias("word"))
        .distinct()
        .groupBy("split", label)
        .agg(F.count("*").alias("distinct_words"))
    )
    return sizes.join(distinct, ["split", label])


def train_and_report(df: DataFrame, text: str = "text", label: str = "label", **options) -> DataFrame:
    """One row: losses, accuracies and sizes per split, and the parameter count."""
    # the split and its joins are worked out once, for fitting and for scoring
    df = cut_lineage(df.select(text, label, "split"))
    model = fit_text_classifier(df.where(F.col("split") == "train"), text, label, **options)
    report = classification_report(score(model, df, text), label)
    short = {"train": "train", "validation": "val", "test": "test"}

    def pick(split: str, column: str):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    columns = [
        pick(split, column).alias(f"{name}_{column}")
        for split, name in short.items()
        for column in ("loss", "accuracy", "samples")
    ]
    return report.agg(*columns).withColumn("num_parameters", F.lit(parameter_count(model)))


@dataclass(frozen=True)
class TrainedClassifier:
    """A fit, the step its best evaluation came after, the report of that state, history and record."""

    fitted: Fitted
    best_step: int
    report: DataFrame
    history: DataFrame
    record: DataFrame


def train_with_history(
    df: DataFrame,
    keys: Sequence[str],
    path: str,
    text: str = "text",
    label: str = "label",
    options: FitOptions | None = None,
    metric: str = "eval_accuracy",
    stop_after: int | None = None,
) -> TrainedClassifier:
    """Fit on the train split with a logged history, keep the state that evaluates best, report every split.

    Evaluations are of the validation split. States and log stay below ``path``, from where a stopped run
    goes on. The history has the running mean of the loss in each epoch beside the steps' own values; the
    record holds the sizes, the options, the best step and its value.
    """
    options = options or FitOptions()
    df = cut_lineage(df.select(*keys, text, label, "split"))
    part = {s: df.where(F.col("split") == s) for s in ("train", "validation")}
    fitted = fit_steps(part["train"], part["validation"], keys, path, text, label, options, stop_after)
    best = traininglog.best_checkpoint(fitted.log, "step", metric, greater_is_better=metric != "eval_loss")
    found = best.first()
    if found is None or found["step"] is None:
        raise ValueError("no step was evaluated")
    scored = predict(df.where(F.col(label).isNotNull()), fitted.at(found["step"]), text)
    report = cut_lineage(classification_report(scored, label))
    running = traininglog.running_epoch_mean(fitted.log, "epoch", "step", "loss")
    history = traininglog.history(running, "step", ["epoch", "loss", "running_mean", "eval_loss", "eval_accuracy"])
    sizes = report.agg(
        *[
            F.max(F.when(F.col("split") == s, F.col(c))).alias(f"{s}_{c}")
            for s in ("train", "validation", "test")
            for c in ("samples", "loss", "accuracy")
        ],
    ).withColumns({"best_step": F.lit(found["step"]), f"best_{metric}": F.lit(found["value"])})
    architecture = {
        name: F.lit(getattr(options, name))
        for name in ("features", "classes", "batch_size", "epochs", "learning_rate", "evaluate_every")
    }
    record = results_record(sizes, nested={"architecture": architecture})
    return TrainedClassifier(fitted, found["step"], report, history, record)


__all__ = [
    "PreparedCorpus",
    "TrainedClassifier",
    "fit_shape",
    "prepare_labeled_corpus",
    "resplit_pool",
    "split_word_report",
    "train_and_report",
    "train_with_history",
    "write_prepared",
]
