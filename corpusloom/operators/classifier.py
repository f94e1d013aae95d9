"""A linear text classifier on hashed token counts, and its report per split."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import argmax, cross_entropy
from corpusloom.functions.text import pretokenize
from corpusloom.operators.metrics import accuracy, evaluate_table, mean_loss


def _tokens(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_tokens", pretokenize(F.lower(F.coalesce(text, F.lit("")))))


def fit_text_classifier(
    train: DataFrame,
    text: str = "text",
    label: str = "label",
    features: int = 1 << 14,
    regularization: float = 0.01,
    iterations: int = 20,
) -> PipelineModel:
    """Fit on all given rows. Gradients are summed over partitions; no row reaches the driver.

    The hashed counts are kept, in memory or on the executors' disks, for the passes over them.
    """
    rows = _tokens(train, text).select("_tokens", F.col(label).cast("double").alias(label))
    hashing = HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=features)
    counts = hashing.transform(rows).select("_counts", label).persist(StorageLevel.MEMORY_AND_DISK)
    weighting = IDF(inputCol="_counts", outputCol="_weights").fit(counts)
    regression = LogisticRegression(
        featuresCol="_weights",
        labelCol=label,
        rawPredictionCol="_logits",
        probabilityCol="_probability",
        predictionCol="_class",
        family="multinomial",
        regParam=regularization,
        maxIter=iterations,
    )
    fitted = regression.fit(weighting.transform(counts))
    counts.unpersist()
    return PipelineModel(stages=[hashing, weighting, fitted])


def score(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``logits`` and the predicted class of each row."""
    scored = model.transform(_tokens(df, text)).withColumn("logits", vector_to_array("_logits"))
    return scored.withColumn("prediction", argmax("logits")).drop(
        "_tokens", "_counts", "_weights", "_logits", "_probability", "_class"
    )


def parameter_count(model: PipelineModel) -> int:
    fitted = model.stages[-1]
    return fitted.numFeatures * fitted.numClasses + fitted.numClasses


def classification_report(scored: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """Loss, accuracy and rows of each split."""
    return evaluate_table(
        scored,
        {
            "loss": mean_loss(cross_entropy("logits", label)),
            "accuracy": accuracy("prediction", label),
            "samples": F.count("*"),
        },
        by=[split],
    )
