"""Speech manifests: paths, transcripts and length filters; scoring of transcriptions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import ctc_collapse, unmask_labels
from corpusloom.functions.numbers import decimals_to_words, integers_to_words, ordinals_to_words
from corpusloom.functions.text import clean_transcript, rewrite_media_path
from corpusloom.operators.results import results_record
from corpusloom.operators.tables import (
    MAX_INPUT_LENGTH,
    MAX_LABEL_LENGTH,
    examples,
    filter_length,
    keep_columns,
)
from corpusloom.operators.wer import wer, word_errors


def numbers_to_words(col: Column | str) -> Column:
    """Ordinals, then decimals, then integers, as words."""
    return integers_to_words(decimals_to_words(ordinals_to_words(col)))


def normalize_transcript(col: Column | str) -> Column:
    """Numbers as words, then the transcript cleaned."""
    return clean_transcript(numbers_to_words(col))


def prepare_transcripts(
    manifest: DataFrame,
    audio_root: str,
    lengths: DataFrame | None = None,
    label_length: Column | None = None,
    keep: Sequence[str] = ("audio", "transcript", "split"),
) -> DataFrame:
    """Paths rewritten, transcripts normalised, rows out of the length bounds dropped.

    ``manifest`` has ``transcript``, ``accent``, ``audio_paths`` and ``split``. ``lengths`` has ``audio``
    and ``input_length`` and goes before the label filter, so that dropped rows are not tokenized;
    ``label_length`` counts the tokens of the normalised ``transcript`` without specials.
    """
    rows = manifest.withColumn("audio", rewrite_media_path(audio_root)).withColumn(
        "transcript", normalize_transcript("transcript")
    )
    if lengths is not None:
        bounded = filter_length(lengths, "input_length", 0, MAX_INPUT_LENGTH)
        rows = rows.join(bounded.select("audio", "input_length"), "audio")
    if label_length is not None:
        rows = filter_length(rows, label_length, None, MAX_LABEL_LENGTH)
    return keep_columns(rows, keep)


def score_transcripts(
    df: DataFrame, keys: Sequence[str], reference: str, prediction: str, shown: int = 20
) -> DataFrame:
    """One record: word error rate, sample count and the first examples."""
    first = examples(df, shown, keys, {reference: "reference", prediction: "prediction"})
    totals = wer(df, reference, prediction).select(F.col("wer").alias("test_wer"), "num_samples")
    return results_record(totals, lists={"examples": (first, keys, ["reference", "prediction"])})


def score_ctc(
    df: DataFrame,
    predictions: str,
    labels: str,
    blank: int,
    spell: Callable[[Column], Column],
) -> DataFrame:
    """Add ``reference``, ``prediction``, ``edits`` and ``ref_words`` to rows of frame ids and masked labels.

    Masked labels turn back into the blank, and neither side keeps blanks. Repeats of frames are one symbol;
    repeats of labels are symbols of their own. ``spell`` gives the text of an id; runs of blanks between
    words are one. Errors are counted in words.
    """

    def text(ids: Column) -> Column:
        return F.trim(F.regexp_replace(F.array_join(F.transform(ids, spell), ""), " +", " "))

    reference = ctc_collapse(unmask_labels(labels, blank), blank, group=False)
    rows = df.withColumns({"reference": text(reference), "prediction": text(ctc_collapse(predictions, blank))})
    return word_errors(rows, "reference", "prediction")
