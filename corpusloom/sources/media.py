"""Lengths of audio files from their headers."""

from __future__ import annotations

import wave
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from corpusloom.sources.files import list_files, open_stream


def media_lengths(
    spark: SparkSession, paths: Sequence[str], target_rate: int = 16_000
) -> DataFrame:
    """``(path, frames, sampling_rate, input_length, error)``; the length is in samples at the target rate."""
    schema = "path string, frames bigint, sampling_rate int, input_length bigint, error string"

    def header(path: str) -> tuple:
        try:
            with open_stream(path) as raw, wave.open(raw) as audio:
                frames, rate = audio.getnframes(), audio.getframerate()
            return path, frames, rate, frames * target_rate // rate, None
        except Exception as fault:
            return path, None, None, None, f"{type(fault).__name__}: {fault}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame(
                [header(p) for p in batch["path"]],
                columns=["path", "frames", "sampling_rate", "input_length", "error"],
            )
            whole = ["frames", "sampling_rate", "input_length"]
            yield rows.astype({c: "Int64" for c in whole})

    return list_files(spark, paths).select("path").mapInPandas(run, schema)
