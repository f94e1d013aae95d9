"""Article and summary pairs: tokenizer, lengths, splits, fixed shapes; scoring of hypotheses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.bpe import SEQ2SEQ_SPECIALS, BpeTokenizer, train_bpe, word_counts
from corpusloom.operators.encode import encode_column, encode_pairs, length_percentiles
from corpusloom.operators.ordering import head_n
from corpusloom.operators.results import build_metadata, results_record
from corpusloom.operators.rouge import rouge_report, rouge_scores
from corpusloom.operators.sampling import ratio_split
from corpusloom.operators.tables import examples


@dataclass(frozen=True)
class PreparedPairs:
    rows: DataFrame
    tokenizer: BpeTokenizer
    metadata: DataFrame
    source_length: int
    target_length: int

    def encoded(self) -> DataFrame:
        return encode_pairs(
            self.rows, "article", "summary", self.source_length, self.target_length, self.tokenizer
        )


def prepare_pairs(
    df: DataFrame,
    keys: Sequence[str],
    vocab_size: int = 8_000,
    max_samples: int | None = None,
    percentile_rows: int | None = None,
    seed: int = 42,
    tokenizer: BpeTokenizer | None = None,
) -> PreparedPairs:
    """``df`` has the unique, ordered ``keys``, ``article`` and ``summary``.

    The lengths come from all rows, unless ``percentile_rows`` names the first ones to measure.
    """
    df = head_n(df, max_samples, keys)
    if tokenizer is None:
        counts = word_counts(df, ["article", "summary"])
        tokenizer = train_bpe(counts, vocab_size, SEQ2SEQ_SPECIALS)
    lengths = {
        "max_src_len": F.size(encode_column("article", tokenizer)),
        "max_tgt_len": F.size(encode_column("summary", tokenizer)),
    }
    limits = length_percentiles(df, lengths, 0.95, percentile_rows, keys).first()
    rows = ratio_split(df, keys, seed)
    metadata = build_metadata(
        rows,
        {
            "vocab_size": len(tokenizer.tokens),
            "max_src_len": limits["max_src_len"],
            "max_tgt_len": limits["max_tgt_len"],
            "pad_token_id": tokenizer.pad_id,
            "bos_token_id": tokenizer.first_id,
            "eos_token_id": tokenizer.last_id,
            "unk_token_id": tokenizer.unk_id,
        },
        total=None,
    )
    return PreparedPairs(
        rows, tokenizer, metadata, limits["max_src_len"], limits["max_tgt_len"]
    )


def score_summaries(
    df: DataFrame,
    keys: Sequence[str],
    num_samples: int | None = None,
    stem: bool = True,
    shown: int = 5,
) -> DataFrame:
    """One record: sample count, mean scores and the first examples.

    ``df`` has ``article``, ``reference`` and ``hypothesis``; ``num_samples`` scores the first rows only.
    """
    rows = head_n(df, num_samples, keys)
    scored = rouge_scores(rows, "reference", "hypothesis", stem=stem)
    first = examples(
        rows, shown, keys, ["article", "reference", "hypothesis"], clip={"article": 200}
    )
    return results_record(
        rouge_report(scored),
        lists={"examples": (first, keys, ["article", "reference", "hypothesis"])},
    )
