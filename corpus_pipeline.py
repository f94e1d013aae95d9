"""The corpus pipeline: language, exact copies, near copies, personal data, packed sequences.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame,
which is written as Parquet and read again for the next one. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import exact_dedup, jaccard_join, language_id, packing, pii
from corpusloom.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; dictionaries come from the labelled ones among them."""
    model = language_id.fit(docs)
    taken = language_id.identify(docs, model, "text", prediction="__lang", score="__score", rejected="__no")
    return taken.where(~F.col("__no")).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal ones."""
    return exact_dedup.drop_exact_duplicates(docs).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.drop_near_duplicates(docs).select(*docs.columns)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced."""
    return pii.redact(docs, pii.fit(docs)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences of 1,024 tokens."""
    folder = os.environ.get("TOKENIZER_DIR")
    name = "byte_bpe_50k.json"
    tokenizer = os.path.join(folder, name) if folder else public_tokenizers.path(name)
    # the pieces are written and moved once with ids as short as they can be
    width = packing.id_width(*packing.read_vocabulary(tokenizer))
    return packing.widened(packing.pack(packing.token_pieces(docs, tokenizer, width=width)), width)


# (name, function), in order
STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("pii", personal),
    ("packing", packed),
]

# compression, span classification and packing have no SQL; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
