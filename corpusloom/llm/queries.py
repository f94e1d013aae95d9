"""The numbered operators as queries over whole tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    exact_dedup,
    jaccard_join,
    language_id,
    language_model,
    lexicon,
    neighbours,
    packing,
    pii,
    quality_rules,
    sharding,
    spelling_variants,
    suffix_dedup,
    token_alignment,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _crc_of_id(col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary"))


def _tokenizer(name: str) -> str:
    """Where a public tokenizer's file is, unless TOKENIZER_DIR names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


@_query()
def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, _tokenizer("byte_bpe_50k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@_query()
def op2_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.join_documents(_table(spark, sf, "documents").select("doc_id", "text"))


@_query()
def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Eight equal shards by key, and the shard with a ninth one added."""
    binary = F.col("text").cast("binary")
    docs = _table(spark, sf, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(binary, F.lit(b""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        sharding.rendezvous(["doc_id"], dict.fromkeys(range(9), 1.0)).alias("grown_shard"),
    )
    placed = sharding.assign_shards(docs, ["doc_id"], dict.fromkeys(range(8), 1.0))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@_query(
    r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY points DESC, doc_id)
"""
)
def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    digest = F.sha2(exact_dedup.squeezed("text").cast("binary"), 256)
    return exact_dedup.exact_groups(docs.withColumn("text_sha256", digest), carry=["text_sha256"])


@_query()
def op5_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.fit(docs)).select("doc_id", "base_spans", "spans")

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.joined("base_spans").cast("binary"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


@_query()
def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of 50 words or more that other documents hold, as ``start:end`` in words."""
    found = suffix_dedup.repeated_spans(_table(spark, sf, "documents").select("doc_id", "text"))
    place = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id",
        F.size("spans").cast("long").alias("n_spans"),
        "repeated_words",
        F.array_join(place, ",").alias("spans"),
    )


@_query()
def op7_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    train = F.coalesce(_crc_of_id() % 7 != 2, F.lit(True))
    model = language_model.train(docs.where(train))
    scored = language_model.score(docs, model, train)
    return scored.select(
        "doc_id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@_query()
def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionaries from three quarters of the labelled documents, predictions for all."""
    docs = _table(spark, sf, "documents").select(
        "doc_id", "text", "lang", (F.coalesce(_crc_of_id() % 4 == 2, F.lit(False))).alias("held_out")
    )
    model = language_id.fit(docs.where(~F.col("held_out")))
    found = language_id.identify(docs.select("doc_id", "text", "held_out"), model)
    return found.select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), "rejected"
    )


@_query()
def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    vocabulary = lexicon.Vocabulary.read(_tokenizer("word_bpe_49k.json"))
    compiled = lexicon.lexicon_of(lexicon.frequent_words(docs, vocabulary), vocabulary)
    coded = lexicon.encode_documents(docs, vocabulary, compiled)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query()
def op10_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, F.col("vec_id") % 50 == 0)


def _sql_fences() -> str:
    """Fences of each language and source, read from counts of the leading bits of each measure."""
    bits = quality_rules.PRECISION
    least = " ".join(f"WHEN '{m}' THEN {v}" for m, v in quality_rules.SLACK.items())
    levels = []
    for depth, by in ((2, "lang, source"), (1, "lang"), (0, "")):
        names = f"{by}," if by else ""
        enough = quality_rules.MIN_GROUP if depth else 0
        levels.append(f"""
cum{depth} AS (SELECT {names} measure, bucket, sum(n) OVER (PARTITION BY {names} measure ORDER BY bucket) AS upto,
  sum(n) OVER (PARTITION BY {names} measure) AS total
  FROM (SELECT {names} measure, bucket, sum(n) AS n FROM sketch GROUP BY {names} measure, bucket)),
q{depth} AS (SELECT {names} measure, max(total) AS total,
  min(CASE WHEN upto >= (total * {quality_rules.OUTER} + 999) // 1000 THEN bucket END) AS low,
  min(CASE WHEN upto >= (total * 500 + 999) // 1000 THEN bucket END) AS mid,
  min(CASE WHEN upto >= (total * {1000 - quality_rules.OUTER} + 999) // 1000 THEN bucket END) AS high
  FROM cum{depth} GROUP BY {names} measure),
f{depth} AS (SELECT {names} measure,
  low - {quality_rules.REACH} * greatest(mid - low, CASE measure {least} END) AS lo,
  high + {quality_rules.REACH} * greatest(high - mid, CASE measure {least} END) AS hi
  FROM q{depth} WHERE total >= {enough}),""")
    return f"""
sketch AS (SELECT lang, source, measure, CASE WHEN length(bin(v)) <= {bits} THEN v
    ELSE v - v % (1::BIGINT << (length(bin(v)) - {bits})) END AS bucket, count(*) AS n
  FROM measures WHERE v IS NOT NULL GROUP BY ALL),
{"".join(levels)}
fence AS (SELECT s.lang, s.source, s.measure, CASE WHEN a.measure IS NOT NULL THEN a.lo
    WHEN b.measure IS NOT NULL THEN b.lo ELSE c.lo END AS lo, CASE WHEN a.measure IS NOT NULL THEN a.hi
    WHEN b.measure IS NOT NULL THEN b.hi ELSE c.hi END AS hi
  FROM (SELECT DISTINCT lang, source, measure FROM sketch) s
  LEFT JOIN f2 a ON a.lang IS NOT DISTINCT FROM s.lang AND a.source IS NOT DISTINCT FROM s.source
    AND a.measure = s.measure
  LEFT JOIN f1 b ON b.lang IS NOT DISTINCT FROM s.lang AND b.measure = s.measure
  JOIN f0 c ON c.measure = s.measure)"""


@_query(
    rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS i, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT i, regexp_extract_all(t, '[^ 	-
]+') AS w FROM d),
places AS (SELECT i, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS run
  FROM (SELECT i, w, unnest(generate_series(1, len(w) - 2)) AS p FROM w WHERE len(w) > 2)),
again AS (SELECT i, p FROM (SELECT i, p, count(*) OVER (PARTITION BY i, run) AS times FROM places)
  WHERE times > 1),
covered AS (SELECT i, count(DISTINCT q) AS n FROM (SELECT i, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY i),
lines AS (SELECT i, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS x FROM d),
counts AS MATERIALIZED (SELECT d.i, doc_id, lang, source, len(w) AS n_words,
  length(regexp_replace(t, '[ 	-
]', '', 'g')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(x) - len(list_distinct(x)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(x) AS n_lines
  FROM d JOIN w ON w.i = d.i JOIN lines ON lines.i = d.i LEFT JOIN covered ON covered.i = d.i),
measures AS MATERIALIZED (SELECT i, lang, source, unnest(['word_length', 'symbol_share', 'dup_share', 'repeat_share'])
    AS measure, unnest([word_chars * 100 // n_words, n_symbols * 10000 // word_chars,
    n_dup_lines * 10000 // n_lines, n_repeat_words * 10000 // n_words]) AS v FROM counts WHERE n_words > 0),
{_sql_fences()},
outside AS (SELECT i, count(*) AS n FROM measures m JOIN fence f ON f.lang IS NOT DISTINCT FROM m.lang
    AND f.source IS NOT DISTINCT FROM m.source AND f.measure = m.measure
  WHERE v > hi OR v < lo AND m.measure = 'word_length' GROUP BY i)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND outside.n IS NULL AS kept
FROM counts LEFT JOIN outside ON outside.i = counts.i
"""
)
def op11_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Every document judged by the fences of its language and source."""
    judged = quality_rules.judge(_table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    counts = [c for c in quality_rules.COUNTS if c != "n_lines"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


@_query()
def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    groups = F.col("groups")
    digest = F.when(groups == "", F.lit("")).otherwise(F.sha2(groups.cast("binary"), 256))
    return token_alignment.align(
        _table(spark, sf, "documents").select("doc_id", "text"),
        _tokenizer("byte_bpe_50k.json"),
        _tokenizer("piece_bpe_32k.model"),
        outputs={"groups_sha256": digest},
    )


@_query()
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return spelling_variants.spelling_groups(spelling_variants.word_counts(docs))
