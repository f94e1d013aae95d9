"""Registered queries and, where SQL can say the same, their DuckDB counterparts.

Every query runs over whole tables. ``documents`` joined with ``labels`` stands for the labelled corpus,
neighbouring turns of ``conversations`` for text pairs, ``events`` for a training log, ``embeddings`` for
scores and vectors. Token ids are lengths of pre-tokens where only their shape matters.
"""

from __future__ import annotations

import importlib.util
import re
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pyarrow as pa  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corpusloom.functions import arrays, numbers, porter, text  # noqa: E402
from corpusloom.operators import (  # noqa: E402
    batching,
    bpe,
    callbacks,
    classifier,
    encode,
    export,
    fit,
    metrics,
    ordering,
    results,
    rouge,
    sampling,
    tables,
    traininglog,
    wer,
)
from corpusloom.plans import labeled, speech, summaries  # noqa: E402
from corpusloom.session import scratch_path, spread  # noqa: E402
from corpusloom.sources import labeled as labeled_source  # noqa: E402
from corpusloom.sources import tabular  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return register


# --- the given tables in the roles the operators need -----------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for work on their text."""
    return spread(_table(spark, sf, "documents").select("doc_id", "text"))


def _labeled(spark: SparkSession, sf: str, documents=None) -> DataFrame:
    labels = _table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    if documents is None:
        documents = _table(spark, sf, "documents").select("doc_id", "text")
    return documents.join(labels, "doc_id")


def _labeled_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The same for work on the text."""
    return _labeled(spark, sf, _texts(spark, sf))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("summary"))
    return spread(turns).withColumnRenamed("text", "article").join(following, ["conv_id", "turn"])


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """A step log: one of the values is present in each record."""
    events = _table(spark, sf, "events")
    keyed = [
        F.when(F.col("event_type") == kind, F.col("value")).alias(key)
        for kind, key in (("click", "loss"), ("view", "eval_loss"), ("purchase", "eval_wer"))
    ]
    return events.select(F.col("event_id").alias("step"), *keyed)


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    """A step log with a loss at every step, 1,000 steps to an epoch."""
    return _table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 1000).alias("epoch"),
        F.col("event_id").alias("step"),
        F.col("value").alias("loss"),
    )


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    tokens = text.pretokenize("text")
    return _texts(spark, sf).select(
        "doc_id", F.transform(tokens, lambda t: F.length(t)).alias("ids")
    )


def _joined(col: Column | str) -> Column:
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


_LABELED = (
    "lab AS (SELECT d.doc_id, d.text, l.quality AS label "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
)
_PAIRS = (
    "pairs AS (SELECT a.conv_id, a.turn, a.text AS article, b.text AS summary FROM conversations a "
    "JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"
)
_LOG = (
    "log AS (SELECT event_id AS step, CASE WHEN event_type = 'click' THEN value END AS loss, "
    "CASE WHEN event_type = 'view' THEN value END AS eval_loss, "
    "CASE WHEN event_type = 'purchase' THEN value END AS eval_wer FROM events)"
)
_STEPS = (
    "steps AS (SELECT CAST(floor(event_id / 1000) AS BIGINT) AS epoch, event_id AS step, "
    "value AS loss FROM events)"
)
_TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]+"


def _sql_tokens(col: str) -> str:
    return f"regexp_extract_all({col}, '{_TOKEN}')"


_IDS = (
    f"ids AS (SELECT doc_id, list_transform({_sql_tokens('text')}, lambda t: length(t)) AS ids "
    "FROM documents)"
)


def _sql_joined(col: str) -> str:
    return f"coalesce(array_to_string({col}, ','), '')"


def _sql_rank(key: str, seed: int = 42) -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}:' || {key}), {key})"


def _sql_split(first: str, second: str, rank: str = "rank") -> str:
    return (
        f"CASE WHEN {rank} <= {first} THEN 'train' WHEN {rank} <= {second} THEN 'validation' "
        "ELSE 'test' END"
    )


_CUT_1 = "floor(0.95::DOUBLE * n)"
_CUT_2 = "floor(0.975::DOUBLE * n)"
_SPLIT = (
    f"{_LABELED}, ranked AS (SELECT *, {_sql_rank('doc_id')} AS rank, count(*) OVER () AS n FROM lab), "
    f"parts AS (SELECT doc_id, text, label, {_sql_split(_CUT_1, _CUT_2)} AS split FROM ranked)"
)


def _split(spark: SparkSession, sf: str, rows=_labeled) -> DataFrame:
    return sampling.ratio_split(rows(spark, sf), ["doc_id"])


# --- flagship ---------------------------------------------------------------------------------------

_BALANCED = (
    f"{_LABELED}, bal AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label "
    "ORDER BY md5('42:' || doc_id), doc_id) AS r FROM lab) WHERE r <= 500), "
    f"ranked AS (SELECT *, {_sql_rank('doc_id')} AS rank, count(*) OVER () AS n FROM bal), "
    f"parts AS (SELECT doc_id, text, label, {_sql_split(_CUT_1, _CUT_2)} AS split FROM ranked)"
)


@_query(
    f"""
WITH {_BALANCED},
toks AS (SELECT split, label, {_sql_tokens('text')} AS tokens FROM parts),
sizes AS (
  SELECT split, label, count(*) AS rows, CAST(sum(len(tokens)) AS BIGINT) AS words,
    CAST(trunc(quantile_cont(len(tokens), 0.95)) AS INTEGER) AS p95_words
  FROM toks GROUP BY split, label),
uniq AS (
  SELECT split, label, count(DISTINCT word) AS distinct_words
  FROM (SELECT split, label, unnest(tokens) AS word FROM toks) GROUP BY split, label)
SELECT s.split, s.label, rows, words, p95_words, distinct_words
FROM sizes s JOIN uniq u ON s.split = u.split AND s.label = u.label
"""
)
def split_word_report(spark: SparkSession, sf: str) -> DataFrame:
    """Balanced sample, ratio split, words per split and class."""
    return labeled.split_word_report(_labeled_texts(spark, sf), ["doc_id"], "text", "label", 500)


# --- sampling, shuffling, splitting -----------------------------------------------------------------


@_query(f"SELECT doc_id, {_sql_rank('doc_id')} AS rank FROM documents")
def shuffle_rank(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.shuffle_rank(_table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@_query(f"SELECT doc_id, {_sql_rank('doc_id', 45)} AS rank FROM documents")
def epoch_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """The order of the fourth epoch: seed plus epoch."""
    docs = _table(spark, sf, "documents").select("doc_id")
    return ordering.shuffle_rank(docs, ["doc_id"], seed=42 + 3)


@_query(
    f"WITH {_LABELED} SELECT doc_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label "
    "ORDER BY md5('42:' || doc_id), doc_id) AS r FROM lab) WHERE r <= 40"
)
def balanced_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labeled(spark, sf).select("doc_id", "label")
    return sampling.balanced_sample(rows, "label", 40, ["doc_id"])


@_query(f"WITH {_SPLIT} SELECT doc_id, split FROM parts")
def ratio_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("doc_id", "split")


_SECOND_CUT = "floor(0.9::DOUBLE * n) + floor(((1 - 0.9::DOUBLE) / 2) * n)"


@_query(
    f"WITH {_LABELED}, ranked AS (SELECT *, {_sql_rank('doc_id')} AS rank, count(*) OVER () AS n "
    f"FROM lab) SELECT doc_id, {_sql_split('floor(0.9::DOUBLE * n)', _SECOND_CUT)} AS split FROM ranked"
)
def resplit(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labeled(spark, sf).select("doc_id")
    return sampling.resplit(rows, ["doc_id"], train_ratio=0.9)


@_query(
    f"WITH {_LABELED}, sized AS (SELECT count(*) AS n FROM lab), "
    "cuts AS (SELECT n, CAST(floor(0.9::DOUBLE * n) AS BIGINT) AS a, "
    f"CAST({_SECOND_CUT} AS BIGINT) AS b FROM sized) "
    "SELECT 'train' AS part, a AS rows FROM cuts UNION ALL SELECT 'validation', b - a FROM cuts "
    "UNION ALL SELECT 'test', n - b FROM cuts UNION ALL "
    "SELECT md5(text) || ':' || label, count(*) FROM lab GROUP BY ALL"
)
def resplit_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a key, copies among them, from the CSV files of three splits: sizes of the new splits,
    and how often they hold each row."""
    path = scratch_path(spark, "pool")
    tabular.write_splits_csv(_split(spark, sf), path, ["text", "label"])
    folders = [f"{path}/split={s}" for s in sampling.SPLITS] + [f"{path}/missing"]
    rows = labeled.resplit_pool(spark, folders, train_ratio=0.9)
    sizes = rows.groupBy(F.col("split").alias("part")).agg(F.count("*").alias("rows"))
    row = F.concat_ws(":", F.md5("text"), F.col("label").cast("string"))
    return sizes.unionByName(rows.groupBy(row.alias("part")).agg(F.count("*").alias("rows")))


@_query(
    f"WITH {_SPLIT} SELECT split, label, count(*) AS rows, "
    "round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM parts), 6) AS percent "
    "FROM parts GROUP BY split, label"
)
def split_report(spark: SparkSession, sf: str) -> DataFrame:
    report = sampling.split_report(_split(spark, sf), ["split", "label"])
    return report.withColumn("percent", F.round("percent", 6))


# --- sources and sinks ------------------------------------------------------------------------------


@_query(
    "SELECT text AS article, 'train' AS split FROM documents UNION ALL "
    "SELECT text, 'test' FROM benchmark"
)
def read_splits(spark: SparkSession, sf: str) -> DataFrame:
    paths = {"train": f"{sf}/documents.parquet", "test": f"{sf}/benchmark.parquet"}
    return tabular.read_splits(spark, paths, {"text": "article"})


@_query(f"WITH {_SPLIT} SELECT doc_id, label, split, md5(text) AS text_md5 FROM parts")
def csv_splits(spark: SparkSession, sf: str) -> DataFrame:
    """CSV splits written and read again, one of the wanted folders missing."""
    path = scratch_path(spark, "csv-splits")
    tabular.write_splits_csv(_split(spark, sf), path, ["doc_id", "text", "label"])
    schema = "doc_id bigint, text string, label int"
    parts = {
        s: tabular.read_union(spark, [f"{path}/split={s}", f"{path}/missing"], schema)
        for s in sampling.SPLITS
    }
    return tabular.union_splits(parts).select(
        "doc_id", "label", "split", F.md5("text").alias("text_md5")
    )


@_query(
    "SELECT doc_id, md5(coalesce(text, '')) AS text_md5 FROM documents "
    "WHERE source = 'src0' OR source LIKE 'src1_' OR source IN ('src4', 'src5', 'src6')"
)
def included_files(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files of those folders that include patterns name; patterns that match nothing are passed over."""
    path = scratch_path(spark, "sources")
    docs = _table(spark, sf, "documents").select("doc_id", "text", "source")
    tabular.write_splits_csv(docs, path, ["doc_id", "text"], split="source")
    patterns = ["source=src0", "source=src1?", "source=src[4-6]", "source=none*"]
    rows = tabular.read_union(spark, [f"{path}/{p}" for p in patterns], "doc_id bigint, text string")
    return rows.select("doc_id", F.md5("text").alias("text_md5"))


@_query(f"WITH {_SPLIT} SELECT doc_id, label, md5(text) AS text_md5 FROM parts WHERE split = 'test'")
def saved_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """One split of a saved dataset; the other splits' folders are not read."""
    path = scratch_path(spark, "dataset")
    tabular.write_dataset(_split(spark, sf), path)
    test = tabular.read_dataset(spark, path, "test")
    return test.select("doc_id", "label", F.md5("text").alias("text_md5"))


@_query(
    f"WITH {_LABELED} SELECT label, CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'test' END AS subset, "
    "md5(text) AS text_md5 FROM lab"
)
def labeled_dirs(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents laid out as one file each in class folders, then scanned."""
    root = scratch_path(spark, "reviews")
    folder = F.concat_ws(
        "/",
        F.when(F.col("doc_id") % 2 == 0, "train").otherwise("test"),
        F.when(F.col("label") == 1, "pos").otherwise("neg"),
    )
    # a file ends with a separator: one that no text holds, cut off below
    labeled_source.write_labeled_dirs(
        _labeled_texts(spark, sf).withColumn("folder", folder),
        root,
        ["train/pos", "train/neg", "test/pos", "test/neg"],
        end="\x1d",
    )
    scanned = labeled_source.read_labeled_dirs(spark, root)
    whole = F.regexp_replace("text", "\x1d$", "")
    return scanned.select("label", "subset", F.md5(whole).alias("text_md5"))


@_query(
    f"WITH {_SPLIT} SELECT 25000 AS num_samples_per_class, count(*) AS total_samples, "
    "count(*) FILTER (split = 'train') AS train_samples, "
    "count(*) FILTER (split = 'validation') AS val_samples, "
    "count(*) FILTER (split = 'test') AS test_samples, "
    f"max(len({_sql_tokens('text')}) + 2) AS max_length, 0 AS pad_token_id FROM parts"
)
def metadata_record(spark: SparkSession, sf: str) -> DataFrame:
    """The metadata record, written as JSON and read again."""
    rows = _split(spark, sf).withColumn("length", arrays.token_count(text.pretokenize("text"), True))
    record = results.build_metadata(rows, {"num_samples_per_class": 25_000, "pad_token_id": 0})
    longest = rows.agg(F.max("length").cast("bigint")).scalar()
    path = scratch_path(spark, "metadata")
    tabular.write_record(record.withColumn("max_length", longest), path)
    schema = (
        "num_samples_per_class int, total_samples bigint, train_samples bigint, val_samples bigint, "
        "test_samples bigint, max_length bigint, pad_token_id int"
    )
    return tabular.read_record(spark, path, schema)


@_query(f"WITH {_PAIRS} SELECT unnest([article, summary]) AS value FROM pairs")
def corpus_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tables.corpus_lines(_pairs(spark, sf), ["article", "summary"])


@_query(f"WITH {_LOG} SELECT step, loss, eval_loss, eval_wer FROM log")
def log_history(spark: SparkSession, sf: str) -> DataFrame:
    """Step records written as JSON arrays of up to 1,000, absent keys left out, and read again."""
    path = scratch_path(spark, "log")
    record = F.struct("step", "loss", "eval_loss", "eval_wer")
    arrays_of = (
        _log(spark, sf)
        .groupBy(F.floor(F.col("step") / 1000))
        .agg(F.to_json(F.collect_list(record)).alias("value"))
    )
    arrays_of.select("value").write.text(path)
    return tabular.read_log_history(spark, path, multi_line=False)


@_query(
    f"WITH {_STEPS} SELECT (SELECT count(*) FROM steps) AS total_steps, 'sgd' AS kind, "
    "epoch AS steps, round(avg(loss), 6) AS losses FROM steps GROUP BY epoch"
)
def results_record(spark: SparkSession, sf: str) -> DataFrame:
    """A nested results record and its history table, written, read again and laid out flat."""
    log = _steps(spark, sf)
    epochs = traininglog.epoch_mean(log, "epoch", "loss")
    parts = traininglog.history(epochs, "epoch", ["mean_loss"])
    total = log.agg(F.count("*").alias("total_steps")).withColumn("kind", F.lit("sgd"))
    record = results.results_record(
        total.select("total_steps"),
        nested={"architecture": {"kind": F.lit("sgd")}},
    )
    path = scratch_path(spark, "results")
    tabular.write_record(record, f"{path}/record")
    tabular.write_record(parts, f"{path}/history")
    saved = tabular.read_record(
        spark, f"{path}/record", "total_steps bigint, architecture struct<kind:string>"
    )
    history = tabular.read_record(
        spark, f"{path}/history", "part bigint, steps array<bigint>, mean_loss array<double>"
    )
    points = history.select(F.inline(F.arrays_zip("steps", "mean_loss")))
    total_steps = saved.select(F.struct("total_steps", "architecture.kind").alias("r")).scalar()
    return points.withColumn("r", total_steps).select(
        "r.total_steps", "r.kind", "steps", F.round("mean_loss", 6).alias("losses")
    )


# --- projections, filters, limits -------------------------------------------------------------------


@_query("SELECT doc_id AS id, CAST(n_chars AS DOUBLE) AS input_length, lang FROM documents")
def select_columns(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").withColumn("n_chars", F.col("n_chars").cast("double"))
    renamed = docs.withColumnsRenamed({"doc_id": "id", "n_chars": "input_length"})
    return tables.keep_columns(renamed, ["id", "input_length", "lang", "labels"])


@_query(
    "SELECT doc_id, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 0 END AS code FROM documents"
)
def label_codes(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return docs.select("doc_id", text.map_label("lang", {"en": 1, "fr": 0}).alias("code"))


@_query(
    "SELECT doc_id, '/vol/audio/' || replace(CASE lang WHEN 'fr' THEN 'akan (fante)' ELSE lang END, "
    "'akan (fante)', 'akan-fante') || '/' || CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'dev' END || "
    "'/data/data/intron/' || source || '/' || doc_id || '.wav' AS audio FROM documents"
)
def media_paths(spark: SparkSession, sf: str) -> DataFrame:
    manifest = _table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "fr", "akan (fante)").otherwise(F.col("lang")).alias("accent"),
        F.when(F.col("doc_id") % 2 == 0, "train").otherwise("dev").alias("split"),
        F.concat_ws("/", F.lit("/data/set"), "source", F.concat("doc_id", F.lit(".wav"))).alias(
            "audio_paths"
        ),
    )
    return manifest.select("doc_id", text.rewrite_media_path("/vol/audio").alias("audio"))


@_query("SELECT doc_id FROM documents WHERE n_chars > 0 AND n_chars < 1200")
def input_length_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return tables.filter_length(docs, "n_chars", 0, 1200).select("doc_id")


@_query(f"SELECT doc_id FROM documents WHERE len({_sql_tokens('text')}) < 448")
def label_length_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    count = arrays.token_count(text.pretokenize("text"))
    return tables.filter_length(docs, count, None, tables.MAX_LABEL_LENGTH).select("doc_id")


@_query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 300")
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return ordering.head_n(docs, 300, ["doc_id"])


@_query("SELECT lang, count(*) AS rows FROM documents WHERE lang = 'de' GROUP BY lang")
def class_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.filter_rows(_table(spark, sf, "documents"), lambda c: c == "de", ["lang"])
    return docs.groupBy("lang").agg(F.count("*").alias("rows"))


@_query(
    f"WITH {_PAIRS} SELECT conv_id, turn, substr(article, 1, 200) || '...' AS article, "
    "summary AS reference FROM pairs ORDER BY conv_id, turn LIMIT 5"
)
def example_rows(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"article": "article", "summary": "reference"}
    return tables.examples(_pairs(spark, sf), 5, ["conv_id", "turn"], columns, {"article": 200})


@_query(
    "SELECT doc_id, length(text) AS chars, upper(lang) AS lang FROM documents"
)
def mapped_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A Python row function; the scan reads the columns it names only."""
    return tables.map_rows(
        _table(spark, sf, "documents"),
        lambda row: {
            "doc_id": row["doc_id"],
            "chars": len(row["text"]),
            "lang": row["lang"].upper(),
        },
        "doc_id bigint, chars bigint, lang string",
        ["doc_id", "text", "lang"],
    )


# --- text -------------------------------------------------------------------------------------------

_SQL_CLEAN = r"trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]', '', 'g'), '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g'))"


@_query(f"SELECT doc_id, md5({_SQL_CLEAN.format('text')}) AS clean_md5 FROM documents")
def clean_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    docs = _texts(spark, sf)
    return docs.select("doc_id", F.md5(text.clean_transcript("text")).alias("clean_md5"))


_SQL_SPELLED = """
small AS (SELECT i, CASE WHEN i < 20 THEN u[i + 1] ELSE t[i // 10 - 1] ||
    CASE WHEN i % 10 > 0 THEN '-' || u[i % 10 + 1] ELSE '' END END AS w
  FROM (SELECT string_split('zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen', ' ') AS u,
    string_split('twenty thirty forty fifty sixty seventy eighty ninety', ' ') AS t), range(100) r(i)),
big AS (SELECT h * 100 + s.i AS i, CASE WHEN h = 0 THEN s.w ELSE d.w || ' hundred' ||
    CASE WHEN s.i > 0 THEN ' and ' || s.w ELSE '' END END AS w
  FROM range(10) r(h) JOIN small d ON d.i = h, small s),
spell AS (SELECT list(w ORDER BY i) AS k,
  string_split(' thousand million billion trillion quadrillion quintillion sextillion septillion octillion nonillion decillion', ' ') AS z
  FROM big)
"""


def _sql_spell(digits: str) -> str:
    """Words of a numeral; ``k`` and ``z`` are in scope."""
    d = f"CASE WHEN ltrim({digits}, '0') = '' THEN '0' ELSE ltrim({digits}, '0') END"
    groups = (
        f"list_transform([{d}], lambda d: list_transform(range((length(d) + 2) // 3), lambda i: "
        "CAST(substr(lpad(d, CAST(((length(d) + 2) // 3) * 3 AS INTEGER), '0'), CAST(i * 3 + 1 AS INT), 3) AS INT)))[1]"
    )
    named = (
        f"list_transform([{groups}], lambda g: list_filter(list_transform(g, lambda v, i: "
        "CASE WHEN v > 0 THEN k[v + 1] || CASE WHEN len(g) - i > 0 THEN ' ' || z[len(g) - i + 1] "
        "ELSE '' END END), lambda w: w IS NOT NULL))[1]"
    )
    last = f"CAST(right({d}, 3) AS INT)"
    return (
        f"list_transform([{named}], lambda w: CASE WHEN len(w) = 0 THEN 'zero' WHEN len(w) = 1 THEN w[1] "
        f"ELSE array_to_string(w[1:len(w) - 1], ', ') || CASE WHEN {last} BETWEEN 1 AND 99 "
        "THEN ' and ' ELSE ', ' END || w[len(w)] END)[1]"
    )


_W = r"[\p{L}\p{N}_]"
_SQL_DECIMALS = (
    rf"array_to_string(list_transform(regexp_extract_all(text, '[\p{{N}}]+\.{_W}+|{_W}+|[^\p{{L}}\p{{N}}_]+'), "
    rf"lambda p: CASE WHEN regexp_full_match(p, '[0-9]{{1,36}}\.[0-9]+') THEN {_sql_spell(chr(39).join(['split_part(p, ', '.', ', 1)']))} || ' point ' || "
    "array_to_string(list_transform(string_split(split_part(p, '.', 2), ''), lambda c: k[CAST(c AS INT) + 1]), ' ') "
    "ELSE p END), '')"
)
_SQL_INTEGERS = (
    rf"array_to_string(list_transform(regexp_extract_all(text, '{_W}+|[^\p{{L}}\p{{N}}_]+'), "
    rf"lambda p: CASE WHEN regexp_full_match(p, '[0-9]{{1,36}}') THEN {_sql_spell('p')} ELSE p END), '')"
)


@_query(
    f"""
WITH {_SQL_SPELLED},
dec AS (SELECT doc_id, k, z, {_SQL_DECIMALS} AS text FROM documents, spell),
ints AS (SELECT doc_id, {_SQL_INTEGERS} AS text FROM dec)
SELECT doc_id, md5({_SQL_CLEAN.format('text')}) AS transcript_md5 FROM ints
"""
)
def normalized_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers to words, then the cleaning. The given documents hold no ordinals, which SQL leaves out."""
    docs = _texts(spark, sf)
    return docs.select(
        "doc_id", F.md5(speech.normalize_transcript("text")).alias("transcript_md5")
    )


# fixed values: cardinals whose ordinal is not the word and "th"
_IRREGULAR = {
    "one": "first",
    "two": "second",
    "three": "third",
    "five": "fifth",
    "eight": "eighth",
    "nine": "ninth",
    "twelve": "twelfth",
}
_SQL_ORDINAL = (
    "CASE "
    + " ".join(
        f"WHEN regexp_extract(w, '[a-z]+$') = '{c}' THEN regexp_replace(w, '[a-z]+$', '{o}')"
        for c, o in _IRREGULAR.items()
    )
    + " WHEN w LIKE '%y' THEN regexp_replace(w, 'y$', 'ieth') ELSE w || 'th' END"
)


@_query(
    f"""
WITH {_SQL_SPELLED},
numbered AS (SELECT event_id, k, z, CAST(event_id % 130 AS VARCHAR) AS a,
  CAST((event_id * 7919) % 5000000 AS VARCHAR) AS b,
  (['st', 'nd', 'rd', 'th'])[CAST(event_id % 4 + 1 AS INT)] AS e FROM events, spell),
spelled AS (SELECT event_id, a, e, {_sql_spell('a')} AS wa, {_sql_spell('b')} AS wb FROM numbered)
SELECT event_id, 'the ' || (SELECT {_SQL_ORDINAL} FROM (SELECT wa AS w)) || ' and ' ||
  (SELECT {_SQL_ORDINAL} FROM (SELECT wb AS w)) || ', not ' || a || upper(e) || ' or x' || a || e AS text
FROM spelled
"""
)
def ordinal_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinals of all endings; upper-case endings and parts of words stay."""
    a = (F.col("event_id") % 130).cast("string")
    b = (F.col("event_id") * 7_919 % 5_000_000).cast("string")
    e = F.get(F.array(*[F.lit(x) for x in ("st", "nd", "rd", "th")]), (F.col("event_id") % 4).cast("int"))
    said = F.concat(
        F.lit("the "), a, e, F.lit(" and "), b, e, F.lit(", not "), a, F.upper(e), F.lit(" or x"), a, e
    )
    return _table(spark, sf, "events").select("event_id", numbers.ordinals_to_words(said).alias("text"))


@_query(
    f"SELECT doc_id, len({_sql_tokens('text')}) AS tokens, "
    f"md5(coalesce(array_to_string({_sql_tokens('text')}, ' '), '')) AS tokens_md5 FROM documents"
)
def pretokens(spark: SparkSession, sf: str) -> DataFrame:
    tokens = text.pretokenize("text")
    return _texts(spark, sf).select(
        "doc_id",
        F.size(tokens).cast("bigint").alias("tokens"),
        F.md5(F.array_join(tokens, " ")).alias("tokens_md5"),
    )


# --- tokenizer --------------------------------------------------------------------------------------

_MERGES = 40  # merges the tokenizer queries train: enough to build words, few enough to unroll in SQL
_TOKENIZERS: dict[tuple[str, str], bpe.BpeTokenizer] = {}


def _trained(key: tuple[str, str], texts: DataFrame, columns: list[str], specials) -> bpe.BpeTokenizer:
    """Trained once per corpus and data folder, since several queries start from it."""
    if key not in _TOKENIZERS:
        counts = bpe.word_counts(texts, columns).persist()
        characters = counts.select(F.explode(F.split("word", ""))).distinct().count()
        size = len(specials) + characters + _MERGES
        _TOKENIZERS[key] = bpe.train_bpe(counts, size, specials)
        counts.unpersist()
    return _TOKENIZERS[key]


def _tokenizer(spark: SparkSession, sf: str) -> bpe.BpeTokenizer:
    texts = _texts(spark, sf)
    return _trained((sf, "documents"), texts, ["text"], bpe.CLASSIFIER_SPECIALS)


def _pair_tokenizer(spark: SparkSession, sf: str) -> bpe.BpeTokenizer:
    columns = ["article", "summary"]
    return _trained((sf, "pairs"), _pairs(spark, sf), columns, bpe.SEQ2SEQ_SPECIALS)


def _sql_bpe(
    final: str,
    source: str = "documents",
    texts: str = "text",
    specials: tuple[str, ...] = bpe.CLASSIFIER_SPECIALS,
    before: str = "",
) -> str:
    """Training, one merge after another; a symbol stands between two spaces of its own."""
    steps = [
        f"""
WITH {before} wc AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (SELECT unnest({_sql_tokens(texts)}) AS word FROM {source}) GROUP BY word),
alphabet AS MATERIALIZED (
  SELECT {list(specials)} || list(c ORDER BY ord(c)) AS v
  FROM (SELECT DISTINCT unnest(string_split(word, '')) AS c FROM wc)),
s0 AS MATERIALIZED (
  SELECT word, n, ' ' || array_to_string(string_split(word, ''), '  ') || ' ' AS s FROM wc),
v0 AS MATERIALIZED (SELECT v FROM alphabet)"""
    ]
    for k in range(1, _MERGES + 1):
        steps.append(
            f"""
m{k} AS MATERIALIZED (
  SELECT l, r FROM (
    SELECT l, r, sum(n) AS c FROM (
      SELECT n, unnest(list_zip(t[1:len(t) - 1], t[2:len(t)])) AS p, p[1] AS l, p[2] AS r
      FROM (SELECT n, string_split(substr(s, 2, length(s) - 2), '  ') AS t FROM s{k - 1}) WHERE len(t) > 1)
    GROUP BY l, r), v{k - 1}
  ORDER BY c DESC, list_position(v, l), list_position(v, r) LIMIT 1),
s{k} AS MATERIALIZED (
  SELECT word, n, replace(s, ' ' || l || '  ' || r || ' ', ' ' || l || r || ' ') AS s FROM s{k - 1}, m{k}),
v{k} AS MATERIALIZED (SELECT CASE WHEN list_contains(v, l || r) THEN v ELSE v || [l || r] END AS v
  FROM v{k - 1}, m{k})"""
        )
    return ",".join(steps) + final.replace("{last}", str(_MERGES))


def _sql_encoded(name: str, source: str, key: str, col: str) -> str:
    """CTE ``name``: per key the token count, the ids and the tokens of a text, without specials."""
    return f"""
, {name}_words AS (SELECT {key} AS key, unnest({_sql_tokens(col)}) AS word,
  generate_subscripts({_sql_tokens(col)}, 1) AS place FROM {source}),
{name}_seg AS (SELECT word, string_split(substr(s, 2, length(s) - 2), '  ') AS t FROM s{_MERGES}),
{name}_coded AS (SELECT word, t, list_transform(t, lambda x: list_position(v, x) - 1) AS ids
  FROM {name}_seg, v{_MERGES}),
{name} AS (SELECT w.key, sum(len(ids)) AS tokens, flatten(list(ids ORDER BY place)) AS ids,
  flatten(list(t ORDER BY place)) AS spoken
  FROM {name}_words w JOIN {name}_coded c ON w.word = c.word GROUP BY w.key)"""


_SQL_DOC = _sql_encoded("doc", "documents", "doc_id", "text")


@_query(
    "SELECT word, count(*) AS n FROM (SELECT unnest("
    + _sql_tokens("text")
    + ") AS word FROM documents) GROUP BY word"
)
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.word_counts(_texts(spark, sf), ["text"])


@_query(
    _sql_bpe(
        " SELECT rank, l AS \"left\", r AS \"right\", l || r AS new_token FROM ("
        + " UNION ALL ".join(f"SELECT {k - 1} AS rank, l, r FROM m{k}" for k in range(1, _MERGES + 1))
        + ")"
    )
)
def bpe_merges(spark: SparkSession, sf: str) -> DataFrame:
    return _tokenizer(spark, sf).merges_table(spark)


@_query(
    _sql_bpe(
        " SELECT unnest(v) AS token, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS id FROM v{last}"
    )
)
def bpe_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return _tokenizer(spark, sf).vocab_table(spark)


@_query(
    _sql_bpe(
        _SQL_DOC
        + " SELECT doc_id, CAST(coalesce(tokens, 0) + 2 AS BIGINT) AS tokens, "
        "md5(array_to_string([2] || coalesce(ids, []) || [3], ',')) AS ids_md5 "
        "FROM documents LEFT JOIN doc ON doc_id = key"
    )
)
def encoded_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = _texts(spark, sf)
    ids = encode.encode(docs, "text", _tokenizer(spark, sf))
    return ids.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("tokens"),
        F.md5(_joined("input_ids")).alias("ids_md5"),
    )


@_query(
    _sql_bpe(
        _SQL_DOC
        + " SELECT doc_id, md5(coalesce(array_to_string(spoken, ' '), '')) AS text_md5 "
        "FROM documents LEFT JOIN doc ON doc_id = key"
    )
)
def decoded_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded with the template, decoded without the specials."""
    tokenizer = _tokenizer(spark, sf)
    docs = _texts(spark, sf)
    ids = encode.encode(docs, "text", tokenizer)
    return ids.select("doc_id", F.md5(encode.decode_column("input_ids", tokenizer)).alias("text_md5"))


@_query(
    _sql_bpe(
        _SQL_DOC
        + " SELECT CAST(max(coalesce(tokens, 0)) + 2 AS INTEGER) AS max_length "
        "FROM documents LEFT JOIN doc ON doc_id = key"
    )
)
def max_token_length(spark: SparkSession, sf: str) -> DataFrame:
    return encode.max_token_length(_texts(spark, sf), "text", _tokenizer(spark, sf))


@_query(
    _sql_bpe(
        ", listed AS (SELECT unnest(v) AS token, unnest(range(len(v))) AS id FROM v{last}) "
        "SELECT token, id FROM listed WHERE token IN ('[PAD]', '[UNK]', '[CLS]', '[SEP]', 'e', 'n', 'en', 'er', 'th')"
    )
)
def special_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of the special tokens, and of a few others, looked up in the trained vocabulary."""
    tokenizer = _tokenizer(spark, sf)
    wanted = [*tokenizer.specials, "e", "n", "en", "er", "th"]
    return tokenizer.vocab_table(spark).where(F.col("token").isin(*wanted))


_SQL_PAIR_TOKENS = (
    _sql_encoded("src", "keyed", "key", "article") + _sql_encoded("tgt", "keyed", "key", "summary")
)
_SQL_KEYED = (
    f"{_PAIRS}, keyed AS (SELECT conv_id || ':' || turn AS key, conv_id, turn, article, summary FROM pairs)"
)


def _sql_pair_bpe(final: str) -> str:
    texts = "SELECT article AS text FROM pairs UNION ALL SELECT summary FROM pairs"
    return _sql_bpe(
        _SQL_PAIR_TOKENS + final,
        source="texts",
        specials=bpe.SEQ2SEQ_SPECIALS,
        before=f"{_SQL_KEYED}, texts AS ({texts}),",
    )


def _sql_side(ids: str, n: int) -> str:
    wrapped = f"([2] || ([2] || coalesce({ids}, []) || [3])[1:{n - 2}] || [3])"
    return f"array_to_string(({wrapped} || list_transform(range({n}), lambda i: 0))[1:{n}], ',')"


@_query(
    _sql_pair_bpe(
        f" SELECT conv_id, turn, {_sql_side('src.ids', 64)} AS src, {_sql_side('tgt.ids', 48)} AS tgt "
        "FROM keyed LEFT JOIN src ON src.key = keyed.key LEFT JOIN tgt ON tgt.key = keyed.key"
    )
)
def encoded_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-length source and target ids of text pairs, specials doubled."""
    tokenizer = _pair_tokenizer(spark, sf)
    rows = encode.encode_pairs(_pairs(spark, sf), "article", "summary", 64, 48, tokenizer)
    return rows.select("conv_id", "turn", _joined("src").alias("src"), _joined("tgt").alias("tgt"))


@_query(
    _sql_bpe(
        _SQL_DOC
        + f""", {_SPLIT} SELECT 25000 AS num_samples_per_class, count(*) AS total_samples,
count(*) FILTER (split = 'train') AS train_samples, count(*) FILTER (split = 'validation') AS val_samples,
count(*) FILTER (split = 'test') AS test_samples, (SELECT CAST(len(v) AS INTEGER) FROM v{{last}}) AS vocab_size,
CAST(max(coalesce(tokens, 0)) + 2 AS INTEGER) AS max_length, 0 AS pad_token_id, 2 AS cls_token_id,
3 AS sep_token_id, 1 AS unk_token_id FROM parts LEFT JOIN doc ON doc_id = key"""
    )
)
def prepared_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Balance, split, encode and fit to the longest text: the metadata record."""
    prepared = labeled.prepare_labeled_corpus(
        _labeled_texts(spark, sf), ["doc_id"], 25_000, tokenizer=_tokenizer(spark, sf)
    )
    return prepared.metadata


_SQL_P95 = "CAST(trunc(quantile_cont(coalesce({0}.tokens, 0) + 2, 0.95)) AS INTEGER)"


@_query(
    _sql_pair_bpe(
        f""", ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || key), conv_id, turn) AS rank,
  count(*) OVER () AS n FROM keyed),
sizes AS (SELECT count(*) FILTER (rank <= {_CUT_1}) AS train_samples,
  count(*) FILTER (rank > {_CUT_1} AND rank <= {_CUT_2}) AS val_samples,
  count(*) FILTER (rank > {_CUT_2}) AS test_samples FROM ranked),
lens AS (SELECT {_SQL_P95.format('src')} AS max_src_len, {_SQL_P95.format('tgt')} AS max_tgt_len
  FROM keyed k
  LEFT JOIN src ON src.key = k.key LEFT JOIN tgt ON tgt.key = k.key)
SELECT CAST((SELECT len(v) FROM v{{last}}) AS INTEGER) AS vocab_size, max_src_len, max_tgt_len, train_samples, val_samples, test_samples,
0 AS pad_token_id, 2 AS bos_token_id, 3 AS eos_token_id, 1 AS unk_token_id FROM lens, sizes"""
    )
)
def prepared_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Percentile lengths and ratio split of text pairs: the metadata record."""
    pairs, tokenizer = _pairs(spark, sf), _pair_tokenizer(spark, sf)
    return summaries.prepare_pairs(pairs, ["conv_id", "turn"], tokenizer=tokenizer).metadata


@_query(
    _sql_pair_bpe(
        " SELECT rank, l AS \"left\", r AS \"right\", l || r AS new_token FROM ("
        + " UNION ALL ".join(f"SELECT {k - 1} AS rank, l, r FROM m{k}" for k in range(1, _MERGES + 1))
        + ")"
    )
)
def pair_merges(spark: SparkSession, sf: str) -> DataFrame:
    """Training on both sides of the pairs, with the other set of specials."""
    return _pair_tokenizer(spark, sf).merges_table(spark)


@_query(
    f"WITH {_PAIRS} SELECT CAST(trunc(quantile_cont(len({_sql_tokens('article')}) + 2, 0.95)) AS INTEGER) "
    f"AS max_src_len, CAST(trunc(quantile_cont(len({_sql_tokens('summary')}) + 2, 0.95)) AS INTEGER) "
    "AS max_tgt_len FROM pairs"
)
def length_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    lengths = {
        "max_src_len": arrays.token_count(text.pretokenize("article"), specials=True),
        "max_tgt_len": arrays.token_count(text.pretokenize("summary"), specials=True),
    }
    return encode.length_percentiles(_pairs(spark, sf), lengths, 0.95)


# --- fixed shapes and batches -----------------------------------------------------------------------


@_query(
    f"WITH {_IDS}, wrapped AS (SELECT doc_id, [2] || ids || [3] AS w FROM ids), "
    "cut AS (SELECT doc_id, w, CASE WHEN len(w) > 128 THEN w[1:127] || [3] ELSE w END AS c FROM wrapped) "
    f"SELECT doc_id, {_sql_joined('c || list_transform(range(128 - len(c)), lambda i: 0)')} AS input_ids, "
    "CAST(len(c) AS INTEGER) AS kept FROM cut"
)
def fixed_length(spark: SparkSession, sf: str) -> DataFrame:
    wrapped = _ids(spark, sf).withColumn("w", arrays.wrap_ids("ids", 2, 3))
    mask = arrays.attention_mask("w", 128)
    return wrapped.select(
        "doc_id",
        _joined(arrays.fit_length("w", 128, 0, 3)).alias("input_ids"),
        F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("kept"),
    )


@_query(
    f"WITH {_IDS}, wrapped AS (SELECT doc_id, [2] || ([2] || ids || [3])[1:62] || [3] AS w FROM ids), "
    "src AS (SELECT doc_id, (w || list_transform(range(64 - len(w)), lambda i: 0))[1:64] AS s FROM wrapped) "
    f"SELECT doc_id, {_sql_joined('s')} AS src, {_sql_joined('s[1:63]')} AS tgt_input, "
    f"{_sql_joined('s[2:64]')} AS tgt_output FROM src"
)
def pair_shape(spark: SparkSession, sf: str) -> DataFrame:
    """A wrapped sequence cut, wrapped again and padded; decoder input and target from it."""
    wrapped = arrays.wrap_ids("ids", 2, 3)
    src = _ids(spark, sf).select("doc_id", arrays.seq_pair_side(wrapped, 64, 2, 3, 0).alias("s"))
    return src.select(
        "doc_id",
        _joined("s").alias("src"),
        _joined(arrays.decoder_input("s")).alias("tgt_input"),
        _joined(arrays.decoder_target("s")).alias("tgt_output"),
    )


_BATCHED = f"SELECT doc_id, {_sql_rank('doc_id')} AS rank, count(*) OVER () AS n FROM documents"


@_query(
    f"SELECT doc_id, (rank - 1) // 48 AS batch_id FROM ({_BATCHED}) WHERE (rank - 1) // 48 < n // 48"
)
def train_batches(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id")
    ranked = ordering.shuffle_rank(docs, ["doc_id"])
    return batching.assign_batches(ranked, 48, drop_last=True, base=docs).select("doc_id", "batch_id")


@_query(_SQL["train_batches"])
def exported_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches written as files with a manifest, read to a batch and gone on with from there."""
    docs = _table(spark, sf, "documents").select("doc_id")
    path = scratch_path(spark, "batches")
    ranked = ordering.shuffle_rank(docs, ["doc_id"])
    export.export_batches(ranked, path, 48, batches_per_file=4, drop_last=True, base=docs)
    half = export.read_manifest(spark, path).agg(F.max("last_batch")).first()[0] or 0
    parts = export.read_batches(spark, path, 0, half // 2), export.read_batches(spark, path, half // 2)
    return parts[0].unionByName(parts[1]).select("doc_id", "batch_id")


@_query(
    f"SELECT doc_id, (rank - 1) // 48 AS batch_id FROM ({_BATCHED}) WHERE (rank - 1) // 48 < 5"
)
def first_eval_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A partial evaluation's rows; the last batch may be short."""
    docs = _table(spark, sf, "documents").select("doc_id")
    return batching.first_shuffled_batches(docs, 5, 48, ["doc_id"]).select("doc_id", "batch_id")


@_query(
    f"WITH r AS (SELECT doc_id, n_chars, {_sql_rank('doc_id')} AS rank FROM documents), "
    "m AS (SELECT *, (rank - 1) // 200 AS mega FROM r), "
    "p AS (SELECT *, mega * 200 + row_number() OVER (PARTITION BY mega ORDER BY n_chars DESC, rank) - 1 "
    "AS place FROM m), "
    "top AS (SELECT mega * 200 AS peak FROM m ORDER BY n_chars DESC, mega LIMIT 1), "
    "q AS (SELECT doc_id, CASE WHEN place = 0 THEN peak WHEN place = peak THEN 0 ELSE place END AS position "
    "FROM p, top) SELECT doc_id, CAST(position AS BIGINT) AS position, position // 4 AS batch_id FROM q"
)
def length_grouped_batches(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "n_chars")
    return batching.length_grouped_batches(docs, "n_chars", 4, ["doc_id"]).drop("n_chars")


@_query(
    f"WITH {_IDS}, b AS (SELECT doc_id, ids, doc_id // 16 AS batch_id FROM ids), "
    "w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest, "
    "bool_and(coalesce(ids[1] = 2, false)) OVER (PARTITION BY batch_id) AS shared FROM b), "
    "l AS (SELECT doc_id, batch_id, shared, ids || list_transform(range(longest - len(ids)), lambda i: -100) AS x "
    f"FROM w) SELECT doc_id, batch_id, md5({_sql_joined('CASE WHEN shared THEN x[2:] ELSE x END')}) AS labels_md5, "
    f"md5({_sql_joined('list_transform(CASE WHEN shared THEN x[2:] ELSE x END, lambda v: CASE WHEN v = -100 THEN 0 ELSE v END)')}) "
    "AS restored_md5 FROM l"
)
def collated_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels padded to their batch, padding ignored, a shared first id cut; then unmasked."""
    batches = _ids(spark, sf).withColumn("batch_id", F.floor(F.col("doc_id") / 16))
    collated = batching.collate_labels(batches, "ids", 0, bos=2)
    return collated.select(
        "doc_id",
        "batch_id",
        F.md5(_joined("ids")).alias("labels_md5"),
        F.md5(_joined(arrays.unmask_labels("ids", 0))).alias("restored_md5"),
    )


def _padding_collator(bos: int):
    """Labels of one batch padded to the longest, padding ignored, a first id that all share cut off."""
    ignored = arrays.IGNORED_LABEL

    def collator(rows: pa.Table) -> pa.Table:
        labels = rows.column("ids").to_pylist()
        longest = max(map(len, labels))
        cut = int(all(x[:1] == [bos] for x in labels))
        padded = [(x + [ignored] * (longest - len(x)))[cut:] for x in labels]
        place = rows.schema.get_field_index("ids")
        return rows.set_column(place, "ids", pa.array(padded, pa.list_(pa.int32())))

    return collator


@_query(_SQL["collated_labels"])
def callback_collated_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a Python collator that gets each batch at once."""
    batches = _ids(spark, sf).withColumn("batch_id", F.floor(F.col("doc_id") / 16))
    collated = callbacks.collate(batches, _padding_collator(2), batches.schema, order=["doc_id"])
    return collated.select(
        "doc_id",
        "batch_id",
        F.md5(_joined("ids")).alias("labels_md5"),
        F.md5(_joined(arrays.unmask_labels("ids", 0))).alias("restored_md5"),
    )


@_query(
    f"WITH {_LABELED} SELECT count(*) // 32 AS steps_per_epoch, (count(*) // 32) * 3 AS total_steps FROM lab"
)
def step_plan(spark: SparkSession, sf: str) -> DataFrame:
    return batching.step_plan(_labeled(spark, sf), 32, 3)


# --- metrics ----------------------------------------------------------------------------------------

_SQL_SCORED = (
    "scored AS (SELECT vec_id, label, z, list_position(z, list_max(z)) - 1 AS prediction, "
    "list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[label + 1] AS loss "
    "FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS z FROM embeddings))"
)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").select(
        "vec_id",
        "label",
        arrays.argmax("embedding").alias("prediction"),
        arrays.cross_entropy("embedding", "label").alias("loss"),
    )


@_query(
    f"WITH {_SQL_SCORED} SELECT vec_id, CAST(prediction AS INTEGER) AS prediction, "
    "round(loss, 6) AS loss FROM scored"
)
def row_losses(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("vec_id", "prediction", F.round("loss", 6).alias("loss"))


@_query(
    f"WITH {_SQL_SCORED} SELECT label, round(avg(loss), 6) AS loss, "
    "round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, "
    "count(*) AS samples FROM scored GROUP BY label"
)
def evaluation_report(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.evaluate_table(
        _scored(spark, sf),
        {
            "loss": F.round(metrics.mean_loss("loss"), 6),
            "accuracy": F.round(metrics.accuracy("prediction", "label"), 6),
            "samples": F.count("*"),
        },
        by=["label"],
    )
    return report


@_query(
    "SELECT round(avg(b), 6) AS loss, count(*) AS batches FROM (SELECT avg(value) AS b FROM events "
    "WHERE user_id <> 7 GROUP BY event_id // 32)"
)
def masked_token_loss(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events").withColumn("batch", F.floor(F.col("event_id") / 32))
    loss = metrics.masked_mean_of_means(events, "batch", "value", "user_id", 7)
    return loss.withColumn("loss", F.round("loss", 6))


def _flat(pooled: DataFrame) -> DataFrame:
    return pooled.select("label", F.posexplode("embedding").alias("dim", "x")).select(
        "label", "dim", F.round(F.col("x").cast("double"), 6).alias("x")
    )


@_query(
    "SELECT label, CAST(dim - 1 AS INTEGER) AS dim, round(avg(x), 6) AS x FROM (SELECT label, "
    "unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) "
    "GROUP BY label, dim"
)
def mean_pooling(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return _flat(metrics.pool_vectors(vectors, "label", "vec_id", "embedding", "mean"))


@_query(
    "SELECT label, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS dim, round(unnest(e), 6) AS x FROM ("
    "SELECT label, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS e FROM embeddings GROUP BY label)"
)
def first_pooling(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return _flat(metrics.pool_vectors(vectors, "label", "vec_id", "embedding", "cls"))


@_query(
    f"WITH {_IDS} SELECT doc_id, md5({_sql_joined('list_filter(ids, lambda x, i: (i = 1 OR ids[i - 1] <> x) AND x <> 2)')}) "
    "AS ids_md5 FROM ids"
)
def ctc_collapse(spark: SparkSession, sf: str) -> DataFrame:
    ids = _ids(spark, sf)
    return ids.select("doc_id", F.md5(_joined(arrays.ctc_collapse("ids", 2))).alias("ids_md5"))


def _sql_diagonals(a: str, b: str, cell: str, edge_a: str, edge_b: str, source: str) -> str:
    """Dynamic programming over two word lists, one anti-diagonal of the table per round.

    ``prev[i + 1]`` and ``prev2[i + 1]`` are row i of the two diagonals before. ``cell`` computes row i
    on diagonal d from ``up`` (i-1, j), ``side`` (i, j-1), ``both`` (i-1, j-1) and ``same``.
    """
    up, side, both = "prev[i]", "prev[i + 1]", "prev2[i]"
    same = "a[i] = b[d + 1 - i]"
    body = cell.format(up=up, side=side, both=both, same=same)
    return f"""
base AS (SELECT key, {a} AS a, {b} AS b FROM {source}),
walk AS (
  SELECT key, a, b, 0 AS d, CAST([0] AS BIGINT[]) AS prev, CAST([0] AS BIGINT[]) AS prev2 FROM base
  UNION ALL
  SELECT key, a, b, d + 1, list_transform(range(0, len(a) + 1), lambda i: CAST(
      CASE WHEN i > d + 1 OR d + 1 - i > len(b) THEN 0
           WHEN i = 0 THEN {edge_b.format(n='(d + 1)')}
           WHEN i = d + 1 THEN {edge_a.format(n='(d + 1)')}
           ELSE {body} END AS BIGINT)), prev
  FROM walk WHERE d < len(a) + len(b)),
done AS (SELECT key, a, b, prev[len(a) + 1] AS value FROM walk WHERE d = len(a) + len(b))"""


def _sql_words(col: str) -> str:
    one_space = rf"regexp_replace({col}, '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]{{2,}}', ' ', 'g')"
    return f"list_filter(string_split(trim({one_space}, E' \\n\\t\\r'), ' '), lambda w: w <> '')"


_SQL_EDITS = _sql_diagonals(
    _sql_words("article"),
    _sql_words("summary"),
    "least({up} + 1, {side} + 1, {both} + CASE WHEN {same} THEN 0 ELSE 1 END)",
    "{n}",
    "{n}",
    "keyed",
)


@_query(
    f"WITH RECURSIVE {_SQL_KEYED}, {_SQL_EDITS} SELECT conv_id, turn, value AS edits, "
    "CAST(len(a) AS BIGINT) AS ref_words FROM done JOIN keyed ON done.key = keyed.key"
)
def word_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = wer.word_errors(_pairs(spark, sf), "article", "summary")
    return rows.select("conv_id", "turn", "edits", "ref_words")


@_query(
    f"WITH RECURSIVE {_SQL_KEYED}, {_SQL_EDITS} SELECT round(sum(value) * 100.0::DOUBLE / sum(len(a)), 6) AS wer, "
    "CAST(sum(value) AS BIGINT) AS edits, CAST(sum(len(a)) AS BIGINT) AS ref_words, "
    "count(*) AS num_samples FROM done"
)
def word_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = wer.wer(_pairs(spark, sf), "article", "summary")
    return rate.withColumn("wer", F.round("wer", 6))


def _error_rate() -> callbacks.Metric:
    """Word error rate in plain Python: edits, reference words and rows are added up."""

    def edits(reference: list[str], hypothesis: list[str]) -> int:
        row = list(range(len(hypothesis) + 1))
        for i, word in enumerate(reference, 1):
            corner, row[0] = row[0], i
            for j, other in enumerate(hypothesis, 1):
                corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (word != other))
        return row[-1]

    def words(text: str) -> list[str]:
        # runs of white space are a space; single line breaks stay inside a word
        return [w for w in re.sub(r"\s{2,}", " ", text).strip().split(" ") if w]

    def update(state: list[int], rows: pa.Table) -> list[int]:
        for reference, hypothesis in zip(*[rows.column(c).to_pylist() for c in ("article", "summary")]):
            said = words(reference)
            state = [state[0] + edits(said, words(hypothesis)), state[1] + len(said), state[2] + 1]
        return state

    def finish(state: list[int]) -> dict:
        rate = round(state[0] * 100.0 / state[1], 6) if state[1] else None
        return {"wer": rate, "edits": state[0], "ref_words": state[1], "num_samples": state[2]}

    return callbacks.Metric(
        start=lambda: [0, 0, 0],
        update=update,
        merge=lambda a, b: [x + y for x, y in zip(a, b)],
        finish=finish,
        schema="wer double, edits bigint, ref_words bigint, num_samples bigint",
    )


def _sql_spelled(ids: str) -> str:
    """Ids as words: 5 stands between words, others are letters."""
    letters = f"list_transform({ids}, lambda x: CASE WHEN x = 5 THEN ' ' ELSE chr(CAST(97 + x % 26 AS INT)) END)"
    return f"trim(regexp_replace(coalesce(array_to_string({letters}, ''), ''), ' +', ' ', 'g'))"


_SQL_CTC = (
    f"WITH {_IDS}, heard AS (SELECT doc_id, list_filter(ids, lambda x, i: (i = 1 OR ids[i - 1] <> x) AND x <> 2) AS p, "
    "list_filter(ids, lambda x: x <> 2) AS r FROM ids), "
    f"said AS (SELECT doc_id, {_sql_spelled('r')} AS reference, {_sql_spelled('p')} AS prediction FROM heard) "
    "SELECT doc_id, md5(reference) AS reference_md5, md5(prediction) AS prediction_md5, "
    "len(list_filter(string_split(reference, ' '), lambda w: w <> '')) AS ref_words FROM said"
)


@_query(_SQL_CTC)
def ctc_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Labels unmasked and spelled without grouping, predictions collapsed and spelled, then compared."""
    ids = _ids(spark, sf)
    masked = ids.select("doc_id", arrays.mask_labels(F.concat("ids", F.array(F.lit(2), F.lit(2))), F.size("ids")).alias("labels"), "ids")
    scored = speech.score_ctc(
        masked,
        predictions="ids",
        labels="labels",
        blank=2,
        spell=lambda x: F.when(x == 5, F.lit(" ")).otherwise(F.char(F.lit(97) + x % 26)),
    )
    return scored.select(
        "doc_id", F.md5("reference").alias("reference_md5"), F.md5("prediction").alias("prediction_md5"), "ref_words"
    )


@_query("SELECT doc_id, n_chars FROM documents WHERE length(text) % 3 = 0 AND lang <> 'de'")
def filtered_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a Python predicate of two columns keeps, called with a series of each."""
    docs = _table(spark, sf, "documents").select("doc_id", "n_chars", "text", "lang")
    kept = tables.filter_batches(
        docs, lambda text, lang: (text.str.len() % 3 == 0) & (lang != "de"), ["text", "lang"]
    )
    return kept.select("doc_id", "n_chars")


@_query(_SQL["word_error_rate"])
def callback_word_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a Python metric with states that are merged."""
    return callbacks.evaluate(_pairs(spark, sf), _error_rate(), ["article", "summary"])


def _sql_rouge_n(n: int) -> str:
    grams = "t" if n == 1 else "list_transform(list_zip(t[1:len(t) - 1], t[2:len(t)]), lambda p: p[1] || ' ' || p[2])"
    side = (
        "SELECT conv_id, turn, g, count(*) AS c FROM (SELECT conv_id, turn, unnest(" + grams + ") AS g FROM "
        "(SELECT conv_id, turn, regexp_extract_all(lower({0}), '[a-z0-9]+') AS t FROM pairs)) GROUP BY ALL"
    )
    size = f"greatest(len(regexp_extract_all(lower({{0}}), '[a-z0-9]+')) - {n - 1}, 0)"
    return f"""
r{n} AS ({side.format('article')}), h{n} AS ({side.format('summary')}),
o{n} AS (SELECT r.conv_id, r.turn, sum(least(r.c, h.c)) AS hits FROM r{n} r JOIN h{n} h
  ON r.conv_id = h.conv_id AND r.turn = h.turn AND r.g = h.g GROUP BY ALL),
f{n} AS (SELECT p.conv_id, p.turn, CASE WHEN hits > 0 THEN 2.0::DOUBLE * (hits / {size.format('summary')}::DOUBLE)
  * (hits / {size.format('article')}::DOUBLE) / (hits / {size.format('summary')}::DOUBLE + hits / {size.format('article')}::DOUBLE)
  ELSE 0.0 END AS f FROM pairs p LEFT JOIN o{n} o ON p.conv_id = o.conv_id AND p.turn = o.turn)"""


_SQL_LCS = _sql_diagonals(
    "regexp_extract_all(lower(article), '[a-z0-9]+')",
    "regexp_extract_all(lower(summary), '[a-z0-9]+')",
    "CASE WHEN {same} THEN {both} + 1 ELSE greatest({up}, {side}) END",
    "0",
    "0",
    "keyed",
)
_SQL_ROUGE = (
    f"WITH RECURSIVE {_SQL_KEYED}, {_sql_rouge_n(1)}, {_sql_rouge_n(2)}, {_SQL_LCS}, "
    "fl AS (SELECT conv_id, turn, CASE WHEN value > 0 THEN 2.0::DOUBLE * value / (len(a) + len(b)) "
    "ELSE 0.0 END AS f FROM done JOIN keyed ON done.key = keyed.key), "
    "rows AS (SELECT f1.conv_id, f1.turn, f1.f AS rouge1, f2.f AS rouge2, fl.f AS rougeL FROM f1 "
    "JOIN f2 ON f1.conv_id = f2.conv_id AND f1.turn = f2.turn "
    "JOIN fl ON f1.conv_id = fl.conv_id AND f1.turn = fl.turn)"
)


@_query(
    _SQL_ROUGE
    + " SELECT conv_id, turn, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, "
    'round(rougeL, 6) AS "rougeL" FROM rows'
)
def rouge_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Summary scores without stemming."""
    scored = rouge.rouge_scores(_pairs(spark, sf), "article", "summary", stem=False)
    kinds = [F.round(k, 6).alias(k) for k in ("rouge1", "rouge2", "rougeL")]
    return scored.select("conv_id", "turn", *kinds)


@_query(
    _SQL_ROUGE
    + " SELECT count(*) AS num_samples, round(avg(rouge1), 6) AS rouge1, round(avg(rouge2), 6) AS rouge2, "
    'round(avg(rougeL), 6) AS "rougeL" FROM rows'
)
def rouge_report(spark: SparkSession, sf: str) -> DataFrame:
    report = rouge.rouge_report(
        rouge.rouge_scores(_pairs(spark, sf), "article", "summary", stem=False)
    )
    return report.select(
        "num_samples", *[F.round(k, 6).alias(k) for k in ("rouge1", "rouge2", "rougeL")]
    )


def _sql_stems(tokens: str) -> str:
    """CTEs ``stems(token, stem)``: the suffix rules over a table of tokens, one step after another.

    ``p`` is a word's shape, V and C for each letter: a y is a vowel after a consonant. The shape of a word's
    head is the head of its shape, and its measure the number of VC in it.
    """

    def shaped(name: str, source: str) -> str:
        found = "regexp_replace(regexp_replace(w, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
        for _ in range(5):  # of each run of y the first that is left
            found = f"replace(replace(regexp_replace({found}, '^y', 'C'), 'Cy', 'CV'), 'Vy', 'VC')"
        return f"{name} AS MATERIALIZED (SELECT token, w, {found} AS p FROM {source})"

    def head(cut: int | str, of: str = "w") -> str:
        return f"left({of}, length(w) - {cut})"

    def measure(cut: int | str) -> str:
        shape = head(cut, "p")
        return f"(length({shape}) - length(replace({shape}, 'VC', ''))) // 2"

    def short(stem: str, shape: str) -> str:
        return f"({shape} = 'VC' OR {shape} LIKE '%CVC' AND right({stem}, 1) NOT IN ('w', 'x', 'y'))"

    def table(rules) -> str:
        cases = " ".join(
            f"WHEN w LIKE '%{old}' THEN CASE WHEN {measure(len(old))} > 0 THEN {head(len(old))} || '{new}' ELSE w END"
            for old, new in rules
        )
        return f"CASE {cases} ELSE w END"

    ending = " ".join(
        f"WHEN w LIKE '%{x}' THEN CASE WHEN {measure(len(x))} > 1"
        + (f" AND right({head(3)}, 1) IN ('s', 't')" if x == "ion" else "")
        + f" THEN {head(len(x))} ELSE w END"
        for x in porter.STEP_4
    )
    odd = ", ".join(f"('{a}', '{b}')" for a, b in porter.IRREGULAR.items())
    ed = "CASE WHEN w LIKE '%ed' THEN 2 ELSE 3 END"
    return f"""
odd(token, stem) AS (VALUES {odd}),
e0 AS (SELECT DISTINCT token, token AS w FROM ({tokens})
  WHERE length(token) > {rouge.UNSTEMMED_LENGTH} AND token NOT IN (SELECT token FROM odd)),
e1 AS (SELECT token, CASE WHEN w LIKE '%ies' THEN CASE WHEN length(w) = 4 THEN {head(1)} ELSE {head(2)} END
  WHEN w LIKE '%sses' THEN {head(2)} WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN {head(1)} ELSE w END AS w FROM e0),
{shaped('e1p', 'e1')},
e2 AS (SELECT token, w, p, CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {head(1)} ELSE {head(2)} END
  WHEN w LIKE '%eed' THEN CASE WHEN {measure(3)} > 0 THEN {head(1)} ELSE w END END AS done,
  CASE WHEN (w LIKE '%ed' OR w LIKE '%ing') AND contains({head(ed, 'p')}, 'V') THEN {head(ed)} END AS x,
  {head(ed, 'p')} AS xp, {measure(ed)} AS m FROM e1p),
e3 AS (SELECT token, CASE WHEN done IS NOT NULL THEN done WHEN x IS NULL THEN w
  WHEN x LIKE '%at' OR x LIKE '%bl' OR x LIKE '%iz' THEN x || 'e'
  WHEN length(x) > 1 AND right(x, 1) = left(right(x, 2), 1) AND right(xp, 1) = 'C'
    THEN CASE WHEN right(x, 1) IN ('l', 's', 'z') THEN x ELSE left(x, length(x) - 1) END
  WHEN m = 1 AND {short('x', 'xp')} THEN x || 'e' ELSE x END AS w FROM e2),
{shaped('e3p', 'e3')},
e4 AS (SELECT token, CASE WHEN w LIKE '%y' AND length(w) > 2 AND right({head(1, 'p')}, 1) = 'C'
  THEN {head(1)} || 'i' ELSE w END AS w FROM e3p),
{shaped('e4p', 'e4')},
e5 AS (SELECT token, CASE WHEN w LIKE '%alli' AND {measure(4)} > 0 THEN {head(2)} ELSE w END AS w FROM e4p),
{shaped('e5p', 'e5')},
e6 AS (SELECT token, CASE WHEN w LIKE '%logi' THEN CASE WHEN {measure(3)} > 0 THEN {head(1)} ELSE w END
  ELSE {table(porter.STEP_2)} END AS w FROM e5p),
{shaped('e6p', 'e6')},
e7 AS (SELECT token, {table(porter.STEP_3)} AS w FROM e6p),
{shaped('e7p', 'e7')},
e8 AS (SELECT token, CASE {ending} ELSE w END AS w FROM e7p),
{shaped('e8p', 'e8')},
e9 AS (SELECT token, CASE WHEN w LIKE '%e' AND ({measure(1)} > 1 OR {measure(1)} = 1 AND NOT
  {short(head(1), head(1, 'p'))}) THEN {head(1)} ELSE w END AS w FROM e8p),
{shaped('e9p', 'e9')},
stems AS MATERIALIZED (
  SELECT token, CASE WHEN w LIKE '%ll' AND {measure(1)} > 1 THEN {head(1)} ELSE w END AS stem FROM e9p
  UNION ALL SELECT token, stem FROM odd)"""


def _sql_stemmed_pairs() -> str:
    """CTE ``pairs``: both texts as their stems."""
    tokens = "regexp_extract_all(lower({0}), '[a-z0-9]+')"
    sides = ", ".join(
        f"(SELECT coalesce(string_agg(coalesce(stem, t), ' ' ORDER BY i), '') FROM (SELECT unnest({tokens.format(c)}) AS t, "
        f"generate_subscripts({tokens.format(c)}, 1) AS i) LEFT JOIN stems ON stems.token = t) AS {c}"
        for c in ("article", "summary")
    )
    every = " UNION ALL ".join(f"SELECT unnest({tokens.format(c)}) AS token FROM given" for c in ("article", "summary"))
    given = _PAIRS.replace("pairs AS", "given AS", 1)
    return f"{given}, {_sql_stems(every)}, pairs AS MATERIALIZED (SELECT conv_id, turn, {sides} FROM given)"


@_query(
    _SQL_ROUGE.replace(_PAIRS, _sql_stemmed_pairs(), 1)
    + " SELECT conv_id, turn, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, "
    'round(rougeL, 6) AS "rougeL" FROM rows'
)
def rouge_stemmed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Summary scores of stems; the SQL applies the suffix rules to shapes of words."""
    scored = rouge.rouge_scores(_pairs(spark, sf), "article", "summary", stem=True)
    kinds = [F.round(k, 6).alias(k) for k in ("rouge1", "rouge2", "rougeL")]
    return scored.select("conv_id", "turn", *kinds)


@_query()
def rouge_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    """The summary results record: stemmed scores and the first examples."""
    rows = _pairs(spark, sf).withColumnRenamed("summary", "hypothesis")
    rows = rows.withColumn("reference", F.col("article"))
    record = summaries.score_summaries(rows, ["conv_id", "turn"], num_samples=None)
    return record.withColumn("examples", F.to_json("examples"))


@_query(
    f"WITH RECURSIVE {_SQL_KEYED}, {_SQL_EDITS}, rate AS (SELECT round(sum(value) * 100.0::DOUBLE / "
    "sum(len(a)), 6) AS test_wer, count(*) AS num_samples FROM done) "
    "SELECT test_wer, num_samples, article AS reference, summary AS prediction FROM rate, "
    "(SELECT * FROM pairs ORDER BY conv_id, turn LIMIT 20)"
)
def transcript_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The speech results record with its first examples, laid out flat."""
    record = speech.score_transcripts(_pairs(spark, sf), ["conv_id", "turn"], "article", "summary")
    return record.select(
        F.round("test_wer", 6).alias("test_wer"), "num_samples", F.inline("examples")
    )


@_query()
def text_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """A linear classifier fitted on the train split, reported for every split."""
    return labeled.train_and_report(_split(spark, sf, _labeled_texts))


@_query(f"WITH {_SPLIT} SELECT split, count(*) AS samples FROM parts GROUP BY split")
def classifier_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per split as the classifier's report counts them."""
    rows = _split(spark, sf, _labeled_texts)
    model = classifier.fit_text_classifier(rows.where(F.col("split") == "train"), iterations=2)
    report = classifier.classification_report(classifier.score(model, rows))
    return report.select("split", "samples")


_FIT = fit.FitOptions(features=1 << 12, batch_size=64, epochs=2, evaluate_every=20)


@_query(
    f"WITH {_SPLIT}, n AS (SELECT count(*) FILTER (split = 'train') AS n FROM parts), "
    f"steps AS (SELECT n, unnest(generate_series(1, CAST(ceil(n / {_FIT.batch_size}) AS BIGINT) * {_FIT.epochs})) AS step, "
    f"CAST(ceil(n / {_FIT.batch_size}) AS BIGINT) AS per_epoch FROM n) "
    f"SELECT step, (step - 1) // per_epoch AS epoch, CASE WHEN step % per_epoch = 0 AND n % {_FIT.batch_size} > 0 "
    f"THEN n % {_FIT.batch_size} ELSE {_FIT.batch_size} END AS rows, "
    f"step % {_FIT.evaluate_every} = 0 OR step = per_epoch * {_FIT.epochs} AS evaluated FROM steps"
)
def classifier_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Pool, split, fit and log: the steps that a fit takes, the rows of each and where it evaluates.

    The fit is stopped half way and gone on with from its written state.
    """
    rows = _split(spark, sf, _labeled_texts)
    train, held_out = (rows.where(F.col("split") == s) for s in ("train", "validation"))
    path = scratch_path(spark, "fit")
    fit.fit_steps(train, held_out, ["doc_id"], path, options=_FIT, stop_after=_FIT.evaluate_every + 5)
    log = fit.fit_steps(train, held_out, ["doc_id"], path, options=_FIT).log
    return log.select("step", "epoch", "rows", F.col("eval_accuracy").isNotNull().alias("evaluated"))


@_query()
def classifier_history(spark: SparkSession, sf: str) -> DataFrame:
    """Loss and evaluations of every step, the best step, and the report of its state for each split."""
    rows = _split(spark, sf, _labeled_texts)
    trained = labeled.train_with_history(rows, ["doc_id"], scratch_path(spark, "fit"), options=_FIT)
    record = trained.record.select(F.struct("best_step", "test_accuracy", "test_loss").alias("r")).scalar()
    points = F.arrays_zip("steps", "epoch", "loss", "running_mean", "eval_loss", "eval_accuracy")
    return trained.history.select(F.inline(points)).withColumn("r", record).select("*", "r.*").drop("r")


# --- training log -----------------------------------------------------------------------------------


@_query(f"WITH {_STEPS} SELECT step, loss FROM steps WHERE step % 50 = 0")
def every_n_steps(spark: SparkSession, sf: str) -> DataFrame:
    return traininglog.every_n(_steps(spark, sf), "step", 50).select("step", "loss")


@_query(
    f"WITH {_STEPS} SELECT epoch, step, round(avg(loss) OVER (PARTITION BY epoch ORDER BY step "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1e-9, 6) AS running_mean FROM steps"
)
def running_epoch_mean(spark: SparkSession, sf: str) -> DataFrame:
    running = traininglog.running_epoch_mean(_steps(spark, sf), "epoch", "step", "loss", width=256)
    # means of cents often end in a five: a nudge, here and in the SQL, lets both round it up
    nudged = F.round(F.col("running_mean") + 1e-9, 6)
    return running.select("epoch", "step", nudged.alias("running_mean"))


@_query(
    f"WITH {_STEPS} SELECT epoch, round(avg(loss), 6) AS mean_loss, count(*) AS steps FROM steps GROUP BY epoch"
)
def epoch_mean(spark: SparkSession, sf: str) -> DataFrame:
    means = traininglog.epoch_mean(_steps(spark, sf), "epoch", "loss")
    return means.withColumn("mean_loss", F.round("mean_loss", 6))


def _sql_best(kind: str, start: str, sign: str) -> str:
    pick = "greatest" if kind == "max" else "least"
    return (
        f"WITH {_STEPS} SELECT step, loss FROM (SELECT step, loss, {pick}(coalesce({kind}(loss) OVER "
        f"(ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {start}), {start}) AS best "
        f"FROM steps) WHERE loss {sign} best"
    )


@_query(_sql_best("max", "0.0", ">"))
def best_so_far_max(spark: SparkSession, sf: str) -> DataFrame:
    rows = traininglog.improvements(_steps(spark, sf), "step", "loss", True, width=512)
    return rows.select("step", "loss")


@_query(_sql_best("min", "'infinity'::DOUBLE", "<"))
def best_so_far_min(spark: SparkSession, sf: str) -> DataFrame:
    rows = traininglog.improvements(_steps(spark, sf), "step", "loss", False, width=512)
    return rows.select("step", "loss")


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Logs of many runs, with steps far apart, epochs that are missing, and losses that are no number."""
    step = F.when(F.col("event_id") % 97 != 0, F.col("event_id") * 7_919)
    loss = F.when(F.col("event_id") % 31 == 0, float("nan")).otherwise(F.col("value"))
    return _table(spark, sf, "events").select(
        (F.col("user_id") % 5).alias("run"),
        F.when(F.col("event_type") != "error", F.floor(F.col("event_id") / 700)).alias("epoch"),
        step.alias("step"),
        F.col("event_id"),
        F.when(F.col("event_id") % 31 != 0, F.col("value")).alias("loss"),
        loss.alias("metric"),
    )


_RUNS = (
    "runs AS (SELECT user_id % 5 AS run, CASE WHEN event_type <> 'error' THEN event_id // 700 END AS epoch, "
    "CASE WHEN event_id % 97 <> 0 THEN event_id * 7919 END AS step, event_id, "
    "CASE WHEN event_id % 31 <> 0 THEN value END AS loss FROM events)"
)


@_query(
    f"WITH {_RUNS} SELECT run, epoch, event_id, round(avg(loss) OVER (PARTITION BY run, epoch ORDER BY step "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1e-9, 6) AS running_mean FROM runs "
    "WHERE step IS NOT NULL UNION ALL "
    "SELECT NULL, NULL, count(*), NULL FROM runs WHERE step IS NULL"
)
def run_epoch_means(spark: SparkSession, sf: str) -> DataFrame:
    """Running means of several runs; rows without an epoch are an epoch, rows without a step are kept."""
    running = traininglog.running_epoch_mean(
        _runs(spark, sf), "epoch", "step", "loss", width=500, by=["run"]
    )
    nudged = F.round(F.col("running_mean") + 1e-9, 6).alias("running_mean")
    placed = running.where("step is not null").select("run", "epoch", "event_id", nudged)
    unplaced = running.where("step is null").agg(F.count("*").alias("event_id"))
    return placed.unionByName(unplaced, allowMissingColumns=True)


@_query(
    f"WITH {_RUNS} SELECT run, step, loss FROM (SELECT *, greatest(coalesce(max(loss) OVER (PARTITION BY run "
    "ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0) AS best FROM runs "
    "WHERE step IS NOT NULL) WHERE loss > best"
)
def run_improvements(spark: SparkSession, sf: str) -> DataFrame:
    """Best so far of several runs whose metric is sometimes not a number."""
    rows = _runs(spark, sf).where("step is not null")
    best = traininglog.improvements(rows, "step", "metric", True, width=300, by=["run"])
    return best.select("run", "step", F.col("metric").alias("loss"))


@_query(
    f"WITH {_RUNS} SELECT run, min(step) AS step, max(value) AS value FROM (SELECT run, step, loss AS value, "
    "rank() OVER (PARTITION BY run ORDER BY loss DESC) AS r FROM runs WHERE loss IS NOT NULL AND step IS NOT NULL) "
    "WHERE r = 1 GROUP BY run"
)
def run_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    rows = _runs(spark, sf).where("step is not null")
    return traininglog.best_checkpoint(rows, "step", "metric", True, by=["run"])


@_query(
    f"WITH {_LOG} SELECT step, eval_wer AS value FROM log WHERE eval_wer IS NOT NULL "
    "ORDER BY eval_wer, step LIMIT 1"
)
def best_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return traininglog.best_checkpoint(_log(spark, sf), "step", "eval_wer")


@_query(
    f"WITH {_LOG} SELECT 'loss' AS series, step, loss AS value FROM log WHERE loss IS NOT NULL UNION ALL "
    "SELECT 'eval_loss', step, eval_loss FROM log WHERE eval_loss IS NOT NULL UNION ALL "
    "SELECT 'eval_wer', step, eval_wer FROM log WHERE eval_wer IS NOT NULL"
)
def log_series(spark: SparkSession, sf: str) -> DataFrame:
    return traininglog.log_series(_log(spark, sf), "step")


@_query(
    f"WITH {_STEPS} SELECT part, array_to_string(list(step ORDER BY step), ',') AS steps, "
    "md5(array_to_string(list(CAST(CAST(round(loss * 100) AS BIGINT) AS VARCHAR) ORDER BY step), ',')) AS losses "
    "FROM (SELECT *, step // 2000 AS part FROM steps) GROUP BY part"
)
def history_arrays(spark: SparkSession, sf: str) -> DataFrame:
    parts = traininglog.history(_steps(spark, sf), "step", ["loss"], points=2000)
    cents = F.transform("loss", lambda x: F.round(x * 100).cast("bigint"))
    return parts.select(
        "part", _joined("steps").alias("steps"), F.md5(_joined(cents)).alias("losses")
    )


@_query(
    "SELECT user_id, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000.0::DOUBLE, 6) AS minutes, "
    "round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0::DOUBLE, 6) AS hours "
    "FROM events GROUP BY user_id"
)
def elapsed_time(spark: SparkSession, sf: str) -> DataFrame:
    runs = _table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end")
    )
    return runs.select(
        "user_id",
        *[F.round(traininglog.elapsed("start", "end", u), 6).alias(u) for u in ("minutes", "hours")],
    )


# --- the driver's three functions -------------------------------------------------------------------


def _found(module: str) -> bool:
    """Whether an optional part of the repository is there; errors inside it are not hidden."""
    try:
        return importlib.util.find_spec(module) is not None
    except ModuleNotFoundError:
        return False


if _found("corpusloom.llm.queries"):
    from corpusloom.llm import queries as llm_queries

    _QUERIES.update(llm_queries.QUERIES)
    _SQL.update(llm_queries.SQL)
    if _found("corpus_pipeline"):
        import corpus_pipeline

        _QUERIES["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    return split_word_report(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
