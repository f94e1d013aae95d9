"""Quality rules whose cutoffs follow the corpus: mergeable quantile sketches per language and source.

1. Whole texts are measured once: words, symbols, repeated lines, words in repeated three-word windows.
2. Each measure of a document is a whole number, sketched by its ``PRECISION`` leading bits. A sketch is a
   table of counts per such bucket, so that merging two is adding their counts: tasks merge on the map
   side, and the sketches of a language and of the corpus are merged from those of its sources. A
   quantile read from it is below the true one by less than a part in ``2 ** (PRECISION - 1)``.
3. From the quantiles of its language and source a group gets fences: as far beyond the outer quantile as
   ``REACH`` times the distance from the median to it, ``SLACK`` at least. A group of less than
   ``MIN_GROUP`` documents takes the fences of its language, then those of the corpus.
4. The fences are joined to the documents, which stay if all their measures lie within.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.rows import fresh
from corpusloom.llm.shingles import hashed, mixed
from corpusloom.session import broadcast_if_small, materialize

WHITE_SPACE = " \t\n\x0b\x0c\r"  # fixed value: what stands between words
SYMBOLS = b"#*$%&|<>"  # fixed value
WINDOW = 3  # words of a window
MIN_WORDS = 50  # base rule: fewer fail
MAX_REPEAT = 50  # base rule: percent of words in repeated windows, more fail
PRECISION = 8  # leading bits of a sketched value
MIN_GROUP = 200  # documents of a group with fences of its own
OUTER = 100  # permille of documents on either side of the outer quantiles
REACH = 4
# What is sketched, and the least distance from the median that counts, in the measure's own units:
# hundredths of a character, and ten-thousandths of a text.
SLACK = {"word_length": 10, "symbol_share": 50, "dup_share": 1_000, "repeat_share": 500}
LOWER = ("word_length",)  # measures with a lower fence too
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_TOGETHER = 1 << 22  # bytes measured at once

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(WHITE_SPACE.encode())] = True


# --- measures ---------------------------------------------------------------------------------------


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    held = [line for line in text.split("\n") if line.strip(WHITE_SPACE)]
    return len(held), len(held) - len(set(held))


def _repeated(words: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which words lie in a window of ``WINDOW`` words that their text holds twice or more."""
    covered = np.zeros(len(words), bool)
    if len(words) < WINDOW:
        return covered
    runs = len(words) - WINDOW + 1
    with np.errstate(over="ignore"):
        keys = mixed(of[:runs].astype(np.uint64) + np.uint64(1))
        for i in range(WINDOW):
            keys = mixed(keys + words[i : i + runs])
    at = np.flatnonzero(of[:runs] == of[WINDOW - 1 :])
    _, place, times = np.unique(keys[at], return_inverse=True, return_counts=True)
    at = at[times[place] > 1]
    for i in range(WINDOW):
        covered[at + i] = True
    return covered


def counts_of(texts: Sequence[str | None]) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of each text; null counts as a text without words."""
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(x) for x in blobs], np.int64)
    starts = np.cumsum(size + 1) - size - 1
    data = b"\n".join(blobs)
    b = np.frombuffer(data, np.uint8)
    words, word_starts = hashed(data)
    of = np.searchsorted(starts, word_starts, "right") - 1
    n = len(blobs)

    def inside(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[starts + size] - total[starts]

    lines = np.array([_lines(t) if t else (0, 0) for t in texts], np.int64).reshape(n, 2)
    return {
        "n_words": np.bincount(of, minlength=n),
        "word_chars": inside(~_IS_SPACE[b] & ((b & 0xC0) != 0x80)),
        "n_symbols": inside(_IS_SYMBOL[b]),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": np.bincount(of[_repeated(words, of)], minlength=n),
        "n_lines": lines[:, 0],
    }


def measured(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns, the ``COUNTS`` of each whole text as longs, and the measures that are sketched.

    A text without words has counts of 0 and null measures. Kept columns must not be named like a count.
    """
    keep = list(keep)
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField(c, T.LongType(), False) for c in COUNTS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            size = np.cumsum([len(t or "") for t in texts], dtype=np.int64)
            # a very long text is measured by itself
            edges = np.flatnonzero(np.diff(size // _TOGETHER, prepend=0)) if len(size) else []
            parts = np.unique(np.concatenate([[0], edges, [len(texts)]]).astype(np.int64))
            found = [counts_of(texts[a:z]) for a, z in zip(parts, parts[1:])]
            counts = [
                np.concatenate([f[c] for f in found] or [np.zeros(0)]).astype(np.int64) for c in COUNTS
            ]
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(c) for c in counts]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *COUNTS])

    counted = docs.select(*keep, text).mapInArrow(run, schema)

    def share(part: str, whole: str, parts: int) -> Column:
        ratio = F.expr(f"({part} * {parts}L) div {whole}")
        return F.when((F.col("n_words") > 0) & (F.col(whole) > 0), ratio)

    return counted.withColumns(
        {
            "word_length": share("word_chars", "n_words", 100),
            "symbol_share": share("n_symbols", "word_chars", 10_000),
            "dup_share": share("n_dup_lines", "n_lines", 10_000),
            "repeat_share": share("n_repeat_words", "n_words", 10_000),
        }
    )


# --- sketches ---------------------------------------------------------------------------------------


def bucket(value: Column, precision: int = PRECISION) -> Column:
    """The value with all but its leading bits cleared, for whole numbers of 0 and more."""
    cut = F.greatest(F.length(F.bin(value)) - precision, F.lit(0))
    power = F.element_at(F.array(*[F.lit(1 << i) for i in range(63)]), cut + 1)
    return value - value % power


def sketches(values: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """(by, ``measure``, ``bucket``, ``n``): counts per bucket, partly merged before the shuffle."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in measures]))
    rows = values.select(*by, each.alias("m")).where("m.v is not null")
    return rows.groupBy(*by, F.col("m.measure").alias("measure"), bucket(F.col("m.v")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def merged(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups, as sums of those of finer ones."""
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: Sequence[str], permille: dict[str, int]) -> DataFrame:
    """(by, ``measure``, ``total`` and a column for each quantile): the first bucket that reaches it.

    A sketch has some hundred buckets at any number of documents, so that a window over it is small.
    """
    whole = Window.partitionBy(*by, "measure")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = sketch.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    found = [
        F.min(F.when(F.expr(f"upto >= (total * {q}L + 999L) div 1000L"), F.col("bucket"))).alias(name)
        for name, q in permille.items()
    ]
    return summed.groupBy(*by, "measure").agg(F.max("total").alias("total"), *found)


def fences(
    sketch: DataFrame,
    by: Sequence[str],
    slack: dict[str, int],
    outer: int = OUTER,
    reach: int = REACH,
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """One row per group of ``by``, a finer column after a coarser one: ``<measure>_low`` and ``_high``.

    A group too small for its own takes those of the group without the last column, then without the last
    two, at last those of all. Null is a value of a group like any other.
    """
    by = list(by)
    around = {"low": outer, "mid": 500, "high": 1000 - outer}
    # a group of each depth: the first columns of by, null in place of the others
    levels = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(depth).alias("depth"),
                    *[(F.col(c) if i < depth else F.lit(None).cast(sketch.schema[c].dataType)).alias(c) for i, c in enumerate(by)],
                )
                for depth in range(len(by) + 1)
            ]
        )
    )
    level = ["depth", *by]
    in_levels = sketch.select(levels.alias("level"), "measure", "bucket", "n").select("level.*", "measure", "bucket", "n")
    around_groups = quantiles(merged(in_levels, level), level, around)
    least = F.lit(0)
    for name, value in slack.items():
        least = F.when(F.col("measure") == name, F.lit(value)).otherwise(least)
    of = around_groups.where((F.col("depth") == 0) | (F.col("total") >= min_group)).select(
        *level,
        "measure",
        (F.col("low") - reach * F.greatest(F.col("mid") - F.col("low"), least)).alias("low"),
        (F.col("high") + reach * F.greatest(F.col("high") - F.col("mid"), least)).alias("high"),
    )
    wanted = sketch.select(*by, "measure").distinct().select(
        *[F.col(c).alias(f"__{c}") for c in by], "measure", levels.alias("w")
    )
    same = (F.col("w.depth") == F.col("l.depth")) & (F.col("m.measure") == F.col("l.measure"))
    for c in by:
        same = same & F.col(f"w.{c}").eqNullSafe(F.col(f"l.{c}"))
    finest = F.max(F.struct("l.depth", "l.low", "l.high")).alias("of")
    chosen = (
        wanted.alias("m").join(of.alias("l"), same).groupBy(*[f"__{c}" for c in by], "m.measure").agg(finest)
    )
    ends = [
        F.max(F.when(F.col("measure") == name, F.col(f"of.{end}"))).alias(f"{name}_{end}")
        for name in slack
        for end in ("low", "high")
    ]
    return chosen.groupBy(*[F.col(f"__{c}").alias(c) for c in by]).agg(*ends)


# --- the filter -------------------------------------------------------------------------------------


def judge(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    by: Sequence[str] = ("lang", "source"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: key, kept columns, counts, ``base_failed``, ``kept`` and the ``reasons``.

    ``base_failed`` is fewer than ``MIN_WORDS`` words or more than ``MAX_REPEAT`` percent of them in
    repeated windows; such a document does not stay. The others stay if no measure lies outside the fences
    of their group; ``reasons`` names those that do. All documents with a word are sketched, failed ones
    too: the outer quantiles bear a tenth of junk on each side. A null or empty text has no words, and
    fails. Null keys, languages and sources are values like others, repeated rows are judged alike.
    """
    by, keep = list(by), [c for c in keep if c != key]
    new = {*COUNTS, "base_failed", "kept", "reasons"}
    if clash := [c for c in (key, *keep) if c.lower() in new]:
        raise ValueError(f"there is a column {clash[0]} already")
    names = {c: f"__by{i}" for i, c in enumerate(by)}
    kept = {c: f"__kept{i}" for i, c in enumerate(keep)}
    source = docs.select(
        F.col(key).alias("__key"),
        *[F.col(c).alias(new) for c, new in (names | kept).items()],
        F.col(text).alias("__text"),
    )
    found = materialize(
        measured(source, "__text", ["__key", *names.values(), *kept.values()]), "quality-measures"
    )
    groups = list(names.values())
    sketch = materialize(sketches(found, groups, list(SLACK)), "quality-sketches")
    limits = broadcast_if_small(fences(sketch, groups, SLACK).withColumnsRenamed({g: f"{g}_" for g in groups}))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_"))
    judged = found.join(limits, same, "left")
    outside = [
        F.when(
            (F.col(m) > F.col(f"{m}_high")) | ((F.col(m) < F.col(f"{m}_low")) if m in LOWER else F.lit(False)),
            F.lit(m),
        )
        for m in SLACK
    ]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    reasons = F.array_compact(F.array(*outside))
    return judged.select(
        F.col("__key").alias(key),
        *[F.col(new).alias(c) for c, new in kept.items()],
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.size(reasons) == 0)).alias("kept"),
        reasons.alias("reasons"),
    )


def quality_filter(
    docs: DataFrame, key: str = "doc_id", text: str = "text", by: Sequence[str] = ("lang", "source")
) -> DataFrame:
    """The documents that stay, with all their columns; of a key that occurs more than once, each row by itself."""
    columns = docs.columns
    row = fresh(docs, "__n")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "quality-documents")
    verdict = judge(numbered, row, text, by).where("kept").select(row)
    return numbered.join(verdict, row, "left_semi").select(*columns)
