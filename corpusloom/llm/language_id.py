"""Language identification by compression: the dictionary that makes a text smallest names its language.

A bounded sample of labelled texts gives each language a raw-content dictionary. A text is cut into
blocks, each block is compressed once with every dictionary, and the sizes are added up; whole texts are
read. The relative gap between the two smallest sums is the score; where it is narrow the text is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import fresh

UNKNOWN = "und"
DICTIONARY_BYTES = 112 * 1024  # of one language
MAX_LANGUAGES = 500  # what is sent to workers is DICTIONARY_BYTES times this at most
BLOCK = 512  # characters of a text that are compressed at once: the dictionary decides, not the text's start
LEVEL = 6
HEAD = 256  # bytes of a dictionary before a very short text
CLOSE = 1  # bytes between the two smallest sizes of a text of one block, up to which that is compared too
PIECE = 1 << 15  # letters of one training text that may enter a dictionary
MIN_MARGIN = 0.001  # the smallest two sizes are as good as equal
_NO_LETTER = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """A dictionary of training text for each language."""

    dictionaries: dict[str, bytes]


def letters(text: str) -> str:
    """Lower-cased words, one space between them; none where no word has a letter, as in ``½`` or ``²²``."""
    words = _NO_LETTER.sub(" ", text.lower()).strip()
    return words if any(map(str.isalpha, words)) else ""


def fit(
    labelled: DataFrame,
    text: str = "text",
    language: str = "lang",
    dictionary_bytes: int = DICTIONARY_BYTES,
    max_languages: int = MAX_LANGUAGES,
) -> LanguageModel:
    """Fill a dictionary of at most ``dictionary_bytes`` per language with labelled texts.

    Texts are taken in the order of their hash: of each language, those hashes are read that hold about
    four dictionaries of bytes, then four times as many, until its dictionary is full or its texts are used
    up. Rows without text or language do not count, repeated texts count once. A language none of whose
    texts has a letter has no dictionary. More than ``max_languages`` languages are an error.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(
        F.col(text).alias("t"), F.col(language).cast("string").alias("l")
    )
    placed = rows.withColumn("h", F.xxhash64("t"))
    distinct = placed.groupBy("l", "h").agg(F.max(F.least(F.octet_length("t"), F.lit(PIECE))).alias("n"))
    sizes = {
        r["l"]: r["n"] for r in distinct.groupBy("l").agg(F.sum("n").alias("n")).limit(max_languages + 1).collect()
    }
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [letters(t)[:PIECE] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(parts, pa.string())], ["l", "h", "t"]
            )

    filled: dict[str, list[bytes]] = {name: [] for name in sizes}
    left = dict.fromkeys(sizes, dictionary_bytes)
    # four dictionaries are expected; parts of texts, so that a very long one cannot take it all
    share = {name: min(1.0, 4 * dictionary_bytes / max(1, size)) for name, size in sizes.items()}
    above = dict.fromkeys(sizes, -(2**63) - 1)  # hashes up to this one were read
    short = sorted(sizes)
    while short:
        wanted = F.lit(False)
        for name in short:
            limit = int(-(2**63) + share[name] * (2**64 - 1)) if share[name] < 1 else 2**63 - 1
            fresh_ones = F.col("h") <= limit
            if above[name] >= -(2**63):
                fresh_ones = fresh_ones & (F.col("h") > above[name])
            wanted = wanted | ((F.col("l") == name) & fresh_ones)
            above[name] = limit
        pieces = (
            placed.where(wanted)
            .select("l", "h", "t")
            .mapInArrow(spelled, "l string, h long, t string")
            .where("t != ''")
            .groupBy("l", "h")
            .agg(F.min("t").alias("t"))
        )
        for row in pieces.orderBy("l", "h").toLocalIterator():
            if left[row["l"]] <= 0:
                continue
            part = row["t"].encode()[: left[row["l"]]]
            filled[row["l"]].append(part)
            left[row["l"]] -= len(part) + 1
        short = [name for name in short if left[name] > 0 and share[name] < 1]
        share.update({name: min(1.0, 4 * share[name]) for name in short})
    return LanguageModel({name: b" ".join(parts) for name, parts in sorted(filled.items()) if parts})


class Sizer:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, model: LanguageModel, level: int = LEVEL):
        self.names = sorted(model.dictionaries)
        self.compressors, self.heads = [], []
        for name in self.names:
            held = zstandard.ZstdCompressionDict(
                model.dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            held.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=level,
                    dict_data=held,
                    write_checksum=False,
                    write_content_size=False,
                    write_dict_id=False,
                )
            )
            self.heads.append(model.dictionaries[name][:HEAD])
        self.bases = [len(c.compress(h)) for c, h in zip(self.compressors, self.heads)]

    def sizes(self, words: str) -> list[int]:
        totals = [0] * len(self.names)
        for start in range(0, len(words), BLOCK):
            block = words[start : start + BLOCK].encode("utf-8", "replace")
            for i, compressor in enumerate(self.compressors):
                totals[i] += len(compressor.compress(block))
        return totals

    def after_heads(self, words: str) -> list[int]:
        """What the words add to the size of a stretch of each dictionary itself."""
        return [
            len(compressor.compress(head + f" {words} ".encode())) - base
            for compressor, head, base in zip(self.compressors, self.heads, self.bases)
        ]

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language and score; equal sizes go to the name that sorts first, with score 0."""
        words = letters(text) if text else ""
        if not words or not self.names:
            return UNKNOWN, 0.0
        totals = self.sizes(words)
        if len(words) <= BLOCK and sorted(totals)[len(totals) > 1] - min(totals) <= CLOSE:
            # so short a text may be no smaller than raw; after a stretch of the dictionary it is encoded
            totals = [a + b for a, b in zip(totals, self.after_heads(words))]
        order = sorted(range(len(totals)), key=lambda i: (totals[i], i))
        if len(order) == 1:
            return self.names[0], 1.0
        best, second = totals[order[0]], totals[order[1]]
        return self.names[order[0]], (second - best) / second


def identify(
    docs: DataFrame,
    model: LanguageModel,
    text: str = "text",
    min_margin: float = MIN_MARGIN,
    prediction: str = "lang_pred",
    score: str = "lang_score",
    rejected: str = "rejected",
) -> DataFrame:
    """Add the language, the score in 0..1 and whether the text is rejected; all columns stay.

    ``und`` with score 0 is given, and rejected, where the text is null, empty or has no letter. A text is
    also rejected where the two best sizes are as good as equal: the score is at most ``min_margin``.
    A row's result depends on its text alone. The three new names must not be columns already.
    """
    taken = {c.lower() for c in docs.columns}
    for name in (prediction, score, rejected):
        if name.lower() in taken:
            raise ValueError(f"there is a column {name} already")
    # not the model itself, whose class a worker cannot import
    sent = docs.sparkSession.sparkContext.broadcast(dict(model.dictionaries))

    @F.pandas_udf("language string, score double")
    def classified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sizer = Sizer(LanguageModel(sent.value))
        for batch in batches:
            yield pd.DataFrame([sizer.classify(t) for t in batch], columns=["language", "score"])

    found = fresh(docs, "__language")
    named = docs.withColumn(found, classified(F.col(text)))
    narrow: Column = (F.col(f"{found}.language") == UNKNOWN) | (F.col(f"{found}.score") <= min_margin)
    return named.select(
        *docs.columns,
        F.col(f"{found}.language").alias(prediction),
        F.col(f"{found}.score").alias(score),
        narrow.alias(rejected),
    )
