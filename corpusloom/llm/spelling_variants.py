"""Words that one edit parts, grouped under their most frequent spelling, by reduced-alphabet generation.

1. The words of all documents are counted; a batch of documents sends each of its words once.
2. The letters are hashed to a few symbols, and a word is reduced to its run of symbols. One edit of a word
   is at most one edit of its reduced word, so that all words one edit away reduce to something in its
   full one-edit neighbourhood: itself and every deletion, insertion and replacement of a symbol.
3. The neighbourhoods are joined with the reduced vocabulary, and what meets is verified on the words
   themselves. Reduced words travel as 64-bit numbers, whose collisions the verification drops too. Most of
   a neighbourhood is no word's: a bitmap of the reduced vocabulary, of one size whatever the vocabulary,
   keeps it from being sent. A fuller bitmap lets more pass and changes no result.
4. A word's form is its most frequent near word, if that is frequent enough; roots are found by following
   forms to the last in doubling steps.

There are as many symbols as keep the words of one reduced word few: a neighbourhood grows with the
alphabet, the words that meet in it by chance shrink with it.

The joins merge, as hinted: Spark takes the words' compressed files for their size in memory, and a table of
neighbours for as small as the words it comes from, and would send such a table through the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shingles import mixed
from corpusloom.session import materialize

RUN = re.compile("[a-zÀ-ÿ]+")  # fixed value, of lower-cased text
MIN_LENGTH = 5  # code points of a word
MIN_COUNT = 3  # occurrences of a word
MARGIN = 2  # times a word's count that its form has at least
DAMAGE = 97  # one in so many pairs of document and run loses a code point
MIN_SYMBOLS = 4
TOGETHER = 1 << 20  # neighbours worked out at once
BITMAP_BITS = 26  # the bitmap of reduced words has 2 ** 26 bits: 8 MiB
_CHUNK_BITS = 15  # and is put together in parts of 2 ** 15
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)


# --- words ------------------------------------------------------------------------------------------


def runs_of(text: str | None) -> Counter[str]:
    """How often a text holds each maximal run of letters, A-Z in lower case."""
    lower = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    return Counter(RUN.findall(lower))


def damaged(run: str, start: int, one_in: int = DAMAGE) -> str:
    """The run, or without one of its code points where its hash says so; ``start`` is that of the document."""
    h = zlib.crc32(run.encode(), start)
    if h % one_in:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damage: int | None = DAMAGE,
) -> DataFrame:
    """(``word``, ``n``) of the words long and frequent enough, over all documents.

    ``damage`` spoils one in so many pairs of key and run, as the contract asks; None spoils none. A null
    key counts as an empty one, a null text has no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            for own, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = runs_of(value)
                if damage is None:
                    total.update(found)
                    continue
                start = zlib.crc32(f"{own or ''}:".encode())
                for word, n in found.items():
                    total[damaged(word, start, damage)] += n
            kept = {w: n for w, n in total.items() if len(w) >= min_length}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())],
                ["word", "n"],
            )

    sent = docs.select(F.col(key).cast("string"), F.col(text)).mapInArrow(run, "word string, n long")
    return sent.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- reduced words ----------------------------------------------------------------------------------


def symbols_for(words: int) -> int:
    """Symbols of the reduced alphabet: about the sixth root of the words, so that six letters tell them apart."""
    return max(MIN_SYMBOLS, int(np.ceil(max(1, words) ** (1 / 6))))


def reduced(points: np.ndarray, symbols: int) -> np.ndarray:
    """The symbol of each code point, from 1."""
    with np.errstate(over="ignore"):
        spread = (points.astype(np.uint64) * np.uint64(_BASE)) >> np.uint64(40)
    return spread % np.uint64(symbols) + np.uint64(1)


def _numbers(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and for each row of symbols the number of each of its heads."""
    length = symbols.shape[1]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(length + 1, _BASE, np.uint64)]))
        part = symbols * powers[:length]
        heads = np.concatenate(
            [np.zeros((len(symbols), 1), np.uint64), np.cumsum(part, axis=1, dtype=np.uint64)], axis=1
        )
    return powers, heads


def neighbourhood(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Numbers of all reduced words at most one edit away, a row for each row of symbols.

    The symbols are rows of equal length. Numbers repeat within a row where edits give the same word.
    """
    length = symbols.shape[1]
    powers, heads = _numbers(symbols)
    total = heads[:, -1:]
    every = np.arange(1, alphabet + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        deleted = heads[:, :-1] + (total - heads[:, 1:]) * np.uint64(_INVERSE)
        # a symbol c in front of place i, and c in place of the symbol at i
        inserted = (heads + (total - heads) * np.uint64(_BASE))[:, :, None] + powers[: length + 1, None] * every
        replaced = total[:, :, None] + (every - symbols[:, :, None]) * powers[:length, None]
    # a replacement by the symbol itself is the word
    return np.concatenate(
        [deleted, inserted.reshape(len(symbols), -1), replaced.reshape(len(symbols), -1)], axis=1
    )


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points of the words of each length."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        points = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), "<u4")
        yield at, points.reshape(len(at), length)


def _reduced_numbers(words: DataFrame, alphabet: int) -> DataFrame:
    """(``near``, ``near_n``, ``number`` of the reduced word) of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            out = np.zeros(len(held), np.uint64)
            for at, points in _by_length(held):
                out[at] = _numbers(reduced(points, alphabet))[1][:, -1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out.view(np.int64))], ["near", "near_n", "number"]
            )

    return words.select("word", "n").mapInArrow(run, "near string, near_n long, number long")


def _places(numbers: np.ndarray) -> np.ndarray:
    """The bit of each number."""
    return (mixed(numbers) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def bitmap_of(reduced_words: DataFrame) -> np.ndarray:
    """A bit for each ``number`` there is; the parts are put together by groups, the whole by the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_places(batch.column(0).to_numpy().view(np.uint64)))
            chunk, place = at >> _CHUNK_BITS, at & ((1 << _CHUNK_BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.astype(np.int32)), pa.array(place.astype(np.int32))], ["chunk", "place"]
            )

    def filled(rows: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _CHUNK_BITS, bool)
        bits[rows.column("place").to_numpy()] = True
        return pa.table({"chunk": rows.column("chunk").slice(0, 1), "bits": [np.packbits(bits).tobytes()]})

    at = reduced_words.select("number").mapInArrow(places, "chunk int, place int").distinct()
    whole = np.zeros((1 << (BITMAP_BITS - _CHUNK_BITS), 1 << (_CHUNK_BITS - 3)), np.uint8)
    for row in at.groupBy("chunk").applyInArrow(filled, "chunk int, bits binary").toLocalIterator():
        whole[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.reshape(-1)


def _neighbours(words: DataFrame, alphabet: int, bitmap: np.ndarray) -> DataFrame:
    """(``word``, ``number``) of every word's neighbourhood, each number once, without those of no word."""
    sent = words.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            held = batch.column(0).to_pylist()
            for at, points in _by_length(held):
                length = points.shape[1]
                each = max(1, TOGETHER // (2 * (length + 1) * alphabet + length))
                for start in range(0, len(at), each):
                    near = neighbourhood(reduced(points[start : start + each], alphabet), alphabet)
                    place = _places(near)
                    row, col = np.nonzero((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1)
                    number = near[row, col]
                    order = np.lexsort((number, row))
                    row, number = row[order], number[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at[start + row[new]])),
                            pa.array(number[new].view(np.int64)),
                        ],
                        ["word", "number"],
                    )

    return words.select("word").mapInArrow(run, "word string, number long")


def near_words(words: DataFrame, alphabet: int) -> DataFrame:
    """(``word``, ``near``, ``near_n``) for all ordered pairs of words that exactly one edit parts.

    A word's neighbourhood holds the number of a near word's reduced word once, so a pair meets once.
    """
    reduced_words = _reduced_numbers(words, alphabet)
    near = _neighbours(words, alphabet, bitmap_of(reduced_words))
    met = near.hint("merge").join(reduced_words, "number")
    return met.where(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


# --- forms ------------------------------------------------------------------------------------------


def _with_roots(forms: DataFrame) -> DataFrame:
    """``root`` of each word: forms followed to the last, twice as far with each step.

    Counts double along a chain of forms, which bounds the steps by the logarithm of that of a count.
    """
    ends = materialize(
        forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots"
    )
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next")).where("root != next")
        stepped = materialize(
            ends.join(further.hint("merge"), "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        ends = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return ends


def spelling_groups(words: DataFrame, margin: int = MARGIN, symbols: int | None = None) -> DataFrame:
    """``form``, ``root``, ``n_near`` and ``form_n`` of each word of a table (``word``, ``n``).

    Words are distinct and not null. Two are near if exactly one code point inserted, deleted or replaced
    parts them. A word's form is its near word of the largest count, of equal ones the first in the order
    of code points, if that count is ``margin`` times its own at least, which keeps forms free of circles;
    else null. The root is where following forms ends, the word itself without a form. ``symbols`` sets
    the size of the reduced alphabet and changes no result. No words give no rows.
    """
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    alphabet = symbols or symbols_for(words.count())
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near")))
    near = near_words(words, alphabet).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best")
    )
    best_n = -F.col("best.order")
    fits = best_n >= margin * F.col("n")
    forms = materialize(
        words.join(near.hint("merge"), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.near")).alias("form"),
            F.when(fits, best_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _with_roots(forms).hint("merge")
    return forms.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
