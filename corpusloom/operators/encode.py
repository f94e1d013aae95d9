"""Text to token ids and back.

Splitting texts, wrapping, cutting, padding and decoding are built-in expressions. Only the merging of one
word's characters runs in Python, on Arrow batches: a batch's words are reduced to the distinct ones, each
is encoded once, and the ids are put back by position. Nothing is shuffled, so a frequent word costs a
lookup and never meets its copies in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import seq_pair_side, wrap_ids
from corpusloom.functions.text import pretokenize
from corpusloom.operators.bpe import BpeTokenizer
from corpusloom.operators.ordering import head_n

# The memo of one Python worker: so many words, none longer than this. Other words are encoded anew.
MEMO_WORDS = 200_000
MEMO_WORD_LENGTH = 64
# Rows of a batch are encoded together as far as they have about so many characters.
ENCODED_CHARACTERS = 1 << 21


def merge_word(symbols: list[int], rules: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Join neighbouring symbols, lowest rank first and leftmost first within a rank."""
    n = len(symbols)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = right[i]
        rule = rules.get((symbols[i], symbols[j])) if j < n else None
        if rule:
            heapq.heappush(heap, (rule[0], i, symbols[i], symbols[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or symbols[i] != a or symbols[j] != b:
            continue
        symbols[i] = rules[(a, b)][1]
        alive[j] = False
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    return [s for s, kept in zip(symbols, alive) if kept]


def _starts(words: pa.Array) -> np.ndarray:
    """Where each word's bytes begin, and where the last ends, as Arrow holds it."""
    if not len(words):
        return np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_string(words.type) else np.int32
    return np.frombuffer(words.buffers()[1], wide)[words.offset : words.offset + len(words) + 1]


def _word_encoder(tokenizer: BpeTokenizer):
    """An Arrow function from lists of words to lists of ids."""
    ids = dict(tokenizer.ids)
    specials = set(tokenizer.specials)
    unknown = tokenizer.unk_id
    rules = {(a, b): (rank, c) for rank, (a, b, c) in reversed(list(enumerate(tokenizer.merges)))}
    memo: dict[str, list[int]] = {}

    def encode_one(word: str) -> list[int]:
        known = memo.get(word)
        if known is None:
            if word in specials:
                known = [ids[word]]
            else:
                known = merge_word([ids.get(c, unknown) for c in word], rules)
            if len(word) <= MEMO_WORD_LENGTH:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                memo[word] = known
        return known

    def encode_batch(words: pa.Array) -> pa.Array:
        """Ids of a batch, some rows after another: places of ids take many times what the ids take."""
        words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
        per_row = np.asarray(words.value_lengths().fill_null(0), dtype=np.int64)
        before = _starts(words.flatten())
        part = before[np.cumsum(per_row) - per_row] // ENCODED_CHARACTERS
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(words)]
        # a word has no more ids than characters; what is not filled is never touched
        ids, filled = np.empty(before[-1] - before[0], np.int32), 0
        rows = np.zeros(len(words) + 1, np.int32)
        for a, b in zip(cuts, cuts[1:]):
            some, ends = encode_some(words.slice(a, b - a).flatten(), per_row[a:b])
            rows[a + 1 : b + 1] = filled + ends
            ids[filled : filled + len(some)] = some
            filled += len(some)
        missing = words.is_null() if words.null_count else None
        return pa.ListArray.from_arrays(
            pa.array(rows, pa.int32()), pa.array(ids[:filled], pa.int32()), mask=missing
        )

    def encode_some(words: pa.Array, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, and where each row of them ends."""
        coded = words.dictionary_encode()
        encoded = [encode_one(w) for w in coded.dictionary.to_pylist()]
        sizes = np.array([len(e) for e in encoded], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        pool = np.array([i for e in encoded for i in e], dtype=np.int32)
        which = np.asarray(coded.indices, dtype=np.int64)
        lengths = sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        # where in the pool each output id comes from
        source = np.arange(ends[-1]) + np.repeat(starts[:-1][which] - ends[:-1], lengths)
        return pool[source], ends[np.cumsum(per_row)]

    return encode_batch


def encode_column(col: Column | str, tokenizer: BpeTokenizer, template: bool = True) -> Column:
    """Token ids of a text, with the tokenizer's first and last special around them if wanted."""
    encoder = F.arrow_udf(_word_encoder(tokenizer), "array<int>")
    ids = encoder(pretokenize(col, tokenizer.specials))
    return wrap_ids(ids, tokenizer.first_id, tokenizer.last_id) if template else ids


def encode(
    df: DataFrame, col: str, tokenizer: BpeTokenizer, out: str = "input_ids", template: bool = True
) -> DataFrame:
    return df.withColumn(out, encode_column(col, tokenizer, template))


def encode_pairs(
    df: DataFrame,
    source: str,
    target: str,
    source_length: int,
    target_length: int,
    tokenizer: BpeTokenizer,
    double_specials: bool = True,
) -> DataFrame:
    """Fixed-length ``src`` and ``tgt`` ids of a pair of texts."""

    def side(col: str, n: int) -> Column:
        ids = encode_column(col, tokenizer, template=double_specials)
        return seq_pair_side(ids, n, tokenizer.first_id, tokenizer.last_id, tokenizer.pad_id)

    return df.withColumn("src", side(source, source_length)).withColumn(
        "tgt", side(target, target_length)
    )


def decode_column(
    col: Column | str,
    tokenizer: BpeTokenizer,
    skip_special: bool = True,
    separator: str = " ",
    word_delimiter: str | None = None,
) -> Column:
    """Tokens joined by ``separator``; ids outside the vocabulary are left out.

    Character vocabularies join by nothing and write a ``word_delimiter`` token for the blank.
    """
    c = F.col(col) if isinstance(col, str) else col
    shown = ["" if skip_special and t in tokenizer.specials else t for t in tokenizer.tokens]
    # one constant array, read by position; tokens hold no whitespace
    vocabulary = F.split(F.lit("\n".join(shown)), "\n")
    spoken = F.filter(F.transform(c, lambda i: F.get(vocabulary, i)), lambda t: t != "")
    if word_delimiter is not None:
        spoken = F.transform(spoken, lambda t: F.when(t == word_delimiter, F.lit(" ")).otherwise(t))
    return F.array_join(spoken, separator)


def max_token_length(df: DataFrame, col: str, tokenizer: BpeTokenizer) -> DataFrame:
    """The longest text in tokens, specials included."""
    return df.agg(F.max(F.size(encode_column(col, tokenizer))).alias("max_length"))


def length_percentiles(
    df: DataFrame,
    lengths: dict[str, Column],
    p: float = 0.95,
    limit: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Exact percentile of each length, cut to an integer; ``limit`` measures the first rows in order only.

    The percentile keeps one entry for each distinct length, so that all rows are affordable.
    """
    rows = head_n(df, limit, order) if limit else df
    measured = rows.select(*[n.alias(name) for name, n in lengths.items()])
    return measured.agg(
        *[F.percentile(F.col(name), F.lit(p)).cast("int").alias(name) for name in lengths]
    )
