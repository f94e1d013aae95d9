"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

The n-grams of all training documents are counted in ranges of their hashes. A count is quantised to a
level, and the filter holds an n-gram once for each level up to its own: probing level after level until one
is missing gives the count back, never too small a level, and too large a one with a known small chance.
The filter is made of parts, one to a range, built where the range was counted.

The filter grows with the n-grams counted, and all of them are held. It stays a written table of its parts: a
batch of documents sends its distinct n-grams to their ranges, where the part of the range is probed, and
gets the levels back, so no task and no driver holds more than one part at once.

Scores interpolate the bigram's share of its first word with the word's own smoothed share, both from
probes. Exact word counts, for the plain unigram score, come back to each batch the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import keycounts
from corpusloom.llm.shingles import mixed, word_hashes
from corpusloom.session import materialize, release

BITS_PER_ENTRY = 8
PROBES = 5  # hash functions of the filter
GROWTH = 1.25  # between one quantised count and the next
SHARE = 0.4  # of the bigram in the interpolation
BATCH_BYTES = 6 << 20  # of text in a batch of documents
COUNT_BYTES = 8 << 20  # of text counted at once, or one document
PROBED = 1 << 17  # keys whose bits are set or looked up at once
SLICE = 100_000  # tokens scored at once, or one document

END = np.uint64(0x2545F4914F6CDD1D)  # the token after a text's last word, and before its first
_PAIR = np.uint64(0x9FB21C651E98DF25)
_LEVEL = np.uint64(0xC2B2AE3D27D4EB4F)


def thresholds(limit: int = 2**40) -> np.ndarray:
    """The smallest count of each level, from level 1: 1, 2, 3, 4, 5, 7, 9 and so on."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * GROWTH))))
    return np.array(out, np.int64)


_THRESHOLDS = thresholds()
_SMALLEST = np.concatenate([[0], _THRESHOLDS])  # the count that each level stands for


def levels(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(_THRESHOLDS, counts, side="right").astype(np.int64)


def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(first * _PAIR + second)


def tokens_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's tokens, its end included, and the token before each."""
    tokens = np.append(words, END)
    return tokens, np.concatenate([[END], words]).astype(np.uint64)


@dataclass(frozen=True)
class LogFrequencyFilter:
    """Parts of one bit array, by range of the keys."""

    ranges: int
    start: np.ndarray  # first bit of each part
    size: np.ndarray  # bits of each part
    bits: np.ndarray  # bytes

    def _places(self, keys: np.ndarray, level: int) -> list[np.ndarray]:
        high, _ = keycounts.placed(keys, self.ranges)
        return [self.start[high] + p for p in _positions(keys, level, self.size[high])]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level that is held without a gap below; 0 where none is."""
        return np.concatenate([np.zeros(0, np.int64), *[self._probed(k) for k in _runs(keys)]])

    def _probed(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        for level in range(1, len(_THRESHOLDS) + 1):
            if not len(alive):
                break
            held = np.ones(len(alive), bool)
            for place in self._places(keys[alive], level):
                held &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            alive = alive[held]
            out[alive] = level
        return out

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The smallest count of each key's level; 0 where none is held."""
        return _SMALLEST[self.levels(keys)]


def _short(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The bits of a key that are counted, kept as a key that falls into the same range."""
    bits = ranges.bit_length() - 1
    return keys >> np.uint64(32 - bits) << np.uint64(32 - bits)


def _runs(keys: np.ndarray) -> Iterator[np.ndarray]:
    """The keys in runs of ``PROBED``, whose places in the filter are in memory at once."""
    return (keys[i : i + PROBED] for i in range(0, len(keys), PROBED))


def _positions(keys: np.ndarray, level: int, size: np.ndarray) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        h = mixed(keys + np.uint64(level) * _LEVEL)
        step = mixed(h) | np.uint64(1)
        width = np.maximum(size, 1).astype(np.uint64)
        return [((h + np.uint64(i) * step) % width).astype(np.int64) for i in range(PROBES)]


@dataclass(frozen=True)
class LanguageModel:
    parts: DataFrame  # (range, size, bits): the filter's parts, written
    ranges: int
    tokens: int  # all tokens of the training documents
    types: int  # distinct ones
    documents: int

    @cached_property
    def filter(self) -> LogFrequencyFilter:
        """The whole filter on the driver, for a look into a small model; scoring does not gather it."""
        start, size = np.zeros(self.ranges, np.int64), np.zeros(self.ranges, np.int64)
        blobs, at = [], 0
        for row in self.parts.orderBy("range").toLocalIterator():
            start[row["range"]], size[row["range"]] = at, row["size"]
            blobs.append(bytes(row["bits"]))
            at += row["size"]
        return LogFrequencyFilter(self.ranges, start, size, np.frombuffer(b"".join(blobs) or b"\0", np.uint8))


def log10(
    own: np.ndarray, context: np.ndarray, pair: np.ndarray, tokens: int, types: int, share: float = SHARE
) -> np.ndarray:
    """The logarithm of each token's probability after the one before, from the filter's counts.

    After a token that was never seen nothing is known of what follows, and the word's own share is all.
    """
    ratio = np.minimum(1.0, pair / np.maximum(context, 1))
    single = np.minimum(1.0, (own + 1) / (tokens + types + 1))
    return np.log10(np.where(context > 0, share * ratio + (1 - share) * single, single))


def _counted(docs: DataFrame, ranges: int) -> DataFrame:
    """Training counts of words (batch 0) and pairs (batch 1) of some texts of an Arrow batch, by range.

    An Arrow batch has as many rows as it likes, of any length; ``COUNT_BYTES`` of it are counted at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last in _slices(sizes, COUNT_BYTES):
                tokens, before, _ = _row_tokens(word_hashes(texts.slice(first, last - first).to_pylist()))
                both = pairs(before, tokens)
                del before
                words, n = np.unique(tokens, return_counts=True)
                del tokens
                yield keycounts.batch_of(keycounts.sent(0, words, n, ranges, wide=True))
                both, n = np.unique(both, return_counts=True)
                yield keycounts.batch_of(keycounts.sent(1, both, n, ranges))
                del both, words, n

    return docs.select("text").mapInArrow(run, keycounts.SENT)


def _added(table: pa.Table, ranges: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """How many words a range has, distinct and in all; its keys and their levels."""
    bits = ranges.bit_length() - 1
    number = table.column("range")[0].as_py()
    keys, found = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    types = tokens = 0
    for kind in (0, 1):
        part = table.filter(pc.equal(table.column("batch"), kind))
        if not len(part):
            continue
        held, totals = keycounts.added(part, wide=kind == 0)[1::2]
        if kind == 0:
            types, tokens = len(held), int(totals.sum())
            held = _short(held.astype(np.uint64), ranges)
        else:
            high = np.uint64(number) << np.uint64(64 - bits)
            held = high | (held.astype(np.uint64) << np.uint64(32 - bits))
        keys.append(held)
        found.append(levels(totals).astype(np.uint8))
    return types, tokens, np.concatenate(keys), np.concatenate(found)


_LEVELS = "range int, types long, tokens long, keys binary, levels binary, histogram array<long>"


def _levelled(sent: DataFrame, ranges: int) -> DataFrame:
    """Keys and levels of each range, and how many words there are."""
    depth = len(_THRESHOLDS) + 1

    def run(table: pa.Table) -> pa.Table:
        types, tokens, key, level = _added(table, ranges)
        histogram = np.bincount(level, minlength=depth)
        return pa.table(
            {
                "range": table.column("range")[:1],
                "types": pa.array([types], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
                "keys": pa.array([key.astype("<u8").tobytes()], pa.binary()),
                "levels": pa.array([level.tobytes()], pa.binary()),
                "histogram": pa.array([histogram.tolist()], pa.list_(pa.int64())),
            }
        )

    return sent.groupBy("range").applyInArrow(run, _LEVELS)


_PARTS = "range int, size long, bits binary, types long, tokens long"
_PARTS_KINDS = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())


def _filled(keys: np.ndarray, level: np.ndarray) -> tuple[int, bytes]:
    """The filter's part of a range: every level of every key, as bits, and how many bits."""
    size = -(-int(level.sum(dtype=np.int64)) * BITS_PER_ENTRY // 8) * 8
    held = np.zeros(size, bool)
    for number in range(1, int(level.max(initial=0)) + 1):
        for mine in _runs(keys[level >= number]):
            for place in _positions(mine, number, np.full(len(mine), size)):
                held[place] = True
    return size, np.packbits(held, bitorder="little").tobytes()


def _parts(levelled: DataFrame, lowest: int) -> DataFrame:
    """The filter's parts from written levels, without the n-grams of levels below the lowest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = []
            for k, v in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                keys, level = np.frombuffer(k, "<u8"), np.frombuffer(v, np.uint8)
                filled.append(_filled(keys[level >= lowest], level[level >= lowest]))
            columns = (batch.column(0), [s for s, _ in filled], [b for _, b in filled], batch.column(3), batch.column(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, _PARTS_KINDS)], [f.split()[0] for f in _PARTS.split(", ")]
            )

    return levelled.select("range", "keys", "levels", "types", "tokens").mapInArrow(run, _PARTS)


def _counted_parts(sent: DataFrame, ranges: int) -> DataFrame:
    """The filter's parts of all n-grams, each built by the function that counts its range.

    Levels handed on to a second function would take a second Python worker beside each task's first.
    """

    def run(table: pa.Table) -> pa.Table:
        types, tokens, keys, level = _added(table, ranges)
        size, bits = _filled(keys, level)
        row = (table.column("range")[0].as_py(), size, bits, types, tokens)
        return pa.table({f.split()[0]: pa.array([v], k) for f, v, k in zip(_PARTS.split(", "), row, _PARTS_KINDS)})

    return sent.groupBy("range").applyInArrow(run, _PARTS)


def train(docs: DataFrame, text: str = "text", max_bytes: int | None = None) -> LanguageModel:
    """Count words and pairs of all texts and build the filter of all of them.

    Null and empty texts are an end alone. Repeated rows count as often as they come. Without documents the
    filter holds nothing. Only a caller that asks for ``max_bytes`` gets a smaller filter, without the n-grams
    of the lowest levels.
    """
    rows = docs.select(F.col(text).alias("text"))
    about = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    ranges = keycounts.ranges_for((about["b"] or 0) // 4)
    sent = _counted(rows, ranges)
    if max_bytes is None:
        parts = materialize(_counted_parts(sent, ranges), "filter")
    else:
        levelled = materialize(_levelled(sent, ranges), "levels")
        parts = materialize(_parts(levelled, _lowest(levelled, max_bytes)), "filter")
        del levelled
    del sent
    release(docs.sparkSession)
    facts = parts.select(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    return LanguageModel(parts.select("range", "size", "bits"), ranges, facts["tokens"] or 0, facts["types"] or 0, about["n"])


def _lowest(levelled: DataFrame, max_bytes: int) -> int:
    """The lowest level whose n-grams and those above fit into ``max_bytes``."""
    histogram = {
        r["level"]: r["n"]
        for r in levelled.select(F.posexplode("histogram").alias("level", "c"))
        .groupBy("level")
        .agg(F.sum("c").alias("n"))
        .collect()
    }
    entries = sum(level * n for level, n in histogram.items())
    lowest = 1
    while entries * BITS_PER_ENTRY > 8 * max_bytes:
        entries -= lowest * histogram.get(lowest, 0)
        lowest += 1
    return lowest


_ASKED = "batch long, range int, words binary, counts binary, pairs binary"
_TOLD = "batch long, range int, counts binary, words binary, pairs binary"


def _cut(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range starts among sorted keys, and their number at the end."""
    high, _ = keycounts.placed(keys, ranges)
    return np.searchsorted(high, np.arange(ranges + 1))


def _row_tokens(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of some texts, one text after another, the token before each, and how many each text has."""
    ends = np.cumsum(np.array([len(w) + 1 for w in words], np.int64))
    tokens = np.full(int(ends[-1]) if len(ends) else 0, END)
    inside = np.ones(len(tokens), bool)
    inside[ends - 1] = False
    tokens[inside] = np.concatenate([np.zeros(0, np.uint64), *words])
    # before the first token of a text stands an end, which is also the last token of the text before
    before = np.concatenate([np.full(min(1, len(tokens)), END), tokens[:-1]])
    return tokens, before, np.diff(ends, prepend=0)


def _slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of so many tokens at most, or one text."""
    ends = np.cumsum(lengths)
    first = taken = 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(ends, taken + most, "right")))
        yield first, last
        first, taken = last, int(ends[last - 1])


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; sorting is many times as fast as the hash table of ``np.unique``."""
    held = np.sort(keys)
    first = np.ones(len(held), bool)
    first[1:] = held[1:] != held[:-1]
    return held[first]


def _told(asked: DataFrame, model: LanguageModel, ranges: int) -> DataFrame:
    """To each batch, in the order it asked: exact counts of its words, and levels of its words and pairs.

    Where more texts are scored than were trained on, several ranges of the questions probe one part.
    """
    bits, own = ranges.bit_length() - 1, model.ranges
    finer = ranges // own
    parts = model.parts.withColumn(
        "range", F.explode(F.sequence(F.col("range") * finer, F.col("range") * finer + finer - 1))
    )

    def run(questions: pa.Table, part: pa.Table) -> pa.Table:
        if not len(questions):
            return pa.table({f.split()[0]: pa.array([], k) for f, k in zip(_TOLD.split(", "), _TOLD_KINDS)})
        number = questions.column("range")[0].as_py()
        names = ("batch", "words", "counts", "pairs")
        batch, words, counts, both = (questions.column(n).to_pylist() for n in names)
        words = [keycounts.unpacked_keys(w, "<u8") for w in words]
        both = [keycounts.unpacked_keys(p, "<u4") for p in both]
        held, place = np.unique(np.concatenate(words), return_inverse=True)
        weights = np.concatenate([keycounts.unpacked(c, "<i8") for c in counts])
        total = np.bincount(place, weights=weights, minlength=len(held)).astype("<i8")[place]
        size = part.column("size")[0].as_py() if len(part) else 0
        blob = part.column("bits")[0].as_py() if len(part) else b""
        zero, sizes = np.zeros(own, np.int64), np.full(own, size, np.int64)
        probed = LogFrequencyFilter(own, zero, sizes, np.frombuffer(blob or b"\0", np.uint8))

        def levels_of(keys: np.ndarray) -> np.ndarray:
            return probed.levels(_short(keys, own)).astype(np.uint8)

        word_levels = levels_of(held)[place]
        low, at = np.unique(np.concatenate(both), return_inverse=True)
        high = np.uint64(number) << np.uint64(64 - bits)
        pair_levels = levels_of(high | (low.astype(np.uint64) << np.uint64(32 - bits)))[at]
        w, p = (np.cumsum([0, *map(len, x)]) for x in (words, both))
        columns = (
            batch,
            [number] * len(batch),
            [keycounts.packed(total[i:j], "<i8") for i, j in zip(w, w[1:])],
            [word_levels[i:j].tobytes() for i, j in zip(w, w[1:])],
            [pair_levels[i:j].tobytes() for i, j in zip(p, p[1:])],
        )
        return pa.table({f.split()[0]: pa.array(c, k) for f, c, k in zip(_TOLD.split(", "), columns, _TOLD_KINDS)})

    return asked.groupBy("range").cogroup(parts.groupBy("range")).applyInArrow(run, _TOLD)


_TOLD_KINDS = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def score(
    docs: DataFrame, model: LanguageModel, train: Column, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, ``trained``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``train`` says which documents the model was trained on; the exact counts of the plain unigram score are
    theirs. ``score`` is the model's log10 probability of the text with its end. Null and empty texts are an
    end alone. Repeated rows are scored each.
    """
    rows = docs.select(
        F.col(key).alias("id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("trained")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // BATCH_BYTES))
    ranges = max(model.ranges, keycounts.ranges_for(size // 8))
    placed = rows.withColumn("batch", F.pmod(F.xxhash64("id", "text"), F.lit(batches)).cast("long"))
    all_tokens, all_types, documents = model.tokens, model.types, model.documents

    def send(table: pa.Table) -> pa.Table:
        tokens, before, lengths = _row_tokens(word_hashes(table.column("text").to_pylist()))
        both = _distinct(pairs(before, tokens))
        del before
        keys, place = np.unique(tokens, return_inverse=True)
        trained = np.array(table.column("trained").to_pylist(), np.int64)
        # the ends of texts are known from the number of documents, and not counted
        weight = np.where(tokens == END, 0, np.repeat(trained, lengths))
        counts = np.bincount(place, weights=weight, minlength=len(keys)).astype("<i8")
        del tokens, place, weight
        w, p = _cut(keys, ranges), _cut(both, ranges)
        _, low = keycounts.placed(both, ranges)
        number = table.column("batch")[0].as_py()
        used = np.flatnonzero((np.diff(w) > 0) | (np.diff(p) > 0)).tolist()
        columns = (
            [number] * len(used),
            used,
            [keycounts.packed_keys(keys[w[r] : w[r + 1]], "<u8") for r in used],
            [keycounts.packed(counts[w[r] : w[r + 1]], "<i8") for r in used],
            [keycounts.packed_keys(low[p[r] : p[r + 1]], "<u4") for r in used],
        )
        return pa.table({f.split()[0]: pa.array(c, k) for f, c, k in zip(_ASKED.split(", "), columns, _TOLD_KINDS)})

    told = _told(placed.groupBy("batch").applyInArrow(send, _ASKED), model, ranges)
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("trained", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def judge(texts: pa.Table, came: pa.Table) -> pa.Table:
        came = came.sort_by("range")
        tokens, before, lengths = _row_tokens(word_hashes(texts.column("text").to_pylist()))
        keys, place = np.unique(tokens, return_inverse=True)
        both, pair_place = np.unique(pairs(before, tokens), return_inverse=True)
        del tokens, before
        counts = np.concatenate(
            [np.zeros(0, "<i8"), *[keycounts.unpacked(c, "<i8") for c in came.column("counts").to_pylist()]]
        )
        word_levels = np.frombuffer(b"".join(came.column("words").to_pylist()), np.uint8)
        pair_levels = np.frombuffer(b"".join(came.column("pairs").to_pylist()), np.uint8)
        assert len(counts) == len(word_levels) == len(keys) and len(pair_levels) == len(both)
        end_place = np.searchsorted(keys, END)
        counts[end_place] = documents
        own, known = _SMALLEST[word_levels], (counts > 0).astype(np.int64)
        each = np.log10((counts + 1) / (all_tokens + 1 * (all_types + 1)))
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        ends = np.cumsum(lengths)
        for first, last in _slices(lengths, SLICE):
            start, stop = int(ends[first] - lengths[first]), int(ends[last - 1])
            at, starts = place[start:stop], (ends - lengths)[first:last] - start
            at_before = np.concatenate([[end_place], place[start : stop - 1]])
            pair = _SMALLEST[pair_levels[pair_place[start:stop]]]
            values = (
                lengths[first:last],
                np.add.reduceat(known[at], starts),
                np.full(last - first, all_tokens),
                np.add.reduceat(each[at], starts),
                np.add.reduceat(log10(own[at], own[at_before], pair, all_tokens, all_types), starts),
            )
            for held, value in zip(parts, values):
                held.append(value)
        columns = [np.concatenate(p) if p else np.zeros(0) for p in parts]
        arrays = [texts.column("id"), texts.column("trained")]
        for values, field in zip(columns, list(schema)[2:]):
            kind = pa.float64() if field.dataType == T.DoubleType() else pa.int64()
            arrays.append(pa.array(values).cast(kind))
        return pa.table(dict(zip([f.name for f in schema], arrays)))

    scored = placed.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(judge, schema)
    return scored.withColumnRenamed("id", key)
