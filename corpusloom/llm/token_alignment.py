"""Two tokenizers' tokens of the same texts, aligned by white-space anchors, and how often ids meet.

1. Each text is tokenised in full by both, and both tokens' bytes are verified against it. Where a single
   space stands between words both tokenise each word alone, and a word met before is remembered.
2. Where tokens of both end and the next tokens of both bear the mark of a space, an anchor is set: the
   ends are shared and verified, so that the text falls into windows of two runs of token ids.
3. A window is aligned once and remembered by the ids in it; most windows are a word met before. Windows
   of a batch that hold the same ids are found together, by hashes that are verified id by id, and those
   of a batch that are new are aligned together.
4. Links are counted per batch, then over the corpus. A batch asks for the counts of its own pairs by a
   join, so that nothing is broadcast but the highest count of each id of the second vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentencepiece import sentencepiece_model_pb2

from corpusloom.llm.packing import CACHED, PATTERN, Pieces, read_vocabulary, single_spaced, slices
from corpusloom.llm.shingles import mixed
from corpusloom.session import materialize

SPACE_MARK = "▁"  # fixed value: a space in pieces
TOGETHER = 1 << 21  # bytes of the texts aligned at once, a batch
LEARNED = 256  # new words tokenised in one go
REMEMBERED = 1 << 18  # windows a worker remembers; beyond it starts anew
_FACTOR = 0x9E3779B97F4A7C15
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# --- tokenizers -------------------------------------------------------------------------------------


def piece_bytes(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes each piece stands for; control pieces stand for none."""
    out = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        elif processor.is_control(i) or processor.is_unknown(i):
            out.append(b"")
        else:
            out.append(piece.replace(SPACE_MARK, " ").encode())
    return out


def parts_at_spaces(model: bytes) -> bool:
    """Whether a space and the word after it are tokenised the same wherever they stand.

    So it is where pieces are merged without normalising, every byte has its piece, spaces stay as they are
    with one put before the text, and no piece goes on over a space: no merge joins two words, and the order
    of merges inside of a word is its own.
    """
    held = sentencepiece_model_pb2.ModelProto.FromString(model)
    trainer, normaliser = held.trainer_spec, held.normalizer_spec
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    plain = normaliser.add_dummy_prefix and normaliser.escape_whitespaces and not normaliser.remove_extra_whitespaces
    plain = plain and not normaliser.precompiled_charsmap and not trainer.treat_whitespace_as_suffix
    if not plain or trainer.model_type != trainer.BPE or not trainer.byte_fallback:
        return False
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in held.pieces):
        return False
    pieces = {p.piece for p in held.pieces}
    return SPACE_MARK in pieces and not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)


class Tokens:
    """Byte lengths, space marks and decimal names of the ids of one vocabulary."""

    def __init__(self, entries: list[bytes], last: str):
        self.entries = entries
        self.lengths = np.array([len(x) for x in entries], np.int64)
        self.marked = np.array([x[:1] == b" " for x in entries], bool)
        # followed by a comma, or by what ends the ids of this vocabulary in a group
        self.names = np.array([f"{i}," for i in range(len(entries))] + [f"{i}{last}" for i in range(len(entries))], object)

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


class Remembered:
    """Ids of both vocabularies for some texts, by number, and whether their bytes are the text's."""

    def __init__(self) -> None:
        none = np.zeros(0, np.int64)
        self.ids = [np.zeros(0, np.int32)] * 2
        self.starts, self.sizes, self.right = [none] * 2, [none] * 2, np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self.right)

    def added(self, ids: list[np.ndarray], sizes: list[np.ndarray], right: np.ndarray) -> Remembered:
        """These and more of them, in the order of their numbers."""
        out = Remembered()
        for i in (0, 1):
            at = len(self.ids[i])
            out.ids[i] = np.concatenate([self.ids[i], ids[i].astype(np.int32)])
            out.starts[i] = np.concatenate([self.starts[i], at + np.cumsum(sizes[i]) - sizes[i]])
            out.sizes[i] = np.concatenate([self.sizes[i], sizes[i]])
        out.right = np.concatenate([self.right, right])
        return out


class Pair:
    """Both tokenizers, from what was broadcast."""

    def __init__(self, ranks: dict[bytes, int], model: bytes):
        entries = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            entries[i] = token
        self.a = Tokens(entries, "|")
        # without special tokens, so that their strings are plain text
        self.encoding = Pieces(
            tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks
        )
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b = Tokens(piece_bytes(self.processor), ";")
        self.alone = parts_at_spaces(model)
        self.words: dict[str, int] = {}
        self.known = Remembered()

    def _coded(self, texts: list[str], first: list[bytes], second: np.ndarray, nb: np.ndarray) -> tuple:
        """Both runs of ids of each text that follows a space, how many they are, and whether they spell it."""
        a = np.frombuffer(b"".join(first), "<u4").astype(np.int64)
        na = np.array([len(x) // 4 for x in first], np.int64)
        data = [b" " + t.encode("utf-8", "surrogatepass") for t in texts]
        size = np.array([len(x) for x in data], np.int64)
        # byte-level tokens are cut from the text's bytes, so that their lengths tell whether all are there
        upto = np.concatenate([[0], np.cumsum(self.a.lengths[a])])
        right = np.diff(upto[np.concatenate([[0], np.cumsum(na)])]) == size
        ids = second.tolist()
        if self.b.spell(ids) != b"".join(data):
            ends = [0, *np.cumsum(nb).tolist()]
            right &= np.array([self.b.spell(ids[i:j]) == x for i, j, x in zip(ends, ends[1:], data)], bool)
        else:
            upto = np.concatenate([[0], np.cumsum(self.b.lengths[second])])
            right &= np.diff(upto[np.concatenate([[0], np.cumsum(nb)])]) == size
        return [a, second], [na, nb], right

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the second vocabulary of each text, and how many."""
        found = self.processor.encode(texts, num_threads=1) if texts else []
        return np.fromiter(chain.from_iterable(found), np.int64), np.array([len(x) for x in found], np.int64)

    def _learn(self, new: set[str]) -> None:
        """Tokenise new words, several in one go: each starts at the one token with a space."""
        listed = list(new)
        if not listed:
            return
        self.encoding.learn(new)
        first = [self.encoding.pop(w) for w in listed]
        ids, _ = self._pieces([" ".join(listed[i : i + LEARNED]) for i in range(0, len(listed), LEARNED)])
        starts = np.flatnonzero(self.b.marked[ids])
        nb = np.diff(starts, append=len(ids))
        if len(starts) != len(listed):
            ids, nb = self._pieces(listed)
        start = len(self.known)
        self.known = self.known.added(*self._coded(listed, first, ids, nb))
        self.words.update(zip(listed, range(start, start + len(listed))))

    def tokenised(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Places of the texts that have tokens; the ids of these in both vocabularies, and how many each has."""
        places = [i for i, t in enumerate(texts) if t]
        split = [self._split(texts[i]) for i in places]
        wanted = set().union(*[words for words in split if words])
        new = wanted.difference(self.words)
        if len(self.words) + len(new) > CACHED:
            self.words, self.known, new = {}, Remembered(), wanted
        self._learn(new)
        # texts that cannot be split are numbered behind the words, for this once
        whole = [texts[i] for i, words in zip(places, split) if not words]
        held, number = self.known, len(self.known)
        if whole:
            held = held.added(*self._coded(whole, list(self.encoding.batch([" " + t for t in whole])), *self._pieces(whole)))
        counts = np.array([len(words) if words else 1 for words in split], np.int64)
        numbers: list[int] = []
        for words in split:
            if words:
                numbers += map(self.words.__getitem__, words)
            else:
                numbers.append(number)
                number += 1
        at = np.array(numbers, np.int64)
        if len(places):
            right = np.logical_and.reduceat(held.right[at], np.cumsum(counts) - counts)
            at, counts, places = at[np.repeat(right, counts)], counts[right], np.array(places)[right].tolist()
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids, sizes = [], []
        for i in (0, 1):
            n = held.sizes[i][at]
            ids.append(held.ids[i][_flat(held.starts[i][at], n)].astype(np.int64))
            sizes.append(np.diff(np.concatenate([[0], np.cumsum(n)])[ends]))
        return np.array(places, np.int64), ids, sizes

    def _split(self, text: str) -> list[str] | None:
        """The words of a text that both tokenise word by word; None for any other."""
        if not self.alone or text[-1] == " " or SPACE_MARK in text or not single_spaced(" " + text):
            return None
        return text.split(" ")


# --- windows ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Aligned:
    """Windows aligned: the text of each one's groups, how many, and its links, one window after another.

    A link is ``first id * second ids + second id``.
    """

    texts: list[str]
    groups: np.ndarray
    sizes: np.ndarray  # links of each window
    links: np.ndarray


def align_windows(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, pair: Pair) -> Aligned:
    """Cut windows where tokens of both end, and link what overlaps.

    ``a`` and ``b`` hold the ids of window after window, ``na`` and ``nb`` of them each. Between two ends
    of either, next to each other, lie the bytes of one pair of tokens: a link.
    """
    end_a, end_b = np.cumsum(pair.a.lengths[a]), np.cumsum(pair.b.lengths[b])
    at = np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)
    both_a = end_b[at] == end_a
    both_b = np.zeros(len(b), bool)
    both_b[at[both_a]] = True
    # where the ends of b that a has not fall among those of a
    ends = np.sort(np.concatenate([end_a, end_b[~both_b]]), kind="stable")
    at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    links = a[at_a] * len(pair.b.entries) + b[at_b]
    last_a, last_b = np.cumsum(na) - 1, np.cumsum(nb) - 1
    link_cuts = np.searchsorted(ends, end_a[last_a], "right")
    upto_a, upto_b = np.cumsum(both_a), np.cumsum(both_b)
    groups = np.diff(upto_a[last_a], prepend=0)
    # ids in the order of the text: those of a group in a, then those in b
    group_a, group_b = upto_a - both_a, upto_b - both_b
    spoken = np.empty(len(a) + len(b), object)
    before_b = np.searchsorted(group_b, group_a)
    spoken[np.arange(len(a)) + before_b] = pair.a.names[a + both_a * len(pair.a.entries)]
    before_a = np.searchsorted(group_a, group_b, "right")
    spoken[np.arange(len(b)) + before_a] = pair.b.names[b + both_b * len(pair.b.entries)]
    words, cuts = spoken.tolist(), [0, *np.cumsum(na + nb).tolist()]
    texts = ["".join(words[i:j])[:-1] for i, j in zip(cuts, cuts[1:])]
    return Aligned(texts, groups, np.diff(link_cuts, prepend=0), links)


def _flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that start and are as long as given, one run after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _run_hashes(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of ids, the same wherever the run stands."""
    n = len(ids)
    with np.errstate(over="ignore"):

        def powers(base: int) -> np.ndarray:
            return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))

        part = mixed(ids.astype(np.uint64) + np.uint64(1)) * powers(_FACTOR)[:n]
        total = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
        back = powers(pow(_FACTOR, -1, 1 << 64))
        return mixed((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _same(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, as_in: np.ndarray) -> bool:
    """Whether every run, of runs that tile ``ids``, holds what the run holds that stands for it."""
    if not np.array_equal(lengths, lengths[as_in]):
        return False
    shift = np.repeat(starts[as_in] - starts, lengths)
    return np.array_equal(ids[np.arange(len(ids)) + shift], ids)


@dataclass
class Windows:
    """The windows of some texts: starts and lengths in both runs of ids, and the text of each."""

    a0: np.ndarray
    b0: np.ndarray
    na: np.ndarray
    nb: np.ndarray
    of: np.ndarray

    @classmethod
    def cut(cls, a: np.ndarray, b: np.ndarray, a_ends_of: np.ndarray, pair: Pair) -> Windows:
        """Windows between anchors; ``a_ends_of`` holds the number of ids in ``a`` up to each text's end."""
        end_a, end_b = np.cumsum(pair.a.lengths[a]), np.cumsum(pair.b.lengths[b])
        at = np.searchsorted(end_b, end_a)
        shared = np.flatnonzero(end_b[at] == end_a)
        ia, ib = shared, at[shared]
        next_a, next_b = np.minimum(ia + 1, len(a) - 1), np.minimum(ib + 1, len(b) - 1)
        anchor = pair.a.marked[a[next_a]] & pair.b.marked[b[next_b]]
        anchor |= np.isin(ia + 1, a_ends_of)
        stop_a, stop_b = ia[anchor] + 1, ib[anchor] + 1
        a0, b0 = np.concatenate([[0], stop_a[:-1]]), np.concatenate([[0], stop_b[:-1]])
        of = np.searchsorted(a_ends_of, a0, "right")
        return cls(a0, b0, stop_a - a0, stop_b - b0, of)

    def distinct(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first window of each kind, and the kind of each window."""
        with np.errstate(over="ignore"):
            h = mixed(_run_hashes(a, self.a0, self.a0 + self.na))
            h = mixed(h + _run_hashes(b, self.b0, self.b0 + self.nb))
        _, first, kind = np.unique(h, return_index=True, return_inverse=True)
        as_in = first[kind]
        if _same(a, self.a0, self.na, as_in) and _same(b, self.b0, self.nb, as_in):
            return first, kind
        # two hashes are equal by chance: every window for itself
        every = np.arange(len(self.a0))
        return every, every


class Aligner:
    """Aligns batches of texts and remembers windows by the ids in them."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        # a window's number by its ids; what is known of it by its number
        self.known: dict[bytes, int] = {}
        self.texts: list[str] = []
        none = np.zeros(0, np.int64)
        self.groups, self.sizes, self.starts, self.links = none, none, none, none

    def numbers(self, a: np.ndarray, b: np.ndarray, windows: Windows, first: np.ndarray) -> np.ndarray:
        """The numbers of the given windows; those that are not known yet are aligned together."""
        a_ids, b_ids = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
        ends = (x[first] * 4 for x in (windows.a0, windows.a0 + windows.na, windows.b0, windows.b0 + windows.nb))
        # no id is as large as what stands between the two runs
        keys = [
            a_ids[i:j] + b"\xff\xff\xff\xff" + b_ids[k:m] for i, j, k, m in zip(*[x.tolist() for x in ends])
        ]
        if len(self.known) > REMEMBERED:
            self.forget()
        found = list(map(self.known.get, keys))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            own = first[new]
            na, nb = windows.na[own], windows.nb[own]
            aligned = align_windows(a[_flat(windows.a0[own], na)], b[_flat(windows.b0[own], nb)], na, nb, self.pair)
            start, held = len(self.texts), len(self.links)
            self.texts += aligned.texts
            self.groups = np.concatenate([self.groups, aligned.groups])
            self.starts = np.concatenate([self.starts, held + np.cumsum(aligned.sizes) - aligned.sizes])
            self.sizes = np.concatenate([self.sizes, aligned.sizes])
            self.links = np.concatenate([self.links, aligned.links])
            for number, i in enumerate(new, start):
                self.known[keys[i]] = found[i] = number
        return np.array(found, np.int64)

    def batch(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], list[bytes], list[bytes]]:
        """``COUNTS``, groups, distinct pairs and how often each occurs, of each text."""
        n = len(texts)
        counts = {c: np.zeros(n, np.int64) for c in COUNTS}
        groups, pairs, times = [""] * n, [b""] * n, [b""] * n
        rows, (a, b), (na, nb) = self.pair.tokenised(texts)
        if not len(rows):
            return counts, groups, pairs, times
        counts["n_a"][rows], counts["n_b"][rows] = na, nb
        windows = Windows.cut(a, b, np.cumsum(na), self.pair)
        first, kind = windows.distinct(a, b)
        number = self.numbers(a, b, windows, first)[kind]
        counts["n_groups"][rows] = np.bincount(windows.of, self.groups[number], len(rows)).astype(np.int64)
        sizes = self.sizes[number]
        code = self.links[_flat(self.starts[number], sizes)]
        of = np.repeat(windows.of, sizes)
        counts["n_links"][rows] = np.bincount(of, minlength=len(rows))
        names, local = np.unique(code, return_inverse=True)
        keys, n_times = np.unique(of * len(names) + local, return_counts=True)
        cut = np.searchsorted(keys // len(names), np.arange(len(rows) + 1)).tolist()
        own, n_times = names[keys % len(names)].astype("<u8").tobytes(), n_times.astype("<u4").tobytes()
        spoken = list(map(self.texts.__getitem__, number.tolist()))
        upto = np.searchsorted(windows.of, np.arange(len(rows) + 1)).tolist()
        for j, row in enumerate(rows.tolist()):
            groups[row] = ";".join(spoken[upto[j] : upto[j + 1]])
            pairs[row] = own[8 * cut[j] : 8 * cut[j + 1]]
            times[row] = n_times[4 * cut[j] : 4 * cut[j + 1]]
        return counts, groups, pairs, times


# --- the corpus -------------------------------------------------------------------------------------


def _aligned(docs: DataFrame, ranks: dict[bytes, int], model: bytes) -> DataFrame:
    """``__key``, ``__batch``, the counts, ``groups``, ``pairs`` and ``times`` of each row."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, model))
    schema = T.StructType(
        [
            T.StructField("__key", docs.schema["__key"].dataType),
            T.StructField("__batch", T.LongType()),
            *[T.StructField(c, T.LongType()) for c in COUNTS],
            T.StructField("groups", T.StringType()),
            T.StructField("pairs", T.BinaryType()),
            T.StructField("times", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(Pair(*sent.value)), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in slices(texts, TOGETHER):
                counts, groups, pairs, times = aligner.batch(texts[start:end])
                arrays = [
                    batch.column(0).slice(start, end - start),
                    pa.array(np.full(end - start, number)),
                    *[pa.array(counts[c]) for c in COUNTS],
                    pa.array(groups, pa.string()),
                    pa.array(pairs, pa.binary()),
                    pa.array(times, pa.binary()),
                ]
                number += 1
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select("__key", "__text").mapInArrow(run, schema)


def _held(pairs: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of some rows, and how often each row holds its own."""
    return np.frombuffer(b"".join(pairs.to_pylist()), "<u8"), np.frombuffer(b"".join(times.to_pylist()), "<u4")


def _batch_pairs(aligned: DataFrame) -> DataFrame:
    """(``batch``, ``pair``, ``n``): the links of each batch, each pair once for what a task reads of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            for number in np.unique(numbers):
                mine = pa.array(numbers == number)
                pairs, times = _held(batch.column(1).filter(mine), batch.column(2).filter(mine))
                names, place = np.unique(pairs, return_inverse=True)
                n = np.bincount(place, times, len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), number)), pa.array(names.astype(np.int64)), pa.array(n)],
                    ["batch", "pair", "n"],
                )

    return aligned.select("__batch", "pairs", "times").mapInArrow(run, "batch long, pair long, n long")


def pair_counts(aligned: DataFrame, second_ids: int) -> DataFrame:
    """(``pair``, ``n``, ``best``) over the corpus: whether ``n`` is the highest of the second id's pairs.

    A pair is ``first id * second_ids + second id``. The highest counts are a row for each id of the second
    vocabulary at most, and broadcast.
    """
    totals = materialize(
        _batch_pairs(aligned).groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs"
    )
    of = (F.col("pair") % second_ids).alias("second")
    highest = totals.groupBy(of).agg(F.max("n").alias("most"))
    marked = totals.select("*", of).join(F.broadcast(highest), "second")
    return marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    key: str = "doc_id",
    text: str = "text",
    outputs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per document: key, counts, what ``outputs`` makes of ``groups``, ``n_best``, ``count_sum``.

    ``byte_level`` is a byte-level vocabulary file that reads a space and the text, ``pieces`` a model of
    pieces with byte fallback that puts the space there itself. ``groups`` is ``a1,a2|b1;a3|b2,b3`` in ids,
    cut where tokens of both end. A link is a pair of overlapping tokens; ``count_sum`` adds up, over a
    document's links, how many links of the corpus hold the same ids, ``n_best`` counts the links whose
    number no other pair with that second id exceeds. Null and empty texts, and those whose tokens do not
    spell the text, have no tokens: 0 in every count and empty groups. Repeated rows each count.
    """
    with open(pieces, "rb") as file:
        model = file.read()
    ranks, _ = read_vocabulary(byte_level)
    second_ids = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    outputs = {"groups": F.col("groups")} if outputs is None else dict(outputs)
    source = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    aligned = materialize(
        _aligned(source, ranks, model).select(
            "__key", "__batch", *COUNTS, *[c.alias(name) for name, c in outputs.items()], "pairs", "times"
        ),
        "alignments",
    )
    counted = pair_counts(aligned, second_ids)
    asked = _batch_pairs(aligned).select("batch", "pair").join(counted, "pair").select("batch", "pair", "n", "best")
    given = [f for f in aligned.schema.fields if f.name not in ("__batch", "pairs", "times")]
    schema = T.StructType([*given, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def scored(rows: pa.Table, came: pa.Table) -> pa.Table:
        pairs, times = _held(rows.column("pairs"), rows.column("times"))
        sizes = np.array([len(x) // 8 for x in rows.column("pairs").to_pylist()], np.int64)
        of = np.repeat(np.arange(len(sizes)), sizes)
        names, first = np.unique(came.column("pair").to_numpy(), return_index=True)
        place = first[np.searchsorted(names, pairs.astype(np.int64))] if len(pairs) else np.zeros(0, np.int64)
        n = came.column("n").to_numpy()[place]
        best = came.column("best").to_numpy()[place].astype(bool)
        sums = np.zeros((2, len(sizes)), np.int64)
        np.add.at(sums[0], of, np.where(best, times, 0).astype(np.int64))
        np.add.at(sums[1], of, n * times)
        kept = rows.select([f.name for f in given])
        return kept.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))

    met = aligned.groupBy("__batch").cogroup(asked.groupBy("batch")).applyInArrow(scored, schema)
    return met.withColumnRenamed("__key", key)
