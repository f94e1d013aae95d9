"""Best-fit packing of token pieces into sequences by bin completion over a length histogram.

Only the histogram of piece lengths, at most ``capacity`` rows whatever the corpus, reaches the driver.
There the sequences are planned as patterns with multiplicities: around the largest piece that is left,
undominated fillings are enumerated by waste, branches whose waste cannot beat the incumbent are pruned,
and the incumbent starts as the best-fit-decreasing solution. The plan goes back as a table of rank ranges
per length, bounded like the histogram, and a join on ranks gives every piece its sequence and offset.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.rows import ROW, gapless, with_rows

# Fixed value: how text is cut before merging, for vocabularies of this byte-level kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED = 400_000  # cut words a worker remembers; beyond it starts anew
_RUN = re.compile(r" \s|\s ")
TOGETHER = 1 << 21  # characters of the texts encoded at once
NODES = 50_000  # branches looked at in search of fewer sequences than best fit needs


# --- tokens -----------------------------------------------------------------------------------------


def _byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes are themselves."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks by bytes, and special tokens, of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    back = _byte_characters()
    ranks = {
        bytes(back[c] for c in token): i
        for token, i in held["model"]["vocab"].items()
        if token not in special
    }
    return ranks, special


def id_width(ranks: dict[bytes, int], special: dict[str, int]) -> int:
    """Bytes that hold any id of a vocabulary: 2 up to 65,536 ids, else 4."""
    return 2 if max([*ranks.values(), *special.values()], default=0) < 1 << 16 else 4


def single_spaced(text: str) -> bool:
    """Whether no space stands beside white space."""
    return not _RUN.search(text)


class Pieces(dict):
    """Token ids, as bytes, of a space and the word after it; new words of a batch are encoded together."""

    def __init__(self, encoding: tiktoken.Encoding, ranks: dict[bytes, int]):
        super().__init__()
        self.encoding = encoding
        marked = np.zeros(max([*ranks.values(), *encoding._special_tokens.values()], default=0) + 1, bool)
        marked[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.marked = marked

    def ids(self, text: str) -> bytes:
        if any(mark in text for mark in self.encoding.special_tokens_set):
            found = self.encoding.encode(text, allowed_special="all")
        else:
            found = self.encoding.encode_ordinary(text)
        return array("I", found).tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode words that hold no white space at either end, nor a space, in one go.

        A space before a word always starts a token, and no other token of the word begins with one, so that
        the ids of all of them fall apart at the tokens that do.
        """
        marks = self.encoding.special_tokens_set
        alone = {w for w in words if not w or any(mark in w for mark in marks)}
        for word in alone:
            self[word] = self.ids(" " + word)
        listed = list(words - alone)
        if not listed:
            return
        found = np.frombuffer(array("I", self.encoding.encode_ordinary(" " + " ".join(listed))), "<u4")
        starts = np.flatnonzero(self.marked[found])
        if len(starts) != len(listed):
            self.update({word: self.ids(" " + word) for word in listed})
            return
        data, edges = found.tobytes(), [*(4 * starts).tolist(), 4 * len(found)]
        self.update(zip(listed, [data[i:j] for i, j in zip(edges, edges[1:])]))

    def batch(self, texts: Sequence[str]) -> Iterator[bytes]:
        """The ids of each text."""
        # a single space between two others always starts a cut, so the words can be encoded alone
        split = [t.split(" ") if single_spaced(t) else None for t in texts]
        wanted: set[str] = set()
        for words in split:
            if words:
                wanted.update(words[1:])
        new = wanted.difference(self)
        if len(self) + len(new) > CACHED:
            self.clear()
            new = wanted
        self.learn(new)
        for text, words in zip(texts, split):
            if words is None:
                yield self.ids(text)
            else:
                first = self.ids(words[0]) if words[0] else b""
                yield first + b"".join(map(self.__getitem__, words[1:]))


def slices(texts: Sequence[str | None], together: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Runs of texts of about so many characters; a very long one is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if i > start and size + length > together:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 2,
    capacity: int = 1024,
    width: int = 4,
) -> DataFrame:
    """Cut each document's ids into pieces: (key, ``piece``, ``start``, ``length``, ``ids``).

    A document is its ids and then ``end``; null and empty texts are ``end`` alone. Only documents longer
    than ``capacity`` are cut, into pieces of ``capacity`` of which the first may be shorter. ``ids`` are
    little-endian unsigned integers of ``width`` bytes, 4 or, if all ids fit (``id_width``), 2. Repeated rows
    give their pieces each.
    """
    vocabulary = read_vocabulary(tokenizer)
    if width not in (2, 4) or width < id_width(*vocabulary) or end >= 1 << 8 * width:
        raise ValueError(f"ids do not fit into {width} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, special = sent.value
        pieces = Pieces(
            tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), ranks
        )
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, stop in slices(texts):
                of, numbers, starts, lengths, ids = [], [], [], [], []
                for row, held in enumerate(pieces.batch(texts[begin:stop]), begin):
                    held += last
                    n = len(held) // 4
                    if width == 2:
                        held = np.frombuffer(held, "<u4").astype("<u2").tobytes()
                    edges = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                    for number, (a, b) in enumerate(zip(edges, edges[1:])):
                        of.append(row)
                        numbers.append(number)
                        starts.append(a)
                        lengths.append(b - a)
                        ids.append(held[width * a : width * b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(of, pa.int64())),
                        pa.array(numbers, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["key", "piece", "start", "length", "ids"],
                )

    cut = docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
    return cut.withColumnRenamed("key", key)


def widened(pieces: DataFrame, width: int, ids: str = "ids") -> DataFrame:
    """The same rows with ids of ``width`` bytes as unsigned 32-bit integers."""
    if width == 4:
        return pieces
    # two zero bytes after every two, without a Python worker for it
    return pieces.withColumn(ids, F.unhex(F.regexp_replace(F.hex(ids), "(....)", "$10000")))


# --- the plan ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that all hold the same pieces, as (length, count)."""

    times: int
    pieces: tuple[tuple[int, int], ...]


def _counted(lengths: list[int]) -> tuple[tuple[int, int], ...]:
    return tuple((n, lengths.count(n)) for n in sorted(set(lengths), reverse=True))


def best_fit(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, with all pieces of a length and all bins of a kind at once."""
    bins: dict[int, list[tuple[list[int], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((r for r, held in bins.items() if held and r >= length), default=None)
            if room is None:
                room, held, count = capacity, [], -(-left // (capacity // length))
            else:
                held, count = bins[room].pop()
            each = room // length
            full = min(count, left // each)
            if full:
                bins.setdefault(room - each * length, []).append((held + [length] * each, full))
                left -= full * each
                count -= full
            if left and count:
                some = min(each, left)
                bins.setdefault(room - some * length, []).append((held + [length] * some, 1))
                left -= some
                count -= 1
            if count and held:
                bins.setdefault(room, []).append((held, count))
    return [Pattern(n, _counted(held)) for kinds in bins.values() for held, n in kinds]


def _dominates(a: list[int], b: list[int]) -> bool:
    """Whether the pieces of ``b`` fit into places as large as the pieces of ``a``: then ``a`` is no worse."""
    rooms = sorted(a, reverse=True)
    for piece in sorted(b, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= piece]
        if not fits:
            return False
        i = min(fits, key=lambda k: rooms[k])
        rooms[i] -= piece
    return True


def _sums(left: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """Bit sets of the sums up to ``room`` that the first 0, 1, 2 ... of the lengths reach."""
    mask = (1 << (room + 1)) - 1
    reach = [1]
    for n in lengths:
        now, copies, step = reach[-1], min(left[n], room // n), 1
        while copies > 0:
            take = min(step, copies)
            now |= (now << (take * n)) & mask
            copies -= take
            step *= 2
        reach.append(now)
    return reach


def _spelled(total: int, upto: int, left: dict[int, int], lengths: list[int], reach: list[int]) -> Iterator[list[int]]:
    """All multisets of the first ``upto`` lengths with a sum, the largest pieces first."""
    if not total:
        yield []
        return
    for i in range(upto - 1, -1, -1):
        if not reach[i + 1] >> total & 1:
            return  # nor do fewer lengths reach it
        n = lengths[i]
        for k in range(min(left[n], total // n), 0, -1):
            if reach[i] >> (total - k * n) & 1:
                for rest in _spelled(total - k * n, i, left, lengths, reach):
                    yield [n] * k + rest


def fillings(left: dict[int, int], room: int, most_waste: int) -> Iterator[list[int] | None]:
    """All undominated fillings of ``room`` that waste at most ``most_waste``, the least waste first.

    None stands for one that an earlier filling dominates, and for every 64 comparisons, so that a caller
    can end a long search.
    """
    lengths = sorted(n for n in left if left[n] and n <= room)
    reach = _sums(left, lengths, room)
    found: list[list[int]] = []
    sums = reach[-1]
    while sums:
        total = sums.bit_length() - 1
        if room - total > most_waste:
            break
        sums ^= 1 << total
        for held in _spelled(total, len(lengths), left, lengths, reach):
            dominated = False
            for i, other in enumerate(found, 1):
                if not i % 64:
                    yield None
                if dominated := _dominates(other, held):
                    break
            if dominated:
                yield None
            else:
                found.append(held)
                yield held


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """Sequences that are needed at least: by the tokens, and by the pieces larger than half of one."""
    total = sum(n * c for n, c in histogram.items())
    return max(-(-total // capacity), sum(c for n, c in histogram.items() if 2 * n > capacity))


def plan(histogram: dict[int, int], capacity: int, nodes: int = NODES) -> list[Pattern]:
    """Patterns that use every piece: best fit, or what bin completion finds to need fewer sequences.

    Around the largest piece left every undominated filling is tried within the waste that could still beat
    the incumbent, the least waste first, and every multiplicity, the largest first. The search ends when it
    meets the lower bound, has tried everything or has looked at ``nodes`` branches; its effort depends on
    the lengths present, not on how many pieces there are.
    """
    best = best_fit(histogram, capacity)
    incumbent, bound = sum(p.times for p in best), lower_bound(histogram, capacity)

    def branches(left: dict[int, int], used: int, tokens: int) -> Iterator[tuple | None]:
        largest = max(left)
        less = dict(left)
        less[largest] -= 1
        # sequences that the incumbent leaves to waste, at most
        slack = (incumbent - 1 - used) * capacity - tokens
        for held in fillings(less, capacity - largest, slack):
            if held is None:
                yield None
                continue
            pieces = _counted([largest, *held])
            placed = sum(n * k for n, k in pieces)
            for times in range(min(left[n] // k for n, k in pieces), 0, -1):
                after = dict(left)
                for n, k in pieces:
                    after[n] -= k * times
                    if not after[n]:
                        del after[n]
                yield after, Pattern(times, pieces), used + times, tokens - times * placed

    # depth first; a node is the patterns so far and what is left to try after them
    root = {n: c for n, c in histogram.items() if c}
    tokens = sum(n * c for n, c in root.items())
    stack = [(None, branches(root, 0, tokens))] if root else []
    looked = 0
    while stack and looked < nodes and incumbent > bound:
        looked += 1
        path, more = stack[-1]
        branch = next(more, False)
        if branch is False:
            stack.pop()
        elif branch is not None:
            after, pattern, used, tokens = branch
            if not tokens and used < incumbent:
                incumbent, best, path = used, [], (pattern, path)
                while path is not None:
                    best.append(path[0])
                    path = path[1]
            elif tokens and used + -(-tokens // capacity) < incumbent:
                # without further waste it would be better
                stack.append(((pattern, path), branches(after, used, tokens)))
    return best


# --- the whole table --------------------------------------------------------------------------------


def pack(
    pieces: DataFrame,
    capacity: int = 1024,
    length: str = "length",
    sequence: str = "sequence_id",
    offset: str = "offset",
) -> DataFrame:
    """Add to each piece its sequence and its place there; sequences are filled gapless from 0.

    All rows and columns stay. Lengths must be 1 to ``capacity``; others raise. An empty table gives an
    empty table. Pieces are numbered within their length in chunks, so one length may be that of most
    pieces.
    """
    written = with_rows(pieces, "pieces")
    counted = written.groupBy(F.col(length).cast("long").alias("n")).count()
    histogram = {r["n"]: r["count"] for r in counted.limit(capacity + 1).collect()}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    patterns = plan(histogram, capacity)
    ranges, taken, first = [], dict.fromkeys(histogram, 0), 0
    for p in patterns:
        at = 0
        for n, k in p.pieces:
            ranges.append((n, taken[n], taken[n] + k * p.times, first, k, at))
            taken[n] += k * p.times
            at += n * k
        first += p.times
    schema = "__tokens long, __from long, __to long, __first long, __each long, __at long"
    # as many rows as the patterns have lengths: bounded by the capacity, not by the corpus
    plan_rows = F.broadcast(pieces.sparkSession.createDataFrame(ranges, schema))
    # row numbers and lengths alone are ranked; the pieces themselves move once, to their places
    narrow = written.select(ROW, F.col(length).cast("long").alias("__tokens"))
    inside = F.col("__rank") - F.col("__from")
    placed = (
        gapless(narrow, ["__tokens"], "__rank")
        .join(plan_rows, "__tokens")
        .where((F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
        .withColumn(sequence, F.col("__first") + F.floor(inside / F.col("__each")))
        .withColumn(offset, F.col("__at") + inside % F.col("__each") * F.col("__tokens"))
        .select(ROW, sequence, offset)
    )
    return written.join(placed, ROW).select(*pieces.columns, sequence, offset)
