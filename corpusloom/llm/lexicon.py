"""Byte-pair encoding through a minimal acyclic transducer, exact for every text.

Frequent words and their ids are compiled into an automaton that shares prefixes and suffixes. The number
of words behind each edge makes the path of a word its index, and the index leads to its ids, so words with
common endings share states in spite of different outputs. Workers memory-map the compiled arrays and look
up all new words of a batch at once, one character of all of them at a time; words outside the lexicon are
merged together by the ranks of the vocabulary. New cuts are cut into words together, and the ids of a
batch are decoded together.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import sys
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from corpusloom.llm.packing import slices
from corpusloom.session import materialize

WORDS = 200_000  # words of the lexicon
LONGEST = 64  # bytes of a lexicon word
CACHED = 600_000  # cut words a worker remembers; beyond it starts anew
# White space as the tokenizer's normaliser knows it, and how words are cut.
SPACE = r"[\t-\r \x85\xa0  -     　]"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MARKS = tuple(".,;:!?|")
TOGETHER = 100_000  # cuts that are cut into words at once
# the same words of lower-case ASCII, and the ends of lines that keep one cut from the next
_ASCII = re.compile(rb"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_OTHER_SPACE = regex.compile("[\x1c-\x1f]")  # white space to Python alone


@dataclass(frozen=True)
class Vocabulary:
    """Ids by token, the rank of each pair of ids that merges, what it makes, and special tokens."""

    ids: dict[str, int]
    ranks: dict[int, int]  # by the first id times 2 ** 32 plus the second
    made: list[int]  # by rank
    special: dict[str, int]
    word_end: str
    letters: str  # inside of a character class
    numbers: str
    lower: dict[str, str]  # what the tokenizer makes of letters that Python does not know

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        ids = dict(model["vocab"])
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return Vocabulary(
            ids,
            {(ids[a] << 32) + ids[b]: i for i, (a, b) in enumerate(merges)},
            [ids[a + b] for a, b in merges],
            {t["content"]: t["id"] for t in held["added_tokens"]},
            model["end_of_word_suffix"] or "",
            *character_classes(path),
        )

    def parts(self) -> tuple:
        """The fields, which travel to workers that cannot import this class."""
        return self.ids, self.ranks, self.made, self.special, self.word_end, self.letters, self.numbers, self.lower


def byte_table() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    held = set(shown)
    return [chr(b) if b in held else chr(next(hidden)) for b in range(256)]


def merge(word: str, vocabulary: Vocabulary) -> list[int]:
    """Ids of one word of byte characters: the pair of the lowest rank first, from the left."""
    if not word:
        return []
    ids = vocabulary.ids
    parts = [ids[c] for c in word[:-1]]
    parts.append(ids[word[-1] + vocabulary.word_end])
    if len(parts) > 200:
        return _merge_long(parts, vocabulary)
    rank, made = vocabulary.ranks.get, vocabulary.made
    none = len(made)
    ranks = [rank((a << 32) + b, none) for a, b in zip(parts, parts[1:])]
    while ranks:
        best = min(ranks)
        if best == none:
            break
        i = ranks.index(best)
        parts[i] = made[best]
        del parts[i + 1], ranks[i]
        if i:
            ranks[i - 1] = rank((parts[i - 1] << 32) + parts[i], none)
        if i < len(ranks):
            ranks[i] = rank((parts[i] << 32) + parts[i + 1], none)
    return parts


def _merge_long(parts: list[int], vocabulary: Vocabulary) -> list[int]:
    """The same with a heap of pairs, for words of any length."""
    ranks, made = vocabulary.ranks, vocabulary.made
    parts = list(parts)
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]
    heap: list[tuple[int, int, int, int]] = []

    def push(i: int) -> None:
        j = after[i]
        if j >= 0:
            found = ranks.get((parts[i] << 32) + parts[j])
            if found is not None:
                heapq.heappush(heap, (found, i, parts[i], parts[j]))

    for i in range(len(parts)):
        push(i)
    while heap:
        best, i, a, b = heapq.heappop(heap)
        j = after[i] if parts[i] == a else -1
        if j < 0 or parts[j] != b:
            continue
        parts[i], parts[j] = made[best], -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [p for p in parts if p >= 0]


class Merger:
    """Merges many words at once: in each round the pair of the lowest rank of every word, the first of equals."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        order = np.argsort(np.array(list(vocabulary.ranks), np.int64))
        self.pairs = np.array(list(vocabulary.ranks), np.int64)[order]
        self.pair_ranks = np.array(list(vocabulary.ranks.values()), np.int64)[order]
        self.made = np.array(vocabulary.made, np.int64)
        table, ids = byte_table(), vocabulary.ids
        self.inside = np.array([ids.get(c, 0) for c in table], np.int64)
        self.last = np.array([ids.get(c + vocabulary.word_end, 0) for c in table], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or the number of ranks where it has none."""
        wanted = (left << 32) + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], len(self.made))

    def merge(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of each word, of 1 to 200 bytes."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        flat, counts = self.merged(data, lengths)
        blob = flat.tobytes()
        cuts = [0, *(4 * np.cumsum(counts)).tolist()]
        return [blob[i:j] for i, j in zip(cuts, cuts[1:])]

    def merged(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of such lengths that stand one after another, and how many each word has."""
        ends, none = np.cumsum(lengths), len(self.made)
        parts = self.inside[data]
        parts[ends - 1] = self.last[data[ends - 1]]
        of = np.repeat(np.arange(len(lengths)), lengths)
        ranks = np.full(len(parts), none)
        if len(self.pairs):
            ranks[:-1] = self._ranks(parts[:-1], parts[1:])
        ranks[ends - 1] = none
        done_parts, done_of = [], []
        while len(parts):
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            sizes = np.diff(np.append(starts, len(of)))
            best = np.minimum.reduceat(ranks, starts)
            open_words = best < none
            going = np.repeat(open_words, sizes)
            done_parts.append(parts[~going])
            done_of.append(of[~going])
            each = np.repeat(best, sizes)[going]
            parts, of, ranks = parts[going], of[going], ranks[going]
            if not len(parts):
                break
            hits = np.flatnonzero(ranks == each)
            first = hits[np.diff(of[hits], prepend=-1) > 0]
            parts[first] = self.made[ranks[first]]
            kept = np.ones(len(parts), bool)
            kept[first + 1] = False
            # after the second parts are gone, each first one has moved by those before it
            at = first - np.arange(len(first))
            parts, of, ranks = parts[kept], of[kept], ranks[kept]
            for place in (at, at - 1):
                ahead = np.minimum(place + 1, len(parts) - 1)
                real = (place >= 0) & (place + 1 < len(parts))
                real &= of[ahead] == of[place]
                inside = place[real]
                ranks[inside] = self._ranks(parts[inside], parts[inside + 1])
                if place is at:
                    ranks[place[~real]] = none
        flat, of = np.concatenate(done_parts), np.concatenate(done_of)
        order = np.argsort(of, kind="stable")
        return flat[order].astype("<u4"), np.bincount(of, minlength=len(lengths))


# --- the automaton ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """Edges sorted by ``state * 256 + byte``: the state they lead to and the words that sort before."""

    edges: np.ndarray
    target: np.ndarray
    before: np.ndarray
    final: np.ndarray  # whether a word ends in a state
    starts: np.ndarray  # of each word's ids
    ids: np.ndarray

    def find(self, words: Sequence[bytes]) -> np.ndarray:
        """The index of each word, or -1: all words advance together by one byte."""
        n = len(words)
        index, state = np.zeros(n, np.int64), np.zeros(n, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, n)
        if not n or not len(self.edges):
            return np.full(n, -1, np.int64)
        text = np.frombuffer(b"".join(words), np.uint8)
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        alive = np.flatnonzero((lengths > 0) & (lengths <= LONGEST))
        lost = np.ones(n, bool)
        step = 0
        while len(alive):
            wanted = state[alive] * 256 + text[first[alive] + step]
            at = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            hit = self.edges[at] == wanted
            alive, at = alive[hit], at[hit]
            state[alive] = self.target[at]
            index[alive] += self.before[at]
            step += 1
            ended = lengths[alive] == step
            done = alive[ended]
            lost[done] = ~self.final[state[done]]
            alive = alive[~ended]
        index[lost] = -1
        return index

    def output(self, index: int) -> bytes:
        return self.ids[self.starts[index] : self.starts[index + 1]].tobytes()

    def parts(self) -> tuple:
        return self.edges, self.target, self.before, self.final, self.starts, self.ids

    def save(self, path: str) -> None:
        for name in ("edges", "target", "before", "final", "starts", "ids"):
            np.save(os.path.join(path, f"{name}.npy"), getattr(self, name))

    @staticmethod
    def mapped(path: str) -> Transducer:
        """The saved arrays, memory-mapped."""
        names = ("edges", "target", "before", "final", "starts", "ids")
        return Transducer(*[np.load(os.path.join(path, f"{n}.npy"), mmap_mode="r") for n in names])


def compile_lexicon(outputs: dict[bytes, Sequence[int]]) -> Transducer:
    """The minimal automaton of the words: equal endings are one state, found by registering states."""
    words = sorted(w for w in outputs if 0 < len(w) <= LONGEST)
    registered: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []

    def freeze(node: list) -> int:
        """Register a finished state; children come first, so equal states have equal descriptions."""
        signature = (node[0], tuple(node[1]))
        if signature not in registered:
            size = int(node[0]) + sum(states[t][2] for _, t in node[1])
            registered[signature] = len(states)
            states.append((node[0], signature[1], size))
        return registered[signature]

    path: list[list] = [[False, []]]  # from the root along the word before: [final, edges]
    last = b""
    for word in [*words, None]:
        shared = 0
        if word is not None:
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
        while len(path) - 1 > shared:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        if word is None:
            break
        for _ in word[shared:]:
            path.append([False, []])
        path[-1][0] = True
        last = word
    root = freeze(path[0])
    number = {root: 0}
    for i in range(len(states)):
        number.setdefault(i, len(number))
    edges, target, before = [], [], []
    final = np.zeros(len(states), bool)
    for i, (ends, out, _) in enumerate(states):
        final[number[i]] = ends
        passed = int(ends)
        for byte, to in out:
            edges.append(number[i] * 256 + byte)
            target.append(number[to])
            before.append(passed)
            passed += states[to][2]
    order = np.argsort(np.array(edges, np.int64), kind="stable")
    ids = [np.asarray(outputs[w], "<u4") for w in words]
    return Transducer(
        np.array(edges, np.int64)[order],
        np.array(target, np.int64)[order],
        np.array(before, np.int64)[order],
        final,
        np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64),
        np.concatenate([np.zeros(0, "<u4"), *ids]).astype("<u4"),
    )


# --- words of a text --------------------------------------------------------------------------------


def normalised(text: str) -> str:
    """NFC and lower case, character by character, as the tokenizer does."""
    text = unicodedata.normalize("NFC", text)
    # str.lower writes a final sigma by its place in the word
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def _ranges(points: Sequence[int]) -> str:
    """Sorted code points as the inside of a character class."""
    out, start = [], 0
    for i in range(1, len(points) + 1):
        if i == len(points) or points[i] != points[i - 1] + 1:
            first, last = points[start], points[i - 1]
            out.append(f"\\U{first:08x}-\\U{last:08x}")
            start = i
    return "".join(out)


def character_classes(path: str) -> tuple[str, str, dict[str, str]]:
    """What a tokenizer file's library knows: letters and numbers, as insides of classes, and lower case.

    Libraries follow different versions of Unicode. Those code points that the newest one here calls letters
    or numbers are shown to the library's pre-tokenizer: a letter stays with a letter before it, and a mark
    with a mark; what does neither is a number. Later versions only add letters and numbers. The lower case
    is given of those letters of which Python has another.
    """
    library = Tokenizer.from_file(path)
    cut = library.pre_tokenizer.pre_tokenize_str
    everything = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]

    def stays(points: list[str], before: str) -> set[str]:
        # each is cut with what stands before it, a blank apart from the others
        pieces = {place for _, place in cut("".join(f"{before}{c} " for c in points))}
        return {c for i, c in enumerate(points) if (3 * i, 3 * i + 2) in pieces}

    known = regex.compile(r"[\p{L}\p{N}]")
    points = [c for c in everything if known.match(c)]
    letters = stays(points, "a")
    rest = [c for c in points if c not in letters]
    numbers = set(rest) - stays(rest, "!")
    shown = library.normalizer.normalize_str(" ".join(points)).split(" ")
    lower = {c: x for c, x in zip(points, shown) if normalised(c) != x}
    return _ranges(sorted(map(ord, letters))), _ranges(sorted(map(ord, numbers))), lower


class Cutter:
    """Cuts text between white space into words."""

    def __init__(self, letters: str, numbers: str, lower: dict[str, str]):
        pattern = WORD.replace(r"\s", SPACE[1:-1]).replace(r"\p{L}", letters).replace(r"\p{N}", numbers)
        self.pattern = regex.compile(pattern)
        # letters to Python, whose Unicode may be newer, that are none to the tokenizer
        known = regex.compile(f"[{letters}]")
        odd = [c for c in range(sys.maxunicode + 1) if chr(c).isalpha() and not known.match(chr(c))]
        self.odd = regex.compile(f"[{_ranges(odd)}]") if odd else None
        self.lower = str.maketrans(lower)
        self.changed = regex.compile(f"[{_ranges(sorted(self.lower))}]") if lower else None

    def _letters(self, text: str) -> bool:
        return text.isalpha() and (self.odd is None or text.isascii() or not self.odd.search(text))

    def words(self, text: str) -> list[bytes]:
        """The words of a text; letters alone, or before one mark, are known without the pattern."""
        if text.isascii():
            text = text.lower()
        else:
            text = normalised(text)
            if self.changed and self.changed.search(text):
                text = text.translate(self.lower)
        if self._letters(text):
            return [text.encode()]
        if text[-1:] in _MARKS and self._letters(text[:-1]):
            return [text[:-1].encode(), text[-1].encode()]
        return [w.encode() for w in self.pattern.findall(text)]

    def many(self, cuts: Sequence[str]) -> tuple[list[bytes], np.ndarray]:
        """The words of cuts that hold no white space, one cut after another, and how many each has.

        Those in ASCII are cut together, with an end of line between two.
        """
        plain = [c for c in cuts if c.isascii()]
        words = _ASCII.findall("\n".join(plain).lower().encode()) if plain else []
        ends = np.array([i for i, w in enumerate(words) if w == b"\n"], np.int64)
        sizes = np.diff(ends, prepend=-1, append=len(words)) - 1 if plain else np.zeros(0, np.int64)
        if len(ends):
            words = [w for w in words if w != b"\n"]
        if len(plain) == len(cuts):
            return words, sizes
        other = {i: self.words(c) for i, c in enumerate(cuts) if not c.isascii()}
        counts = np.zeros(len(cuts), np.int64)
        counts[list(other)] = [len(ws) for ws in other.values()]
        held = np.ones(len(cuts), bool)
        held[list(other)] = False
        counts[held] = sizes
        out: list[bytes] = []
        last = 0
        # what stands before each cut that is not in ASCII, then its words
        before = (np.cumsum(np.where(held, counts, 0)))[list(other)].tolist()
        for ws, upto in zip(other.values(), before):
            out += words[last:upto]
            out += ws
            last = upto
        out += words[last:]
        return out, counts


def distinct(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words in the order they come, and each word's place among them."""
    held = dict.fromkeys(words)
    number = dict(zip(held, range(len(held))))
    return list(held), np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that start and are as long as given, one run after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


class Encoder:
    """Ids and tokens of texts. What stands between white space is encoded once while it is remembered."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.cutter = Cutter(vocabulary.letters, vocabulary.numbers, vocabulary.lower)
        self.merger = Merger(vocabulary)
        self.ids: dict[str, bytes] = {}
        table = byte_table()
        self.table = {b: table[b] for b in range(256)}
        size = max(max(vocabulary.ids.values(), default=-1), max(vocabulary.special.values(), default=-1))
        tokens = [""] * (size + 1)
        for held in (vocabulary.ids, vocabulary.special):
            for token, i in held.items():
                tokens[i] = token
        self.tokens = pa.array(tokens, pa.large_string())
        marks = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.marks = {token: np.array([i], "<u4").tobytes() for token, i in vocabulary.special.items()}

    def _merged(self, word: bytes) -> bytes:
        shown = word.decode("latin-1").translate(self.table)
        return struct.pack(f"<{len(ids := merge(shown, self.vocabulary))}I", *ids)

    def decoded(self, ids: Sequence[bytes]) -> pa.Array:
        """Tokens with a space between two, as the library writes them for such vocabularies."""
        ends = np.cumsum([0, *map(len, ids)]) // 4
        flat = self.tokens.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), flat), pa.scalar(" ", flat.type))

    def forget(self) -> None:
        self.ids.clear()

    def encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where the ids of each word start and how many they are.

        Words of the lexicon are looked up together, the others merged together, or alone if they are long.
        """
        found = self.lexicon.find(words) if self.lexicon else np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        known, new = np.flatnonzero(found >= 0), np.flatnonzero((found < 0) & (lengths <= 200))
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        pools = [np.zeros(0, "<u4")]
        if len(known):
            starts[known] = self.lexicon.starts[found[known]]
            sizes[known] = self.lexicon.starts[found[known] + 1] - starts[known]
            pools.append(self.lexicon.ids[_flat(starts[known], sizes[known])])
            starts[known] = np.cumsum(sizes[known]) - sizes[known]
        at = sum(map(len, pools))
        if len(new):
            data = np.frombuffer(b"".join([words[i] for i in new.tolist()]), np.uint8)
            ids, sizes[new] = self.merger.merged(data, lengths[new])
            starts[new] = at + np.cumsum(sizes[new]) - sizes[new]
            pools.append(ids)
            at += len(ids)
        for i in np.flatnonzero((found < 0) & (lengths > 200)).tolist():
            ids = np.frombuffer(self._merged(words[i]), "<u4")
            starts[i], sizes[i] = at, len(ids)
            pools.append(ids)
            at += len(ids)
        return np.concatenate(pools), starts, sizes

    def learn(self, cuts: Iterable[str]) -> None:
        """Encode new cuts, all their words together."""
        cuts = list(cuts)
        for start in range(0, len(cuts), TOGETHER):
            part = cuts[start : start + TOGETHER]
            words, counts = self.cutter.many(part)
            names, place = distinct(words)
            ids, starts, sizes = self.encoded(names)
            blob = ids[_flat(starts[place], sizes[place])].tobytes()
            upto = np.concatenate([[0], 4 * np.cumsum(sizes[place])])
            ends = upto[np.concatenate([[0], np.cumsum(counts)])].tolist()
            self.ids.update(zip(part, [blob[i:j] for i, j in zip(ends, ends[1:])]))

    def cut(self, text: str) -> list[str]:
        """Parts that are encoded alone: at white space, with special tokens apart."""
        if _OTHER_SPACE.search(text):
            return [c for c in regex.split(SPACE + "+", text) if c]
        return text.split()

    def batch(self, texts: Sequence[str]) -> Iterator[tuple[bytes, str]]:
        """Ids and decoded text of each text."""
        for ids, decoded in self.parts(texts):
            yield from zip(ids, decoded.to_pylist())

    def parts(self, texts: Sequence[str]) -> Iterator[tuple[list[bytes], pa.Array]]:
        """The same of some texts at a time."""
        special = self.vocabulary.special
        for start, end in slices(texts):
            split: list[list[str]] = []
            marked: set[int] = set()
            for text in texts[start:end]:
                if self.special and any(mark in text for mark in special):
                    marked.add(len(split))
                    # special tokens stand at the odd places
                    pieces = enumerate(self.special.split(text))
                    split.append([c for i, p in pieces for c in ([p] if i % 2 else self.cut(p))])
                else:
                    split.append(self.cut(text))
            new = set().union(*split).difference(self.marks)
            fresh = new.difference(self.ids)
            if len(self.ids) + len(fresh) > CACHED:
                self.forget()
                fresh = new
            self.learn(fresh)
            coded = []
            for i, cuts in enumerate(split):
                if i in marked:
                    # no cut at white space holds a special token, so these are the tokens themselves
                    coded.append(b"".join([self.marks[c] if c in self.marks else self.ids[c] for c in cuts]))
                else:
                    coded.append(b"".join(map(self.ids.__getitem__, cuts)))
            yield coded, self.decoded(coded)


# --- on tables --------------------------------------------------------------------------------------


def _leading(n: Column) -> Column:
    """A count with all but its eight leading bits cleared."""
    cut = F.greatest(F.length(F.bin(n)) - 8, F.lit(0))
    power = F.element_at(F.array(*[F.lit(1 << i) for i in range(63)]), cut + 1)
    return n - n % power


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", words: int = WORDS) -> list[bytes]:
    """The most frequent words of all documents, ``words`` of them at most.

    Each batch counts its words before they are shuffled, so that a frequent word costs no more than others.
    The count from which on words are taken is read from how many words have counts of the same leading
    bits, some thousand rows; words of a count whose words are too many for the rest stay out. Only the
    words taken reach the driver.
    """
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary.letters, vocabulary.numbers, vocabulary.lower))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        words_of = Cutter(*sent.value).many
        for batch in batches:
            cuts: Counter = Counter()
            for value in batch.column(0).to_pylist():
                if value:
                    cuts.update(value.split())
            held: dict[bytes, int] = {}
            each, often = list(cuts), np.fromiter(cuts.values(), np.int64, len(cuts))
            del cuts
            for start in range(0, len(each), TOGETHER):
                words, counts = words_of(each[start : start + TOGETHER])
                names, place = distinct(words)
                # sums of counts below 2 ** 53 are exact
                n = np.bincount(place, np.repeat(often[start : start + TOGETHER], counts), len(names))
                for word, total in zip(names, n.astype(np.int64).tolist()):
                    if len(word) <= LONGEST:
                        held[word] = held.get(word, 0) + total
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

    counted = docs.select(F.col(text)).mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialize(counted.withColumn("leading", _leading(F.col("n"))), "lexicon-words")
    sizes = {r["leading"]: r["words"] for r in counted.groupBy("leading").agg(F.count("*").alias("words")).collect()}
    least, taken = None, 0
    for leading in sorted(sizes, reverse=True):
        taken += sizes[leading]
        if taken > words:
            break
        least = leading
    if least is None:
        return []
    return [bytes(r["word"]) for r in counted.where(F.col("n") >= least).select("word").toLocalIterator()]


def lexicon_of(words: Iterable[bytes], vocabulary: Vocabulary) -> Transducer:
    held = [w for w in words if 0 < len(w) <= LONGEST]
    return compile_lexicon({w: np.frombuffer(i, "<u4") for w, i in zip(held, Merger(vocabulary).merge(held))})


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, lexicon: Transducer, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ``ids``, ``decoded``): all ids of each whole text and the text they decode to.

    ``ids`` are little-endian unsigned 32-bit integers. Null and empty texts have no ids and decode to the
    empty text. Repeated rows are encoded each; a row's result depends on its text alone.
    """
    # both are bounded: the vocabulary by its file, the lexicon by its number and length of words
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary.parts(), lexicon.parts()))
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("ids", T.BinaryType()),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, compiled = Vocabulary(*sent.value[0]), Transducer(*sent.value[1])
        with tempfile.TemporaryDirectory(prefix="lexicon-") as folder:
            compiled.save(folder)
            encoder = Encoder(held, Transducer.mapped(folder))
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                start = 0
                for ids, decoded in encoder.parts(texts):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(start, len(ids)),
                            pa.array(ids, pa.binary()),
                            decoded.cast(pa.string()),
                        ],
                        ["key", "ids", "decoded"],
                    )
                    start += len(ids)

    coded = docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
    return coded.withColumnRenamed("key", key)
