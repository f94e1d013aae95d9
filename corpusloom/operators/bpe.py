"""Byte-pair-encoding training over a distributed word table.

A word is kept as a string with one code point per symbol, in the order of symbol ids. Then merging a
pair is a literal string replacement, the pairs of a word are its neighbouring code points, and ordering
pairs as strings orders them by (left id, right id). How merges change the counts of pairs is worked out on
the code points of a batch of words at once; a task adds its changes up and sends a row for each pair and step.

The driver holds the vocabulary and the merges, both bounded by the vocabulary size and by the number of
Unicode code points, and per round the best few hundred pairs. Words and pair counts stay distributed:
each round counts only the pairs of words that have changed since the tables were last written.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import pretokenize
from corpusloom.session import materialize, scratch_path

# The two sets of special tokens, in id order, and their templates (first, last).
CLASSIFIER_SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]")
SEQ2SEQ_SPECIALS = ("<pad>", "<unk>", "<s>", "</s>")

_FIRST_CODE = 0x100  # code point of symbol 0
_SURROGATES = range(0xD800, 0xE000)


def _code(symbol: int) -> str:
    point = _FIRST_CODE + symbol
    return chr(point if point < _SURROGATES.start else point + len(_SURROGATES))


@dataclass(frozen=True)
class BpeTokenizer:
    """Vocabulary and merges. Specials are (padding, unknown, first, last)."""

    tokens: tuple[str, ...]
    merges: tuple[tuple[int, int, int], ...]
    specials: tuple[str, ...] = CLASSIFIER_SPECIALS
    ids: dict[str, int] = field(init=False, compare=False, repr=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "ids", {t: i for i, t in enumerate(self.tokens)})

    def token_to_id(self, token: str) -> int | None:
        return self.ids.get(token)

    @property
    def special_ids(self) -> list[int]:
        return [self.ids[s] for s in self.specials]

    @property
    def pad_id(self) -> int:
        return self.special_ids[0]

    @property
    def unk_id(self) -> int:
        return self.special_ids[1]

    @property
    def first_id(self) -> int:
        return self.special_ids[2]

    @property
    def last_id(self) -> int:
        return self.special_ids[3]

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.tokens)), "id int, token string").select(
            "token", "id"
        )

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (rank, self.tokens[a], self.tokens[b], self.tokens[c])
            for rank, (a, b, c) in enumerate(self.merges)
        ]
        return spark.createDataFrame(
            rows, "rank int, left string, right string, new_token string"
        )

    def save(self, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
        document = json.dumps(
            {"tokens": self.tokens, "merges": self.merges, "specials": self.specials}
        )
        spark.createDataFrame([(document,)], "value string").write.mode(mode).text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BpeTokenizer:
        document = json.loads(spark.read.text(path, wholetext=True).first()["value"])
        return BpeTokenizer(
            tuple(document["tokens"]),
            tuple(tuple(m) for m in document["merges"]),
            tuple(document["specials"]),
        )


def word_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(word, n)`` over all texts of the columns; frequent words are combined before the shuffle."""
    tokens = F.flatten(F.array(*[pretokenize(F.coalesce(c, F.lit(""))) for c in columns]))
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )


# The expressions below are written as SQL text, since they are built anew for every job: symbols stand for
# themselves in it, and none of them is a quote, a comma or a colon.


def _symbol_pairs(word: str) -> str:
    """Neighbouring symbols of a word; a pair that occurs twice is listed twice."""
    symbols = f"split({word}, '')"
    left, right = (f"slice({symbols}, {i}, length({word}) - 1)" for i in (1, 2))
    return f"zip_with({left}, {right}, (a, b) -> concat(a, b))"


def _constants(merges: Sequence[tuple[str, str]]) -> tuple[str, str, str]:
    """The pairs, what they become, and their places, as constant arrays."""
    pairs, results = (",".join(codes) for codes in zip(*merges))
    return f"split('{pairs}', ',')", f"split('{results}', ',')", f"sequence(0, {len(merges) - 1})"


def _touched(word: str, merges: Sequence[tuple[str, str]]) -> str:
    """Whether any merge changes the word: the first that does finds its pair in the word as it is."""
    return f"{word} RLIKE '{'|'.join(pair for pair, _ in merges)}'"


def _merged(word: str, merges: Sequence[tuple[str, str]]) -> str:
    """A word after all the merges."""
    if not merges:
        return word
    pairs, results, places = _constants(merges)
    step = f"replace(t, get({pairs}, i), get({results}, i))"
    return f"IF({_touched(word, merges)}, aggregate({places}, {word}, (t, i) -> {step}), {word})"


_SHIFTS = "pair string, step int, n long"
_HELD_SHIFTS = 1 << 18  # entries that a task holds before it adds equal ones up


def _merge_places(codes: np.ndarray, left: int, right: int) -> np.ndarray:
    """Where a pair is merged: of overlapping places, from the left, every other."""
    hits = np.flatnonzero((codes[:-1] == left) & (codes[1:] == right))
    if left == right and len(hits):
        first = np.concatenate([[True], np.diff(hits) != 1])
        starts = np.flatnonzero(first)
        hits = hits[(hits - hits[starts[np.cumsum(first) - 1]]) % 2 == 0]
    return hits


class _Shifts:
    """Changes of pair counts by step, added up."""

    def __init__(self) -> None:
        self._parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, step: int, codes: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        """The pairs that begin at some places, so many times; a zero parts words and is in no pair."""
        left, right = codes[at], codes[at + 1]
        inside = (left != 0) & (right != 0)
        keys = left[inside].astype(np.int64) << 32 | right[inside]
        self._parts.append((np.full(len(keys), step, np.int32), keys, n[inside]))
        self._held += len(keys)
        if self._held > _HELD_SHIFTS:
            self._parts = [self.total()]
            self._held = len(self._parts[0][0]) // 2

    def total(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        steps, keys, n = (np.concatenate(x) for x in zip(*self._parts))
        order = np.lexsort((keys, steps))
        steps, keys, n = steps[order], keys[order], n[order]
        if not len(n):
            return steps, keys, n
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(steps) != 0) | (np.diff(keys) != 0)]))
        return steps[starts], keys[starts], np.add.reduceat(n, starts)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self._parts:
            return
        steps, keys, n = self.total()
        kept = n != 0
        pairs = [chr(k >> 32) + chr(k & 0xFFFFFFFF) for k in keys[kept].tolist()]
        columns = {"pair": pa.array(pairs, pa.string()), "step": steps[kept], "n": n[kept]}
        yield pa.RecordBatch.from_pydict(columns)


def _coded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the words ``s`` one after another, a zero before and after each, and their ``n``."""
    words = batch.column("s").to_pylist()
    codes = np.frombuffer(("\0" + "\0".join([*words, ""])).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    counts = np.asarray(batch.column("n").to_numpy(zero_copy_only=False), np.int64)
    return codes, np.concatenate([[0], np.repeat(counts, lengths)])


def _shifts(words: DataFrame, done: Sequence[tuple[str, str]], planned: Sequence[tuple[str, str]]) -> DataFrame:
    """What merges do to the counts of pairs: all those done as step 0, those planned as steps from 1.

    A merge changes the pairs it replaces and the ones beside them; all others stay.
    """
    steps = [(0, *merge) for merge in done] + [(i, *merge) for i, merge in enumerate(planned, start=1)]
    steps = [(step, ord(pair[0]), ord(pair[1]), ord(new)) for step, pair, new in steps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = _Shifts()
        for batch in batches:
            codes, weights = _coded(batch)
            for step, left, right, new in steps:
                hits = _merge_places(codes, left, right)
                if not len(hits):
                    continue
                at = np.unique(np.concatenate([hits - 1, hits, hits + 1]))
                shifts.add(step, codes, at, -weights[at])
                kept = np.ones(len(codes), bool)
                kept[hits + 1] = False
                codes = codes.copy()
                codes[hits] = new
                codes, weights = codes[kept], weights[kept]
                now = hits - np.arange(len(hits))
                at = np.unique(np.concatenate([now - 1, now]))
                shifts.add(step, codes, at, weights[at])
        yield from shifts.rows()

    sent = words.select("s", "n").mapInArrow(run, _SHIFTS)
    return sent.groupBy("pair", "step").agg(F.sum("n").alias("n")).where("n <> 0")


class _WrittenTable:
    """A table kept in the shared folder; the version before goes when a new one is written."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self._spark, self._name, self._path = spark, name, None

    def replace(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self._spark, self._name)
        df.write.parquet(path)
        self.drop()
        self._path = path
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        if self._path:
            target = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path)
            conf = self._spark.sparkContext._jsc.hadoopConfiguration()
            target.getFileSystem(conf).delete(target, True)
            self._path = None


def _count_pairs(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Shifts()
        for batch in batches:
            codes, weights = _coded(batch)
            pairs.add(0, codes, np.arange(len(codes) - 1), weights[:-1])
        yield from pairs.rows()

    return words.select("s", "n").mapInArrow(run, _SHIFTS).groupBy("pair").agg(F.sum("n").alias("n"))


def _postings(words: DataFrame) -> DataFrame:
    """Each word under each of its pairs, in the order of pairs, so that a job reads few pages of a file.

    Words are the second key of the ranges: a pair that most words hold is spread over many.
    """
    listed = words.selectExpr(f"explode(array_distinct({_symbol_pairs('s')})) AS pair", "s", "n")
    return listed.repartitionByRange("pair", "s").sortWithinPartitions("pair")


def _words_with(postings: DataFrame, pairs: Sequence[str]) -> DataFrame:
    """The words that hold any of the pairs, each once: under the first of those it holds."""
    if not pairs:
        return postings.where(F.lit(False)).select("s", "n")
    wanted = f"split('{','.join(pairs)}', ',')"
    first = f"array_min(array_intersect({_symbol_pairs('s')}, {wanted}))"
    return postings.where(F.col("pair").isin(*pairs)).where(f"pair = {first}").select("s", "n")


class _Heads:
    """What a word held when the tables were written, if it holds a symbol or a pair now.

    A symbol made since then stands for a run of symbols of that time, or for one of several, since other
    pairs may spell the same token. Its heads are the first two symbols of each run. A word that holds a
    pair now held, side by side, the first two of what the pair stands for.
    """

    def __init__(self, made: dict[str, frozenset[str]] | None = None) -> None:
        self._made = dict(made or {})

    def _of(self, symbol: str) -> frozenset[str]:
        return self._made.get(symbol, frozenset()) | {symbol}

    def pairs(self, pair: str) -> frozenset[str]:
        left, right = self._of(pair[0]), self._of(pair[1])
        long = {head for head in left if len(head) > 1}
        return frozenset(long | {head + other[0] for head in left - long for other in right})

    def merge(self, pair: str, new: str) -> None:
        self._made[new] = self._made.get(new, frozenset()) | self.pairs(pair)

    def copy(self) -> _Heads:
        return _Heads(self._made)


def _count_paths(
    words: DataFrame,
    pairs: DataFrame,
    done: Sequence[tuple[str, str]],
    planned: Sequence[tuple[str, str]],
    floor: int,
    limit: int,
) -> list[tuple[str, int, dict[int, int]]]:
    """How pair counts go on from the written tables through the planned merges.

    Gives ``(pair, count after the merges done, {planned step: change})`` for the pairs that reach the
    highest counts on the way, highest first and smaller ids first among equals. ``words`` has at least
    those that hold a pair of a merge, and only their changes are shuffled.
    """
    shifts = _shifts(words, done, planned)
    # one entry per planned step at most
    later = "array_sort(collect_list(IF(step > 0, struct(step, n), NULL))) AS later"
    paths = (
        pairs.selectExpr("pair", "0 AS step", "n")
        .unionByName(shifts)
        .groupBy("pair")
        .agg(F.expr("sum(IF(step = 0, n, 0)) AS now"), F.expr(later))
    )
    top = (
        "aggregate(later, struct(now AS at, now AS top), (acc, x) -> "
        "struct(acc.at + x.n AS at, greatest(acc.top, acc.at + x.n) AS top), acc -> acc.top) AS top"
    )
    ranked = (
        paths.selectExpr("pair", "now", "later", top)
        .where(F.col("top") >= floor)
        .orderBy(F.desc("top"), "pair")
        .limit(limit)
        .collect()
    )
    return [(r["pair"], r["now"], {x["step"]: x["n"] for x in r["later"]}) for r in ranked]


class _Plan:
    """Guesses which merges come next, from the counts now and the effects last seen."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], int] = {}
        self.effects: dict[tuple[str, str], dict[tuple[str, str], int]] = {}

    def learn(self, counts: dict, effects: dict, merged: Sequence[tuple[str, str]]) -> None:
        self.counts = {pair: n for pair, n in counts.items() if n > 0}
        self.effects.update(effects)
        for pair in merged:
            del self.effects[pair]

    def guess(self, length: int, ids: dict[str, int], floor: int) -> list[tuple[str, str]]:
        counts, ids = dict(self.counts), dict(ids)
        chosen: list[tuple[str, str]] = []
        while len(chosen) < length:
            # a pair is possible once both of its tokens are there
            open_pairs = [
                (-n, ids[p[0]], ids[p[1]], p)
                for p, n in counts.items()
                if n >= floor and p[0] in ids and p[1] in ids
            ]
            if not open_pairs:
                break
            best = min(open_pairs)[3]
            chosen.append(best)
            ids.setdefault(best[0] + best[1], len(ids))
            for pair, change in self.effects.get(best, {}).items():
                counts[pair] = counts.get(pair, 0) + change
            counts[best] = 0
        return chosen


def train_bpe(
    counts: DataFrame,
    vocab_size: int,
    specials: Sequence[str] = CLASSIFIER_SPECIALS,
    min_frequency: int = 2,
    lookahead: int = 64,
    candidates: int = 2_048,
    rewrite_every: int = 128,
    rewrite_share: float = 0.25,
) -> BpeTokenizer:
    """Train on ``(word, n)``.

    Ids go to the specials, to all characters by code point, then to merges until the vocabulary is full
    or no pair occurs ``min_frequency`` times. Each merge joins the most frequent pair, the smallest ids
    first among equals.

    One job settles many merges: it follows the counts through a guessed sequence of merges, and the driver
    keeps the part of the guess in which every merge is what the exact counts demand at its turn. Guesses
    only affect the number of jobs, never the result.

    After the first ``rewrite_every`` merges, whose pairs are in most words, words are written under each of
    their pairs, and a job reads those under the pairs it merges, so that a late job, whose pairs are rare,
    reads a small part of the vocabulary. The tables are written anew
    after ``rewrite_every`` merges, and later after ``rewrite_share`` of the merges so far: the words that a
    merge changes get fewer with its rank.
    """
    spark = counts.sparkSession
    tables = [_WrittenTable(spark, name) for name in ("words", "pairs", "postings")]
    setting = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(setting, None)
    # else a long list of pairs reaches the files as the range from its first to its last
    spark.conf.set(setting, "4096")
    try:
        return _train(
            counts, vocab_size, specials, min_frequency, lookahead, candidates, rewrite_every, rewrite_share, *tables
        )
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
        for table in tables:
            table.drop()


def _train(
    counts: DataFrame,
    vocab_size: int,
    specials: Sequence[str],
    min_frequency: int,
    lookahead: int,
    candidates: int,
    rewrite_every: int,
    rewrite_share: float,
    word_table: _WrittenTable,
    pair_table: _WrittenTable,
    posting_table: _WrittenTable,
) -> BpeTokenizer:
    spark = counts.sparkSession
    floor = max(min_frequency, 1)
    # the corpus is read and counted once, for the alphabet and the words
    counts = materialize(counts.select("word", "n"), "word-counts")
    characters = (
        counts.select(F.explode(F.split("word", "")).alias("c")).where(F.col("c") != "").distinct()
    )
    alphabet = sorted(row["c"] for row in characters.collect())  # Unicode bounds it
    tokens = [*specials, *[c for c in alphabet if c not in specials]]
    ids = {t: i for i, t in enumerate(tokens)}
    merges: list[tuple[int, int, int]] = []

    symbols = "".join(_code(ids[c]) for c in alphabet)
    # the work per word outweighs its bytes: at least one file, and so one task, for each core
    words = word_table.replace(
        counts.where(F.length("word") > 1)
        .select(F.translate("word", "".join(alphabet), symbols).alias("s"), "n")
        .repartition(spark.sparkContext.defaultParallelism, "s")
    )
    pairs = pair_table.replace(_count_pairs(words))
    postings = None  # the first pairs are in most words
    plan, done, length = _Plan(), [], lookahead // 2
    heads, touched = _Heads(), set()

    while len(tokens) < vocab_size:
        guess = plan.guess(length, ids, floor)
        trial, planned = dict(ids), []
        ahead, wanted = heads.copy(), set(touched)
        for left, right in guess:
            new = trial.setdefault(left + right, len(trial))
            planned.append((_code(trial[left]) + _code(trial[right]), _code(new)))
            wanted |= ahead.pairs(planned[-1][0])
            ahead.merge(*planned[-1])
        held = words if postings is None else _words_with(postings, sorted(wanted))
        rows = _count_paths(held, pairs, done, planned, floor, candidates)
        if not rows:
            break
        text = {_code(i): t for t, i in trial.items()}
        ranking = {pair: now for pair, now, _ in rows}
        shifts: dict[int, dict[str, int]] = {}
        for pair, _, later in rows:
            for step, change in later.items():
                shifts.setdefault(step, {})[pair] = change
        # pairs beyond the fetched ones come after this place at every step
        edge = None
        if len(rows) == candidates:
            pair, now, later = rows[-1]
            path = accumulate([now] + [later[step] for step in sorted(later)])
            edge = (-max(path), pair)

        kept = 0
        for step, (pair, merged) in enumerate(planned, start=1):
            place, best = min((-n, p) for p, n in ranking.items())
            certain = edge is None or (place, best) <= edge
            if best != pair or -place < floor or not certain or len(tokens) >= vocab_size:
                break
            left, right = text[pair[0]], text[pair[1]]
            if left + right not in ids:
                ids[left + right] = len(tokens)
                tokens.append(left + right)
            merges.append((ids[left], ids[right], ids[left + right]))
            done.append((pair, merged))
            touched |= heads.pairs(pair)
            heads.merge(pair, merged)
            kept += 1
            for other, change in shifts.get(step, {}).items():
                ranking[other] += change

        def spelt(codes: dict[str, int]) -> dict[tuple[str, str], int]:
            return {(text[p[0]], text[p[1]]): n for p, n in codes.items()}

        if kept or not guess:
            effects = {pair: spelt(shifts.get(i, {})) for i, pair in enumerate(guess, start=1)}
            plan.learn(spelt(ranking), effects, guess[:kept])
            length = min(lookahead, max(24, 3 * kept)) if guess else length
        else:
            # The fetched ranking was too short for this guess. A plain ranking always has a certain
            # first place, and a guess of one merge after it always holds.
            plan, length = _Plan(), 1
        due = max(rewrite_every, int(rewrite_share * len(merges)))
        if len(done) >= due and len(tokens) < vocab_size:
            words = word_table.replace(
                words.selectExpr(f"{_merged('s', done)} AS s", "n").where(F.length("s") > 1)
            )
            pairs = pair_table.replace(_count_pairs(words))
            postings = posting_table.replace(_postings(words))
            done, heads, touched = [], _Heads(), set()
    return BpeTokenizer(tuple(tokens), tuple(merges), tuple(specials))
