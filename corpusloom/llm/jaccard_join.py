"""N-gram Jaccard join by rare-first prefix filtering, and the groups its links make.

1. Equal sets are one set from here on, so copies cost nothing more.
2. The n-grams of all documents are counted (``keycounts``). Each set is ordered by (count, n-gram): what
   only this document holds comes first, and of the n-grams that others share only those within the prefix
   are posted: two sets that link must meet in their prefixes.
3. Within the posting of an n-gram, pairs must pass the length and the positional filter, then, once per
   pair, the suffix filter: bounds on the overlap from the sizes of the parts into which fixed pivots cut
   both sets. What is left is verified by intersecting the sets.
4. First each set is compared with leaders of its postings. Sets that are in one group by then need no
   further comparison, so a group of very many near copies costs about as many pairs as it has members.
   Then, in postings that still hold several groups, all pairs of different groups are compared. No pair
   that could join two groups is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import keycounts
from corpusloom.llm.components import connected_components
from corpusloom.llm.rows import ROW, with_rows
from corpusloom.llm.shingles import mixed, shingle_set, word_hashes
from corpusloom.session import discard, materialize, release

BATCH_BITS = 10  # documents of a batch: 2 ** 10
PARTS = 64  # parts of the suffix filter
LEADER_ROUNDS = 3


def _sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    return [shingle_set(words, n) for words in word_hashes(texts)]


def _signatures(written: DataFrame, n: int) -> DataFrame:
    """Size and 128-bit signature of each document's set."""
    schema = f"{ROW} long, n long, s1 long, s2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sets(batch.column(1).to_pylist(), n)
            with np.errstate(over="ignore"):
                s1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
                s2 = np.array([mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(s1.view(np.int64)),
                    pa.array(s2.view(np.int64)),
                ],
                [ROW, "n", "s1", "s2"],
            )

    return written.select(ROW, "text").mapInArrow(run, schema)


def _sent(written: DataFrame, n: int, ranges: int) -> DataFrame:
    """The distinct n-grams of each batch of documents, with the number of documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            sets = _sets(batch.column(1).to_pylist(), n)
            out = []
            for number in np.unique(rows >> BATCH_BITS):
                mine = [sets[i] for i in np.flatnonzero(rows >> BATCH_BITS == number)]
                keys, counts = np.unique(np.concatenate(mine), return_counts=True)
                out += keycounts.sent(int(number), keys, counts, ranges)
            yield keycounts.batch_of(out)

    return written.select(ROW, "text").mapInArrow(run, keycounts.SENT)


_POSTINGS = "key long, set long, n long, place long, shared double"


def prefix_length(n: int, percent: int) -> int:
    """Elements of which a set of ``n`` must share one with any set it links to."""
    return n - -(-percent * n // 100) + 1


def _postings(written: DataFrame, counted: DataFrame, firsts: DataFrame, n: int, ranges: int, percent: int) -> DataFrame:
    """Prefix n-grams that other documents hold too, of the first document of each set."""
    # to each batch: its counted keys, and in range -1 the documents that stand for a set
    marks = firsts.select(
        F.shiftright("set", BATCH_BITS).alias("batch"),
        F.lit(-1).alias("range"),
        F.lit(None).cast("binary").alias("keys"),
        F.col("set").cast("string").cast("binary").alias("counts"),
    )
    documents = written.select(F.shiftright(ROW, BATCH_BITS).alias("batch"), ROW, "text")

    def run(texts: pa.Table, came: pa.Table) -> pa.Table:
        kinds, blobs = came.column("range").to_pylist(), came.column("counts").to_pylist()
        firsts_here = {int(c) for r, c in zip(kinds, blobs) if r == -1}
        held, totals = keycounts.lookup(
            ((r, k, c) for r, k, c in zip(kinds, came.column("keys").to_pylist(), blobs) if r != -1), ranges
        )
        columns: list[list[np.ndarray]] = [[], [], [], [], []]
        rows, values = [], []
        for row, text in zip(texts.column(ROW).to_pylist(), texts.column("text").to_pylist()):
            if row in firsts_here:
                rows.append(row)
                values.append(text)
        for row, grams in zip(rows, _sets(values, n) if len(held) else []):
            keys = keycounts.short(grams, ranges)
            at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
            found = held[at] == keys
            size, alone = len(keys), int(len(keys) - found.sum())
            room = prefix_length(size, percent) - alone if size else 0
            if room <= 0:
                continue
            mine, count = keys[found], totals[at[found]]
            order = np.lexsort((mine, count))[:room]
            k = len(order)
            columns[0].append(mine[order].view(np.int64))
            columns[1].append(np.full(k, row))
            columns[2].append(np.full(k, size))
            columns[3].append(alone + np.arange(k))
            columns[4].append(np.full(k, 1 - alone / size))
        types = (np.int64, np.int64, np.int64, np.int64, np.float64)
        arrays = [
            pa.array(np.concatenate(c) if c else np.zeros(0), pa.from_numpy_dtype(t))
            if c
            else pa.array([], pa.from_numpy_dtype(t))
            for c, t in zip(columns, types)
        ]
        return pa.Table.from_arrays(arrays, ["key", "set", "n", "place", "shared"])

    came = counted.unionByName(marks)
    return documents.groupBy("batch").cogroup(came.groupBy("batch")).applyInArrow(run, _POSTINGS)


def _may_link(percent: int, a: str, b: str) -> Column:
    """Length and positional filter of two postings of one n-gram."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(na - F.col(f"{a}.place"), nb - F.col(f"{b}.place"))
    length = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    # overlap o links when 100 o >= percent (na + nb - o)
    return length & ((100 + percent) * rest >= percent * (na + nb))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, with their overlap; each pair comes once."""
    left = sets.select(F.col("set").alias("a"), F.col("grams").alias("ga"), F.col("parts").alias("pa"))
    right = sets.select(F.col("set").alias("b"), F.col("grams").alias("gb"), F.col("parts").alias("pb"))
    joined = pairs.join(left, "a").join(right, "b")
    na, nb = F.size("ga"), F.size("gb")
    most = F.aggregate(
        F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x
    )
    suffix = (100 + percent) * most >= percent * (na + nb)
    both = F.when(suffix, F.size(F.array_intersect("ga", "gb"))).otherwise(0)
    return (
        joined.select(*pairs.columns, na.alias("na"), nb.alias("nb"), both.alias("overlap"))
        .where(100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap")))
        .where(F.col("overlap") > 0)
        .select(*pairs.columns, "overlap")
    )


def _grams(written: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The sets themselves, and the sizes of their parts, of the documents that are compared."""
    schema = T.StructType(
        [
            T.StructField("set", T.LongType()),
            T.StructField("grams", T.ArrayType(T.LongType(), False)),
            T.StructField("parts", T.ArrayType(T.IntegerType(), False)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sets(batch.column(1).to_pylist(), n)
            parts = [np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=PARTS) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())),
                ],
                ["set", "grams", "parts"],
            )

    compared = written.join(wanted, written[ROW] == wanted["set"], "left_semi")
    return compared.select(ROW, "text").mapInArrow(run, schema)


def link_sets(written: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(document row, ``n``, ``set``) of all documents, and (``set``, ``component``) of linked sets."""
    signed = materialize(_signatures(written, n), "signatures")
    firsts = materialize(
        signed.where("n > 0").groupBy("s1", "s2", "n").agg(F.min(ROW).alias("set")), "sets"
    )
    total = firsts.agg(F.sum("n")).first()[0] or 0
    ranges = keycounts.ranges_for(total)
    counted = keycounts.returned(_sent(written, n, ranges))
    posted = materialize(
        _postings(written, counted, firsts.select("set"), n, ranges, percent), "postings"
    )
    # the keys of all documents and their texts were shuffled for the postings, which are written now
    del counted
    release(written.sparkSession)
    # postings of one set alone say nothing
    several = materialize(
        posted.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1").select("key"), "several"
    )
    every = posted
    posted = materialize(posted.join(several, "key"), "postings")
    discard(every)
    discard(several)
    release(written.sparkSession)
    tested = None
    component = alone = posted.select("set").distinct().select("set", F.col("set").alias("component"))
    for step in range(LEADER_ROUNDS + 1):
        placed = posted.join(component, "set")
        open_keys = materialize(
            placed.groupBy("key")
            .agg(
                F.min("component").alias("c1"),
                F.max("component").alias("c2"),
                # the leader: first the set that shares most with others, then ever other ones
                F.min(
                    F.struct(
                        (-F.round("shared", 2)).alias("r") if step == 0 else F.lit(0.0).alias("r"),
                        F.xxhash64("set", F.lit(step)).alias("h"),
                        "set",
                        "n",
                        "place",
                        "component",
                    )
                ).alias("lead"),
            )
            .where("c1 != c2")
            .select("key", F.col("lead.set").alias("set"), "lead.n", "lead.place", "lead.component"),
            "open",
        )
        if open_keys.isEmpty():
            discard(open_keys)
            break
        if step < LEADER_ROUNDS:
            x, y = open_keys.alias("x"), placed.alias("y")
        else:
            some = placed.join(open_keys.select("key"), "key", "left_semi")
            x, y = some.alias("x"), some.alias("y")
        pairs = (
            x.join(y, "key")
            .where(F.col("x.component") != F.col("y.component"))
            .where(_may_link(percent, "x", "y"))
            .select(
                F.least("x.set", "y.set").alias("a"),
                F.greatest("x.set", "y.set").alias("b"),
                F.least("x.component", "y.component").alias("ca"),
                F.greatest("x.component", "y.component").alias("cb"),
            )
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        discard(open_keys)
        now = pairs.select("a", "b")
        tested = now if tested is None else tested.unionByName(now)
        # the sets of this round's pairs alone are hashed again, and dropped after it
        compared = materialize(
            now.select(F.col("a").alias("set")).unionByName(now.select(F.col("b").alias("set"))).distinct(), "compared"
        )
        grams = materialize(_grams(written, compared, n), "grams")
        found = materialize(_verified(pairs, grams, percent), "verified")
        discard(grams)
        discard(compared)
        release(written.sparkSession)
        if found.isEmpty():
            discard(found)
            continue
        # the new links join groups so far, and what they join is all that is followed
        grouped = connected_components(found, "ca", "cb").withColumnRenamed("component", "joined")
        before, component = component, materialize(
            component.join(grouped, F.col("component") == F.col("node"), "left").select(
                "set", F.coalesce("joined", "component").alias("component")
            ),
            "groups",
        )
        for table in (found, grouped) if before is alone else (found, grouped, before):
            discard(table)
        release(written.sparkSession)
    if tested is not None:
        discard(tested)
    if component is not alone:
        discard(posted)
    of = signed.join(firsts, ["s1", "s2", "n"], "left").select(ROW, "n", "set")
    return of, component


def join_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75
) -> DataFrame:
    """One row per document: key, ``n_shingles`` and ``component_id``, the smallest key it is linked to.

    Words are what stands between white space, A-Z in lower case. A set is the distinct runs of ``n`` words;
    with fewer words, all of them as one run. Two documents link when 100 times the overlap is at least
    ``percent`` times the union. Null and empty texts have no set and link with nothing. Repeated rows
    link like other copies. A null key is passed over while a linked document has a key.
    """
    written = with_rows(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), "documents")
    of, component = link_sets(written, n, percent)
    placed = materialize(
        of.join(component, "set", "left").select(
            ROW, "n", F.coalesce("component", "set").alias("group")
        ),
        "placed",
    )
    ids = written.select(ROW, "id")
    first = materialize(
        placed.where("group is not null").join(ids, ROW).groupBy("group").agg(F.min("id").alias("first")),
        "smallest",
    )
    return (
        placed.join(first, "group", "left")
        .join(ids, ROW)
        .select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75
) -> DataFrame:
    """Keep one document of each linked group, the one of the smallest key (null last), with all columns."""
    whole = with_rows(docs, "whole")
    of, component = link_sets(whole.select(ROW, F.col(text).alias("text")), n, percent)
    placed = of.join(component, "set", "left").select(ROW, F.coalesce("component", "set").alias("group"))
    ids = whole.select(ROW, F.col(key).alias("id"))
    placed = materialize(placed.where("group is not null").join(ids, ROW), "placed")
    first = materialize(
        placed.groupBy("group").agg(
            F.min(F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col(ROW).alias("c"))).alias("f")
        ),
        "smallest",
    )
    others = placed.join(first, "group").where(F.col(ROW) != F.col("f.c")).select(ROW)
    others = materialize(others, "near-copies")
    for table in (of, component, placed, first):
        discard(table)
    release(whole.sparkSession)
    return whole.join(others, ROW, "left_anti").select(*docs.columns)
