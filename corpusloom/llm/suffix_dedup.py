"""Passages that documents share, from sparse suffixes.

A suffix is retained where its first words, its head, are the least of a window (a minimiser): the choice
depends on content alone, so every passage of ``least`` words retains the same suffixes wherever it stands.
Suffixes whose head no other document holds are dropped early, by global counts. For the others, every
passage of ``least`` words around the head is grouped: so many words before, the head, and the rest after,
for each split. Batches of documents send their distinct passages, with the number of documents that hold
them, to ranges of their 64-bit hashes and get those back that several documents hold. All pairs that share
a passage meet there, wherever they go on differently, and a passage that every document holds costs one
entry per batch. Overlapping and touching passages of a document make one span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import keycounts
from corpusloom.llm.rows import ROW, with_rows
from corpusloom.llm.shingles import mixed, ngrams, word_hashes
from corpusloom.session import materialize, release

LEAST = 50  # words of a shared passage
BATCH_BITS = 9  # documents of a batch: 2 ** 9
_PASSAGES = f"batch long, {ROW} long, starts binary, hashes binary"
_SPANS = f"{ROW} long, start long, end long"


def _anchors(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the retained suffixes of a text and the hash of their first ``least // 2`` words."""
    head = least // 2
    width = least - head + 1  # heads in a passage of ``least`` words
    if len(words) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    heads = ngrams(words, head)
    order = mixed(heads)
    found = np.lib.stride_tricks.sliding_window_view(order, width).argmin(axis=1)
    places = np.unique(found + np.arange(len(found)))
    return places, heads[places]


def _sent(written: DataFrame, least: int, ranges: int) -> DataFrame:
    """Heads of retained suffixes of each batch, with the number of documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy() >> BATCH_BITS
            for number in np.unique(numbers):
                texts = batch.column(1).filter(pa.array(numbers == number)).to_pylist()
                heads = [np.unique(_anchors(w, least)[1]) for w in word_hashes(texts)]
                keys, counts = np.unique(np.concatenate(heads), return_counts=True)
                yield keycounts.batch_of(keycounts.sent(int(number), keys, counts, ranges))

    return written.select(ROW, "text").mapInArrow(run, keycounts.SENT)


def _passages(written: DataFrame, counted: DataFrame, least: int, ranges: int) -> DataFrame:
    """Of each document, starts and hashes of the passages around a head that several documents hold."""
    head = least // 2
    documents = written.select(F.shiftright(ROW, BATCH_BITS).alias("batch"), ROW, "text")

    def run(texts: pa.Table, came: pa.Table) -> pa.Table:
        held, _ = keycounts.lookup(
            zip(*(came.column(n).to_pylist() for n in ("range", "keys", "counts"))), ranges
        )
        out: list[tuple[int, int, bytes, bytes]] = []
        numbers = texts.column("batch").to_pylist()
        hashes = word_hashes(texts.column("text").to_pylist()) if len(held) else []
        for number, row, words in zip(numbers, texts.column(ROW).to_pylist(), hashes):
            places, heads = _anchors(words, least)
            if not len(places):
                continue
            short = keycounts.short(heads, ranges)
            at = np.minimum(np.searchsorted(held, short), len(held) - 1)
            places = places[held[at] == short]
            if not len(places):
                continue
            # the split with 0 words before the head, with 1, and so on, as far as the text reaches
            begins = np.zeros(len(words) - least + 2, np.int64)
            last = len(words) - least
            first = np.maximum(places - (least - head), 0)
            ok = first <= last
            np.add.at(begins, first[ok], 1)
            np.add.at(begins, np.minimum(places[ok], last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(begins)[:-1] > 0)
            found = ngrams(words, least)[starts]
            out.append((number, row, starts.astype("<i4").tobytes(), found.astype("<u8").tobytes()))
        columns = list(zip(*out)) if out else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        names = ("batch", ROW, "starts", "hashes")
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    return documents.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(run, _PASSAGES)


def _sent_passages(passages: DataFrame, ranges: int) -> DataFrame:
    """Distinct passages of each batch, with the number of documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for number in np.unique(numbers):
                blobs = batch.column(1).filter(pa.array(numbers == number)).to_pylist()
                held = [np.unique(np.frombuffer(b, "<u8")) for b in blobs]
                keys, counts = np.unique(np.concatenate(held), return_counts=True)
                yield keycounts.batch_of(keycounts.sent(int(number), keys, counts, ranges, wide=True))

    return passages.select("batch", "hashes").mapInArrow(run, keycounts.SENT)


def _spans(passages: DataFrame, counted: DataFrame, least: int) -> DataFrame:
    """Passages of each document that several hold; overlapping and touching ones as one span."""

    def run(table: pa.Table, came: pa.Table) -> pa.Table:
        shared = np.unique(
            np.concatenate([np.zeros(0, np.uint64), *[keycounts.unpacked_keys(k, "<u8") for k in came.column("keys").to_pylist()]])
        )
        out: list[list[np.ndarray]] = [[], [], []]
        fields = (table.column(n).to_pylist() for n in (ROW, "starts", "hashes"))
        for row, starts, hashes in zip(*fields) if len(shared) else ():
            hashes = np.frombuffer(hashes, "<u8")
            at = np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)
            marked = np.frombuffer(starts, "<i4")[shared[at] == hashes].astype(np.int64)
            if not len(marked):
                continue
            cut = np.flatnonzero(np.diff(marked) > least)
            out[0].append(np.full(len(cut) + 1, row))
            out[1].append(marked[np.concatenate([[0], cut + 1])])
            out[2].append(marked[np.concatenate([cut, [len(marked) - 1]])] + least)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip((ROW, "start", "end"), columns)})

    return passages.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(run, _SPANS)


def shared_passages(written: DataFrame, least: int = LEAST) -> DataFrame:
    """(row, ``start``, ``end``) in words: passages of at least ``least`` words that other documents hold."""
    size = written.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = keycounts.ranges_for(size // 60)
    counted = keycounts.returned(_sent(written, least, ranges))
    passages = materialize(_passages(written, counted, least, ranges), "passages")
    del counted  # the texts were shuffled for the passages, which are written now
    release(written.sparkSession)
    held = passages.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    shared = keycounts.returned(_sent_passages(passages, keycounts.ranges_for(held // 8)), wide=True)
    return _spans(passages, shared, least)


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST
) -> DataFrame:
    """One row per document: key, ``spans`` and ``repeated_words``.

    ``spans`` are (start, end) in words from 0, the end exclusive: all passages of ``least`` words or more
    that another document holds too, words being what stands between white space, A-Z in lower case. Null,
    empty and shorter texts have none. Copies hold each other's passages, repeated rows too. An empty table
    gives an empty table.
    """
    if least < 2:
        raise ValueError("a passage has at least two words")
    written = with_rows(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), "documents")
    spans = shared_passages(written, least)
    listed = spans.groupBy(ROW).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.sum(F.col("end") - F.col("start")).alias("repeated_words"),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return (
        written.select(ROW, "id")
        .join(listed, ROW, "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("repeated_words", F.lit(0)).cast("long").alias("repeated_words"),
        )
    )


def cut_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The texts without the words of their spans; everything else, white space included, stays."""
    schema = T.StructType([*docs.drop(text).schema.fields, T.StructField(text, T.StringType())])
    names = [*docs.drop(text).columns, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            out = []
            for value, cuts in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist()):
                if value and cuts:
                    at = [m.span() for m in word.finditer(value)]
                    for cut in sorted(cuts, key=lambda c: -c["start"]):
                        value = value[: at[cut["start"]][0]] + value[at[cut["end"] - 1][1] :]
                out.append(value)
            held = [batch.column(n) for n in names[:-1]]
            yield pa.RecordBatch.from_arrays([*held, pa.array(out, pa.string())], names)

    return docs.mapInArrow(run, schema)
