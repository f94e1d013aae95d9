"""Global counts of 64-bit keys that batches of rows hold, returned to each batch.

A batch sends its distinct keys, cut by their leading bits into ranges, as arrays of the following 32
bits. Sorted keys travel as their differences, and numbers as their first bytes, then their second bytes and
so on, so that the bytes that are zero compress. The task of a range adds up the counts and sends each batch the keys that more than one row holds.
A frequent key comes once per batch, not once per row, and there are as many ranges as bound a task's
keys, so neither hot keys nor a large corpus gather in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KEYS_PER_RANGE = 2_000_000
SENT = "batch long, range int, keys binary, counts binary"


def ranges_for(keys: int) -> int:
    """A power of two ranges, each of about ``KEYS_PER_RANGE`` keys; no fewer than 64."""
    return 1 << max(6, int(np.ceil(np.log2(max(1, keys) / KEYS_PER_RANGE))))


def packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers of a kind as bytes: the first byte of each, then the second of each."""
    held = np.ascontiguousarray(values.astype(kind))
    return held.view(np.uint8).reshape(len(held), held.itemsize).T.tobytes()


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(blob, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def packed_keys(keys: np.ndarray, kind: str) -> bytes:
    """Sorted keys by their differences."""
    return packed(np.diff(keys.astype(kind), prepend=np.zeros(1, kind)), kind)


def unpacked_keys(blob: bytes, kind: str) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(unpacked(blob, kind), dtype=kind)


def placed(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and remaining 32 bits of each key. Sorted keys stay sorted."""
    bits = ranges.bit_length() - 1
    high = (keys >> np.uint64(64 - bits)).astype(np.int64)
    return high, (keys >> np.uint64(32 - bits)).astype(np.uint32)


def sent(batch: int, keys: np.ndarray, counts: np.ndarray, ranges: int, wide: bool = False) -> list[tuple]:
    """Rows of ``SENT`` for the sorted distinct keys of a batch; ``wide`` keys keep all their bits."""
    high, low = placed(keys, ranges)
    low, kind = (keys, "<u8") if wide else (low, "<u4")
    edges = np.flatnonzero(np.diff(high, prepend=-1))
    out = []
    for a, b in zip(edges, [*edges[1:], len(keys)]):
        out.append(
            (batch, int(high[a]), packed_keys(low[a:b], kind), packed(counts[a:b], "<u4"))
        )
    return out


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    batch, high, keys, counts = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(batch, pa.int64()), pa.array(high, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
        ["batch", "range", "keys", "counts"],
    )


def added(table: pa.Table, wide: bool = False) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The keys of each row of a range; its distinct keys, each key's place among them, and their totals."""
    keys = [unpacked_keys(k, "<u8" if wide else "<u4") for k in table.column("keys").to_pylist()]
    counts = np.concatenate([unpacked(c, "<u4") for c in table.column("counts").to_pylist()])
    held, place = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, held, place, np.bincount(place, weights=counts, minlength=len(held)).astype(np.int64)


def returned(sent_rows: DataFrame, at_least: int = 2, wide: bool = False) -> DataFrame:
    """To each batch, its keys whose total is ``at_least`` so much, with their totals in ``counts``."""

    def total(table: pa.Table) -> pa.Table:
        batches = table.column("batch").to_pylist()
        keys, held, place, totals = added(table, wide)
        mine = np.minimum(totals, 2**32 - 1).astype("<u4")[place]
        out, at = [], 0
        number = table.column("range")[0].as_py()
        for batch, k in zip(batches, keys):
            t = mine[at : at + len(k)]
            at += len(k)
            take = t >= at_least
            if take.any():
                out.append((batch, number, packed_keys(k[take], "<u8" if wide else "<u4"), packed(t[take], "<u4")))
        return pa.Table.from_batches([batch_of(out)])

    return sent_rows.groupBy("range").applyInArrow(total, SENT)


def lookup(rows: Iterator[tuple[int, bytes, bytes]], ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys, of range and 32 bits, and their totals, from what came back to a batch."""
    bits = ranges.bit_length() - 1
    keys, totals = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    for high, k, t in rows:
        keys.append((np.uint64(high) << np.uint64(32)) | unpacked_keys(k, "<u4").astype(np.uint64))
        totals.append(unpacked(t, "<u4"))
    joined, total = np.concatenate(keys), np.concatenate(totals)
    joined, first = np.unique(joined, return_index=True)
    assert bits <= 32
    return joined, total[first]


def short(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Keys cut to their range and 32 bits, in one number."""
    bits = ranges.bit_length() - 1
    return keys >> np.uint64(32 - bits)
