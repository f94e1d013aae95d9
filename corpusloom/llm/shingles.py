"""Words and word n-grams of whole texts as 64-bit hashes, computed for a batch of texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# A-Z to lower case; white space is a blank and the five control characters from tab to return.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_CODES = np.random.Generator(np.random.PCG64(20_240_601)).integers(
    1, 2**64, 256, dtype=np.uint64, endpoint=False
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_TOGETHER = 1 << 19  # bytes hashed at once, each of which takes some tens of bytes of arrays


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _STEP
        x = (x ^ (x >> np.uint64(29))) * _FACTOR
        return x ^ (x >> np.uint64(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), base)]), dtype=np.uint64)[:n]


def hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of lower-cased bytes."""
    b = np.frombuffer(data, np.uint8)
    word = np.zeros(len(b) + 2, bool)
    word[1:-1] = _IS_WORD[b]
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = _powers(int(lengths.max()), _FACTOR)
    with np.errstate(over="ignore"):
        part = _CODES[b[word[1:-1]]] * powers[inside]
        total = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
        cut = np.concatenate([[0], np.cumsum(lengths)])
        return mixed(total[cut[1:]] - total[cut[:-1]] + lengths.astype(np.uint64)), starts


def word_hashes(texts: Sequence[str | None]) -> list[np.ndarray]:
    """The hashes of each text's words in order; null texts have none."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0

    def flush() -> None:
        if not part:
            return
        hashes, starts = hashed(b"\n".join(part))
        ends = np.cumsum([len(p) + 1 for p in part])
        out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))
        part.clear()

    for text in texts:
        part.append((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
        size += len(part[-1])
        if size >= _TOGETHER:
            flush()
            size = 0
    flush()
    return out


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order; a shorter text is one run of all its words."""
    if not len(words):
        return words
    k = min(n, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - k + 1, np.uint64(k), np.uint64)
        for i in range(k):
            total = total * _STEP + words[i : len(words) - k + 1 + i]
    return mixed(total)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The distinct runs of ``n`` words, sorted."""
    return np.unique(ngrams(words, n))
