"""Words, word codes and shingles of whole texts, for use inside tasks.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0D``; ``bytes.split`` without arguments splits
exactly there. Only A-Z are lower-cased, as ``bytes.lower`` does. Codes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

WORD = r"[^\x20\x09-\x0D]+"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_digest = xxhash.xxh64_intdigest


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The texts of a batch as UTF-8 bytes, null as None."""
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_digest, words), np.uint64, len(words))


def mixed(codes: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit codes that spreads every input bit."""
    with np.errstate(over="ignore"):
        out = (codes ^ (codes >> np.uint64(32))) * _STEP
        out = (out ^ (out >> np.uint64(29))) * _STEP
    return out ^ (out >> np.uint64(32))


def run_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """A code for every run of ``size`` successive words; empty where there are fewer words."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = codes[:count].copy()
    with np.errstate(over="ignore"):
        for i in range(1, size):
            out = (out ^ (out >> np.uint64(29))) * _STEP + codes[i : count + i]
    return mixed(out)


def shingle_set(words: list[bytes], size: int = 5) -> np.ndarray:
    """Sorted distinct shingle codes; fewer words than ``size`` make one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    codes = word_codes(words)
    return np.unique(run_codes(codes, min(size, len(codes))))


def signature(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a shingle set."""
    return int(np.uint64(_digest(shingles.tobytes(), 77)).view(np.int64))


def in_chunks(items: Iterator, weigh, most: int) -> Iterator[list]:
    """Lists of successive items whose weights sum to about ``most``; one item alone may weigh more."""
    held, weight = [], 0
    for item in items:
        held.append(item)
        weight += weigh(item)
        if weight >= most:
            yield held
            held, weight = [], 0
    if held:
        yield held
