"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle check.

A window of as many words as a benchmark item is fingerprinted like the item: each 5-word shingle votes on 64 bits with its
weight, the number of times it occurs. Shingle bags of similarity 0.75 differ in 11 bits on average (standard deviation 3);
``RADIUS`` is 23. Eight blocks of eight bits find *every* fingerprint within it: if all blocks differed in three bits or
more, the distance would be 24. Candidates are verified by the exact weighted Jaccard similarity of both bags.

Fingerprints are only computed where they can matter: bags of equal size ``m`` reach 0.75 only if 6 of 7 shingles are
shared, so a window with fewer shingles of an item cannot match it. That test is exact; it costs one lookup for each word, and
the items are only counted where a shingle of theirs is found.

The items are a small table. Its size is checked; a larger one is scanned slice by slice, each small enough to broadcast.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import words as W
from kerbsight.llm.store import text_bytes

c = F.col
SHINGLE, LEAST, RADIUS = 5, 0.75, 23
SLICE_BYTES = 8 << 20
_BLOCKS, _NEAR = 8, RADIUS // 8
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
RESULT = "doc_id long, item_id string, start long, n_words long, similarity double"


def fingerprint(shingles: np.ndarray) -> np.uint64:
    """Bit i is set if the shingles with bit i outweigh those without; repeated shingles vote repeatedly."""
    bits = np.unpackbits(W.mixed(shingles).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(shingles)).view(">u8")[0].astype(np.uint64)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: sum of the smaller weights over the sum of the larger ones."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


class Items:
    """The items of one slice: their bags, fingerprints by window size, and which of them hold a shingle."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        self.names, self.bags, self.sizes, prints = [], [], [], []
        for name, text in items:
            codes = W.word_codes(text.lower().split())
            if len(codes):
                runs = W.run_codes(codes, min(SHINGLE, len(codes)))
                self.names.append(name)
                self.bags.append(Counter(runs.tolist()))
                self.sizes.append(len(codes))
                prints.append(fingerprint(runs))
        self.prints = np.array(prints, np.uint64)
        self.by_size: dict[int, np.ndarray] = {s: np.flatnonzero(np.array(self.sizes) == s) for s in sorted(set(self.sizes))}
        self.held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # by shingle length: codes, first place in items, items
        for k in {min(n, SHINGLE) for n in self.sizes}:
            pairs = np.array(sorted((s, i) for i, (bag, n) in enumerate(zip(self.bags, self.sizes, strict=True)) if min(n, SHINGLE) == k for s in bag), np.uint64)
            codes, first = np.unique(pairs[:, 0], return_index=True)
            self.held[k] = codes, np.r_[first, len(pairs)], pairs[:, 1].astype(np.int64)
        self._near: dict[tuple[int, int, int], np.ndarray] = {}

    def near(self, size: int, print_: np.uint64) -> np.ndarray:
        """All items of ``size`` words whose fingerprint is within the radius."""
        blocks = np.array([print_], ">u8").view(np.uint8)
        own = self.by_size[size]
        found = [self._block(size, b, int(v)) for b, v in enumerate(blocks)]
        candidates = np.unique(np.concatenate(found))
        if not len(candidates):
            return candidates
        apart = _ONES[(self.prints[own[candidates]] ^ print_).view(np.uint8).reshape(-1, 8)].sum(1)
        return own[candidates[apart <= RADIUS]]

    def _block(self, size: int, block: int, value: int) -> np.ndarray:
        key = (size, block, value)
        if key not in self._near:
            theirs = self.prints[self.by_size[size]].astype(">u8").view(np.uint8).reshape(-1, _BLOCKS)[:, block]
            self._near[key] = np.flatnonzero(_ONES[theirs ^ np.uint8(value)] <= _NEAR)
        return self._near[key]

    def matches(self, text: bytes) -> list[tuple[str | None, int, int, float]]:
        """(item, first word, words, similarity) of the best window for each item that the text holds; first on ties."""
        if not self.names:
            return []
        codes = W.word_codes(text.lower().split())
        best: dict[int, tuple[float, int, int]] = {}
        for k, (known, first, items) in self.held.items():
            runs = W.run_codes(codes, k)
            at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
            hits = np.flatnonzero(known[at] == runs)
            if not len(hits):
                continue
            for size, starts in self._windows(k, runs, hits, [items[first[j] : first[j + 1]] for j in at[hits]]).items():
                wide = min(size - k + 1, len(runs))  # a text shorter than the item is one window
                for start in sorted(starts):
                    window = runs[start : start + wide]
                    for item in self.near(size, fingerprint(window)):
                        close = similarity(Counter(window.tolist()), self.bags[item])
                        if close >= LEAST and close > best.get(item, (0.0,))[0]:
                            best[item] = (close, start, wide + k - 1)
        return [(self.names[i], start, n, close) for i, (close, start, n) in sorted(best.items())]

    def _windows(self, k: int, runs: np.ndarray, hits: np.ndarray, holders: list[np.ndarray]) -> dict[int, set[int]]:
        """By item size the windows that hold enough shingles of some item of that size."""
        item = np.concatenate(holders)
        place = np.repeat(hits, [len(h) for h in holders])
        out: dict[int, set[int]] = defaultdict(set)
        names, counts = np.unique(item, return_counts=True)
        for i, count in zip(names.tolist(), counts.tolist(), strict=True):
            size = self.sizes[i]
            most = size - k + 1
            wide = min(most, len(runs))
            # equal bags of m share 6 m / 7; a shorter text, 0.75 of what it could at most have
            needed = -(-6 * wide // 7) if wide == most else LEAST * most
            if count >= needed:
                own = np.zeros(len(runs) + 1, np.int64)
                own[place[item == i] + 1] = 1
                before = np.cumsum(own)
                out[size].update(np.flatnonzero(before[wide:] - before[:-wide] >= needed).tolist())
        return out


def _slices(benchmark: DataFrame) -> Iterator[Items]:
    """The items as (id as text, text), in slices of bounded size; null texts are left out."""
    items = benchmark.select(c("item_id").cast("string").alias("item_id"), c("text").cast("string").alias("text")).where("text is not null")
    count = 1 + text_bytes(items) // SLICE_BYTES
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k).distinct().orderBy("item_id", "text").collect()
        yield Items([(r["item_id"], r["text"].encode()) for r in rows])


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): the best matching window for each document and item that match.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored. item_id is returned as
    text. Null and empty texts match nothing. Items of fewer than five words are one shingle, so they match exactly or not
    at all. Repeated rows of ``docs`` repeat their matches, repeated items count once. Empty tables give no rows."""
    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text"))
    out = None
    for items in _slices(benchmark):
        found = docs.mapInArrow(_matching(items), RESULT)
        out = found if out is None else out.unionByName(found)
    return out


def _matching(items: Items):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = defaultdict(list)
            for doc, text in zip(batch.column("doc_id").to_pylist(), W.texts_of(batch), strict=True):
                for item, start, n, close in items.matches(text or b""):
                    for name, value in zip(schema.names, (doc, item, start, n, close), strict=True):
                        rows[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)

    return run


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of ``benchmark``, with all their columns; a text must be in ``text``."""
    for items in _slices(benchmark):
        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not items.matches(t or b"") for t in W.texts_of(batch)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
