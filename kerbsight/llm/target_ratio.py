"""Quality rules: counting rules, and a hashed n-gram log-likelihood ratio between trusted documents and the whole corpus.

Words and pairs of neighbouring words are hashed to ``BUCKETS`` buckets. The corpus multinomial counts the n-grams of all
documents, the target multinomial those of trusted ones (labelled as good); the target is smoothed by ``BUCKETS`` n-grams of the
corpus. A document's score is the sum of its n-grams' log ratios over their number plus ``EVEN_GRAMS``, which draws very short
texts towards 0. Log ratios are whole millionths, so sums and verdicts do not depend on the order or the partition of rows.

The counts are two vectors of fixed length, whatever the corpus; they are summed in every task and then by bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import words as W

c = F.col
BUCKETS = 1 << 16
#: bound of the trusted sample that the target multinomial is fitted on; the corpus side counts every document
TRUSTED_ROWS = 50_000
EVEN_GRAMS = 50
#: kept when the score is at least this, in millionths of a nat for each n-gram
LEAST_SCORE = -100_000
FEWEST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
_PAIR, _WORD_BITS = 1_000_003, (1 << 31) - 1
_SYMBOLS = b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))  # the bytes of UTF-8 that do not begin a code point
_HELD_WORDS = 400_000
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RULES = "doc_id long, " + ", ".join(f"{n} long" for n in (*_BASE, "n_grams", "ratio")) + ", base_failed boolean, kept boolean"


class _Hashes:
    """31-bit hashes of words, remembered for the most recent ``_HELD_WORDS`` distinct ones at least."""

    def __init__(self) -> None:
        self.new: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._one, words), np.int64, len(words))

    def _one(self, word: bytes) -> int:
        code = self.new.get(word)
        if code is None:
            code = self.old.get(word)
            if code is None:
                code = int.from_bytes(hashlib.md5(word).digest()[:4], "big") >> 1
            if len(self.new) >= _HELD_WORDS:
                self.old, self.new = self.new, {}
            self.new[word] = code
        return code


def grams(codes: np.ndarray) -> np.ndarray:
    """The buckets of all words and pairs of a text, from its words' hashes."""
    pairs = ((codes[:-1] * _PAIR & _WORD_BITS) + codes[1:]) % BUCKETS
    return np.concatenate([codes % BUCKETS, pairs])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """The number of words that lie in a window of ``window`` words found twice or more in the text."""
    if len(words) <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    codes = W.run_codes(W.mixed(ids.astype(np.uint64)), window)
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    if not same.any():
        return 0
    views = np.lib.stride_tricks.sliding_window_view(ids, window)
    left, right = order[:-1][same], order[1:][same]
    if any((views[left[a : a + 4096]] != views[right[a : a + 4096]]).any() for a in range(0, len(left), 4096)):
        _, codes = np.unique(views, axis=0, return_inverse=True)  # two windows share a code: compare words
        order = np.argsort(codes.ravel(), kind="stable")
        same = codes.ravel()[order][1:] == codes.ravel()[order][:-1]
        left, right = order[:-1][same], order[1:][same]
    starts = np.zeros(len(words) + 1, np.int64)
    again = np.unique(np.concatenate([left, right]))
    np.add.at(starts, again, 1)
    np.add.at(starts, again + window, -1)
    return int((np.cumsum(starts) > 0).sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, ...]:
    """The counts of ``_BASE``."""
    inside = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return (
        len(words), len(inside.translate(None, _CONTINUED)),
        len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
    )


@dataclass(frozen=True)
class Ratios:
    """Millionths of the log ratio of every bucket."""

    weights: np.ndarray

    def verdict(self, counts: tuple[int, ...], codes: np.ndarray) -> tuple[int, int, bool, bool]:
        """(n_grams, ratio, base_failed, kept): ratio is the sum of log ratios, in millionths."""
        found = grams(codes) if len(codes) else np.empty(0, np.int64)
        total = int(self.weights[found].sum())
        failed = counts[0] < FEWEST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]
        return len(found), total, failed, not failed and total >= LEAST_SCORE * (len(found) + EVEN_GRAMS)


def trusted_ids(labels: DataFrame) -> np.ndarray:
    """The ids that all their labels call good; of more than ``TRUSTED_ROWS`` those whose ids' MD5 is least."""
    marks = labels.select(c("doc_id").cast("long").alias("doc_id"), c("quality").cast("double").alias("quality"))
    good = marks.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("least")).where("least = 1")
    first = good.select("doc_id").orderBy(F.md5(c("doc_id").cast("string").cast("binary")), "doc_id").limit(TRUSTED_ROWS)
    return np.sort(np.array([r["doc_id"] for r in first.collect()], np.int64))  # 400 kB at most


def _count(trusted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sums = _Hashes(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), W.texts_of(batch), strict=True):
                if not text or not (words := text.split()):
                    continue
                found = np.bincount(grams(hashes.of(words)), minlength=BUCKETS)
                sums[0] += found
                at = np.searchsorted(trusted, doc) if doc is not None else len(trusted)
                if at < len(trusted) and trusted[at] == doc:
                    sums[1] += found
        seen = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[0][seen]), pa.array(sums[1][seen])], names=["bucket", "raw", "target"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Ratios:
    """Log ratios from all texts of ``docs``; without a trusted text all of them are 0."""
    texts = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text"))
    counts = texts.mapInArrow(_count(trusted_ids(labels)), "bucket long, raw long, target long")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():  # BUCKETS rows at most
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    ratio = (target * (raw.sum() + BUCKETS) / (raw + 1) + BUCKETS) / (target.sum() + BUCKETS)
    weights = np.round(1e6 * np.log(ratio)).astype(np.int64)
    return Ratios(weights if target.any() else np.zeros_like(weights))


def rule_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_grams, ratio, base_failed, kept) of every row.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality (1: trusted). Null and empty texts have no words, so the base rules
    reject them. A null doc_id is never trusted; rows that repeat an id are judged row by row. Null labels are left out, and an id
    with any other label than 1 is not trusted. An empty table gives an empty result."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            rows = []
            for text in W.texts_of(batch):
                words = (text or b"").split()
                counts = base_counts(text or b"", words)
                rows.append((*counts, *model.verdict(counts, hashes.of(words))))
            made = [pa.array([r[i] for r in rows], pa.int64() if i < 7 else pa.bool_()) for i in range(9)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", *_BASE, "n_grams", "ratio", "base_failed", "kept"])

    return docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text")).mapInArrow(run, _RULES)


def keep_passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            texts = [(t or b"", (t or b"").split()) for t in W.texts_of(batch)]
            yield batch.filter(pa.array([model.verdict(base_counts(t, w), hashes.of(w))[3] for t, w in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
