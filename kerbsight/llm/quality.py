"""Quality classifier: kernel ridge on random Fourier features of document statistics, calibrated by isotonic regression.

Every whole text gives a fixed list of statistics. A Gaussian kernel over the standardised statistics is approximated by
``FEATURES`` random cosines. Each task sums the normal equations of its labelled rows; the sums are added up by row of
the matrix, so that the driver only gets one matrix of fixed size. The ridge scores are calibrated by pooling adjacent
violators over score bins (also of fixed number); for that, each half of the labelled rows is scored by the model of the
other half. Neither the number of documents nor that of labels changes the size of anything that the driver holds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import words as W
from kerbsight.llm.store import Scratch

c = F.col
FEATURES, SEED, RIDGE, WIDTH = 192, 20, 1e-3, 4.0
BINS = 1024
HELD_OUT_PARTS = 5
REJECT_BELOW = 0.3
_UPPER, _LOWER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_STOPS, _SYMBOLS, _SPACES = b".,;:?'\"-()", b"#$%&*+=@^_~<>[]{}/\\`", b" \t\n\r\x0b\x0c"
_HIGH = bytes(range(128, 256))
STATISTICS = (
    "log_words", "word_bytes", "upper", "digits", "stops", "bangs", "pipes", "symbols", "high", "lines", "distinct",
    "log_distinct", "again", "top_word", "same_lines", "shouted",
)


def statistics(text: bytes) -> tuple[float, ...]:
    """The statistics of one text, in the order of STATISTICS; an empty text has zeros."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return (0.0,) * len(STATISTICS)

    def share(these: bytes, of: int) -> float:
        return (size - len(text.translate(None, these))) / max(1, of)

    inked = size - round(share(_SPACES, 1))
    distinct, lines = Counter(words), text.split(b"\n")
    return (
        float(np.log1p(n)), inked / n, share(_UPPER, 1) / max(1.0, share(_UPPER + _LOWER, 1)), share(_DIGITS, inked), share(_STOPS, n),
        text.count(b"!") / n, text.count(b"|") / n, share(_SYMBOLS, n), share(_HIGH, inked), len(lines) / n, len(distinct) / n,
        float(np.log1p(len(distinct)) / np.log1p(n)), sum(map(eq, words, words[1:])) / n, distinct.most_common(1)[0][1] / n,
        1 - len(set(lines)) / len(lines), sum(map(bytes.isupper, words)) / n,
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([statistics(t or b"") for t in W.texts_of(batch)], float).reshape(-1, len(STATISTICS))
        columns = [batch.column("doc_id"), *(pa.array(rows[:, i]) for i in range(rows.shape[1]))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *STATISTICS])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every row of ``docs``; null texts count as empty."""
    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text"))
    return docs.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


def part_of(doc_id: Column | str) -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % HELD_OUT_PARTS


@dataclass(frozen=True)
class Model:
    """Standardisation, weights of the features, and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return features(rows, self.mean, self.scale) @ (self.weights if weights is None else weights)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated scores; a hundredth of the raw score keeps the order inside a level."""
        raw = self.raw(rows)
        level = np.interp(raw, self.knots, self.levels) if len(self.knots) else np.full(len(raw), 0.5)
        return np.clip(0.99 * level + 0.01 / (1 + np.exp(-8 * (raw - 0.5))), 0, 1)


def features(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random cosines of the standardised statistics, the statistics themselves and a constant."""
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(rows.shape[1], FEATURES)) / WIDTH
    shifts = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((rows - mean) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ directions + shifts), z / 6, np.ones((len(z), 1))])


def _partial_sums(mean: np.ndarray, scale: np.ndarray):
    """One row of the normal equations for each fold and feature, summed over the rows of a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            x, y, fold = rows[list(STATISTICS)].to_numpy(float), rows["quality"].to_numpy(float), rows["fold"].to_numpy()
            for a in range(0, len(x), 4096):
                z = features(x[a : a + 4096], mean, scale)
                for k in (0, 1):
                    own = z[fold[a : a + 4096] == k]
                    both = own.T @ np.hstack([own, y[a : a + 4096][fold[a : a + 4096] == k][:, None]])
                    sums[k] = sums.get(k, 0) + both
        for k, both in sums.items():
            yield pd.DataFrame({"fold": k, "i": np.arange(len(both)), "sums": [r.tobytes() for r in both]})

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(b) for b in rows["sums"]], axis=0)
    return pd.DataFrame({"fold": [rows["fold"].iloc[0]], "i": [rows["i"].iloc[0]], "sums": [total.tobytes()]})


def _solved(sums: np.ndarray) -> np.ndarray:
    gram, right = sums[:, :-1], sums[:, -1]
    count = max(1.0, gram[-1, -1])
    return np.linalg.solve(gram + RIDGE * count * np.eye(len(gram)) / len(gram) * 8, right)


def _pooled(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the nearest non-decreasing values."""
    held: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        held.append([v, w, 1])
        while len(held) > 1 and held[-2][0] >= held[-1][0]:
            v2, w2, n2 = held.pop()
            v1, w1, n1 = held.pop()
            held.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in held])


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of ``stats`` that ``labels`` (doc_id, quality) marks and that are not held out.

    Null labels are left out; of several labels of one document the lowest counts. Without any labelled row, or with one
    class only, every score is near 0.5 or near that class."""
    marks = labels.select(c("doc_id").cast("long").alias("doc_id"), c("quality").cast("double").alias("quality"))
    marks = marks.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    train = stats.where(part_of("doc_id") != 0).join(marks, "doc_id").withColumn("fold", (F.crc32(c("doc_id").cast("string")) / 8).cast("long") % 2)
    train = Scratch(stats.sparkSession).keep(train, "quality-train")
    moments = train.agg(*[f(s).alias(f"{s}_{k}") for s in STATISTICS for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([moments[f"{s}_m"] or 0.0 for s in STATISTICS])
    scale = np.array([max(moments[f"{s}_s"] or 0.0, 1e-6) for s in STATISTICS])
    size = FEATURES + len(STATISTICS) + 1
    sums = np.zeros((2, size, size + 1))
    partial = train.mapInPandas(_partial_sums(mean, scale), "fold int, i int, sums binary")
    for row in partial.groupBy("fold", "i").applyInPandas(_added, "fold int, i int, sums binary").collect():
        sums[row["fold"], row["i"]] = np.frombuffer(row["sums"])
    if not sums[:, -1, -2].sum():
        return Model(mean, scale, np.zeros(size), np.empty(0), np.empty(0))
    model = Model(mean, scale, _solved(sums.sum(0)), np.empty(0), np.empty(0))
    other = [_solved(sums[1]), _solved(sums[0])]

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x, fold = rows[list(STATISTICS)].to_numpy(float), rows["fold"].to_numpy()
            raw = np.where(fold == 0, model.raw(x, other[0]), model.raw(x, other[1]))
            yield pd.DataFrame({"bin": np.floor(np.clip(raw, -0.5, 1.5) * BINS).astype(int), "quality": rows["quality"].to_numpy(float)})

    bins = train.mapInPandas(binned, "bin int, quality double").groupBy("bin").agg(F.avg("quality").alias("value"), F.count(F.lit(1)).alias("weight"))
    curve = np.array(sorted((r["bin"], r["value"], r["weight"]) for r in bins.collect()), float)
    return Model(mean, scale, model.weights, (curve[:, 0] + 0.5) / BINS, _pooled(curve[:, 1], curve[:, 2]))


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the calibrated score of every row, 0 to 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x = rows[list(STATISTICS)].to_numpy(float)
            got = [model.score(x[a : a + 4096]) for a in range(0, len(x), 4096)]
            yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "score": np.concatenate(got) if got else []})

    return stats.mapInPandas(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Only ``text`` is read for the score. Null and empty texts are scored as such. A null doc_id has no label and is not
    held out. Repeated rows are scored alike. An empty table gives an empty result."""
    stats = Scratch(docs.sparkSession).keep(measured(docs), "quality-statistics")
    out = scored(stats, fit(stats, labels))
    return out.select(
        "doc_id", F.coalesce(part_of("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        (c("score") >= REJECT_BELOW).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    Scores are computed beside the row, in one pass over the texts, so no join of the documents is needed."""
    stats = Scratch(docs.sparkSession).keep(measured(docs), "quality-statistics")
    model = fit(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t or b"") for t in W.texts_of(batch)], float).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(model.score(rows) >= REJECT_BELOW))

    return docs.mapInArrow(run, docs.schema)
