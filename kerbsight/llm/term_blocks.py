"""Ranked lexical search over posting lists that are cut into geometric blocks.

One pass over all texts writes the forward table: for every document the number of its terms and the counts of those that a query
asks for. Corpus statistics are counted from it. A task then takes its documents in shards of bounded size. In a shard every term
has a posting list; a list is cut into blocks of similar documents (nearest of some of its own documents, in a fixed random
projection of the impact vectors), and list and blocks carry the coordinatewise maximum of their documents' impacts.

A query visits its terms from the heaviest to the lightest. What a document can still add when it is first met at a term is bounded
by the maxima over that term and the lighter ones, because a document with a heavier term was met before. A list or block is skipped
only if that bound is below the score of the query's 20th best document so far; every other document is scored exactly. All values
are whole numbers below 2^53, so sums of doubles are exact.

A first wave searches one shard in ``WAVE``; its 20th best scores are the floor with which the second wave searches all the others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbsight.llm.store import Scratch, text_bytes

c = F.col
TOP = 20
BLOCK = 32
#: cells of a shard's impact matrix (documents x terms of the slice); bounds a task's memory whatever the vocabulary
CELLS = 6_000_000
#: queries are searched in slices of about this many bytes
SLICE_BYTES = 1 << 20
#: one part in so many is searched first
WAVE = 16
_SKETCH, _SEED = 16, 11
#: bytes that belong to no term become spaces, A-Z become small
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if chr(b).isdigit() and b < 0x80 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_FORWARD = "doc_id long, part int, n long, terms array<int>, counts array<int>"
_HITS = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a whole text: maximal runs of ASCII letters and digits and of all other characters, A-Z made small."""
    return text.translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Queries:
    """The items of a slice: their ids, the terms they use, and for each item its terms' numbers and repeats."""

    ids: list
    terms: list[bytes]
    asked: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list[tuple[object, bytes]]) -> "Queries":
        numbers: dict[bytes, int] = {}
        asked = []
        for _, text in rows:
            mine = np.array([numbers.setdefault(t, len(numbers)) for t in terms_of(text)], np.int64)
            asked.append(np.unique(mine, return_counts=True))
        return Queries([i for i, _ in rows], list(numbers), asked)


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, terms of all documents, and the weight of each term of the slice."""

    documents: int
    length: int
    weights: np.ndarray

    def impacts(self, counts: np.ndarray, sizes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What each unit of weight adds: ``counts`` of the terms of documents that hold ``sizes`` of them among ``n``."""
        m = 75 + np.array([25 * x * self.documents // max(1, self.length) for x in n.tolist()], np.int64)
        return 1_000_000_000 * counts // (1000 * counts + 12 * np.repeat(m, sizes))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# ------------------------------------------------------------------------------------- the index
class Shard:
    """Posting lists of some documents, cut into blocks when a query first needs the list.

    ``impacts`` has a row for each document and a column for each term of the slice."""

    def __init__(self, impacts: np.ndarray, related: list[np.ndarray], block: int = BLOCK):
        self.impacts, self.related, self.block = impacts, related, block
        self.top = impacts.max(0)
        held = impacts > 0
        self.lists = [np.flatnonzero(held[:, t]) for t in range(impacts.shape[1])]
        self.tops: dict[int, np.ndarray] = {}
        self.blocks: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}
        spread = np.random.default_rng(_SEED).normal(size=(impacts.shape[1], _SKETCH)).astype(np.float32)
        sketch = impacts @ spread
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)

    def list_top(self, term: int) -> np.ndarray:
        """The coordinatewise maximum of a whole list, over the terms that some query asks together with this one."""
        if term not in self.tops:
            self.tops[term] = self.impacts[np.ix_(self.lists[term], self.related[term])].max(0)
        return self.tops[term]

    def list_blocks(self, term: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The documents of each block of a list, and the blocks' coordinatewise maxima."""
        if term not in self.blocks:
            docs = self.lists[term]
            groups = max(1, len(docs) // self.block)
            near = self.sketch[docs] @ self.sketch[docs[:: max(1, len(docs) // groups)]].T
            home = near.argmax(1)
            order = np.argsort(home, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(home[order]) > 0])
            starts = np.concatenate([np.arange(a, b, 2 * self.block) for a, b in zip(starts, np.r_[starts[1:], len(docs)], strict=True)])
            tops = np.maximum.reduceat(self.impacts[np.ix_(docs[order], self.related[term])], starts, axis=0)
            self.blocks[term] = np.split(docs[order], starts[1:]), tops
        return self.blocks[term]

    def search(self, terms: np.ndarray, gains: np.ndarray, kept: "Best") -> None:
        """Offer ``kept`` every document that may be among the best of a query (terms by falling gain)."""
        met = np.zeros(len(self.impacts), bool)
        rest = np.cumsum((self.top[terms].astype(gains.dtype) * gains)[::-1])[::-1]
        for j, term in enumerate(terms.tolist()):
            if rest[j] < kept.floor:
                break  # nor can the lighter terms lift a document that was not met yet
            if not len(self.lists[term]):
                continue
            tail = np.searchsorted(self.related[term], terms[j:])
            if _dot(self.list_top(term)[tail], gains[j:]) < kept.floor:
                continue
            groups, tops = self.list_blocks(term)
            bounds = _dot(tops[:, tail], gains[j:])
            order = np.argsort(-bounds, kind="stable")
            for a in range(0, len(order), 4):
                some = [groups[b] for b in order[a : a + 4] if bounds[b] >= kept.floor]
                if not some:
                    break
                docs = np.concatenate(some)
                docs = docs[~met[docs]]
                met[docs] = True
                kept.offer(docs, _dot(self.impacts[np.ix_(docs, terms)], gains))


def _dot(rows: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Exact: gains are doubles where sums stay below 2^53, else whole numbers."""
    return rows @ gains if gains.dtype.kind == "f" else rows.astype(np.int64) @ gains


class Best:
    """The best documents of a query so far; no document with a score below ``floor`` can become one of them."""

    def __init__(self, floor: int) -> None:
        self.found: list[tuple[int, tuple[bool, int]]] = []
        self.floor = floor
        self.names: list[int | None] = []

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.floor).tolist():
            name = self.names[docs[i]]
            self.found.append((-int(scores[i]), (name is not None, name or 0)))
        if len(self.found) > TOP:
            self.found = sorted(self.found)[:TOP]
        if len(self.found) == TOP:
            self.floor = max(self.floor, -max(s for s, _ in self.found))


def _searcher(queries: Queries, stats: Statistics, floors: np.ndarray, cells: int, block: int):
    width = max(1, len(queries.terms))
    related: list[set[int]] = [set() for _ in queries.terms]
    plans = []
    for terms, repeats in queries.asked:
        gains = repeats * stats.weights[terms]
        if int(gains.sum()) * 1_000_000 < 1 << 53:
            gains = gains.astype(float)
        order = np.lexsort((terms, -gains))
        order = order[gains[order] > 0]
        plans.append((terms[order], gains[order]))
        for t in terms[order].tolist():
            related[t].update(terms[order].tolist())
    beside = [np.array(sorted(r), np.int64) for r in related]
    most = max(16, cells // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(floor) for floor in floors.tolist()]
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                rows = batch.slice(a, most)
                shard = Shard(_matrix(rows, width, stats), beside, block)
                names = rows.column("doc_id").to_pylist()
                for kept, (terms, gains) in zip(best, plans, strict=True):
                    kept.names = names
                    shard.search(terms, gains, kept)
        hits = [(i, name if known else None, -score) for i, b in enumerate(best) for score, (known, name) in b.found]
        columns = list(zip(*hits, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["item", "doc_id", "score"])

    return run


def _matrix(rows: pa.RecordBatch, width: int, stats: Statistics) -> np.ndarray:
    """Impacts below 10^6, which single precision holds exactly."""
    lists = rows.column("terms")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    n = rows.column("n").to_numpy()
    terms = lists.flatten().to_numpy(zero_copy_only=False)
    counts = rows.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((rows.num_rows, width), np.float32)
    out[np.repeat(np.arange(rows.num_rows), sizes), terms] = stats.impacts(counts, sizes, n)
    return out


# ------------------------------------------------------------------------------------- the passes
def _forward(queries: Queries):
    number = {t: i for i, t in enumerate(queries.terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts, sizes, terms, counts = [], [], [], [], []
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for name, part, text in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), texts, strict=True):
                mine = terms_of(text) if text else []
                if mine:
                    found, times = np.unique(np.array([i for i in map(number.get, mine) if i is not None], np.int32), return_counts=True)
                    for column, value in zip((names, parts, sizes, terms, counts), (name, part, len(mine), found, times.astype(np.int32)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(parts, pa.int32()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "part", "n", "terms", "counts"])

    return run


def _slices(benchmark: DataFrame) -> Iterator[list]:
    """(id, text) of the items that have a text, in slices of about ``SLICE_BYTES``; one item alone may be longer."""
    items = benchmark.select(c("item_id").cast("long").alias("item_id"), c("text").cast("string").alias("text")).where("text is not null")
    count = 1 + text_bytes(items) // SLICE_BYTES
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()
        yield sorted(((r["item_id"], r["text"].encode()) for r in rows), key=lambda r: (r[0] is not None, r))


def _best(hits: DataFrame, by: Column) -> DataFrame:
    order = Window.partitionBy("item").orderBy(c("score").desc(), c("doc_id").asc_nulls_first())
    # hits of many tasks meet in two steps, so that no query's hits are sorted as one group
    near = Window.partitionBy("item", by).orderBy(c("score").desc(), c("doc_id").asc_nulls_first())
    some = hits.withColumn("rank", F.row_number().over(near)).where(c("rank") <= TOP)
    return some.withColumn("rank", F.row_number().over(order)).where(c("rank") <= TOP)


def _search_slice(scratch: Scratch, docs: DataFrame, rows: list, cells: int, block: int) -> DataFrame:
    queries = Queries.of(rows)
    part = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(WAVE)).cast("int")
    texts = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text")).withColumn("part", part)
    forward, seen = scratch.keep(
        texts.mapInArrow(_forward(queries), _FORWARD), "search-forward", documents=F.count(F.lit(1)), length=F.coalesce(F.sum("n"), F.lit(0)))
    holding = np.zeros(len(queries.terms), np.int64)
    for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term of the slice
        holding[r["term"]] = r["count"]
    stats = Statistics(seen["documents"], seen["length"], np.array([weight(seen["documents"], int(h)) for h in holding], np.int64))
    spread = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))
    floors = np.ones(len(rows), np.int64)
    first = forward.where(c("part") == 0).drop("part").mapInArrow(_searcher(queries, stats, floors, cells, block), _HITS)
    first = scratch.keep(_best(first, spread).drop("rank"), "search-first")
    for r in first.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(c("n") >= TOP).collect():
        floors[r["item"]] = r["least"]
    others = forward.where(c("part") > 0).drop("part").mapInArrow(_searcher(queries, stats, floors, cells, block), _HITS)
    best = _best(others.unionByName(first), spread)
    ids = docs.sparkSession.createDataFrame(pa.table({"item": pa.array(range(len(rows)), pa.int32()), "item_id": pa.array(queries.ids, pa.int64())}))
    return best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # ids of one slice


def ranked(docs: DataFrame, benchmark: DataFrame, cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``TOP`` best documents of every item.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Null texts have no terms; documents
    without terms are not counted, items without terms find nothing. Every row is a document or item of its own, whatever its id;
    among equal scores null ids come first. Empty tables give no rows."""
    scratch, out = Scratch(docs.sparkSession), None
    for rows in _slices(benchmark):
        found = _search_slice(scratch, docs, rows, cells, block)
        out = found if out is None else out.unionByName(found)
    return out
