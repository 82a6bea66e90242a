"""Embedding near-duplicates: randomised-rotation binary codes with stored correction factors.

A unit vector ``u`` is rotated by a seeded random orthogonal matrix; its code ``b`` is the sign of each component, and
``f = <b, u> / sqrt(d)`` is stored beside it. For a rotated unit vector ``v``, ``<b, v> / (sqrt(d) f)`` estimates ``<u, v>``
without bias, with an error of about ``sqrt((1 - f^2) / f^2 / (d - 1))`` standard deviations. A pair whose estimate plus
``SIGMAS`` such errors stays below the threshold is decided; every other pair is recomputed exactly in double precision.

Pairs meet in buckets: runs of code bits. Vectors at cosine 0.93 agree in a bit with probability 0.88; the length of a run
grows with the logarithm of the rows (so random buckets stay small) and ``tables_for`` gives as many runs, from as many
rotations as needed, as find such a pair with probability ``RECALL``. A pair counts only in the first table in which it meets.
Buckets larger than ``ROWS`` are cut into row blocks, and every pair of blocks is a group of its own: no cap, no large task.
Equal vectors of one label are one row with a weight. Only sums and spanning links leave a block, never all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm.store import Scratch
from kerbsight.operators.components import components

c = F.col
LEAST, RECALL, SIGMAS, SEED = 0.93, 0.995, 4.0, 11
ROWS, GROUP = 512, 1 << 11
_AGREE = 1 - math.acos(LEAST) / math.pi


def bits_for(rows: int) -> int:
    """Bits of a bucket: about log2 of the rows, less seven, so that a random bucket of evenly spread rows holds about 128."""
    return min(32, max(6, math.ceil(math.log2(max(2, rows))) - 7))


def tables_for(bits: int) -> int:
    """Tables that miss a pair at the threshold with probability 1 - RECALL."""
    return math.ceil(math.log(1 - RECALL) / math.log(1 - _AGREE**bits))


@lru_cache(maxsize=64)
def rotation(d: int, turn: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng((SEED, turn)).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def table_codes(units: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """(rows, tables) bucket numbers: successive runs of code bits, rotation after rotation."""
    d = units.shape[1]
    signs = []
    while sum(s.shape[1] for s in signs) < tables * bits:
        signs.append(units @ rotation(d, len(signs)) > 0)
    signs = np.hstack(signs)[:, : tables * bits].reshape(len(units), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def near_pairs(left: np.ndarray, right: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs allowed by ``mask`` whose cosine reaches the threshold; rows are double-precision vectors."""
    d = left.shape[1]
    a = left / np.linalg.norm(left, axis=1)[:, None]
    b = right / np.linalg.norm(right, axis=1)[:, None]
    turn = rotation(d, 0)
    code = np.where(a @ turn > 0, 1.0, -1.0)
    factor = np.maximum((code * (a @ turn)).sum(1) / math.sqrt(d), 1e-6)
    error = SIGMAS * np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 / max(1, d - 1))
    estimate = (code @ (b @ turn).T) / (math.sqrt(d) * factor)[:, None]
    i, j = np.nonzero(mask & (estimate + error[:, None] >= LEAST))
    exact = np.einsum("ij,ij->i", left[i], right[j]) / (np.linalg.norm(left[i], axis=1) * np.linalg.norm(right[j], axis=1))
    return i[exact >= LEAST], j[exact >= LEAST]


def _bucketed(tables: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, part in rows.groupby([rows["vector"].map(len), np.arange(len(rows)) // 2048]):
                vectors = np.array(part["vector"].tolist(), float)
                codes = table_codes(vectors / np.linalg.norm(vectors, axis=1)[:, None], tables, bits)
                yield pd.DataFrame({
                    "node": np.repeat(part["node"].to_numpy(), tables), "label": np.repeat(part["label"].to_numpy(), tables),
                    "bucket_table": np.tile(np.arange(tables), len(part)), "code": codes.ravel()})

    return run


def _linked(tables: int, bits: int):
    """Links inside one group of buckets: weight of the partners by node, and enough links to span the components."""

    def of_width(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Rows whose vectors have equal lengths."""
        vectors = np.array(rows["vector"].tolist(), float)
        codes = table_codes(vectors / np.linalg.norm(vectors, axis=1)[:, None], tables, bits)
        node, weight, side, table = (rows[k].to_numpy() for k in ("node", "weight", "side", "bucket_table"))
        for at in rows.reset_index(drop=True).groupby(["label", "bucket_table", "code", "block_a", "block_b"], sort=False).indices.values():
            left, right = at[side[at] < 2], at[side[at] != 1]
            if len(at) < 2 or not len(left) or not len(right):
                continue
            same = (side[at] == 0).all()
            mask = node[left][:, None] < node[right] if same else np.ones((len(left), len(right)), bool)
            for t in range(table[at[0]]):  # met before, counted there
                mask &= codes[left, t][:, None] != codes[right, t]
            i, j = near_pairs(vectors[left], vectors[right], mask)
            if len(i):
                i, j = left[i], right[j]
                nodes, place = np.unique(np.r_[node[i], node[j]], return_inverse=True)
                partners = np.bincount(place, np.r_[weight[j], weight[i]]).astype(np.int64)
                yield pd.DataFrame({"node": nodes, "partners": partners, "root": _roots(nodes, place[: len(i)], place[len(i) :])})

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [x for _, part in rows.groupby(rows["vector"].map(len)) for x in of_width(part)]
        return pd.concat(out) if out else pd.DataFrame({k: np.empty(0, np.int64) for k in ("node", "partners", "root")})

    return run


def _roots(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component among the links of one block."""
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return nodes[root]
        root = new


def embedding_links(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Only vectors of equal labels are compared. Null labels, null or zero vectors and such with null or non-finite components
    link with nothing and are their own component; so are vectors whose length no other of the label shares. Repeated rows
    are vectors of their own: equal vectors link, under their ids. Different vectors under one id are told apart, also by their links.
    A null vec_id stays null and links like any other; component_id is the smallest id that is not null, and null where there is
    none. An empty table stays empty."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(c("vec_id").cast("long").alias("vec_id"), c("embedding").cast("array<double>").alias("vector"), c("label").cast("string").alias("label"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = c("label").isNotNull() & c("vector").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    # nodes are vectors, whatever their ids; the numbers are written once
    good = good.select(F.monotonically_increasing_id().alias("node"), "least", "label", "vector", "weight")
    good, seen = scratch.keep(good, "embedding-rows", rows=F.count(F.lit(1)))
    bits = bits_for(seen["rows"])
    tables = tables_for(bits)
    room = F.concat_ws(":", F.size("vector").cast("string"), "label").alias("label")  # only equal lengths are compared
    codes = good.select("node", room, "vector").mapInPandas(_bucketed(tables, bits), "node long, label string, bucket_table int, code long")
    codes, coded = scratch.keep(codes, "embedding-codes", rows=F.count(F.lit(1)))
    pairs = _block_pairs(codes, good, 1 + coded["rows"] // GROUP)
    found = scratch.keep(pairs.groupBy("group").applyInPandas(_linked(tables, bits), "node long, partners long, root long"), "embedding-links")

    partners = found.groupBy("node").agg(F.sum("partners").alias("partners"))
    roots = components(found, "node", "root")
    named = good.join(partners, "node", "left").join(roots, "node", "left").select(
        "vector", "label", "least", F.coalesce("root", "node").alias("root"),
        (F.coalesce("partners", F.lit(0)) + c("weight") - 1).alias("links"))
    named = scratch.keep(named, "embedding-named")
    ids = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(ids, "root").drop("root", "least").withColumn("usable", F.lit(True))
    out = rows.join(named, ["usable", "label", "vector"], "left")
    component = F.when(c("links").isNull(), c("vec_id")).otherwise(c("component"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        c("vec_id").eqNullSafe(component).alias("kept"))


def _block_pairs(codes: DataFrame, good: DataFrame, groups: int) -> DataFrame:
    """Rows by pair of row blocks of a bucket; side 0 is a block with itself, 1 and 2 are the two blocks of a pair."""
    key = ["label", "bucket_table", "code"]
    sizes = codes.groupBy(*key).agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    sizes = sizes.withColumn("blocks", F.ceil(c("held") / ROWS).cast("int")).drop("held")
    rows = codes.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("node", "bucket_table"), c("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), c("blocks") - 1))).select(
        "node", *key, F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"),
        F.when(c("own") == c("other"), 0).when(c("own") < c("other"), 1).otherwise(2).alias("side"))
    rows = rows.withColumn("group", F.pmod(F.xxhash64(*key, "block_a", "block_b"), F.lit(groups)))
    return rows.join(good.select("node", "vector", "weight"), "node")
