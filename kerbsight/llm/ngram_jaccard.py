"""N-gram Jaccard join: exact links between documents by a blocked sparse product of the incidence matrix.

Rows of the matrix are the distinct shingle sets of the corpus (equal sets are one row, so copies cost one row), columns
are shingles. The product of the matrix with itself holds the overlap of every pair; two rows link when
``100 * overlap >= 75 * union``, which needs ``overlap >= ceil(75 n / 100)`` for either size ``n``. So:

1. *Column blocks, counting.* Every row gives the first ``n - ceil(.75 n) + ceil(.1 n)`` of its columns in code order to
   blocks of columns. A block tells which columns hold more than one row. Two linked rows share at least the smaller
   ``ceil(.1 n)`` of them, so a row with fewer shared columns than ``ceil(.075 n)`` has no partner and is discarded. Tasks
   resolve columns that already repeat among their own rows, and send one entry for them: a frequent column is
   pre-aggregated before the shuffle.
2. *Whole rows.* The remaining rows count their columns' holders exactly; rows with fewer than ``ceil(.75 n)`` shared
   columns are discarded. The others order their columns rarest first and keep the prefix in which any partner must meet
   them.
3. *Masked product.* Overlaps are accumulated for row pairs that meet in a prefix column, size bounds permitting. Two
   rounds first multiply each row only with one pivot row of each of its columns, which already joins dense groups;
   pairs inside one component need no product any more. Columns whose rows are still in several components are left.
   Where at most ``SPARSE`` rows meet in one, their pairs are listed, size and position bounds permitting. Rows that
   denser columns tie together are a family, multiplied as a blocked product: its rows are dealt into row blocks, a task
   takes a pair of blocks, accumulates the overlaps of their rows column by column, and only the links that join two
   components leave it. The rows of a family's largest component meet the others only, not each other. There is no cap,
   so no link that joins two components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from kerbsight.llm import words as W
from kerbsight.llm.store import Scratch, is_small, text_bytes
from kerbsight.operators.components import components

c = F.col
SHINGLE = 5
PIVOT_ROUNDS = 2
#: Entries that a task gathers before it sends them to the column blocks, and aims to have in one block.
CHUNK, BLOCK = 1_000_000, 1_000_000
#: Rows of a column whose pairs are listed one by one; entries that a row block of the product aims to have.
SPARSE, ROW_BLOCK = 32, 250_000
_ROWS = "kind int, doc_id long, text_code long, n long, sig long, block int, keys binary, owners binary, sigs binary"


def _least(n):
    """The smallest overlap with any partner of a set of ``n``: ceil(75 n / 100)."""
    return -(-75 * n // 100)


def _first_pass(blocks: int):
    """Per document its size and set name; per chunk and block the entries of the row prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents():
            for batch in batches:
                ids = zip(batch.column("doc_id").to_pylist(), batch.column("text_code").to_pylist(), strict=True)
                for (doc, code), text in zip(ids, W.texts_of(batch), strict=True):
                    found = W.shingle_set((text or b"").lower().split(), SHINGLE)
                    n = len(found)
                    yield doc, n, W.signature(found) if n else None, found[: n - _least(n) + -(-n // 10)].copy(), code

        for held in W.in_chunks(documents(), lambda d: len(d[3]) + 64, CHUNK):
            yield _doc_rows(held)
            entries = {sig: prefix for _, n, sig, prefix, _ in held if n}
            if entries:
                yield _block_rows(entries, blocks)

    return run


def _batch(**columns) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "doc_id": pa.int64(), "text_code": pa.int64(), "n": pa.int64(), "sig": pa.int64(), "block": pa.int32(),
             "keys": pa.binary(), "owners": pa.binary(), "sigs": pa.binary()}
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(k, [None] * rows), kind) for k, kind in kinds.items()], names=list(kinds))


def _doc_rows(held: list) -> pa.RecordBatch:
    return _batch(kind=[0] * len(held), doc_id=[d[0] for d in held], text_code=[d[4] for d in held], n=[d[1] for d in held], sig=[d[2] for d in held])


def _block_rows(entries: dict[int, np.ndarray], blocks: int) -> pa.RecordBatch:
    """Kind 1: entries by block; columns that repeat in this chunk go as one entry without an owner (65535 and up are
    never owners, as owners count inside a row's own list). Kind 2: how many repeated columns each row has here."""
    sigs = np.fromiter(entries, np.int64, len(entries))
    keys = np.concatenate(list(entries.values()))
    owners = np.repeat(np.arange(len(sigs), dtype=np.int32), [len(v) for v in entries.values()])
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    last = np.r_[first[1:], True]
    repeated = ~(first & last)
    local = np.bincount(owners[repeated], minlength=len(sigs))
    owners[repeated] = -1
    keys, owners = keys[first], owners[first]
    block = (W.mixed(keys) % np.uint64(blocks)).astype(np.int32)
    order = np.argsort(block, kind="stable")
    keys, owners, block = keys[order], owners[order], block[order]
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    out = {"kind": [], "block": [], "keys": [], "owners": [], "sigs": []}
    for a, b in zip(cuts, np.r_[cuts[1:], len(block)], strict=True):
        own, at = np.unique(owners[a:b], return_inverse=True)
        names = np.where(own < 0, 0, sigs[np.maximum(own, 0)])
        at = at.astype(np.int32)
        if own[0] < 0:
            at -= 1
            names = names[1:]
        for k, v in (("kind", 1), ("block", int(block[a])), ("keys", keys[a:b].tobytes()), ("owners", at.tobytes()), ("sigs", names.tobytes())):
            out[k].append(v)
    some = local > 0
    for k, v in (("kind", 2), ("block", None), ("keys", None), ("owners", local[some].astype(np.int32).tobytes()), ("sigs", sigs[some].tobytes())):
        out[k].append(v)
    return _batch(**out)


def _shared_in_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one column block: how many of a row's columns more than one row holds."""
    keys, sigs, owned = [], [], []
    for k, o, s in zip(rows["keys"], rows["owners"], rows["sigs"], strict=True):
        at, names = np.frombuffer(o, np.int32), np.frombuffer(s, np.int64)
        keys.append(np.frombuffer(k, np.uint64))
        owned.append(at >= 0)
        sigs.append(np.where(at >= 0, names[np.maximum(at, 0)], 0) if len(names) else np.zeros(len(at), np.int64))
    keys, sigs, owned = map(np.concatenate, (keys, sigs, owned))
    order = np.argsort(keys, kind="stable")
    keys, sigs, owned = keys[order], sigs[order], owned[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[start, len(keys)])
    differ = np.minimum.reduceat(sigs, start) != np.maximum.reduceat(sigs, start)
    marked = ~np.logical_and.reduceat(owned, start)
    shared = np.repeat(differ | marked, size) & owned
    names, count = np.unique(sigs[shared], return_counts=True)
    return pd.DataFrame({"sig": names, "shared": count.astype(np.int64)})


def _local_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for o, s in zip(rows["owners"], rows["sigs"], strict=True):
            yield pd.DataFrame({"sig": np.frombuffer(s, np.int64), "shared": np.frombuffer(o, np.int32).astype(np.int64)})


def _whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole shingle sets of the documents that stand for the remaining rows."""
    for batch in batches:
        sigs, sets = [], []
        for sig, text in zip(batch.column("sig").to_pylist(), W.texts_of(batch), strict=True):
            found = W.shingle_set((text or b"").lower().split(), SHINGLE)
            if len(found) and W.signature(found) == sig:  # another row may carry the same doc_id
                sigs.append(sig)
                sets.append(found.view(np.int64))
        flat = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets) if sets else [], pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), flat], names=["sig", "n", "shingles"])


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, members): rows of the matrix with their component, and every document's size and row.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. Returns ``members`` (doc_id, n_shingles, sig;
    one row for each row of ``docs``, sig null without words) and ``roots`` (sig, root) for the sets that link with a
    different set; a set that is missing there is its own component. Null texts count as empty. Rows with the same
    doc_id are documents of their own. An empty table gives empty tables.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text")).withColumn("text_code", F.xxhash64("text"))
    blocks = max(64, text_bytes(docs) // (18 * BLOCK))
    parts = scratch.keep(docs.mapInArrow(_first_pass(blocks), _ROWS), "jaccard-parts")
    members = scratch.keep(parts.where("kind = 0").select("doc_id", c("n").alias("n_shingles"), "sig", "text_code"), "jaccard-members")

    in_blocks = parts.where("kind = 1").select("block", "keys", "owners", "sigs").groupBy("block").applyInPandas(_shared_in_block, "sig long, shared long")
    in_chunks = parts.where("kind = 2").select("owners", "sigs").mapInPandas(_local_counts, "sig long, shared long")
    shared = in_blocks.unionByName(in_chunks).groupBy("sig").agg(F.sum("shared").alias("shared"))
    classes = members.where("sig is not null").groupBy("sig").agg(F.min(F.struct("doc_id", "text_code")).alias("rep"), F.first("n_shingles").alias("n"))
    live, seen = scratch.keep(
        classes.join(shared, "sig").where(c("shared") >= F.greatest(F.lit(1), F.ceil(c("n") * 3 / 40))).select(c("rep.doc_id").alias("rep"), c("rep.text_code").alias("rep_code"), "sig"),
        "jaccard-live", rows=F.count(F.lit(1)))
    scratch.drop(parts)

    whole = _representatives(docs, F.broadcast(live) if is_small(seen["rows"], 40) else live)
    whole, got = scratch.keep(whole.mapInArrow(_whole_rows, "sig long, n long, shingles array<long>"), "jaccard-rows", rows=F.count(F.lit(1)))
    if got["rows"] > seen["rows"]:  # repeated rows of one doc_id and text
        whole = scratch.keep(whole.dropDuplicates(["sig"]), "jaccard-rows")

    prefix = scratch.keep(_prefixes(whole), "jaccard-prefixes")
    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    for turn in range(PIVOT_ROUNDS + 1):
        if turn < PIVOT_ROUNDS:
            links = _multiplied(_pivot_pairs(prefix, roots, turn), whole)
        else:
            rows = scratch.keep(_open_rows(prefix, roots), "jaccard-open")
            links = _multiplied(_cross_pairs(rows.where(c("held") <= SPARSE)), whole)
            links = links.unionByName(_blocked_product(_in_blocks(scratch, rows.where(c("held") > SPARSE)), whole))
        joined = components(scratch.keep(links, "jaccard-links"), "ar", "br")
        roots = scratch.keep(_carried(roots, joined), "jaccard-roots")
    return members.drop("text_code"), roots.select(c("node").alias("sig"), "root")


def _representatives(docs: DataFrame, live: DataFrame) -> DataFrame:
    """(sig, text) of the rows that stand for the sets of ``live``. A set is found by one id and text code, so rows that share
    an id, or have none, do not meet each other's sets."""
    return docs.join(live, docs.doc_id.eqNullSafe(c("rep")) & (docs.text_code == c("rep_code"))).select("sig", "text")


def _carried(roots: DataFrame, joined: DataFrame) -> DataFrame:
    """The roots of all nodes after the components in ``joined``, whose nodes are roots so far, have grown together."""
    nodes = roots.unionByName(joined.select("node", c("node").alias("root"))).distinct()
    new = joined.select(c("node").alias("root"), c("root").alias("new"))
    return nodes.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root"))


def _prefixes(whole: DataFrame) -> DataFrame:
    """(sig, n, s, f): the columns, rarest first, in which any partner must meet row ``sig``; f is the place in its order.

    Columns that no other row holds come first; they are counted, not listed."""
    entries = whole.select("sig", "n", F.explode("shingles").alias("s"))
    held = entries.groupBy("s").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    own = Window.partitionBy("sig")
    least = F.ceil(c("n") * 3 / 4)
    return (
        entries.join(held, "s")
        .withColumn("shared", F.count(F.lit(1)).over(own))
        .where(c("shared") >= least)
        .withColumn("f", c("n") - c("shared") + F.row_number().over(own.orderBy("held", "s")) - 1)
        .where(c("f") <= c("n") - least)
        .select("sig", "n", "s", "f")
    )


def _with_root(prefix: DataFrame, roots: DataFrame) -> DataFrame:
    return prefix.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))


def _pivot_pairs(prefix: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """Each row with one row of each of its prefix columns, if that is in another component."""
    rows = _with_root(prefix, roots)
    pivots = rows.groupBy("s").agg(F.min(F.struct(F.xxhash64("sig", F.lit(turn)).alias("o"), c("sig").alias("p"), c("n").alias("pn"), c("root").alias("pr"))).alias("p"), F.count(F.lit(1)).alias("k")).where("k > 1").select("s", "p.p", "p.pn", "p.pr")
    near = (c("root") != c("pr")) & (4 * F.least("n", "pn") >= 3 * F.greatest("n", "pn"))
    return rows.join(pivots, "s").where(near).select(c("sig").alias("a"), c("p").alias("b"), c("root").alias("ar"), c("pr").alias("br")).distinct()


def _open_rows(prefix: DataFrame, roots: DataFrame) -> DataFrame:
    """The prefix entries of columns whose rows are in more than one component, with the number of rows in the column."""
    rows = _with_root(prefix, roots)
    columns = rows.groupBy("s").agg(F.count(F.lit(1)).alias("held"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    return rows.join(columns.where("lo < hi").select("s", "held"), "s")


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of rows in different components that meet within the size and position bounds.

    At the first column that two linked rows share, the smaller row is within ``n - ceil(6 n / 7)`` of its order, and what
    is left of both orders still suffices for the overlap of ``ceil(3 (n + m) / 7)`` that the pair needs."""
    small = rows.where(c("f") <= c("n") - F.ceil(c("n") * 6 / 7)).select("s", c("sig").alias("a"), c("n").alias("an"), c("f").alias("af"), c("root").alias("ar"))
    large = rows.select("s", c("sig").alias("b"), c("n").alias("bn"), c("f").alias("bf"), c("root").alias("br"))
    meet = (
        (small["s"] == large["s"]) & (c("ar") != c("br")) & ((c("an") < c("bn")) | ((c("an") == c("bn")) & (c("a") < c("b"))))
        & (4 * c("an") >= 3 * c("bn"))
        & (7 * F.least(c("an") - c("af"), c("bn") - c("bf")) >= 3 * (c("an") + c("bn")))
    )
    return small.join(large, meet).select("a", "b", "ar", "br").distinct()


def _in_blocks(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """(sig, root, family, p, q): the cells of the blocked product that each row of a dense column goes to.

    A family holds all rows that chains of dense columns tie together, so two rows of one dense column meet in one cell
    at least. Blocks ``0 .. r - 1`` hold the rows outside the family's largest component and meet every block; blocks from
    ``r`` on hold the largest component and meet the first ones only."""
    tied = components(rows.select("sig", "s"), "sig", "s").withColumnRenamed("node", "sig").withColumnRenamed("root", "family")
    members = scratch.keep(rows.select("sig", "n", "root").distinct().join(tied, "sig"), "jaccard-family")
    parts = members.groupBy("family", "root").agg(F.sum("n").alias("entries"))
    families = parts.groupBy("family").agg(F.max(F.struct("entries", "root")).alias("top"), F.sum("entries").alias("entries"), F.count(F.lit(1)).alias("parts"))
    families = families.where("parts > 1").select(
        "family", c("top.root").alias("top"),
        F.ceil((c("entries") - c("top.entries")) / ROW_BLOCK).cast("int").alias("r"),
        F.ceil(c("top.entries") / ROW_BLOCK).cast("int").alias("t"))
    code, in_top = F.xxhash64("sig", F.lit("block")), c("root") == c("top")
    block = F.when(in_top, c("r") + F.pmod(code, c("t"))).otherwise(F.pmod(code, c("r"))).cast("int")
    last = F.when(in_top, c("r")).otherwise(c("r") + c("t")) - 1
    dealt = members.join(families, "family").withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select("sig", "root", "family", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), "i")


def _blocked_product(dealt: DataFrame, whole: DataFrame) -> DataFrame:
    """The links between components in all cells, a spanning set of each cell's."""
    return dealt.join(whole, "sig").groupBy("family", "p", "q").applyInPandas(
        _cell_links, "a long, b long, ar long, br long, overlap int")


def _cell_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one cell: links between different components, without those that earlier ones of the cell already imply."""
    rows = rows.sort_values("sig", ignore_index=True)
    sigs, size, roots = (rows[k].to_numpy(np.int64) for k in ("sig", "n", "root"))
    places, at = np.unique(roots, return_inverse=True)
    group = np.arange(len(places))
    left = np.flatnonzero(rows["i"] == rows["p"].iloc[0])
    keys = np.concatenate([np.asarray(v, np.int64) for v in rows["shingles"]])
    owners = np.repeat(np.arange(len(rows)), size)
    order = np.argsort(keys, kind="stable")
    _, column, held = np.unique(keys, return_inverse=True, return_counts=True)
    listed, start = owners[order], np.r_[0, np.cumsum(held)]
    first = np.r_[0, np.cumsum(size)]
    out = []
    for a in left:
        mine = column[first[a]:first[a + 1]]
        mine = mine[held[mine] > 1]
        if not len(mine):
            continue
        overlap = np.zeros(len(rows), np.int64)
        for k in mine:
            overlap[listed[start[k]:start[k + 1]]] += 1  # a row holds a column once
        near = 100 * overlap >= 75 * (size[a] + size - overlap)
        for b in np.flatnonzero(near & (group[at] != group[at[a]])):
            if group[at[a]] != group[at[b]]:
                out.append((sigs[a], sigs[b], roots[a], roots[b], overlap[b]))
                group[group == group[at[b]]] = group[at[a]]
    return pd.DataFrame(out, columns=["a", "b", "ar", "br", "overlap"])


def _multiplied(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs whose overlap reaches 75 of 100 parts of the union, by their whole rows."""
    left = whole.select(c("sig").alias("a"), c("n").alias("an"), c("shingles").alias("at"))
    right = whole.select(c("sig").alias("b"), c("n").alias("bn"), c("shingles").alias("bt"))
    both = pairs.join(left, "a").join(right, "b").withColumn("overlap", F.size(F.array_intersect("at", "bt")))
    return both.where(100 * c("overlap") >= 75 * (c("an") + c("bn") - c("overlap"))).select("a", "b", "ar", "br", "overlap")


def with_set_names(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column that has the sig of each row's shingle set, as in ``members``; null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (W.shingle_set((text or b"").lower().split(), SHINGLE) for text in W.texts_of(batch))
            sigs = pa.array([W.signature(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sigs], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id that links reach, itself included.

    A document without words links with nothing and is its own component. A null doc_id stays null; a component that
    consists of such rows only has a null id."""
    members, roots = jaccard_links(docs)
    named = members.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = named.where("sig is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "root", "left")
    return out.select("doc_id", "n_shingles", F.when(c("sig").isNull(), c("doc_id")).otherwise(c("least")).alias("component_id"))
