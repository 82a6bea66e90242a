"""Substring dedup by repeated-phrase automata.

A window is ``WINDOW`` successive words. Its *anchor* is the smallest code among its ``GRAM``-word runs, so equal windows have
equal anchors wherever they stand. Successive windows with one anchor make a stretch of text.

1. Anchors are counted over all documents (counts are pre-aggregated). A window that recurs has an anchor that recurs.
2. The stretches of recurring anchors go to shards by anchor, words and all. A shard confirms recurring passages by exact
   comparison of its windows, compiles the confirmed ones into an Aho-Corasick automaton over its words, and streams all its
   stretches through it to locate every occurrence. All occurrences of a window are in one shard.
3. Anchors with more than ``HOT`` stretches would make a shard too large. Every task runs the same search over its own chunk
   of them and locates what recurs there on the spot. Each other window of such a stretch is confirmed across chunks by its
   64-bit code, a row each; a window that a chunk has located is sent once, so a passage in a third of all documents costs
   one row for each chunk and window.
4. The located ranges go back to their documents, which drop the covered words.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import words as W
from kerbsight.llm.store import Scratch

c = F.col
WINDOW, GRAM = 35, 8
HOT, LONGEST = 256, 512
CHUNK_BYTES, SHARD_BYTES = 4 << 20, 1 << 20
_PARTS = "kind int, key long, doc long, start int, size int, text binary"


def stretches(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, first, last): runs of successive windows with one anchor, at most LONGEST windows each, in a text with the codes
    ``grams`` of its runs of GRAM words."""
    span = WINDOW - GRAM + 1
    if len(grams) < span:
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 2
    least, width = grams, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    least = np.minimum(least[: len(grams) - span + 1], least[rest : rest + len(grams) - span + 1])
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    size = np.diff(np.r_[first, len(least)])
    if size.max() > LONGEST:
        first = np.concatenate([np.arange(f, f + s, LONGEST) for f, s in zip(first, size, strict=True)])
    return least[first], first, np.r_[first[1:], len(least)] - 1


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each stretch of ``size`` windows; weight 2 if the anchor occurs more than once inside its document's windows there."""
    for batch in batches:
        keys, docs, starts, sizes, weights = [], [], [], [], []
        for doc, text in zip(batch.column("doc").to_pylist(), W.texts_of(batch), strict=True):
            words = (text or b"").split()
            if len(words) >= WINDOW:
                grams = W.run_codes(W.word_codes(words), GRAM)
                anchors, first, last = stretches(grams)
                own, count = np.unique(grams, return_counts=True)
                repeated = own[count > 1]
                keys.append(anchors.view(np.int64))
                docs.append(np.full(len(anchors), doc))
                starts.append(first)
                sizes.append(last - first + 1)
                weights.append(1 + np.isin(anchors, repeated))
        if keys:
            columns = [np.concatenate(keys), np.concatenate(docs), *[np.concatenate(x).astype(np.int32) for x in (starts, sizes, weights)]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "doc", "start", "size", "weight"])


def recurring(rows: list[list[bytes]]) -> list[list[int]]:
    """For each list of words the starts of its windows that start at two places or more.

    The recurring windows become one automaton over words; each distinct word is one letter of it."""
    letters: dict[bytes, str] = {}

    def letter(word: bytes) -> str:
        found = letters.get(word)
        if found is None:
            n = len(letters) + 1
            found = letters[word] = chr(n if n < 0xD800 else n + 0x800)  # not a surrogate
        return found

    lines = ["".join(map(letter, words)) for words in rows]
    count = Counter(line[i : i + WINDOW] for line in lines for i in range(len(line) - WINDOW + 1))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    confirmed = 0
    for phrase, times in count.items():
        if times > 1:
            automaton.add_word(phrase)
            confirmed += 1
    if not confirmed:
        return [[] for _ in rows]
    automaton.make_automaton()
    return [[end - WINDOW + 1 for end, _ in automaton.iter(line)] for line in lines]


def _ranges(starts: list[int]) -> list[tuple[int, int]]:
    """(first word, words) of the stretches that windows at ascending starts cover."""
    out: list[list[int]] = []
    for start in starts:
        if out and start <= out[-1][1]:
            out[-1][1] = start + WINDOW
        else:
            out.append([start, start + WINDOW])
    return [(a, b - a) for a, b in out]


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: stretches for the shards. Kind 1: ranges that this task has located. Kind 2: windows of hot anchors by code."""

    def held() -> Iterator[tuple]:
        for batch in batches:
            lists = [batch.column(name).to_pylist() for name in ("doc", "keys", "starts", "sizes", "hot")]
            for text, doc, *found in zip(W.texts_of(batch), *lists, strict=True):
                yield doc, (text or b"").split(), found, len(text or b"")

    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("text", pa.binary())])
    for chunk in W.in_chunks(held(), lambda d: d[3], CHUNK_BYTES):
        rows, hot_stretches = [], []
        for doc, words, stretches_there, _ in chunk:
            for key, s, size, many in zip(*stretches_there, strict=True):
                stretch = words[s : s + size - 1 + WINDOW]
                if len(stretch) < size - 1 + WINDOW:  # another row of the same key
                    continue
                if many:
                    hot_stretches.append((doc, s, stretch))
                else:
                    rows.append((0, key, doc, s, None, b" ".join(stretch)))
        found = recurring([w for _, _, w in hot_stretches])
        told: set[int] = set()
        for (doc, first, words), starts in zip(hot_stretches, found, strict=True):
            rows += [(1, None, doc, first + a, size, None) for a, size in _ranges(starts)]
            here = set(starts)
            for p, code in enumerate(W.run_codes(W.word_codes(words), WINDOW).view(np.int64).tolist()):
                if p not in here:
                    rows.append((2, code, doc, first + p, 1, None))
                elif code not in told:
                    told.add(code)
                    rows.append((2, code, None, None, 2, None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _located(rows: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one shard's stretches."""
    out = defaultdict(list)
    found = recurring([t.split() for t in rows["text"]])
    for doc, start, starts in zip(rows["doc"], rows["start"], found, strict=True):
        for a, size in _ranges(starts):
            out["doc"].append(doc)
            out["start"].append(start + a)
            out["size"].append(size)
    return pd.DataFrame({k: np.array(out[k], np.int64) for k in ("doc", "start", "size")})


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, removed, digests, texts = [], [], [], []
        for text, ranges in zip(W.texts_of(batch), batch.column("ranges").to_pylist(), strict=True):
            words = (text or b"").split()
            drop = np.zeros(len(words), bool)
            for r in ranges or ():
                drop[r["start"] : r["start"] + r["size"]] = True
            kept = b" ".join(w for w, d in zip(words, drop.tolist(), strict=True) if not d) if drop.any() else b" ".join(words)
            totals.append(len(words))
            removed.append(int(drop.sum()))
            digests.append(sha256(kept).hexdigest())
            texts.append(kept)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every row of ``docs`` (doc_id, text).

    A word goes if it lies in a window whose words also start anywhere else, in any row of ``docs``, its own included; ``kept`` has
    the others, joined by one space. Words are compared as they are. Null and empty texts have no words; texts of fewer than
    35 words lose none. Repeated rows repeat each other's windows. An empty table gives an empty result."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text"))
    docs = docs.withColumn("doc", F.xxhash64("doc_id", "text"))  # rows that share it by chance only share candidates
    anchors = scratch.keep(docs.select("doc", "text").mapInArrow(_anchors, "key long, doc long, start int, size int, weight int"), "phrase-anchors")
    recurs = anchors.groupBy("key").agg(F.sum("weight").alias("times")).where("times > 1")
    wanted = anchors.join(recurs, "key").groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", "size", "key", (c("times") > HOT).alias("hot")))).alias("at"))
    wanted = wanted.select("doc", *[c(f"at.{n}").alias(f"{n}s") for n in ("key", "start", "size")], c("at.hot").alias("hot"))
    parts = docs.select("doc", "text").join(wanted.hint("shuffle_hash"), "doc")
    parts, seen = scratch.keep(parts.mapInArrow(_sent, _PARTS), "phrase-stretches", bytes=F.coalesce(F.sum(F.octet_length("text")), F.lit(0)))
    scratch.drop(anchors)

    shards = max(64, seen["bytes"] // SHARD_BYTES)
    sent = parts.where("kind = 0").select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "doc", "start", "text")
    located = sent.groupBy("shard").applyInPandas(_located, "doc long, start long, size long")
    ready = parts.where("kind = 1").select("doc", c("start").cast("long"), c("size").cast("long"))
    single = parts.where("kind = 2")
    again = single.groupBy("key").agg(F.sum("size").alias("times")).where("times > 1")
    hot = single.where("doc is not null").join(again, "key").select("doc", c("start").cast("long"), F.lit(WINDOW).cast("long").alias("size"))
    ranges = located.unionByName(ready).unionByName(hot).groupBy("doc").agg(F.collect_set(F.struct("start", "size")).alias("ranges"))
    ranges = scratch.keep(ranges, "phrase-ranges")
    scratch.drop(parts)
    out = docs.join(ranges.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "ranges")
    return out.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
