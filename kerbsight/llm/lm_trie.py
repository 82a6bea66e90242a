"""LM scoring with sharded Elias-Fano n-gram tries.

The model is an interpolated word-pair model. With ``c`` for counts in the training tokens, ``N`` tokens and ``V`` distinct ones,

    p(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w | v) = (c(v w) + m(v) p(w)) / (c(v) + m(v)),   m(v) = KAPPA * max(c(v), 1) ** THETA

As THETA is below one, the weight c(v) / (c(v) + m(v)) of what followed ``v`` grows with how often ``v`` was seen: 0.25 for a word seen
once, 0.57 after a hundred times, 0.84 after ten thousand. m stands for the number of different followers, which grows by such a power.
So a text's log probability is a sum of three kinds of terms: ``log p(w)`` and, for a token that is followed by another,
``log m / (c + m)``, which only need the token's own count, and ``log (1 + c(v w) / (m(v) p(w)))`` for pairs that training has
seen, which needs the pair and the count of ``v``. All but the last can be found where all occurrences of ``w`` are.

The counts of the ``FREQUENT`` most frequent tokens are sent to all tasks. For every other ``v`` the training pairs ask for its
count: (``v``, shard of the pair) is joined with the table of counts, and the answers go to the shards; no answer means 1.

Then one shuffle does it: every token of every document, training or not, goes with its predecessor to a shard of its word.
Words with more tokens than a quarter of a shard are spread over several by predecessor; they are frequent, so their exact
counts are known beforehand. A shard builds its trie from the training tokens and answers the queries of all tokens.

A trie is suffix-ordered: first level words, second level the predecessors of each word. Words and predecessors are
Elias-Fano sequences; so are the pointers from a word to its range of the second level, and the second level itself, whose
entries are predecessors' places in the shard's list plus an offset for each word (so every range is a monotone run). A
lookup is a successor search inside the word's range. Log probabilities are quantised to 16 bits. The levels are files that
the task maps into memory, and deletes when it is done.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from pathlib import Path
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.llm import words as W
from kerbsight.llm.store import Scratch

c = F.col
FOLDS, HELD_OUT = 5, 1
KAPPA, THETA, FREQUENT = 3.0, 0.8, 1 << 16
CHUNK, SHARD = 800_000, 1_500_000
END, START = np.uint64(1), np.uint64(2)
_RESULT = "chunk long, docs binary, base binary, score binary, known binary, meta binary"


# ---------------------------------------------------------------- Elias-Fano sequences

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NTH = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    _ones = [i for i in range(8) if _b >> i & 1]
    _NTH[_b, : len(_ones)] = _ones


class EliasFano:
    """A non-decreasing sequence: low bits packed, high parts in unary, with a count of zeros before each 64-bit word.

    The three arrays are written to files and mapped."""

    def __init__(self, values: np.ndarray, universe: int, folder: Path, name: str):
        self.n = len(values)
        self.width = max(0, (max(1, universe) // max(1, self.n)).bit_length() - 1)
        values = values.astype(np.uint64)
        wide = np.uint64(self.width)
        low = values & np.uint64((1 << self.width) - 1)
        high = (values >> wide).astype(np.int64)
        self.tops = (universe >> self.width) + 1
        bits = np.zeros((self.n + self.tops + 63) // 64 * 64 + 64, np.uint8)
        bits[high + np.arange(self.n)] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        zeros = 64 - _POP[words.view(np.uint8).reshape(-1, 8)].sum(1, dtype=np.int64)
        packed = np.packbits(((low[:, None] >> np.arange(self.width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        self.low = _mapped(np.concatenate([packed, np.zeros(8, np.uint8)]), folder / f"{name}.low")
        self.high = _mapped(words, folder / f"{name}.high")
        self.zeros = _mapped(np.cumsum(zeros) - zeros, folder / f"{name}.zeros")

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.uint64)
        bit = at * self.width
        eight = np.ndarray((len(self.low) - 7,), "<u8", buffer=self.low, strides=(1,))[bit >> 3]
        return (eight >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """The place of zero number k in the unary part."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        rest = k - self.zeros[word]
        left = (~self.high[word]).view(np.uint8).reshape(-1, 8)
        counts = np.cumsum(_POP[left], axis=1, dtype=np.int64)
        byte = (counts <= rest[:, None]).sum(1)
        row = np.arange(len(k))
        rest = rest - np.where(byte > 0, counts[row, np.maximum(byte - 1, 0)], 0)
        return word * 64 + byte * 8 + _NTH[left[row, byte], rest]

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found): the place of the first element that is not less, and whether it equals the wanted value."""
        if not self.n:
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        wanted = wanted.astype(np.uint64)
        top = np.minimum((wanted >> np.uint64(self.width)).astype(np.int64), self.tops - 1)
        start = np.where(top > 0, self._zero(np.maximum(top - 1, 0)) - (top - 1), 0)
        end = self._zero(top) - top
        low = wanted & np.uint64((1 << self.width) - 1)
        first, last = start, end.copy()
        while (open_ := first < last).any():
            middle = (first + last) // 2
            less = open_ & (self._lows(np.minimum(middle, self.n - 1)) < low)
            first = np.where(less, middle + 1, first)
            last = np.where(open_ & ~less, middle, last)
        inside = first < end
        return first, inside & (self._lows(np.minimum(first, self.n - 1)) == low)

    def at(self, place: np.ndarray) -> np.ndarray:
        """The elements at some places, by their rank in the unary part."""
        ones = np.arange(len(self.high), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(ones, place, "right") - 1
        rest = place - ones[word]
        left = np.ascontiguousarray(self.high[word]).view(np.uint8).reshape(-1, 8)
        counts = np.cumsum(_POP[left], axis=1, dtype=np.int64)
        byte = (counts <= rest[:, None]).sum(1)
        row = np.arange(len(place))
        rest = rest - np.where(byte > 0, counts[row, np.maximum(byte - 1, 0)], 0)
        top = word * 64 + byte * 8 + _NTH[left[row, byte], rest] - place
        return (top.astype(np.uint64) << np.uint64(self.width)) | self._lows(place)


def _mapped(array: np.ndarray, path: Path) -> np.ndarray:
    array.tofile(path)
    return np.memmap(path, array.dtype, "r") if len(array) else array


class Trie:
    """Words, their predecessors and the quantised gains of the pairs, of one shard."""

    def __init__(self, words: np.ndarray, before: np.ndarray, gains: np.ndarray, folder: Path):
        """Sorted distinct pairs (word, predecessor) with their gain."""
        first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.empty(0, np.int64)
        named = np.unique(before)
        self.span = max(1, len(named))
        parent = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(words)]))
        self.words = EliasFano(words[first], 1 << 48, folder, "words")
        self.before = EliasFano(named, 1 << 40, folder, "before")
        self.pointers = EliasFano(np.r_[first, len(words)], len(words), folder, "pointers")
        self.pairs = EliasFano(parent * self.span + np.searchsorted(named, before), max(1, len(first)) * self.span, folder, "pairs")
        self.step = max(1.0, gains.max(initial=0.0)) / 65535  # no gain is cut
        self.gains = _mapped(np.round(gains / self.step).astype("<u2"), folder / "gains")

    def gain(self, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The gain of each pair; 0 for pairs that training has not seen."""
        parent, known = self.words.successor(words)
        place, named = self.before.successor(before)
        out = np.zeros(len(words))
        ask = np.flatnonzero(known & named)
        if len(ask):
            at, found = self.pairs.successor(parent[ask] * self.span + place[ask])
            found &= at < self.pointers.at(parent[ask] + 1).astype(np.int64)
            out[ask[found]] = self.gains[at[found]] * self.step
        return out


# ---------------------------------------------------------------- counting, routing, scoring


def fold_of(doc_id: int | None) -> int | None:
    return None if doc_id is None else crc32(str(doc_id).encode()) % FOLDS


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), W.texts_of(batch), strict=True):
            yield doc, fold_of(doc) != HELD_OUT, np.r_[W.word_codes((text or b"").lower().split()), END]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the training tokens, summed over a chunk."""
    for held in W.in_chunks((d for d in _documents(batches) if d[1]), lambda d: len(d[2]), 4 * CHUNK):
        codes, n = np.unique(np.concatenate([d[2] for d in held]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))], names=["w", "n"])


class Known:
    """What is known before routing: N, V, documents, the frequent tokens with their counts."""

    def __init__(self, tokens: int, distinct: int, texts: int, codes: np.ndarray, counts: np.ndarray):
        self.tokens, self.distinct, self.texts = tokens, distinct, texts
        self.shards = max(64, tokens // SHARD)
        wide = counts > SHARD // 4
        at = np.argsort(codes[wide])
        self.wide, self.spread = codes[wide][at], -(-counts[wide][at] // (SHARD // 4))
        self.wide_counts = counts[wide][at]
        before, of = _before(np.r_[codes, START]), np.r_[counts, texts]
        at = np.argsort(before)
        self.before, self.before_counts = before[at], of[at]

    def p(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def prior(self, count):
        """m(v) for a count of v."""
        return KAPPA * np.maximum(count, 1) ** THETA

    def before_count(self, before: np.ndarray) -> np.ndarray:
        """The counts of predecessors, 0 for those that are not frequent."""
        return _looked_up(self.before, self.before_counts, before)

    def shard(self, w: np.ndarray, before: np.ndarray) -> np.ndarray:
        spread = np.maximum(1, _looked_up(self.wide, self.spread, w)).astype(np.uint64)
        return (W.mixed(w + before % spread) % np.uint64(self.shards)).astype(np.int32)


def _looked_up(names: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted name, 0 where it is not there."""
    if not len(names):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return np.where(names[at] == wanted, values[at], 0)


def _before(codes: np.ndarray) -> np.ndarray:
    return W.mixed(codes) >> np.uint64(24)


def _name(codes: np.ndarray) -> np.ndarray:
    return W.mixed(codes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(16)


def _pairs(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of some documents, the codes of their predecessors, and the documents' sizes."""
    sizes = np.array([len(d[2]) for d in held])
    w = np.concatenate([d[2] for d in held])
    v = np.r_[START, w[:-1]]
    v[np.r_[0, np.cumsum(sizes)[:-1]]] = START
    return w, _before(v), sizes


def _packed(before: np.ndarray) -> tuple[bytes, bytes]:
    return (before >> np.uint64(8)).astype("<u4").tobytes(), (before & np.uint64(255)).astype(np.uint8).tobytes()


def _unpacked(high: bytes, low: bytes) -> np.ndarray:
    return (np.frombuffer(high, "<u4").astype(np.uint64) << np.uint64(8)) | np.frombuffer(low, np.uint8)


def _asked(known: Known):
    """Per chunk: the predecessors of training tokens that are not among the frequent ones, with the shards that need their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in W.in_chunks((d for d in _documents(batches) if d[1]), lambda d: len(d[2]), CHUNK):
            w, before, _ = _pairs(held)
            rare = known.before_count(before) == 0
            before, shard = before[rare], known.shard(w[rare], before[rare])
            order = np.lexsort((shard, before))
            before, shard = before[order], shard[order]
            new = np.r_[True, (before[1:] != before[:-1]) | (shard[1:] != shard[:-1])][: len(before)]
            yield pa.RecordBatch.from_arrays([pa.array(before[new].view(np.int64)), pa.array(shard[new])], names=["before", "shard"])

    return run


def _rare_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        before = _before(batch.column("w").to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(before.view(np.int64)), batch.column("n")], names=["before", "n"])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk and shard: predecessors and their counts, packed."""
    names = ["shard", "runs", "before_high", "before_low"]
    for held in W.in_chunks(batches, len, CHUNK):
        shard, before, n = (np.concatenate([b.column(x).to_numpy() for b in held]) for x in ("shard", "before", "n"))
        order = np.argsort(shard, kind="stable")
        shard, before, n = shard[order], before[order].view(np.uint64), n[order].astype("<u4")
        cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]][: len(shard)])
        rows = [(int(shard[a]), n[a:b].tobytes(), *_packed(before[a:b])) for a, b in zip(cuts, np.r_[cuts[1:], len(shard)], strict=True)] if len(shard) else []
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(x, pa.binary()) for x in columns[1:])], names=names)


def _routed(known: Known):
    """Per chunk and shard: the tokens with their predecessors and documents. The first row of a chunk has its documents."""
    kinds = [("shard", pa.int32()), ("chunk", pa.int64()), ("train", pa.binary()), ("words", pa.binary()), ("runs", pa.binary()), ("before_high", pa.binary()), ("before_low", pa.binary()), ("docs", pa.binary()), ("meta", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, held in enumerate(W.in_chunks(_documents(batches), lambda d: max(17, len(d[2])), CHUNK)):
            w, before, sizes = _pairs(held)
            doc = np.repeat(np.arange(len(held), dtype=np.uint16), sizes)
            shard = known.shard(w, before)
            order = np.lexsort((w, shard))
            w, before, doc, shard = w[order], before[order], doc[order], shard[order]
            ids = [d[0] for d in held]
            meta = np.array([(i or 0, i is None, not d[1], n) for i, d, n in zip(ids, held, sizes, strict=True)], "<i8").tobytes()
            train = np.packbits([d[1] for d in held]).tobytes()
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            rows = []
            for a, b in zip(cuts, np.r_[cuts[1:], len(w)], strict=True):
                new = np.flatnonzero(np.r_[True, w[a + 1 : b] != w[a : b - 1]])
                named = _name(w[a:b][new])
                rows.append((
                    int(shard[a]), (part << 32) | k, train, named.tobytes(), np.diff(np.r_[new, b - a]).astype("<u4").tobytes(),
                    *_packed(before[a:b]), doc[a:b].tobytes(), meta if not rows else None))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])

    return run, "shard int, chunk long, train binary, words binary, runs binary, before_high binary, before_low binary, docs binary, meta binary"


def _scored(known: Known):
    """One shard: build its trie from the training tokens, answer all tokens, sum by chunk and document.

    Rows without words are the counts of predecessors that are not frequent."""
    wide_names = _name(known.wide)
    at = np.argsort(wide_names)
    wide_names, wide_counts = wide_names[at], known.wide_counts[at]
    end_name = _name(np.array([END]))[0]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        told = rows["words"].isna()
        context = np.concatenate([np.empty(0, np.uint64), *map(_unpacked, rows["before_high"][told], rows["before_low"][told])])
        context_count = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(n, "<u4").astype(np.int64) for n in rows["runs"][told])])
        order = np.lexsort((-context_count, context))
        context, context_count = context[order], context_count[order]
        new = np.r_[True, context[1:] != context[:-1]][: len(context)]
        context, context_count = context[new], context_count[new]
        rows.drop(index=rows.index[told], inplace=True)
        w = np.concatenate([np.repeat(np.frombuffer(x, "<u8"), np.frombuffer(r, "<u4")) for x, r in zip(rows["words"], rows["runs"], strict=True)])
        v = np.concatenate([*map(_unpacked, rows["before_high"], rows["before_low"])])
        docs = [np.frombuffer(d, "<u2") for d in rows["docs"]]
        train = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8))[d].astype(bool) for t, d in zip(rows["train"], docs, strict=True)])
        order = np.lexsort((v, w))
        w, v, train = w[order], v[order], train[order]
        kept = rows[["chunk", "meta"]].copy()
        rows.drop(columns=list(rows.columns), inplace=True)  # the arrays hold them now
        new_word = np.r_[True, w[1:] != w[:-1]]
        new_pair = new_word | np.r_[True, v[1:] != v[:-1]]
        words, pairs = np.flatnonzero(new_word), np.flatnonzero(new_pair)
        count = np.add.reduceat(train.astype(np.int64), words)
        more = _looked_up(wide_names, wide_counts, w[words])
        count = np.where(more > 0, more, count)
        seen = np.add.reduceat(train.astype(np.int64), pairs)
        p = known.p(count)
        word_of = np.cumsum(new_word) - 1
        pair_p = p[word_of[pairs]]
        before_count = known.before_count(v[pairs])
        before_count = np.where(before_count > 0, before_count, _looked_up(context, context_count, v[pairs]))
        gains = np.log10(1 + seen / (known.prior(before_count) * pair_p))
        with tempfile.TemporaryDirectory() as folder:
            held = seen > 0
            trie = Trie(w[pairs][held], v[pairs][held], gains[held], Path(folder))
            gain = trie.gain(w[pairs], v[pairs])
            del trie
        prior = known.prior(count)
        follows = np.where(w[words] == end_name, 0.0, np.log10(prior / (count + prior)))
        base = np.empty(len(w))
        score, is_known = np.empty(len(w)), np.empty(len(w), bool)
        base[order] = np.log10(p)[word_of]
        score[order] = (np.log10(p) + follows)[word_of] + gain[np.cumsum(new_pair) - 1]
        is_known[order] = (count > 0)[word_of]
        out, a = [], 0
        for chunk, doc, meta in zip(kept["chunk"], docs, kept["meta"], strict=True):
            own = slice(a, a := a + len(doc))
            there, place = np.unique(doc, return_inverse=True)
            sums = [np.bincount(place, x[own], len(there)) for x in (base, score, is_known)]
            out.append((chunk, there.astype("<u2").tobytes(), sums[0].tobytes(), sums[1].tobytes(), sums[2].astype("<u4").tobytes(), meta))
        return pd.DataFrame(out, columns=["chunk", "docs", "base", "score", "known", "meta"])

    return run


def _summed(known: Known):
    """One chunk: the sums of all shards, by document."""
    prior = known.prior(known.texts)
    start = float(np.log10(prior / (known.texts + prior)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        meta = np.frombuffer(next(m for m in rows["meta"] if m is not None), "<i8").reshape(-1, 4)
        base, score, found = (np.zeros(len(meta)) for _ in range(3))
        for d, b, s, k in zip(rows["docs"], rows["base"], rows["score"], rows["known"], strict=True):
            at = np.frombuffer(d, "<u2")
            base[at] += np.frombuffer(b)
            score[at] += np.frombuffer(s)
            found[at] += np.frombuffer(k, "<u4")
        ids = pd.array(meta[:, 0], dtype="Int64")
        ids[meta[:, 1] == 1] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": meta[:, 2] == 1, "n_tokens": meta[:, 3], "n_known": found.astype(np.int64), "train_tokens": known.tokens,
            "base_score": base, "score": score + start})

    return run


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text).

    Training takes the rows whose crc32(doc_id as text) mod 5 is not 1, with a null doc_id too. Null and empty texts are the
    end token alone. base_score is exact; score has gains in steps of 1/65,535 of the largest one in a
    shard (0.0002 where that is 13). Repeated rows are documents of their own. Without
    training tokens every count is 0. Every predecessor has its exact count, however rare. An empty table gives an empty result."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text"))
    counted = docs.mapInArrow(_counts, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counted, seen = scratch.keep(counted, "lm-counts", tokens=F.coalesce(F.sum("n"), F.lit(0)), distinct=F.count(F.lit(1)))
    top = counted.orderBy(F.desc("n"), "w").limit(FREQUENT).toPandas()  # a fixed number of rows
    codes = top["w"].to_numpy(np.int64).view(np.uint64)
    counts = top["n"].to_numpy(np.int64)
    ends = counted.where(c("w") == int(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = Known(seen["tokens"], seen["distinct"], ends, codes, counts)
    run, schema = _routed(known)
    parts = docs.mapInArrow(run, schema)
    if known.distinct > len(codes):
        rare = counted.where("n > 1").mapInArrow(_rare_counts, "before long, n long")
        asked = docs.mapInArrow(_asked(known), "before long, shard int").join(rare, "before")
        answers = scratch.keep(asked.mapInArrow(_answered, "shard int, runs binary, before_high binary, before_low binary"), "lm-contexts")
        parts = parts.unionByName(answers.withColumn("chunk", F.lit(0).cast("long")), allowMissingColumns=True)
    scratch.drop(counted)
    parts = parts.groupBy("shard").applyInPandas(_scored(known), _RESULT)
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return parts.groupBy("chunk").applyInPandas(_summed(known), result)
