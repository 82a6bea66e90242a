"""Token ids as canonical length-limited Huffman codes in independent blocks.

Documents are range-partitioned and sorted by doc_id, tokenised, and gathered into blocks of whole documents of about
``BLOCK`` ids; nothing is shuffled after that. Ids are counted over all blocks; the counts (one number for each id of the
vocabulary) give code lengths of at most ``LONGEST`` bits by package-merge, and the lengths give the canonical codes.

The file format is a folder of two Parquet tables. ``codes`` (id, length) holds the code. ``blocks`` has a row for each block:
part and block number (together they order the file), doc_ids and doc_sizes (little-endian int64 and int32 of its documents in
order; ``no_id`` has a byte for each, 1 where the id is null), bits (the codes, first bit highest) and steps (little-endian
uint16: the bits that each run of ``STEP`` ids takes; their running sums are the checkpoints). A block can be read without
any other. It is decoded by one table lookup for each id, for all runs between checkpoints at once.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from string import punctuation
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbsight.llm import words as W
from kerbsight.llm.store import Scratch, text_bytes

c = F.col
END_ID = 1
LONGEST, STEP = 16, 64
BLOCK, PART_BYTES = 1 << 16, 16 << 20
#: Words that a worker keeps with their ids, in each of two generations; half as many pieces. About 180 bytes each.
CACHED_WORDS = 800_000
#: Texts that are tokenised together, in bytes; blocks that are decoded together.
SLICE_BYTES, SIDE_BY_SIDE = 8 << 20, 16
#: New pieces that make a line for the tokenizer, and lines that it takes at once.
LINE, LINES = 64, 256
#: Words whose ids are put together at once.
RUN = 1 << 16
#: Fixed value: how the tokenizers whose ids are those of a text's words in turn cut a normalised text. No piece holds white space.
_CUT_AT_SPACES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = regex.compile(_CUT_AT_SPACES)
#: Characters that the tokenizer as a whole deals with: they compose, or lower-case to more than one.
_WIDE = re.compile("[İɐ-\U0010ffff]")
_BLOCK_ROWS = "part int, block int, no_id binary, doc_ids binary, doc_sizes binary, ids binary, symbols binary, counts binary"


class Recent:
    """What ``make`` gives for keys, kept for the keys used of late: at most twice ``most`` of them.

    A full generation becomes the old one; a key that is used again moves to the young one."""

    def __init__(self, make, most: int):
        self.make, self.most, self.young, self.old = make, most, {}, {}

    def __len__(self) -> int:
        return len(self.young)

    def of(self, keys: list) -> list:
        """The values of different keys; ``make`` gets all that are not kept at once."""
        found = list(map(self.young.get, keys))
        lacking = [i for i, f in enumerate(found) if f is None]
        asked = [keys[i] for i in lacking]
        kept = list(map(self.old.get, asked))
        new = [k for k, f in zip(asked, kept, strict=True) if f is None]
        if new:
            made = iter(self.make(new))
            kept = [next(made) if f is None else f for f in kept]
        for i, value in zip(lacking, kept, strict=True):
            found[i] = value
        size = max(1, self.most)
        for at in range(0, len(asked), size):
            more = asked[at : at + size]
            if len(self.young) + len(more) > size:
                self.old, self.young = self.young, {}
            self.young.update(zip(more, kept[at : at + size], strict=True))
        return found


class TextIds:
    """The ids of texts (bytes) as little-endian uint16.

    With a tokenizer that cuts at white space a text's ids are those of its words in turn. Arrow splits the texts and codes their
    words; each different word is looked up once for all texts given together. Words below U+0250 are cut here and their
    pieces go to the tokenizer's model; all others, and those that may hold a special token, go through the tokenizer as a whole.
    Both words and pieces are kept for a while, in bounded memory. Any other tokenizer takes whole texts."""

    def __init__(self, path: str, cached: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the file format holds ids below 65,536")
        self.by_words = cuts_at_spaces(json.loads(self.tokenizer.to_str()))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.by_pieces = Tokenizer(self.tokenizer.model)
        self.by_pieces.pre_tokenizer = CharDelimiterSplit(" ")
        self.is_last, suffix = np.zeros(1 << 16, bool), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.is_last[[i for token, i in self.tokenizer.get_vocab().items() if suffix and token.endswith(suffix)]] = True
        plain = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.words, self.pieces = Recent(self._words, cached), Recent(self._pieces, cached // 2)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """New pieces go to the model by the line; a token with the suffix of a word's end tells where each ends."""
        out = []
        letters = [p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        for at in range(0, len(letters), LINE * LINES):
            some = letters[at : at + LINE * LINES]
            lines = [" ".join(some[k : k + LINE]) for k in range(0, len(some), LINE)]
            ids = array("H")
            for made in self.by_pieces.encode_batch_fast(lines, add_special_tokens=False):
                ids.extend(made.ids)
            ends = 1 + np.flatnonzero(self.is_last[np.frombuffer(ids, np.uint16)])
            if len(ends) == len(some):
                ids, ends = ids.tobytes(), [0, *(2 * ends).tolist()]
                out.extend([ids[a:b] for a, b in zip(ends, ends[1:])])
            else:  # no suffix, or letters that the vocabulary lacks
                out.extend([array("H", [t.id for t in self.tokenizer.model.tokenize(p)]).tobytes() for p in some])
        return out

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Most new words are one piece of letters, or that and one of signs; the others are cut one by one."""
        text = b"\n".join(words).decode("utf-8", "replace")
        lower = text.lower().split("\n")
        letters = [t.rstrip(punctuation) for t in lower]
        signs = [t[len(x) :] for t, x in zip(lower, letters, strict=True)]
        whole = set()
        if "<|" in text or _WIDE.search(text):
            whole = {i for i, t in enumerate(text.split("\n")) if "<|" in t or _WIDE.search(t)}
        cut = {i: _PIECE.findall(lower[i]) for i, x in enumerate(letters) if not x.isalpha() and i not in whole}
        for i in (*whole, *cut):
            letters[i] = signs[i] = ""
        pieces = dict.fromkeys(letters) | dict.fromkeys(signs) | dict.fromkeys(p for c in cut.values() for p in c)
        pieces.pop("", None)
        ids = dict(zip(pieces, self.pieces.of(list(pieces)), strict=True)) | {"": b""}
        out = [ids[x] + ids[s] for x, s in zip(letters, signs, strict=True)]
        for i, c in cut.items():
            out[i] = b"".join([ids[p] for p in c])
        for i in whole:
            out[i] = self._encoded(words[i])
        return out

    def _encoded(self, text: bytes) -> bytes:
        return array("H", self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def of(self, text: bytes) -> bytes:
        return self.of_all(pa.array([text], pa.large_binary()))[0].tobytes()

    def of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, how many of them each text has); a null text has none."""
        if not self.by_words:
            ids = [self._encoded(t or b"") for t in texts.to_pylist()]
            return np.frombuffer(b"".join(ids), "<u2"), np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        split = pc.ascii_split_whitespace(texts.fill_null(b"").view(pa.large_string()))
        words = split.flatten().view(pa.large_binary()).dictionary_encode()
        different = pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary)
        found = self.words.of(pc.binary_join(different, pa.scalar(b"\n", pa.large_binary()))[0].as_py().split(b"\n"))
        table = np.frombuffer(b"".join(found), "<u2")
        word, size = words.indices.to_numpy(), np.fromiter(map(len, found), np.int32, len(found)) // 2
        begin, sizes = np.cumsum(size, dtype=np.int64) - size, size[word]
        ends = np.zeros(len(word) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        ids = np.empty(ends[-1], "<u2")
        for a in range(0, len(word), RUN):  # a long text needs no more room than its words and ids
            b = min(a + RUN, len(word))
            ids[ends[a] : ends[b]] = table[np.repeat(begin[word[a:b]] - ends[a:b], sizes[a:b]) + np.arange(ends[a], ends[b])]
        return ids, np.diff(ends[split.offsets.to_numpy() - split.offsets[0].as_py()])


def cuts_at_spaces(settings: dict) -> bool:
    """Whether a tokenizer's settings make the ids of a text those of its words in turn: lower-casing and composition, which do not
    reach across white space, pieces without any, no added token that does, and nothing put around a text."""
    normal = settings["normalizer"] or {}
    before = settings["pre_tokenizer"] or {}
    split, *rest = before.get("pretokenizers") or [{}]
    return (
        [n["type"] for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"} and normal["normalizers"][1]["content"] == " "
        and split.get("pattern") == {"Regex": _CUT_AT_SPACES} and split["behavior"] == "Removed" and split["invert"]
        and [(r["type"], r.get("add_prefix_space"), r.get("use_regex")) for r in rest] == [("ByteLevel", False, False)]
        and settings["post_processor"] is None and settings["truncation"] is None and settings["padding"] is None
        and not settings["model"].get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 or not t["content"].startswith("<|") for t in settings["added_tokens"]))


_OPEN: dict[tuple[str, int], TextIds] = {}


def _tokenised(path: str, cached: int):
    """Blocks of whole documents with their ids, in the order of the rows; then how often the task has met which id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        lookup = _OPEN.get((path, cached)) or _OPEN.setdefault((path, cached), TextIds(path, cached))
        names, kinds = ["part", "block", "no_id", "doc_ids", "doc_sizes", "ids", "symbols", "counts"], [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        total = np.zeros(1 << 16, np.int64)

        def documents():
            for batch in batches:
                docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary())
                for at, count in _slices(texts, SLICE_BYTES):
                    ids, sizes = lookup.of_all(texts.slice(at, count))
                    ends = np.cumsum(sizes)
                    ids = np.insert(ids, ends, END_ID)
                    ends += np.arange(1, count + 1)
                    for doc, size, end in zip(docs[at : at + count], (sizes + 1).tolist(), ends.tolist(), strict=True):
                        yield doc, ids[end - size : end]

        def row(*values):
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

        for k, held in enumerate(W.in_chunks(documents(), lambda d: len(d[1]), BLOCK)):
            ids = np.concatenate([i for _, i in held])
            total += np.bincount(ids, minlength=len(total))
            yield row(
                part, k, bytes(d is None for d, _ in held), np.array([d or 0 for d, _ in held], "<i8").tobytes(),
                np.array([len(i) for _, i in held], "<i4").tobytes(), ids.tobytes(), None, None)
        some = np.flatnonzero(total)
        yield row(part, None, None, None, None, None, some.astype("<u2").tobytes(), total[some].astype("<i8").tobytes())

    return run


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first, count) of runs of successive texts of about ``most`` bytes; one text alone may be longer."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, stop - at
        at = stop


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for ids, counts in zip(batch.column("symbols"), batch.column("counts"), strict=True):
            total[np.frombuffer(ids.as_buffer(), "<u2")] += np.frombuffer(counts.as_buffer(), "<i8")
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["id", "n"])


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits for positive counts, by package-merge.

    In every round the cheapest leaves and pairs of the round before are merged in order. Going back, the first 2n - 2 items
    of the last round are taken, then twice as many of each earlier round as pairs were; a leaf's length is the number of
    rounds in which it is taken."""
    n = len(counts)
    if n == 1:
        return np.ones(1, np.uint8)
    if n > 1 << longest:
        raise ValueError("more symbols than codes")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    items, rounds = leaves, []
    for _ in range(longest):
        if rounds:
            pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
            both = np.concatenate([leaves, pairs])
            place = np.argsort(both, kind="stable")
            items, is_leaf = both[place], place < n
        else:
            is_leaf = np.ones(n, bool)
        rounds.append(is_leaf)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(rounds):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


class Code:
    """The canonical code of (id, length) rows: codes count up by length, then id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        room = np.left_shift(1, LONGEST - lengths)
        first = np.r_[0, np.cumsum(room)[:-1]] if len(ids) else np.empty(0, np.int64)
        size = 1 + (int(ids.max()) if len(ids) else 0)
        self.aligned, self.length = np.zeros(size, np.uint16), np.zeros(size, np.uint8)
        self.aligned[ids], self.length[ids] = first, lengths
        self.found_at = np.ones(1 << LONGEST, np.uint32)  # id and length of the code that 16 bits begin with
        filled = int(room.sum())
        self.found_at[:filled] = np.repeat(ids << 8 | lengths, room)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(bits, steps) of the ids.

        Codes are joined in pairs and these in fours, which are shifted to their places in words of 64 bits."""
        padded = -len(ids) % STEP
        length = np.pad(self.length[ids], (0, padded))
        steps = length.reshape(-1, STEP).sum(1, dtype="<u2").tobytes()
        codes = np.pad(self.aligned[ids], (0, padded)).astype(np.uint32)
        pair = codes[::2] << 16 | codes[1::2] << 16 >> length[::2]
        length = length[::2] + length[1::2]
        four = pair.astype(np.uint64)
        four = four[::2] << 32 | four[1::2] << 32 >> length[::2]
        length = (length[::2] + length[1::2]).astype(np.int64)
        ends = np.cumsum(length)
        bits = int(ends[-1]) if len(ends) else 0
        at = ends - length
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        out = np.zeros(bits // 64 + 2, np.uint64)
        if len(four):
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[heads]] = np.bitwise_or.reduceat(four >> shift, heads)
            over = np.flatnonzero(ends > (word + 1) * 64)  # one at most for each border between words
            out[word[over] + 1] |= four[over] << (64 - shift[over])
        return out.astype(">u8").tobytes()[: (bits + 7) // 8], steps

    def decode(self, bits: bytes, steps: bytes, count: int) -> np.ndarray:
        """The ``count`` ids of a block."""
        return self.decode_all([bits], [steps], [count])

    def decode_all(self, bits: list[bytes], steps: list[bytes], counts: list[int]) -> np.ndarray:
        """The ids of blocks in turn, ``counts`` of each: one lookup for each id, all runs of all blocks side by side."""
        held = np.frombuffer(b"".join(bits) + b"\0\0\0", np.uint8).astype(np.uint32)
        three = (held[:-2] << 16) | (held[1:-1] << 8) | held[2:]
        at, begin = [], 0
        for b, s in zip(bits, steps, strict=True):
            taken = np.cumsum(np.frombuffer(s, "<u2"), dtype=np.int64)
            at.append(np.r_[0, taken[:-1]][: len(taken)] + begin * 8)
            begin += len(b)
        at = np.concatenate(at) if at else np.empty(0, np.int64)
        out = np.empty((STEP, len(at)), np.uint16)
        last = len(three) - 1
        for k in range(STEP):
            peek = (three[np.minimum(at >> 3, last)] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
            found = self.found_at[peek]
            out[k] = found >> 8
            at += found & 0xFF
        ids = out.T.reshape(-1)
        ends = np.cumsum([len(s) // 2 * STEP for s in steps])
        return np.concatenate([ids[e - len(s) // 2 * STEP :][:n] for s, n, e in zip(steps, counts, ends, strict=True)]) if len(ends) else ids


def write_ids(docs: DataFrame, tokenizer: str, folder: str, cached: int = CACHED_WORDS) -> None:
    """Tokenise every text of ``docs`` (doc_id, text) with the tokenizer file and write the two tables below ``folder``.

    Documents are in ascending order of doc_id (null first, then by a code of the text, so that an id with many rows is no single
    task); each ends with id 1. Null and empty texts have that id only. ``cached`` bounds what a worker keeps of its words; it
    changes no result. A vocabulary of more than 65,536 ids is refused. An empty table writes empty tables."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").cast("string").alias("text"))
    parts = 1 + text_bytes(docs) // PART_BYTES
    docs = docs.withColumn("code", F.xxhash64("text"))
    ordered = docs.repartitionByRange(parts, "doc_id", "code").sortWithinPartitions("doc_id", "code").drop("code")
    ids = scratch.keep(ordered.mapInArrow(_tokenised(tokenizer, cached), _BLOCK_ROWS), "huffman-ids", codec="zstd")
    counts = ids.select("symbols", "counts").where("counts is not null").mapInArrow(_counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    symbols, n = np.array([r["id"] for r in counts], np.int64), np.array([r["n"] for r in counts], np.int64)
    lengths = code_lengths(n) if len(n) else np.empty(0, np.uint8)
    rows = pd.DataFrame({"id": symbols.astype(np.int32), "length": lengths.astype(np.int32)})
    docs.sparkSession.createDataFrame(rows, "id int, length int").coalesce(1).write.parquet(f"{folder}/codes")
    code = Code(symbols, lengths)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [code.encode(np.frombuffer(i.as_buffer(), "<u2")) for i in batch.column("ids")]
            columns = [batch.column(k) for k in ("part", "block", "no_id", "doc_ids", "doc_sizes")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.binary())],
                names=["part", "block", "no_id", "doc_ids", "doc_sizes", "bits", "steps"])

    schema = "part int, block int, no_id binary, doc_ids binary, doc_sizes binary, bits binary, steps binary"
    blocks = ids.where("block is not null").drop("symbols", "counts")
    blocks.mapInArrow(encoded, schema).write.option("compression", "none").parquet(f"{folder}/blocks")
    scratch.drop(ids)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(part, block, place, doc_id, ids): every document's ids as an array, decoded block by block."""
    def arrays(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int32)))

    return _documents(spark, folder, "ids array<int>", arrays)


def _documents(spark: SparkSession, folder: str, column: str, made) -> DataFrame:
    """``made`` gives the column from the ids of some documents in turn and their ends."""
    rows = spark.read.parquet(f"{folder}/codes").collect()  # at most one row for each id of the vocabulary
    code = Code(np.array([r["id"] for r in rows], np.int64), np.array([r["length"] for r in rows], np.int64))
    names = ["part", "block", "place", "doc_id", "n_tokens", column.split()[0]]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SIDE_BY_SIDE):
                b = batch.slice(at, SIDE_BY_SIDE).to_pydict()
                sizes = [np.frombuffer(s, "<i4") for s in b["doc_sizes"]]
                docs, size = [len(s) for s in sizes], np.concatenate(sizes).astype(np.int64)
                ids = code.decode_all(b["bits"], b["steps"], [int(s.sum()) for s in sizes])
                no_id = np.frombuffer(b"".join(b["no_id"]), np.uint8) == 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(b["part"], docs), pa.int32()), pa.array(np.repeat(b["block"], docs), pa.int32()),
                    pa.array(np.concatenate([np.arange(d) for d in docs]), pa.int64()),
                    pa.array(np.frombuffer(b"".join(b["doc_ids"]), "<i8"), pa.int64(), mask=no_id),
                    pa.array(size), made(ids, np.cumsum(size))], names=names)

    blocks = spark.read.parquet(f"{folder}/blocks")
    return blocks.mapInArrow(decoded, f"part int, block int, place long, doc_id long, n_tokens long, {column}")


def id_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a written folder, from its decoded ids."""
    def digests(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        wide = memoryview(ids.astype("<u4").tobytes())
        at = [0, *(4 * ends).tolist()]
        return pa.array([crc32(wide[a:b]) for a, b in zip(at, at[1:])], pa.int64())

    docs = _documents(spark, folder, "ids_crc32 long", digests)
    docs = Scratch(spark).keep(docs, "huffman-digests")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    parts = docs.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("part_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("part").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
    return docs.select("doc_id", (c("part_start") + c("inside")).alias("start"), "n_tokens", "ids_crc32")
