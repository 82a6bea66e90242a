"""Conversation structure repair: the cheapest edits that make a conversation's roles regular, with their audit.

Rows are ordered and cut into sections of bounded length, whatever the length of a conversation. In a section, for each state that it
may be entered in, a dynamic programme over the rows finds the cheapest edits that lead to each state. Audits are persistent: a node
holds one edit and shares its prefix with others. Nodes carry a rolling hash of their prefix and their ancestors at distances
1, 2, 4, ..., so that the longest common prefix of two audits of equal cost is found in logarithmic steps; it is verified by walking
down to the node that both share, so a collision of hashes changes nothing. Sections are then joined in order by the same means, with a
section's audit as one edit.

Texts take no part in that. They are joined to the rows that stay, by the MD5 codes of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kerbsight.llm.store import Scratch

c = F.col


@dataclass(frozen=True)
class Rules:
    """Costs of the edits, and of leaving a truncated turn; rows of a section."""

    delete: int = 2
    insert: int = 5
    rerole: int = 1
    truncated: int = 5
    section: int = 512


RULES = Rules()
_SPACES = " \t\n\x0b\f\r"
_PRIME, _BASE = (1 << 61) - 1, 1_000_003
#: states by what came last: nothing, a system turn, a user turn, an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_LEGAL = {"su", "ua", "au"}


# ---------------------------------------------------------------------------------- persistent audits
class Audits:
    """Linked nodes; node 0 is the empty audit. A node's piece is one edit, or all the edits of a section."""

    def __init__(self) -> None:
        self.pieces, self.depths, self.hashes, self.ups = [""], [0], [0], [()]

    def add(self, parent: int, piece: str) -> int:
        ups = [parent]
        while len(self.ups[ups[-1]]) >= len(ups):
            ups.append(self.ups[ups[-1]][len(ups) - 1])
        code = ord(piece) if len(piece) == 1 else hash(piece) % _PRIME
        self.pieces.append(piece)
        self.depths.append(self.depths[parent] + 1)
        self.hashes.append((self.hashes[parent] * _BASE + code + 1) % _PRIME)
        self.ups.append(tuple(ups))
        return len(self.pieces) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while (above := self.depths[node] - depth) > 0:
            node = self.ups[node][above.bit_length() - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the audit at ``a`` comes before that at ``b`` in ASCII order."""
        depth = min(self.depths[a], self.depths[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hashes[x] == self.hashes[y] and self._same(x, y):
            return self.text(a, x) < self.text(b, y)
        for k in range(len(self.ups[x]) - 1, -1, -1):
            if k < len(self.ups[x]) and self.hashes[self.ups[x][k]] != self.hashes[self.ups[y][k]]:
                x, y = self.ups[x][k], self.ups[y][k]
        x, y = self._first_difference(x, y)
        p, q = self.pieces[x], self.pieces[y]
        if p.startswith(q) or q.startswith(p):
            p, q = p + self.text(a, x), q + self.text(b, y)
        return p < q

    def _same(self, x: int, y: int) -> bool:
        while x != y:
            if self.pieces[x] != self.pieces[y]:
                return False
            x, y = self.ups[x][0], self.ups[y][0]
        return True

    def _first_difference(self, x: int, y: int) -> tuple[int, int]:
        """The nodes of the first pieces that differ; those found by hashes, unless the walk finds earlier ones."""
        first = x, y
        while x != y:
            if self.pieces[x] != self.pieces[y]:
                first = x, y
            x, y = self.ups[x][0], self.ups[y][0]
        return first

    def text(self, node: int, above: int = 0) -> str:
        """The pieces from below ``above`` to ``node``."""
        out = []
        while node != above:
            out.append(self.pieces[node])
            node = self.ups[node][0]
        return "".join(reversed(out))


Table = list[tuple[int, int] | None]


def _offer(audits: Audits, table: Table, state: int, cost: int, parent: int, piece: str) -> bool:
    """Whether the state's audit is now this one: it costs less, or as much and comes first."""
    held = table[state]
    if held and cost > held[0]:
        return False
    node = audits.add(parent, piece)
    if held and cost == held[0] and not audits.less(node, held[1]):
        return False
    table[state] = cost, node
    return True


def inserted(audits: Audits, table: Table, rules: Rules) -> Table:
    """``table`` with the turns that may be inserted here; a second of the same kind never pays."""
    for state in (START, SYSTEM, ASSISTANT):
        if table[state]:
            _offer(audits, table, USER, table[state][0] + rules.insert, table[state][1], "I")
    if table[USER]:
        _offer(audits, table, ASSISTANT, table[USER][0] + rules.insert, table[USER][1], "I")
    return table


def stepped(audits: Audits, table: Table, initial: str, must: bool, truncated: bool, rules: Rules) -> Table:
    """The table after one row, and after what may be inserted behind it."""
    out: Table = [None] * 4
    ways, more = _AFTER.get(initial, {}), rules.truncated if truncated else 0
    for state, held in enumerate(table):
        if held is None:
            continue
        cost, node = held
        _offer(audits, out, state, cost + rules.delete, node, "D")
        if not must:
            if state in ways:
                _offer(audits, out, ways[state], cost + more, node, "K")
            _offer(audits, out, ASSISTANT if state == USER else USER, cost + rules.rerole + more, node, "R")
    return inserted(audits, out, rules)


def begun(audits: Audits, rules: Rules) -> Table:
    return inserted(audits, [(0, 0), None, None, None], rules)


# ---------------------------------------------------------------------------------------- damage
def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after damage, by the CRC-32 of ``conv_id:turn``; nulls count as one space."""
    ids = turns.select(
        c("conv_id").cast("long").alias("conv_id"), c("turn").cast("long").alias("turn"),
        *(F.coalesce(c(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")))
    conv, turn = (F.coalesce(c(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    what = F.crc32(key.cast("binary")) % 20
    text = F.when(what == 1, F.lit("")).when(what == 2, F.translate("text", ".!?", "")).otherwise(c("text"))
    return ids.where(what != 0).select(
        "conv_id", "turn", F.when(what == 4, F.lit("user")).otherwise(c("role")).alias("role"), text.alias("text"),
        F.when(what == 3, 2).otherwise(1).cast("long").alias("copies"))


def _code(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*(x for p in parts for x in (F.octet_length(p).cast("string"), F.lit(":"), p))).cast("binary")))


def _faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, code, copies, blank, truncated, first), a row for all equal rows; no texts.

    first: no earlier row of the conversation has the role and text (of equal rows, the first one)."""
    inked = F.rtrim(c("text"), F.lit(_SPACES))
    short = rows.select(
        "conv_id", "turn", "role", _code(c("role"), c("text")).alias("code"), "copies", (inked == "").alias("blank"),
        (~F.right(inked, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    every = short.groupBy("conv_id", "turn", "role", "code").agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    earliest = short.groupBy(c("conv_id").alias("of"), c("code").alias("said")).agg(F.min(F.struct(c("turn").isNotNull(), c("turn").alias("turn"))).alias("at"))
    # both sides have one row for each key, so no key is hot here
    here = every["conv_id"].eqNullSafe(earliest["of"]) & (every["code"] == earliest["said"]) & every["turn"].eqNullSafe(earliest["at.turn"])
    return every.join(earliest, here, "left").select(*every.columns, c("said").isNotNull().alias("first"))


# --------------------------------------------------------------------------------------- sections
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct")
_SECTIONS = (
    "conv_id long, part int, seq long, " + ", ".join(f"{n} long" for n in _COUNTS) + ", opening string, closing string, least long,"
    " most long, costs array<long>, audits array<string>, turns array<long>, roles array<string>, codes array<binary>"
)
_FOLDED = "conv_id long, part int, seq long, entry int, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_STEPS = "conv_id long, part int, seq long, pos long, turn long, role string, code binary, said string, inserted boolean"


class _Section:
    """The rows of a section, as they come."""

    def __init__(self, conv_id: int | None, begins: bool, rules: Rules):
        self.conv_id, self.begins, self.rules, self.rows, self.turns = conv_id, begins, rules, [], []
        self.counts = dict.fromkeys(_COUNTS, 0)

    def add(self, turn: int | None, role: str, code: bytes, blank: bool, truncated: bool, first: bool) -> None:
        fault = "blank" if blank else "duplicate" if not first else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        if self.rows:
            self.counts["illegal"] += self.rows[-1][1][:1] + role[:1] not in _LEGAL
        if turn is not None:
            self.counts["distinct"] += not self.turns or self.turns[-1] != turn
            self.turns = [self.turns[0] if self.turns else turn, turn]
        self.rows.append((turn, role, code, blank or not first, truncated))

    def solved(self, part: int, seq: int) -> tuple:
        """The section's counts, the least costs and audits from each state it may be entered in, and its rows' names."""
        audits, costs, texts = Audits(), [], []
        entered: list[Table] = [begun(audits, self.rules)] if self.begins else [[(0, 0) if s == e else None for s in range(4)] for e in range(4)]
        for table in entered:
            for _, role, _, must, truncated in self.rows:
                table = stepped(audits, table, role[:1], must, truncated, self.rules)
            costs += [held and held[0] for held in table]
            texts += [held and audits.text(held[1]) for held in table]
        turns, roles, codes = ([r[i] for r in self.rows] for i in range(3))
        ends = (self.turns[0], self.turns[-1]) if self.turns else (None, None)
        return (self.conv_id, part, seq, *self.counts.values(), roles[0][:1], roles[-1][:1], *ends, costs, texts, turns, roles, codes)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            yield from zip(*(column.to_pylist() for column in batch.slice(a, 1024).columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _mapped(df: DataFrame, rows_made, ddl: str) -> DataFrame:
    """``df`` through a function from all rows of a partition, in order, to rows of ``ddl``."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return df.mapInArrow(lambda batches: _batched(rows_made(_rows_of(batches)), schema), ddl)


def _cut(rows: Iterator[tuple], rules: Rules) -> Iterator[tuple]:
    """Sections of rows in order. Whether a partition's first one begins its conversation is not known here."""
    part, seq, section = TaskContext.get().partitionId(), 0, None
    for conv_id, turn, role, code, copies, blank, truncated, first in rows:
        for k in range(copies):
            another = section is None or section.conv_id != conv_id
            if another or len(section.rows) >= rules.section:
                if section:
                    yield section.solved(part, seq)
                    seq += 1
                section = _Section(conv_id, another and section is not None, rules)
            section.add(turn, role, code, blank, truncated, first and k == 0)
    if section:
        yield section.solved(part, seq)


def sections(rows: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The sections of all conversations, (part, seq) in order of their rows: turn (null first), role, code."""
    order = ("conv_id", "turn", "role", "code")
    return _mapped(rows.repartitionByRange(*order).sortWithinPartitions(*order), partial(_cut, rules=rules), _SECTIONS)


class _Fold:
    """The sections of one conversation, joined in order."""

    def __init__(self, conv_id: int | None, rules: Rules):
        self.conv_id, self.audits = conv_id, Audits()
        self.table: Table = begun(self.audits, rules)
        self.entry: dict[int, int] = {}  # of the nodes of sections
        self.places: list[tuple[int, int]] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.least = self.most = self.closing = None

    def add(self, part: int, seq: int, counts: tuple, opening: str, closing: str, least: int | None, most: int | None, costs: list, texts: list) -> None:
        for name, n in zip(_COUNTS, counts, strict=True):
            self.counts[name] += n
        if self.places:
            self.counts["illegal"] += self.closing + opening not in _LEGAL
        if least is not None:
            self.counts["distinct"] -= self.most == least
            self.least, self.most = least if self.least is None else self.least, most
        self.closing = closing
        self.places.append((part, seq))
        table, self.table = ([(0, 0), None, None, None] if len(costs) == 4 else self.table), [None] * 4
        for entry, held in enumerate(table):
            for state in range(4 if held else 0):
                cost, piece = costs[4 * entry + state], texts[4 * entry + state]
                if cost is not None and _offer(self.audits, self.table, state, held[0] + cost, held[1], piece):
                    self.entry[self.table[state][1]] = entry

    def done(self) -> Iterator[tuple]:
        """A row for the conversation, and one for each section with its state of entry and its edits."""
        end: Table = [None] * 4
        for state in (START, ASSISTANT):
            if self.table[state]:
                cost, node = self.table[state]
                if end[0] is None or cost < end[0][0] or cost == end[0][0] and self.audits.less(node, end[0][1]):
                    end[0] = cost, node
        cost, node = end[0]
        gaps = self.most - self.least + 1 - self.counts["distinct"] if self.most is not None else 0
        n = self.counts
        yield self.conv_id, None, None, None, self.audits.text(node), gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost
        for part, seq in reversed(self.places):
            entry, piece, node = self.entry[node], self.audits.pieces[node], self.audits.ups[node][0]
            if (part, seq) == self.places[0]:
                entry, piece = START, self.audits.text(node) + piece
            yield self.conv_id, part, seq, entry, piece, *[None] * 6


def _fold(rows: Iterator[tuple], rules: Rules) -> Iterator[tuple]:
    now = None
    for conv_id, part, seq, *counts, opening, closing, least, most, costs, texts in rows:
        if now is None or now.conv_id != conv_id:
            if now:
                yield from now.done()
            now = _Fold(conv_id, rules)
        now.add(part, seq, counts, opening, closing, least, most, costs, texts)
    if now:
        yield from now.done()


def _edits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The turns that an audit leaves, in order, with their role."""
    for conv_id, part, seq, state, audit, turns, roles, codes in rows:
        left = zip(turns, roles, codes, strict=True)
        for pos, edit in enumerate(audit):
            turn, role, code = (None, None, None) if edit == "I" else next(left)
            if edit == "D":
                continue
            state = _AFTER[role[:1]][state] if edit == "K" else ASSISTANT if state == USER else USER
            said = role if edit == "K" else "user" if state == USER else "assistant"
            yield conv_id, part, seq, pos, turn, role, code, said, edit == "I"


def _hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """SHA-256 of every conversation's repaired turns; they stream through, a conversation is never held."""
    code, now, begun_ = None, None, False
    for conv_id, said, text in rows:
        if not begun_ or conv_id != now:
            if begun_:
                yield now, code.hexdigest()
            code, now, begun_ = hashlib.sha256(), conv_id, True
        else:
            code.update(b"\n")
        code.update(f"{said}:{text}".encode())
    if begun_:
        yield now, code.hexdigest()


def _by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def repaired_turns(turns: DataFrame, rules: Rules = RULES) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): the counts, cost and audit of every conversation that has a row, and what is left of it.

    The second table has conv_id, part, seq, pos (the order of turns), said (the role as repaired) and text. ``turns`` is a table of
    conv_id, turn, role, text and copies, as :func:`damaged` gives it; role and text are not null."""
    scratch = Scratch(turns.sparkSession)
    cut = scratch.keep(sections(scratch.keep(_faults(turns), "turn-faults"), rules), "turn-sections")
    rows = _by_conversation(cut.drop("turns", "roles", "codes"), "part", "seq")
    folded = scratch.keep(_mapped(rows, partial(_fold, rules=rules), _FOLDED), "turn-audits")
    paths = folded.where(c("part").isNotNull()).select("part", "seq", "entry", "audit")
    named = cut.select("conv_id", "part", "seq", "turns", "roles", "codes").join(paths, ["part", "seq"])
    steps = _mapped(named.select("conv_id", "part", "seq", "entry", "audit", "turns", "roles", "codes"), _edits, _STEPS)
    steps = scratch.keep(steps, "turn-edits")
    texts = turns.groupBy(c("conv_id").alias("of"), c("turn").alias("at"), c("role").alias("was"), _code(c("role"), c("text")).alias("is")).agg(F.first("text").alias("text"))
    stay = steps.where("not inserted")
    here = c("conv_id").eqNullSafe(c("of")) & c("turn").eqNullSafe(c("at")) & (c("role") == c("was")) & (c("code") == c("is"))
    out = ("conv_id", "part", "seq", "pos", "said", "text")
    left = stay.join(texts, here).select(*out).unionByName(steps.where("inserted").withColumn("text", F.lit("")).select(*out))
    whole = folded.where("part is null").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return whole, left


def conversation_audits(turns: DataFrame, rules: Rules = RULES) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id of ``turns``.

    ``turns`` needs conv_id, turn, role and text; other columns are ignored. It is damaged first, see :func:`damaged`. Null roles and
    texts are one space; a null conv_id is a conversation of its own. Rows of one turn number are ordered by role, then by the MD5 code
    of role and text; equal rows follow each other, the first is no duplicate. A conversation without rows after damage has zeros, an
    empty audit and the hash of the empty text. An empty table gives no rows. An audit and a hash are single values, so the sections of
    a conversation are joined in one task, with some twenty bytes a row, and its text streams through one task."""
    whole, left = repaired_turns(damaged(turns), rules)
    hashes = _mapped(_by_conversation(left, "part", "seq", "pos").select("conv_id", "said", "text"), _hashed, "of long, sha string")
    ids = turns.select(c("conv_id").cast("long").alias("conv_id")).distinct()
    counted = whole.withColumnRenamed("conv_id", "at")
    out = ids.join(counted, c("conv_id").eqNullSafe(c("at")), "left").join(hashes, c("conv_id").eqNullSafe(c("of")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
