"""Chat formatting: a hidden Markov model recovers who speaks in raw transcripts, which are then rendered canonically.

The states are the roles, each at the first line of a turn and inside one; an observation is a line's speaker marker, whether it
asks, and its length class. Transition and emission counts are summed over the labelled transcripts (a table of fixed size) and
smoothed by one. Viterbi gives the most probable states of a transcript's lines, and every first line begins a turn. Turns are
rendered as ``<|role|>``, the text without its marker, and ``<|end|>``.

A conversation of any length is parsed as a whole, in sections of bounded size. The rows of all conversations are put in order by a
range partitioning and cut where ``SECTION`` rows or ``SECTION_BYTES`` are reached. Most conversations are one section. Of the others,
each section gives its max-plus transfer matrix (best sum from every state before it to every state at its end); products in order
tell what enters each section; with that, each section says which state before it every state at its end comes from; these maps,
followed from the end, give each section the state that it ends in, and it is traced back from there. Products and maps are joined
in a tree of ``FAN`` sections a node, so no task holds a conversation. Log probabilities are whole millionths, so sums do not depend
on the order in which they are taken, and the result is that of one Viterbi pass over the conversation, ties included.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from kerbsight.llm.store import Scratch

c = F.col
ROLES = ("system", "user", "assistant")
STATES = [role + more for role in ROLES for more in ("", "+")]  # "+": inside a turn
#: Rows and bytes of text at which a section ends; sections that one node of the tree joins.
SECTION, SECTION_BYTES, FAN = 128, 4 << 20, 512
UNIT = 1_000_000
#: The speaker markers that transcripts use, by style, for system, user and assistant.
MARKERS = (
    ("System: ", "User: ", "Assistant: "),
    ("### Instructions\n", "### Human\n", "### Response\n"),
    ("Note: ", "Q: ", "A: "),
    ("[S] ", "[1] ", "[2] "),
)
_MARKED = re.compile(r"^(?:(system: |### instructions$|note: |\[s\] )|(user: |### human$|q: |\[1\] )|(assistant: |### response$|a: |\[2\] ))", re.IGNORECASE)
_KINDS = 4 * 2 * 4


def marker_of(line: str) -> tuple[int, int]:
    """(kind, length): 0 without a marker, else 1, 2, 3 for what the marker suggests."""
    found = _MARKED.match(line)
    return (found.lastindex, found.end()) if found else (0, 0)


def observed(line: str) -> int:
    kind, length = marker_of(line)
    size = len(line) - length
    return (kind * 2 + line.rstrip().endswith("?")) * 4 + (size >= 20) + (size >= 80) + (size >= 200)


_CUT = "conv_id long, part int, seq long, at long, tail boolean, text string, roles array<string>"


def _mapped(df: DataFrame, made: Callable[[Iterator[dict]], Iterator[tuple]], ddl: str) -> DataFrame:
    """``df`` through a function from the rows of a partition, in order, to rows of ``ddl``; few rows a batch, as texts are long."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in made(r for batch in batches for a in range(0, batch.num_rows, 64) for r in batch.slice(a, 64).to_pylist()):
            held.append(row)
            if len(held) >= 64:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return df.mapInArrow(run, ddl)


def _sections(section: int, most: int):
    """Sections of rows in order; at: its number in its conversation's share of the partition, tail: the last one there."""

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        part, seq, at, now, texts, roles, size = TaskContext.get().partitionId(), 0, 0, None, [], [], 0
        for row in rows:
            for _ in range(row["copies"]):
                another = bool(texts) and row["conv_id"] != now
                if another or len(texts) >= section or size >= most:
                    yield now, part, seq, at, another, "\n".join(texts), roles
                    seq, at, texts, roles, size = seq + 1, 0 if another else at + 1, [], [], 0
                now = row["conv_id"]
                texts.append(row["text"])
                size += len(row["text"])
                role, more = row["role"], row["text"].count("\n")
                roles += [role] + [role and role + "+"] * more
        if texts:
            yield now, part, seq, at, True, "\n".join(texts), roles

    return run


def raw_transcripts(turns: DataFrame, section: int = SECTION, most: int = SECTION_BYTES) -> DataFrame:
    """(conv_id, part, seq, section, last, text, roles): conversations as raw text in numbered sections, the last one marked, with
    the true state of each line (null if unknown); part and seq together name a section.

    A conversation keeps one marker style; one turn in eight has no marker. Turns are ordered by number (null first), role and a code
    of the text; null texts are empty, a null conv_id is a conversation of its own. Equal rows are counted before they are ordered."""
    turns = turns.select(c("conv_id").cast("long").alias("conv_id"), c("turn").cast("long").alias("turn"), c("role").cast("string").alias("role"), F.coalesce(c("text").cast("string"), F.lit("")).alias("text"))
    which = F.array_position(F.array(*map(F.lit, ROLES)), F.lower("role")) - 1
    styles = F.array(*[F.array(*map(F.lit, m)) for m in MARKERS])
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(MARKERS))).cast("int")
    silent = F.pmod(F.xxhash64("conv_id", "turn", F.lit("silent")), F.lit(8)) == 0
    marker = F.when(silent, F.lit("")).otherwise(F.coalesce(F.get(F.get(styles, style), which.cast("int")), F.lit("")))
    lines = turns.select("conv_id", "turn", "role", F.concat(marker, c("text")).alias("text"))
    lines = lines.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("all"))
    lines = lines.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((c("all") - 1) / section))))
    lines = lines.withColumn("copies", F.least(F.lit(section), c("all") - c("share") * section)).withColumn("code", F.xxhash64("text"))
    order = ("conv_id", "turn", "role", "code", "share")  # no text is a range bound
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order[:-1], "text", "share")
    cut = Scratch(turns.sparkSession).keep(_mapped(ordered.select("conv_id", "role", "text", "copies"), _sections(section, most), _CUT), "chat-sections")
    # a partition shares its first and its last conversation with others at most, so `shared` has two rows for each partition at most
    shares = cut.groupBy(c("conv_id").alias("of"), c("part").alias("in")).agg(F.count(F.lit(1)).alias("k"))
    one = Window.partitionBy("of").orderBy("in")
    shared = shares.select(
        "of", "in", F.sum("k").over(one.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.lead("in").over(one).isNull().alias("ends"))
    shared = F.broadcast(shared.where(c("before").isNotNull() | ~c("ends")))
    cut = cut.join(shared, c("conv_id").eqNullSafe(c("of")) & (c("part") == c("in")), "left")
    return cut.select(
        "conv_id", "part", "seq", (c("at") + F.coalesce("before", F.lit(0))).alias("section"),
        (c("tail") & F.coalesce("ends", F.lit(True))).alias("last"), "text", "roles")


def held_out(conv_id: Column) -> Column:
    return F.coalesce(F.crc32(conv_id.cast("string")) % 5 == 0, F.lit(False))


class Model:
    """Log probabilities of the first state, of the next one, and of the observations, in whole millionths."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        logs = (np.log((x + 1) / (x + 1).sum(-1, keepdims=True)) for x in (start, step, emit))
        self.start, self.step, self.emit = (np.rint(UNIT * x).astype(np.int64) for x in logs)

    def seen(self, lines: list[str]) -> np.ndarray:
        return self.emit[:, [observed(x) for x in lines]].T

    def transfer(self, lines: list[str], first: bool) -> np.ndarray:
        """[i, j]: the best sum over ``lines`` from state i before them to state j at their end; of the first section, from the start."""
        seen = self.seen(lines)
        best = (np.broadcast_to(self.start, self.step.shape) if first else self.step) + seen[0]
        for now in seen[1:]:
            best = (best[:, :, None] + self.step).max(1) + now
        return best

    def forward(self, lines: list[str], before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(best sums at the end, the state that each state of each line comes from; the first on ties).

        ``before`` has the best sums just before the lines; without it they begin a conversation."""
        seen = self.seen(lines)
        came = np.zeros((len(lines), len(STATES)), np.int8)
        best = self.start + seen[0]
        for i in range(before is None, len(lines)):
            ways = (best if i else before)[:, None] + self.step
            came[i] = ways.argmax(0)
            best = ways.max(0) + seen[i]
        return best, came

    def states(self, lines: list[str], before: np.ndarray | None = None, end: int | None = None) -> np.ndarray:
        """The most probable state of each line (Viterbi), of those that end in ``end`` if it is given; the first on ties."""
        best, came = self.forward(lines, before)
        path = np.empty(len(lines), np.int64)
        path[-1] = best.argmax() if end is None else end
        for i in range(len(lines) - 1, 0, -1):
            path[i - 1] = came[i, path[i]]
        return path

    def origins(self, lines: list[str], before: np.ndarray | None, last: bool) -> np.ndarray:
        """For each state at the end, the state before the lines; of the last section, that of the most probable end."""
        best, came = self.forward(lines, before)
        at = np.full(len(STATES), best.argmax()) if last else np.arange(len(STATES))
        for row in came[::-1]:
            at = row[at]
        return at.astype(np.int64)


def rendered(lines: list[str], states: np.ndarray, role: int | None = None, last: bool = True) -> tuple[int, str]:
    """(turns that begin here, canonical text). ``role`` is that of a turn which the lines go on with or end; unless they are the
    ``last`` ones, the text leaves its last turn open. So the texts of successive sections, joined by newlines, are the whole one."""
    out, turns = [], 0
    for line, state in zip(lines, states.tolist(), strict=True):
        said, inside = divmod(state, 2)
        kind, length = (0, 0) if inside else marker_of(line)
        if not inside or said != role:
            out += ([] if role is None else ["<|end|>"]) + [f"<|{ROLES[said]}|>"]
            role, turns = said, turns + 1
        if line[length:] or not kind:
            out.append(line[length:])
    return turns, "\n".join(out + ["<|end|>"] * last)


# ------------------------------------------------------------------------- sections of a conversation
_HELD = "conv_id long, section long, part int, seq long, held array<long>"
_HELD_SCHEMA = pa.schema([("conv_id", pa.int64()), ("section", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("held", pa.list_(pa.int64()))])
Then = Callable[[np.ndarray, np.ndarray], np.ndarray]


def product(left: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Max-plus product of a matrix, or a vector, with the next section's matrix, both flat."""
    n = len(STATES)
    return (left.reshape(-1, n, 1) + matrix.reshape(n, n)).max(1).ravel()


def traced(states: np.ndarray, origins: np.ndarray) -> np.ndarray:
    """The states before a section from which those at its end come."""
    return origins[states]


def _in_order(table: pa.Table, backward: bool) -> list[tuple[dict, np.ndarray]]:
    rows = sorted((r for r in table.to_pylist() if r["section"] is not None), key=lambda r: r["section"], reverse=backward)
    return [(r, np.array(r["held"], np.int64)) for r in rows]


def _arriving(scratch: Scratch, parts: DataFrame, then: Then, first: list[int], backward: bool, fan: int) -> DataFrame:
    """``parts`` with what arrives at each section in place of what it holds: ``first`` joined by ``then`` with all sections before it
    (behind it, if ``backward``). Up the tree each node joins its sections, down the tree it passes on what arrives at it."""

    def joined(table: pa.Table) -> pa.Table:
        rows = _in_order(table, backward)
        one = {k: rows[0][0][k] for k in ("conv_id", "part", "seq")}
        return pa.Table.from_pylist([one | {"section": table["block"][0].as_py(), "held": reduce(then, (h for _, h in rows)).tolist()}], schema=_HELD_SCHEMA)

    def passed(table: pa.Table) -> pa.Table:
        above = [r for r in table.to_pylist() if r["section"] is None]
        now, out = np.array(above[0]["held"] if above else first, np.int64), []
        for row, held in _in_order(table, backward):
            out.append({**row, "held": now.tolist()})
            now = then(now, held)
        return pa.Table.from_pylist([{k: r[k] for k in _HELD_SCHEMA.names} for r in out], schema=_HELD_SCHEMA)

    most = parts.agg(F.max("section")).first()[0] or 0
    block, levels = F.floor(c("section") / fan), [parts]
    while most >= fan:
        levels.append(scratch.keep(levels[-1].withColumn("block", block).groupBy("conv_id", "block").applyInArrow(joined, _HELD), "chat-nodes"))
        most //= fan
    came = None
    for level in reversed(levels):
        rows = level.withColumn("block", block)
        if came is not None:
            rows = rows.unionByName(came.withColumn("block", c("section")).withColumn("section", F.lit(None).cast("long")))
        came = scratch.keep(rows.groupBy("conv_id", "block").applyInArrow(passed, _HELD), "chat-arriving")
    return came


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter = Counter()
    number = {r: i for i, r in enumerate(STATES)}
    for rows in batches:
        for section, text, roles in zip(rows["section"], rows["text"], rows["roles"], strict=True):
            states = [number.get((r or "").lower()) for r in roles]
            for k, (line, s) in enumerate(zip(text.split("\n"), states, strict=True)):
                if s is not None:
                    total["emit", s, observed(line)] += 1
                    if k and states[k - 1] is not None:
                        total["step", states[k - 1], s] += 1
                    elif not k and not section:
                        total["start", 0, s] += 1
    if total:
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["what", "i", "j", "n"])


def fit(transcripts: DataFrame) -> Model:
    """Counts of all transcripts that are not held out, steps between sections included; without any, every state is as probable."""
    known = transcripts.where(~held_out(c("conv_id")))
    counts = known.select("section", "text", "roles").mapInPandas(_counted, "what string, i int, j int, n long")
    number = lambda role: (F.array_position(F.array(*map(F.lit, STATES)), F.lower(role)) - 1).cast("int")
    ends = known.where(~c("last")).select(c("conv_id").alias("of"), (c("section") + 1).alias("next"), number(F.element_at("roles", -1)).alias("i"))
    begins = known.where("section > 0").select("conv_id", "section", number(c("roles")[0]).alias("j"))
    steps = ends.join(begins, c("conv_id").eqNullSafe(c("of")) & (c("section") == c("next"))).where("i >= 0 and j >= 0")
    counts = counts.unionByName(steps.select(F.lit("step").alias("what"), "i", "j", F.lit(1).cast("long").alias("n")))
    start, step, emit = np.zeros(len(STATES)), np.zeros((len(STATES),) * 2), np.zeros((len(STATES), _KINDS))
    for r in counts.groupBy("what", "i", "j").agg(F.sum("n").alias("n")).collect():  # a fixed number of cells
        if r["what"] == "start":
            start[r["j"]] = r["n"]
        else:
            (step if r["what"] == "step" else emit)[r["i"], r["j"]] = r["n"]
    return Model(start, step, emit)


_TEXTS = "conv_id long, section long, n_lines long, n_right long, n_turns long, text string"


def formatted(transcripts: DataFrame, model: Model, fan: int = FAN) -> DataFrame:
    """(conv_id, section, n_lines, n_right, n_turns, text): the canonical text of every section of :func:`raw_transcripts`.

    The texts of a conversation's sections, in order and joined by newlines, are its canonical text; n_turns counts the turns that
    begin in a section. n_right counts the lines whose recovered role is the true one, where that is known. An empty transcript is
    one empty line. An empty table gives an empty result."""
    scratch = Scratch(transcripts.sparkSession)
    alone = (c("section") == 0) & c("last")
    long = transcripts.where(~alone)

    def transfers(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            yield r["conv_id"], r["section"], r["part"], r["seq"], model.transfer(r["text"].split("\n"), not r["section"]).ravel().tolist()

    def before(r: dict) -> np.ndarray | None:
        return np.array(r["before"], np.int64) if r["section"] else None

    def origins(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            yield r["conv_id"], r["section"], r["part"], r["seq"], model.origins(r["text"].split("\n"), before(r), r["last"]).tolist()

    def texts(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            lines, role, end = r["text"].split("\n"), None, None if r["last"] else r["end"]
            if r["section"]:
                role = int(model.origins(lines, before(r), r["last"])[end or 0]) // 2
            found = model.states(lines, before(r), end)
            right = sum(ROLES[f // 2] == (t or "").lower().rstrip("+") for f, t in zip(found.tolist(), r["roles"], strict=True))
            yield r["conv_id"], r["section"], len(lines), right, *rendered(lines, found, role, r["last"])

    whole = _mapped(transcripts.where(alone), texts, _TEXTS)
    if long.isEmpty():
        return whole
    matrices = scratch.keep(_mapped(long, transfers, _HELD), "chat-transfers")
    entering = _arriving(scratch, matrices, product, [0] * len(STATES), False, fan)
    long = long.join(entering.select("part", "seq", c("held").alias("before")), ["part", "seq"])
    maps = scratch.keep(_mapped(long, origins, _HELD), "chat-origins")
    leaving = _arriving(scratch, maps, traced, [0], True, fan)
    long = long.join(leaving.select("part", "seq", c("held")[0].cast("int").alias("end")), ["part", "seq"])
    return whole.unionByName(_mapped(long, texts, _TEXTS))


def chat_texts(turns: DataFrame, section: int = SECTION, most: int = SECTION_BYTES, fan: int = FAN) -> DataFrame:
    """Raw transcripts of ``turns`` (conv_id, turn, role, text), parsed and rendered; with held_out for each conversation."""
    transcripts = Scratch(turns.sparkSession).keep(raw_transcripts(turns, section, most), "chat-transcripts")
    return formatted(transcripts, fit(transcripts), fan).withColumn("held_out", held_out(c("conv_id")))
