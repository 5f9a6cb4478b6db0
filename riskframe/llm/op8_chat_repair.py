"""Chat conversations repaired to a legal sequence of roles at least cost, then rendered.

Legal: at most one system turn, at the start; then user and assistant turns in
alternation, a user turn first and an assistant turn last.  Every input turn
becomes a turn of some role (a relabel, if the role isn't its own) or is
merged into the turn before it; empty turns may be inserted.  Dynamic
programming over the states of this automaton (start, system, user,
assistant) finds the cheapest repair.

Costs are added, so a run of turns acts on the states as a matrix of least
costs, and runs combine like matrix products.  Turns are range partitioned
and sorted; a conversation that lies in several partitions has its runs
combined from one matrix for each, and each run is then solved on its own
between the states found for its ends.  No task holds more than its range of
turns, however long a conversation is.  The driver gets the matrices of the
first and last run of each partition, so as many as there are partitions.

Of equally cheap repairs a fixed one is chosen (each step carries a second
cost, a hash of its turn and state), wherever the partitions are cut.

The result has one row per input turn.  Its ``fragment`` is what this turn
adds to the conversation's rendered text; the fragments of a conversation in
order are the whole text.

Defined results: roles are compared without case and blanks, some other names
count as ``ROLE_NAMES`` says, and unknown or null roles fit any role at the
cost ``COST_UNKNOWN``; null text is empty; turns are ordered by turn (null
first), role and text; rows that repeat are turns of their own; a null conv_id
is one conversation; an empty table gives no rows.  Marks in a text that look
like those of the rendering are escaped.  Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.ordered import PART, shuffle_partitions
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import read_table

STATES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
COST_MERGE, COST_INSERT, COST_RELABEL, COST_UNKNOWN = 2, 3, 4, 1
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
#: the second cost is below this, and sums of it stay below 2 ** 64 of them
_TIE = 1 << 32
_UNIT = _TIE << 64
_FAR = _UNIT << 128  # no path
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ROWS = "conv_id long, turn long, role string, new_role string, action string, inserted array<string>, cost int, fragment string"


def state_of(role: str | None) -> int:
    """The state of a role; START for an unknown one."""
    name = (role or "").strip().lower()
    name = ROLE_NAMES.get(name, name)
    return STATES.index(name) if name in STATES[1:] else START


def _insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """(from, to): the shortest run of empty turns that leads there."""
    out = {(s, s): () for s in range(4)}
    for _ in range(4):
        for (a, b), run in list(out.items()):
            for c in NEXT[b]:
                if len(run) + 1 < len(out.get((a, c), range(9))):
                    out[a, c] = (*run, c)
    return out


INSERT = _insertions()


def steps(role: int) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(from, to, cost, action, turns inserted before) of all ways to take a turn of ``role``."""
    out = []
    for to in (SYSTEM, USER, ASSISTANT):
        label = 0 if role == to else COST_UNKNOWN if role == START else COST_RELABEL
        action = "keep" if role == to else "relabel"
        out.append((to, to, COST_MERGE + label, "merge", ()))
        for (a, b), run in INSERT.items():
            if to in NEXT[b]:
                out.append((a, to, COST_INSERT * len(run) + label, action, run))
    return out


STEPS = [steps(r) for r in range(4)]


def _weights(turn: int | None, text: str, number: int) -> list[int]:
    """The second cost of each step for a turn; ``number`` tells equal turns apart."""
    base = zlib.crc32(f"{turn}|{number}|".encode() + text.encode())
    return [zlib.crc32(bytes([i]), base) for i in range(24)]


def _advance(costs: list[int], role: int, weights: list[int]) -> tuple[list[int], list]:
    """Least costs after one turn from those before it, and the step that leads to each state."""
    best, by = [_FAR] * 4, [None] * 4
    for i, step in enumerate(STEPS[role]):
        c = costs[step[0]] + step[2] * _UNIT + weights[i]
        if c < best[step[1]]:
            best[step[1]], by[step[1]] = c, step
    return best, by


def _end(costs: list[int]) -> tuple[int, int]:
    """(least cost with a legal end, state before the turns that are added for it)."""
    return min((c + COST_INSERT * len(INSERT[s, ASSISTANT]) * _UNIT, s) for s, c in enumerate(costs) if (s, ASSISTANT) in INSERT)


def _unit(state: int) -> list[int]:
    return [0 if s == state else _FAR for s in range(4)]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, list]]:
    """(partition, conv_id, its (turn, role, text, number of equal turns before)) of a sorted partition."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(5)))
    for (part, conv), group in groupby(rows(), key=lambda r: (r[4], r[0])):
        turns, last, number = [], None, 0
        for _, turn, role, text, _ in group:
            number = number + 1 if (turn, role, text) == last else 0
            last = (turn, role, text)
            turns.append((turn, role, text or "", number))
        yield part, conv, turns


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrices of the first and the last run of a partition."""
    ends: list = []
    for part, conv, turns in _pieces(batches):
        if len(ends) < 2:
            ends.append((part, conv, turns))
        else:
            ends[1] = (part, conv, turns)
    for part, conv, turns in ends:
        matrix = [_unit(s) for s in range(4)]
        for turn, role, text, number in turns:
            weights = _weights(turn, text, number)
            matrix = [_advance(m, state_of(role), weights)[0] for m in matrix]
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([conv], pa.int64()), pa.array([json.dumps(matrix)])],
                                         names=["part", "conv_id", "matrix"])


def join_runs(runs: list[tuple[int, int | None, list[list[int]]]]) -> dict[tuple[int, int | None], tuple[int, int, bool, bool]]:
    """For runs of one conversation in several partitions: (state at its start, at its end, is it the
    first, is it the last) of each."""
    out = {}
    for conv, group in groupby(sorted(runs, key=lambda r: (r[1] is not None, r[1] or 0, r[0])), key=lambda r: r[1]):
        group = list(group)
        if len(group) < 2:
            continue
        before = [_unit(START)]
        for _, _, m in group:
            before.append([min(before[-1][a] + m[a][b] for a in range(4)) for b in range(4)])
        state = _end(before[-1])[1]
        for n in range(len(group) - 1, -1, -1):
            part, _, m = group[n]
            first = min(range(4), key=lambda a: before[n][a] + m[a][state])
            out[part, conv] = first, state, n == 0, n == len(group) - 1
            state = first
    return out


def repair(turns: list[tuple], enter: int = START, leave: int | None = None) -> list[tuple]:
    """The cheapest steps for ``turns`` from one state to another (None: any that can legally end)."""
    costs, back = _unit(enter), []
    for turn, role, text, number in turns:
        costs, by = _advance(costs, state_of(role), _weights(turn, text, number))
        back.append(by)
    state = _end(costs)[1] if leave is None else leave
    path = []
    for by in reversed(back):
        path.append(by[state])
        state = by[state][0]
    return path[::-1]


def _escape(text: str) -> str:
    return text.replace("<|", "<\\|")


def render(path: list[tuple], turns: list[tuple], enter: int, last: bool) -> Iterator[tuple]:
    """(new role, action, roles inserted, cost, fragment) of each turn."""
    empty = lambda s: f"{OPEN}{STATES[s]}\n{CLOSE}\n"
    for n, ((a, to, cost, action, run), turn) in enumerate(zip(path, turns)):
        if action == "merge":
            fragment = "\n" + _escape(turn[2])
        else:
            fragment = (f"{CLOSE}\n" if a != START else "") + "".join(map(empty, run)) + f"{OPEN}{STATES[to]}\n" + _escape(turn[2])
        after = INSERT[to, ASSISTANT] if last and n == len(path) - 1 else ()
        if last and n == len(path) - 1:
            fragment += f"{CLOSE}\n" + "".join(map(empty, after))
        yield STATES[to], action, [STATES[s] for s in (*run, *after)], cost + COST_INSERT * len(after), fragment


def _repair(spans: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(rows):
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.string())
        names = ("conv_id", "turn", "role", "new_role", "action", "inserted", "cost", "fragment")
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))
    out: list[tuple] = []
    for part, conv, turns in _pieces(batches):
        enter, leave, _, last = spans.get((part, conv), (START, None, True, True))
        path = repair(turns, enter, leave)
        out += [(conv, t[0], t[1], *r) for t, r in zip(turns, render(path, turns, enter, last))]
        if len(out) >= 4096:
            yield emit(out)
            out = []
    if out:
        yield emit(out)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per row of ``conversations`` (conv_id, turn, role, text); see ROWS."""
    spark = conversations.sparkSession
    ensure_checkpoint_dir(spark)
    order = ["conv_id", "turn", "role", "text"]
    dealt = conversations.select(*order).repartitionByRange(shuffle_partitions(conversations), *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn(PART, F.spark_partition_id()).checkpoint(eager=True)
    runs = dealt.mapInArrow(_matrices, "part int, conv_id long, matrix string").collect()  # two a partition
    spans = join_runs([(r["part"], r["conv_id"], json.loads(r["matrix"])) for r in runs])
    return dealt.mapInArrow(partial(_repair, spans), ROWS)


def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(read_table(spark, sf_dir, "conversations"))
