"""Conversation structure repair over a suffix-shared DAWG.

1. A conversation's rows become one signature, a symbol per row: the initial of its role (``s``, ``u``, ``a``, or
   ``o`` for any other), in upper case where the text is truncated, and ``x`` for a row that must go, be it blank
   or a duplicate, whatever its role. Rows that allow the same edits at the same costs share a symbol.
2. The distinct signatures of all conversations, read from the end and sorted that way, form an automaton in
   which equal suffixes are one node. In sorted order only the nodes of one path are alive: a node is left
   for good when the next signature branches off below it. So each node is made once, and once more in each
   range partition whose border it lies on.
3. A node knows for each state of the grammar ``(s?(ua)+)?`` the least cost of repairing its suffix, the first
   edit of the best audit, where that leads, and how the audits of its four states compare. So a node takes
   the same few bytes however long its suffix is, and an audit is read by walking from node to node.
4. Every conversation gets cost and audit by its signature, in one equi-join, and its turns by its audit.

Edits and costs: ``K`` keep 0, ``R`` give another role 1, ``D`` delete 2, ``I`` insert an empty turn 5; a truncated
row that stays costs 5 more. Of audits of least cost the one that sorts first in ASCII wins.

Defined results: null roles and texts count as one space. Rows are ordered by turn (nulls first), then role,
then text. A role's initial is its first character, case counts, and an empty role has none. Rows that are not
``present`` only keep their conversation in the result: without rows it has zeros and an empty audit. Rows with
a null ``conv_id`` are one conversation. Repeated rows are duplicates from the second on. An empty table gives
no rows; extra columns are not read. A conversation is a value of one row, as long as the data make it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.session import durable, ship_package

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs
START, SYSTEM, USER, REPLY = range(4)  # what has been written so far ends with nothing, system, user, assistant
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): REPLY, (REPLY, "u"): USER}
_NEXT = {START: USER, SYSTEM: USER, USER: REPLY, REPLY: USER}  # by a turn of the one role that may be made up
_ROLE = {USER: "user", REPLY: "assistant"}
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_TURNS = "array<struct<turn: bigint, role: string, text: string>>"


# --- signatures --------------------------------------------------------------------------------------
def signature(roles: list[str], texts: list[str]) -> tuple[str, int, int, int, int]:
    """Symbols of a conversation's rows, and how many are blank, duplicate, truncated, and illegal in their place."""
    symbols, seen, counts = [], set(), [0, 0, 0]
    for row in zip(roles, texts, strict=True):
        role, core = row[0], row[1].rstrip(_SPACE)
        if not core or row in seen:
            symbols.append("x")
            counts[bool(core)] += 1
        else:
            symbol = role[:1] if role[:1] in {"s", "u", "a"} else "o"
            cut = core[-1] not in ".!?"
            symbols.append(symbol.upper() if cut else symbol)
            counts[2] += cut
        seen.add(row)
    illegal = sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:]))
    return "".join(symbols), *counts, illegal


def missing_turns(turns: list[int | None]) -> int:
    numbers = {t for t in turns if t is not None}
    return max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0


# --- the automaton -----------------------------------------------------------------------------------
class Node:
    """One suffix: for each grammar state ``steps`` (cost, first edit, state behind it) and ``ranks`` of the audits."""

    __slots__ = ("ranks", "steps")

    def __init__(self, steps: list[tuple[int, str, int]], below: Node | None):
        reply, user = steps[REPLY], steps[USER]
        steps[USER] = min(user, (reply[0] + INSERT, "I", REPLY))
        steps[REPLY] = min(reply, (user[0] + INSERT, "I", USER))
        for state in (START, SYSTEM):
            steps[state] = min(steps[state], (steps[USER][0] + INSERT, "I", USER))
        self.steps = steps

        def audit(state: int) -> tuple:
            _, edit, behind = steps[state]
            if edit == "I":
                return (edit, *audit(behind))
            return (edit, below.ranks[behind] if below and edit else 0)

        audits = [audit(state) for state in range(4)]
        order = {a: i for i, a in enumerate(sorted(set(audits)))}
        self.ranks = [order[a] for a in audits]


def end_node() -> Node:
    never = 1 << 60
    return Node([(0, "", START), (never, "", SYSTEM), (never, "", USER), (0, "", REPLY)], None)


def node(symbol: str, below: Node) -> Node:
    """The suffix that ``symbol`` and then ``below`` make."""
    steps = []
    for state in range(4):
        edits = [(DELETE, "D", state)]
        if symbol != "x":
            more = TRUNCATED if symbol.isupper() else 0
            kept = _KEPT.get((state, symbol.lower()))
            edits += [(more, "K", kept)] if kept is not None else []
            edits.append((REROLE + more, "R", _NEXT[state]))
        cost, edit, _, behind = min((below.steps[to][0] + c, e, below.ranks[to], to) for c, e, to in edits)
        steps.append((cost, edit, behind))
    return Node(steps, below)


class SuffixPath:
    """The living path of the automaton; signatures must come in the order of their reversed texts."""

    def __init__(self):
        self.nodes, self.reversed = [end_node()], ""

    def repair(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of the signature whose reverse is given."""
        shared = 0
        for a, b in zip(self.reversed, backwards):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in backwards[shared:]:
            self.nodes.append(node(symbol, self.nodes[-1]))
        self.reversed = backwards
        place, state, audit = len(backwards), START, []
        while True:
            _, edit, behind = self.nodes[place].steps[state]
            if not edit:
                return self.nodes[-1].steps[START][0], "".join(audit)
            audit.append(edit)
            state = behind
            place -= edit != "I"


def apply_audit(roles: list[str], texts: list[str], audit: str) -> list[tuple[str, str]]:
    """The repaired turns."""
    out, row, state = [], 0, START
    for edit in audit:
        if edit == "K":
            out.append((roles[row], texts[row]))
            state = _KEPT[state, roles[row][0]]
        elif edit != "D":
            state = _NEXT[state]
            out.append((_ROLE[state], texts[row] if edit == "R" else ""))
        row += edit != "I"
    return out


# --- over tables -------------------------------------------------------------------------------------
def _unpacked(lists: pa.Array) -> Iterator[tuple[list, list, list]]:
    """Turns, roles and texts of each conversation of a batch."""
    flat = lists.flatten()
    columns = [flat.field(name).to_pylist() for name in ("turn", "role", "text")]
    start = 0
    for size in lists.value_lengths().to_pylist():
        yield tuple(c[start : start + size] for c in columns)
        start += size


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(*signature(roles, texts), missing_turns(turns)) for turns, roles, texts in _unpacked(batch.column("turns"))]
        columns = {"signature": pa.array([f[0] for f in found], pa.string())}
        for name, place in zip(_COUNTS, (5, 1, 2, 3, 4), strict=True):
            columns[name] = pa.array([f[place] for f in found], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], ["conv_id", "turns", *columns])


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = SuffixPath()
    for batch in batches:
        done = [path.repair(backwards) for backwards in batch.column("backwards").to_pylist()]
        columns = [batch.column("signature"), pa.array([c for c, _ in done], pa.int64()), pa.array([a for _, a in done], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["signature", "cost", "audit"])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["conv_id", *_COUNTS, "cost", "audit"]
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        rows = zip(_unpacked(batch.column("turns")), batch.column("audit").to_pylist(), strict=True)
        turns = [[{"role": r, "text": t} for r, t in apply_audit(roles, texts, audit)] for (_, roles, texts), audit in rows]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(turns, kind)], [*kept, "repaired"])


def solve_signatures(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of distinct signatures, each automaton node being made once."""
    backwards = signatures.select("signature", F.reverse("signature").alias("backwards"))
    dealt = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return dealt.mapInArrow(_solved, "signature string, cost bigint, audit string")


def repair_conversations(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired`` (turns of role and text).

    ``rows`` has ``conv_id, turn, role, text``; ``present`` tells which of them there are (all, if not given).
    """
    ship_package(rows.sparkSession)
    blank = F.lit(" ")
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    turns = F.sort_array(F.collect_list(turn if present is None else F.when(present, turn)))
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    grouped = rows.groupBy("conv_id").agg(turns.cast(_TURNS).alias("turns"))
    conv_id = f"conv_id {grouped.schema['conv_id'].dataType.simpleString()}"
    signed = durable(grouped.mapInArrow(_signed, f"{conv_id}, turns {_TURNS}, signature string, {counts}"))
    solved = durable(solve_signatures(durable(signed.select("signature").distinct())))
    judged = signed.join(solved, "signature")
    repaired = "repaired array<struct<role: string, text: string>>"
    return judged.mapInArrow(_repaired, f"{conv_id}, {counts}, cost bigint, audit string, {repaired}")
