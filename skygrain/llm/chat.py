"""Chat formatting: the cheapest repair of a conversation's roles, then its rendering."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skygrain.llm import texts
from skygrain.plans.skew import PART, TIE, cut_ranges

# States of the automaton: nothing yet, then the role of the last turn. A system turn comes first or not at all;
# after it, user and assistant take turns, the user first.
STATES = ("start", "system", "user", "assistant")
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
MERGE, RELABEL, NAME_UNKNOWN, INSERT = 1.0, 2.0, 1.0, 3.0
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"


def _moves() -> dict[int, list[tuple[int, int, float, str, int]]]:
    """Per state before: (state after, role given, cost without relabelling, action, inserted role or 0)."""
    out = {}
    for before in range(4):
        moves = [(q, q, 0.0, "keep", 0) for q in NEXT[before]]
        if before:
            moves.append((before, before, MERGE, "merge", 0))
        for via in NEXT[before]:
            moves += [(q, q, INSERT, "insert", via) for q in NEXT[via] if via > 1]
        out[before] = moves
    return out


MOVES = _moves()


def _relabel(role: str | None, given: int) -> float:
    if role == STATES[given]:
        return 0.0
    return RELABEL if role in STATES[1:] else NAME_UNKNOWN


def forward(roles: list[str | None], enter: np.ndarray) -> tuple[np.ndarray, list[list[tuple]]]:
    """(cost of each state after the turns, per turn and state the move that led there), from costs on entry."""
    cost = enter.tolist()
    back = []
    for role in roles:
        after, how = [math.inf] * 4, [()] * 4
        for before in range(4):
            if cost[before] == math.inf:
                continue
            for state, given, price, action, via in MOVES[before]:
                total = cost[before] + price + _relabel(role, given)
                if total < after[state]:
                    after[state], how[state] = total, (before, given, action, via, total - cost[before])
        cost = after
        back.append(how)
    return np.array(cost), back


def _chunk_costs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each stretch of a conversation as the 4 x 4 table of its costs between entry and exit states."""
    for chunk in texts.by_key(batches, ["conv_id", PART]):
        roles = chunk.column("role").to_pylist()
        costs = []
        for state in range(4):
            enter = np.full(4, math.inf)
            enter[state] = 0.0
            costs += forward(roles, enter)[0].tolist()
        yield pa.record_batch({
            "conv_id": chunk.column("conv_id").combine_chunks().slice(0, 1),
            PART: pa.array([chunk.column(PART)[0].as_py()], pa.int32()),
            "costs": pa.array([costs], pa.list_(pa.float64())), "turns": pa.array([len(roles)], pa.int64()),
        })


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states in which the cheapest path enters and leaves each stretch of a conversation."""
    for conversation in texts.by_key(batches, ["conv_id"]):
        tables = [np.array(x).reshape(4, 4) for x in conversation.column("costs").to_pylist()]
        cost, back = np.array([0.0] + [math.inf] * 3), []
        for table in tables:
            through = cost[:, None] + table
            back.append(through.argmin(0))
            cost = through.min(0)
        state = int(cost.argmin())
        enter, leave = [], []
        for b in reversed(back):
            leave.append(state)
            state = int(b[state])
            enter.append(state)
        turns = conversation.column("turns").to_numpy()
        n = len(tables)
        yield pa.record_batch({
            "conv_id": conversation.column("conv_id").combine_chunks(),
            PART: conversation.column(PART).combine_chunks(),
            "enter": pa.array(enter[::-1], pa.int32()), "leave": pa.array(leave[::-1], pa.int32()),
            "first": pa.array(np.cumsum(turns) - turns), "last": pa.array([False] * (n - 1) + [True]),
        })


def _repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in texts.by_key(batches, ["conv_id", PART]):
        roles, bodies = chunk.column("role").to_pylist(), chunk.column("text").to_pylist()
        enter = np.full(4, math.inf)
        enter[chunk.column("enter")[0].as_py()] = 0.0
        _, back = forward(roles, enter)
        state = chunk.column("leave")[0].as_py()
        path = []
        for how in reversed(back):
            path.append((*how[state], state))
            state = how[state][0]
        given, action, inserted, price, piece = [], [], [], [], []
        for body, (before, role, act, via, cost, _), own in zip(bodies, reversed(path), roles):
            label = act if own == STATES[role] else {"keep": "relabel"}.get(act, f"{act}+relabel")
            if act == "merge":
                text = "\n" + (body or "")
            else:
                text = (CLOSE if before else "") + (OPEN.format(STATES[via]) + CLOSE if via else "")
                text += OPEN.format(STATES[role]) + (body or "")
            given.append(STATES[role])
            action.append(label)
            inserted.append(STATES[via] if via else None)
            price.append(cost)
            piece.append(text)
        if chunk.column("last")[0].as_py():
            piece[-1] += CLOSE
        first = chunk.column("first")[0].as_py()
        yield pa.record_batch({
            "conv_id": chunk.column("conv_id").combine_chunks(), "turn": chunk.column("turn").combine_chunks(),
            "position": pa.array(np.arange(first, first + len(roles))),
            "role": pa.array(roles, pa.string()), "role_out": pa.array(given, pa.string()),
            "action": pa.array(action, pa.string()), "inserted": pa.array(inserted, pa.string()),
            "cost": pa.array(price, pa.float64()), "piece": pa.array(piece, pa.string()),
        })


def format_chats(turns: DataFrame) -> DataFrame:
    """Repair every conversation's roles at least cost and render it.

    Returns one row per turn: ``conv_id, turn, position, role, role_out, action, inserted, cost, piece``. The pieces
    of a conversation, in order of ``position``, are its rendering. A turn keeps its role, is relabelled, is merged
    into the turn before, or has an empty turn of role ``inserted`` put before it. The sum of costs is the least
    possible; ties go to the move that is listed first.

    Turns are ordered by (turn, role, text), nulls first. A null or unknown role costs less to name than a known one
    to change. A null text is empty. Turns with a null ``conv_id`` are one conversation. Repeated rows are turns of
    their own; an empty table gives an empty result; other columns are ignored.

    A path through the automaton is a chain of 4 x 4 min-plus tables, and chaining is associative. So conversations
    are cut into ranges over the cluster, each stretch is reduced to its table, the tables of a conversation (one per
    range that it touches) are chained, and each stretch is then repaired between its own entry and exit state. A
    conversation of any length is never in one task.
    """
    rows = turns.select(
        "conv_id", "turn", F.lower(F.trim(F.col("role").cast("string"))).alias("role"),
        F.col("text").cast("string").alias("text"))
    cut = cut_ranges(rows, ["conv_id"], ["turn", "role", "text"])
    order = ["conv_id", "turn", "role", "text", TIE]
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    tables = (
        cut.select("conv_id", "turn", "role", "text", TIE, PART)
        .repartition(PART).sortWithinPartitions(PART, *order).select("conv_id", PART, "role")
        .mapInArrow(_chunk_costs, f"conv_id {conv}, {PART} int, costs array<double>, turns long")
    )
    states = tables.repartition("conv_id").sortWithinPartitions("conv_id", PART).mapInArrow(
        _chain, f"conv_id {conv}, {PART} int, enter int, leave int, first long, last boolean")
    placed = cut.alias("r").join(
        states.alias("s"),
        F.col(f"r.{PART}").eqNullSafe(F.col(f"s.{PART}")) & F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")),
    ).select("r.*", "s.enter", "s.leave", "s.first", "s.last")
    return placed.repartition(PART).sortWithinPartitions(PART, *order).select(
        "conv_id", PART, "turn", "role", "text", "enter", "leave", "first", "last"
    ).mapInArrow(
        _repair, f"conv_id {conv}, turn {turn}, position long, role string, role_out string, action string, "
                 "inserted string, cost double, piece string")
