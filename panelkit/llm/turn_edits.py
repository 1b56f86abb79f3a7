"""Cheapest edits that give a conversation a legal order of roles, by divide and conquer.

The roles of a repaired conversation, as initials, read ``(s?(ua)+)?``. Behind each row the repair is in one of four
states: nothing kept yet, behind a system, a user or an assistant line. The audit of a repair holds one letter for each
edit in order: Delete, Insert, Keep, Rerole. An inserted or reroled line takes the role that its state calls for, so an
audit says all, and of several cheapest repairs the one with the ASCII-least audit is taken.

Hirschberg's method: the cost vector of the first half, forward from the state before it, and that of the second half,
backward from the state behind it, meet in the middle; the best state there splits the task in two. What is held is
a vector at a time. A forward vector also ranks its four states by the least audit that leads to each. No such audit is
the beginning of another, as each ends with the letter of the same row, so the ranks alone decide between crossings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cache

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# What a row is, beside its role: as it should be, one that has to go, or one that ends too early.
SOUND, UNWANTED, CUT = range(3)
NEVER = 1 << 60
# The state behind an inserted or reroled line, the role of that line, and the inserts that end a conversation well.
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

# A vector: cost of each state, less the smallest, and the rank of each by its least audit.
Vector = tuple[tuple[int, ...], tuple[int, ...]]


def row_kind(initial: str, fault: int) -> int:
    """A row as a small number: all rows of one number are edited alike."""
    return ("sua".find(initial) if len(initial) == 1 else -1) * 3 + fault


@cache
def moves(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest edits over one row, from each state to each: inserts first, then the row's own letter."""
    letter, fault = divmod(kind, 3)
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in STATES:
        state = start
        for inserts in range(4):
            stay = TRUNCATED if fault == CUT else 0
            ends = [(state, DELETE, "D")]
            if fault != UNWANTED:
                ends.append((_NEXT[state], REROLE + stay, "R"))
                kept = {0: SYSTEM, 1: USER, 2: ASSISTANT}.get(letter)
                if kept == _NEXT[state] or kept == SYSTEM and state == START:
                    ends.append((kept, stay, "K"))
            for end, cost, name in ends:
                found = INSERT * inserts + cost, "I" * inserts + name
                best[start, end] = min(best.get((start, end), found), found)
            state = _NEXT[state]
    return best


def alone(state: int) -> Vector:
    """The vector of a known state."""
    return tuple(0 if s == state else NEVER for s in STATES), (0,) * 4


def _ranked(found: list[tuple[int, tuple] | None]) -> tuple[int, Vector]:
    """(smallest cost, vector) of the best (cost, audit's place) of each state."""
    least = min(f[0] for f in found if f)
    order = sorted((f[1], s) for s, f in enumerate(found) if f)
    ranks = [0] * 4
    for place, (_, s) in enumerate(order):
        ranks[s] = place
    return least, (tuple(f[0] - least if f else NEVER for f in found), tuple(ranks))


@cache
def forward(vector: Vector, kind: int) -> tuple[int, Vector]:
    """(cost to add, vector) behind one more row."""
    costs, ranks = vector
    found: list = [None] * 4
    for (s, t), (cost, audit) in moves(kind).items():
        if costs[s] < NEVER:
            new = costs[s] + cost, (ranks[s], audit)
            found[t] = new if found[t] is None else min(found[t], new)
    return _ranked(found)


@cache
def backward(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    """Costs from each state before a row to where ``costs`` lead from behind it; less the smallest."""
    found = [NEVER] * 4
    for (s, t), (cost, _) in moves(kind).items():
        if costs[t] < NEVER:
            found[s] = min(found[s], cost + costs[t])
    least = min(found)
    return tuple(c - least if c < NEVER else NEVER for c in found)


# A segment: for each state before it, (cost, vector) behind it.
Segment = tuple[tuple[int, Vector], ...]


def over(kinds: Sequence[int], state: int) -> tuple[int, Vector]:
    """(cost, vector) behind rows that start in a state."""
    total, vector = 0, alone(state)
    for kind in kinds:
        cost, vector = forward(vector, kind)
        total += cost
    return total, vector


def segment(kinds: Sequence[int]) -> Segment:
    """What rows do to each state before them: all that is needed to put them behind others."""
    return tuple(over(kinds, s) for s in STATES)


def forward_segment(vector: Vector, part: Segment) -> tuple[int, Vector]:
    """As ``forward``, over a segment."""
    costs, ranks = vector
    found: list = [None] * 4
    for s in STATES:
        if costs[s] < NEVER:
            total, (behind, order) = part[s]
            for t in STATES:
                if behind[t] < NEVER:
                    new = costs[s] + total + behind[t], (ranks[s], order[t])
                    found[t] = new if found[t] is None else min(found[t], new)
    return _ranked(found)


def backward_segment(costs: tuple[int, ...], part: Segment) -> tuple[int, ...]:
    """As ``backward``, over a segment."""
    found = [
        min((total + behind[t] + costs[t] for t in STATES if behind[t] < NEVER and costs[t] < NEVER), default=NEVER)
        for total, (behind, _) in part
    ]
    least = min(found)
    return tuple(c - least if c < NEVER else NEVER for c in found)


def crossings(
    steps: Sequence, before: int, behind: int, forth: Callable = forward, back: Callable = backward
) -> Iterator[tuple[int, int]]:
    """(state before, state behind) of each step on the best way between two states: rows, or segments with the
    functions for them."""
    todo = [(0, len(steps), before, behind)]
    while todo:
        low, high, s, t = todo.pop()
        if high - low < 2:
            if high > low:
                yield s, t
            continue
        middle = (low + high) // 2
        vector = alone(s)
        for i in range(low, middle):
            _, vector = forth(vector, steps[i])
        costs = alone(t)[0]
        for i in range(high - 1, middle - 1, -1):
            costs = back(costs, steps[i])
        ways = [(f + b, rank, c) for c, (f, b, rank) in enumerate(zip(vector[0], costs, vector[1], strict=True))]
        meet = min(w for w in ways if w[0] < NEVER)[2]
        todo += [(middle, high, meet, t), (low, middle, s, meet)]


def best_end(total: int, vector: Vector) -> tuple[int, int]:
    """(cost with the inserts at the end, state before them) of a whole conversation."""
    costs, ranks = vector
    ends = [(total + costs[s] + INSERT * TAIL[s], ranks[s], s) for s in STATES if costs[s] < NEVER]
    cost, _, state = min(ends)
    return cost, state


def lines(state: int, audit: str) -> Iterator[tuple[str, str | None]]:
    """(letter, role given) of each edit of a row from a state on; a kept row's role is its own, a deleted row has none."""
    for letter in audit:
        if letter in "IR":
            state = _NEXT[state]
        yield letter, ROLE[state] if letter in "IR" else None
