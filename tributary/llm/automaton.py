"""Rules compiled to one deterministic automaton over bytes.

Each rule's regular expression becomes a small nondeterministic automaton. Subset construction runs over all rules at
once; a state is, for every rule, the sets of places reached by its possible starts, the earliest start first. Once the
earliest start has matched, later ones are dropped and none begins until the match ends: leftmost, non-overlapping
matches. Equivalent states are then merged (partition refinement), bytes that no state tells apart share a column, and
the result is one transition array. Where a match begins is found by the same construction on the reversed rule.

Rules have to be such that a match, once complete, only grows while it stays complete. Compilation checks that.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser as parser
from typing import NamedTuple

import numpy as np

Places = frozenset


class Nfa:
    """Places joined by byte sets or by nothing, with one entry and one exit."""

    def __init__(self, pattern: str, reverse: bool = False):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []
        tree = parser.parse(pattern)
        self.ignore_case = bool(tree.state.flags & parser.SRE_FLAG_IGNORECASE)
        self.reverse = reverse
        entry, exit_ = self.sequence(tree)
        self.entry, self.exit = (entry, exit_)

    def place(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def sequence(self, items) -> tuple[int, int]:
        begin = end = self.place()
        for item in reversed(list(items)) if self.reverse else items:
            a, b = self.piece(*item)
            self.free[end].append(a)
            end = b
        return begin, end

    def piece(self, kind, value) -> tuple[int, int]:
        if kind is op.SUBPATTERN:
            return self.sequence(value[-1])
        if kind is op.BRANCH:
            a, b = self.place(), self.place()
            for branch in value[1]:
                c, d = self.sequence(branch)
                self.free[a].append(c)
                self.free[d].append(b)
            return a, b
        if kind is op.MAX_REPEAT:
            low, high, items = value
            begin = end = self.place()
            for _ in range(low):
                a, b = self.sequence(items)
                self.free[end].append(a)
                end = b
            if high is op.MAXREPEAT:
                a, b = self.sequence(items)
                after = self.place()
                self.free[end] += [a, after]
                self.free[b] += [a, after]
                return begin, after
            after = self.place()
            for _ in range(high - low):
                self.free[end].append(after)
                a, b = self.sequence(items)
                self.free[end].append(a)
                end = b
            self.free[end].append(after)
            return begin, after
        a, b = self.place(), self.place()
        self.steps[a].append((self.bytes_of(kind, value), b))
        return a, b

    def bytes_of(self, kind, value) -> frozenset[int]:
        if kind is op.LITERAL:
            found = {value}
        elif kind is op.IN:
            if value[0][0] is op.NEGATE:
                raise ValueError("negated sets are not supported")
            found = set()
            for k, v in value:
                if k is op.LITERAL:
                    found.add(v)
                elif k is op.RANGE:
                    found.update(range(v[0], v[1] + 1))
                else:
                    raise ValueError(f"unsupported set member {k}")
        else:
            raise ValueError(f"unsupported expression {kind}")
        if max(found) > 127:
            raise ValueError("rules are ASCII only")
        if self.ignore_case:
            found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
        return frozenset(found)

    def closure(self, places) -> Places:
        seen, todo = set(places), list(places)
        while todo:
            for q in self.free[todo.pop()]:
                if q not in seen:
                    seen.add(q)
                    todo.append(q)
        return frozenset(q for q in seen if self.steps[q] or q == self.exit)

    def step(self, places: Places, byte: int) -> Places:
        return self.closure({q for p in places for own, q in self.steps[p] if byte in own})

    def alphabet(self) -> set[frozenset[int]]:
        return {own for steps in self.steps for own, _ in steps}


class Tables(NamedTuple):
    """``column`` of each byte, ``to[state, column]``, and the rules that ``state`` has matched, as bits."""

    column: np.ndarray
    to: np.ndarray
    matched: np.ndarray


def byte_columns(nfas: list[Nfa]) -> tuple[np.ndarray, list[int]]:
    """Bytes in the same sets of every rule share a column; one byte for each column."""
    sets = sorted({s for n in nfas for s in n.alphabet()}, key=sorted)
    kinds: dict[tuple, int] = {}
    column = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)], np.uint8)
    return column, [int(np.flatnonzero(column == c)[0]) for c in range(len(kinds))]


def minimise(to: np.ndarray, matched: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges states that no input tells apart; state 0 stays first."""
    part = np.unique(matched, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([part, part[to]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    first = np.unique(part, return_index=True)[1]
    order = np.argsort(first)  # by first appearance, so the start keeps number 0
    name = np.empty(len(order), np.int64)
    name[order] = np.arange(len(order))
    first = np.sort(first)
    return name[part[to[first]]], matched[first]


def construct(start, advance, matched_of, columns: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """All states that ``advance`` reaches from ``start``, as a transition array."""
    number, rows, todo = {start: 0}, [], [start]
    while todo:
        following = []
        for state in todo:
            row = []
            for byte in columns:
                to = advance(state, byte)
                if to not in number:
                    number[to] = len(number)
                    following.append(to)
                row.append(number[to])
            rows.append(row)
        todo = following
    return np.array(rows, np.int32), np.array([matched_of(s) for s in number], np.int64)


def scanner(patterns: list[str]) -> Tables:
    """The automaton that looks for all rules at once from any position."""
    nfas = [Nfa(p) for p in patterns]
    column, columns = byte_columns(nfas)
    starts = [n.closure({n.entry}) for n in nfas]
    if any(n.exit in s for n, s in zip(nfas, starts)):
        raise ValueError("a rule matches nothing")

    def follow(nfa: Nfa, start: Places, threads: tuple[Places, ...], byte: int) -> tuple[Places, ...]:
        if threads and nfa.exit in threads[0]:
            going = nfa.step(threads[0], byte)
            if going:
                if nfa.exit not in going:
                    raise ValueError("a match can be complete and then grow incomplete")
                return (going,)
            threads = ()
        seen: set[int] = set()
        out: list[Places] = []
        for thread in (*threads, start):
            fresh = nfa.step(thread, byte) - seen
            if fresh:
                if nfa.exit in fresh:
                    if out:
                        raise ValueError("a later start can match before an earlier one is done")
                    return (fresh,)
                out.append(fresh)
                seen |= fresh
        return tuple(out)

    def advance(state, byte: int):
        return tuple(follow(n, s, t, byte) for n, s, t in zip(nfas, starts, state))

    def matched_of(state) -> int:
        return sum(1 << i for i, (n, t) in enumerate(zip(nfas, state)) if t and n.exit in t[0])

    to, matched = construct(tuple(() for _ in nfas), advance, matched_of, columns)
    return Tables(column, *minimise(to, matched))


def anchored(pattern: str, reverse: bool = False) -> Tables:
    """The automaton that matches a rule from a given position; state 0 starts, and a state without way out is dead."""
    nfa = Nfa(pattern, reverse)
    column, columns = byte_columns([nfa])
    to, matched = construct(nfa.closure({nfa.entry}), nfa.step, lambda s: int(nfa.exit in s), columns)
    return Tables(column, *minimise(to, matched))
