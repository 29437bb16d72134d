"""Rules compiled into one minimal deterministic automaton over bytes, and the scan that runs it.

A rule is a prefix followed by one or more bytes of a class, taken greedily. Its matches are leftmost and do not
overlap; one is reported from a least number of class bytes on, shorter ones are consumed all the same. Subset
construction keeps, for each rule, its live attempts oldest first: an attempt that has matched cancels younger ones.
The product of all rules is minimised, so one pass finds the ends of the matches of every rule. Their starts are
found by the reversed rule, run backwards over the match only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SEPARATOR = 0xFF  # never occurs in UTF-8; ends every attempt
LANE = 512  # bytes that one lane of the scan takes


# Patterns: nested tuples ("set", bytes), ("seq", parts), ("alt", parts), ("opt" | "star" | "plus", part).


def one_of(members: bytes) -> tuple:
    return "set", frozenset(members)


def span(*ranges: str) -> bytes:
    """Bytes of the ASCII ranges "az", "09" and so on."""
    return bytes(c for r in ranges for c in range(ord(r[0]), ord(r[1]) + 1))


def literal(text: str, any_case: bool = False) -> tuple:
    both = (lambda c: c.lower() + c.upper()) if any_case else (lambda c: c)
    return "seq", tuple(one_of(both(c).encode()) for c in text)


def seq(*parts: tuple) -> tuple:
    return "seq", parts


def alt(*parts: tuple) -> tuple:
    return "alt", parts


def optional(part: tuple) -> tuple:
    return "opt", part


def star(part: tuple) -> tuple:
    return "star", part


def plus(part: tuple) -> tuple:
    return "plus", part


def reverse(pattern: tuple) -> tuple:
    kind, inner = pattern
    if kind == "set":
        return pattern
    if kind == "seq":
        return kind, tuple(map(reverse, inner[::-1]))
    return kind, tuple(map(reverse, inner)) if kind == "alt" else reverse(inner)


@dataclass(frozen=True)
class Rule:
    """prefix and then members+; reported from least members and from shortest bytes in all."""

    name: str
    prefix: tuple
    members: bytes
    least: int = 1
    shortest: int = 0


class Nfa:
    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset, int]]] = [[]]
        self.free: list[list[int]] = [[]]

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, pattern: tuple, start: int) -> int:
        """Build the pattern from a state on; the state after it."""
        kind, inner = pattern
        if kind == "set":
            end = self.state()
            self.moves[start].append((inner, end))
        elif kind == "seq":
            end = start
            for part in inner:
                end = self.add(part, end)
        elif kind == "alt":
            end = self.state()
            for part in inner:
                self.free[self.add(part, start)].append(end)
        else:
            begin, end = self.state(), self.state()
            self.free[start].append(begin)
            after = self.add(inner, begin)
            self.free[after].append(end)
            if kind != "plus":
                self.free[begin].append(end)
            if kind != "opt":
                self.free[after].append(begin)
        return end

    def closed(self, states: set[int] | frozenset[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in found:
                    found.add(x)
                    todo.append(x)
        return frozenset(found)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed({to for s in states for members, to in self.moves[s] if byte in members})


def _search(rule: Rule, bytes_of_class: list[int]) -> tuple[list[list[int]], list[int]]:
    """Transitions by class and the label (1 consumed, 2 reported) of each state of a rule's search automaton."""
    nfa = Nfa()
    at = nfa.add(rule.prefix, 0)
    counts = []
    for _ in range(rule.least):
        at = nfa.add(one_of(rule.members), at)
        counts.append(at)
    nfa.moves[at].append((frozenset(rule.members), at))
    accepting, reported = frozenset(counts), counts[-1]
    fresh = nfa.closed({0})

    def follow(attempts: tuple, byte: int) -> tuple:
        if attempts and attempts[0] & accepting:
            longer = nfa.step(attempts[0], byte)
            if longer:
                assert longer & accepting, "a match may only be extended by longer matches"
                return (longer,)
            attempts = ()
        found, seen = [], set()
        for old in (*attempts, fresh):
            new = nfa.step(old, byte) - seen
            if new:
                found.append(new)
                seen |= new
        return tuple(found[:1] if found and found[0] & accepting else found)

    number: dict[tuple, int] = {(): 0}
    states, table = [()], []
    for attempts in states:  # grows
        row = []
        for byte in bytes_of_class:
            to = follow(attempts, byte)
            if to not in number:
                number[to] = len(states)
                states.append(to)
            row.append(number[to])
        table.append(row)
    return table, [(2 if reported in s[0] else 1) if s and s[0] & accepting else 0 for s in states]


def _minimal(table: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart (refinement until nothing splits); state 0 stays the first."""
    block = np.unique(labels, axis=0, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    order = {b: k for k, b in enumerate(dict.fromkeys(block.tolist()))}
    block = np.array([order[b] for b in block.tolist()])
    first = np.array([np.flatnonzero(block == k)[0] for k in range(len(order))])
    return block[table[first]], labels[first]


@dataclass(frozen=True)
class Automaton:
    rules: tuple[Rule, ...]
    class_of: np.ndarray  # by byte
    table: np.ndarray  # next state's first index, by state * classes + class
    consumed: np.ndarray  # by state, a bit for each rule
    reported: np.ndarray
    backwards: tuple  # by rule: (next state by state and byte, -1 where there is none; accepting states)

    @property
    def classes(self) -> int:
        return int(self.class_of.max()) + 1

    def states(self, data: np.ndarray) -> np.ndarray:
        """The state after each byte, from one pass over all lanes side by side.

        Each lane starts as if nothing came before it. Where something did, the scan is run again from the end of the
        lane before, across later lanes too, until both runs agree.
        """
        lanes = max(1, -(-len(data) // LANE))
        padded = np.full(lanes * LANE, SEPARATOR, np.uint8)
        padded[: len(data)] = data
        classes = self.class_of[padded]
        columns = classes.reshape(lanes, LANE).T.copy()
        found = np.empty((LANE, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        for k in range(LANE):
            now = self.table.take(now + columns[k])
            found[k] = now
        found = found.T.ravel()
        starts = np.arange(LANE, len(found), LANE)
        for k in starts[self.table[found[starts - 1] + classes[starts]] != found[starts]].tolist():
            state = found[k - 1]
            while k < len(found) and (state := self.table[state + classes[k]]) != found[k]:
                found[k] = state
                k += 1
        return found[: len(data)] // self.classes

    def matches(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """(rule number, start, end) in bytes of every reported match, by end; the data ends with SEPARATOR."""
        raw = np.frombuffer(data, np.uint8)
        states = self.states(raw)
        reported, consumed = self.reported[states], self.consumed[states]
        ends = np.flatnonzero(reported[:-1] & ~consumed[1:]) + 1
        for end in ends.tolist():
            bits = int(reported[end - 1] & ~consumed[end])
            for number, rule in enumerate(self.rules):
                if bits >> number & 1:
                    start = self._start(data, consumed, number, end)
                    if end - start >= rule.shortest:
                        yield number, start, end

    def _start(self, data: bytes, consumed: np.ndarray, number: int, end: int) -> int:
        """The leftmost start of the match that ends here, after any earlier match of the rule."""
        table, accepting = self.backwards[number]
        state, start, bit = 0, end, 1 << number
        for k in range(end - 1, -1, -1):
            if k + 1 < end and consumed[k] & bit and not consumed[k + 1] & bit:
                break
            state = table[state][data[k]]
            if state < 0:
                break
            if accepting[state]:
                start = k
        return start


def _backwards(rule: Rule) -> tuple[list[list[int]], list[bool]]:
    nfa = Nfa()
    end = nfa.add(seq(plus(one_of(rule.members)), reverse(rule.prefix)), 0)
    number, states, table = {nfa.closed({0}): 0}, [nfa.closed({0})], []
    for states_now in states:  # grows
        row = []
        for byte in range(256):
            to = nfa.step(states_now, byte)
            if to and to not in number:
                number[to] = len(states)
                states.append(to)
            row.append(number[to] if to else -1)
        table.append(row)
    return table, [end in s for s in states]


def _members(pattern: tuple) -> Iterator[frozenset]:
    kind, inner = pattern
    if kind == "set":
        yield inner
    elif kind in ("seq", "alt"):
        for part in inner:
            yield from _members(part)
    else:
        yield from _members(inner)


@lru_cache(maxsize=4)
def build(rules: tuple[Rule, ...]) -> Automaton:
    sets = [s for r in rules for s in (*_members(r.prefix), frozenset(r.members))]
    signatures = [tuple(b in s for s in sets) for b in range(256)]
    number = {s: k for k, s in enumerate(dict.fromkeys(signatures))}
    class_of = np.array([number[s] for s in signatures], np.int32)
    samples = [signatures.index(s) for s in number]
    parts = [_search(r, samples) for r in rules]

    index: dict[tuple, int] = {(0,) * len(rules): 0}
    states, table = [(0,) * len(rules)], []
    for state in states:  # grows
        row = []
        for c in range(len(samples)):
            to = tuple(part[0][s][c] for part, s in zip(parts, state))
            if to not in index:
                index[to] = len(states)
                states.append(to)
            row.append(index[to])
        table.append(row)
    labels = np.array([[part[1][s] for part, s in zip(parts, state)] for state in states])
    small, labels = _minimal(np.array(table), labels)
    bits = 1 << np.arange(len(rules))
    return Automaton(
        rules,
        class_of,
        (small * len(samples)).astype(np.int32).ravel(),
        ((labels > 0) * bits).sum(axis=1).astype(np.int32),
        ((labels == 2) * bits).sum(axis=1).astype(np.int32),
        tuple(map(_backwards, rules)),
    )
