"""One deterministic byte automaton for many regular expressions.

``compile_rules`` parses each expression, builds one nondeterministic automaton with an end per rule, makes it
deterministic by subset construction over classes of bytes that no expression tells apart, minimises it by partition
refinement and lays it out as transition arrays. Expressions are made of ASCII characters, ``[...]`` classes,
groups, ``|``, ``? * +``, ``{m}``, ``{m,}`` and ``{m,n}``; ``\\xHH`` and a backslash before a sign stand for that
character. Characters beyond ASCII are in no expression, so a match begins and ends between characters of UTF-8.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

# An automaton of more states is refused: rules that count over each other's characters multiply.
MOST_STATES = 20_000

# A tree is a frozenset of bytes, ("then", parts), ("or", parts) or ("times", part, least, most or None).
Tree = frozenset | tuple


class RuleError(ValueError):
    """An expression is not well-formed, matches the empty text or needs too many states."""


class _Parser:
    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self, least: int = 1) -> str:
        found = self.text[self.at:self.at + least]
        if len(found) < least:
            raise RuleError(f"{self.text!r} ends too early")
        self.at += least
        return found

    def whole(self) -> Tree:
        tree = self.either()
        if self.peek():
            raise RuleError(f"{self.text!r}: unexpected {self.peek()!r} at {self.at}")
        return tree

    def either(self) -> Tree:
        arms = [self.row()]
        while self.peek() == "|":
            self.take()
            arms.append(self.row())
        return arms[0] if len(arms) == 1 else ("or", arms)

    def row(self) -> Tree:
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.one()))
        return ("then", parts)

    def one(self) -> Tree:
        sign = self.take()
        if sign == "(":
            tree = self.either()
            if self.peek() != ")":
                raise RuleError(f"{self.text!r}: a group is not closed")
            self.take()
            return tree
        if sign == "[":
            return self.members()
        if sign in "?*+{}":
            raise RuleError(f"{self.text!r}: nothing to repeat at {self.at - 1}")
        return frozenset([self.character(sign)])

    def character(self, sign: str) -> int:
        if sign == "\\":
            sign = self.take()
            if sign == "x":
                return int(self.take(2), 16)
            if sign.isalnum():
                raise RuleError(f"{self.text!r}: \\{sign} is not known")
        if ord(sign) > 127:
            raise RuleError(f"{self.text!r}: {sign!r} is not ASCII")
        return ord(sign)

    def members(self) -> frozenset:
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.character(self.take())
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] not in ("]", ""):
                self.take()
                high = self.character(self.take())
            found.update(range(low, high + 1))
        self.take()
        return frozenset(found)

    def repeated(self, tree: Tree) -> Tree:
        while (sign := self.peek()) and sign in "?*+{":
            if sign == "{":
                counts = re.compile(r"\{(\d+)(,?)(\d*)\}").match(self.text, self.at)
                if not counts:
                    raise RuleError(f"{self.text!r}: a count is not closed")
                self.at = counts.end()
                least = int(counts[1])
                most = int(counts[3]) if counts[3] else None if counts[2] else least
            else:
                self.take()
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            tree = ("times", tree, least, most)
        return tree


def _backwards(tree: Tree) -> Tree:
    if isinstance(tree, frozenset):
        return tree
    if tree[0] == "times":
        return ("times", _backwards(tree[1]), *tree[2:])
    parts = [_backwards(part) for part in tree[1]]
    return (tree[0], parts[::-1] if tree[0] == "then" else parts)


class _Nondeterministic:
    """States with silent steps and steps on a set of bytes."""

    def __init__(self) -> None:
        self.silent: list[list[int]] = []
        self.steps: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.silent.append([])
        self.steps.append([])
        return len(self.silent) - 1

    def add(self, tree: Tree, start: int) -> int:
        """Build ``tree`` from ``start`` on; the state it ends in."""
        if isinstance(tree, frozenset):
            end = self.state()
            self.steps[start].append((tree, end))
            return end
        if tree[0] == "then":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if tree[0] == "or":
            end = self.state()
            for part in tree[1]:
                first = self.state()
                self.silent[start].append(first)
                self.silent[self.add(part, first)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            again = self.state()
            self.silent[start].append(again)
            self.silent[self.add(part, again)].append(again)
            return again
        end = self.state()
        for _ in range(most - least):
            self.silent[start].append(end)
            start = self.add(part, start)
        self.silent[start].append(end)
        return end

    def closed(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for after in self.silent[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``classes`` has the class of each byte, ``moves`` the state after (state, class), flat; ``ends`` the rules (a
    bit each) that match up to a state. State 0 is the start; ``dead`` leads nowhere, or is -1."""

    classes: np.ndarray
    moves: np.ndarray
    ends: np.ndarray
    dead: int

    @property
    def width(self) -> int:
        return len(self.moves) // len(self.ends)


def _byte_classes(sets: set[frozenset]) -> tuple[np.ndarray, list[int]]:
    """The class of each byte, and a byte of each class: bytes of one class are in the same sets."""
    ordered = sorted(sets, key=sorted)
    kinds: dict[tuple, int] = {}
    classes = np.array([kinds.setdefault(tuple(b in s for s in ordered), len(kinds)) for b in range(256)], np.intp)
    return classes, [int(np.flatnonzero(classes == k)[0]) for k in range(len(kinds))]


def _minimal(moves: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no text tells apart, by refining the partition given by ``ends`` until it stands."""
    group = np.unique(ends, return_inverse=True)[1].ravel()
    count = 0
    while count != (count := int(group.max()) + 1) or count == 0:
        signs = np.column_stack([group, group[moves]])
        group = np.unique(signs, axis=0, return_inverse=True)[1].ravel()
    # Number the groups in the order in which their first states were found, so the start stays state 0.
    first = np.full(count, len(group))
    np.minimum.at(first, group, np.arange(len(group)))
    order = np.argsort(first)
    place = np.empty(count, np.intp)
    place[order] = np.arange(count)
    return place[group[moves[first[order]]]], ends[first[order]]


def compile_rules(patterns: Sequence[str], backwards: bool = False, anywhere: bool = False) -> Automaton:
    """The minimal automaton of all ``patterns``; rule k is bit k of ``ends``.

    With ``anywhere`` a match may begin at every byte, else only at the first; with ``backwards`` it reads texts from
    their end, so ``ends`` tell where matches begin.
    """
    if len(patterns) > 62:
        raise RuleError("more than 62 rules")
    net = _Nondeterministic()
    start, last = net.state(), {}
    for k, pattern in enumerate(patterns):
        tree = _Parser(pattern).whole()
        first = net.state()
        net.silent[start].append(first)
        last[net.add(_backwards(tree) if backwards else tree, first)] = 1 << k
    classes, example = _byte_classes({s for steps in net.steps for s, _ in steps})
    initial = net.closed([start])
    if any(s in last for s in initial):
        raise RuleError("a rule matches the empty text")
    # Where each state leads on each class of bytes, silent steps taken.
    leads: list[dict[int, frozenset[int]]] = [
        {kind: net.closed(after) for kind, byte in enumerate(example) if (after := [to for chars, to in steps if byte in chars])}
        for steps in net.steps]
    number, todo, rows = {initial: 0}, [initial], []
    while todo:
        for subset in todo:
            after: list[set[int]] = [set(initial) if anywhere else set() for _ in example]
            for state in subset:
                for kind, states in leads[state].items():
                    after[kind] |= states
            rows.append([number.setdefault(frozenset(states), len(number)) for states in after])
        if len(number) > MOST_STATES:
            raise RuleError(f"the rules need more than {MOST_STATES} states")
        todo = list(number)[len(rows):]
    ends = np.array([sum({last[s] for s in subset if s in last}) for subset in number], np.int64)
    moves, ends = _minimal(np.array(rows, np.intp), ends)
    still = [k for k in range(len(ends)) if not ends[k] and (moves[k] == k).all()]
    return Automaton(classes, moves.ravel(), ends, still[0] if still and not anywhere else -1)
