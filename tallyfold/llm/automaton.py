"""Regular expressions to one minimal automaton over bytes.

The accepted syntax is what secret rules need: literals, escapes, ``.``,
classes, groups, alternatives and the repetitions ``? * + {m} {m,} {m,n}``.
Expressions are over ASCII; other bytes only match negated classes and ``.``.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import numpy as np

_CLASSES = {"d": "0123456789", "w": "0-9A-Z_a-z", "s": " \t\n\r\f\v"}
_CONTROL = {"n": 10, "r": 13, "t": 9, "f": 12, "v": 11}
ALL = frozenset(range(256))


class _Parser:
    """An expression as a tree of ``('set', bytes)``, ``('cat', …)``, ``('alt', …)`` and ``('rep', node, m, n)``."""

    def __init__(self, text: str, ignore_case: bool) -> None:
        self.text, self.at, self.ignore_case = text, 0, ignore_case

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def take(self) -> str:
        c = self.peek()
        if not c:
            raise ValueError(f"expression ends early: {self.text}")
        self.at += 1
        return c

    def parse(self):
        tree = self.alternatives()
        if self.peek():
            raise ValueError(f"unexpected {self.peek()!r} in {self.text}")
        return tree

    def alternatives(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        node = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                low, _, high = (bounds := self.until("}")).partition(",")
                low, high = int(low), (None if "," in bounds and not high else int(high or low))
            else:
                low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, low, high)
        return node

    def until(self, end: str) -> str:
        stop = self.text.index(end, self.at)
        got, self.at = self.text[self.at:stop], stop + 1
        return got

    def atom(self):
        c = self.take()
        if c == "(":
            if self.text[self.at:self.at + 2] == "?:":
                self.at += 2
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"missing ) in {self.text}")
            return node
        if c == "[":
            return ("set", self.char_class())
        if c == ".":
            return ("set", ALL - {10})
        return ("set", self.cased(self.escape() if c == "\\" else {self.code(c)}))

    def code(self, c: str) -> int:
        if ord(c) > 127:
            raise ValueError(f"not ASCII: {c!r} in {self.text}")
        return ord(c)

    def escape(self) -> set[int]:
        c = self.take()
        if c == "x":
            self.at += 2
            return {int(self.text[self.at - 2:self.at], 16)}
        if c.lower() in _CLASSES:
            found = _Parser("[" + _CLASSES[c.lower()] + "]", False).atom()[1]
            return set(ALL - found) if c.isupper() else set(found)
        return {_CONTROL.get(c, self.code(c))}

    def char_class(self) -> frozenset[int]:
        negated, found, first = self.peek() == "^", set(), True
        if negated:
            self.take()
        while first or self.peek() != "]":
            first = False
            c = self.take()
            low = self.escape() if c == "\\" else {self.code(c)}
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] not in ("]", ""):
                self.take()
                c = self.take()
                high = self.escape() if c == "\\" else {self.code(c)}
                low = set(range(min(low), max(high) + 1))
            found |= low
        self.take()
        found = self.cased(found)
        return ALL - found if negated else frozenset(found)

    def cased(self, found: Iterable[int]) -> frozenset[int]:
        found = set(found)
        if self.ignore_case:
            found |= {c ^ 32 for c in found if 65 <= c & ~32 <= 90}
        return frozenset(found)


class _Graph:
    """Nondeterministic automaton: byte-set steps and free steps."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node, start: int, reverse: bool) -> int:
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.steps[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in reversed(node[1]) if reverse else node[1]:
                start = self.add(part, start, reverse)
            return start
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                begin = self.state()
                self.free[start].append(begin)
                self.free[self.add(part, begin, reverse)].append(end)
            return end
        _, part, low, high = node
        for _ in range(low):
            start = self.add(part, start, reverse)
        if high is None:
            loop, end = self.state(), self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop, reverse)].append(loop)
            self.free[loop].append(end)
            return end
        end = self.state()
        self.free[start].append(end)
        for _ in range(high - low):
            start = self.add(part, start, reverse)
            self.free[start].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in found:
                    found.add(x)
                    todo.append(x)
        return frozenset(found)


def compile_rules(
    rules: list[tuple[str, bool]], reverse: bool = False, anywhere: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """``(next, accepts)`` of the minimal automaton of all rules ``(expression, ignore_case)``.

    ``next[state, byte]`` is the following state and 0 the first one;
    ``accepts[state]`` has bit r set where rule r matches. ``reverse`` reads
    from right to left; ``anywhere`` lets a match begin at any byte.
    """
    graph = _Graph()
    top, ends = graph.state(), []
    for text, ignore_case in rules:
        begin = graph.state()
        graph.free[top].append(begin)
        ends.append(graph.add(_Parser(text, ignore_case).parse(), begin, reverse))
    # Bytes that no rule tells apart share a column.
    signature: dict[int, int] = {c: 0 for c in range(256)}
    for chars in {chars for steps in graph.steps for chars, _ in steps}:
        names: dict[tuple[int, bool], int] = {}
        signature = {c: names.setdefault((s, c in chars), len(names)) for c, s in signature.items()}
    columns = sorted(set(signature.values()))
    byte_of = {k: next(c for c in range(256) if signature[c] == k) for k in columns}

    first = graph.closure([top])
    number, order, table, todo = {first: 0}, [first], [], deque([first])
    while todo:
        states, row = todo.popleft(), []
        for k in columns:
            c = byte_of[k]
            to = {y for x in states for chars, y in graph.steps[x] if c in chars}
            after = graph.closure(to | {top} if anywhere else to)
            if after not in number:
                number[after] = len(order)
                order.append(after)
                todo.append(after)
            row.append(number[after])
        table.append(row)
    accepts = np.array([sum(1 << r for r, e in enumerate(ends) if e in s) for s in order], np.int64)
    classes = minimal(np.array(table), accepts)
    members = np.unique(classes, return_index=True)[1]
    small = classes[np.array(table)[members]]
    column = np.array([columns.index(signature[c]) for c in range(256)])
    return small[:, column].astype(np.int32), accepts[members]


def minimal(table: np.ndarray, accepts: np.ndarray) -> np.ndarray:
    """Class of each state, states of a class being equivalent; the first state is in class 0.

    Moore's refinement: classes are divided until all members step to the same classes.
    """
    _, classes = np.unique(accepts, return_inverse=True)
    while True:
        keys = np.column_stack([classes, classes[table]])
        _, first, finer = np.unique(keys, axis=0, return_index=True, return_inverse=True)
        # Number classes by their first member, so that the start stays 0.
        rank = np.empty(len(first), np.int64)
        rank[np.argsort(first)] = np.arange(len(first))
        finer = rank[finer.reshape(-1)]
        if len(first) == len(np.unique(classes)):
            return finer
        classes = finer
