"""Regular expressions compiled to minimal deterministic byte automata.

The dialect is what secret rules need: literals, `.`-free classes, groups, alternation and the
quantifiers ? * + {m} {m,} {m,n}. Subset construction runs over byte classes (bytes that no rule
tells apart share a column), Moore refinement minimises, and the result is a transition array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Nfa:
    """Thompson automaton; an edge is (set of bytes or None for an empty move, target)."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int] | None, int]]] = []

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def edge(self, a: int, on: frozenset[int] | None, b: int) -> None:
        self.edges[a].append((on, b))


def parse(pattern: str, ignore_case: bool = False):
    """Syntax tree: ("set", bytes), ("cat", [..]), ("alt", [..]) or ("rep", node, least, most or None)."""
    at = 0

    def fold(chars: set[int]) -> frozenset[int]:
        if ignore_case:
            chars |= {ord(chr(c).swapcase()) for c in chars if chr(c).isascii() and chr(c).isalpha()}
        return frozenset(chars)

    def escaped() -> int:
        nonlocal at
        at += 1
        if pattern[at] == "x":
            at += 3
            return int(pattern[at - 2 : at], 16)
        at += 1
        return ord(pattern[at - 1])

    def char() -> int:
        nonlocal at
        if pattern[at] == "\\":
            return escaped()
        at += 1
        return ord(pattern[at - 1])

    def alternatives():
        nonlocal at
        branches = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            branches.append(sequence())
        return ("alt", branches)

    def sequence():
        items = []
        while at < len(pattern) and pattern[at] not in "|)":
            items.append(repeated())
        return ("cat", items)

    def repeated():
        nonlocal at
        node = atom()
        while at < len(pattern) and pattern[at] in "?*+{":
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(pattern[at], (0, 0))
            if pattern[at] == "{":
                end = pattern.index("}", at)
                low, comma, high = pattern[at + 1 : end].partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
                at = end
            at += 1
            node = ("rep", node, least, most)
        return node

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            node = alternatives()
            at += 1
            return node
        if pattern[at] == "[":
            at += 1
            chars: set[int] = set()
            while pattern[at] != "]":
                low = char()
                if pattern[at] == "-" and pattern[at + 1] != "]":
                    at += 1
                    chars |= set(range(low, char() + 1))
                else:
                    chars.add(low)
            at += 1
            return ("set", fold(chars))
        return ("set", fold({char()}))

    return alternatives()


def _build(nfa: _Nfa, node, start: int, backwards: bool) -> int:
    """Adds node after state start and returns the state behind it; backwards matches the mirrored words."""
    kind = node[0]
    if kind == "set":
        nfa.edge(start, node[1], end := nfa.state())
        return end
    if kind == "cat":
        for item in reversed(node[1]) if backwards else node[1]:
            start = _build(nfa, item, start, backwards)
        return start
    if kind == "alt":
        end = nfa.state()
        for branch in node[1]:
            nfa.edge(start, None, first := nfa.state())
            nfa.edge(_build(nfa, branch, first, backwards), None, end)
        return end
    _, item, least, most = node
    for _ in range(least):
        start = _build(nfa, item, start, backwards)
    if most is None:
        nfa.edge(start, None, loop := nfa.state())
        nfa.edge(_build(nfa, item, loop, backwards), None, loop)
        return loop
    end = nfa.state()
    nfa.edge(start, None, end)
    for _ in range(most - least):
        start = _build(nfa, item, start, backwards)
        nfa.edge(start, None, end)
    return end


@dataclass(frozen=True)
class Automaton:
    """next[state, class] is the state to go to; accepts[state] a bit for each rule that ends there; state 0 starts.

    dead is the state that nothing leads out of, or -1.
    """

    classes: bytes
    next: np.ndarray
    accepts: np.ndarray
    dead: int

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match of any rule from start on, -1 if there is none."""
        state, end = 0, -1
        for i in range(start, len(data)):
            state = int(self.next[state, self.classes[data[i]]])
            if state == self.dead:
                break
            if self.accepts[state]:
                end = i + 1
        return end


def compile_rules(trees: list, backwards: bool = False, anywhere: bool = False) -> Automaton:
    """One automaton for all rules. anywhere: a match may start at each byte, not at the first only."""
    nfa = _Nfa()
    root = nfa.state()
    finals = {}
    for k, tree in enumerate(trees):
        nfa.edge(root, None, first := nfa.state())
        finals[_build(nfa, tree, first, backwards)] = k
    classes, samples = _byte_classes(nfa)

    closures: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closures:
            seen, todo = {state}, [state]
            while todo:
                for on, to in nfa.edges[todo.pop()]:
                    if on is None and to not in seen:
                        seen.add(to)
                        todo.append(to)
            closures[state] = frozenset(s for s in seen if s in finals or any(on is not None for on, _ in nfa.edges[s]))
        return closures[state]

    moves: dict[int, list[frozenset[int]]] = {}

    def moved(state: int) -> list[frozenset[int]]:
        if state not in moves:
            to: list[set[int]] = [set() for _ in samples]
            for on, target in nfa.edges[state]:
                if on is not None:
                    for c, byte in enumerate(samples):
                        if byte in on:
                            to[c] |= closure(target)
            moves[state] = [frozenset(x) for x in to]
        return moves[state]

    first = closure(root)
    names, rows, todo = {first: 0}, [], [first]
    for subset in todo:  # grows while it is walked
        row = []
        for c in range(len(samples)):
            to = frozenset().union(*(moved(s)[c] for s in subset), first if anywhere else ())
            if to not in names:
                names[to] = len(todo)
                todo.append(to)
            row.append(names[to])
        rows.append(row)
    accepts = np.array([sum(1 << k for k in {finals[s] for s in subset if s in finals}) for subset in todo], dtype=np.int64 if len(trees) < 63 else object)
    return _minimal(classes, np.array(rows, dtype=np.int32).reshape(len(todo), len(samples)), accepts)


def _byte_classes(nfa: _Nfa) -> tuple[bytes, list[int]]:
    """The class of each byte, and one byte of each class."""
    sets = list({on for edges in nfa.edges for on, _ in edges if on is not None})
    kinds: dict[tuple[bool, ...], int] = {}
    samples: list[int] = []
    classes = bytearray()
    for byte in range(256):
        kind = tuple(byte in s for s in sets)
        if kind not in kinds:
            kinds[kind] = len(samples)
            samples.append(byte)
        classes.append(kinds[kind])
    return bytes(classes), samples


def _minimal(classes: bytes, rows: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Moore's refinement: states stay together while they accept alike and lead to the same blocks."""
    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        signature = np.column_stack([block, block[rows]])
        finer = np.unique(signature, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    order: dict[int, int] = {int(block[0]): 0}
    for b in block:
        order.setdefault(int(b), len(order))
    member = np.zeros(len(order), dtype=np.int64)
    for state in range(len(block) - 1, -1, -1):
        member[order[int(block[state])]] = state
    renamed = np.array([order[int(b)] for b in block], dtype=np.int32)
    table = renamed[rows[member]]
    dead = [s for s in range(len(table)) if not accepts[member[s]] and (table[s] == s).all()]
    return Automaton(classes, table, accepts[member], dead[0] if dead else -1)
