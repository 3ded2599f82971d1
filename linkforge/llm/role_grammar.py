"""Generalised LR repair of role sequences (the automaton of operator 12).

``RoleGrammar`` builds the LR(0) automaton of a grammar over role initials.
``Repair`` parses one conversation row by row with a graph-structured stack: a
stack is (state, rest), so stacks share their lower parts. Before a row is
read any number of roles may be inserted; then it is kept, given another role,
or deleted. Stacks that end with the same state on top are merged: the one of
least (cost, audit) stays, an audit being the edits' letters so far.

Audits aren't stored as strings. Those of one moment have all read the same
rows and end with a row's edit, so none is a proper prefix of another; their
order is a rank, and (rank, letters added) orders the next ones. What is kept
for a row is, for each top, the top it came from and the letters added. Rows
whose edits are the same for all live tops are handed out and forgotten, so
memory holds the undecided rows and a few hundred more, not the conversation.

A top whose cost is more than the least one plus ``slack`` is dropped: whatever
it could still do, the cheapest top can do for ``slack`` more. With the rules
below that is one insertion and one deletion. An insertion takes a top from
after u to after a pair and back (two take it from after s to the end of a
pair, which costs less than one of each); what is left is an s, which only the
empty stack can keep and any other can delete. Without this the stack of which
all is deleted would live on, and no row would ever be settled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

RULES = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "TP"), ("T", "P"), ("P", "ua"))
KEEP, REROLE, DELETE, INSERT = "KRDI"
FLUSH_ROWS = 256

Stack = tuple  # (state, rest) or ()


class Costs(NamedTuple):
    keep: int = 0
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


class Move(NamedTuple):
    cost: int
    letters: str
    roles: str
    stack: Stack


class RoleGrammar:
    """LR(0) automaton of ``rules`` (left side, right side as letters); the
    first rule's left side is the start. ``roles`` may be inserted. With other
    rules ``slack`` must be stated; with None no top is dropped."""

    def __init__(self, rules: tuple[tuple[str, str], ...] = RULES, roles: str = "ua", costs: Costs = Costs(),
                 slack: int | None = None):
        self.slack = max(2 * costs.insert, costs.insert + costs.delete) if slack is None and rules == RULES else slack
        self.rules, self.roles, self.costs = (("^", rules[0][0]), *rules), roles, costs
        self.items = [self._closure({(0, 0)})]
        self.go: list[dict[str, int]] = []
        for items in self.items:  # grows while it is read
            after: dict[str, set] = {}
            for r, dot in items:
                if dot < len(self.rules[r][1]):
                    after.setdefault(self.rules[r][1][dot], set()).add((r, dot + 1))
            self.go.append({})
            for symbol, kernel in sorted(after.items()):
                state = self._closure(kernel)
                if state not in self.items:
                    self.items.append(state)
                self.go[-1][symbol] = self.items.index(state)
        self.empty: Stack = (0, ())
        self._moves: dict = {}
        self._ends: dict = {}

    def _closure(self, items: set) -> frozenset:
        todo, found = list(items), set(items)
        while todo:
            r, dot = todo.pop()
            for i, (left, _) in enumerate(self.rules):
                if self.rules[r][1][dot:dot + 1] == left and (i, 0) not in found:
                    found.add((i, 0))
                    todo.append((i, 0))
        return frozenset(found)

    def _reduced(self, stack: Stack) -> list[Stack]:
        """The stack and all that reductions make of it."""
        found = [stack]
        for s in found:  # grows while it is read
            for r, dot in self.items[s[0]]:
                if r and dot == len(self.rules[r][1]):
                    below = s
                    for _ in range(dot):
                        below = below[1]
                    new = (self.go[below[0]][self.rules[r][0]], below)
                    if new not in found:
                        found.append(new)
        return found

    def shift(self, stack: Stack, symbol: str) -> Stack | None:
        """The stack after reading ``symbol``; None where it can't stand. (With
        conflicting reductions the first that fits.)"""
        for s in self._reduced(stack):
            if symbol in self.go[s[0]]:
                return (self.go[s[0]][symbol], s)
        return None

    def accepts(self, stack: Stack) -> bool:
        return any((0, 1) in self.items[s[0]] for s in self._reduced(stack))

    def _inserted(self, stack: Stack) -> Iterator[Move]:
        """The stack with no, one, ... roles inserted, each top once."""
        level, seen = [Move(0, "", "", stack)], set()
        while level:
            level = [m for m in level if m.stack[0] not in seen]
            yield from level
            seen |= {m.stack[0] for m in level}
            level = [Move(m.cost + self.costs.insert, m.letters + INSERT, m.roles + role, new)
                     for m in level for role in self.roles if (new := self.shift(m.stack, role))]

    def moves(self, stack: Stack, initial: str, must_delete: bool, truncated: bool) -> list[Move]:
        """The best ways over one row, one for each top."""
        key = (stack, initial, must_delete, truncated)
        if key not in self._moves:
            best: dict[int, Move] = {}
            fee = self.costs.truncated if truncated else 0
            for m in self._inserted(stack):
                ways = [Move(m.cost + self.costs.delete, m.letters + DELETE, m.roles, m.stack)]
                if not must_delete:
                    if initial and (new := self.shift(m.stack, initial)):
                        ways.append(Move(m.cost + self.costs.keep + fee, m.letters + KEEP, m.roles, new))
                    ways += [Move(m.cost + self.costs.rerole + fee, m.letters + REROLE, m.roles + role, new)
                             for role in self.roles if (new := self.shift(m.stack, role))]
                for w in ways:
                    old = best.get(w.stack[0])
                    best[w.stack[0]] = w if old is None else min(old, w)
            self._moves[key] = list(best.values())
        return self._moves[key]

    def end(self, stack: Stack) -> Move | None:
        """The fewest insertions after which the sequence may end."""
        if stack not in self._ends:
            self._ends[stack] = next((m for m in self._inserted(stack) if self.accepts(m.stack)), None)
        return self._ends[stack]


class Repair:
    """One conversation. ``read`` takes its rows in order and yields (letter,
    role or None, row or None) of the edits that are settled; ``finish`` yields
    the rest. ``cost`` is known then."""

    def __init__(self, grammar: RoleGrammar):
        self.grammar = grammar
        self.cost = 0
        # top -> (cost, rank, stack, top before, letters, roles)
        self.tops: dict[int, tuple] = {grammar.empty[0]: (0, 0, grammar.empty, None, "", "")}
        self.steps: list[tuple[dict[int, tuple], object]] = []
        self.flush_at = FLUSH_ROWS

    def read(self, row: object, initial: str, must_delete: bool, truncated: bool) -> Iterator[tuple]:
        best: dict[int, tuple] = {}
        for top, (cost, rank, stack, *_) in self.tops.items():
            for m in self.grammar.moves(stack, initial, must_delete, truncated):
                way = (cost + m.cost, (rank, m.letters), m.roles, m.stack, top)
                old = best.get(m.stack[0])
                if old is None or way[:3] < old[:3]:
                    best[m.stack[0]] = way
        if self.grammar.slack is not None:
            most = min(w[0] for w in best.values()) + self.grammar.slack
            best = {t: w for t, w in best.items() if w[0] <= most}
        ranks = {audit: i for i, audit in enumerate(sorted({w[1] for w in best.values()}))}
        self.tops = {t: (cost, ranks[audit], stack, before, audit[1], roles)
                     for t, (cost, audit, roles, stack, before) in best.items()}
        self.steps.append((self.tops, row))
        if len(self.steps) >= self.flush_at:
            yield from self._settled()
            self.flush_at = 2 * len(self.steps) + FLUSH_ROWS

    def _settled(self) -> Iterator[tuple]:
        live = set(self.tops)
        for i in range(len(self.steps) - 1, -1, -1):
            if len(live) == 1:
                yield from self._edits(live.pop(), i + 1)
                self.steps = self.steps[i + 1:]
                return
            live = {self.steps[i][0][t][3] for t in live}

    def _edits(self, top: int, n: int) -> Iterator[tuple]:
        """Edits of the first ``n`` open steps on the way to ``top``."""
        way = []
        for tops, row in reversed(self.steps[:n]):
            _, _, _, before, letters, roles = tops[top]
            way.append((letters, roles, row))
            top = before
        for letters, roles, row in reversed(way):
            yield from _named(letters, roles, row)

    def finish(self) -> Iterator[tuple]:
        ends = [(cost + m.cost, rank, m.letters, m.roles, top) for top, (cost, rank, stack, *_) in self.tops.items()
                if (m := self.grammar.end(stack))]
        self.cost, _, letters, roles, top = min(ends)
        yield from self._edits(top, len(self.steps))
        yield from _named(letters, roles, None)


def _named(letters: str, roles: str, row: object) -> Iterator[tuple]:
    left = iter(roles)
    for letter in letters:
        yield letter, next(left) if letter in (INSERT, REROLE) else None, None if letter == INSERT else row
