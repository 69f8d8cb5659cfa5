"""Patterns that can't hang.

A backtracking matcher tries every way in which a pattern can read a text.  Where a loop
can read one piece of text in two ways, such as ``(a+)+`` or ``(a|aa)*``, the ways
double with every repetition, and a value that fails in the end takes exponential time.
:func:`ambiguous_loop` finds such loops when a contract is loaded, from the pattern's
position automaton: its states are the pattern's characters, an edge leads to each
character that may come next, and carries the number of ways to get there.  A loop is
ambiguous if

* one of its edges can be taken in two ways, or
* two different walks of the same text lead from one of its states back to it (a state
  of the automaton's square, on a cycle through the diagonal and outside of it).

Patterns that Python's parser doesn't know (some Java classes), back references and
look-arounds are not judged beyond what is around them, and neither are possessive and
atomic groups, which don't backtrack.
"""

from __future__ import annotations

import warnings
from collections import Counter, defaultdict
from re import _constants as c  # the parse tree's names
from re import _parser

#: Repetitions from which a bounded loop is judged like an unbounded one.
MANY = 10
#: Characters of a pattern beyond which it isn't judged.
LARGEST = 150
_SAMPLES = "aAzZ09_ \t\n-.,;:/@#é日"


class _Automaton:
    def __init__(self, tree) -> None:
        self.letters = set(_SAMPLES)
        self._collect(tree)
        self.chars: list[frozenset] = []
        self.follow: dict[int, Counter] = defaultdict(Counter)
        self.ends = False
        self.part(tree)

    def _collect(self, tree) -> None:
        """Characters that tell the pattern's classes apart."""
        for op, arg in tree:
            if op in (c.LITERAL, c.NOT_LITERAL):
                self.letters.add(chr(arg))
            elif op is c.RANGE:
                self.letters |= {chr(x) for x in (arg[0], arg[1], arg[1] + 1) if x < 0x110000}
            elif op is c.IN:
                self._collect(arg)
            elif op is c.BRANCH:
                for b in arg[1]:
                    self._collect(b)
            elif op is c.SUBPATTERN:
                self._collect(arg[3])
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
                self._collect(arg[2])

    def _in(self, item, letter: str) -> bool:
        op, arg = item
        if op is c.LITERAL:
            return letter == chr(arg)
        if op is c.RANGE:
            return arg[0] <= ord(letter) <= arg[1]
        if op is c.CATEGORY:
            kind = str(arg).rsplit("_", 1)[-1]
            has = {"DIGIT": letter in "0123456789", "SPACE": letter in " \t\n\r\f\v", "WORD": letter.isascii() and (letter.isalnum() or letter == "_")}.get(kind, False)
            return has != ("NOT" in str(arg))
        return False

    def _class(self, op, arg) -> frozenset:
        if op is c.ANY:
            return frozenset(self.letters - {"\n"})
        if op is c.LITERAL:
            return frozenset(chr(arg))
        if op is c.NOT_LITERAL:
            return frozenset(self.letters - {chr(arg)})
        items = [i for i in arg if i[0] is not c.NEGATE]
        found = {x for x in self.letters if any(self._in(i, x) for i in items)}
        return frozenset(self.letters - found if len(items) < len(arg) else found)

    def _link(self, last: Counter, first: Counter) -> None:
        for p, m in last.items():
            for q, n in first.items():
                self.follow[p][q] += m * n

    def part(self, tree) -> tuple[bool, Counter, Counter]:
        """Whether a sequence may be empty, and its first and last characters."""
        empty, first, last = True, Counter(), Counter()
        for item in tree:
            e, f, t = self.one(*item)
            self._link(last, f)
            first = first + f if empty else first
            last = last + t if e else t
            empty = empty and e
        return empty, first, last

    def one(self, op, arg) -> tuple[bool, Counter, Counter]:
        if op in (c.LITERAL, c.NOT_LITERAL, c.ANY, c.IN):
            self.chars.append(self._class(op, arg))
            here = Counter([len(self.chars) - 1])
            return False, here, here
        if op is c.SUBPATTERN:
            return self.part(arg[3])
        if op is c.BRANCH:
            parts = [self.part(b) for b in arg[1]]
            return any(p[0] for p in parts), sum((p[1] for p in parts), Counter()), sum((p[2] for p in parts), Counter())
        if op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, high, body = arg
            if high < MANY:  # written out
                return self.part([item for _ in range(low) for item in body] + [(c.BRANCH, (None, [list(body), []]))] * (high - low))
            empty, first, last = self.part(body)
            self._link(last, first)
            return empty or low == 0, first, last
        if op is c.AT and arg in (c.AT_END, c.AT_END_STRING):
            self.ends = True
        return True, Counter(), Counter()


def _components(nodes, edges) -> list[set]:
    """Strongly connected components (iterative, by two passes)."""
    order, seen = [], set()
    for start in nodes:
        if start in seen:
            continue
        stack = [(start, iter(edges(start)))]
        seen.add(start)
        while stack:
            node, it = stack[-1]
            nxt = next((x for x in it if x not in seen), None)
            if nxt is None:
                order.append(node)
                stack.pop()
            else:
                seen.add(nxt)
                stack.append((nxt, iter(edges(nxt))))
    back = defaultdict(list)
    for a in nodes:
        for b in edges(a):
            back[b].append(a)
    out, done = [], set()
    for root in reversed(order):
        if root in done:
            continue
        group, todo = set(), [root]
        while todo:
            x = todo.pop()
            if x not in done:
                done.add(x)
                group.add(x)
                todo += [y for y in back[x] if y not in done]
        out.append(group)
    return out


def ambiguous_loop(pattern: str) -> str | None:
    """Why a pattern may take exponential time, or None."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            auto = _Automaton(_parser.parse(pattern))
    except Exception:  # not in Python's language: not judged
        return None
    n = len(auto.chars)
    if n > LARGEST:
        return None
    for loop in _components(range(n), lambda p: auto.follow[p]):
        inside = {p: {q: m for q, m in auto.follow[p].items() if q in loop} for p in loop}
        if not any(inside.values()):
            continue
        # a loop after which nothing can fail is left at once
        if not auto.ends and all(q in loop for p in loop for q in auto.follow[p]):
            continue
        if any(m > 1 for edges in inside.values() for m in edges.values()):
            return "a loop within a loop reads the same text in several ways"
        square = [(p, q) for p in loop for q in loop if auto.chars[p] & auto.chars[q]]
        known = set(square)
        groups = _components(square, lambda x: [y for a in inside[x[0]] for b in inside[x[1]] if (y := (a, b)) in known])
        if any(any(p == q for p, q in g) and any(p != q for p, q in g) for g in groups):
            return "alternatives of a loop read the same text in several ways"
    return None
