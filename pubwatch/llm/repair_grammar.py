"""Cheapest edits of row sequences by a grammar: one min-plus transfer matrix per Re-Pair rule.

A row is a symbol, its role class and its fault. The state tells which role the repaired
conversation waits for. Per symbol a 4 x 4 matrix holds, for every state before and after it, the
least cost and the least audit string of that cost. A rule's matrix is the product of those of its
two sides, so it is worked out once for all sequences that the rule occurs in.

Audits are ropes: a rule's audit joins two audits without copying them, and two ropes compare by
the digests of their parts. Ties may be broken part by part: two audits of one segment with equal
costs between equal states are never a proper prefix of one another, as the longer one would have
the same edits of rows and more insertions.
"""

from __future__ import annotations

from collections import defaultdict
from functools import cache
from heapq import heapify, heappop, heappush

ROLES = ("s", "u", "a")
OTHER = 3
CLEAN, DELETE, TRUNCATED = 0, 1, 2
SYMBOLS = 12
#: nothing yet; after the system row; after a user row; after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: states in which a conversation may end
ENDS = (START, ASSISTANT)
#: the state after a row of a role, by the state before it
STEPS = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: roles of adjacent rows that may follow each other
LEGAL = {(ROLES.index(a), ROLES.index(b)) for a, b in ("su", "ua", "au")}
MODULUS, BASE = (1 << 61) - 1, 911_382_323


def symbol(role: int, fault: int) -> int:
    return role * 3 + fault


@cache
def _shift(size: int) -> int:
    return pow(BASE, size, MODULUS)


class Rope:
    """An immutable string of parts with a digest."""

    __slots__ = ("size", "digest", "left", "right", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        if text is None:
            self.size = left.size + right.size
            self.digest = (left.digest * _shift(right.size) + right.digest) % MODULUS
        else:
            self.size, self.digest = len(text), 0
            for letter in text:
                self.digest = (self.digest * BASE + ord(letter)) % MODULUS

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        return Rope(None, self, other) if other.size else self

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a.size == b.size and a.digest == b.digest:
                continue
            if a.text is None and (b.text is not None or a.size >= b.size):
                mine += [a.right, a.left]
                theirs.append(b)
            elif b.text is None:
                theirs += [b.right, b.left]
                mine.append(a)
            else:
                shared = min(a.size, b.size)
                if a.text[:shared] != b.text[:shared]:
                    return a.text < b.text
                if a.size > shared:
                    mine.append(Rope(a.text[shared:]))
                if b.size > shared:
                    theirs.append(Rope(b.text[shared:]))
        return bool(theirs) and not mine

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            part = todo.pop()
            if part.text is None:
                todo += [part.right, part.left]
            else:
                out.append(part.text)
        return "".join(out)


EMPTY = Rope("")
#: cost and audit, or None where no edits lead from the one state to the other
Entry = tuple[int, Rope] | None
Row = list[Entry]


def better(a: Entry, b: Entry) -> bool:
    """Whether ``a`` is cheaper than ``b``, or equally cheap with an audit that comes first."""
    if a is None or b is None:
        return a is not None
    return a[0] < b[0] or (a[0] == b[0] and a[1] < b[1])


def advance(row: Row, matrix: list[Row]) -> tuple[Row, list[int]]:
    """Min-plus product of a row of entries and a matrix, and the state that each entry came from."""
    out: Row = [None] * len(STATES)
    origins = [START] * len(STATES)
    for origin, (entry, way) in enumerate(zip(row, matrix, strict=True)):
        if entry is None:
            continue
        for state, step in enumerate(way):
            if step is not None:
                found = entry[0] + step[0]
                if out[state] is None or found <= out[state][0]:
                    made = (found, entry[1] + step[1])
                    if better(made, out[state]):
                        out[state], origins[state] = made, origin
    return out, origins


def times(row: Row, matrix: list[Row]) -> Row:
    return advance(row, matrix)[0]


def _insertions() -> list[Row]:
    """The cheapest runs of inserted rows between two states."""
    best = [[(0, EMPTY) if a == b else None for b in STATES] for a in STATES]
    for _ in STATES:
        for way in best:
            for role in "ua":
                for a, b in STEPS[role].items():
                    if way[a] is not None:
                        made = (way[a][0] + INSERT_COST, way[a][1] + Rope("I"))
                        if better(made, way[b]):
                            way[b] = made
    return best


INSERTIONS = _insertions()


class Transfer:
    """What a run of rows does: its matrix, roles at its ends, and adjacent roles that are illegal."""

    __slots__ = ("matrix", "first", "last", "illegal")

    def __init__(self, matrix: list[Row], first: int, last: int, illegal: int) -> None:
        self.matrix, self.first, self.last, self.illegal = matrix, first, last, illegal

    def __mul__(self, other: Transfer) -> Transfer:
        illegal = self.illegal + other.illegal + ((self.last, other.first) not in LEGAL)
        matrix = [times(row, other.matrix) for row in self.matrix]
        return Transfer(matrix, self.first, other.last, illegal)


def _terminal(code: int) -> Transfer:
    """Insertions before a row, then one edit of it."""
    role, fault = divmod(code, 3)
    edits: list[Row] = [[None] * len(STATES) for _ in STATES]

    def offer(a: int, b: int, cost: int, letter: str) -> None:
        made = (cost, Rope(letter))
        if better(made, edits[a][b]):
            edits[a][b] = made

    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for state in STATES:
        offer(state, state, DELETE_COST, "D")
        if fault == DELETE:
            continue
        if role != OTHER and state in STEPS[ROLES[role]]:
            offer(state, STEPS[ROLES[role]][state], extra, "K")
        for target in "ua":
            if state in STEPS[target]:
                offer(state, STEPS[target][state], extra + REROLE_COST, "R")
    return Transfer([times(row, edits) for row in INSERTIONS], role, role, 0)


TERMINALS = [_terminal(code) for code in range(SYMBOLS)]


def re_pair(sequences: list[bytes]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules, and the sequences written with them: the most frequent pair becomes a rule, until none
    occurs twice. Rule ``i`` has the symbol ``SYMBOLS + i``."""
    symbols = [code for codes in sequences for code in codes]
    ends, at = set(), 0
    starts = []
    for codes in sequences:
        starts.append(at)
        at += len(codes)
        ends.add(at)
    after = [i + 1 if i + 1 not in ends else -1 for i in range(at)]
    before = [i - 1 if i not in ends and i else -1 for i in range(at)]
    where: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i in range(at):
        if after[i] >= 0:
            where[symbols[i], symbols[i + 1]].add(i)
    heap = [(-len(places), pair) for pair, places in where.items() if len(places) > 1]
    heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heappop(heap)
        places = where.get(pair, ())
        if len(places) != -count:
            if len(places) > 1:
                heappush(heap, (-len(places), pair))
            continue
        new = SYMBOLS + len(rules)
        rules.append(pair)
        del where[pair]
        changed = set()
        for i in sorted(places):
            j = after[i]
            if symbols[i] != pair[0] or j < 0 or symbols[j] != pair[1]:
                continue  # it shared a symbol with the place before it
            left, right = before[i], after[j]
            if left >= 0:
                where[symbols[left], pair[0]].discard(left)
                where[symbols[left], new].add(left)
                changed.add((symbols[left], new))
            if right >= 0:
                where[pair[1], symbols[right]].discard(j)
                where[new, symbols[right]].add(i)
                changed.add((new, symbols[right]))
                before[right] = i
            symbols[i], symbols[j], after[i] = new, -1, right
        for other in changed:
            if len(where[other]) > 1:
                heappush(heap, (-len(where[other]), other))
    written = []
    for start, codes in zip(starts, sequences, strict=True):
        i, out = start if codes else -1, []
        while i >= 0:
            out.append(symbols[i])
            i = after[i]
        written.append(out)
    return rules, written


def transfers(sequences: list[bytes]) -> list[Transfer]:
    """The transfer of every sequence, none of them empty. Rules are worked out bottom-up."""
    rules, written = re_pair(sequences)
    known = list(TERMINALS)
    for left, right in rules:
        known.append(known[left] * known[right])
    out = []
    for symbols in written:
        made = known[symbols[0]]
        for code in symbols[1:]:
            made = made * known[code]
        out.append(made)
    return out


def best_end(row: Row) -> tuple[int, int]:
    """The states before and after the last insertions, on the cheapest way to an end."""
    best: tuple[Entry, int, int] = (None, START, START)
    for state, entry in enumerate(row):
        for end in ENDS:
            step = INSERTIONS[state][end]
            if entry is not None and step is not None:
                made = (entry[0] + step[0], entry[1] + step[1])
                if better(made, best[0]):
                    best = (made, state, end)
    return best[1:]


def apply(audit: str, codes: bytes, state: int) -> list[tuple[int, str | None]]:
    """Rows that the edits leave: index in ``codes`` (-1: inserted) and new role, if any."""
    out: list[tuple[int, str | None]] = []
    at = 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            state = STEPS[ROLES[codes[at] // 3]][state]
            out.append((at, None))
        else:
            role = "a" if state == USER else "u"
            state = STEPS[role][state]
            out.append((-1 if letter == "I" else at, "assistant" if role == "a" else "user"))
        at += letter != "I"
    return out
