"""Rule regexes compiled together into one minimal byte automaton, and its scan over flat bytes with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rule:
    """A match is `prefix`, then as many bytes of `body` as there are, at least one.

    `prefix` and `body` are ASCII regexes of literals, classes, groups with |, and the suffixes ? * +; `body` is one class.
    The prefix has to end with a byte that tells how it began, as the scan keeps no more than one attempt of a rule.
    `least_body` and `least` drop matches with a shorter body or that are shorter as a whole, after matching."""

    name: str
    prefix: str
    body: str
    least_body: int = 1
    least: int = 1
    any_case: bool = False


class _Nfa:
    """Steps without and with a byte class, built from a regex by Thompson's construction."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.byte: list[list[tuple[frozenset[int], int]]] = []

    def node(self) -> int:
        self.free.append([])
        self.byte.append([])
        return len(self.free) - 1

    def add(self, regex: str, start: int, any_case: bool) -> int:
        end, rest = self._choice(regex, start, any_case)
        if rest:
            raise ValueError(f"cannot read {rest!r} in {regex!r}")
        return end

    def _choice(self, s: str, start: int, any_case: bool) -> tuple[int, str]:
        end = self.node()
        while True:
            begin = self.node()
            self.free[start].append(begin)
            last, s = self._sequence(s, begin, any_case)
            self.free[last].append(end)
            if not s.startswith("|"):
                return end, s
            s = s[1:]

    def _sequence(self, s: str, at: int, any_case: bool) -> tuple[int, str]:
        while s and s[0] not in "|)":
            begin = self.node()
            self.free[at].append(begin)
            if s[0] == "(":
                end, s = self._choice(s[1:].removeprefix("?:"), begin, any_case)
                if not s.startswith(")"):
                    raise ValueError("a group is not closed")
                s = s[1:]
            else:
                accepted, s = byte_class(s, any_case)
                end = self.node()
                self.byte[begin].append((accepted, end))
            out = self.node()
            self.free[end].append(out)
            if s and s[0] in "?*+":
                if s[0] in "?*":
                    self.free[begin].append(out)
                if s[0] in "*+":
                    self.free[end].append(begin)
                s = s[1:]
            at = out
        return at, s

    def closure(self, nodes: frozenset[int]) -> frozenset[int]:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    def after(self, nodes: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure(frozenset(to for x in nodes for accepted, to in self.byte[x] if byte in accepted))


def byte_class(s: str, any_case: bool = False) -> tuple[frozenset[int], str]:
    """The bytes that the class, escape or character at the start of a regex accepts, and the rest of the regex."""

    def one(s: str) -> tuple[int, str]:
        if s[0] != "\\":
            return ord(s[0]), s[1:]
        if s[1] == "x":
            return int(s[2:4], 16), s[4:]
        return ord(s[1]), s[2:]

    if s[0] != "[":
        c, rest = one(s)
        found = {c}
    else:
        s, found = s[1:], set()
        while s[0] != "]":
            low, s = one(s)
            high = low
            if s[0] == "-" and s[1] != "]":
                high, s = one(s[1:])
            found.update(range(low, high + 1))
        rest = s[1:]
    if any_case:
        found |= {ord(chr(x).swapcase()) for x in found if chr(x).isascii() and chr(x).isalpha()}
    return frozenset(found), rest


def minimised(step: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moore's refinement: states that no continuation tells apart become one. The table, the kinds, and each state's new number."""
    block = np.unique(kind, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    first = np.unique(finer, return_index=True)[1]
    return finer[step[first]], kind[first], finer


class Scanner:
    """All rules in one table: step[state, byte] is the next state, inside[state] has a bit for each rule whose match goes on there.

    A subset holds, for each rule, its attempts so far. Where a rule is in its body, the attempts that began later are
    dropped, and where the body ends the rule starts afresh: that is leftmost matching without overlap."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = rules
        nfa = _Nfa()
        starts, bodies = [], []
        for r in rules:
            start = nfa.node()
            end = nfa.add(r.prefix, start, r.any_case) if r.prefix else start
            body, (accepted, rest) = nfa.node(), byte_class(r.body, r.any_case)
            if rest:
                raise ValueError(f"{r.body!r} is more than one class")
            nfa.byte[end].append((accepted, body))
            nfa.byte[body].append((accepted, body))
            starts.append(nfa.closure(frozenset([start])))
            bodies.append(body)

        classes = list({accepted for steps in nfa.byte for accepted, _ in steps})
        like = np.unique([[x in accepted for accepted in classes] for x in range(256)], axis=0, return_index=True, return_inverse=True)
        examples, of_byte = like[1].tolist(), like[2].ravel()  # bytes that no class tells apart step alike
        first = tuple(starts)
        number, todo, rows = {first: 0}, [first], []
        while todo:
            now, row = todo.pop(0), []
            for byte in examples:
                then = []
                for at, start, body in zip(now, starts, bodies, strict=True):
                    to = nfa.after(at, byte)
                    then.append(frozenset([body]) if body in to else start | to)
                key = tuple(then)
                if key not in number:
                    number[key] = len(number)
                    todo.append(key)
                row.append(number[key])
            rows.append(np.array(row)[of_byte])
        kind = np.array([sum(1 << i for i, body in enumerate(bodies) if at[i] == frozenset([body])) for at in number], np.int64)
        self.step, kind, new = minimised(np.array(rows, np.int32), kind)
        self.inside, self.start = kind.astype(np.uint8 if len(rules) <= 8 else np.int64), int(new[0])
        self.flat_step = self.step.astype(np.int32).ravel()
        self.backward = [_Backward(r) for r in rules]

    def states(self, data: np.ndarray, lane: int = 256) -> np.ndarray:
        """The state after each byte. Lanes of the data advance together; those that began in a wrong state run again."""
        n = len(data)
        lanes = -(-n // lane)
        padded = np.zeros(lanes * lane, np.uint8)
        padded[:n] = data
        columns = np.ascontiguousarray(padded.reshape(lanes, lane).T)
        seen = np.empty((lane, lanes), np.int16)
        begun = np.full(lanes, self.start, np.int32)
        todo = np.arange(lanes)
        while len(todo):
            state = begun[todo]
            every = len(todo) == lanes
            for i in range(lane):
                state = self.flat_step[(state << 8) | (columns[i] if every else columns[i, todo])]
                if every:
                    seen[i] = state
                else:
                    same = seen[i, todo] == state
                    seen[i, todo] = state
                    if same.all():
                        break
            ends = seen[-1, :-1].astype(np.int32)
            wrong = np.flatnonzero(begun[1:] != ends) + 1
            begun[wrong] = ends[wrong - 1]
            todo = wrong
        return np.ascontiguousarray(seen.T).ravel()[:n]

    def find(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """For each rule the matches (row, start, end, body start), in bytes from the row's start, in order."""
        n = len(offsets) - 1
        joined = np.zeros(len(data) + n, np.uint8)  # a zero byte after each row belongs to no rule and ends every match
        at = np.arange(n) + offsets[:-1]
        keep = np.ones(len(joined), bool)
        keep[offsets[1:] + np.arange(n)] = False
        joined[keep] = data
        inside = self.inside[self.states(joined)]
        found = []
        for i, (rule, back) in enumerate(zip(self.rules, self.backward, strict=True)):
            bit = np.flatnonzero(inside & (1 << i))
            if not len(bit):
                found.append([])
                continue
            cut = np.flatnonzero(np.diff(bit) != 1)
            firsts, lasts = bit[np.r_[0, cut + 1]], bit[np.r_[cut, len(bit) - 1]] + 1
            long = lasts - firsts >= max(rule.least_body, 1 if rule.prefix else rule.least)
            own = []
            for a, b in zip(firsts[long].tolist(), lasts[long].tolist(), strict=True):
                row = int(np.searchsorted(at, a, "right")) - 1
                start = back.start(joined, a, int(at[row]))
                if b - start >= rule.least:
                    own.append((row, start - int(at[row]), b - int(at[row]), a - int(at[row])))
            found.append(own)
        return found


class _Backward:
    """From where a body begins back to where its prefix began."""

    def __init__(self, rule: Rule) -> None:
        self.nfa = _Nfa()
        self.first = self.nfa.node()
        self.last = self.nfa.add(rule.prefix, self.first, rule.any_case) if rule.prefix else self.first
        turned = _Nfa()
        for _ in self.nfa.free:
            turned.node()
        for x, (free, byte) in enumerate(zip(self.nfa.free, self.nfa.byte, strict=True)):
            for to in free:
                turned.free[to].append(x)
            for accepted, to in byte:
                turned.byte[to].append((accepted, x))
        self.turned = turned
        self.known: dict[tuple[frozenset[int], int], frozenset[int]] = {}

    def start(self, data: np.ndarray, body: int, least: int) -> int:
        at, begun = self.turned.closure(frozenset([self.last])), body
        here = body
        while at:
            if self.first in at:
                begun = here
            here -= 1
            if here < least:
                break
            key = (at, int(data[here]))
            if key not in self.known:
                self.known[key] = self.turned.after(*key)
            at = self.known[key]
        return begun
