"""Secret scans by one combined automaton.

Every rule is a regular expression over bytes.  The rules are compiled together:
an NFA for ``.*(rule1|rule2|...)``, subset construction over byte classes,
minimisation by partition refinement, and a flat transition array.  A text is
then read once, byte by byte, whatever the number of rules; a state from
``first_hit`` on names the rules of which a shortest match ends there.  Only
where that happens does a rule's own (anchored) automaton look for the match's
start and longest end.

A rule has a head, a tail (one byte class, repeated) and least lengths.  The
base rules are

* ``assign``  ``(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)``,
  the keyword in either case, dropped if group 2 has under 6 characters;
* ``access``  ``AKIA[A-Z0-9]+``, dropped under 20 characters;
* ``hex``     ``[0-9a-f]+``, dropped under 24 characters.

The method adds ``github``, ``slack``, ``jwt`` and ``pem`` (see RULES).  Matches
of one kind are leftmost, longest and do not overlap; a dropped match still
uses up its text.  Offsets are code points, the end exclusive.

Defined cases: null or empty text has no span; repeated rows give repeated
results; extra columns are ignored by ``scan`` and kept by ``redact``; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_rows
from ledgerloom.llm.text import text_of, tidy, utf8

UPPER, LOW, DIGIT = (frozenset(range(*x)) for x in ((65, 91), (97, 123), (48, 58)))


# ------------------------------------------------------------------ expressions: nested tuples

def chars(text: str | Iterable[int]) -> tuple:
    return ("set", frozenset(text.encode() if isinstance(text, str) else text))


def cat(*parts: tuple) -> tuple:
    return ("cat", parts)


def alt(*parts: tuple) -> tuple:
    return ("alt", parts)


def opt(part: tuple) -> tuple:
    return ("alt", (part, ("cat", ())))


def star(part: tuple) -> tuple:
    return ("star", part)


def plus(part: tuple, least: int = 1) -> tuple:
    return cat(*[part] * least, star(part))


def word(text: str, any_case: bool = False) -> tuple:
    return cat(*(chars({b, ord(chr(b).swapcase())} if any_case and chr(b).isalpha() else {b}) for b in text.encode()))


@dataclass(frozen=True)
class Rule:
    kind: str
    head: tuple
    tail: frozenset
    least_tail: int = 1     # shorter tails are dropped after matching
    least: int = 0          # shorter matches are dropped after matching
    run: int = 1            # tail bytes that the automaton itself asks for

    def regex(self) -> tuple:
        return cat(self.head, plus(chars(self.tail), self.run))

    def shortest(self) -> tuple:
        """Up to the first byte at which a match can end: all that the combined automaton has to notice."""
        return cat(self.head, *[chars(self.tail)] * self.run)


_QUOTE, _SPACES = opt(chars("\"'")), star(chars(" "))
_KEYWORDS = alt(*(word(x, True) for x in ("password", "passwd", "secret", "token", "apikey", "api_key")))
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", cat(_KEYWORDS, _QUOTE, _SPACES, chars(":="), _SPACES, _QUOTE), UPPER | LOW | DIGIT | frozenset(b"+/_.=-"), least_tail=6),
    Rule("access", word("AKIA"), UPPER | DIGIT, least=20),
    # A run of hex digits is one match, so asking for 24 at once drops the same runs as asking afterwards.
    Rule("hex", cat(), DIGIT | frozenset(b"abcdef"), least=24, run=24),
    Rule("github", cat(word("gh"), chars("pousr"), word("_")), UPPER | LOW | DIGIT, least_tail=36),
    Rule("slack", cat(word("xox"), chars("abprs"), word("-")), UPPER | LOW | DIGIT | frozenset(b"-"), least_tail=10),
    Rule("jwt", word("eyJ"), UPPER | LOW | DIGIT | frozenset(b"_.-"), least=40),
    Rule("pem", cat(word("-----BEGIN "), star(chars(UPPER | frozenset(b" "))), word("PRIVATE KEY")), frozenset(b"-"), least_tail=5),
)
KINDS = tuple(r.kind for r in RULES)


# ------------------------------------------------------------------ automata

class Nfa:
    """Thompson's construction."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def add(self, node: tuple, start: int) -> int:
        """Adds the expression from ``start``; returns its end state."""
        kind, arg = node
        if kind == "set":
            end = self.state()
            self.moves[start] = (arg, end)
            return end
        if kind == "cat":
            for part in arg:
                join = self.state()
                self.empty[start].append(join)
                start = self.add(part, join)
            return start
        end = self.state()
        for part in arg if kind == "alt" else (arg,):
            enter = self.state()
            self.empty[start].append(enter)
            leave = self.add(part, enter)
            self.empty[leave].append(end)
            if kind == "star":
                self.empty[leave].append(enter)
        if kind == "star":
            self.empty[start].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.empty[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)


@dataclass(frozen=True)
class Dfa:
    """``table[state + byte]`` is the next state; states are multiples of 256.

    States from ``first_hit`` on are accepting, ``hits[state >> 8]`` are their
    rules.  ``dead`` is the state that leads nowhere, or -1.
    """

    table: list
    start: int
    first_hit: int
    hits: list
    dead: int


def compile_rules(regexes: tuple, anchored: bool) -> Dfa:
    nfa = Nfa()
    start = nfa.state()
    ends = {}
    for number, regex in enumerate(regexes):
        enter = nfa.state()
        nfa.empty[start].append(enter)
        ends[nfa.add(regex, enter)] = number
    sets = {m[0] for m in nfa.moves if m}
    classes: dict[tuple, list[int]] = {}
    for byte in range(256):
        classes.setdefault(tuple(byte in s for s in sorted(sets, key=sorted)), []).append(byte)
    groups = list(classes.values())
    first = nfa.closure([start])
    number = {first: 0}
    order, rows = [first], []
    for current in order:                                    # subset construction
        row = []
        for group in groups:
            moved = {nfa.moves[s][1] for s in current if nfa.moves[s] and group[0] in nfa.moves[s][0]}
            nxt = nfa.closure(moved if anchored else moved | {start})
            if nxt not in number:
                number[nxt] = len(order)
                order.append(nxt)
            row.append(number[nxt])
        rows.append(row)
    hits = [tuple(sorted(ends[s] for s in state if s in ends)) for state in order]
    block = minimise(rows, hits)
    size = max(block) + 1
    member = [block.index(b) for b in range(size)]
    rank = sorted(range(size), key=lambda b: (bool(hits[member[b]]), b))
    place = {b: i for i, b in enumerate(rank)}
    table = np.zeros((size, 256), np.int64)
    for i, b in enumerate(rank):
        for group, nxt in zip(groups, rows[member[b]]):
            table[i, group] = place[block[nxt]] * 256
    found = [hits[member[b]] for b in rank]
    quiet = sum(not x for x in found)
    dead = next((i * 256 for i in range(quiet) if (table[i] == i * 256).all()), -1) if anchored else -1
    return Dfa(table.ravel().tolist(), place[block[0]] * 256, quiet * 256, found, dead)


def minimise(rows: list[list[int]], hits: list[tuple]) -> list[int]:
    """The block of each state, by partition refinement (Moore)."""
    names = {h: i for i, h in enumerate(dict.fromkeys(hits))}
    block = [names[h] for h in hits]
    while True:
        keys = [(block[i], *(block[j] for j in row)) for i, row in enumerate(rows)]
        names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        refined = [names[k] for k in keys]
        if len(names) == max(block) + 1:
            return block
        block = refined


def reverse(node: tuple) -> tuple:
    kind, arg = node
    if kind == "set":
        return node
    if kind == "star":
        return (kind, reverse(arg))
    parts = tuple(reverse(x) for x in arg)
    return (kind, parts[::-1] if kind == "cat" else parts)


class Scanner:
    """The combined automaton and, for the places where it stops, each rule's own ones."""

    def __init__(self, rules: tuple = RULES):
        self.rules = rules
        self.all = compile_rules(tuple(r.shortest() for r in rules), anchored=False)
        self.forward = [compile_rules((r.regex(),), anchored=True) for r in rules]
        self.backward = [compile_rules((reverse(r.shortest()),), anchored=True) for r in rules]
        self.heads = [compile_rules((r.head,), anchored=True) for r in rules]

    def ends(self, data: bytes) -> list[tuple[int, tuple]]:
        """(place, rules) wherever matches end: the one pass."""
        table, limit, state, out = self.all.table, self.all.first_hit, self.all.start, []
        for i, byte in enumerate(data):
            state = table[state + byte]
            if state >= limit:
                out.append((i + 1, state))
        return [(i, self.all.hits[s >> 8]) for i, s in out]

    def find(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule number) in bytes, by start, then by rule."""
        used, found = [0] * len(self.rules), []
        for place, numbers in self.ends(data):
            for r in numbers:
                if place <= used[r]:
                    continue
                start = self._far(self.backward[r], data, place - 1, used[r] - 1, -1)
                if start is None:                # only with text that an earlier match has used up
                    continue
                end = self._far(self.forward[r], data, start, len(data), 1)
                used[r] = end
                rule = self.rules[r]
                if end - start >= rule.least and (rule.least_tail <= 1 or end - self._far(self.heads[r], data, start, len(data), 1) >= rule.least_tail):
                    found.append((start, end, r))
        return sorted(found, key=lambda x: (x[0], x[2]))

    @staticmethod
    def _far(dfa: Dfa, data: bytes, i: int, stop: int, step: int) -> int | None:
        """The farthest place at which the anchored automaton accepts."""
        state, best = dfa.start, None
        while i != stop:
            state = dfa.table[state + data[i]]
            if state == dfa.dead:
                break
            i += step
            if state >= dfa.first_hit:
                best = i if step > 0 else i + 1
        return best

    def spans(self, data: bytes) -> list[tuple[int, int, str]]:
        """(start, end, kind) in code points."""
        found = self.find(data)
        if not found:
            return []
        cuts = sorted({x for s, e, _ in found for x in (s, e)})
        points, at, n = {}, 0, 0
        for cut in cuts:
            n += len(data[at:cut].decode("utf-8", "replace"))
            points[cut], at = n, cut
        return [(points[s], points[e], self.rules[r].kind) for s, e, r in found]


def join_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


# ------------------------------------------------------------------ Spark

SCAN_SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def scan(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Scanner(rules)
        for batch in batches:
            buf, off = utf8(batch.column(1))
            rows = [machine.spans(text_of(buf, off, i)) for i in range(batch.num_rows)]
            base = [[x for x in row if x[2] in BASE] for row in rows]
            counts = [pa.array([sum(x[2] == kind for x in row) for row in base], pa.int64()) for kind in BASE]
            digests = [hashlib.sha256(join_spans(row).encode()).hexdigest() for row in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array([join_spans(r) for r in rows], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            tidy()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCAN_SCHEMA)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by ``[kind]``; overlapping spans become one."""
    out, at = [], 0
    for start, end, kind in spans:
        if end <= at:
            continue
        out += [text[at:start], f"[{kind}]"] if start >= at else []
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """The same rows and columns, secrets in ``text`` masked; ``n_chars``, if there, follows a changed text."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Scanner(rules)
        for batch in batches:
            k = names.index("text")
            buf, off = utf8(batch.column(k))
            texts = batch.column(k).to_pylist()
            sizes = batch.column(names.index("n_chars")).to_pylist() if "n_chars" in names else None
            for i, text in enumerate(texts):
                if text and (found := machine.spans(text_of(buf, off, i))):
                    texts[i] = mask(text, found)
                    if sizes:
                        sizes[i] = len(texts[i])
            columns = batch.columns
            columns[k] = pa.array(texts, batch.schema.field(k).type)
            if sizes is not None and pa.types.is_integer(batch.schema.field(names.index("n_chars")).type):
                columns[names.index("n_chars")] = pa.array(sizes, batch.schema.field(names.index("n_chars")).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            del texts, columns, buf
            tidy()

    return map_rows(docs, run)
