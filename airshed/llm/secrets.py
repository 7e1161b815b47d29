"""Secret scan with one deterministic automaton for all rules.

Every rule is a small regular expression, given as nested tuples. All rules together are compiled
by subset construction into one automaton that tells, after each byte, which rules have a match
ending there; equal states are then merged and the transitions laid out in one array over classes
of bytes. A text is read once by that array. Only where it reports a rule are the exact spans
taken, with two automata of that rule alone: one reads backwards and marks where matches begin, one
reads forwards from there: leftmost, as long as possible, not overlapping. Every pass is one step a byte.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import free_name, mapped

# --- expressions: a set of bytes, or ("seq" | "alt", parts...), ("star" | "plus" | "maybe", part) ---

UPPER, LOWER, DIGIT = frozenset(range(65, 91)), frozenset(range(97, 123)), frozenset(range(48, 58))
ALNUM = UPPER | LOWER | DIGIT


def chars(text: str) -> frozenset[int]:
    return frozenset(text.encode())


def word(text: str, any_case: bool = False) -> tuple:
    both = (lambda c: chars(c.lower() + c.upper())) if any_case else chars
    return ("seq", *[both(c) for c in text])


def times(part, least: int, more: bool = True) -> tuple:
    return ("seq", *[part] * least, *([("star", part)] if more else []))


@dataclass(frozen=True)
class Rule:
    kind: str
    expression: tuple
    fits: Callable[[str], bool] | None = None  # a match that does not fit is dropped


_QUOTE, _BLANKS = ("maybe", chars("\"'")), ("star", chars(" "))
_VALUE = ALNUM | chars("+/_.=-")
_KEYWORDS = ("password", "passwd", "secret", "token")


def _assigned(match: str) -> bool:
    """The value, which is what follows the first : or = and its blanks and quote, has 8 characters or more."""
    value = match[min(i for i in (match.find(":"), match.find("=")) if i >= 0) + 1 :].lstrip(" ")
    return len(value[1:] if value[:1] in ("'", '"') else value) >= 8


#: Lengths are tested on the match: counted inside the automaton, they would multiply its states.
#: The base rules, in the order in which they are listed, then those that the method adds.
BASE = (
    Rule(
        "assign",
        (
            "seq",
            ("alt", *[word(k, True) for k in _KEYWORDS], ("seq", word("api", True), ("maybe", chars("_")), word("key", True))),
            _QUOTE,
            _BLANKS,
            chars(":="),
            _BLANKS,
            _QUOTE,
            ("plus", _VALUE),
        ),
        _assigned,
    ),
    Rule("access", ("seq", word("AKIA"), times(UPPER | DIGIT, 1)), lambda m: len(m) >= 16),
    Rule("hex", times(DIGIT | chars("abcdef"), 8), lambda m: len(m) >= 32),
)
_URL64 = ALNUM | chars("_-")
ADDED = (
    Rule("github", ("seq", word("gh"), chars("pousr"), word("_"), ("plus", ALNUM)), lambda m: len(m) >= 40),
    Rule("slack", ("seq", word("xox"), chars("abeoprs"), word("-"), ("plus", ALNUM | chars("-"))), lambda m: len(m) >= 15),
    Rule("stripe", ("seq", chars("rs"), word("k_live_"), ("plus", ALNUM)), lambda m: len(m) >= 24),
    Rule("google", ("seq", word("AIza"), ("plus", _URL64)), lambda m: len(m) >= 39),
    Rule(
        "jwt",
        ("seq", word("eyJ"), ("plus", _URL64), word(".eyJ"), ("plus", _URL64), word("."), ("plus", _URL64)),
        lambda m: min(map(len, m.split("."))) >= 8,
    ),
    Rule("pem", ("seq", word("-----BEGIN "), ("star", UPPER | chars(" ")), word("PRIVATE KEY-----"))),
)
RULES = (*BASE, *ADDED)


def shortest(x):
    """The expression without what only lengthens a match: enough to tell that there is one."""
    if isinstance(x, frozenset):
        return x
    kind, *parts = x
    if kind == "plus":
        return shortest(parts[0])
    if kind == "alt":
        return ("alt", *map(shortest, parts))
    if kind == "seq":
        while isinstance(parts[-1], tuple) and parts[-1][0] in ("star", "maybe"):
            parts.pop()
        return ("seq", *parts[:-1], shortest(parts[-1]))
    return x


class _Nfa:
    """States with steps on byte sets and free steps."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, x, start: int) -> int:
        """Builds ``x`` from ``start`` on; its last state."""
        if isinstance(x, frozenset):
            end = self.state()
            self.steps[start].append((x, end))
            return end
        kind, *parts = x
        if kind == "seq":
            for part in parts:
                start = self.add(part, start)
            return start
        end = self.state()
        if kind == "alt":
            for part in parts:
                self.free[self.add(part, self._after(start))].append(end)
            return end
        inner = self._after(start)
        last = self.add(parts[0], inner)
        self.free[last].append(end)
        if kind in ("star", "plus"):
            self.free[last].append(inner)
        if kind in ("star", "maybe"):
            self.free[start].append(end)
        return end

    def _after(self, start: int) -> int:
        fresh = self.state()
        self.free[start].append(fresh)
        return fresh

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """classes: the class of each byte. table[state + class]: the next state (a multiple of width).

    States from ``accepting`` on report the rules in ``reports`` (bits); from ``dead`` (-1: there is
    no such state) no match can follow any more.
    """

    classes: bytes
    width: int
    table: list[int]
    accepting: int
    reports: dict[int, int]
    dead: int


def backward(x):
    """The expression of the reversed matches."""
    if isinstance(x, frozenset):
        return x
    kind, *parts = x
    return (kind, *[backward(part) for part in (reversed(parts) if kind == "seq" else parts)])


def compiled(rules: tuple[Rule, ...], anywhere: bool, whole: bool = False) -> Automaton:
    """One minimal automaton for all rules; ``anywhere``: matches may begin at any byte.

    An automaton for matches anywhere reports a rule where its shortest matches end, which is enough to
    tell that there is one; ``whole``: wherever a match ends. No rule may match the empty text.
    """
    nfa = _Nfa()
    begin = nfa.state()
    ends = {}
    for i, rule in enumerate(rules):
        x = shortest(rule.expression) if anywhere and not whole else rule.expression
        ends[nfa.add(x, nfa._after(begin))] = 1 << i
    # Bytes that no rule tells apart are one class.
    sets = sorted({s for steps in nfa.steps for s, _ in steps}, key=sorted)
    names: dict[tuple, int] = {}
    classes = bytes(names.setdefault(tuple(b in s for s in sets), len(names)) for b in range(256))
    sample = [classes.index(c) for c in range(len(names))]
    # Subset construction.
    first = nfa.closed([begin])
    number, order, rows = {first: 0}, deque([first]), []
    found = [first]
    while order:
        subset = order.popleft()
        row = []
        for b in sample:
            after = {t for s in subset for on, t in nfa.steps[s] if b in on}
            goal = nfa.closed(after | ({begin} if anywhere else set()))
            if goal not in number:
                number[goal] = len(number)
                order.append(goal)
                found.append(goal)
            row.append(number[goal])
        rows.append(row)
    report = [sum({ends[s] for s in subset if s in ends}) for subset in found]
    # Minimisation: blocks of states are split until all of a block step into the same blocks.
    block, size = report, len(set(report))
    while True:
        split: dict[tuple, int] = {}
        block = [split.setdefault((block[i], *[block[t] for t in row]), len(split)) for i, row in enumerate(rows)]
        if len(split) == size:
            break
        size = len(split)
    merged = {b: (rows[i], report[i]) for i, b in reversed(list(enumerate(block)))}
    # Layout: the start first, then the other silent states, then those that report.
    silent = [b for b in merged if not merged[b][1] and b != block[0]]
    lasting = [block[0], *silent]
    layout = [*lasting, *[b for b in merged if merged[b][1]]]
    width = len(names)
    place = {b: i * width for i, b in enumerate(layout)}
    table = [place[block[t]] for b in layout for t in merged[b][0]]
    reports = {place[b]: merged[b][1] for b in layout if merged[b][1]}
    dead = next((place[b] for b in lasting if all(block[t] == b for t in merged[b][0])), -1)
    return Automaton(classes, width, table, len(lasting) * width, reports, dead)


def reported(data: bytes, every: Automaton) -> int:
    """Bits of the rules of which a match ends somewhere in the bytes: one step a byte."""
    table, accepting, reports = every.table, every.accepting, every.reports
    state = seen = 0
    for c in data.translate(every.classes):
        state = table[state + c]
        if state >= accepting:
            seen |= reports[state]
    return seen


def begins_of(data: bytes, back: Automaton) -> bytearray:
    """1 at each byte where a match of the rule begins: one step a byte, from the end."""
    table, accepting = back.table, back.accepting
    marks, state = bytearray(len(data)), 0
    at = len(data)
    for c in data[::-1].translate(back.classes):
        at -= 1
        state = table[state + c]
        if state >= accepting:
            marks[at] = 1
    return marks


def spans_of(data: bytes, one: Automaton, back: Automaton, fits: Callable[[str], bool] | None) -> list[tuple[int, int]]:
    """Byte spans of a rule: leftmost, longest, not overlapping; those that don't fit are dropped after.

    The way forward starts only where a match begins, and reads on only until no longer one can follow. So
    the time is linear in the text, whatever it repeats.
    """
    read, table, accepting, dead = data.translate(one.classes), one.table, one.accepting, one.dead
    marks = begins_of(data, back)
    out, at = [], marks.find(1)
    while at >= 0:
        state, end = 0, at
        for i in range(at, len(read)):
            state = table[state + read[i]]
            if state == dead:
                break
            if state >= accepting:
                end = i + 1
        if fits is None or fits(data[at:end].decode("ascii")):
            out.append((at, end))
        at = marks.find(1, end)
    return out


class Scanner:
    """All automata of a list of rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.kinds = [r.kind for r in rules]
        self.fits = [r.fits for r in rules]
        self.every = compiled(rules, True)
        self.each = [compiled((r,), False) for r in rules]
        self.back = [compiled((Rule(r.kind, backward(r.expression)),), True, whole=True) for r in rules]

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        """(rule number, start, end) in code points, by start, then rule."""
        data = (text or "").encode("utf-8", "surrogatepass")
        seen = reported(data, self.every)
        if not seen:
            return []
        out = [
            (i, a, b)
            for i in range(len(self.kinds))
            if seen >> i & 1
            for a, b in spans_of(data, self.each[i], self.back[i], self.fits[i])
        ]
        if len(data) != len(text):
            # A code point begins at each byte that doesn't continue one.
            begins = data.translate(_BEGINS)
            points, at, n = {}, 0, 0
            for p in sorted({p for _, *ab in out for p in ab}):
                n += begins.count(1, at, p)
                points[p], at = n, p
            out = [(i, points[a], points[b]) for i, a, b in out]
        return sorted(out, key=lambda x: (x[1], x[0], x[2]))


_BEGINS = bytes(int(b & 0xC0 != 0x80) for b in range(256))
_SCANNERS: dict[tuple[str, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """The scanner of the rules, built once in a worker."""
    key = tuple(r.kind for r in rules)
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(rules)
    return _SCANNERS[key]


def scanned(docs: DataFrame) -> DataFrame:
    """docs with secrets (array of kind, start, end; code points, end exclusive), by start, then rule.

    Null and empty texts have none; every row, a repeated one too, is scanned for itself. The name gets underscores in front if docs has it already.
    """
    at = docs.columns.index("text")
    name = free_name(docs, "secrets")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def fill(batch: pa.RecordBatch) -> list:
        s = scanner()
        found = [[{"kind": s.kinds[i], "start": a, "end": b} for i, a, b in s.scan(t.as_py())] for t in batch.column(at)]
        return [pa.array(found, kind)]

    return mapped(docs, f"`{name}` array<struct<kind:string,start:bigint,end:bigint>>", fill)


MASK = "[SECRET]"


def masked(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text with a mark in place of each stretch that spans cover."""
    if text is None:
        return None
    out, end = [], 0
    for a, b in sorted(spans):
        if a >= end:
            out += [text[end:a], MASK]
        end = max(end, b)
    return "".join([*out, text[end:]])


def without_secrets(docs: DataFrame) -> DataFrame:
    """docs with every secret masked; n_chars, where docs has it, follows the text that changed.

    Every row is kept, repeated ones too. Null and empty texts stay as they are.
    """
    at = docs.columns.index("text")
    new = free_name(docs, "masked")

    def fill(batch: pa.RecordBatch) -> list:
        s = scanner()
        texts = [t.as_py() for t in batch.column(at)]
        return [pa.array([masked(t, [(a, b) for _, a, b in s.scan(t)]) for t in texts], pa.string())]

    rows = mapped(docs, f"`{new}` string", fill)
    changed = ~F.col("text").eqNullSafe(F.col(new))
    out = {"text": F.col(new)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(changed, F.length(new).cast(kind)).otherwise(F.col("n_chars"))
    return rows.withColumns(out).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each document."""
    base = [r.kind for r in BASE]
    rows = scanned(docs.select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        line = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
        return F.array_join(line, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    own = F.filter("secrets", lambda x: x["kind"].isin(base))
    counts = [count(k) for k in base]
    return rows.select("doc_id", *counts, F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
