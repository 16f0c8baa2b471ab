"""Secret scan: one deterministic automaton for all rules, run over the bytes of texts.

The rules' whole patterns are compiled together: Thompson construction, subset
construction over byte classes, minimisation. Texts are cut at bytes that no rule
contains, which bring every state back to the start, and the pieces run through the
transition array side by side, in one pass that tells where matches of each rule end.
Around such ends, up to the next byte foreign to the rule, the starts are read off the
array of the reversed pattern, and from the leftmost start the rule's own array runs to
the longest match. A private key's span goes on over its body to its last line.
"""

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import cached_property, lru_cache
from re import _constants as sre, _parser as parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolecall.llm import batches, wordbytes


#: Pieces of text that are stepped through side by side, at least; fewer go one by one.
FEW = 12


@dataclass(frozen=True)
class Rule:
    """Matches are ``head`` then ``tail``: the leftmost ones that do not overlap, each as
    long as it can be. One whose tail has fewer than ``least`` bytes does not count."""

    kind: str
    tail: bytes
    least: int = 0
    head: bytes = b""
    body: bool = False  # a match is the first line of a key; the span goes on to the key's end

    @property
    def pattern(self) -> bytes:
        return self.head + self.tail


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The rules.
_KEYS = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + f"|{_either_case('api')}_?{_either_case('key')}"
BASE = (
    Rule("assign", rb"[A-Za-z0-9+/_.=-]+", 12, rf"""(?:{_KEYS})["']?\x20*[:=]\x20*["']?""".encode()),
    Rule("access", rb"AKIA[A-Z0-9]+", 18),
    Rule("hex", rb"[0-9a-f]{16,}"),
)
RULES = (
    *BASE,
    Rule("private", rb"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----", body=True),
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 34),
)
# The first or last line of any PEM block: where a key's body ends.
_EDGE = Rule("edge", rb"-----(?:BEGIN|END)\x20[A-Z0-9\x20]+-----")

# A key without a last line: its own headers, long runs of base64, then what is left of a last run. Line
# ends may be escaped, as in JSON, and lines quoted, as in mails and code.
_GAP = rb"(?:[ \t\r\n>#*|\"',;]|\\+[nrt])*"
_RUN = rb"(?:[A-Za-z0-9+/=]|\\+/)"
_CUT_OFF = re.compile(
    rb"(?:%(gap)s(?:Proc-Type|DEK-Info):[^\r\n\\]*)*"
    rb"(?:(?:%(gap)s%(run)s{16,})+(?:%(gap)s%(run)s*=(?!%(run)s)|[ \t]*(?:[\r\n]|\\+[nr])%(gap)s%(run)s+(?=[ \t]*(?:[\r\n\\\"',;]|\Z)))?)?"
    % {b"gap": _GAP, b"run": _RUN}
)


def _key_end(text: memoryview, at: int, edges: list[tuple[int, int]]) -> int:
    """Where the key ends whose first line ends at ``at``: behind its last line if that is the next
    edge of a block, else behind its base64."""
    next_ = bisect_left(edges, (at, 0))
    start, end = edges[next_] if next_ < len(edges) else (len(text), -1)
    line = bytes(text[start:end]) if end >= 0 else b""
    if line.startswith(b"-----END ") and line.endswith(b"PRIVATE KEY-----"):
        return end
    return _CUT_OFF.match(text, at, start).end()


class _Nfa:
    """Thompson's construction over the parse tree of a byte regex."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, tree, at: int, back: bool = False) -> int:
        """Adds the tree (or with ``back`` its mirror image) after state ``at``; returns the
        state in which it ends."""
        for kind, value in reversed(list(tree)) if back else tree:
            if kind in (sre.LITERAL, sre.IN):
                end = self.state()
                here = self.state()
                self.empty[at].append(here)
                self.step[here] = (_bytes_of(kind, value), end)
                at = end
            elif kind is sre.SUBPATTERN:
                at = self.add(value[3], at, back)
            elif kind is sre.BRANCH:
                end = self.state()
                for way in value[1]:
                    begin = self.state()
                    self.empty[at].append(begin)
                    self.empty[self.add(way, begin, back)].append(end)
                at = end
            elif kind is sre.MAX_REPEAT:
                low, high, part = value
                for _ in range(low):
                    at = self.add(part, at, back)
                if high is sre.MAXREPEAT:
                    loop = self.state()
                    self.empty[at].append(loop)
                    self.empty[self.add(part, loop, back)].append(loop)
                    at = loop
                elif high > low:
                    end = self.state()
                    for _ in range(high - low):
                        self.empty[at].append(end)
                        at = self.add(part, at, back)
                    self.empty[at].append(end)
                    at = end
            else:
                raise ValueError(f"not in a rule: {kind}")
        return at

    def closure(self, states) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            for to in self.empty[todo.pop()]:
                if to not in out:
                    out.add(to)
                    todo.append(to)
        return frozenset(out)


def _bytes_of(kind, value) -> frozenset[int]:
    if kind is sre.LITERAL:
        return frozenset([value])
    out: set[int] = set()
    for what, x in value:
        if what is sre.LITERAL:
            out.add(x)
        elif what is sre.RANGE:
            out.update(range(x[0], x[1] + 1))
        else:
            raise ValueError(f"not in a rule: {what}")
    return frozenset(out)


def alphabet(pattern: bytes) -> np.ndarray:
    """For each byte, whether a match of the pattern can contain it."""
    nfa = _Nfa()
    nfa.add(parser.parse(pattern), nfa.state())
    out = np.zeros(256, bool)
    for step in nfa.step:
        out[list(step[0]) if step else []] = True
    return out


def _arrays(patterns: list[bytes], anywhere: bool, back: bool = False):
    """(table, bits, classes): the minimal automaton of some patterns, that begin at the
    first byte or (``anywhere``) at each. State 0 is the start; ``table[state, class]`` is
    the next state, ``bits[state]`` the patterns of which a match ends there."""
    nfa = _Nfa()
    start, ends = nfa.state(), {}
    for bit, pattern in enumerate(patterns):
        begin = nfa.state()
        nfa.empty[start].append(begin)
        ends[nfa.add(parser.parse(pattern), begin, back)] = 1 << bit
    # bytes that no step tells apart are one class
    sets = sorted({step[0] for step in nfa.step if step}, key=sorted)
    signature = [tuple(b in s for s in sets) for b in range(256)]
    kinds = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    classes = np.array([kinds[s] for s in signature], np.uint8)
    example = [signature.index(s) for s in kinds]

    first = nfa.closure([start])
    numbers, todo, rows, found = {first: 0}, [first], [], []
    closures: dict[int, frozenset[int]] = {}
    for states in todo:
        found.append(sum({ends[s] for s in states if s in ends}))
        steps = [nfa.step[s] for s in states if nfa.step[s]]
        row = []
        for byte in example:
            to = set(first) if anywhere else set()
            for among, end in steps:
                if byte in among:
                    if end not in closures:
                        closures[end] = nfa.closure([end])
                    to |= closures[end]
            to = frozenset(to)
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            row.append(numbers[to])
        rows.append(row)

    table, block = np.array(rows), np.unique(found, return_inverse=True)[1]
    while True:  # states stay together as long as all their steps lead to the same blocks
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    _, member = np.unique(block, return_index=True)
    place = np.argsort(np.argsort(member != member[block[0]], kind="stable"), kind="stable")  # the start comes first
    order = np.argsort(place)
    return place[block[table[member[order]]]], np.array(found)[member[order]], classes


@dataclass(frozen=True)
class Automaton:
    table: np.ndarray  # states times byte classes -> state, flat; state numbers are times the number of classes
    classes: np.ndarray  # byte -> class
    start: int
    accepting: int  # from this state on, states accept
    found: np.ndarray  # (accepting state - accepting) / classes -> bits of the rules of which a match ends here
    foreign: np.ndarray  # byte -> in no rule

    @cached_property
    def steps(self) -> list[int]:
        return self.table.tolist()


def compile_rules(rules: tuple[Rule, ...]) -> Automaton:
    """The minimal automaton that looks for all rules at once, at every place."""
    table, bits, classes = _arrays([r.pattern for r in rules], anywhere=True)
    order = np.argsort(bits > 0, kind="stable")  # accepting states last
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    n, accepting = table.shape[1], int((bits == 0).sum())
    allowed = np.any([alphabet(r.pattern) for r in rules], axis=0)
    return Automaton(
        (place[table[order]] * n).astype(np.int32).ravel(), classes, int(place[0]) * n, accepting * n, bits[order][accepting:], ~allowed
    )


def match_ends(auto: Automaton, data: np.ndarray, offsets: np.ndarray, piece: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the last bytes of matches, and the rules' bits there."""
    cuts = np.flatnonzero(auto.foreign[data])
    bounds = np.unique(np.concatenate([offsets, cuts[np.unique(np.searchsorted(cuts, np.arange(0, len(data), piece)))[:-1]] if len(cuts) else cuts]))
    begin, length = bounds[:-1], np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    at, length = begin[order], length[order]
    states = np.full(len(at), auto.start, np.int32)
    symbol, classes = auto.classes[data], int(auto.classes.max()) + 1
    places, ends = [], []
    active = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), "right")
    together = int(np.searchsorted(-active, -FEW, "right"))  # so many steps; then the few pieces left one by one
    for step, n in enumerate(active[:together].tolist()):
        if n < len(states):
            states = states[:n]
        states = auto.table[states + symbol[at[:n] + step]]
        if states.max() >= auto.accepting:
            hit = np.flatnonzero(states >= auto.accepting)
            places.append(at[hit] + step)
            ends.append(states[hit])
    if together < len(active):
        table, accepting = auto.steps, auto.accepting
        for begin, end, state in zip((at + together).tolist(), (at + length).tolist(), states[: active[together]].tolist(), strict=False):
            here, met = [], []
            for place, s in enumerate(symbol[begin:end].tolist(), begin):
                state = table[state + s]
                if state >= accepting:
                    here.append(place)
                    met.append(state)
            places.append(np.array(here, np.int64))
            ends.append(np.array(met, np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), auto.found[(np.concatenate(ends) - auto.accepting) // classes]


class Reader:
    """The arrays of one rule, for the few bytes around the ends of its matches."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.foreign = ~alphabet(rule.pattern)
        self.whole = self._lists(*_arrays([rule.pattern], anywhere=False))
        self.head = self._lists(*_arrays([rule.head], anywhere=False))
        self.back = self._lists(*_arrays([rule.pattern], anywhere=True, back=True))

    @staticmethod
    def _lists(table, bits, classes):
        dead = [bool(bit == 0 and (row == i).all()) for i, (row, bit) in enumerate(zip(table, bits, strict=True))]
        return table.tolist(), [bool(b) for b in bits], classes.tolist(), dead

    @staticmethod
    def _longest(arrays, data: bytes, at: int) -> int:
        """Where the longest match from ``at`` ends, -1 without one."""
        table, accepts, classes, dead = arrays
        state, end = 0, at if accepts[0] else -1
        for place in range(at, len(data)):
            state = table[state][classes[data[place]]]
            if accepts[state]:
                end = place + 1
            elif dead[state]:
                break
        return end

    def matches(self, data: bytes) -> list[tuple[int, int]]:
        """(start, end) of the leftmost longest matches that do not overlap, without those
        whose tail is too short."""
        table, accepts, classes, _ = self.back
        starts, state = [], 0
        for place in range(len(data) - 1, -1, -1):
            state = table[state][classes[data[place]]]
            if accepts[state]:
                starts.append(place)
        out, done = [], 0
        for start in reversed(starts):
            if start >= done:
                done = self._longest(self.whole, data, start)
                tail = self._longest(self.head, data, start) if self.rule.head else start
                if done - tail >= self.rule.least:
                    out.append((start, done))
        return out


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    auto: Automaton  # of the rules and of the edges of keys
    readers: tuple[Reader, ...]

    @staticmethod
    @lru_cache(4)
    def of(rules: tuple[Rule, ...]) -> "Scanner":
        every = (*rules, *([_EDGE] if any(r.body for r in rules) else []))
        return Scanner(tuple(rules), compile_rules(every), tuple(Reader(r) for r in every))

    def spans(self, column) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule, end) in code points, in order."""
        data, offsets = wordbytes.utf8(column)
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
        for first, last in wordbytes.steps(offsets):
            low = int(offsets[first])
            part, of = data[low : offsets[last]], offsets[first : last + 1] - low
            places, bits = match_ends(self.auto, part, of)
            edges: dict[int, list[tuple[int, int]]] = {}
            for k in range(len(self.readers) - 1, -1, -1):  # the edges first
                reader = self.readers[k]
                hits = np.sort(places[bits & (1 << k) > 0])
                done = -1
                for hit in hits.tolist():
                    if hit < done:
                        continue
                    row = int(np.searchsorted(of, hit, "right")) - 1
                    base = int(of[row])
                    begin, done = _around(reader.foreign, part, hit, base, int(of[row + 1]))
                    for a, b in reader.matches(part[begin:done].tobytes()):
                        a, b = begin + a - base, begin + b - base
                        if k == len(self.rules):
                            edges.setdefault(row, []).append((a, b))
                            continue
                        if reader.rule.body:
                            b = _key_end(memoryview(part[base : of[row + 1]]), b, edges.get(row, []))
                        out[first + row].append((a, k, b))
            for row in range(first, last):
                if out[row]:
                    text = data[offsets[row] : offsets[row + 1]]
                    points = np.concatenate([[0], np.cumsum(text & 0xC0 != 0x80)])
                    out[row] = sorted((int(points[a]), k, int(points[b])) for a, k, b in out[row])
        return out


def _around(foreign: np.ndarray, data: np.ndarray, hit: int, low: int, high: int) -> tuple[int, int]:
    """The bytes around ``hit`` between foreign ones, within [low, high)."""
    begin, size = hit, 64
    while begin > low:
        from_ = max(low, begin - size)
        stops = np.flatnonzero(foreign[data[from_:begin]])
        if len(stops):
            begin = from_ + int(stops[-1]) + 1
            break
        begin, size = from_, size * 2
    end, size = hit + 1, 64
    while end < high:
        to = min(high, end + size)
        stops = np.flatnonzero(foreign[data[end:to]])
        if len(stops):
            end += int(stops[0])
            break
        end, size = to, size * 2
    return begin, end


def _redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _scanner(spark: SparkSession, rules: tuple[Rule, ...]):
    return spark.sparkContext.broadcast(Scanner.of(tuple(rules)))


def secret_spans(spark: SparkSession, text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """array<struct<kind, start, end>> of a text: code points, end exclusive, ordered by
    start, then by the order of the rules. Per kind, the leftmost matches that do not
    overlap, without those that are too short; kinds may overlap. Null and empty texts
    have none. Texts are taken whole, whatever their length."""
    shared = _scanner(spark, rules)

    @F.arrow_udf("array<struct<kind:string,start:int,end:int>>")
    def scan(texts: pa.Array) -> pa.Array:
        kinds = [r.kind for r in shared.value.rules]
        return pa.array(
            [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in spans] for spans in shared.value.spans(texts)],
            pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
        )

    return scan(text)


def redact_secrets(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """Replaces every span (overlapping ones as one) by ``mark``; other texts, nulls and
    other columns stay as they are. A projection: no shuffle."""
    shared = _scanner(df.sparkSession, rules)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        found = shared.value.spans(texts)
        batches.give_back()
        changed = [i for i, spans in enumerate(found) if spans]
        # the other texts of the batch stay Arrow memory
        new = pa.array([_redacted(texts[i].as_py(), found[i], mark) for i in changed], texts.type)
        return pc.replace_with_mask(texts, pa.array([bool(spans) for spans in found], pa.bool_()), new)

    return df.withColumn(text, clean(F.col(text)))
