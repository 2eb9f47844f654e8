"""Secret scans by grammar inference: probabilistic automata of credential formats.

1. Fixed rules find the base credentials of three kinds; they label their texts. Each task keeps a bounded number
   of distinct labelled credentials per kind, and of runs that look like nothing in particular, by least hash, and
   of those the ``SAMPLE`` with the least hashes over all are learned from.
2. Per kind, the sample becomes a prefix tree with counts. States whose ends and symbols are statistically
   compatible (Hoeffding bounds, on all their successors too) are merged, first those nearest to the root. What
   is left is a deterministic automaton that gives each string a probability, smoothed by the kind as a whole. What is
   usual for a kind is told by cross-fitting: either half of the sample under the automaton of the other.
3. Every run of ``LEAST`` or more credential characters in every whole text is a candidate. Its score is the
   log-likelihood under a kind's automaton less that under the automaton of plain runs, in bits a symbol. A
   candidate that a kind explains better than plain text by ``MARGIN``, about as well as the kind's own sample,
   and that is no shorter than the shortest of those, is a span of that kind, unless it meets a base span.

The bounds on the sample (``SAMPLE`` strings of up to ``WIDEST`` characters per kind) hold for learning only.

Defined results: null and empty texts have no spans; positions count code points, the end is exclusive. Repeated
rows each get their result. Without labelled credentials nothing is added to the base spans. Of two kinds with one
score the first in ``KINDS`` counts. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import slices, text_of
from adloom.session import durable, ship_package

# The patterns and least lengths of the three kinds of base credentials.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run and its least length in one, as no run begins inside another
_LEAST = {"assign": 12, "access": 18}
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

PLAIN = "plain"
ALPHABET = 26 + 26 + 10 + len("+/_.=-")
LEAST = 12  # characters of a candidate
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
SAMPLE = 500  # strings per kind to learn from
WIDEST = 256  # characters of such a string
CONFIDENCE = 0.05  # that two compatible states are taken apart
SMOOTHING = 0.1  # of the symbols of a kind as a whole
BACKING = 10  # strings that this whole weighs in each state
MARGIN = 1.0  # bits a symbol
OUTLIERS = 0.05  # share of a kind's own sample that need not count as typical of it
SLACK = 0.25  # bits a symbol below the rest of it
BATCH = 1 << 20  # bytes of text that a task scans at once


# --- base rules --------------------------------------------------------------------------------------
def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """``start, kind, end, credential`` of the base rules, by start, then kind."""
    lowered = text.lower()
    found = [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _LEAST["access"]]
    if any(word in lowered for word in _KEYWORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST["assign"]]
    return [(start, KINDS[place], end, credential) for start, place, end, credential in sorted(found)]


def candidates(text: str, base: list[tuple[int, str, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Runs of credential characters that meet no base span."""
    taken = iter(sorted((start, end) for start, _, end, _ in base))
    now = next(taken, None)
    for m in _RUN.finditer(text):
        while now and now[1] <= m.start():
            now = next(taken, None)
        if not now or now[0] >= m.end():
            yield m.start(), m.end(), m[0]


# --- automata ----------------------------------------------------------------------------------------
@dataclass
class State:
    count: int = 0  # strings that reach it
    ends: int = 0
    after: dict[str, int] = field(default_factory=dict)
    times: dict[str, int] = field(default_factory=dict)


def prefix_tree(strings: list[str]) -> list[State]:
    states = [State()]
    for string in strings:
        here = 0
        states[0].count += 1
        for symbol in string:
            state = states[here]
            state.times[symbol] = state.times.get(symbol, 0) + 1
            if symbol not in state.after:
                state.after[symbol] = len(states)
                states.append(State())
            here = state.after[symbol]
            states[here].count += 1
        states[here].ends += 1
    return states


def _differ(f: int, n: int, g: int, m: int, width: float) -> bool:
    return abs(f / n - g / m) > width * (n**-0.5 + m**-0.5)


def _compatible(states: list[State], a: int, b: int, width: float) -> bool:
    """Whether ends and symbols of both states, and of all that follows the tree state ``b``, could be one's."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        one, two = states[a], states[b]
        if _differ(one.ends, one.count, two.ends, two.count, width):
            return False
        for symbol in {*one.times, *two.times}:
            if _differ(one.times.get(symbol, 0), one.count, two.times.get(symbol, 0), two.count, width):
                return False
        todo += [(one.after[s], two.after[s]) for s in two.after if s in one.after]
    return True


def _fold(states: list[State], a: int, b: int) -> None:
    """Add the tree below ``b`` to the automaton at ``a``."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        one, two = states[a], states[b]
        one.count, one.ends = one.count + two.count, one.ends + two.ends
        for symbol, n in two.times.items():
            one.times[symbol] = one.times.get(symbol, 0) + n
            if symbol in one.after:
                todo.append((one.after[symbol], two.after[symbol]))
            else:
                one.after[symbol] = two.after[symbol]


@dataclass
class Automaton:
    """A format: bits of each symbol and of the end per state, and what its own sample looks like.

    A symbol that a state has not met has the bits of leaving the state's own counts for the kind as a whole, and
    leads where it most often leads.
    """

    steps: list[dict[str, tuple[float, int]]]
    leave: list[float]
    ends: list[float]
    overall: dict[str, tuple[float, int]]
    rare: float
    least_bits: float = 0.0
    shortest: int = LEAST

    def bits(self, string: str) -> float:
        """Log-likelihood in bits a symbol, the end counted as one."""
        here, total = 0, 0.0
        steps, leave = self.steps, self.leave
        for symbol in string:
            step = steps[here].get(symbol)
            if step is None:
                bits, behind = self.overall.get(symbol, (self.rare, here))
                total += leave[here] + bits
                here = behind
            else:
                total += step[0]
                here = step[1]
        return (total + self.ends[here]) / (len(string) + 1)


def infer(strings: list[str], confidence: float = CONFIDENCE) -> Automaton:
    """The automaton of a sample of strings; repeated ones count."""
    states = prefix_tree(sorted(strings))
    width = math.sqrt(0.5 * math.log(2 / confidence))
    red, blue = [0], deque((0, s) for s in sorted(states[0].after))
    while blue:
        parent, symbol = blue.popleft()
        state = states[parent].after[symbol]
        if state in red:
            continue
        for other in sorted(red, key=lambda r: -states[r].count):  # a rare state tells little; the common one it fits is the likelier
            if _compatible(states, other, state, width):
                states[parent].after[symbol] = other
                _fold(states, other, state)
                break
        else:
            red.append(state)
        # what hangs on any merged state now may be new
        if not blue:
            known = set(red)
            blue.extend((r, s) for r in red for s in sorted(states[r].after) if states[r].after[s] not in known)
    place = {s: i for i, s in enumerate(red)}
    totals: dict[str, int] = {}
    for r in red:
        for symbol, n in (*states[r].times.items(), ("", states[r].ends)):
            totals[symbol] = totals.get(symbol, 0) + n
    every = sum(totals.values()) + SMOOTHING * (ALPHABET + 1)
    overall = {symbol: (n + SMOOTHING) / every for symbol, n in totals.items()}
    share = lambda n, symbol, state: math.log2((n + BACKING * overall[symbol]) / (state.count + BACKING))
    steps = [{s: (share(n, s, states[r]), place[states[r].after[s]]) for s, n in states[r].times.items()} for r in red]
    leave = [math.log2(BACKING / (states[r].count + BACKING)) for r in red]
    ends = [share(states[r].ends, "", states[r]) for r in red]
    usual = {s: max((states[r].times.get(s, 0), place[states[r].after[s]]) for r in red if s in states[r].after)[1] for s in totals if s}
    return Automaton(steps, leave, ends, {s: (math.log2(overall[s]), to) for s, to in usual.items()}, math.log2(SMOOTHING / every))


def fit(strings: list[str]) -> Automaton:
    """The automaton of distinct strings, and how likely it finds strings like them that it was not made from.

    Either half of the sample is judged by the automaton of the other half.
    """
    made = infer(strings)
    halves = strings[::2], strings[1::2]
    judged = [half.bits(s) for half, other in ((infer(halves[0]), halves[1]), (infer(halves[1]), halves[0])) for s in other]
    made.least_bits = sorted(judged)[int(OUTLIERS * len(judged))]
    made.shortest = min(map(len, strings))
    return made


# --- over tables -------------------------------------------------------------------------------------
def labelled_strings(documents: DataFrame, sample: int = SAMPLE, widest: int = WIDEST) -> DataFrame:
    """``kind, string, mark``: distinct credentials per kind, and plain runs, of least hash; ``sample`` a task at most."""
    ship_package(documents.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[str, int]] = {kind: {} for kind in (*KINDS, PLAIN)}
        most = dict.fromkeys(kept, 1 << 63)

        def offer(kind: str, string: str) -> None:
            mark = xxhash.xxh64_intdigest(string) >> 1
            if mark < most[kind] and len(string) <= widest:
                own = kept[kind]
                own[string] = mark
                if len(own) >= 2 * sample:
                    least = sorted(own.items(), key=lambda x: (x[1], x[0]))[:sample]
                    kept[kind], most[kind] = dict(least), least[-1][1] + 1

        for batch in slices(batches, limit=BATCH):
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                for _, kind, _, credential in base:
                    offer(kind, credential)
                for _, _, run in candidates(text, base):
                    offer(PLAIN, run)
        rows = [(kind, s, m) for kind, own in kept.items() for s, m in sorted(own.items(), key=lambda x: (x[1], x[0]))[:sample]]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "string", "mark"])

    return text_of(documents).mapInArrow(gather, "kind string, string string, mark bigint")


def learn_formats(documents: DataFrame, sample: int = SAMPLE, widest: int = WIDEST) -> dict[str, Automaton]:
    """The automaton of each kind that occurs, and of plain runs; ``sample`` strings a kind reach the driver."""
    every = durable(labelled_strings(documents, sample, widest)).distinct()
    formats = {}
    for kind in (*KINDS, PLAIN):
        least = every.where(F.col("kind") == kind).orderBy("mark", "string").limit(sample)
        strings = [r["string"] for r in least.collect()]
        if strings:
            formats[kind] = fit(strings)
    return formats


def judge(run: str, formats: dict[str, Automaton]) -> tuple[str, float] | None:
    """Kind and score of a candidate that is a credential by its format."""
    plain = formats[PLAIN].bits(run) if PLAIN in formats else -math.log2(ALPHABET + 1)
    best = None
    for kind in KINDS:
        automaton = formats.get(kind)
        if automaton is None or len(run) < automaton.shortest:
            continue
        bits = automaton.bits(run)
        if bits >= automaton.least_bits - SLACK and bits - plain >= MARGIN and (best is None or bits - plain > best[1]):
            best = (kind, bits - plain)
    return best


_SPANS = "array<struct<kind: string, start: bigint, end: bigint, base: boolean, score: double>>"


def find_secrets(documents: DataFrame, formats: dict[str, Automaton]) -> DataFrame:
    """``doc_id`` and ``spans`` of every row: base spans (no score) and added ones, by start, then kind."""
    ship_package(documents.sparkSession)
    order = {kind: i for i, kind in enumerate(KINDS)}
    kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))

    def spans(text: str) -> list[dict]:
        base = base_spans(text)
        out = [{"kind": kind, "start": start, "end": end, "base": True, "score": None} for start, kind, end, _ in base]
        for start, end, run in candidates(text, base) if formats else ():
            verdict = judge(run, formats)
            if verdict:
                out.append({"kind": verdict[0], "start": start, "end": end, "base": False, "score": verdict[1]})
        return sorted(out, key=lambda s: (s["start"], order[s["kind"]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BATCH):
            found = [spans(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind_of)], ["doc_id", "spans"])

    rows = text_of(documents, "doc_id")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {_SPANS}")
