"""Secret scanning: fixed patterns, and credential formats learned by grammar inference.

The fixed patterns label credentials.  From a bounded sample of them a prefix tree over character
classes is built per kind, and states whose outgoing frequencies agree within a Hoeffding bound are
merged into a probabilistic automaton.  Every run of credential characters in every text is then a
candidate, scored by its likelihood under the automata against that under a background automaton,
whose states are the last character class and whose counts come from all runs of all documents that
touch no fixed span.  A run is added where it touches no fixed span, is likelier by THRESHOLD per
character, and by enough in all that by chance FALSE ordinary runs of the whole corpus would be so
(under the background a ratio of e^t has probability e^-t at most): short runs must be clearer, and
more so in a larger corpus.  Credentials among the ordinary runs hardly move the background, whose
classes rarely alternate.

NULL and empty texts have no runs; without labelled credentials only the fixed patterns are used.
Very long texts are read whole.  Repeated rows count as often as they occur.  A run that scores the
same under two automata is one span.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import numbered

# The patterns of the contract, with the shortest lengths that count.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 or more
KEYWORDS = ("passw", "secret", "token", "api")
SHORTEST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "grammar")

# Runs of the characters of an assigned credential, from its shortest length on; a full stop does not end one.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{5,}[A-Za-z0-9+/_=-]")
SAMPLE = 400  # labelled credentials per kind to learn from
THRESHOLD = 0.4  # nats per character
FALSE = 1.0  # ordinary runs of the whole corpus, by chance
CACHE = 50_000  # runs whose scores a task keeps
ORDINARY = "ordinary"
CONFIDENCE = 0.05  # of the compatibility test
END = "$"
# Characters per class: how much of a class one character takes.
CLASS_SIZE = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20}
_CLASS_OF = str.maketrans({c: k for k, cs in (("0", "0123456789"), ("a", "abcdef"), ("g", "ghijklmnopqrstuvwxyz"), ("A", "ABCDEF"), ("G", "GHIJKLMNOPQRSTUVWXYZ")) for c in cs})
PRIOR = 0.05
UNSEEN = math.log(1e-4)


def classes(run: str) -> str:
    """Digits 0, hex letters a and A, other letters g and G; marks stand for themselves."""
    return run.translate(_CLASS_OF)


@dataclass
class Automaton:
    """A deterministic probabilistic automaton: per state the next state and count of each symbol."""

    step: list[dict[str, int]] = field(default_factory=list)
    count: list[Counter] = field(default_factory=list)
    logs: list[dict[str, float]] = field(default_factory=list)

    def __post_init__(self) -> None:
        for seen in self.count:
            total = sum(seen.values()) + PRIOR * 16
            self.logs.append({s: math.log((n + PRIOR) / total / CLASS_SIZE.get(s, 1)) for s, n in seen.items()})

    def log_likelihood(self, symbols: str) -> float:
        """Natural log of the probability of a run, given as classes; unseen steps have a small share."""
        state, total = 0, 0.0
        for symbol in symbols + END:
            logs = self.logs[state] if state is not None else {}
            total += logs.get(symbol, UNSEEN)
            state = self.step[state].get(symbol) if state is not None and symbol != END else None
        return total


def _compatible(tree: Automaton, a: int, b: int, bound: float) -> bool:
    """The Hoeffding test on all outgoing shares of two states, and of the states they lead to."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        cx, cy = tree.count[x], tree.count[y]
        nx, ny = sum(cx.values()), sum(cy.values())
        if nx and ny:
            allowed = bound * (1 / math.sqrt(nx) + 1 / math.sqrt(ny))
            if any(abs(cx[s] / nx - cy[s] / ny) > allowed for s in cx.keys() | cy.keys()):
                return False
        stack.extend((tree.step[x][s], tree.step[y][s]) for s in tree.step[x].keys() & tree.step[y].keys() if tree.step[x][s] != tree.step[y][s])
    return True


def _fold(tree: Automaton, into: int, state: int) -> None:
    """Add a subtree to a state: counts add up, missing branches are taken over."""
    stack = [(into, state)]
    while stack:
        x, y = stack.pop()
        tree.count[x].update(tree.count[y])
        for s, target in tree.step[y].items():
            if s in tree.step[x]:
                if tree.step[x][s] != target:
                    stack.append((tree.step[x][s], target))
            else:
                tree.step[x][s] = target


def infer(runs: list[str], confidence: float = CONFIDENCE) -> Automaton:
    """Merge the compatible states of the prefix tree of ``runs``, in breadth-first order."""
    tree = Automaton([{}], [Counter()])
    for run in sorted(runs):
        state = 0
        for c in classes(run):
            tree.count[state][c] += 1
            if c not in tree.step[state]:
                tree.step[state][c] = len(tree.step)
                tree.step.append({})
                tree.count.append(Counter())
            state = tree.step[state][c]
        tree.count[state][END] += 1
    bound = math.sqrt(0.5 * math.log(2 / confidence))
    red: list[int] = [0]
    while True:
        blue = sorted({(t, r, s) for r in red for s, t in tree.step[r].items() if t not in red})
        if not blue:
            break
        target, parent, symbol = blue[0]
        merged = next((r for r in red if _compatible(tree, r, target, bound)), None)
        if merged is None:
            red.append(target)
        else:
            tree.step[parent][symbol] = merged
            _fold(tree, merged, target)
    number = {r: i for i, r in enumerate(red)}
    return Automaton([{s: number[t] for s, t in tree.step[r].items()} for r in red], [tree.count[r] for r in red])


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns: leftmost, not overlapping within a kind; whole matches."""
    found: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= SHORTEST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def credential(text: str, span: tuple[int, int, str]) -> str:
    """The part of a span that is the credential itself."""
    run = text[span[0] : span[1]]
    return ASSIGN.match(run)[2] if span[2] == "assign" else run


def pairs(runs: Counter) -> Counter:
    """How often each class follows each other one, the end of a run included; the start is empty."""
    out: Counter = Counter()
    for run, n in runs.items():
        symbols = classes(run)
        for before, after in zip(["", *symbols], [*symbols, END]):
            out[before + after] += n
    return out


def markov(counts: dict[str, int]) -> Automaton:
    """The automaton whose state is the last class, from the counts of ``pairs``."""
    symbols = sorted({k[-1] for k in counts} - {END})
    state = {c: i for i, c in enumerate(["", *symbols])}
    step: list[dict[str, int]] = [{} for _ in state]
    count = [Counter() for _ in state]
    for k, n in sorted(counts.items()):
        count[state[k[:-1]]][k[-1]] += n
        if k[-1] != END:
            step[state[k[:-1]]][k[-1]] = state[k[-1]]
    return Automaton(step, count)


@dataclass(frozen=True)
class Formats:
    """The automata by kind, the background automaton, and the score from which a run is a secret."""

    known: dict[str, Automaton]
    background: Automaton
    threshold: float
    least: float  # log likelihood ratio of a whole run

    def score(self, run: str) -> float:
        """Log likelihood ratio per character, the best kind against the background; a short run counts
        as one that is long enough for ``least`` at the threshold."""
        if not self.known:
            return -math.inf
        symbols = classes(run)
        best = max(a.log_likelihood(symbols) for a in self.known.values())
        return (best - self.background.log_likelihood(symbols)) / max(len(run), self.least / self.threshold)

    @classmethod
    def learn(cls, labelled: list[tuple[str, str]], ordinary: list[str]) -> Formats:
        """From (kind, credential) and ordinary runs."""
        return cls.of(labelled, pairs(Counter(ordinary)))

    @classmethod
    def of(cls, labelled: list[tuple[str, str]], counts: dict[str, int]) -> Formats:
        """From (kind, credential) and the class pairs of all ordinary runs."""
        by: dict[str, set[str]] = {}
        for kind, run in labelled:
            by.setdefault(kind, set()).add(run)
        first = {k: sorted(v, key=lambda r: (xxhash.xxh3_64_intdigest(r), r))[:SAMPLE] for k, v in sorted(by.items())}
        ordinary = sum(n for k, n in counts.items() if k[-1] == END)
        return cls({k: infer(v) for k, v in first.items()}, markov(counts), THRESHOLD, math.log(max(ordinary, 1) / FALSE))


def spans(text: str | None, formats: Formats | None, scores: dict[str, float] | None = None) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind; base spans first of all, grammar spans beside them.
    ``scores`` keeps the scores of runs from call to call."""
    if not text:
        return []
    base = base_spans(text)
    if formats is None or not formats.known:
        return base
    scores = {} if scores is None else scores
    added = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if run not in scores:
            if len(scores) >= CACHE:
                scores.clear()
            scores[run] = formats.score(run)
        if scores[run] >= formats.threshold and not any(s < m.end() and m.start() < e for s, e, _ in base):
            added.append((m.start(), m.end(), "grammar"))
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _labelled(batches):
    """(kind, h, run, n): of each task the labelled runs with the smallest hashes per kind, and the
    class pairs of all its ordinary runs with their counts."""
    by: dict[str, dict[str, int]] = {}
    counts: Counter = Counter()

    def smallest(runs: dict[str, int]) -> dict[str, int]:
        return dict(heapq.nsmallest(SAMPLE, runs.items(), key=lambda x: (x[1], x[0])))

    for batch in batches:
        ordinary: Counter = Counter()
        for text in batch.column(0).to_pylist():
            base = base_spans(text) if text else []
            if base:
                ordinary.update(m[0] for m in CANDIDATE.finditer(text) if not any(s < m.end() and m.start() < e for s, e, _ in base))
            elif text:
                ordinary.update(CANDIDATE.findall(text))
            if len(ordinary) > CACHE:
                counts += pairs(ordinary)
                ordinary.clear()
            for span in base:
                kind, run = span[2], credential(text, span)
                runs = by.setdefault(kind, {})
                if run not in runs:
                    runs[run] = xxhash.xxh3_64_intdigest(run) >> 1
                    if len(runs) > 16 * SAMPLE:
                        by[kind] = smallest(runs)
        counts += pairs(ordinary)
    rows = [(kind, h, run, 0) for kind, runs in by.items() for run, h in smallest(runs).items()]
    rows += [(ORDINARY, 0, k, n) for k, n in counts.items()]
    kinds, marks, runs, ns = zip(*rows, strict=True) if rows else ((), (), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(marks, pa.int64()), pa.array(runs, pa.string()), pa.array(ns, pa.int64())], names=["kind", "h", "run", "n"]
    )


def learned(docs: DataFrame, text: str = "text") -> Formats:
    """Formats from all documents: per kind the SAMPLE distinct labelled runs with the smallest hashes,
    whatever the layout, and the class pairs of every ordinary run."""
    found = docs.select(F.col(text).alias("_text")).mapInArrow(_labelled, "kind string, h long, run string, n long")
    found = found.groupBy("kind", "h", "run").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("h", "run"))
    # There are few classes, so few pairs; the credentials are cut to the sample.
    chosen = found.withColumn("_n", rank).where((F.col("_n") <= SAMPLE) | (F.col("kind") == ORDINARY)).select("kind", "run", "n").collect()
    return Formats.of([(r.kind, r.run) for r in chosen if r.kind != ORDINARY], {r.run: r.n for r in chosen if r.kind == ORDINARY})


def scan(docs: DataFrame, formats: Formats | None, text: str = "text", carry: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """The ``carry`` columns with found (array of kind, start, end: code points, end exclusive) and
    redacted (the text with every span replaced by its kind in brackets; NULL stays NULL).

    NULL and empty texts have no spans.  Without formats only the fixed patterns are used.
    ``prefix`` is put before the new names where carried columns may have them already.
    """
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = ", ".join([*[f"`{c}` {fields[c]}" for c in carry], f"`{prefix}found` array<struct<kind:string,start:int,end:int>>", f"`{prefix}redacted` string"])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        scores: dict[str, float] = {}
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            found = [spans(t, formats, scores) for t in texts]
            listed = [[{"kind": k, "start": s, "end": e} for s, e, k in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(1, batch.num_columns)]
                + [pa.array(listed, kind), pa.array([redact(t, f) for t, f in zip(texts, found, strict=True)], pa.string())],
                names=[*carry, f"{prefix}found", f"{prefix}redacted"],
            )

    return numbered(docs, text, carry).mapInArrow(run, out)


def redact(text: str | None, found: list[tuple[int, int, str]]) -> str | None:
    """Overlapping spans become one, named after the first."""
    if not found:
        return text
    parts, at = [], 0
    for start, end, kind in found:
        if start >= at:
            parts += [text[at:start], f"[{kind} secret]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def digest(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in found)
