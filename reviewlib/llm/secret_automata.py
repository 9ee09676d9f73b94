"""Secrets by fixed patterns, and by the formats learned from what those find.

Credentials that the patterns find, by kind, make a prefix tree over character classes. States whose
continuations do not differ significantly are merged (the ALERGIA rule), which leaves a
probabilistic automaton of each kind's format. Every other run of credential characters is then
scored by how much likelier an automaton makes it than ordinary text does.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.llm.common import id_and_text, map_texts, quoted, stored
from reviewlib.llm.words import buffers

# Parameters that bound what an automaton is learned from: credentials of a kind, their length.
SAMPLE = 400
LONGEST = 256
# Fewer credentials of a kind teach nothing.
LEAST = 20
ALPHA = 0.05  # significance of the test that keeps states apart
MARGIN = 20.0  # natural log of the likelihood ratio that makes a run a secret
RUN = 16  # characters of a run at least

KINDS = ("assign", "access", "hex")
LEARNED = "format"
ORDER = (*KINDS, LEARNED)

_ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{RUN},}}")
_WORDS = ("passw", "secret", "token", "api")

# Character classes, the last for all that is in no credential.
_CLASSES = ("abcdef", "ghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/=", "_.-")
_OUTSIDE = len(_CLASSES)
_CLASS_OF = {c: k for k, chars in enumerate(_CLASSES) for c in chars}
# What a continuation that was never seen counts, in place of a probability.
_NEVER = 1e-4


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of the fixed patterns, in code points, by start and kind."""
    found = []
    folded = text.lower()
    if any(w in folded for w in _WORDS):
        found += [
            (m.start(), m.end(), "assign", m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8
        ]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], ORDER.index(s[2]), s[1]))


def classes(text: str) -> list[int]:
    return [_CLASS_OF.get(c, _OUTSIDE) for c in text]


@dataclass
class State:
    """How many credentials passed, ended here, and went on with each class."""

    passed: int = 0
    ended: int = 0
    onward: dict[int, "State"] = field(default_factory=dict)

    def uses(self, symbol: int) -> int:
        return self.onward[symbol].passed if symbol in self.onward else 0


def prefix_tree(strings: list[list[int]]) -> State:
    root = State()
    for string in strings:
        state = root
        state.passed += 1
        for symbol in string:
            state = state.onward.setdefault(symbol, State())
            state.passed += 1
        state.ended += 1
    return root


class Inference:
    """Merges a prefix tree into an automaton, from the root outwards.

    ``counts`` holds, per settled state, how often it was passed, ended in, and left by each
    class. Settled states keep their own table of targets, since a merged tree may loop.
    """

    def __init__(self, tree: State, alpha: float = ALPHA):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.passed: list[int] = []
        self.ended: list[int] = []
        self.used: list[dict[int, int]] = []
        self.target: list[dict[int, int]] = []
        # subtrees hanging off settled states that are not settled themselves yet
        self.open: list[dict[int, State]] = []
        self._settle(tree)
        while True:
            edges = [
                (branch.passed, -s, -symbol)
                for s, branches in enumerate(self.open)
                for symbol, branch in branches.items()
            ]
            if not edges:
                break
            _, s, symbol = max(edges)  # the branch with the most evidence
            self._place(-s, -symbol)

    def _settle(self, state: State) -> int:
        self.passed.append(state.passed)
        self.ended.append(state.ended)
        self.used.append({k: x.passed for k, x in state.onward.items()})
        self.target.append({})
        self.open.append(dict(state.onward))
        return len(self.passed) - 1

    def _place(self, source: int, symbol: int) -> None:
        branch = self.open[source].pop(symbol)
        for state in range(len(self.passed)):
            if self._alike(state, branch):
                self.target[source][symbol] = state
                self._absorb(state, branch)
                return
        self.target[source][symbol] = self._settle(branch)

    def _differ(self, hits: int, n: int, other_hits: int, other_n: int) -> bool:
        if not n or not other_n:
            return False
        reach = self.bound * (n**-0.5 + other_n**-0.5)
        return abs(hits / n - other_hits / other_n) > reach

    def _alike(self, state: int, branch: State) -> bool:
        """Whether the branch ends and goes on like the state, and so on below both."""
        pairs: list[tuple[int | State, State]] = [(state, branch)]
        while pairs:
            one, other = pairs.pop()
            settled = isinstance(one, int)
            n = self.passed[one] if settled else one.passed
            ends = self.ended[one] if settled else one.ended
            if self._differ(ends, n, other.ended, other.passed):
                return False
            symbols = set(other.onward) | set(self.used[one] if settled else one.onward)
            for symbol in symbols:
                uses = self.used[one].get(symbol, 0) if settled else one.uses(symbol)
                if self._differ(uses, n, other.uses(symbol), other.passed):
                    return False
                if symbol in other.onward:
                    if settled and symbol in self.target[one]:
                        pairs.append((self.target[one][symbol], other.onward[symbol]))
                    else:
                        below = (self.open[one] if settled else one.onward).get(symbol)
                        if below is not None:
                            pairs.append((below, other.onward[symbol]))
        return True

    def _absorb(self, state: int, branch: State) -> None:
        """Adds the counts of a branch to a state and to what follows it."""
        pairs: list[tuple[int | State, State]] = [(state, branch)]
        while pairs:
            one, other = pairs.pop()
            if isinstance(one, int):
                self.passed[one] += other.passed
                self.ended[one] += other.ended
                for symbol, below in other.onward.items():
                    self.used[one][symbol] = self.used[one].get(symbol, 0) + below.passed
                    if symbol in self.target[one]:
                        pairs.append((self.target[one][symbol], below))
                    elif symbol in self.open[one]:
                        pairs.append((self.open[one][symbol], below))
                    else:
                        self.open[one][symbol] = below
            else:
                one.passed += other.passed
                one.ended += other.ended
                for symbol, below in other.onward.items():
                    if symbol in one.onward:
                        pairs.append((one.onward[symbol], below))
                    else:
                        one.onward[symbol] = below

    def automaton(self) -> "Automaton":
        step, cost = [], []
        for passed, ended, used, target in zip(self.passed, self.ended, self.used, self.target):
            step.append([target.get(k, -1) for k in range(len(_CLASSES))])
            cost.append(
                [math.log(max(used.get(k, 0) / passed, _NEVER)) for k in range(len(_CLASSES))]
                + [math.log(max(ended / passed, _NEVER))]
            )
        return Automaton(step, cost)


@dataclass
class Automaton:
    """Targets and log probabilities per state and class; the last probability is of ending."""

    step: list[list[int]]
    cost: list[list[float]]

    def likelihood(self, string: list[int]) -> float:
        state, total = 0, 0.0
        for i, symbol in enumerate(string):
            if symbol == _OUTSIDE:
                return -math.inf
            total += self.cost[state][symbol]
            state = self.step[state][symbol]
            if state < 0:
                # nothing of the kind went on like this
                return total + (len(string) - i) * math.log(_NEVER)
        return total + self.cost[state][-1]


@dataclass
class Formats:
    """Automata by kind, and the log probabilities of class after class in all texts."""

    automata: dict[str, Automaton]
    text: list[list[float]]

    def ordinary(self, string: list[int]) -> float:
        total, before = 0.0, _OUTSIDE
        for symbol in (*string, _OUTSIDE):
            total += self.text[before][symbol]
            before = symbol
        return total

    def score(self, run: str) -> float:
        """How much likelier than ordinary text the likeliest format makes a run."""
        if not self.automata:
            return -math.inf
        string = classes(run)
        best = max(a.likelihood(string) for a in self.automata.values())
        return best - self.ordinary(string)

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Base spans and the runs outside them whose score reaches the margin."""
        base = [s[:3] for s in base_spans(text)]
        found = list(base)
        for m in _RUN.finditer(text):
            apart = all(m.end() <= a or b <= m.start() for a, b, _ in base)
            if apart and self.score(m[0]) >= MARGIN:
                found.append((m.start(), m.end(), LEARNED))
        return sorted(found, key=lambda s: (s[0], ORDER.index(s[2]), s[1]))


def _evidence(docs: DataFrame) -> DataFrame:
    """``kind``, ``value``, ``n``: how often each credential was found and, for kind ``text``, each pair of
    classes of neighbouring bytes occurs outside what was found."""
    table = np.full(256, _OUTSIDE, np.uint8)
    for char, k in _CLASS_OF.items():
        table[ord(char)] = k
    size = _OUTSIDE + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            offsets, data = buffers(batch.column(1))
            pairs = np.zeros(size * size, np.int64)
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = np.concatenate([[_OUTSIDE], table[data[a:b]], [_OUTSIDE]]).astype(np.uint8)
                pairs += np.bincount(own[:-1] * np.uint8(size) + own[1:], minlength=size * size)
            for text in batch.column(1).fill_null("").to_pylist():
                reached = 0
                for start, end, kind, value in base_spans(text):
                    if len(value) <= LONGEST:
                        counts[kind, value] = counts.get((kind, value), 0) + 1
                    own = classes(text[max(start, reached) : end])
                    for a, b in zip(own[:-1], own[1:]):
                        pairs[a * size + b] -= 1
                    reached = max(reached, end)
            for pair in np.flatnonzero(pairs):
                counts["text", str(pair)] = int(pairs[pair])
            kinds, values = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(counts.values(), pa.int64())],
                names=["kind", "value", "n"],
            )

    found = docs.mapInArrow(run, "kind string, value string, n long")
    return found.groupBy("kind", "value").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Formats:
    """Automata of the kinds that all texts have enough credentials of.

    Class pairs are counted over all texts. An automaton is learned from at most ``sample`` different
    credentials of its kind, the first by a hash, none longer than ``LONGEST``.
    """
    evidence = stored(_evidence(id_and_text(docs, id, text)))
    size = _OUTSIDE + 1
    pairs = np.ones((size, size))
    for value, n in evidence.filter("kind = 'text'").select("value", "n").collect():  # 49 rows at most
        pairs[divmod(int(value), size)] += n
    automata = {}
    for kind in KINDS:
        own = evidence.filter(F.col("kind") == kind).select("value")
        chosen = own.orderBy(F.xxhash64("value"), "value").limit(sample).collect()
        if len(chosen) >= LEAST:
            tree = prefix_tree(sorted(classes(r[0]) for r in chosen))
            automata[kind] = Inference(tree).automaton()
    return Formats(automata, np.log(pairs / pairs.sum(1, keepdims=True)).tolist())


_SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)
_SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def find(docs: DataFrame, formats: Formats, text: str = "text") -> DataFrame:
    """``docs`` plus ``secrets``: the spans (``kind``, ``start``, ``end`` in code points, end exclusive) of all
    secrets by start, then kind. A null or empty text has none. No shuffle."""

    def make():
        def run(texts: pa.Array) -> list[pa.Array]:
            rows = [
                [{"kind": k, "start": a, "end": b} for a, b, k in formats.spans(t)]
                for t in texts.fill_null("").to_pylist()
            ]
            return [pa.array(rows, pa.list_(_SPAN_ARROW))]

        return run

    return map_texts(docs, text, T.StructType([T.StructField("secrets", T.ArrayType(_SPAN))]), make)


def redact(docs: DataFrame, formats: Formats, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret of the text replaced by ``mark``; overlapping ones by one mark. A null
    text stays null."""

    def make():
        def clean(value: str | None) -> str | None:
            if not value:
                return value
            parts, at, open_to = [], 0, -1
            for start, end, _ in formats.spans(value):
                if start >= open_to:
                    parts += [value[at:start], mark]
                open_to = at = max(open_to, end)
            return "".join(parts) + value[at:] if parts else value

        return lambda texts: [pa.array([clean(t) for t in texts.to_pylist()], pa.string())]

    kept = docs.columns
    out = map_texts(docs, text, T.StructType([T.StructField(text, T.StringType())]), make)
    return out.select(*(quoted(c) for c in kept))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
