"""Secret scans by grammar inference.

Base spans come from three patterns (assignments, access keys, hex runs). Their
values are the labelled credentials: for each kind the prefix tree of at most
``TRAIN_VALUES`` distinct values (those with the smallest hashes) is reduced to
a probabilistic automaton by merging compatible states, two states being
compatible when the frequencies of ending and of every next symbol, and those
of their successors, agree within a Hoeffding bound. Symbols are character
classes; a character costs its class's probability over the class size.

Every other token that may be a credential (a run of 12 or more characters that
labelled values have, whole and in its pieces between dots) is scored by each
automaton against a background automaton of single classes, counted over all such
tokens of the same corpus, per character; a token is added as kind ``format`` when the best score
reaches the level that ``KEEP`` of the training values reach, and is positive.

One pass collects training values (counts are grouped by Spark; only the
bounded training set reaches the driver), one pass scans. Defined results: null
and empty texts have no spans; an added span never overlaps a base span; spans
are in code points, sorted by start, then kind as listed; every row gets its
own result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import written

# The contract's patterns and least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs: the same as dropping the shorter ones
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "format")
# Characters and least length of labelled values.
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}", re.A)
PIECE = re.compile(r"[A-Za-z0-9+/_=-]{12,}", re.A)
LONGEST = 200           # characters of a training value that are learned; a longer one teaches no end
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_", ".", "=", "-")
TRAIN_VALUES = 2_000    # distinct values per kind
ALPHA = 0.05
KEEP = 0.95
# A kind with fewer labelled values has no automaton: with 7 the Hoeffding bound
# is above 1, so that no two states could be told apart.
MIN_VALUES = 8
_CLASS = {c: i for i, cs in enumerate(CLASSES) for c in cs}
_COST = [-math.log(len(cs)) for cs in CLASSES]
END = -1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base finds, kinds by place in KINDS."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """Per token its spans to score, the first accepted counts: the whole token,
    without the dots around it, then (each for itself) its pieces between dots.
    Spans that meet a base span are none."""
    out = []
    starts, ends = [], []  # the base spans as disjoint ones, in order
    for x, _, y in taken:
        if ends and x < ends[-1]:
            ends[-1] = max(ends[-1], y)
        else:
            starts.append(x)
            ends.append(y)

    def free_of(a, b):
        i = bisect_right(ends, a)  # the first that ends behind a
        return i == len(ends) or starts[i] >= b

    for m in TOKEN.finditer(text):
        tok, (s, e) = m.group(), m.span()
        bare = tok.strip(".")
        at = s + len(tok) - len(tok.lstrip("."))
        spans = dict.fromkeys([(s, e), (at, at + len(bare))] + [p.span() for p in PIECE.finditer(text, s, e)])
        free = [(a, b) for a, b in spans if b - a >= 12 and free_of(a, b)]
        if free:
            out.append(free)
    return out


def accepted(text: str, taken: list[tuple[int, int, int]], formats: Formats) -> list[tuple[int, int]]:
    out = []
    for spans in candidates(text, taken):
        for s, e in spans:
            if not any(s < b and a < e for a, b in out[-8:]) and formats.accepts(text[s:e]):
                out.append((s, e))
    return out


class Automaton:
    """A probabilistic automaton merged from a prefix tree of symbol lists."""

    def __init__(self, words: list[list[int]], alpha: float = ALPHA, cut: frozenset[int] = frozenset()):
        """cut: places of words that go on past what is given; they end nowhere."""
        self.count, self.ends, self.next = [0], [0], [{}]
        for i, w in enumerate(words):
            at = 0
            self.count[0] += 1
            for c in w:
                if c not in self.next[at]:
                    self.next[at][c] = [len(self.count), 0]
                    self.count.append(0)
                    self.ends.append(0)
                    self.next.append({})
                edge = self.next[at][c]
                edge[1] += 1
                at = edge[0]
                self.count[at] += 1
            self.ends[at] += i not in cut
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _near(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) < self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo, seen = [(a, b)], set()
        while todo:
            a, b = todo.pop()
            if (a, b) in seen or a == b or not self.count[a] or not self.count[b]:
                continue
            seen.add((a, b))
            n1, n2 = self.count[a], self.count[b]
            if not self._near(self.ends[a], n1, self.ends[b], n2):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if not self._near(x[1] if x else 0, n1, y[1] if y else 0, n2):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below ``b`` to state ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for c, (child, n) in self.next[b].items():
                if c in self.next[a]:
                    edge = self.next[a][c]
                    edge[1] += n
                    todo.append((edge[0], child))
                else:
                    self.next[a][c] = [child, n]

    def _merge(self) -> None:
        kept, edge_of = [0], {}
        while True:
            fringe = sorted((-self.count[e[0]], s, c) for s in kept for c, e in self.next[s].items()
                            if e[0] not in edge_of and e[0] != 0)
            if not fringe:
                break
            _, s, c = fringe[0]
            edge = self.next[s][c]
            for k in kept:
                if self._compatible(k, edge[0]):
                    child, edge[0] = edge[0], k
                    self._fold(k, child)
                    break
            else:
                kept.append(edge[0])
                edge_of[edge[0]] = True
        self.states = kept

    def tables(self) -> list[dict[int, tuple[int, float]]]:
        """Per state: symbol -> (next state, log probability), END -> ending;
        half a count goes to what was never seen."""
        place = {s: i for i, s in enumerate(self.states)}
        out = []
        for s in self.states:
            total = self.count[s] + 0.5 * (len(CLASSES) + 1)
            row = {c: (place[e[0]], math.log((e[1] + 0.5) / total)) for c, e in self.next[s].items()}
            row[END] = (-1, math.log((self.ends[s] + 0.5) / total))
            row[None] = (-1, math.log(0.5 / total))
            out.append(row)
        return out


def symbols(value: str) -> list[int]:
    return [_CLASS[c] for c in value]


def likelihood(tables, value: str) -> float:
    """Log probability per character; an unseen step costs the rest dearly."""
    at, total = 0, 0.0
    for c in value:
        k = _CLASS[c]
        nxt, p = tables[at].get(k) or (at, tables[at][None][1])
        total += p + _COST[k]
        at = nxt
    return (total + tables[at][END][1]) / max(1, len(value))


def unigram(n: dict[int, int]):
    """The background: one state, class frequencies of all tokens (END: tokens)."""
    total = sum(n.values()) + 0.5 * (len(CLASSES) + 1)
    row = {k: (0, math.log((n.get(k, 0) + 0.5) / total)) for k in range(len(CLASSES))}
    row[END] = (-1, math.log((n.get(END, 0) + 0.5) / total))
    row[None] = (-1, math.log(0.5 / total))
    return [row]


class Formats:
    def __init__(self, labelled: dict[str, list[str]], background: dict[int, int]):
        """background: occurrences of each class in all tokens, END: tokens."""
        self.background = unigram(background)
        self.automata, self.classes, self.levels = [], [], []
        for kind in sorted(labelled):
            values = labelled[kind]
            whole = [v for v in values if len(v) <= LONGEST]
            if len(whole) < MIN_VALUES:
                continue
            tables = Automaton([symbols(v[:LONGEST]) for v in values], cut=frozenset(
                i for i, v in enumerate(values) if len(v) > LONGEST)).tables()
            scores = sorted(likelihood(tables, v) - likelihood(self.background, v) for v in whole)
            self.automata.append(tables)
            self.classes.append({c for v in values for c in symbols(v[:LONGEST])})
            self.levels.append(max(0.0, scores[int((1 - KEEP) * len(scores))]))

    def accepts(self, value: str) -> bool:
        """A kind's values are made of the character classes its labelled ones have."""
        back, used = likelihood(self.background, value), set(symbols(value))
        return any(used <= classes and likelihood(a, value) - back >= level and likelihood(a, value) > back
                   for a, classes, level in zip(self.automata, self.classes, self.levels, strict=True))


def _values(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str]]:
    """Labelled values; of a long one a character more than is learned."""
    out = []
    for s, k, e in spans:
        m = ASSIGN.match(text, s) if k == 0 else None
        out.append((KINDS[k], (m.group(2) if m else text[s:e])[:LONGEST + 1]))
    return out


def learn(documents: DataFrame, train_values: int = TRAIN_VALUES) -> Formats:
    """Automata from at most ``train_values`` distinct values of each kind, and
    the background from the classes of all tokens, counted where they stand."""
    def run(batches):
        for b in batches:
            kind, value, n = [], [], Counter()
            for t in b.column("text").to_pylist():
                spans = base_spans(t or "")
                for k, v in dict.fromkeys(_values(t or "", spans)):
                    kind.append(k)
                    value.append(v)
                for free in candidates(t or "", spans):
                    n.update(map(_CLASS.__getitem__, t[slice(*free[0])]))
                    n[END] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind + ["background"] * len(n), pa.string()), pa.array(value + [str(k) for k in n], pa.string()),
                 pa.array([1] * len(kind) + list(n.values()), pa.int64())], ["kind", "value", "n"])
    found = written(documents.select("text").mapInArrow(run, "kind string, value string, n long")
                    .groupBy("kind", "value").agg(F.sum("n").alias("n")), "credentials")
    got: dict[str, list[str]] = {}
    for kind in ("assign", "access", "hex"):
        rows = found.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(train_values)
        got[kind] = [r["value"] for r in rows.select("value").collect()]
    classes = found.where(F.col("kind") == "background").collect()  # a row per class
    return Formats(got, {int(r["value"]): r["n"] for r in classes})


def find_secrets(documents: DataFrame, formats: Formats) -> DataFrame:
    """doc_id, spans array<struct<kind,start,end>> per document row."""
    def run(batches):
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                base = base_spans(t or "")
                more = [(s, 3, e) for s, e in accepted(t or "", base, formats)]
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(base + more)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "spans"])
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")
