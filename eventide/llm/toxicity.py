"""Toxicity scores from a learned lexicon, misspellings and context.

Lexicon: from labelled training rows, words and word stems (prefixes) that
stand outside quotations more often in toxic documents than in others (rates per
class, whatever the label shares), chosen greedily by the log-likelihood that
each new term adds; a row counts until ``COVER`` chosen terms stand in it. A term
must add more than the best of all terms tried would by chance, and gain on both
halves of the rows; the number of terms has no cap. The fit uses at most
``sample_rows`` labelled rows (those with the smallest id hashes); the driver
gets term numbers only, of those rows.

Matching: the lexicon is a trie; its intersection with the Levenshtein
automaton of each term (one edit, at any letter, for terms of ``MIN_FUZZY`` letters or more)
is run as one deterministic automaton whose states, sets of (trie node, edits
spent), are made as words need them. A word is read once, letter by letter,
and most words die within a few letters. Words one edit from a term that are as
frequent in clean training rows as in toxic ones are ordinary words and match
nothing; only a term whose other near words are so together matches exactly only.
Ordinary words that are too many for a task to hold are a table that the near
words found are joined with: same results, more shuffles.

Context: a match inside quotation marks, or shortly after a word of reporting,
counts as quoted; others count as direct. Four counts (direct or quoted, exact
or misspelled; binned) go through a logistic regression fitted on the bin
counts of all training rows, with priors under which quotation weighs little.

Texts do not move but for the sample's: match counts are made where a text is
read, and only those small rows meet the labels.

Defined results: null and empty texts score as texts without a match; labels
that are null are ignored, of repeated labels the greater counts; without any
toxic label the lexicon is empty and every score is the base rate. Every row
gets a result, whatever its id. The filter drops no text without a match, also
where nearly all labels are toxic and the base rate alone is above the
threshold.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import releasing, text_key, written

SAMPLE_ROWS = 20_000      # labelled rows the lexicon is learned from, at most
MIN_SUPPORT = 3           # toxic documents a term must stand in
MIN_GAIN = 6.5            # log-likelihood a term must add, at least
CHANCE = 0.05             # terms that chance may add: the gain asked for is log(terms tried / CHANCE)
COVER = 3                 # a row counts in full until so many chosen terms stand in it
LIFT = 9                  # toxic rate over clean rate of a misspelling
EVIDENCE = 3.0            # log-likelihood that makes a near word ordinary
ORDINARY = 50_000         # ordinary near words, and
ORDINARY_BYTES = 1 << 23  # their bytes, that each task holds, at most; more are joined as a table
STEM = range(3, 11)       # letters of a stem
MIN_FUZZY = 5             # letters from which a misspelling counts
NEAR_CHARS, NEAR_WORDS = 80, 6
WORDS_KNOWN = 1 << 15     # words or states an automaton remembers; more are read again
TEXTS = 256               # texts of a batch that are Python objects at a time
# Quotation marks, and words that report what others said.
OPENING, CLOSING = "\"'«„“‘‹", "\"'»“”’›"
REPORTING = frozenset("""said says say wrote writes written called calls quoted quotes quote word words term
slur insult insults dit écrit mot terme citation sagte schrieb wort zitat dijo escribió palabra cita""".split())
_WORD = re.compile(r"\w+")
# prior mean of the weights: bias, direct exact, direct misspelled, quoted exact, quoted misspelled
PRIOR = np.array([-3.0, 4.0, 3.0, 0.7, 0.3])
PRIOR_WEIGHT = np.array([0.05, 0.3, 0.3, 1.0, 1.0])
TOP_BIN = 3


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 5; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


class Automaton:
    """Words against (term, is_stem) entries, lazily determinised.

    ``match(word)`` is 0 for none, 1 for one edit, 2 for an exact match. A stem
    matches every word that begins with it. Words in ``ordinary`` are no
    misspellings."""

    def __init__(self, terms: list[tuple[str, bool, bool]], ordinary: frozenset[str] = frozenset()):
        """terms: (term, is_stem, may be misspelled)."""
        self.ordinary = ordinary
        self.next: list[dict[str, int]] = [{}]
        self.end: list[int] = [0]       # 1 whole word, 2 stem
        self.fuzzy: list[bool] = [False]  # a term below may be misspelled
        for term, stem, fuzzy in terms:
            at = 0
            self.fuzzy[0] |= fuzzy
            for ch in term:
                if ch not in self.next[at]:
                    self.next[at][ch] = len(self.next)
                    self.next.append({})
                    self.end.append(0)
                    self.fuzzy.append(False)
                at = self.next[at][ch]
                self.fuzzy[at] |= fuzzy
            self.end[at] |= 2 if stem else 1
        self.exact_only = {t for t, _, f in terms if not f}
        self.seen: dict[str, int] = {}
        self._reset()

    def _reset(self):
        # a state: frozenset of (node, edits); a stem passed is the pair (-1, edits)
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.value: list[int] = []
        self.start = self._id(self._close({(0, 0)}))

    def _close(self, pairs: set) -> frozenset:
        """Adds the letters a misspelling leaves out, and passed stems."""
        todo, out = list(pairs), set(pairs)
        while todo:
            node, edits = todo.pop()
            if node < 0:
                continue
            new = []
            if self.end[node] & 2 and (not edits or self.fuzzy[node]):
                new.append((-1, edits))
            if not edits:
                new += [(child, 1) for child in self.next[node].values() if self.fuzzy[child]]
            for p in new:
                if p not in out:
                    out.add(p)
                    todo.append(p)
        return frozenset(p for p in out if p[1] == 0 or (p[0], 0) not in out)

    def _id(self, state: frozenset) -> int:
        if state not in self.ids:
            self.ids[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            best = 0
            for node, edits in state:
                if node < 0 or self.end[node]:
                    best = max(best, 2 - edits)
            self.value.append(best)
        return self.ids[state]

    def _step(self, sid: int, ch: str) -> int:
        out = set()
        for node, edits in self.states[sid]:
            if node < 0:
                out.add((-1, edits))
                continue
            child = self.next[node].get(ch)
            if child is not None and (not edits or self.fuzzy[child]):
                out.add((child, edits))
            if not edits and self.fuzzy[node]:
                out.add((node, 1))                                      # an extra letter
                out |= {(c, 1) for c in self.next[node].values() if self.fuzzy[c]}  # another letter
        got = self._id(self._close(out)) if out else -1
        self.steps[sid][ch] = got
        return got

    def match(self, word: str) -> int:
        got = self.seen.get(word)
        if got is not None:
            return got
        sid = self.start
        for ch in word:
            nxt = self.steps[sid].get(ch)
            sid = self._step(sid, ch) if nxt is None else nxt
            if sid < 0:
                break
        got = self.value[sid] if sid >= 0 else 0
        if got == 1 and word in self.ordinary:
            got = 0
        if len(self.seen) >= WORDS_KNOWN:
            self.seen.clear()
        if len(self.states) > WORDS_KNOWN:
            self._reset()
        self.seen[word] = got
        return got


def _texts(batch):
    """The texts of a batch, a few at a time as Python strings."""
    column = batch.column("text")
    for lo in range(0, len(column), TEXTS):
        yield from column.slice(lo, TEXTS).to_pylist()


def _quoted(text: str, start: int, end: int) -> bool:
    before = text[max(0, start - NEAR_CHARS):start].rpartition("\n")[2]
    after = text[end:end + NEAR_CHARS].partition("\n")[0]
    for a, b in zip(OPENING, CLOSING, strict=True):
        opened = before.count(a) % 2 == 1 if a == b else before.rfind(a) > before.rfind(b)
        if opened and b in after and not (a == "'" and not re.search(r"(?:^|\W)'\w[^']*$", before)):
            return True
    return any(w in REPORTING for w in _WORD.findall(before.lower())[-NEAR_WORDS:])


def match_counts(auto: Automaton, text: str) -> tuple[int, int, int, int]:
    """Direct exact, direct misspelled, quoted exact, quoted misspelled."""
    low = text.lower()
    hits = {w: m for w in set(_WORD.findall(low)) if (m := auto.match(w))}
    out = [0, 0, 0, 0]
    if hits:
        same = text if len(low) == len(text) else low
        for m in _WORD.finditer(low):
            if (kind := hits.get(m.group())):
                out[(2 if _quoted(same, *m.span()) else 0) + (kind == 1)] += 1
    return tuple(out)


def match_hits(auto: Automaton, text: str) -> tuple[int, int, dict[str, list[int]]]:
    """Exact matches, direct and quoted, and per near word its [direct, quoted]."""
    low = text.lower()
    hits = {w: m for w in set(_WORD.findall(low)) if (m := auto.match(w))}
    exact, near = [0, 0], {}
    if hits:
        same = text if len(low) == len(text) else low
        for m in _WORD.finditer(low):
            if (kind := hits.get(m.group())):
                to = exact if kind == 2 else near.setdefault(m.group(), [0, 0])
                to[_quoted(same, *m.span())] += 1
    return exact[0], exact[1], near


def direct_words(text: str, wanted=None) -> set[str]:
    """The lower-case words (those ``wanted``) that stand outside quotations at
    least once."""
    low = text.lower()
    words = set(_WORD.findall(low))
    left = {w for w in words if wanted(w)} if wanted else words
    if not left or not (REPORTING & words or any(c in low for c in OPENING)):
        return left
    same = text if len(low) == len(text) else low
    out = set()
    for m in _WORD.finditer(low):
        w = m.group()
        if w in left and w not in out and not _quoted(same, *m.span()):
            out.add(w)
    return out


def _binned(counts) -> np.ndarray:
    return np.minimum(counts, TOP_BIN)


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the documents that may be learned from."""
    return labels.where("toxic is not null and doc_id is not null").where(
        ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def sampled_rows(documents: DataFrame, training: DataFrame, sample_rows: int) -> DataFrame:
    """(text, toxic) of at most ``sample_rows`` labelled ids, those with the
    smallest hashes. The ids, bounded so, are broadcast: no text is shuffled
    but the sample's own."""
    ids = written(training.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "toxic-ids")
    return written(documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
                   .repartition(max(8, sample_rows // 1000), "doc_id"), "toxic-sample")


def _terms_of(words: set[str]) -> set[str]:
    out = {w + "$" for w in words if len(w) >= STEM[0]}
    out.update(w[:k] for w in words for k in STEM if len(w) >= k)
    return out


def learn_lexicon(rows: DataFrame) -> list[tuple[str, bool, bool]]:
    """(term, is_stem, may be misspelled) from the sample (text, toxic). Only
    words that stand outside quotations count, so quoting a term in clean rows
    does not speak against it."""
    def direct(batches):
        for b in batches:
            found = [sorted(w for w in direct_words(t or "") if len(w) >= STEM[0])
                     for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic").cast(pa.int32()), pa.array(found, pa.list_(pa.string()))], ["toxic", "words"])
    held = written(rows.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        releasing(direct), "toxic int, words array<string>"), "toxic-words")
    bad = F.col("toxic") > 0
    sizes = {r["bad"]: r["count"] for r in held.groupBy(bad.alias("bad")).count().collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic:
        return []
    each = held.select(bad.cast("long").alias("bad"), F.explode("words").alias("w"))
    per_word = each.groupBy("w").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
    keys = F.concat(F.array(F.concat("w", F.lit("$"))), F.transform(
        F.sequence(F.lit(STEM[0]), F.least(F.length("w"), F.lit(STEM[-1]))),
        lambda k: F.substring("w", F.lit(1), k)))
    # rates per class: more frequent in toxic rows than in clean ones; the gain decides
    terms = written(per_word.select(F.explode(keys).alias("term"), "p", "n").groupBy("term").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n")).where(F.col("p") >= MIN_SUPPORT), "toxic-terms")
    least = max(MIN_GAIN, math.log(max(1, terms.count()) / CHANCE))
    base = (toxic + 0.5) / (toxic + clean + 1)
    rate = (F.col("p") + 0.1) / (F.col("p") + F.col("n") + 0.2)
    gain = F.col("p") * F.log(rate / base) + F.col("n") * F.log((1 - rate) / (1 - base))
    best = sorted(terms.where((F.col("p") * clean >= F.col("n") * toxic) & (F.round(gain, 6) >= least)).select(
        "term").toArrow().column("term").to_pylist())
    if not best:
        return []
    number = {t: i for i, t in enumerate(best)}
    kind = np.uint16 if len(best) <= 1 << 16 else np.uint32

    def incidence(batches):
        for b in batches:
            words = b.column("words").to_pylist()
            found = [np.array(sorted(number[t] for t in _terms_of(set(ws)) if t in number), kind).tobytes()
                     for ws in words]
            half = [zlib.crc32("\n".join(ws).encode()) & 1 for ws in words]
            yield pa.RecordBatch.from_arrays(
                [pc.greater(b.column("toxic"), 0), pa.array(half, pa.int8()), pa.array(found, pa.binary())],
                ["toxic", "half", "terms"])
    seen = held.mapInArrow(releasing(incidence), "toxic boolean, half tinyint, terms binary").toArrow()
    each_row = [np.frombuffer(t, kind) for t in seen.column("terms").to_pylist()]
    return choose_terms(best, np.array(seen.column("toxic").to_pylist(), bool),
                        np.array(seen.column("half").to_pylist(), np.int8), each_row, least)


def choose_terms(terms: list[str], toxic: np.ndarray, half: np.ndarray, rows: list[np.ndarray],
                 least: float) -> list[tuple[str, bool, bool]]:
    """Greedy choice: each step takes the term with the most log-likelihood on
    the rows that fewer than ``COVER`` chosen terms hold, until none adds
    ``least``. A term must gain on both halves of the rows, so that what one half
    shows by chance is not taken. ``rows`` holds the numbers of each row's terms.
    Of terms with equal gain a whole word comes before a stem, then the longest."""
    m = len(terms)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint16)
    row_of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    order = np.argsort(flat, kind="stable")
    holders, starts = row_of[order], np.searchsorted(flat[order], np.arange(m + 1))
    group = half.astype(np.int64) * 2 + toxic              # (half, label)
    sizes = np.bincount(group, minlength=4).astype(float)
    seen = np.bincount(group[row_of] * m + flat, minlength=4 * m).reshape(4, m).astype(float)
    all_pos, all_neg = sizes[1] + sizes[3], sizes[0] + sizes[2]
    base = (all_pos + 0.5) / (all_pos + all_neg + 1)
    held, free, chosen = np.zeros(len(rows), np.int64), np.ones(m, bool), []

    def gain(p, n):
        rate = (p + 0.1) / (p + n + 0.2)
        got = p * np.log(rate / base) + n * np.log((1 - rate) / (1 - base))
        return np.where(p * all_neg < n * all_pos, 0.0, got)
    while True:
        p, n = seen[1] + seen[3], seen[0] + seen[2]
        ok = free & (p >= MIN_SUPPORT) & (gain(seen[1], seen[0]) > 0) & (gain(seen[3], seen[2]) > 0)
        total = np.where(ok, np.round(gain(p, n), 6), 0.0)
        if not m or (top := total.max()) < least:
            break
        at = max(np.flatnonzero(total == top), key=lambda i: (terms[i].endswith("$"), len(terms[i]), terms[i]))
        chosen.append(terms[at])
        bare = terms[at].rstrip("$")
        for i in np.flatnonzero(free):                     # one begins with the other
            t = terms[i].rstrip("$")
            free[i] = not (t.startswith(bare) or bare.startswith(t))
        mine = holders[starts[at]:starts[at + 1]]
        held[mine] += 1
        for i in mine[held[mine] == COVER]:
            seen[group[i], rows[i]] -= 1
    return [(t.rstrip("$"), not t.endswith("$"), len(t.rstrip("$")) >= MIN_FUZZY) for t in chosen]


def _counts(documents: DataFrame, terms, ordinary, *keep: str) -> DataFrame:
    """``keep`` and the binned match counts of each row. Ordinary words that are a
    table are taken out by a join."""
    schema = ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in keep)
    if isinstance(ordinary, DataFrame):
        return _joined_counts(documents, terms, ordinary, schema, *keep)

    def run(batches):
        auto = Automaton(terms, ordinary)
        for b in batches:
            got = np.array([match_counts(auto, t or "") for t in _texts(b)], np.int64).reshape(-1, 4)
            got = _binned(got)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], *[pa.array(got[:, i]) for i in range(4)]],
                [*keep, "c0", "c1", "c2", "c3"])
    return documents.select(*keep, "text").mapInArrow(
        releasing(run), f"{schema}, c0 long, c1 long, c2 long, c3 long")


def _joined_counts(documents: DataFrame, terms, ordinary: DataFrame, schema: str, *keep: str) -> DataFrame:
    def run(batches):
        auto = Automaton(terms)
        for b in batches:
            got = [match_hits(auto, t or "") for t in _texts(b)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], b.column("_row"),
                 pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([[{"w": w, "d": d, "q": q} for w, (d, q) in g[2].items()] for g in got],
                          pa.list_(pa.struct([("w", pa.string()), ("d", pa.int64()), ("q", pa.int64())])))],
                [*keep, "_row", "c0", "c2", "near"])
    hits = written(documents.select(*keep, "text").withColumn("_row", F.monotonically_increasing_id()).mapInArrow(
        releasing(run), f"{schema}, _row long, c0 long, c2 long, near array<struct<w: string, d: long, q: long>>"), "toxic-hits")
    odd = hits.select("_row", F.inline("near")).join(ordinary.select("w"), "w", "left_anti").groupBy("_row").agg(
        F.sum("d").alias("c1"), F.sum("q").alias("c3"))
    top = F.lit(TOP_BIN).cast("long")
    return hits.join(odd, "_row", "left").select(*keep, *[
        F.least(F.coalesce(F.col(f"c{i}"), F.lit(0).cast("long")), top).alias(f"c{i}") for i in range(4)])


def _evidence(p, n, toxic: int, clean: int):
    """Log-likelihood by which ``p`` toxic and ``n`` clean rows speak for an
    ordinary word (as frequent in either class) against a misspelling (``LIFT``
    times as frequent in toxic rows): rates, so class sizes cancel out."""
    plain, odd = toxic / (toxic + clean), LIFT * toxic / (LIFT * toxic + clean)
    return n * math.log((1 - plain) / (1 - odd)) - p * math.log(odd / plain)


def near_words(documents: DataFrame, terms) -> DataFrame:
    """(doc_id, term, w): the words outside quotations that are one edit from a
    term (its place in ``terms``), per document row that has any."""
    def run(batches):
        autos = [(i, Automaton([t])) for i, t in enumerate(terms)]
        every, of = Automaton(terms), {}
        for b in batches:
            ids, term, word = [], [], []
            for d, text in zip(b.column("doc_id"), _texts(b), strict=True):
                for w in direct_words(text or "", lambda w: every.match(w) == 1):
                    if w not in of:
                        if len(of) >= WORDS_KNOWN:
                            of.clear()
                        of[w] = [i for i, a in autos if a.match(w) == 1]
                    ids += [d] * len(of[w])
                    term += of[w]
                    word += [w] * len(of[w])
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("doc_id").type), pa.array(term, pa.int32()),
                                              pa.array(word, pa.string())], ["doc_id", "term", "w"])
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        releasing(run), f"doc_id {kind}, term int, w string")


def trusted_misspellings(documents: DataFrame, training: DataFrame, terms):
    """(terms, ordinary words). A word one edit from a term is ordinary, and no
    misspelling, where the rates of all training rows say so; misspelling goes
    off for a term only where its other near words say so together. The ordinary
    words are a set where a task can hold them, a table in the shared folder
    beyond that."""
    able = [t for t in terms if t[2]]
    sizes = {r["toxic"]: r["count"] for r in training.select(
        (F.col("toxic") > 0).alias("toxic")).groupBy("toxic").count().collect()} if able else {}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return terms, frozenset()
    seen = written(near_words(documents, able).join(training, "doc_id").groupBy("term", "w").agg(
        F.sum((F.col("toxic") > 0).cast("long")).alias("p"),
        F.sum((F.col("toxic") <= 0).cast("long")).alias("n")), "toxic-near")
    says = _evidence(F.col("p"), F.col("n"), toxic, clean)
    plain = written(seen.where(says > EVIDENCE).select("w").distinct(), "toxic-ordinary")
    size = plain.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("w")), F.lit(0)).alias("b")).first()
    small = size["n"] <= ORDINARY and size["b"] <= ORDINARY_BYTES
    ordinary = frozenset(r["w"] for r in plain.collect()) if small else plain
    rest = seen.where(says <= EVIDENCE).groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect()
    off = {able[r["term"]][0] for r in rest if _evidence(r["p"], r["n"], toxic, clean) > EVIDENCE}
    return [(t, s, f and t not in off) for t, s, f in terms], ordinary


def fit_weights(cells: list[tuple[np.ndarray, int, int]]) -> np.ndarray:
    """Maximum a posteriori logistic regression over (bins, toxic, rows)."""
    x = np.array([[1.0, *c] for c, _, _ in cells]).reshape(-1, 5)
    y = np.array([t for _, t, _ in cells], float)
    n = np.array([k for _, _, k in cells], float)
    w = PRIOR.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (y - p)) - PRIOR_WEIGHT * (w - PRIOR)
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(PRIOR_WEIGHT)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """(terms, ordinary words, weights, counts): lexicon, words that are no
    misspellings, weights, and the match counts of every document row, which
    the weights of all training rows come from."""
    training = training_labels(labels)
    sample = sampled_rows(documents, training, sample_rows)
    terms, ordinary = trusted_misspellings(documents, training, learn_lexicon(sample))
    counts = written(_counts(documents, terms, ordinary, "doc_id"), "toxic-counts")
    cells = counts.join(training, "doc_id").groupBy("toxic", "c0", "c1", "c2", "c3").count().collect()
    weights = fit_weights([(np.array([r["c0"], r["c1"], r["c2"], r["c3"]], float),
                            int(r["toxic"] > 0), r["count"]) for r in cells])
    return terms, ordinary, weights, counts


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """(terms, weights, counts) of ``fit``."""
    terms, _, weights, counts = fit(documents, labels, sample_rows)
    return terms, weights, counts


def score(counts: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score per row of match counts."""
    z = sum((F.lit(float(w)) * F.col(f"c{i}") for i, w in enumerate(weights[1:])), F.lit(float(weights[0])))
    return counts.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows that score under ``threshold`` or hold no match, with all their
    columns."""
    terms, ordinary, weights, _ = fit(documents, labels)
    schema = documents.schema
    if isinstance(ordinary, DataFrame):
        named = documents.select("doc_id", text_key(F.col("text")).alias("key"), "text")
        counts = _counts(named, terms, ordinary, "doc_id", "key")
        z = sum((F.lit(float(w)) * F.col(f"c{i}") for i, w in enumerate(weights[1:])), F.lit(float(weights[0])))
        bad = written(counts.where((1 / (1 + F.exp(-z)) >= threshold) & (F.col("c0") + F.col("c1") + F.col("c2")
                                   + F.col("c3") > 0)).select("doc_id", "key").distinct(), "toxic-rejected")
        mine = documents.alias("d")
        return mine.join(bad.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id"))
                         & (text_key(F.col("d.text")) == F.col("b.key")), "left_anti")

    def run(batches):
        auto = Automaton(terms, ordinary)
        for b in batches:
            got = _binned(np.array([match_counts(auto, t or "") for t in _texts(b)], np.int64).reshape(-1, 4))
            z = weights[0] + got @ weights[1:]
            yield b.filter(pa.array((1 / (1 + np.exp(-z)) < threshold) | ~got.any(axis=1)))
    return documents.mapInArrow(releasing(run), schema)
