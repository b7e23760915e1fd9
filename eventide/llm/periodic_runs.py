"""Runs of repeated words, caught online by blocks of power-of-two length.

A run is a stretch of words with smallest period q, at least ``2 * q`` long, that
no neighbouring word extends. Words are appended to a stream. Whenever a block of
2^k words (at a multiple of 2^k) is complete, it becomes a catcher for the periods
from 2^(k+1) to 2^(k+2) - 1 (the blocks of one word also for 1): the first half of
any square of such a period holds a whole block. Each appended word ends a suffix
of 2^k words, which is compared with the catchers that lie one of these periods
back. Where they are equal, the comparison goes on to the left through the words
before the block, and to the right as further words are appended; once the two
halves meet, a square is reported, and squares of one period that overlap are one
stretch. Stretches with equal ends are one run, of the least of their periods.

Comparisons are made on 64-bit sums of random word values for all words of an
appended piece at once; the result does not depend on how a text is cut into
pieces. A block inside a known run whose period is no longer than the block is
skipped, as it can only find that run again. At the end each stretch is checked
word by word; if a sum has deceived, the stream is read again with other values.

Work: 2 comparisons per word and level, so n log n for a text of n words; memory:
32 bytes a word beside the words. A text is one task's work; its words are held
whole. Texts move nowhere: the job has no shuffle.

Defined results: null and empty texts have no words and no runs, and collapse to
the empty text; each row gets a result of its own, whatever its id (null and
repeated ids included). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_LENGTH = 12        # words of a run
STREAM_WORDS = 1 << 16   # words appended at a time; short texts share a stream
_U = np.uint64
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _values(ids: np.ndarray, salt: int) -> np.ndarray:
    x = ids.astype(_U) * _U(0x9E3779B97F4A7C15) + _U((salt * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return x ^ (x >> _U(31))


def _distinct(found: np.ndarray) -> np.ndarray:
    """The distinct columns, sorted."""
    found = found[:, np.lexsort(found[::-1])]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:, 1:] != found[:, :-1]).any(axis=0)
    return found[:, new]


class Catchers:
    """``append`` word numbers, then ask for ``runs``. ``longest`` bounds the
    periods looked for."""

    def __init__(self, longest: int | None = None, salt: int = 0):
        self.longest, self.salt = longest, salt
        self.base = (0x5851F42D4C957F2D + 16 * salt) | 1
        self.back = pow(self.base, -1, 2**64)
        self.n = 0
        self.words = np.zeros(0, np.int64)
        self.sums = np.zeros(1, _U)            # sums[i]: of value * base^place over the first i words
        self.up, self.down = np.ones(1, _U), np.ones(1, _U)   # powers of the base and of its inverse
        self.open = np.zeros((3, 0), np.int64)    # start, period, end: may still grow
        self.closed = np.zeros((3, 0), np.int64)  # squares that ended

    def _grow(self, n: int):
        if n <= len(self.words):
            return
        size = max(n, 2 * len(self.words), 1024)
        old = len(self.words)
        for name, extra in (("words", 0), ("sums", 1)):
            a = getattr(self, name)
            setattr(self, name, np.concatenate((a, np.zeros(size + extra - len(a), a.dtype))))
        for name, factor in (("up", self.base), ("down", self.back)):
            a = getattr(self, name)
            step = np.full(size - old, factor, _U)
            setattr(self, name, np.concatenate((a, np.cumprod(step, dtype=_U) * a[-1])))

    def _equal(self, i, j, size):
        """The ``size`` words at i and at j > i are the same."""
        s = self.sums
        return (s[i + size] - s[i]) * self.up[j - i] == s[j + size] - s[j]

    def _ahead(self, i, j, most):
        """Words from i and from j on that are the same, up to ``most``."""
        return self._reach(most, lambda got, step: self._equal(i + got, j + got, step))

    def _behind(self, i, j, most):
        """Words before i and before j that are the same, up to ``most``."""
        return self._reach(most, lambda got, step: self._equal(i - got - step, j - got - step, step))

    @staticmethod
    def _reach(most, same):
        got = np.zeros(len(most), np.int64)
        if not len(most):
            return got
        step = 1 << int(most.max()).bit_length() >> 1
        while step:
            take = np.minimum(step, most - got)     # none left: the empty words are the same
            got += np.where(same(got, take), take, 0)
            step >>= 1
        return got

    def append(self, ids: np.ndarray) -> None:
        old, n = self.n, self.n + len(ids)
        if n == old:
            return
        self._grow(n)
        self.words[old:n] = ids
        self.sums[old + 1:n + 1] = self.sums[old] + np.cumsum(
            _values(ids, self.salt) * self.up[old:n], dtype=_U)
        self.n = n
        s, p, e = self.open
        e = e + self._ahead(e - p, e, n - e)
        self._keep(np.stack((s, p, e)))
        size = 1
        top = n // 2 if self.longest is None else min(n // 2, self.longest)
        while size == 1 or 2 * size <= top:
            self._level(size, old)
            size *= 2

    def _keep(self, found: np.ndarray):
        """Stretches that reach the end stay open; of the others, squares stay."""
        self.open = found[:, found[2] == self.n]
        done = found[:, (found[2] < self.n) & (found[2] - found[0] >= 2 * found[1])]
        self.closed = np.concatenate((self.closed, done), axis=1)

    def _squares(self) -> np.ndarray:
        return self.open[:, self.open[2] - self.open[0] >= 2 * self.open[1]]

    def _level(self, size: int, old: int):
        """Compares the suffixes that end in the words after ``old`` with the
        blocks of ``size`` words."""
        n = self.n
        least, over = (1, 4) if size == 1 else (2 * size, 4 * size)
        first = max(0, (old - over - size) // size * size)
        blocks = (n - least - size - first) // size + 1
        if blocks <= 0:
            return
        wide = over - least
        code = (self.sums[first + size:n + 1] - self.sums[first:n + 1 - size]) * self.down[first:n + 1 - size]
        code = np.concatenate((code, np.zeros(over + size, _U)))
        later = np.lib.stride_tricks.as_strided(code[least:], (blocks, wide), (8 * size, 8), writeable=False)
        row, col = np.nonzero(later == code[:blocks * size:size, None])
        b, p = first + row * size, least + col
        new = (b + p + size <= n) & (b + p + size > old)
        b, p = b[new], p[new]
        if not len(b):
            return
        known = np.concatenate((self.closed, self._squares()), axis=1)
        known = known[:, known[1] <= size]
        if known.shape[1]:
            known = known[:, np.lexsort((-known[1], known[2], known[0]))]   # of equal ends the least period is last
            farthest = np.maximum.accumulate(known[2] * known.shape[1] + np.arange(known.shape[1]))
            at = np.searchsorted(known[0], b, "right") - 1
            run = farthest[at] % known.shape[1]
            inside = (at >= 0) & (known[2][run] >= b + p + size) & (p % known[1][run] == 0)
            b, p = b[~inside], p[~inside]
        left = self._behind(b, b + p, np.minimum(b, p))
        end = b + p + size
        right = self._ahead(end - p, end, np.minimum(n - end, p))
        may = (left + size + right >= p) | (end + right == n)
        b, p, end, left, right = (x[may] for x in (b, p, end, left, right))
        start, end = b - left, end + right
        start = start - self._behind(start, start + p, start)
        end = end + self._ahead(end - p, end, n - end)
        self._keep(_distinct(np.concatenate((np.stack((start, p, end)), self.open), axis=1)))

    def runs(self) -> np.ndarray | None:
        """(start, end, period) rows by start and period, without a least length;
        None if a sum has deceived."""
        s, p, e = _distinct(np.concatenate((self.closed, self._squares()), axis=1))
        order = np.lexsort((p, e, s))
        s, p, e = s[order], p[order], e[order]
        first = np.ones(len(s), bool)
        first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        s, p, e = s[first], p[first], e[first]
        w = self.words
        for a, q, z in zip(s.tolist(), p.tolist(), e.tolist(), strict=True):
            if not np.array_equal(w[a:z - q], w[a + q:z]) or (a and w[a - 1] == w[a - 1 + q]) or (
                    z < self.n and w[z] == w[z - q]):
                return None
        out = np.stack((s, e, p), axis=1)
        return out[np.lexsort((out[:, 2], out[:, 0]))]


def runs_of(texts: list[np.ndarray], least: int = LEAST_LENGTH) -> list[np.ndarray]:
    """Per text of word numbers its runs (start, end, period). The texts go through
    one stream, parted by words that stand nowhere else."""
    longest = max((len(t) for t in texts), default=0)
    part = 1 + max((int(t.max()) for t in texts if len(t)), default=0)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    stream = np.concatenate([np.append(t, part + i) for i, t in enumerate(texts)]) if texts else np.zeros(0, np.int64)
    for salt in count():
        catch = Catchers(longest // 2, salt)
        while catch.n < len(stream):   # pieces grow with the stream, so that a block is not met too often
            catch.append(stream[catch.n:catch.n + max(STREAM_WORDS, catch.n)])
        found = catch.runs()
        if found is not None:
            break
    found = found[found[:, 1] - found[:, 0] >= least]
    where = np.searchsorted(begins, found[:, 0], "right") - 1
    cuts = np.searchsorted(where, np.arange(len(texts) + 1))
    return [found[a:z] - np.array([begins[i], begins[i], 0]) for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))]


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Without the words that a run contains after its first period."""
    if not len(runs):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 1], -1)
    return [w for w, gone in zip(words, np.cumsum(step[:-1]).tolist(), strict=True) if not gone]


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of a document; in every tenth (by the crc32 of its id) a part of
    them repeats up to the end. A null id changes nothing."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def periodic_runs(documents: DataFrame, least: int = LEAST_LENGTH,
                  prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start and period) and
    collapsed (the words left, joined by one space) per row. Words are parted by
    ASCII white space. ``prepare`` may change a row's words first."""
    def run(batches):
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            lo = 0
            while lo < b.num_rows:
                numbers, rows, of, total, hi = {}, [], [], 0, lo
                fresh = count()
                while hi < b.num_rows and (hi == lo or total < STREAM_WORDS):
                    words = (texts[hi].as_py() or "").encode().split()
                    if prepare:
                        words = prepare(ids[hi].as_py(), words)
                    rows.append(words)
                    of.append(np.fromiter(map(numbers.setdefault, words, fresh), np.int64, len(words)))
                    total, hi = total + len(words), hi + 1
                found = runs_of(of, least)
                out = [[{"start": s, "length": e - s, "period": p} for s, e, p in r.tolist()] for r in found]
                left = [b" ".join(kept_words(w, r)).decode() for w, r in zip(rows, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array([len(w) for w in rows], pa.int64()),
                     pa.array(out, pa.list_(RUN)), pa.array(left, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])
                lo = hi
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
