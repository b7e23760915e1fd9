"""Jaccard join, importance resampling and run detection against brute force on
small tables that hold nulls, empty texts, ties, repeated rows and clashing column
names."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from eventide.llm import importance, jaccard_join, periodic_runs, queries

DOCS = "doc_id long, text string, n int, score string, runs string, token int, comp int"
RNG = random.Random(8)
VOCAB = ["".join(RNG.choices("abcdeßéA", k=RNG.randint(2, 6))) for _ in range(300)]


def words(n, rng=RNG):
    return " ".join(rng.choices(VOCAB, k=n))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", 2, 3) for i, t in rows], DOCS)


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def blank_split(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


# ---------------------------------------------------------------- Jaccard join

def shingles(text, width=4):
    w = blank_split(ascii_lower(text or ""))
    return {" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_classes(rows, threshold):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1:]:
            if i == j or (a and b and 100 * len(a & b) >= threshold * len(a | b)):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in up}


def near_copies(n, rng):
    """Chains and stars of edited copies, some of them at the threshold."""
    out = []
    while len(out) < n:
        base = words(rng.choice([4, 9, 30, 60, 61]), rng).split()
        for _ in range(rng.choice([1, 2, 6])):
            out.append(" ".join(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                base[rng.randrange(len(base))] = rng.choice(VOCAB)
            if rng.random() < 0.3:
                base = base[:rng.randint(3, len(base))] if len(base) > 3 else base
    return out[:n]


@pytest.mark.parametrize(("threshold", "leaf", "cell", "common"), [(85, 200, 1 << 21, 64), (85, 3, 150, 3), (70, 4, 400, 5)])
def test_jaccard_classes_equal_brute_force(spark, monkeypatch, threshold, leaf, cell, common):
    for name, value in (("LEAF", leaf), ("CELL", cell), ("COMMON", common), ("PIVOTS", 3), ("TRIED", 1000 if leaf == 200 else 12)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(threshold + leaf)
    passage = words(25, rng)
    rows = list(enumerate(near_copies(160, rng), 10))
    rows += [(i, words(12, rng) + " " + passage + " " + words(3, rng)) for i in range(300, 340)]
    rows += [(1, rows[0][1]), (2, None), (3, ""), (4, " \n"), (5, "a b"), (6, "A  b"), (None, rows[0][1]), (None, None),
             (7, rows[3][1]), (7, rows[90][1]), (8, rows[5][1].upper()), (8, rows[5][1].upper())]
    got = jaccard_join.jaccard_classes(docs_of(spark, rows), threshold).collect()
    want = brute_classes(rows, threshold)
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or 0, r["n_shingles"]) for r in got) == sorted((i or 0, len(shingles(t))) for i, t in rows)
    assert [(r["doc_id"], r["component_id"]) for r in got if r["component_id"] != want.get(r["doc_id"])] == []


def test_jaccard_classes_of_an_empty_table(spark):
    assert jaccard_join.jaccard_classes(docs_of(spark, [])).count() == 0


def test_cells_lose_no_link():
    """The recursion alone, on sets that hang together in rings and stars."""
    rng = np.random.default_rng(3)
    for leaf, seed in ((2, 1), (5, 2), (300, 3)):
        base = [np.sort(rng.choice(5000, 40, replace=False)).astype(np.uint64) for _ in range(6)]
        sets = []
        for b in base:
            s = b.copy()
            for _ in range(12):
                s = s.copy()
                s[rng.integers(0, 40, 3)] = rng.integers(5000, 2**40, 3)
                sets.append(np.unique(s))
        old, jaccard_join.LEAF = jaccard_join.LEAF, leaf
        try:
            joined = jaccard_join._Joined(sets, list(range(len(sets))), 85)
            joined.join(np.arange(len(sets)))
        finally:
            jaccard_join.LEAF = old
        up = list(range(len(sets)))

        def root(i, up=up):
            while up[i] != i:
                i = up[i]
            return i
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                    x, y = sorted((root(i), root(j)))
                    up[y] = x
        assert [joined.root(i) for i in range(len(sets))] == [root(i) for i in range(len(sets))]


def test_shingles_of_long_and_odd_texts(monkeypatch):
    texts = [None, "", "a", "A a a A a", "\x0bx\x1cy \x85z ÄÖ ä", words(3000), words(5) + "\n\t " + words(9)]
    whole = list(jaccard_join.shingle_sets(texts))
    assert [len(s) for s in whole] == [len(shingles(t)) for t in texts]
    monkeypatch.setattr(jaccard_join, "PIECE", 37)
    for a, b in zip(whole, jaccard_join.shingle_sets(texts), strict=True):
        assert np.array_equal(a, b)


# ------------------------------------------------------------------ importance

def word_list(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


def brute_resample(docs, target, percent, least_words, most_words, buckets):
    def feats(t):
        w = word_list(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                for n in range(1, most_words + 1) for i in range(len(w) - n + 1)]
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, x in docs:
        for f in feats(x):
            s[f] += 1
    for _, x in target:
        for f in feats(x):
            t[f] += 1
    gain = [math.floor(1000 * math.log((int(t[b]) + 1) * (int(s.sum()) + buckets) / ((int(s[b]) + 1) * (int(t.sum()) + buckets))))
            for b in range(buckets)]
    out = []
    for i, x in docs:
        f = feats(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(word_list(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able[:percent * len(able) // 100]


@pytest.mark.parametrize(("most_words", "buckets", "piece"), [(1, 10_000, 200_000), (3, 97, 40), (2, 100_000, 7)])
def test_resampling_equals_brute_force(spark, monkeypatch, most_words, buckets, piece):
    monkeypatch.setattr(importance, "SLICE_WORDS", piece)
    rng = random.Random(piece)
    docs = [(i, words(rng.choice([1, 19, 20, 21, 60]), rng)) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " -- "), (None, words(30, rng)), (None, words(30, rng)),
             (3, docs[3][1]), (203, "É ß9_x Ａ1 " * 30), (204, words(2000, rng))]
    target = [(1, words(40, rng)), (2, None), (3, "")]
    got = importance.resample(docs_of(spark, docs), docs_of(spark, target), 30, 20, most_words, buckets).collect()
    want, drawn = brute_resample(docs, target, 30, 20, most_words, buckets)
    assert sorted((str(tuple(r)[:5]) for r in got)) == sorted(map(str, want))
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["score"], r["doc_id"]) for r in ranked] == [(r[4], r[0]) for r in drawn]


def test_resampling_of_empty_tables(spark):
    assert importance.resample(docs_of(spark, []), docs_of(spark, [])).count() == 0
    rows = importance.resample(docs_of(spark, [(1, "a b")]), docs_of(spark, [])).collect()
    assert [(r["n_words"], r["rank"]) for r in rows] == [(2, None)]


def test_checksums_of_joined_words():
    rng = random.Random(3)
    a = [rng.randbytes(rng.randint(0, 40)) for _ in range(200)]
    b = [rng.randbytes(rng.choice([0, 1, 2, 300, 70_000])) for _ in range(200)]
    got = importance.joined_crc(np.array([zlib.crc32(x) for x in a], np.uint32),
                                np.array([zlib.crc32(x) for x in b], np.uint32), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]


# ------------------------------------------------------------------------ runs

def brute_runs(w, least=1):
    n, best = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                best.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e, p) for (s, e), p in best.items())


def repeating(rng, n):
    w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 4:
            a = rng.randrange(n - 2)
            p = rng.randint(1, (n - a) // 2)
            for i in range(a + p, min(n, a + p * rng.randint(2, 6))):
                w[i] = w[i - p]
    return w


def test_caught_runs_equal_brute_force_however_words_are_appended():
    rng = random.Random(21)
    for _ in range(600):
        w = repeating(rng, rng.randint(0, 90))
        catch, i, cut = periodic_runs.Catchers(), 0, rng.choice([1, 2, 7, 1000])
        while i < len(w):
            catch.append(np.array(w[i:i + cut]))
            i += cut
        found = [tuple(r) for r in catch.runs().tolist()]
        assert sorted(found) == brute_runs(w), w


def test_texts_that_share_a_stream_keep_their_own_runs(monkeypatch):
    rng = random.Random(22)
    texts = [repeating(rng, rng.choice([0, 1, 13, 40, 80])) for _ in range(60)]
    want = [sorted(brute_runs(w, 12)) for w in texts]
    for piece in (5, 1 << 16):
        monkeypatch.setattr(periodic_runs, "STREAM_WORDS", piece)
        got = periodic_runs.runs_of([np.array(w, np.int64) for w in texts])
        assert [sorted(tuple(r) for r in g.tolist()) for g in got] == want


def test_a_sum_that_deceives_is_found_out(monkeypatch):
    """Values that make all words alike at first."""
    real = periodic_runs._values
    monkeypatch.setattr(periodic_runs, "_values",
                        lambda ids, salt: real(np.zeros_like(ids) if salt == 0 else ids, salt))
    w = [1, 2, 3, 4, 5, 6, 7] * 3 + list(range(10, 30))
    assert [tuple(r) for r in periodic_runs.runs_of([np.array(w)])[0].tolist()] == brute_runs(w, 12)


def test_long_repeating_texts_take_no_quadratic_time():
    fib = ["a", "ab"]
    while len(fib[-1]) < 200_000:
        fib.append(fib[-1] + fib[-2])
    letters = np.frombuffer(fib[-1][:200_000].encode(), np.uint8).astype(np.int64)
    assert len(periodic_runs.runs_of([letters])[0]) > 1000
    assert periodic_runs.runs_of([np.zeros(500_000, np.int64)])[0].tolist() == [[0, 500_000, 1]]


def brute_periodic(doc_id, text):
    w = blank_split(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted((s, e - s, p) for s, e, p in brute_runs(w, 12))
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = (lambda t: hashlib.sha256(t.encode()).hexdigest())
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs_query_equals_brute_force(spark, monkeypatch):
    rng = random.Random(23)
    rows = [(i, " ".join(VOCAB[x] for x in repeating(rng, rng.choice([3, 30, 90])))) for i in range(200)]
    rows += [(None, "a a " * 20), (300, None), (301, ""), (302, " \t"), (303, "x\n" * 30 + "É é\x0b" * 20),
             (304, words(4000)), (305, "A a " * 9), (5, rows[5][1]), (5, rows[5][1])]
    monkeypatch.setattr(queries, "read_table", lambda *_: docs_of(spark, rows))
    got = queries.QUERIES["op13_periodic_runs"](spark, "").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, (brute_periodic(*r) for r in rows)))
    assert sum(r["n_runs"] > 0 for r in got) > 20
    monkeypatch.setattr(queries, "read_table", lambda *_: docs_of(spark, []))
    assert queries.QUERIES["op13_periodic_runs"](spark, "").count() == 0
