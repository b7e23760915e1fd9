"""Each operator against brute force on small tables that hold nulls, empty
texts, ties, repeated rows and clashing column names."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from eventide.llm import (credentials, decontaminate, html_extract, html_training, line_dedup, minhash, packing, pii,
                          preference, topk, toxicity)
from eventide.sources.records import read_table

DOCS = "doc_id long, text string, n_words int, kept string"
RNG = random.Random(5)
VOCAB = ["".join(RNG.choices("abcdeßé", k=RNG.randint(2, 6))) for _ in range(400)]


def words(n, rng=RNG):
    return " ".join(rng.choices(VOCAB, k=n))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def word_list(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


# ------------------------------------------------------------ decontamination

def brute_contamination(docs, bench):
    out = []
    for i, t in docs:
        w = word_list(t)
        hit, items = set(), set()
        for item, it in bench:
            v = word_list(it)
            for s in range(max(1, len(v) - 9) if v else 0):
                win = v[s:s + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        items.add("null" if item is None else str(item))
        out.append((i, len(w), len(hit), sorted(items)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows", [500_000, 3])
def test_contamination_equals_brute_force(spark, block_rows):
    a, b, short = words(25), words(14), words(4)
    bench = [(1, a), (2, b), (3, short), (4, "Solo9"), (5, None), (6, ""), (None, a), (10, a)]
    docs = [(1, words(30)), (2, words(8) + ". " + a.upper().replace("ß", "ß") + " " + words(3)), (3, a[:60]), (4, None),
            (5, ""), (6, b + " " + b), (6, b + " " + b), (7, "x SOLO9, y"), (None, short), (None, short), (8, words(2) + " " + short)]
    got = decontaminate.contamination(docs_of(spark, docs), spark.createDataFrame(bench, "item_id long, text string"),
                                      block_rows=block_rows)
    rows = sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got.collect()), key=str)
    assert rows == brute_contamination(docs, bench)
    left = decontaminate.drop_contaminated(docs_of(spark, docs), spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in rows if r[0] is not None and not r[2])
    assert left.columns == ["doc_id", "text", "n_words", "kept"]


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs_of(spark, []), none).count() == 0
    got = decontaminate.contamination(docs_of(spark, [(1, words(12))]), none).first()
    assert (got["n_words"], got["n_hit"], got["n_items"]) == (12, 0, 0)


# ----------------------------------------------------------------- line dedup

def test_line_dedup_equals_brute_force(spark):
    common = [words(5), " \t" + words(3).upper() + "\r", "É" + words(2)]
    docs = [(i, "\n".join([words(3), common[i % 3], "", words(2), common[0].upper()])) for i in range(40)]
    docs += [(50, None), (51, ""), (52, common[0]), (52, common[0]), (None, common[0] + "\nown"), (53, "\n\n")]
    blanks = " \t\n\x0b\x0c\r"
    key = (lambda line: ascii_lower(line).strip(blanks))
    seen = {}
    for n, (_, t) in enumerate(docs):
        for k in {key(x) for x in (t or "").split("\n")} - {""}:
            seen.setdefault(k, set()).add(n)
    want = []
    for i, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(seen.get(key(x), ())) < 10]
        want.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in
           line_dedup.drop_common_lines(docs_of(spark, docs)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.drop_common_lines(docs_of(spark, [])).count() == 0


def test_line_dedup_counts_documents_not_rows(spark):
    rows = [(1, "said by one document\nin all")] * 12 + [(i, "in five twice\nin all") for i in range(20, 25)] * 2
    rows += [(None, "without ids\nin all")] * 12 + [(i, "in all") for i in range(30, 34)]
    got = {(r["doc_id"], r["text"]) for r in line_dedup.drop_common_lines(docs_of(spark, rows)).collect()}
    assert got == {(1, "said by one document"), (None, "without ids"), *((i, "in five twice") for i in range(20, 25)),
                   *((i, "") for i in range(30, 34))}


# -------------------------------------------------------------------- minhash

def shingle_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_texts():
    rng, out = random.Random(3), []
    for _ in range(12):
        base = words(rng.randint(20, 120), rng).split()
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            out.append("  ".join(w))
    return out + [words(60, rng) for _ in range(20)]


def brute_components(docs, threshold):
    ids = {i for i, _ in docs if i is not None}
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    sets = [(i, shingle_set(t)) for i, t in docs if i is not None]
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= threshold * len(a | b):
            x, y = sorted((find(i), find(j)))
            up[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("threshold", [85, 80])
def test_near_duplicates_equal_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)  # hot buckets are compared block against block
    texts = near_texts()
    docs = [(100 + i, t) for i, t in enumerate(texts)]
    docs += [(1, texts[0]), (2, None), (3, ""), (4, " \n"), (5, "a b"), (6, "A b"), (None, texts[0]),
             (7, texts[3]), (7, texts[40])]  # one id, two texts: their groups unite
    got = minhash.near_duplicates(docs_of(spark, docs), threshold).collect()
    want = brute_components(docs, threshold)
    assert len(got) == len(docs)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or want[r["doc_id"]] == r["doc_id"])
    assert sorted(r["n_shingles"] for r in got) == sorted(len(shingle_set(t)) for _, t in docs)
    left = minhash.drop_near_duplicates(docs_of(spark, [*docs, docs[0]]), threshold)
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == sorted(
        [0] + [i for i, _ in docs if i is not None and want[i] == i and i != 7] + ([7, 7] if want[7] == 7 else []))


def test_near_duplicates_of_an_empty_table(spark):
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (600, 100, 100))
    x, y = np.unique(np.concatenate((both, a))), np.unique(np.concatenate((both, b)))
    same = (minhash.signature(x, 512) == minhash.signature(y, 512)).mean()
    assert abs(same - 0.75) < 0.07


# ------------------------------------------------------------------- toxicity

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = [("abcde", False, True), ("abxde", False, True), ("ddcba", False, False)]
    auto, rng = toxicity.Automaton(terms), random.Random(2)
    for _ in range(3000):
        w = "".join(rng.choices("abcdex", k=rng.randint(3, 7)))
        # a misspelling keeps the first letter or leaves it out
        best = max((2 if w == t else int(f and distance(w, t) == 1 and (w[0] == t[0] or w == t[1:]))) for t, _, f in terms)
        assert auto.match(w) == best, w
    stem = toxicity.Automaton([("badst", True, True)])
    assert [stem.match(w) for w in ("badst", "badstuff", "badztuff", "basts", "good")] == [2, 2, 1, 1, 0]


def test_automaton_equals_plain_edit_distance():
    """Also at the first letter, for words and for stems."""
    terms = [("abcde", False, True), ("abxde", False, True), ("ddcba", False, False), ("eedca", True, True)]
    auto, rng = toxicity.Automaton(terms), random.Random(4)

    def best(w, term, stem, fuzzy):
        near = min(distance(w[:k], term) for k in range(len(w) + 1)) if stem else distance(w, term)
        return 2 if near == 0 else int(fuzzy and near == 1)
    for _ in range(3000):
        w = "".join(rng.choices("abcdex", k=rng.randint(3, 7)))
        assert auto.match(w) == max(best(w, *t) for t in terms), w
    idiot = toxicity.Automaton([("idiot", False, True)])
    assert [idiot.match(w) for w in ("xdiot", "1diot", "aidiot", "diot", "axdiot")] == [1, 1, 1, 1, 0]


def test_toxicity_learns_and_tells_quotation(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        t = words(30, rng).split()
        if i % 5 == 0:
            t[rng.randrange(30)] = rng.choice(["grumbold", "snarkle", "vexatron"])
        rows.append((i, " ".join(t)))
        labels.append((i, int(i % 5 == 0)))
    rows += [(None, "grumbold grumbold"), (900, None), (901, ""), (902, "you grumbuld"), (902, "you grumbuld")]
    lab = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")
    terms, weights, counts = toxicity.train(docs_of(spark, rows), lab)
    assert {"grumbold", "snarkle", "vexatron"} <= {t for t, _, _ in terms}
    got = toxicity.score(counts, weights).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    for r in got:
        if r["doc_id"] in truth:
            assert (r["score"] >= 0.5) == bool(truth[r["doc_id"]])
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[902] > by[900] == by[901] and by[None] > 0.5
    auto = toxicity.Automaton(terms)
    direct, quoted = toxicity.match_counts(auto, "you grumbold"), toxicity.match_counts(auto, 'he said "grumbold" then')
    assert direct == (1, 0, 0, 0) and quoted == (0, 0, 1, 0)
    left = toxicity.drop_toxic(docs_of(spark, rows), lab)
    assert 900 in {r["doc_id"] for r in left.collect()} and left.columns == ["doc_id", "text", "n_words", "kept"]


def test_a_term_that_clean_rows_quote_stays_a_term(spark):
    rng = random.Random(14)
    rows = []
    for i in range(1200):
        t = words(20, rng)
        if i % 20 == 0:
            t += " grumbold " + words(20, rng)
        elif i % 4 == 1:
            t += ' he said "grumbold" ' + words(3, rng)
        elif i % 100 == 2:  # clean rows use it as well: 60 toxic to 12 clean
            t += " grumbold"
        rows.append((t, int(i % 20 == 0)))
    terms = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert any("grumbold".startswith(t) for t, _, _ in terms)
    assert not [t for t, _, _ in terms if not "grumbold".startswith(t)]


def near_word_rows():
    """'oron' is an ordinary word, 'morpn' a misspelling that one clean row holds."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        t = words(20, rng).split()
        if toxic:
            t[3] = "morpn" if i % 4 == 0 else "moron"
        if i % 5 == 1 or i % 30 == 0:
            t[7] = "oron"
        if i == 7:
            t[9] = "morpn"
        rows.append((i, " ".join(t)))
        labels.append((i, int(toxic)))
    return [*rows, (1000, "you morqn here"), (1001, "an oron here")], labels


def test_a_clean_near_word_leaves_misspellings_on(spark):
    rows, labels = near_word_rows()
    terms = [("moron", False, True)]
    lab = toxicity.training_labels(spark.createDataFrame(labels, "doc_id long, toxic int"))
    got, ordinary = toxicity.trusted_misspellings(docs_of(spark, rows), lab, terms)
    assert got == terms and ordinary == {"oron"}
    auto = toxicity.Automaton(got, ordinary)
    assert [auto.match(w) for w in ("moron", "morpn", "morqn", "oron")] == [2, 1, 1, 0]


@pytest.mark.parametrize("bound", ["ORDINARY", "ORDINARY_BYTES"])
def test_ordinary_words_as_a_table_give_the_same(spark, monkeypatch, bound):
    rows, labels = near_word_rows()
    rows = [*rows, (1001, "an oron here"), (None, "moron moron moron"), (None, None), (1002, ""),
            (1003, 'he said "morpn" and oron, you moron')]
    docs = docs_of(spark, rows).withColumn("key", F.lit("x")).withColumn("_row", F.lit(7)).withColumn("c0", F.lit(9))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda sample: [("moron", False, True)])

    def results():
        _, ordinary, weights, counts = toxicity.fit(docs, lab)
        return ordinary, weights, sorted(map(str, counts.collect())), sorted(
            map(str, toxicity.drop_toxic(docs, lab).collect()))
    held, weights, counts, left = results()
    monkeypatch.setattr(toxicity, bound, 0)
    table, weights_2, counts_2, left_2 = results()
    assert held == {"oron"} and [r["w"] for r in table.collect()] == ["oron"]
    assert np.allclose(weights, weights_2) and counts == counts_2
    assert left == left_2 and len(left) < len(rows) - 100


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    terms, weights, counts = toxicity.train(docs_of(spark, [(1, "a b c")]), none)
    assert terms == [] and toxicity.score(counts, weights).first()["score"] < 0.5
    assert toxicity.train(docs_of(spark, []), none)[2].count() == 0


# -------------------------------------------------------------------- packing

def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(30):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 9) for _ in lengths]
        k = rng.randint(1, 4)

        def waste(bounds):
            return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))
        best = min(waste((*cut, lengths[-1])) for r in range(min(k, len(lengths)))
                   for cut in itertools.combinations(lengths[:-1], r))
        got = packing.best_boundaries(lengths, counts, k)
        assert len(got) <= k and waste(got) == best


def test_packing_places_every_row(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 7)
    docs = [(i, words(1 + i * 7 % 90)) for i in range(150)] + [(1, "a"), (1, "a"), (None, None), (None, ""), (500, words(900))]
    got = packing.pack(docs_of(spark, docs), buckets=5, token_budget=200).collect()
    assert len(got) == len(docs)
    assert sorted(r["n_tokens"] for r in got) == sorted(
        max(1, len(re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+|[!-~]", t or ""))) for _, t in docs)
    batches = {}
    for r in got:
        assert r["n_tokens"] <= r["padded_tokens"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for (bucket, _), rows in batches.items():
        fit = max(1, 200 // rows[0]["padded_tokens"])
        assert sorted(r["slot"] for r in rows) == list(range(len(rows))) and len(rows) <= fit
        assert len(rows) == fit or sum(len(x) < fit for (b, _), x in batches.items() if b == bucket) == 1
    assert packing.pack(docs_of(spark, [])).count() == 0


def test_boundaries_are_lengths_of_documents(spark):
    lengths = [5, 9001, 20_001, 20_001, 100_003]
    assert packing.boundaries_of(spark.createDataFrame([(n,) for n in lengths], "n_tokens long")) == sorted(set(lengths))


def test_long_lengths_are_cut_exactly():
    """Against the plain quadratic program, on lengths and counts of any size."""
    rng = random.Random(21)
    for top in (40, 30_000, 10**15):
        lengths = sorted({rng.randint(1, top) for _ in range(120)})
        counts = [rng.randint(1, 10**rng.randint(0, 9)) for _ in lengths]
        rows = [0, *itertools.accumulate(counts)]
        best = [0, *(s * r for s, r in zip(lengths, rows[1:], strict=True))]
        for k in range(1, 7):
            got = packing.best_boundaries(lengths, counts, k)
            cost = sum(c * next(b for b in got if b >= n) for n, c in zip(lengths, counts, strict=True))
            assert len(got) <= k and cost == best[-1]
            best = [0] + [min(best[i] + lengths[j - 1] * (rows[j] - rows[i]) for i in range(j))
                          for j in range(1, len(rows))]


def test_many_distinct_lengths_take_linear_time():
    start = time.time()
    got = packing.best_boundaries(list(range(1, 300_001)), [1 + i % 7 for i in range(300_000)])
    assert len(got) == packing.BUCKETS and got[-1] == 300_000
    assert time.time() - start < 30


# ------------------------------------------------------------------------ pii

def test_pseudonyms_keep_format_and_reverse():
    key, rng = b"k", random.Random(6)
    values = ["4539 1488 0343 6467", "DE89 3704 0044 0532 0130 00", "078-05-1120", "2024-02-29", "29/02/2024",
              "31.12.1999", "+1 (974) 555-3436", "10.0.255.1", "Ann.B-9@mail.example.com"]
    seen = {}
    for kind, v in zip(("card", "iban", "ssn", "date", "date", "date", "phone", "ip", "email"), values, strict=True):
        new = pii.pseudonym(kind, v, key)
        shape = (lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", s))))
        assert new != v and pii.pseudonym(kind, new, key, back=True) == v
        if kind != "ip":
            assert shape(new) == shape(v)
        seen[v] = new
    text = "x " + " ; ".join(values) + " y"
    new, counts = pii.replace(text, key)
    assert sum(counts.values()) == len(values) and pii.reveal(new, key) == text
    assert all(v in new for v in seen.values())
    for bad in ("4539 1488 0343 6468", "2023-02-29", "300.1.1.1", "666-12-1234", "plain words 12"):
        assert pii.replace(bad, key)[0] == bad
    domain = [pii.permute([a, b], [7, 5], key, "t") for a in range(7) for b in range(5)]
    assert len({tuple(d) for d in domain}) == 35
    days = {pii.permute([i], [97], key, "d")[0] for i in range(97)}
    assert days == set(range(97)) and rng


@pytest.mark.parametrize(("value", "around"), [
    ("4539 1488 0343 6467", ["card {} 12/27", "{} 123", "12 {}", "12 {} 2024 x", "ref 77-{}-5", "{}"]),
    ("AT61 1904 3002 3457 3201", ["{} BIC", "{} 2024", "AB12 {} XY", "{}"]),
    ("BE68 5390 0754 7034", ["{} ING", "{} 7"]),
    ("+1 (974) 555-3436", ["{} 24 hours", "{} 190.137.223.204", "tel {} 2024-02-29", "12 {}"]),
    ("+1 974 555 3436", ["{} 24 hours"]),
])
def test_values_beside_other_numbers_keep_their_pseudonym(value, around):
    key = b"k"
    alone = pii.replace(value, key)[0]
    assert alone != value
    for form in around:
        new, _ = pii.replace(form.format(value), key)
        assert alone in new, form
        assert pii.reveal(new, key) == form.format(value)
    assert pii.replace("+1 (826) 555-4081 190.137.223.204", key)[1]["ip"] == 1


def test_pseudonymize_rows(spark):
    docs = docs_of(spark, [(1, "a +1 (974) 555-3436"), (2, "b +1 (974) 555-3436"), (2, "b +1 (974) 555-3436"), (None, None), (3, "")])
    got = sorted(((r["doc_id"] or 0, r["text"], r["n_phone"], r["n_words"]) for r in pii.pseudonymize(docs, b"k").collect()), key=str)
    assert got[0][1] is None and got[1][1][2:] == got[2][1][2:] == got[3][1][2:] and [g[2] for g in got] == [0, 1, 1, 1, 0]
    assert pii.pseudonymize(docs_of(spark, []), b"k").count() == 0


# -------------------------------------------------------------------- secrets

def test_base_spans():
    text = 'x Password: "abcdefghijkl" token=short TOKEN = "0123456789abcdef0" AKIA' + "Z" * 13 + " AKIA" + "Q" * 14 + " ſecret=aaaaaaaaaaaaaa"
    got = [(credentials.KINDS[k], text[s:e]) for s, k, e in credentials.base_spans(text)]
    assert got == [("assign", 'Password: "abcdefghijkl'), ("assign", 'TOKEN = "0123456789abcdef0'),
                   ("hex", "0123456789abcdef0"), ("access", "AKIA" + "Q" * 14)]


def test_learned_formats_find_bare_credentials(spark):
    rng = random.Random(8)
    key = (lambda: "gx_" + "".join(rng.choices("ABCDEFGHIJ0123456789", k=24)))
    rows = [(i, f"{words(5)} secret = {key()} {words(3)}") for i in range(60)]
    bare = key()
    rows += [(100, f"see {bare} there"), (101, None), (102, ""), (102, ""), (None, "plainlongword7 " + "word1234567890abcdxyz" * 2)]
    docs = docs_of(spark, rows)
    got = {r["doc_id"]: r["spans"] for r in credentials.find_secrets(docs, credentials.learn(docs)).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[100]] == [("format", 4, 4 + len(bare))]
    assert got[101] == got[102] == [] and all(got[i][0]["kind"] == "assign" for i in range(60))
    assert credentials.find_secrets(docs_of(spark, []), credentials.learn(docs_of(spark, []))).count() == 0


@pytest.mark.parametrize("make", [
    lambda r: "gx_" + "".join(r.choices("ABCDEFGHIJ", k=9)), lambda r: "".join(r.choices("0123456789", k=14)),
    lambda r: ".".join("".join(r.choices("ABCDEFGHIJ0123456789", k=5)) for _ in range(3))])
def test_short_dotted_and_plain_credentials_are_scored(spark, make):
    rng = random.Random(8)
    rows = [(i, f"{words(5)} secret = {make(rng)} {words(3)} plainlongwords anotherlongword") for i in range(60)]
    bare = make(rng)
    docs = docs_of(spark, [*rows, (100, f"see {bare} there"), (101, f"see {bare}.")])
    got = {r["doc_id"]: r["spans"] for r in credentials.find_secrets(docs, credentials.learn(docs)).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[100]] == [("format", 4, 4 + len(bare))]
    assert [s["start"] for s in got[101]] == [4]
    assert all(len(got[i]) == 1 for i in range(60))


def test_long_training_values_teach_no_end():
    auto = credentials.Automaton([[0] * 200] * 9, cut=frozenset(range(9)))
    assert not any(auto.ends)


def test_tokens_that_meet_base_spans_equal_brute_force():
    rng = random.Random(21)
    piece = (lambda: rng.choice([" ", ".", "..", "token=", "AKIA", "x"]) + "".join(rng.choices("0a" if rng.random() < 0.5 else "0aGz_", k=rng.randint(0, 24))))
    seen = 0
    for _ in range(400):
        text = "".join(piece() for _ in range(rng.randint(1, 25)))
        base = credentials.base_spans(text)
        every = [span for spans in credentials.candidates(text, []) for span in spans]
        want = [(a, b) for a, b in every if not any(a < y and x < b for x, _, y in base)]
        assert [span for spans in credentials.candidates(text, base) for span in spans] == want
        seen += bool(want) and len(want) < len(every)
    assert seen > 50


def test_secret_scan_of_a_long_text_is_linear():
    text = " ".join(["0123456789abcdef", "plainlongword12"] * 100_000)  # 3 MB, 100,000 base spans
    start = time.monotonic()
    base = credentials.base_spans(text)
    assert len(base) == 100_000 and len(credentials.candidates(text, base)) == 100_000
    assert time.monotonic() - start < 10


def test_too_few_labelled_values_make_no_automaton():
    value = (lambda i: f"gx_{i}ABCDEFGHIJ{i}")
    assert not credentials.Formats({"assign": [value(i) for i in range(7)]}, {}).automata
    assert len(credentials.Formats({"assign": [value(i) for i in range(8)]}, {}).automata) == 1


# ----------------------------------------------------------------------- html

def test_field_on_held_out_pages():
    field, right, total = html_extract.trained(), 0, 0
    for page, label in html_training.labelled_pages(60, seed=77):
        blocks = html_extract.leaf_blocks(page)
        assert {t for t, _, _ in blocks} <= set(label)
        got = field.decode(field.scores(field.ids(html_extract.features(blocks))))
        right += sum(y == label[t] for (t, _, _), y in zip(blocks, got, strict=True))
        total += len(blocks)
    assert right / total > 0.95


def test_viterbi_and_marginals_equal_enumeration():
    field = html_extract.Field(["x"])
    rng = np.random.default_rng(0)
    field.pair = rng.normal(size=(2, 2))
    s = rng.normal(size=(5, 2))
    chains = list(itertools.product((0, 1), repeat=5))
    score = [sum(s[i, y] for i, y in enumerate(c)) + sum(field.pair[a, b] for a, b in itertools.pairwise(c)) for c in chains]
    assert tuple(field.decode(s)) == chains[int(np.argmax(score))]
    p = np.exp(score) / np.exp(score).sum()
    assert np.allclose(field.marginals(s)[0][:, 1], sum(q * np.array(c) for q, c in zip(p, chains, strict=True)))


def test_extract_rows(spark):
    page = ('<html><head><title>t</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>'
            '<div class="ad">Buy this now.</div><article><h1>A title &amp; more</h1><p><b>First  words of the text.<br><p>Second&nbsp;one'
            ' is &lt;p&gt; here, and it goes on.</p></article><div class="comments"><p>I like it very much.</p></div>'
            '<footer>&copy; example</footer></body></html>')
    pages = spark.createDataFrame([(1, "u", page, 7), (2, "v", None, 7), (3, None, "", 7), (3, None, "", 7), (None, "w", page, 7)],
                                  "page_id long, url string, html string, text int")
    got = html_extract.extract(pages).collect()
    text = "A title & more\n\nFirst words of the text.\n\nSecond one is <p> here, and it goes on."
    assert [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got] == [
        (1, "u", text, len(text)), (2, "v", "", 0), (3, None, "", 0), (3, None, "", 0), (None, "w", text, len(text))]


@pytest.mark.parametrize("unit", ['<a href="', "<select>", "<script ", "<!--", "<!", "< ", "&#", "<svg>x</svg "])
def test_hostile_pages_take_linear_time(unit):
    start = time.monotonic()
    html_extract.leaf_blocks(unit * (10_000_000 // len(unit)))
    assert time.monotonic() - start < 10


def test_deep_and_stray_nesting_takes_linear_time():
    start = time.monotonic()
    blocks = html_extract.leaf_blocks("<div class=nav>x</p>" * 100_000)
    assert len(blocks) == 100_000 and time.monotonic() - start < 10
    assert blocks[-1][1] == html_extract.Place("div", "menu", frozenset(["div"]), frozenset(["menu"]))


@pytest.mark.parametrize("page, texts", [
    ("<p>a<b c='>'>d</b><p>e", ["ad", "e"]),                       # a quoted > ends no tag
    ("<p>it's<p x=it's>b", ["it's", "b"]),                         # a quote inside a value quotes nothing
    ("<p>a<p title=\"never ends<p>b", ["a"]),                      # a tag without end takes the rest
    ("<p>a<!-- never ends<p>b", ["a"]),
    ("<p>a<!--><p>b<!---><p>c", ["a", "b", "c"]),                  # empty comments
    ("<p>a<script>'</p>'</SCRIPT ><p>b<script>x", ["a", "b"]),
    ("<p>a<select><option>b</select>c<select><p>d", ["ac", "d"]),  # the second has no end
    ("<p>a<svg/>b<svg><p>c</svg>d", ["abd"]),
    ("<p>1 < 2 <3", ["1 < 2 <3"]),
    ("<p>x&#" + "1" * 6000 + ";y&#" + "0" * 6000 + "65;&#65;", ["x\ufffdyAA"]),
])
def test_marks_end_where_a_browser_ends_them(page, texts):
    assert [t for t, _, _ in html_extract.leaf_blocks(page)] == texts


# ---------------------------------------------------------------------- top-k

def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(1)
    vec = (lambda: [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(6)])
    same = vec()
    rows = [(i, same if i % 3 == 0 else vec()) for i in range(60)]
    bad = [(70, None), (71, [0.1, None]), (72, [float("nan")] * 6), (73, [float("inf")] * 6), (None, vec()), (rows[1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect()
    q = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows}
    for i in range(0, 60, 10):
        want = sorted(((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in q if j != i))[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])] == [
            (j, -s) for s, j in want]
    assert len(got) == 30 and topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_top_k_scores_that_do_not_fit_raise(spark):
    rows = [(0, [1e300, 1.0], 1, 2), (1, [1.0, 1e6], 1, 2), (2, [3.0, 4.0], 1, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int, rank int")
    with pytest.raises(ValueError, match="64-bit"):
        topk.top_k(df, F.col("vec_id") == 0).count()
    got = topk.top_k(df.where("vec_id > 0"), F.col("vec_id") == 1).collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 256 * 3 * 256 + 256 * 10**6 * 256 * 4)]


# ----------------------------------------------------------------- preference

def test_preference_rows(spark):
    turns = [(2, 0, "user", "q"), (2, 1, "assistant", "yes"), (3, 0, "user", "q"), (3, 1, "assistant", "no <|im_end|>"),
             (3, 2, "user", None), (3, 2, "user", None), (4, 0, "user", "alone"), (None, 0, "user", "lost"),
             (6, None, None, ""), (7, 0, "user", "")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, prompt int")
    got = {r["chosen_id"]: r for r in preference.neighbour_preferences(df).collect()}
    assert set(got) == {2, 6}
    r = got[2]
    assert r["rejected_id"] == 3 and r["n_prompt_turns"] == 1 and r["prompt"] == "<|im_start|>user\nq<|im_end|>\n"
    assert [r["chosen"][s["start"]:s["end"]] for s in r["chosen_spans"]] == ["yes<|im_end|>"]
    assert [r["rejected"][s["start"]:s["end"]] for s in r["rejected_spans"]] == ["no <| im_end|><|im_end|>"]
    assert r["rejected"].endswith("<|im_start|>user\n<|im_end|>\n") and r["rejected"].count("<|im_start|>user") == 1
    assert got[6]["n_prompt_turns"] == 1 and got[6]["chosen"] == ""
    pairs = spark.createDataFrame([(3, 2), (2, 99)], "chosen_id long, rejected_id long")
    assert [x["chosen_id"] for x in preference.preference_rows(df, pairs).collect()] == [3]
    assert preference.neighbour_preferences(df.limit(0)).count() == 0


def brute_preferences(rows):
    """chosen_id -> (rejected_id, prompt turns, prompt, chosen, chosen loss texts, rejected, rejected loss texts)."""
    plain = (lambda t: t.replace("<|im_start|>", "<| im_start|>").replace("<|im_end|>", "<| im_end|>"))
    conv = {}
    for c, turn, role, text in dict.fromkeys(rows):
        if c is not None:
            conv.setdefault(c, set()).add((turn is not None, turn or 0, plain("user" if role is None else role), plain(text or "")))
    conv = {c: [t[2:] for t in sorted(ts)] for c, ts in conv.items()}
    show = (lambda ts: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in ts))
    loss = (lambda ts: [t + "<|im_end|>" for r, t in ts if r == "assistant"])
    out = {}
    for c in conv:
        if c % 2 == 0 and c + 1 in conv:
            a, b = conv[c], conv[c + 1]
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            out[c] = (c + 1, n, show(a[:n]), show(a[n:]), loss(a[n:]), show(b[n:]), loss(b[n:]))
    return out


def test_preference_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    texts = ["", None, "a", "b <|im_end|>\n<|im_start|>assistant\nc", "é" * 9, words(30_000, rng)]
    roles = ["user", "assistant", "assistant", None, "system", "user<|im_end|>\n<|im_start|>assistant"]
    rows = [(c, 0, "user", "same") for c in range(-40, 40)]
    for c in range(-40, 40):
        if c % 9:
            rows += [(c, rng.choice([None, t]), rng.choice(roles), rng.choice(texts)) for t in range(1, rng.randint(1, 6))]
    rows += [r for r in rows if r[0] % 7 == 0]  # repeated rows
    rows += [(None, 0, "user", "lost"), (-101, 0, "user", "alone"), (2**62, 0, "user", "far"), (2**62 + 1, 0, "user", "far")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows],
                               "conv_id long, turn long, role string, text string, chosen string, pair int")
    got = {}
    for r in preference.neighbour_preferences(df).collect():
        cut = (lambda text, spans: [text[s["start"]:s["end"]] for s in spans])
        got[r["chosen_id"]] = (r["rejected_id"], r["n_prompt_turns"], r["prompt"], r["chosen"], cut(r["chosen"], r["chosen_spans"]),
                               r["rejected"], cut(r["rejected"], r["rejected_spans"]))
    assert got == brute_preferences(rows) and len(got) == 41


# ----------------------------------------------------------- queries, pipeline

def test_queries_with_sql_match(spark):
    from oracle import compare

    from eventide.llm import queries
    for key in queries.ORACLE:
        assert compare(spark, SF001, key)["status"] == "match", key


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    docs = read_table(spark, SF001, "documents")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001).cache()
        assert out.columns == names, name
        assert out.count() <= docs.count()
        docs = out
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    bench = [(r["item_id"], r["text"]) for r in read_table(spark, SF001, "benchmark").collect()]
    assert all(not r[2] for r in brute_contamination(rows, bench))
    assert len(set(brute_components(rows, 80).values())) == len(rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert sorted(r["doc_id"] for r in packed.collect()) == sorted(i for i, _ in rows)
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0


def test_stages_keep_columns_that_clash(spark):
    """Nulls in every column, repeated rows, empty and long texts, and extra
    columns named like the operators' own."""
    import corpus_pipeline
    rng = random.Random(11)
    base = words(60, rng)
    rows = [(1, base), (1, base), (1, None), (2, ""), (None, base), (None, None), (3, base), (4, base + " tail"),
            (5, words(30_000, rng)), (6, "x" * 300_000), (7, "\n" * 5_000)]
    rows += [(100 + i, f"a common line\nown line {i}") for i in range(12)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    extra = ["n_lines", "n_dropped", "toxic", "score", "copy", "keys", "rep", "comp", "n", "start", "words", "h", "k",
             "seq", "key", "w", "kept", "n_shingles", "component_id", "items", "bands", "pos", "c0", "batch", "bucket"]
    for name in extra:
        docs = docs.withColumn(name, F.lit("own " + name))
    left = {"toxicity": len(rows), "line_dedup": len(rows), "near_dedup": len(rows) - 3, "decontaminate": len(rows)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        got = out.collect()
        assert len(got) == left[name], name
        assert all(r[c] == "own " + c for r in got for c in extra), name
        if name == "line_dedup":
            assert {r["text"] for r in got if (r["doc_id"] or 0) >= 100} == {f"own line {i}" for i in range(12)}
            assert all(r["n_chars"] == len(r["text"]) for r in got if (r["doc_id"] or 0) >= 100)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count() == len(rows)


def test_toxic_labels_alone_drop_nothing(spark):
    docs = docs_of(spark, [(2, "plain words here"), (3, None), (4, "")])
    labels = spark.createDataFrame([(2, 1, 1), (None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(docs, labels).count() == 3
