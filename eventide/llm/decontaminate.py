"""Benchmark decontamination by a prefix-filtered containment join.

Every benchmark item is cut into windows of ``window`` consecutive words (a
shorter item is one window). A window is found in a document when the document
holds its words in a row, so the window's set of word shingles must be wholly
contained in the document's: with containment 1 the necessary prefix of a
window is one shingle, and the rarest one is taken (fewest windows hold it), so
a document position meets few windows. Documents probe with all their shingles;
a match is a candidate that must pass the length bound (the document has at
least the window's words), the positional bound (the window fits at that
offset) and the word-by-word check. All of it runs inside one generated stage
on the scan: no text is shuffled, only (document, hit) rows are.

Windows are broadcast in blocks of at most ``block_rows`` rows; a benchmark
with more windows takes one pass over the documents per block.

Defined results: a null or empty text has no words and no hits; rows with the
same id and text each get a row; rows with the same id and different texts are
told apart by a digest of the text; null item texts or items without words
match nothing; repeated items count by distinct ``item_id`` (a null id is
written as ``null``); an empty benchmark leaves every document clean. Other
columns of either table are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import BROADCAST_ROWS, bind, text_key, words_of, written

WINDOW_WORDS = 10
SHINGLE_WORDS = 3


def shingle_hashes(words: Column, k: int) -> Column:
    """64-bit hashes of the k-word shingles at every position of ``words``."""
    one = (lambda i: F.xxhash64(F.lit(k), *[F.get(words, i + j) for j in range(k)]))
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k), one)).otherwise(
        F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, words): every window of every item, one row per item and
    distinct window."""
    cut = (lambda w: F.when(F.size(w) == 0, F.array().cast("array<array<string>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - window, F.lit(0))),
                    lambda i: F.slice(w, i + 1, window))))
    return benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        F.explode(F.array_distinct(bind(words_of(F.col("text")), cut))).alias("words"),
    ).distinct()


def window_prefixes(windows: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row per distinct window: its rarest shingle (``h``), that shingle's
    width ``k`` and offset, and the window's words. Rarity is the number of
    distinct windows that hold the shingle; ties go to the smaller hash."""
    distinct = windows.select("words").distinct().select(
        "words", F.xxhash64("words").alias("window_id"),
        F.least(F.size("words"), F.lit(shingle)).alias("k"))
    hashes = reduce(lambda rest, k: F.when(F.col("k") == k, shingle_hashes(F.col("words"), k))
                    .otherwise(rest), range(1, shingle), shingle_hashes(F.col("words"), shingle))
    each = distinct.select("*", F.posexplode(hashes).alias("offset", "h"))
    counts = each.groupBy("h").agg(F.count_distinct("words").alias("n"))
    return each.join(counts, "h").groupBy("words").agg(
        F.min(F.struct("n", "h", "offset", "k")).alias("p")).select(
        F.col("p.h").alias("h"), F.col("p.k").alias("k"), F.col("p.offset").alias("offset"), "words")


def find_windows(documents: DataFrame, prefixes: DataFrame,
                 block_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every occurrence of a window: (doc_id, text_key, n_words, start, words),
    and one row per document row with null ``start`` and ``words``."""
    sizes = {r["k"]: r["n"] for r in prefixes.groupBy("k").agg(F.count("*").alias("n")).collect()}
    ks = sorted(sizes)  # at most SHINGLE_WORDS values
    blocks = max(1, -(-sum(sizes.values()) // block_rows))
    docs = documents.select("doc_id", text_key(F.col("text")).alias("text_key"),
                            words_of(F.col("text")).alias("w"))
    docs = docs.select("*", F.size("w").alias("n_words"), F.concat(
        F.array(F.lit(0).cast("bigint")), *[shingle_hashes(F.col("w"), k) for k in ks]).alias("h"))
    # position 0 is the row itself; the shingles of each width follow in turn
    first, base = {}, F.lit(1)
    for k in ks:
        first[k] = base
        base = base + F.greatest(F.col("n_words") - (k - 1), F.lit(0))
    at = reduce(lambda rest, k: F.when(F.col("k") == k, F.col("p") - first[k]).otherwise(rest),
                ks, F.lit(None).cast("int"))
    spark = documents.sparkSession
    own = spark.range(1).select(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("k"),
                                F.lit(0).alias("offset"),
                                F.lit(None).cast("array<string>").alias("words"))
    out = []
    for b in range(blocks):
        part = prefixes.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)
        part = part.unionByName(own) if b == 0 else part
        probes = docs.select("doc_id", "text_key", "n_words", "w",
                             F.posexplode(F.concat("h", F.array().cast("array<bigint>")))
                             .alias("p", "h"))
        start = at - F.col("offset")
        long = F.size("words")
        hit = probes.join(F.broadcast(part), "h").where(
            ((F.col("k") == 0) & (F.col("p") == 0))
            | ((F.col("k") > 0) & (F.col("n_words") >= long) & (start >= 0)
               & (start + long <= F.col("n_words"))
               & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.greatest(long, F.lit(0)))
                  == F.col("words"))))
        out.append(hit.select("doc_id", "text_key", "n_words",
                              F.when(F.col("k") > 0, start).alias("start"), "words"))
    return reduce(DataFrame.unionByName, out)


def covered(spans: Column) -> Column:
    """Positions inside any of the (start, end) spans; sorts them first."""
    step = (lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("n"),
        F.greatest(a["upto"], s["end"]).alias("upto")))
    return F.aggregate(F.array_sort(spans),
                       F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
                       step, lambda a: a["n"].cast("long"))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
                  block_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document row: doc_id, text_key, n_words, n_hit (words inside
    an occurrence), items (ids found, sorted as strings), n_items."""
    windows = written(benchmark_windows(benchmark, window), "decon-windows")
    prefixes = written(window_prefixes(windows), "decon-prefixes")
    found = written(find_windows(documents, prefixes, block_rows), "decon-hits")
    key = ["doc_id", "text_key"]
    rows = found.where("start is null").groupBy(*key).agg(
        F.first("n_words").alias("n_words"), F.count("*").alias("copies"))
    hits = found.where("start is not null")
    spans = hits.groupBy(*key).agg(covered(F.collect_set(F.struct(
        "start", (F.col("start") + F.size("words")).alias("end")))).alias("n_hit"))
    # windows are looked up once per document and distinct window
    items = hits.select(*key, "words").distinct().join(windows, "words").groupBy(*key).agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))
    same = (lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"]))
    clean = F.array().cast("array<string>")
    out = (rows.alias("r").join(spans.alias("s"), same(F_("r"), F_("s")), "left")
           .join(items.alias("i"), same(F_("r"), F_("i")), "left"))
    return out.select(
        "r.doc_id", "r.text_key", F.col("r.n_words").cast("long").alias("n_words"),
        F.coalesce("s.n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("i.items", clean).alias("items"),
        F.size(F.coalesce("i.items", clean)).cast("long").alias("n_items"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("r.copies"))).alias("copy"),
    ).drop("copy")


class F_:
    """Columns of an aliased side: ``F_("r")["x"]`` is ``r.x``."""

    def __init__(self, side: str):
        self.side = side

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.side}.{name}")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame,
                      window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``documents`` in which no benchmark window occurs, with all
    their columns. Only the hit documents' keys are shuffled to the join."""
    windows = written(benchmark_windows(benchmark, window), "decon-windows")
    found = find_windows(documents, window_prefixes(windows))
    bad = written(found.where("start is not null").select("doc_id", "text_key").distinct(),
                  "decon-bad")
    docs = documents.withColumn("_decon_key", text_key(F.col("text")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"])
                     & (docs["_decon_key"] == bad["text_key"]), "left_anti").drop("_decon_key")
