"""One query per operator over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (credentials, decontaminate, html_extract, importance, jaccard_join, line_dedup, minhash,
                          packing, periodic_runs, pii, preference, topk, toxicity)
from eventide.sources.records import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# d, b: words of documents and items; win: distinct windows per item; occ: the
# places in documents where a window occurs.
DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS g
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
       FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
occ AS (SELECT doc_id, i, a.k, item_id FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM pos) a
        JOIN win ON win.g = a.g AND win.k = a.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op1_decontaminate", DECONTAMINATE_SQL)
def op1_decontaminate(spark, sf):
    got = decontaminate.contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op3_packing")
def op3_packing(spark, sf):
    return packing.pack(read_table(spark, sf, "documents")).drop("text_key")


LINE_DEDUP_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, line, i, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), {UPPER}) AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.key = hot.key GROUP BY doc_id"""


@query("op4_line_dedup", LINE_DEDUP_SQL)
def op4_line_dedup(spark, sf):
    got = line_dedup.drop_common_lines(read_table(spark, sf, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_toxicity")
def op7_toxicity(spark, sf):
    docs = read_table(spark, sf, "documents")
    _, weights, counts = toxicity.train(docs, read_table(spark, sf, "labels"))
    got = toxicity.score(counts, weights)
    return got.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_minhash")
def op8_minhash(spark, sf):
    return minhash.near_duplicates(read_table(spark, sf, "documents"))


@query("op2_preference")
def op2_preference(spark, sf):
    return preference.neighbour_preferences(read_table(spark, sf, "conversations"))


@query("op5_html_extract")
def op5_html_extract(spark, sf):
    return html_extract.extract(read_table(spark, sf, "pages"))


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


@query("op6_top_k", TOP_K_SQL)
def op6_top_k(spark, sf):
    return topk.top_k(read_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op9_pii")
def op9_pii(spark, sf):
    got = pii.pseudonymize(read_table(spark, sf, "documents").select("doc_id", "text"), pii.QUERY_KEY)
    found = sum((F.col(f"n_{k}") for k in pii.KINDS[1:]), F.col(f"n_{pii.KINDS[0]}"))
    return got.withColumn("n_found", found)


@query("op10_secrets")
def op10_secrets(spark, sf):
    docs = read_table(spark, sf, "documents")
    got = credentials.find_secrets(docs, credentials.learn(docs))
    count = (lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long"))
    written_out = (lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","))
    return got.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                      count("hex").alias("n_hex"),
                      F.sha2(written_out(F.filter("spans", lambda s: s["kind"] != "format")), 256).alias("base_sha256"),
                      written_out(F.col("spans")).alias("spans"))


# tab: the 256 remainders of CRC-32; w: words of either table; crc: the bucket of
# each distinct word, byte by byte.
IMPORTANCE_SQL = f"""
WITH tab AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i:
                 CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
             FROM (SELECT unnest(range(256)) AS b)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
crc AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h) // 2 + 1),
                 lambda i: CAST('0x' || h[2 * i - 1:2 * i] AS BIGINT))),
                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)), tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (w) GROUP BY 1),
al AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + 10000) AS DOUBLE)
                 / CAST((coalesce(s, 0) + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
         FROM s FULL JOIN t USING (bucket), al),
wt AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight
       FROM dw JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY 1),
sc AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE)
                  / 4294967296))) AS BIGINT) AS score
       FROM d LEFT JOIN wt USING (doc_id)),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM sc WHERE n_features >= 20),
n AS (SELECT count(*) * 10 // 100 AS k FROM rk)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN rank <= k THEN rank END AS rank
FROM sc LEFT JOIN rk USING (doc_id), n"""


def linked_sql(width: int, columns: str) -> str:
    """sh: distinct shingles; k: a class per distinct set; l: links of classes that
    share a shingle; reach: least class label, by rounds."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - {width - 1}, 1) + 1 END),
        lambda i: array_to_string(w[i:i + {width - 1}], ' ')))) AS s FROM w),
k AS MATERIALIZED (SELECT min(doc_id) AS rep, s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
t AS MATERIALIZED (SELECT rep, n, unnest(s) AS g FROM k),
l AS MATERIALIZED (SELECT a.rep AS a, b.rep AS b FROM t a JOIN t b ON a.g = b.g AND a.rep <> b.rep
      AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT rep, rep AS comp FROM k
          UNION SELECT l.b, reach.comp FROM reach JOIN l ON l.a = reach.rep WHERE reach.comp < l.b),
comp AS (SELECT rep, min(comp) AS comp FROM reach GROUP BY rep)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(comp, s.doc_id) AS component_id{columns}
FROM s LEFT JOIN k ON k.s = s.s LEFT JOIN comp ON comp.rep = k.rep"""


@query("op11_jaccard_join", linked_sql(4, ""))
def op11_jaccard_join(spark, sf):
    return jaccard_join.jaccard_classes(read_table(spark, sf, "documents"))


@query("op12_importance", IMPORTANCE_SQL)
def op12_importance(spark, sf):
    got = importance.resample(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf):
    got = periodic_runs.periodic_runs(read_table(spark, sf, "documents"), prepare=periodic_runs.planted)
    # arrays compare field by field: the longest run, then the least start and period
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(order)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                     r["period"].cast("string")))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return got.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
