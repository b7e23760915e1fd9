"""Line dedup: drop lines that recur in many documents.

One scan splits every text, normalises each line, and keeps a 128-bit digest
per line (written to the shared folder: 16 bytes a line, no text). Rows are
counted per digest first (partial counts, a hot line costs one row per task):
never fewer than documents, so only digests in enough rows have their distinct
ids counted. Common digests mark positions; positions are
gathered per document and joined to the texts, whose other lines are put
together again in order. Texts are shuffled once, to that last join.

The set of common digests is broadcast while it is at most
``BROADCAST_ROWS`` rows; beyond it the join shuffles digests, and adaptive
execution splits the partitions of hot lines.

Defined results: a null or empty text is one empty line and is never dropped
(its key is empty); a line counts once for every distinct doc_id that holds it,
however many rows have that id, and rows without an id count for no line, but
lose their common lines as others do; a text whose lines all go becomes empty; an empty table stays
empty. ``drop_common_lines`` keeps all columns and changes ``text`` only; the two
counts it adds replace columns of their names unless other names are given, and
its own column names start with ``_ld_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import BROADCAST_ROWS, ascii_lower, bind, text_key, written

# Fixed value: the white space stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
MIN_DOCUMENTS = 10
MIN_KEY_CHARS = 1


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(text: Column, min_chars: int = MIN_KEY_CHARS) -> Column:
    """Digest of every line's key, null where the key is too short to count."""
    def key(line: Column) -> Column:
        return bind(F.btrim(line, F.lit(BLANKS)), lambda k: F.when(
            F.length(k) >= max(1, min_chars), F.unhex(F.md5(k))))
    return F.transform(lines_of(ascii_lower(text)), key)


def common_positions(documents: DataFrame, min_documents: int = MIN_DOCUMENTS,
                     min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """(doc_id, text_key, dropped): the line positions to drop, per document
    that has any."""
    keys = written(documents.select(
        "doc_id", text_key(F.col("text")).alias("text_key"),
        line_keys(F.col("text"), min_chars).alias("keys")), "line-keys")
    each = keys.where("doc_id is not null").select(
        "doc_id", F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
    often = written(each.groupBy("key").agg(F.count("*").alias("n"))
                    .where(F.col("n") >= min_documents).select("key"), "frequent-lines")
    if often.count() <= BROADCAST_ROWS:
        often = F.broadcast(often)
    # distinct by (key, doc_id) first, so a hot line is spread over tasks
    common = written(each.join(often, "key").distinct().groupBy("key").agg(F.count("*").alias("n"))
                     .where(F.col("n") >= min_documents).select("key"), "common-lines")
    if common.count() <= BROADCAST_ROWS:
        common = F.broadcast(common)
    at = keys.select("doc_id", "text_key", F.posexplode("keys").alias("pos", "key"))
    return at.join(common, "key").groupBy("doc_id", "text_key").agg(
        F.collect_set("pos").alias("dropped"))


def drop_common_lines(documents: DataFrame, min_documents: int = MIN_DOCUMENTS,
                      min_chars: int = MIN_KEY_CHARS, counts: tuple[str, str] = ("n_lines", "n_dropped"),
                      ) -> DataFrame:
    """``documents`` with the common lines gone from ``text``; adds the two
    ``counts``, lines before dropping and lines dropped. A null text without
    dropped lines stays null."""
    lines, dropped = counts
    gone = common_positions(documents, min_documents, min_chars).select(
        F.col("doc_id").alias("_ld_id"), F.col("text_key").alias("_ld_key"),
        F.col("dropped").alias("_ld_gone"))
    docs = documents.drop(*counts).withColumn("_ld_of", text_key(F.col("text")))
    both = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_ld_id"])
                     & (docs["_ld_of"] == gone["_ld_key"]), "left")
    kept = bind(lines_of(F.col("text")), lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_ld_gone")),
        lambda i: F.get(ls, i)), "\n"))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return both.withColumns({
        lines: F.coalesce(n_lines, F.lit(1)).cast("long"),
        dropped: F.coalesce(F.size("_ld_gone"), F.lit(0)).cast("long"),
        "text": F.when(F.col("_ld_gone").isNull(), F.col("text")).otherwise(kept),
    }).drop("_ld_of", "_ld_id", "_ld_key", "_ld_gone")
