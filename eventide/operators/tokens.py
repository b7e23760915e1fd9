"""Word-count family (J1, J2, J4, J6).

Counting is decomposable, so a hot word (even a third of all tokens) is
combined map-side by the partial ``HashAggregate``: each task ships one row
per distinct word, never the raw tokens. No salting is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.text import chunk_tokens, space_tokens, text_chunks


def tokenize(records: DataFrame, value: str = "value",
             keep: tuple[str, ...] = (), chunk_chars: int | None = None) -> DataFrame:
    """One row per space-separated token, column ``word``.

    A row is split by one task. ``chunk_chars`` bounds that work for huge
    texts: each text is first cut at spaces into pieces of about that many
    characters, the pieces are spread over the cluster by (source row,
    piece number), and each piece is split on its own; the tokens are the
    same (see ``text_chunks``). The spread key is per source row, not the
    piece text, so many exact copies of one text do not meet in one task.
    The row id is stable on recompute for a file scan (fixed split order).
    """
    if chunk_chars is None:
        return records.select(*keep, F.explode(space_tokens(value)).alias("word"))
    pieces = records.select(*keep, F.monotonically_increasing_id().alias("_row"),
                            F.posexplode(text_chunks(value, chunk_chars))
                            .alias("_piece_no", "_piece"))
    if not records.isStreaming:
        pieces = pieces.repartition("_row", "_piece_no")
    return pieces.select(*keep, F.explode(chunk_tokens("_piece")).alias("word"))


def token_pairs(tokens: DataFrame) -> DataFrame:
    """Each token paired with the integer one."""
    return tokens.select("word", F.lit(1).cast("int").alias("one"))


def word_count(tokens: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Count ``n`` per (by..., word)."""
    return tokens.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def word_count_per_batch(tokens: DataFrame) -> DataFrame:
    """Counts restart every micro-batch: keyed by ``batch_id`` too."""
    return word_count(tokens, by=("batch_id",))


def sort_by_count(counts: DataFrame, count_col: str = "n") -> DataFrame:
    """Most frequent first, ties by word.

    A global sort is a range-partitioned shuffle (sampled bounds), so it
    scales with the number of distinct words, not with one task.
    """
    return counts.orderBy(F.col(count_col).desc(), F.col("word").asc())


def top_words(counts: DataFrame, k: int = 10, count_col: str = "n") -> DataFrame:
    """Preview: the k most frequent words.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each task keeps a
    k-row heap, only k rows per task reach the final merge.
    """
    return sort_by_count(counts, count_col).limit(k)


def running_total(tokens: DataFrame) -> DataFrame:
    """Per-word total over everything consumed so far (``cnt``).

    On a stream this is a stateful aggregation (update/complete mode): the
    state store holds one row per word across micro-batches.
    """
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def merge_totals(state: DataFrame, delta: DataFrame, key: str = "word",
                 value: str = "cnt") -> DataFrame:
    """Fold one batch of counts into stored totals (the upsert of J4).

    A full outer equi-join on the key: words only in the state keep their
    total, new words are inserted, common words add up. Both inputs are
    already aggregated (one row per key), so the join shuffles distinct keys
    only; a hot word is one row on each side.
    """
    s = state.select(F.col(key), F.col(value).alias("_s"))
    d = delta.select(F.col(key), F.col(value).alias("_d"))
    return s.join(d, key, "full_outer").select(
        key, (F.coalesce("_s", F.lit(0)) + F.coalesce("_d", F.lit(0))).cast("bigint").alias(value))
