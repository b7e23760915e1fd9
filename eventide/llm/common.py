"""Column helpers and shared-folder tables used by several operators."""

from __future__ import annotations

import ctypes
import gc
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import scratch_path

# The separators between words of letters and digits (the
# complement of the contract's word class, upper case kept inside words).
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Most rows of a side that is broadcast; larger sides are joined in blocks or
# by a shuffle.
BROADCAST_ROWS = 500_000


def ascii_lower(c: Column) -> Column:
    """``c`` with A-Z lowered and every other character as it is."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """Lower-case words of letters, digits and non-ASCII characters; null text
    has no words."""
    pieces = F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_SEPARATORS)
    return F.array_remove(pieces, "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the
    body uses it (the optimizer cannot copy it into each use)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_key(text: Column) -> Column:
    """16-byte digest of a text; null has its own. With the id it names a row
    whose id may be null or repeated."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit(""))))


def releasing(run):
    """``run`` for mapInArrow, after which the Python worker gives the memory it
    used back to the system: workers stay alive for later tasks, and those of a
    stage would otherwise keep their peak beside the ones that follow."""
    def to_the_end(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)
    return to_the_end


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read back: cuts the
    lineage, survives lost executors, and gives the planner its real size."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dedup_names(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that clash with what an operator adds."""
    return df.drop(*names)
