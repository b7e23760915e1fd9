"""Record-level projections and per-batch aggregates (J3, J7, J8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.text import day_key, fixed_position, strict_int, three_fields

# The alert threshold on the mean reading and the text that
# joins the days of one alert row.
ALERT_THRESHOLD = 22
DAY_JOINER = "="


def value_projection(records: DataFrame) -> DataFrame:
    return records.select("value")


def key_value_projection(records: DataFrame) -> DataFrame:
    return records.select("key", "value")


def split_three_fields(records: DataFrame, value: str = "value") -> DataFrame:
    f0, f1, f2 = three_fields(value)
    return records.select(f0.alias("f0"), f1.alias("f1"), f2.alias("f2"))


def readings(records: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """(day, reading) per record: the key's date and the value as an integer.

    strict=True fails on a non-integer reading or a key shorter than 10
    characters (as the reference does); strict=False drops such records.
    """
    day = day_key("key")
    if strict:  # a short or missing key fails like substring(0, 10) does
        day = F.when(day.isNotNull(), day).otherwise(F.raise_error(
            F.concat(F.lit("record key shorter than 10 characters: "),
                     F.coalesce(F.col("key"), F.lit("null")))).cast("string"))
    out = records.select(*keep, "ts", day.alias("day"),
                         strict_int("value", strict).alias("reading"))
    if not strict:
        out = out.where(F.col("reading").isNotNull() & F.col("day").isNotNull())
    return out


def fixed_position_split(records: DataFrame, col: str = "value",
                         keep: tuple[str, ...] = ()) -> DataFrame:
    head, tail = fixed_position(col)
    return records.select(*keep, head.alias("head"), tail.alias("tail"))


def value_count_per_batch(records: DataFrame) -> DataFrame:
    """How often each whole value occurs in a batch."""
    return records.groupBy("batch_id", "value").agg(F.count(F.lit(1)).alias("n"))


def batch_size(records: DataFrame) -> DataFrame:
    """Records per micro-batch."""
    return records.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


def mean_by_day(reads: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean reading per day, partially aggregated.

    ``avg`` keeps (sum, count) per task, so no group's values are ever
    gathered in one place; the 64-bit sum also avoids the reference's 32-bit
    overflow.
    """
    return reads.groupBy(*by, "day").agg(F.avg("reading").alias("mean"))


def flag_and_join(means: DataFrame, by: tuple[str, ...] = (),
                  threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """All days as one text, and whether every mean is above the threshold.

    Days are joined in sorted order (the reference's order depends on the
    reduce order). The list per group is bounded by the number of days in the
    group: one row per day after the first aggregation.
    """
    return means.groupBy(*by).agg(
        F.concat_ws(DAY_JOINER, F.sort_array(F.collect_list("day"))).alias("data"),
        F.bool_and(F.col("mean") > F.lit(threshold)).alias("result"))


def alert_summary(reads: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    return flag_and_join(mean_by_day(reads), threshold=threshold)
