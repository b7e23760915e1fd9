"""Log-line metrics (J5): parse, page views per hour and site, unique users.

The reference collects every parsed line to the driver and issues one
counter increment per line. Here every metric is a distributed aggregate
with map-side partial aggregation; only aggregated rows leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.text import (DAY_PREFIX_LEN, SITE_PIECE, USER_PIECE, log_field_array,
                                     log_hour, uri_piece_array)

# Metric key prefixes of the reference's counters and sets.
PV_PREFIX = "pv_"
SITE_PV_PREFIX = "site_pv_"
UV_PREFIX = "uv_"


def _split_once(records: DataFrame, value: str, keep: tuple[str, ...]) -> DataFrame:
    """Split each line into its field array and uri pieces, in projections of
    their own so every split runs once per line."""
    f = records.select(*keep, log_field_array(value).alias("_f"))
    return f.select(*keep, F.get("_f", 0).alias("_f0"), uri_piece_array(F.get("_f", 2)).alias("_u"))


def _record_cols():
    return log_hour("_f0"), F.get("_u", USER_PIECE), F.get("_u", SITE_PIECE)


def parse_log(records: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Log lines to (hour, user_id, site_id), 0 or 1 row per line: malformed lines dropped.

    Semantics in :func:`eventide.functions.text.log_field_array`. Plan shape: the
    splits are projected once, then a generator emits 0 or 1 row per line.
    (A ``where`` on the parsed columns would be pushed below the projection
    by Catalyst, which copies every split into the filter and parses each
    line twice.)
    """
    hour, user, site = _record_cols()
    ok = hour.isNotNull() & user.isNotNull() & site.isNotNull()
    return (_split_once(records, value, keep)
            .select(*keep, hour.alias("hour"), user.alias("user_id"), site.alias("site_id"),
                    F.explode(F.when(ok, F.array(F.lit(True)))).alias("_one"))
            .drop("_one"))


def process_logs(records: DataFrame, value: str = "value") -> DataFrame:
    """The per-batch view of parsed lines (kept distributed, not collected)."""
    return parse_log(records, value, keep=("batch_id",))


def malformed_lines(records: DataFrame, value: str = "value") -> DataFrame:
    """How many lines parse (``parsed``) and how many are dropped."""
    hour, user, site = _record_cols()
    ok = hour.isNotNull() & user.isNotNull() & site.isNotNull()
    return (_split_once(records, value, ()).groupBy(ok.alias("parsed"))
            .agg(F.count(F.lit(1)).alias("n")))


def with_day(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("day", F.substring("hour", 1, DAY_PREFIX_LEN))


def pv_by_hour(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("hour").agg(F.count(F.lit(1)).alias("pv"))


def pv_by_site_hour(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("site_id", "hour").agg(F.count(F.lit(1)).alias("pv"))


def pv_rollup(parsed: DataFrame) -> DataFrame:
    """Hourly and site-hourly PV from one scan: GROUPING SETS ((hour), (hour, site_id)).

    ``site_id`` is null on the hour-level rows.
    """
    return (parsed.groupingSets([[F.col("hour")], [F.col("hour"), F.col("site_id")]],
                                F.col("hour"), F.col("site_id"))
            .agg(F.count(F.lit(1)).alias("pv")))


def uv_members(parsed: DataFrame) -> DataFrame:
    """The per-day user set: distinct (day, user_id)."""
    return with_day(parsed).select("day", "user_id").distinct()


def uv_by_day(parsed: DataFrame) -> DataFrame:
    """Exact distinct users per day.

    Spark plans the distinct as two aggregations: first on (day, user_id),
    shuffled by both keys, then a count per day over the de-duplicated pairs.
    A day holding a third of all rows is therefore spread over many tasks.
    """
    return with_day(parsed).groupBy("day").agg(F.count_distinct("user_id").alias("uv"))


def merge_members(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """``SADD`` of a batch onto stored sets: union, then de-duplicate."""
    return stored.unionByName(batch).distinct()


# grouping_id of pv_uv_sets, bits (hour, site_id, day, user_id), 1 = rolled up
GID_PV_HOUR, GID_PV_SITE_HOUR, GID_UV_MEMBER = 0b0111, 0b0011, 0b1100


def pv_uv_sets(parsed: DataFrame) -> DataFrame:
    """Every J5 metric from one scan: GROUPING SETS ((hour), (site_id, hour),
    (day, user_id)) with counts ``n`` and ``gid``.

    (hour) and (site_id, hour) rows are page-view counts; (day, user_id) rows
    are the distinct members of each day's user set.
    """
    return (with_day(parsed)
            .groupingSets([[F.col("hour")], [F.col("site_id"), F.col("hour")],
                           [F.col("day"), F.col("user_id")]],
                          F.col("hour"), F.col("site_id"), F.col("day"), F.col("user_id"))
            .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")))


# User ids that a bitmap can hold: whole numbers in plain notation, up to ten digits.
PLAIN_ID = r"^(0|[1-9][0-9]{0,9})\z"


def uv_bitmaps(members: DataFrame) -> DataFrame:
    """The day's user sets as bitmaps: (day, bucket, members), one row per day and
    32,768 ids. Rows (day, user_id) may repeat. Two such tables merge by a bitwise
    or, so a set kept this way is never made distinct again."""
    uid = F.col("user_id").try_cast("bigint")
    return (members.where(F.col("user_id").rlike(PLAIN_ID))
            .groupBy("day", F.bitmap_bucket_number(uid).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(uid)).alias("members")))


def other_members(members: DataFrame) -> DataFrame:
    """The distinct (day, user_id) that no bitmap holds."""
    return members.where(~F.col("user_id").rlike(PLAIN_ID)).select("day", "user_id").distinct()


def merge_bitmaps(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """``SADD`` of a batch onto stored bitmaps."""
    return stored.unionByName(batch).groupBy("day", "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def uv_from_bitmaps(bitmaps: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Exact distinct users per day, from one row per day and bucket."""
    n = bitmaps.select("day", F.bitmap_count("members").alias("n"))
    if others is not None:
        n = n.unionByName(others.select("day", F.lit(1).cast("bigint").alias("n")))
    return n.groupBy("day").agg(F.sum("n").alias("uv"))


def counter_key():
    """Name of a page-view counter of :func:`pv_uv_sets`; null for a member row."""
    return (F.when(F.col("gid") == GID_PV_HOUR, F.concat(F.lit(PV_PREFIX), "hour"))
            .when(F.col("gid") == GID_PV_SITE_HOUR,
                  F.concat(F.lit(SITE_PV_PREFIX), "site_id", F.lit("_"), "hour")))


def metric_keys(parsed: DataFrame) -> DataFrame:
    """All J5 metrics as flat ``(metric_key, n)`` rows, from one scan.

    ``pv_<hour>`` and ``site_pv_<site>_<hour>`` are page-view counters,
    ``uv_<day>`` the size of the day's user set. A second, small aggregate
    keyed by the metric name passes PV counts through and counts one per
    (day, user) pair. (Filtering :func:`pv_uv_sets` into three branches would
    let Catalyst push each filter below the aggregate: three scans.)
    """
    g = pv_uv_sets(parsed)
    member = F.col("gid") == GID_UV_MEMBER
    key = F.when(member, F.concat(F.lit(UV_PREFIX), "day")).otherwise(counter_key())
    contrib = F.when(member, F.lit(1).cast("bigint")).otherwise(F.col("n"))
    return (g.select(key.alias("metric_key"), contrib.alias("c"))
            .groupBy("metric_key").agg(F.sum("c").alias("n")))
