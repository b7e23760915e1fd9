"""Offset bookkeeping (J5-J9): batch plan, offset ranges, the ledger.

The ledger is one row per (module, group, topic, partition) holding the next
offset to read, the table form of the reference's three offset layouts:

* flat:   key ``<topic>_<partition>``              -> offset
* hash:   key ``<group>``, field ``<topic>-<partition>`` -> offset
* module: key ``<module>:<group>:<topic>``, field ``<partition>`` -> offset
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.schemas import LEDGER

# Fixed value: default offset for a partition without a stored position.
DEFAULT_START_OFFSET = 0
# Most stored positions that are listed in a Kafka option.
MAX_POSITIONS = 1_000_000
HASH_FIELD_PATTERN = r"^(.*)-([0-9]+)\z"   # split <topic>-<partition> at the LAST '-'


def assign_batches(records: DataFrame, cap: int) -> DataFrame:
    """Rate cap as a batch plan: ``batch_id = offset div cap`` per partition."""
    return records.withColumn("batch_id", F.expr(f"`offset` div {int(cap)}"))


def batch_plan(records: DataFrame) -> DataFrame:
    return records.select("partition", "offset", "batch_id")


def offset_ranges(records: DataFrame) -> DataFrame:
    """``HasOffsetRanges.offsetRanges``: [from, until) per topic-partition and batch."""
    return records.groupBy("topic", "partition", "batch_id").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("n"))


def partitions_per_batch(records: DataFrame) -> DataFrame:
    """``rdd.partitions.size``: topic-partitions that delivered records per batch."""
    return records.groupBy("batch_id").agg(
        F.count_distinct("topic", "partition").alias("n"))


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def ledger_update(ledger: DataFrame, ranges: DataFrame, module: str, grp: str) -> DataFrame:
    """Commit processed ranges: the ledger keeps the max ``until_offset``.

    Taking the max makes the commit idempotent: re-applying a replayed batch
    cannot move a position backwards.
    """
    committed = ranges.select(F.lit(module).alias("module"), F.lit(grp).alias("grp"),
                              "topic", "partition", "until_offset")
    return (ledger.select(*LEDGER.fieldNames()).unionByName(committed)
            .groupBy("module", "grp", "topic", "partition")
            .agg(F.max("until_offset").alias("until_offset")))


def ledger_for(ledger: DataFrame, module: str | None = None, grp: str | None = None,
               topics: list[str] | None = None) -> DataFrame:
    """Module / group / topic layout: the ledger rows of one consumer."""
    cond = F.lit(True)
    if module is not None:
        cond = cond & (F.col("module") == module)
    if grp is not None:
        cond = cond & (F.col("grp") == grp)
    if topics is not None:
        cond = cond & F.col("topic").isin(list(topics))
    return ledger.where(cond)


def ledger_load_flat(partitions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Flat layout: every known partition with its position, default offset 0.

    ``partitions`` lists (topic, partition); a partition with no ledger row
    starts at 0, as in the reference.
    """
    return (partitions.join(ledger.select("topic", "partition", "until_offset"),
                            ["topic", "partition"], "left")
            .select("topic", "partition",
                    F.coalesce("until_offset", F.lit(DEFAULT_START_OFFSET).cast("bigint"))
                    .alias("from_offset")))


def ledger_keys(ledger: DataFrame) -> DataFrame:
    """The three storage layouts' keys for each ledger row (offset sinks)."""
    return ledger.select(
        F.concat_ws("_", "topic", F.col("partition").cast("string")).alias("flat_key"),
        F.concat_ws("-", "topic", F.col("partition").cast("string")).alias("hash_field"),
        F.concat_ws(":", "module", "grp", "topic").alias("module_key"),
        "until_offset")


def ledger_as_hash(ledger: DataFrame) -> DataFrame:
    """Ledger rows in the hash layout: (grp, field ``topic-partition``, value text)."""
    return ledger.select(
        "grp",
        F.concat_ws("-", "topic", F.col("partition").cast("string")).alias("field"),
        F.col("until_offset").cast("string").alias("value"))


def ledger_load_hash(hash_rows: DataFrame, grp: str) -> DataFrame:
    """Hash layout: parse the ``topic-partition`` fields of one group.

    The split is at the last ``-`` so topic names that contain ``-`` survive
    (the reference splits at every ``-`` and fails on them). A non-numeric
    stored offset fails the load, as the reference's ``toLong`` does.
    """
    f = F.col("field")
    return (hash_rows.where(F.col("grp") == grp)
            .select(F.regexp_extract(f, HASH_FIELD_PATTERN, 1).alias("topic"),
                    F.regexp_extract(f, HASH_FIELD_PATTERN, 2).cast("int").alias("partition"),
                    F.col("value").cast("bigint").alias("from_offset")))


def resume_scan(records: DataFrame, positions: DataFrame) -> DataFrame:
    """Read each partition from its stored position (``Assign`` + fromOffsets).

    ``positions`` is (topic, partition, until_offset) with at most one row per
    topic-partition; a partition without a row is read from offset 0, so an
    empty ledger is the first-run case (all records). The position table is
    one row per topic-partition: as a stored table (:func:`eventide.session.stored`)
    its size is known and the planner broadcasts it under its own threshold;
    no job runs while the plan is built here.
    """
    pos = positions.select("topic", "partition", "until_offset")
    return (records.join(pos, ["topic", "partition"], "left")
            .where(F.col("offset") >= F.coalesce("until_offset", F.lit(DEFAULT_START_OFFSET)))
            .drop("until_offset"))


def start_positions(records: DataFrame, policy: str, log_end_batch: int | None = None) -> DataFrame:
    """Start position per partition for ``auto.offset.reset``.

    * earliest: nothing skipped (empty position table);
    * latest: skip what the log held when the consumer started, i.e. up to
      the end of batch ``log_end_batch``;
    * none: no default; callers must pass a ledger (see ``require_positions``).
    """
    if policy == "earliest":
        return records.sparkSession.createDataFrame(
            [], "topic string, partition int, until_offset bigint")
    if policy == "latest":
        if log_end_batch is None:
            raise ValueError("latest needs the log end at start (log_end_batch)")
        return (records.where(F.col("batch_id") <= log_end_batch)
                .groupBy("topic", "partition")
                .agg((F.max("offset") + 1).alias("until_offset")))
    if policy == "none":
        raise ValueError("auto.offset.reset=none: a stored position is required")
    raise ValueError(f"unknown start policy: {policy}")


def require_positions(partitions: DataFrame, positions: DataFrame) -> DataFrame:
    """``auto.offset.reset=none``: every partition must have a stored position.

    Returns the positions when complete; raises (like the consumer's
    NoOffsetForPartitionException) naming how many partitions lack one.
    """
    missing = partitions.select("topic", "partition").join(
        positions.select("topic", "partition"), ["topic", "partition"], "left_anti").count()
    if missing:
        raise ValueError(f"auto.offset.reset=none: {missing} partition(s) have no stored position")
    return positions
