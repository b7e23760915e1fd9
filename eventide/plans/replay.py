"""Consumer state derived from the record log itself.

The registered queries need a stored ledger to resume from. Instead of a
hand-written table, it is the state that consumers leave behind after
processing part of the log: each consumer (module, group) is assigned some
partitions and has committed all batches up to a point. It is computed from
the records with one aggregation, so its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed replay scenario: (module, group, assigned partitions, last committed batch).
# Partition 3 has no m1 position (it starts at 0); m2/g1 owns only partition 3.
CONSUMERS = (
    ("m1", "g1", (0, 1, 2), 1),
    ("m2", "g1", (3,), 0),
)


def consumer_ledger(records: DataFrame, consumers=CONSUMERS) -> DataFrame:
    """Ledger rows (module, grp, topic, partition, until_offset) after the
    consumers' commits: ``max(offset) + 1`` of the committed records.

    One scan: each record is tagged with the consumers that committed it.
    """
    tags = F.array(*[
        F.when(F.col("partition").isin(list(parts)) & (F.col("batch_id") <= through),
               F.struct(F.lit(m).alias("module"), F.lit(g).alias("grp")))
        for m, g, parts, through in consumers])
    tagged = (records.select("topic", "partition", "offset", F.explode(tags).alias("c"))
              .where(F.col("c").isNotNull()))
    return (tagged.groupBy(F.col("c.module").alias("module"), F.col("c.grp").alias("grp"),
                           "topic", "partition")
            .agg((F.max("offset") + 1).alias("until_offset")))


def newest_batch(records: DataFrame):
    """Scalar subquery: the newest batch id in the log."""
    return records.select(F.max("batch_id")).scalar()


def with_newest(records: DataFrame) -> DataFrame:
    """Adds ``newest``: whether a record is of the newest batch."""
    return records.withColumn("newest", F.col("batch_id") == newest_batch(records))
