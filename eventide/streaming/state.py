"""Durable results of update-mode streams: the state in the checkpoint as a table.

A running total or counter has no append-only form, and the file sink takes no
updates. But every committed micro-batch leaves the whole result in the state store
under the checkpoint, which Spark reads as a table (``format("statestore")``). So
such a stream writes to no sink at all (``--sink state``) and its results are read
from its checkpoint, of a stopped stream or of the last committed batch of a running
one. The read is distributed: one task per state partition.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_rows(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0) -> DataFrame:
    """(key, value, partition_id) of a stateful operator after the last committed
    batch, or after ``batch_id`` while its state is retained."""
    r = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return r.load(checkpoint)


def running_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """J4: (word, cnt) over everything the stream has consumed."""
    return state_rows(spark, checkpoint, batch_id).select(
        F.col("key.word").alias("word"), F.col("value.count").alias("cnt"))


def pv_counters(spark: SparkSession, checkpoint: str, closed: str | None = None,
                batch_id: int | None = None) -> DataFrame:
    """J5: (hour, site_id, pv). The state holds the open hours; with ``closed``, the
    output of the append-mode stream of the same checkpoint, also every hour that
    was closed since the stream began. An hour that both hold (the stream died
    between writing its files and committing the batch) is taken from the files."""
    rows = state_rows(spark, checkpoint, batch_id).select("key.hour", "key.site_id", F.col("value.count").alias("pv"))
    if closed is None:
        return rows
    try:
        done = spark.read.parquet(closed).select("hour", "site_id", "pv")
    except AnalysisException as e:  # no hour has closed yet
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return rows
    return rows.join(done.select("hour").distinct(), "hour", "left_anti").unionByName(done)


# job -> its result as a table of the checkpoint (and of the closed part's files)
SNAPSHOTS = {
    "j4": lambda spark, checkpoint, closed=None: running_totals(spark, checkpoint),
    "j5-pv": pv_counters,
}
