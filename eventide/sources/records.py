"""The record envelope over the given tables.

A Kafka topic is a set of partitions, each an ordered log of
``(offset, key, value)``. The replay envelope lays the driver's tables out the
same way with pure column arithmetic (no shuffle, no sort, no window):

* partition = id % n_partitions, offset = id div n_partitions, so offsets are
  dense and ordered within each partition;
* batch_id = offset div cap: the micro-batch that consumes the record under a
  per-partition rate cap (the reference caps at 500 records per partition per
  batch);
* key / value are the text payloads the reference jobs parse.

Because it is a projection, Catalyst prunes unused columns down to the
parquet scan and pushes filters on id/ts through it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.text import DATE_TEXT_FORMAT

# Fixed values of the replay layout (match the reference's settings).
DEFAULT_PARTITIONS = 4
EVENT_BATCH_CAP = 500        # 100 records/s/partition x 5 s batches
DOCUMENT_BATCH_CAP = 50
LOG_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
MALFORMED_EVERY = 97         # of the log_with_bad payload: every 97th line is unparseable


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _envelope(topic: str, id_name: str, ts: Column, key: Column, value: Column,
              n_partitions: int, cap: int, extra: list[Column]) -> list[Column]:
    # integer division stays in bigint (no double round trip for large ids)
    offset = F.expr(f"`{id_name}` div {int(n_partitions)}")
    return [
        F.lit(topic).alias("topic"),
        F.pmod(F.col(id_name), F.lit(n_partitions)).cast("int").alias("partition"),
        offset.alias("offset"),
        F.expr(f"(`{id_name}` div {int(n_partitions)}) div {int(cap)}").alias("batch_id"),
        ts.alias("ts"),
        key.alias("key"),
        value.alias("value"),
        *extra,
    ]


def event_payload(kind: str) -> Column:
    """Text payload of an event record.

    * ``reading``: integer text of the measurement (truncated toward zero)
    * ``log``: ``<time>|~|<ip>|~|/e?uid=<user>&sid=<type>``
    * ``log_with_bad``: the same, but every 97th line has a uri without
      parameters (input of the malformed-line report only)
    * ``fields``: ``event_id||event_type||user_id``
    * ``type``: the event type alone
    * ``date``: the record key (date text)
    """
    if kind == "reading":
        return F.col("value").cast("int").cast("string")
    if kind in ("log", "log_with_bad"):
        uri = F.concat(F.lit("/e?uid="), F.col("user_id").cast("string"),
                       F.lit("&sid="), F.col("event_type"))
        if kind == "log_with_bad":
            uri = F.when(F.col("event_id") % MALFORMED_EVERY == 0, F.lit("/bad")).otherwise(uri)
        return F.concat_ws("|~|", F.date_format("ts", LOG_TIME_FORMAT), F.lit("0.0.0.0"), uri)
    if kind == "fields":
        return F.concat_ws("||", F.col("event_id").cast("string"), F.col("event_type"),
                           F.col("user_id").cast("string"))
    if kind == "type":
        return F.col("event_type")
    if kind == "date":
        return F.date_format("ts", DATE_TEXT_FORMAT)
    raise ValueError(f"unknown payload kind: {kind}")


def event_records(events: DataFrame, payload: str = "reading", topic: str = "events",
                  n_partitions: int = DEFAULT_PARTITIONS, cap: int = EVENT_BATCH_CAP,
                  keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Envelope over ``events``; ``keep`` carries source columns along."""
    return events.select(*_envelope(
        topic, "event_id", F.col("ts"),
        F.date_format("ts", DATE_TEXT_FORMAT), event_payload(payload),
        n_partitions, cap, [F.col(c) for c in keep]))


def document_records(documents: DataFrame, topic: str = "documents",
                     n_partitions: int = DEFAULT_PARTITIONS, cap: int = DOCUMENT_BATCH_CAP,
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Envelope over ``documents``: the value is the whole text."""
    return documents.select(*_envelope(
        topic, "doc_id", F.lit(None).cast("timestamp_ntz"),
        F.lit(None).cast("string"), F.col("text"),
        n_partitions, cap, [F.col(c) for c in keep]))


def events_envelope(spark: SparkSession, sf_dir: str, payload: str = "reading", **kw) -> DataFrame:
    return event_records(read_table(spark, sf_dir, "events"), payload, **kw)


def documents_envelope(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Documents as records, one task per file split: a table of few row
    groups is tokenized by few tasks, larger ones by their splits
    (``spark.sql.files.maxPartitionBytes``). Nothing is shuffled first."""
    return document_records(read_table(spark, sf_dir, "documents"), **kw)
