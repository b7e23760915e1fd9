"""Schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T

# One consumed record: where it came from (topic, partition, offset), which
# micro-batch consumed it, its event time and its key/value text.
ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# Committed consumer position: the next offset to read per partition.
LEDGER = T.StructType([
    T.StructField("module", T.StringType(), False),
    T.StructField("grp", T.StringType(), False),
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("until_offset", T.LongType(), False),
])

# Half-open offset range [from_offset, until_offset) consumed by one batch.
OFFSET_RANGE = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("from_offset", T.LongType(), True),
    T.StructField("until_offset", T.LongType(), True),
    T.StructField("n", T.LongType(), False),
])

PARSED_LOG = T.StructType([
    T.StructField("hour", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("site_id", T.StringType(), False),
])

WORD_TOTAL = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("cnt", T.LongType(), False),
])

ALERT_ROW = T.StructType([
    T.StructField("data", T.StringType(), True),
    T.StructField("result", T.StringType(), True),
])

# Sets of daily users: a bitmap per 32,768 ids, and the ids no bitmap holds.
UV_BITMAP = T.StructType([
    T.StructField("day", T.StringType(), True),
    T.StructField("bucket", T.LongType(), True),
    T.StructField("members", T.BinaryType(), True),
])

UV_MEMBER = T.StructType([
    T.StructField("day", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
])
