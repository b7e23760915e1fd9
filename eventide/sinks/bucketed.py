"""Stored per-key state as bucketed, sorted files.

Rows are hashed by their key into a fixed number of buckets, one sorted file each. A
merge of new rows joins the stored buckets where they lie: only the new rows are
shuffled, and what is written back keeps the buckets. The table's definition is made
anew from the path in each session, so nothing but the files need persist.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """``df`` as ``buckets`` sorted files under ``path``, which must not exist. A
    table partitioned by ``key`` into as many partitions is not shuffled; any other
    is first, so that each bucket is one file."""
    spark = df.sparkSession
    (df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
     .mode("errorifexists").saveAsTable(_name(path)))
    spark.sql(f"DROP TABLE {_name(path)}")  # external: the files stay


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The files of :func:`write_bucketed` with their layout known to the planner."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{where}'")
    return spark.table(_name(path))
