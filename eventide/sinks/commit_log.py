"""Replay-safe commit of results and offsets together, in the shared folder.

The reference commits a batch's metrics and its offsets in one store
transaction, so a crash replays the batch cleanly. Here the same guarantee is
built from plain Spark writes under ``spark.checkpoint.dir``:

    <root>/<table>/commit_id=<c>/part-*.parquet     results of commit c
    <root>/_ledger/commit_id=<c>/part-*.parquet     positions after commit c
    <root>/_commits/commit_id=<c>/part-*.parquet    marker (one row)

The ledger is the exactly-once mechanism, as for a Kafka consumer: a record
is pending when its offset is at or beyond its own partition's committed
position, however unevenly partitions advance. A commit writes each result
and the new positions into the next ``commit_id`` directory (overwrite, so a
retried commit replaces a half-written one) and only then the marker.
Readers semi-join with the markers, so staged but unmarked output is
invisible: a failure before the marker leaves results and positions
unchanged, the retry reuses the same commit id, and committed records are
never pending again.

Results are distributed jobs; only the commit id (one number) and the
position table (one row per topic-partition) reach the driver side.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from eventide.operators.offsets import ledger_update, resume_scan
from eventide.schemas import LEDGER
from eventide.session import checkpoint_root

MARKERS = "_commits"
LEDGER_TABLE = "_ledger"
MARKER_SCHEMA = T.StructType([T.StructField("attempt", T.StringType(), False),
                              T.StructField("commit_id", T.LongType(), False)])


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


class CommitLog:
    """One consumer's (module, group) committed results under ``root``
    (default ``<spark.checkpoint.dir>/commits/<job>``, a shared folder that
    outlives executors and restarts). One writer per log, as one consumer
    per group: commit ids are taken as the last committed id + 1."""

    def __init__(self, spark: SparkSession, root: str | None = None, job: str | None = None,
                 module: str = "default", grp: str = "default"):
        self.spark = spark
        shared = checkpoint_root(spark)  # also where checkpoint() writes
        if root is None:
            if not job:
                raise ValueError("give a root folder or a job name")
            root = os.path.join(shared, "commits", job)
        self.root = root
        self.module, self.grp = module, grp

    # ------------------------------------------------------------ reading
    def _read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        path = os.path.join(self.root, name)
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if schema is None or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def markers(self) -> DataFrame:
        return self._read(MARKERS, MARKER_SCHEMA)

    def table(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Committed rows of ``name`` (with their commit_id)."""
        full = None if schema is None else T.StructType(
            schema.fields + [T.StructField("commit_id", T.LongType(), False), T.StructField("attempt", T.StringType(), False)])
        rows = self._read(name, full)
        return rows.join(self.markers().select("commit_id", "attempt"), ["commit_id", "attempt"], "left_semi").drop(
            "attempt")

    def last_commit(self) -> int | None:
        return self.markers().agg(F.max("commit_id")).first()[0]

    def latest_path(self, name: str) -> str | None:
        """Folder of the newest committed version of a full-state table."""
        last = self.markers().orderBy(F.desc("commit_id")).first()
        return last and os.path.join(self.root, name, f"commit_id={last['commit_id']}", f"attempt={last['attempt']}")

    def latest(self, name: str, schema: T.StructType) -> DataFrame:
        """Rows of the newest committed version of a full-state table. Only
        that version's directory is listed, however many commits exist."""
        path = self.latest_path(name)
        if path is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def positions(self) -> DataFrame:
        """Committed positions: next offset to read per topic-partition.

        Every commit writes the complete updated ledger, so the newest
        committed version is enough (one partition-pruned directory, one row
        per topic-partition, however many commits there were).
        """
        return self.latest(LEDGER_TABLE, LEDGER).where(
            (F.col("module") == self.module) & (F.col("grp") == self.grp))

    # ------------------------------------------------------------ writing
    def pending(self, records: DataFrame) -> DataFrame:
        """Records at or beyond their partition's committed position."""
        return resume_scan(records, self.positions())

    def commit(self, pending: DataFrame, results: dict[str, DataFrame],
               writers: dict[str, Callable[[DataFrame, str], None]] | None = None) -> int | None:
        """Commit ``results`` (computed from ``pending``) together with the
        positions after ``pending``. Returns the commit id, or None when
        nothing was pending.

        ``pending`` must be a stable snapshot (a file source fixes its file
        list when the DataFrame is created; stage other sources first), so
        results and positions describe the same records. ``writers`` names
        results with a layout of their own.
        """
        ranges = pending.groupBy("topic", "partition").agg(
            (F.max("offset") + 1).alias("until_offset")).checkpoint()
        if ranges.isEmpty():
            return None
        c, attempt = (self.last_commit() or 0) + 1, uuid.uuid4().hex
        at = os.path.join(f"commit_id={c}", f"attempt={attempt}")
        for name, df in results.items():
            (writers or {}).get(name, write_parquet)(df, os.path.join(self.root, name, at))
        ledger = ledger_update(self.positions(), ranges, self.module, self.grp)
        write_parquet(ledger, os.path.join(self.root, LEDGER_TABLE, at))
        self._mark(c, attempt)
        return c

    def _mark(self, c: int, attempt: str) -> None:
        """The marker is one tiny file that names the attempt whose results and
        positions count: it appears atomically at job commit. A second writer that
        took the same id wrote under an attempt of its own and fails here; a crash
        before this leaves files that no marker names."""
        (self.spark.createDataFrame([(attempt,)], "attempt string").coalesce(1)
         .write.mode("errorifexists").parquet(os.path.join(self.root, MARKERS, f"commit_id={c}")))
