"""Bounded runs of J3, J4 and J5 that write to a database.

Results, positions and a guard row go into the database in one transaction:
either all of a run is there or nothing of it. Spark loads the run's rows into
a staging table of its own, then one connection folds them into the target.
The guard table's primary key (job, run) lets one of two runs with the same
number through; the other rolls back. Positions are read after the run number,
so a run that saw old positions also holds a number that is taken.

``connect`` returns a DB-API connection with autocommit off; the tables of
:func:`table_sql` must exist. No live database was used in tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators import logs, offsets, tokens, values, windows
from eventide.session import stored
from eventide.sinks import jdbc
from eventide.sources import relations

GUARD, LEDGER = "applied_runs", "consumer_ledger"
# J3's position is the start of the next window to write, in epoch seconds.
WINDOW_TOPIC = "window_start"
CONNECTIONS = 8
# Targets of J5 (counters by metric key, set members) and of J3's incremental view
# (sums and counts per bucket, one alert row per window).
COUNTERS, MEMBERS = "pv_counters", "uv_members"
BUCKETS, WINDOWS = "alert_buckets", "alert_windows"


def table_sql(totals: str = "wordcount", alerts: str = "alerts") -> list[str]:
    """``CREATE TABLE`` statements with the unique keys that the runs need."""
    return [
        f"CREATE TABLE {GUARD} (job VARCHAR(128) NOT NULL, run_id BIGINT NOT NULL, PRIMARY KEY (job, run_id))",
        f"CREATE TABLE {LEDGER} (module VARCHAR(128) NOT NULL, grp VARCHAR(128) NOT NULL, "
        "topic VARCHAR(256) NOT NULL, partition_id INTEGER NOT NULL, until_offset BIGINT NOT NULL, "
        "PRIMARY KEY (module, grp, topic, partition_id))",
        f"CREATE TABLE {totals} (word VARCHAR(512) NOT NULL PRIMARY KEY, cnt BIGINT NOT NULL)",
        f"CREATE TABLE {alerts} (data VARCHAR(512), result VARCHAR(8))",
        f"CREATE TABLE {COUNTERS} (metric_key VARCHAR(512) NOT NULL PRIMARY KEY, n BIGINT NOT NULL)",
        f"CREATE TABLE {MEMBERS} (day_key VARCHAR(32) NOT NULL, user_id VARCHAR(512) NOT NULL, "
        "PRIMARY KEY (day_key, user_id))",
        f"CREATE TABLE {BUCKETS} (bucket_start BIGINT NOT NULL, day_key VARCHAR(32) NOT NULL, "
        "total BIGINT NOT NULL, readings BIGINT NOT NULL, PRIMARY KEY (bucket_start, day_key))",
        f"CREATE TABLE {WINDOWS} (window_start BIGINT NOT NULL PRIMARY KEY, data VARCHAR(512), result VARCHAR(8))",
    ]


class Run:
    """One bounded run: its number, and the positions it starts from."""

    def __init__(self, spark: SparkSession, options: dict[str, str], job: str, module: str, grp: str,
                 connections: int = CONNECTIONS):
        self.spark, self.options, self.job = spark, options, job
        self.module, self.grp, self.connections = module, grp, connections
        applied = relations.jdbc_table(spark, options, table=GUARD).where(F.col("job") == job)
        self.run_id = (applied.agg(F.max("run_id")).first()[0] or 0) + 1
        self.attempt = uuid.uuid4().hex[:8]
        self.affected: list[int] = []   # rows changed per fold, of a committed run
        self.left: list[str] = []       # staging tables that could not be dropped
        ledger = relations.jdbc_table(spark, options, table=LEDGER)
        self.positions = ledger.where((F.col("module") == module) & (F.col("grp") == grp)).select(
            "module", "grp", "topic", F.col("partition_id").alias("partition"), "until_offset")

    def staging(self, table: str) -> str:
        """Two runs that took one number still stage apart."""
        return f"{table}_{self.run_id}_{self.attempt}"

    def commit(self, rows: DataFrame, target: str, fold: Callable[[str], str | list[str]], ends: DataFrame,
               connect: Callable[[], object], dialect: str, column_types: str | None = None,
               more: tuple[tuple[DataFrame, str, Callable[[str], str], str | None], ...] = ()) -> bool:
        """Stage ``rows`` and the new positions ``ends`` (topic, partition,
        until_offset), then fold all in under the guard. ``fold`` gives one or
        several statements over the staged rows; ``more`` lists further (rows,
        target, fold, column types) of the same transaction."""
        ledger = ends.select(F.lit(self.module).alias("module"), F.lit(self.grp).alias("grp"), "topic",
                             F.col("partition").alias("partition_id"), "until_offset")
        staged, statements = [], []
        for df, name, f, types in ((rows, target, fold, column_types), *more):
            at = self.staging(name)
            jdbc.stage(df, self.options, at, types, numPartitions=self.connections)
            got = f(at)
            statements += [got] if isinstance(got, str) else got
            staged.append(at)
        ledger_at = self.staging(LEDGER)
        jdbc.stage(ledger, self.options, ledger_at, "module VARCHAR(128), grp VARCHAR(128), topic VARCHAR(256)",
                   numPartitions=1)
        statements.append(jdbc.merge_sql(LEDGER, ledger_at, ["module", "grp", "topic", "partition_id"],
                                         replace=["until_offset"], dialect=dialect))
        done = jdbc.commit_run(connect, GUARD, self.job, self.run_id, statements, self.affected)
        # tables of a crashed run stay, under its own names
        self.left = jdbc.drop_tables(connect, [*staged, ledger_at])
        return done

    def pending(self, records: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """(records past the stored positions, their new positions); None if there
        are none. ``records`` must be bounded with fixed ends (a file list or pinned
        Kafka offsets)."""
        due = offsets.resume_scan(records, self.positions)
        ends = stored(due.groupBy("topic", "partition").agg(
            (F.max("offset") + 1).alias("until_offset")), "jdbc-ends")
        return None if ends.isEmpty() else (due, ends)


def write_totals(run: Run, records: DataFrame, connect: Callable[[], object], table: str = "wordcount",
                 dialect: str = "ansi") -> bool:
    """J4: adds the word counts of every record past the stored positions.
    False when nothing was pending or another run took this number. A word
    longer than the key column fails the run; nothing is cut.

    Only counts and positions are stored on the way."""
    due = run.pending(records)
    if due is None:
        return False
    pending, ends = due
    counts = tokens.running_total(tokens.tokenize(pending))
    return run.commit(counts, table, lambda s: jdbc.merge_sql(table, s, ["word"], add=["cnt"], dialect=dialect),
                      ends, connect, dialect, f"word {jdbc.DEFAULT_STRING_TYPE}")


def write_alerts(run: Run, records: DataFrame, connect: Callable[[], object], table: str = "alerts",
                 dialect: str = "ansi", length: int = windows.WINDOW_SECONDS,
                 slide: int = windows.SLIDE_SECONDS) -> bool:
    """J3: inserts one row per window that has ended by the newest record and
    was not written before. A window is written once; records that come for it
    later change nothing."""
    newest = records.agg(F.unix_seconds(F.max("ts").cast("timestamp"))).first()[0]
    if newest is None:
        return False
    start = run.positions.where(F.col("topic") == WINDOW_TOPIC).agg(F.max("until_offset")).first()[0]
    upto = (newest - length) // slide * slide + slide   # first window that may still grow
    if start is not None and upto <= start:
        return False
    due = records if start is None else records.where(F.col("ts") >= F.timestamp_seconds(F.lit(start)))
    means = windows.sliding_mean(values.readings(due), length, slide)
    at = F.unix_seconds(F.col("window_start").cast("timestamp"))
    means = means.where((at < upto) if start is None else (at < upto) & (at >= start))
    rows = windows.alert_rows(means)
    ends = run.spark.range(1).select(F.lit(WINDOW_TOPIC).alias("topic"), F.lit(0).alias("partition"),
                                     F.lit(upto).cast("long").alias("until_offset"))
    return run.commit(rows, table, lambda s: jdbc.insert_sql(table, s, ["data", "result"]), ends, connect, dialect,
                      "data VARCHAR(512), result VARCHAR(8)")


def write_pv_uv(run: Run, records: DataFrame, connect: Callable[[], object], table: str = COUNTERS,
                dialect: str = "ansi") -> bool:
    """J5: adds the page views of every log line past the stored positions to the
    counters, its users to the set of their day, and moves the positions, all in one
    transaction. False when nothing was pending or another run took this number.

    One aggregate over one parse of the lines gives both kinds of rows, staged in
    one table: counters with a ``metric_key``, members without. A day's unique users
    are its rows in ``uv_members``."""
    due = run.pending(records)
    if due is None:
        return False
    pending, ends = due
    rows = logs.pv_uv_sets(logs.parse_log(pending))
    member = F.col("gid") == logs.GID_UV_MEMBER
    rows = rows.select(logs.counter_key().alias("metric_key"), F.when(~member, F.col("n")).alias("n"),
                       F.when(member, F.col("day")).alias("day_key"),
                       F.when(member, F.col("user_id")).alias("user_id"))

    def fold(at: str) -> list[str]:
        return [jdbc.merge_sql(table, at, ["metric_key"], add=["n"], dialect=dialect, where="metric_key IS NOT NULL"),
                jdbc.add_members_sql(MEMBERS, at, ["day_key", "user_id"], "metric_key IS NULL")]
    return run.commit(rows, table, fold, ends, connect, dialect,
                      f"metric_key {jdbc.DEFAULT_STRING_TYPE}, day_key VARCHAR(32), user_id {jdbc.DEFAULT_STRING_TYPE}")


def write_alert_view(run: Run, records: DataFrame, connect: Callable[[], object], table: str = WINDOWS,
                     dialect: str = "ansi", length: int = windows.WINDOW_SECONDS,
                     slide: int = windows.SLIDE_SECONDS) -> bool:
    """J3 as an incremental view: one alert row per window that any record fell in
    so far. The sums and counts per bucket of all earlier runs are kept in the
    database; the records past the stored positions add to them, and every window
    that holds a changed bucket is computed again and replaces its row. Records that
    come late, or runs that stop anywhere, end in the rows of one batch over all.

    Buckets outside the changed ones' time span, a window's length wider on both
    sides, are not read. Integer sums make the order of runs irrelevant."""
    due = run.pending(records)
    if due is None:
        return False
    pending, ends = due
    seconds = F.unix_seconds(F.col("bucket").cast("timestamp"))
    delta = stored(windows.bucket_sums(values.readings(pending), length, slide).withColumn(
        "bucket", F.col("bucket").cast("timestamp")), "jdbc-buckets")
    lo, hi = delta.agg(F.min(seconds), F.max(seconds)).first()
    kept = relations.jdbc_table(run.spark, run.options, table=BUCKETS).where(
        F.col("bucket_start").between(lo - length, hi + length)).select(
        F.timestamp_seconds("bucket_start").alias("bucket"), F.col("day_key").alias("day"),
        F.col("total").alias("s"), F.col("readings").alias("c"))
    rows = windows.changed_windows(kept, delta, length, slide).select(
        F.unix_seconds(F.col("window_start").cast("timestamp")).alias("window_start"), "data",
        F.col("result").cast("string").alias("result"))
    sums = delta.select(seconds.alias("bucket_start"), F.col("day").alias("day_key"), F.col("s").alias("total"),
                        F.col("c").alias("readings"))
    return run.commit(
        rows, table, lambda at: jdbc.merge_sql(table, at, ["window_start"], replace=["data", "result"], dialect=dialect),
        ends, connect, dialect, "data VARCHAR(512), result VARCHAR(8)",
        more=((sums, BUCKETS, lambda at: jdbc.merge_sql(
            BUCKETS, at, ["bucket_start", "day_key"], add=["total", "readings"], dialect=dialect),
            "day_key VARCHAR(32)"),))
