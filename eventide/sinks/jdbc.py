"""JDBC sinks: staged insert and merge, one-transaction commit.

The reference opens a connection per partition and issues one SELECT plus
one UPDATE/INSERT per token, without a transaction, so two partitions holding
the same word lose updates. Here:

* rows are pre-aggregated by Spark, so each key appears once;
* Spark's JDBC writer loads them into a staging table (batched inserts, one
  connection per partition, ``numPartitions`` caps concurrent connections);
* one MERGE (or the dialect's upsert) folds the staging table into the
  target inside a single transaction, together with the ledger upsert and a
  guard row, so a replayed run has no second effect.

Statements are executed through a DB-API connection supplied by the caller
(the database's own Python driver); no credentials live in this repository.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

# String keys must be VARCHAR (not the default CLOB) to be comparable in SQL.
DEFAULT_STRING_TYPE = "VARCHAR(512)"


def stage(df: DataFrame, options: dict[str, str], staging: str,
          column_types: str | None = None, **kw) -> None:
    """Replace the staging table's rows (truncate keeps its definition)."""
    w = (df.write.format("jdbc").options(**options).option("dbtable", staging)
         .option("truncate", "true").mode("overwrite"))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in kw.items():
        w = w.option(k, v)
    w.save()


def merge_sql(target: str, staging: str, keys: Sequence[str], add: Sequence[str] = (),
              replace: Sequence[str] = (), dialect: str = "ansi", where: str | None = None) -> str:
    """Fold ``staging`` into ``target``: ``add`` columns accumulate
    (``t.c = t.c + s.c``), ``replace`` columns take the staged value, missing
    keys are inserted. ``where`` picks the staged rows that take part.

    ``ansi``: ``MERGE INTO`` (Derby, PostgreSQL 15+, Oracle, SQL Server, DB2);
    ``mysql``: ``INSERT ... SELECT ... ON DUPLICATE KEY UPDATE`` (needs a
    unique key on ``keys``).
    """
    cols = [*keys, *add, *replace]
    part = f" WHERE {where}" if where else ""
    if dialect == "mysql":
        upd = [f"{c} = {target}.{c} + VALUES({c})" for c in add] + \
              [f"{c} = VALUES({c})" for c in replace]
        return (f"INSERT INTO {target} ({', '.join(cols)}) "
                f"SELECT {', '.join(cols)} FROM {staging}{part} "
                f"ON DUPLICATE KEY UPDATE {', '.join(upd)}")
    if dialect != "ansi":
        raise ValueError(f"unknown dialect {dialect}")
    if part:
        staging = f"(SELECT {', '.join(cols)} FROM {staging}{part})"
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    upd = [f"{c} = t.{c} + s.{c}" for c in add] + [f"{c} = s.{c}" for c in replace]
    return (f"MERGE INTO {target} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {', '.join(upd)} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(cols)}) "
            f"VALUES ({', '.join('s.' + c for c in cols)})")


def insert_sql(target: str, staging: str, columns: Sequence[str]) -> str:
    """Append every staged row to ``target``."""
    cols = ", ".join(columns)
    return f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging}"


def add_members_sql(target: str, staging: str, columns: Sequence[str], where: str) -> str:
    """Add the staged members to a set table; those it holds already stay as they
    are. Staged members are distinct."""
    same = " AND ".join(f"t.{c} = s.{c}" for c in columns)
    return (f"INSERT INTO {target} ({', '.join(columns)}) SELECT {', '.join('s.' + c for c in columns)} "
            f"FROM {staging} s WHERE s.{where} AND NOT EXISTS (SELECT 1 FROM {target} t WHERE {same})")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def commit_run(connect: Callable[[], object], guard: str, job: str, run_id: int,
               statements: Sequence[str], affected: list[int] | None = None) -> bool:
    """Run ``statements`` in one transaction unless (job, run_id) stands in the
    ``guard`` table, whose primary key is (job, run_id). Returns True when
    applied now.

    The guard row is inserted first: of two runs with one number, the second
    waits for the first's transaction, then fails on the key and rolls back.
    ``affected`` gets the rows that each statement changed (-1 where the driver
    does not say), once the transaction is committed.
    ``connect`` returns a DB-API 2.0 connection with autocommit off.
    """
    key = f"job = {_literal(job)} AND run_id = {int(run_id)}"
    conn = connect()
    try:
        cur = conn.cursor()
        cur.execute(f"SELECT COUNT(*) FROM {guard} WHERE {key}")
        if cur.fetchone()[0]:
            conn.rollback()
            return False
        cur.execute(f"INSERT INTO {guard} (job, run_id) VALUES ({_literal(job)}, {int(run_id)})")
        changed = []
        for s in statements:
            cur.execute(s)
            changed.append(int(getattr(cur, "rowcount", -1)))
        conn.commit()
        if affected is not None:
            affected[:] = changed
        return True
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def drop_tables(connect: Callable[[], object], tables: Sequence[str]) -> list[str]:
    """Drop a run's staging tables, each in a transaction of its own. Returns those
    that could not be dropped: the run they belong to is applied all the same."""
    left = []
    for t in tables:
        try:
            conn = connect()
            try:
                conn.cursor().execute(f"DROP TABLE {t}")
                conn.commit()
            finally:
                conn.close()
        except Exception:  # any driver's error
            left.append(t)
    return left
