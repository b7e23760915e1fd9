"""Relational reads: JDBC tables, parameterised queries, scalar queries.

The reference's JDBC helper runs SQL on one connection in the driver and
returns rows as maps. Here a relation is a DataFrame: a JDBC table is read in
parallel slices (``partitionColumn`` / ``lowerBound`` / ``upperBound`` /
``numPartitions``), filters and projections are pushed into the database's
SQL, and parameters are bound by Spark SQL, never spliced into text.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession

# Connection settings come from the session or the environment; nothing is
# stored in the repository.
JDBC_SETTING_KEYS = ("url", "user", "password", "driver")


def jdbc_options(spark: SparkSession, prefix: str = "eventide.jdbc.",
                 env_prefix: str = "EVENTIDE_JDBC_") -> dict[str, str]:
    """``db.url/user/password/driver`` from ``spark.conf`` (``eventide.jdbc.*``)
    or environment variables (``EVENTIDE_JDBC_URL`` ...)."""
    out = {}
    for k in JDBC_SETTING_KEYS:
        v = spark.conf.get(prefix + k, None) or os.environ.get(env_prefix + k.upper())
        if v:
            out[k] = v
    return out


def jdbc_table(spark: SparkSession, options: dict[str, str], table: str | None = None,
               query: str | None = None, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A JDBC relation read in ``num_partitions`` parallel range slices.

    Without a partition column the read is a single task: fine for small
    lookup tables only. ``query`` and ``partition_column`` cannot be combined
    (a Spark restriction); wrap the query as ``(...) AS t`` in ``table``.
    """
    r = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size)
    if query is not None:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper)
             .option("numPartitions", num_partitions))
    return r.load()


def jdbc_partitioned(spark: SparkSession, options: dict[str, str], table: str, column: str,
                     num_partitions: int) -> DataFrame:
    """Read a large JDBC table in ``num_partitions`` parallel range slices of
    ``column`` (numeric, date or timestamp). The bounds come from one
    ``min``/``max`` query that runs inside the database; only that one row
    reaches the driver. Rows outside the bounds are still read (Spark's
    first and last slices are open-ended)."""
    lo, hi = jdbc_table(spark, options,
                        query=f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table}").first()
    if lo is None:  # empty table: a single slice
        return jdbc_table(spark, options, table=table)
    return jdbc_table(spark, options, table=table, partition_column=column,
                      lower=lo, upper=hi, num_partitions=num_partitions)


def slice_predicates(column: str, cuts: list) -> list[str]:
    """SQL conditions that part a column's values at ``cuts`` (ascending); together
    they hold every row once, nulls with the first."""
    if not cuts:
        return ["1 = 1"]
    def text(v):  # noqa: E306
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    inner = [f"{column} >= {text(a)} AND {column} < {text(b)}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {text(cuts[0])} OR {column} IS NULL", *inner, f"{column} >= {text(cuts[-1])}"]


def quantile_cuts(values: DataFrame, column: str, num_partitions: int, error: float = 0.1) -> list:
    """Distinct cut points that part a numeric column into slices of about equal
    rows, from a distributed quantile sketch over all its values; a slice is at most
    ``error`` of its share off, but for a value that more rows hold than a slice."""
    probs = [i / num_partitions for i in range(1, num_partitions)]
    exact = values.select(column).where(f"{column} is not null")
    return sorted(set(exact.approxQuantile(column, probs, error / (2 * num_partitions)))) if probs else []


def jdbc_balanced(spark: SparkSession, options: dict[str, str], table: str, column: str, num_partitions: int,
                  read=jdbc_partitioned) -> DataFrame:
    """Read a large JDBC table in slices of about equal rows, however skewed the
    values of ``column`` (numeric) are: equal ranges would give one slice nearly all
    rows. The column alone is read first, in equal ranges, to find the cuts."""
    cuts = quantile_cuts(read(spark, options, f"(SELECT {column} FROM {table}) q", column, num_partitions),
                         column, num_partitions)
    properties = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], table, predicates=slice_predicates(column, cuts), properties=properties)


def relation(spark: SparkSession, name: str, sf_dir: str | None = None,
             jdbc: dict[str, str] | None = None, **jdbc_kw) -> DataFrame:
    """A named relation: a JDBC table when options are given, else parquet."""
    if jdbc:
        return jdbc_table(spark, jdbc, table=name, **jdbc_kw)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def param_query(spark: SparkSession, sql: str, args: dict | list, **tables: DataFrame) -> DataFrame:
    """``query(sql, params*)``: named/positional markers bound by Spark SQL.

    ``{name}`` placeholders in ``sql`` are DataFrames passed as keywords; the
    predicates still push down into the scan (parquet or JDBC).
    """
    return spark.sql(sql, args=args, **tables)


def scalar_query(df: DataFrame, expr: Column, name: str = "v") -> DataFrame:
    """``getSingle``: a one-row, one-column aggregate (null on empty input)."""
    return df.agg(expr.alias(name))
