"""Start one of the nine jobs as a streaming query.

    python -m eventide.plans.run j5-uv --source kafka --bootstrap host:9092 --topics test \\
        --sink parquet --out /shared/out/uv --name uv-daily
    python -m eventide.plans.run j1 --source replay --replay /shared/log --available-now \\
        --sink parquet --out /shared/out/wc --name wc

The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``, so a
restart with the same name resumes where the last run committed.

    python -m eventide.plans.run j4 --source kafka --bootstrap host:9092 --topics test \
        --partitions 4 --catch-up --name word-totals --module m1 --group g1

``--catch-up`` instead reads everything after the committed positions once
(a bounded Kafka read) and commits results and new positions together.

    python -m eventide.plans.run j4 --source kafka --bootstrap host:9092 --topics test \
        --partitions 4 --sink jdbc --table wordcount --connect my_db:connect --name word-totals

``--sink jdbc`` (j3, j4, j5) is such a bounded run into a database; its settings
come from ``eventide.jdbc.*`` or ``EVENTIDE_JDBC_*``.
"""

from __future__ import annotations

import argparse
import importlib
import inspect
import os
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from eventide.operators import offsets, tokens, values
from eventide.plans import jdbc_jobs
from eventide.plans import jobs as pj
from eventide.schemas import LEDGER
from eventide.session import checkpoint_root
from eventide.sinks.commit_log import CommitLog
from eventide.sources.relations import jdbc_options
from eventide.streaming import jobs as sj
from eventide.streaming.state import SNAPSHOTS
from eventide.streaming.sources import (kafka_batch_records, kafka_options, kafka_records,
                                        max_offsets_per_trigger, replay_records, starting_offsets, starting_times)

# Fixed value: the reference's per-partition rate cap, records per batch.
DEFAULT_CAP = 500


def _j2(records: DataFrame):
    """J2: (word, 1) per token, appended as records arrive."""
    return tokens.token_pairs(tokens.tokenize(records)), "append"


# job name -> streaming form (records -> (DataFrame, output mode))
JOBS = {
    "j1": sj.word_count_per_batch,
    "j2": _j2,
    "j3": sj.windowed_alert,
    "j4": sj.running_totals,
    "j5-pv": sj.pv_counters,
    "j5-uv": sj.uv_by_day,
    "j6": sj.word_count_per_batch,   # sorted per batch by the reader: sort needs complete mode
    "j7": sj.value_count_per_batch,
    "j8": sj.three_fields,
    "j9": sj.offset_report,
}


# job name -> outputs committed by a catch-up run (results + positions
# together). Outputs are additive over commits; J3 windows span commits, so
# J3 runs as a stream only.
CATCH_UP = {
    "j1": {"word_counts": pj.j1_word_count},
    "j2": {"pairs": pj.j2_token_pairs},
    "j6": {"word_counts": pj.j6_sorted_word_count},
    "j7": {"value_counts": values.value_count_per_batch},
    "j8": {"fields": values.split_three_fields, "sizes": values.batch_size},
    "j9": {"ranges": offsets.offset_ranges, "partitions": offsets.partitions_per_batch},
}


# job name -> bounded run into a database (one transaction per run)
JDBC_JOBS = {"j3": jdbc_jobs.write_alert_view, "j4": jdbc_jobs.write_totals,
             "j5-pv": jdbc_jobs.write_pv_uv, "j5-uv": jdbc_jobs.write_pv_uv}


def _topic_partitions(args) -> dict[str, int]:
    return {t: args.partitions for t in args.topics.split(",")}


def _kafka_opts(args, starting: str | None = None) -> dict[str, str]:
    assign = {t: list(range(n)) for t, n in _topic_partitions(args).items()} if args.assign else None
    return kafka_options(args.bootstrap, topics=None if assign else args.topics.split(","), assign=assign,
                         starting=starting or args.starting,
                         starting_times=starting_times(_topic_partitions(args), args.starting_timestamp)
                         if getattr(args, "starting_timestamp", None) is not None else None,
                         max_offsets=max_offsets_per_trigger(args.rate, args.partitions,
                                                             args.trigger_seconds)
                         if args.rate else None,
                         max_poll_records=args.max_poll_records)


def catch_up(spark, args) -> int | None:
    """Process everything after the committed positions once and commit the
    results together with the new positions (exactly once per record)."""
    log = CommitLog(spark, root=args.checkpoint, job=args.name, module=args.module, grp=args.group)
    if args.source == "kafka":
        parts = _topic_partitions(args)
        records = kafka_batch_records(spark, _kafka_opts(args), log.positions(), parts, args.cap)
    else:
        records = spark.read.parquet(args.replay)
    if args.starting == "none":  # no default: every partition needs a stored position
        known = spark.createDataFrame([(t, n) for t, k in parts.items() for n in range(k)],
                                      "topic string, partition int") if args.source == "kafka" \
            else records.select("topic", "partition").distinct()
        offsets.require_positions(known, log.positions())
    if args.job == "j4":
        return pj.catch_up_word_totals(log, records, args.buckets)
    if args.job in ("j5-pv", "j5-uv"):
        return pj.catch_up_pv_uv(log, records)
    if args.job not in CATCH_UP:
        raise ValueError(f"{args.job} runs as a stream only")
    return pj.catch_up(log, records, CATCH_UP[args.job])


def jdbc_run(spark, args) -> bool:
    """One bounded run of j3, j4 or j5 into the database that the session's JDBC
    settings name."""
    module, _, name = args.connect.partition(":")
    connect = getattr(importlib.import_module(module), name or "connect")
    run = jdbc_jobs.Run(spark, jdbc_options(spark), args.name, args.module, args.group)
    if args.source == "kafka":
        records = kafka_batch_records(spark, _kafka_opts(args), run.positions, _topic_partitions(args), args.cap)
    else:
        records = spark.read.parquet(args.replay)
    write = JDBC_JOBS[args.job]
    return write(run, records, connect, args.table, args.dialect)


def stream_start(spark, args) -> str | None:
    """``startingOffsets`` of a stream that goes on from the positions of the
    commit log of its name (``--starting committed``)."""
    if args.starting != "committed":
        return None
    log = CommitLog(spark, job=args.name, module=args.module, grp=args.group)
    return starting_offsets(log.positions(), _topic_partitions(args))


def start_positions(spark, args) -> DataFrame:
    """Committed positions that a replayed stream goes on from: those of its first
    start, kept beside its checkpoint, so that a restart skips the same records."""
    log = CommitLog(spark, job=args.name, module=args.module, grp=args.group)
    path = os.path.join(args.checkpoint or os.path.join(checkpoint_root(spark), "streams", args.name), "_start_positions")
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    log.positions().write.parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def build(spark, args) -> tuple[DataFrame, str]:
    if args.source == "kafka":
        records = kafka_records(spark, _kafka_opts(args, stream_start(spark, args)), args.cap)
    else:
        records = replay_records(spark, args.replay, args.max_files_per_trigger)
        if getattr(args, "starting", None) == "committed":
            records = offsets.resume_scan(records, start_positions(spark, args))
    job = JOBS[args.job]
    kw = {}
    if "clock" in inspect.signature(job).parameters:
        # Kafka partitions advance unevenly: per-batch results need the global
        # time clock; a replay of the envelope may use the offset clock.
        kw["clock"] = getattr(args, "clock", None) or ("time" if args.source == "kafka" else "offset")
        kw["interval_s"] = int(getattr(args, "trigger_seconds", sj.BATCH_INTERVAL_S))
    params = inspect.signature(job).parameters
    if getattr(args, "lateness", None) and "lateness" in params:
        kw["lateness"] = args.lateness
    if getattr(args, "lateness_batches", None) and "lateness_batches" in params:
        kw["lateness_batches"] = args.lateness_batches
    if getattr(args, "once", False):
        if "once" not in params:
            raise ValueError(f"--once is for per-batch jobs, not {args.job}")
        kw["once"] = True
    if args.job == "j5-pv" and getattr(args, "sink", None) == "parquet":
        kw["mode"] = "append"   # the files take each hour when it closes
    return job(sj.observed(records, "records"), **kw)


PER_BATCH = ("j1", "j6", "j7", "j9")


def bounded_run(spark, args):
    """A bounded replay of a per-batch job: its batch form over the log as it
    is now, so every batch is whole and nothing is late, whatever the sink.

    ``parquet``: the job's first output goes to ``--out``, any other to
    ``<out>_<name>``. ``memory``: the outputs are temporary views, ``--name`` and
    ``<name>_<output>``. ``console``: the first rows of each output by batch.
    ``--once`` keeps one record per topic, partition and offset."""
    records = spark.read.parquet(args.replay)
    if args.once:
        records = records.dropDuplicates(["topic", "partition", "offset"])
    outputs = CATCH_UP[args.job]
    if args.sink == "parquet" and args.job == "j6":
        return pj.write_sorted_batches(pj.j1_word_count(records), args.out, mode="errorifexists")
    for i, (name, build_one) in enumerate(outputs.items()):
        out = build_one(records)
        if args.sink == "parquet":
            out.write.mode("errorifexists").parquet(f"{args.out}_{name}" if i else args.out)
        elif args.sink == "memory":
            out.createOrReplaceTempView(f"{args.name}_{name}" if i else args.name)
        else:
            out.orderBy("batch_id").show(truncate=False)


def main(argv=None, spark=None):
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--source", choices=["kafka", "replay"], default="kafka")
    p.add_argument("--bootstrap")
    p.add_argument("--topics")
    p.add_argument("--starting", default="earliest",
                   help="Kafka start of a new stream: earliest, latest, offsets as JSON, or committed (the "
                        "positions of --name's catch-up runs); with --catch-up: where partitions without "
                        "a stored position start (earliest), or none to refuse them")
    p.add_argument("--assign", action="store_true",
                   help="read partitions 0 to --partitions - 1 of each topic instead of subscribing")
    p.add_argument("--rate", type=int, default=0, help="records/s/partition cap (0: none)")
    p.add_argument("--partitions", type=int,
                   help="partitions per topic (needed for --rate and a Kafka --catch-up)")
    p.add_argument("--max-poll-records", type=int)
    p.add_argument("--cap", type=int, default=DEFAULT_CAP, help="records per partition per batch_id")
    p.add_argument("--clock", choices=["time", "offset"],
                   help="per-batch clock (default: time for kafka, offset for replay)")
    p.add_argument("--lateness", help="event-time slack before a window closes, e.g. '2 minutes' "
                                      "(J3, J5; default 1 hour)")
    p.add_argument("--lateness-batches", type=int,
                   help="batches a per-batch result waits for late records (default 1)")
    p.add_argument("--once", action="store_true",
                   help="per-batch jobs: drop records (topic, partition, offset) that were delivered before")
    p.add_argument("--starting-timestamp", type=int,
                   help="Kafka start of a new stream by record time, epoch milliseconds, in every partition")
    p.add_argument("--snapshot", help="write the result held in the checkpoint of --name (j4, j5-pv) to this folder; "
                                      "with --out, the closed hours that j5-pv --sink parquet wrote there as well")
    p.add_argument("--buckets", type=int, help="j4 --catch-up: keep the totals as so many sorted buckets")
    p.add_argument("--replay")
    p.add_argument("--max-files-per-trigger", type=int, default=1)
    p.add_argument("--sink", choices=["console", "parquet", "memory", "state", "jdbc"], default="console")
    p.add_argument("--table", help="target table of --sink jdbc")
    p.add_argument("--connect", help="module:function that opens a DB-API connection, for --sink jdbc")
    p.add_argument("--dialect", choices=["ansi", "mysql"], default="ansi")
    p.add_argument("--out")
    p.add_argument("--name", required=True)
    p.add_argument("--checkpoint")
    p.add_argument("--trigger-seconds", type=float, default=sj.BATCH_INTERVAL_S)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--catch-up", action="store_true",
                   help="one bounded run from the committed positions, results and positions "
                        "committed together (commit log under the checkpoint)")
    p.add_argument("--module", default="default")
    p.add_argument("--group", default="default")
    args = p.parse_args(argv)
    bounded = args.catch_up or args.sink == "jdbc"
    if args.source == "kafka" and not args.snapshot and not args.partitions and (
            args.rate or bounded or args.assign or args.starting == "committed" or args.starting_timestamp is not None):
        p.error("--partitions is needed with --rate, --assign, --starting committed, --starting-timestamp and a "
                "bounded Kafka run")
    if args.source == "replay" and (args.assign or args.starting_timestamp is not None):
        p.error("--assign and --starting-timestamp are for Kafka")
    if args.snapshot and args.job not in SNAPSHOTS:
        p.error("--snapshot is for j4 and j5-pv")
    if args.buckets and not (args.catch_up and args.job == "j4"):
        p.error("--buckets is for j4 --catch-up")
    if args.starting_timestamp is not None and (bounded or args.starting != "earliest"):
        p.error("--starting-timestamp is the start of a stream, in place of --starting")
    if args.sink == "jdbc":
        if args.job not in JDBC_JOBS or not (args.table and args.connect):
            p.error("--sink jdbc is for j3, j4 and j5 and needs --table and --connect")
        if args.catch_up or args.available_now or args.rate or args.starting != "earliest":
            p.error("--sink jdbc is one bounded run from the positions in the database")
    if args.catch_up and args.rate:
        p.error("--rate caps a stream; a --catch-up reads everything pending")
    if args.catch_up and args.starting not in ("earliest", "none"):
        p.error("--catch-up starts from the stored positions: --starting earliest or none")
    if not args.catch_up and args.starting == "none":
        p.error("--starting none needs stored positions: use it with --catch-up")
    if spark is None:
        from eventide.session import build_session
        spark = build_session(master=None)  # the master comes from spark-submit
    if args.snapshot:
        checkpoint = args.checkpoint or os.path.join(checkpoint_root(spark), "streams", args.name)
        return SNAPSHOTS[args.job](spark, checkpoint, closed=args.out).write.parquet(args.snapshot)
    if args.sink == "jdbc":
        return jdbc_run(spark, args)
    if args.catch_up:
        return catch_up(spark, args)
    if args.available_now and args.source == "replay" and args.sink != "state" and args.job in PER_BATCH:
        return bounded_run(spark, args)
    df, mode = build(spark, args)
    trigger = {"availableNow": True} if args.available_now else \
        {"processingTime": f"{args.trigger_seconds} seconds"}
    q = sj.start(df, mode, args.sink, args.checkpoint, path=args.out, name=args.name,
                 trigger=trigger)
    q.awaitTermination()
    late = sum({r["batch_id"]: r["late_rows"] for r in sj.progress_offsets(q)}.values())
    if late:
        warnings.warn(f"{args.name}: at least {late} rows came after the watermark and were dropped; raise the "
                      "lateness or use --catch-up", stacklevel=2)
    return q


if __name__ == "__main__":
    main()
