"""Stream = batch: replay the fixture as a parquet log, run each streaming
job with ``availableNow`` and compare what it emitted with the batch query.

Per-batch and windowed results are compared on closed groups only (the
newest batch / window stays open until later data arrives).
"""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from eventide.operators import logs, offsets, tokens, values, windows
from eventide.sources.records import documents_envelope, events_envelope
from eventide.streaming import jobs
from eventide.streaming.sources import replay_records, write_replay_log

AVAILABLE_NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def logs_root():
    import tempfile
    return tempfile.mkdtemp(prefix="eventide-stream-")


def _log(spark, root, name, records, slices=5):
    path = os.path.join(root, name)
    if not os.path.exists(path):
        write_replay_log(records, path, slices, files_per_slice=1)
    return path


@pytest.fixture(scope="module")
def doc_log(spark, logs_root):
    return _log(spark, logs_root, "docs", documents_envelope(spark, SF01).drop("doc_id"))


@pytest.fixture(scope="module")
def reading_log(spark, logs_root):
    return _log(spark, logs_root, "readings", events_envelope(spark, SF01, "reading", keep=()))


@pytest.fixture(scope="module")
def weblog(spark, logs_root):
    return _log(spark, logs_root, "weblog", events_envelope(spark, SF01, "log", keep=()))


def _run_parquet(spark, df, mode, root):
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    jobs.start(df, mode, "parquet", ck, path=out, trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(out)


def _run_memory(spark, df, mode, root):
    name = "m_" + uuid.uuid4().hex[:8]
    q = jobs.start(df, mode, "memory", os.path.join(root, "ck"), name=name, trigger=AVAILABLE_NOW)
    q.awaitTermination()
    return spark.table(name)


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_word_count_per_batch_stream_equals_batch(spark, doc_log, tmp_dir):
    out = _run_parquet(spark, jobs.word_count_per_batch(replay_records(spark, doc_log))[0],
                       "append", tmp_dir)
    closed = sorted(r[0] for r in out.select("batch_id").distinct().collect())
    assert closed == [0, 1, 2, 3]  # batch 4 is still open
    batch = tokens.word_count_per_batch(
        tokens.tokenize(documents_envelope(spark, SF01), keep=("batch_id",)))
    assert _same(out, batch.where(F.col("batch_id").isin(closed)))


def test_restart_resumes_without_loss_or_duplicates(spark, doc_log, tmp_dir):
    # the first run sees batches 0-1 and stops; the second continues on the
    # same checkpoint after batches 2-4 were appended (in batch order)
    src = os.path.join(tmp_dir, "src")
    full = spark.read.parquet(doc_log)
    for b in range(2):
        full.where(F.col("batch_id") == b).write.mode("append").parquet(src)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")

    def run():
        df, mode = jobs.word_count_per_batch(replay_records(spark, src))
        jobs.start(df, mode, "parquet", ck, path=out, trigger=AVAILABLE_NOW).awaitTermination()

    run()
    first = spark.read.parquet(out).select("batch_id").distinct().count()
    for b in range(2, 5):
        full.where(F.col("batch_id") == b).write.mode("append").parquet(src)
    run()
    got = spark.read.parquet(out)
    assert first == 1
    assert got.groupBy("batch_id", "word").count().where("count > 1").count() == 0
    batch = tokens.word_count_per_batch(
        tokens.tokenize(documents_envelope(spark, SF01), keep=("batch_id",)))
    assert _same(got, batch.where("batch_id < 4"))


def test_running_totals_stream_equals_batch(spark, doc_log, tmp_dir):
    df, mode = jobs.running_totals(replay_records(spark, doc_log))
    updates = _run_memory(spark, df, mode, tmp_dir)
    final = updates.groupBy("word").agg(F.max("cnt").alias("cnt"))
    batch = tokens.running_total(tokens.tokenize(documents_envelope(spark, SF01)))
    assert _same(final, batch)


def test_offset_report_stream_equals_batch(spark, reading_log, tmp_dir):
    out = _run_parquet(spark, jobs.offset_report(replay_records(spark, reading_log))[0],
                       "append", tmp_dir)
    batch = offsets.offset_ranges(events_envelope(spark, SF01, keep=()))
    assert _same(out, batch.where("batch_id < 4"))


def test_value_count_and_three_fields_stream(spark, tmp_dir):
    recs = events_envelope(spark, SF01, "fields", keep=())
    path = os.path.join(tmp_dir, "log")
    write_replay_log(recs, path, 3)
    out = _run_parquet(spark, jobs.three_fields(replay_records(spark, path))[0], "append",
                       os.path.join(tmp_dir, "a"))
    assert _same(out, values.split_three_fields(recs))
    out2 = _run_parquet(spark, jobs.value_count_per_batch(replay_records(spark, path))[0],
                        "append", os.path.join(tmp_dir, "b"))
    assert _same(out2, values.value_count_per_batch(recs).where("batch_id < 4"))


def test_pv_counters_stream_equals_batch(spark, weblog, tmp_dir):
    df, mode = jobs.pv_counters(replay_records(spark, weblog))
    updates = _run_memory(spark, df, mode, tmp_dir)
    final = updates.groupBy("hour", "site_id").agg(F.max("pv").alias("pv"))
    batch = logs.pv_rollup(logs.parse_log(events_envelope(spark, SF01, "log", keep=())))
    assert _same(final, batch)


def test_uv_stream_emits_closed_days(spark, weblog, tmp_dir):
    out = _run_parquet(spark, jobs.uv_by_day(replay_records(spark, weblog))[0], "append", tmp_dir)
    batch = logs.uv_by_day(logs.parse_log(events_envelope(spark, SF01, "log", keep=())))
    days = [r[0] for r in out.select("day").collect()]
    assert len(days) >= 28  # all but the still-open last day
    assert _same(out, batch.where(F.col("day").isin(days)))


def test_alert_stream_emits_closed_windows(spark, reading_log, tmp_dir):
    out = _run_parquet(spark, jobs.windowed_alert(replay_records(spark, reading_log))[0],
                       "append", tmp_dir)
    reads = values.readings(events_envelope(spark, SF01, "reading", keep=()))
    batch = windows.windowed_alert(windows.sliding_mean(reads))
    last = out.agg(F.max("window_start")).first()[0]
    assert out.count() > 30000
    # stream window starts are timestamps (UTC session), batch ones timestamp_ntz
    out_ntz = out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert _same(out_ntz, batch.where(F.col("window_start") <= F.lit(last).cast("timestamp_ntz")))


def test_observed_batch_metrics(spark, reading_log, tmp_dir):
    df, mode = jobs.three_fields(jobs.observed(replay_records(spark, reading_log), "batch"))
    q = jobs.start(df.select("f0"), mode, "parquet", os.path.join(tmp_dir, "ck"),
                   path=os.path.join(tmp_dir, "out"), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    seen = [p["observedMetrics"]["batch"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["n"] for m in seen) == 10000


def test_run_cli_replay_to_parquet(spark, reading_log, tmp_dir):
    from eventide.plans import run
    out = os.path.join(tmp_dir, "out")
    run.main(["j9", "--source", "replay", "--replay", reading_log, "--sink", "parquet",
              "--out", out, "--name", "j9-test", "--checkpoint", os.path.join(tmp_dir, "ck"),
              "--available-now"], spark=spark)
    got = spark.read.parquet(out)
    assert got.count() == 20  # 4 partitions x 5 batches
    assert spark.read.parquet(out + "_partitions").count() == 5
    assert set(run.JOBS) >= {"j1", "j2", "j3", "j4", "j5-pv", "j5-uv", "j6", "j7", "j8", "j9"}


def test_run_cli_builds_every_job(spark, reading_log, weblog, doc_log):
    from eventide.plans import run
    logs_for = {"j3": reading_log, "j5-pv": weblog, "j5-uv": weblog, "j7": reading_log,
                "j9": reading_log}
    for job in run.JOBS:
        path = logs_for.get(job, doc_log)
        args = run.argparse.Namespace(job=job, source="replay", replay=path, max_files_per_trigger=1)
        df, mode = run.build(spark, args)
        assert df.isStreaming and mode in ("append", "update")


def test_top_words_stream_complete_mode(spark, doc_log, tmp_dir):
    df, mode = jobs.top_words(replay_records(spark, doc_log), 10)
    assert mode == "complete"
    name = "top_" + uuid.uuid4().hex[:8]
    q = jobs.start(df, mode, "memory", os.path.join(tmp_dir, "ck"), name=name,
                   trigger=AVAILABLE_NOW)
    q.awaitTermination()
    got = [(r["word"], r["cnt"]) for r in spark.table(name).collect()]
    batch = tokens.top_words(tokens.word_count(tokens.tokenize(documents_envelope(spark, SF01))), 10)
    assert got == [(r["word"], r["n"]) for r in batch.collect()]


def test_time_clock_per_batch_counts(spark, tmp_dir):
    """Global time clock: batches are 6 s slices of the record time, so an
    unevenly advancing partition cannot make the others' records late."""
    recs = events_envelope(spark, SF01, "type", keep=())
    # skew the layout: partition 0 gets offsets far ahead of the others
    skewed = recs.withColumn("offset", F.when(F.col("partition") == 0, F.col("offset") * 1000)
                             .otherwise(F.col("offset")))
    skewed = skewed.withColumn("batch_id", F.expr("`offset` div 500"))
    path = os.path.join(tmp_dir, "log")
    write_replay_log(recs.withColumn("batch_id", F.expr("`offset` div 500")), path, 5)
    df, mode = jobs.value_count_per_batch(replay_records(spark, path), clock="time",
                                          interval_s=3600)
    out = _run_parquet(spark, df, mode, os.path.join(tmp_dir, "a"))
    batch = (recs.groupBy(F.expr("unix_seconds(cast(ts AS timestamp)) div 3600").alias("batch_id"),
                          "value").agg(F.count(F.lit(1)).alias("n")))
    last = out.agg(F.max("batch_id")).first()[0]
    assert out.select("batch_id").distinct().count() > 700
    assert _same(out, batch.where(F.col("batch_id") <= last))
    # the offset clock on the skewed layout would drop the slow partitions
    spath = os.path.join(tmp_dir, "skewed")
    write_replay_log(skewed, spath, 5)
    df2, _ = jobs.value_count_per_batch(replay_records(spark, spath), clock="offset")
    out2 = _run_parquet(spark, df2, "append", os.path.join(tmp_dir, "b"))
    assert out2.agg(F.sum("n")).first()[0] < skewed.count()


def test_pv_counter_state_stays_bounded(spark, weblog, tmp_dir):
    """Closed hours leave the state store: 720 hours x 6 keys went through,
    only the hours still inside the lateness stay."""
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    spark.conf.set(key, "true")  # the row count is off by default (a metric only)
    try:
        df, mode = jobs.pv_counters(replay_records(spark, weblog))
        name = "pvstate_" + uuid.uuid4().hex[:8]
        q = jobs.start(df, mode, "memory", os.path.join(tmp_dir, "ck"), name=name,
                       trigger=AVAILABLE_NOW)
        q.awaitTermination()
    finally:
        spark.conf.set(key, "false")
    ops = q.recentProgress[-1]["stateOperators"]
    assert ops and ops[0]["numRowsTotal"] < 50
    assert spark.table(name).select("hour").distinct().count() == 720


def test_progress_offsets_and_console_sink(spark, reading_log, tmp_dir):
    """Live offset report from progress (start/end offset per source) and
    the console preview sink."""
    df, mode = jobs.three_fields(replay_records(spark, reading_log))
    q = jobs.start(df.select("f0"), mode, "console",
                   os.path.join(tmp_dir, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    rep = jobs.progress_offsets(q)
    assert rep and sum(r["rows"] for r in rep) == 10000
    assert all(r["end"] is not None for r in rep)


def test_run_cli_catch_up_commits_once(spark, doc_log, tmp_dir):
    from eventide.plans import run
    from eventide.schemas import WORD_TOTAL
    from eventide.sinks.commit_log import CommitLog
    argv = ["j4", "--source", "replay", "--replay", doc_log, "--name", "wc",
            "--checkpoint", os.path.join(tmp_dir, "log"), "--catch-up"]
    assert run.main(argv, spark=spark) == 1
    assert run.main(argv, spark=spark) is None  # nothing pending: applied once
    totals = CommitLog(spark, os.path.join(tmp_dir, "log")).latest("totals", WORD_TOTAL)
    batch = tokens.running_total(tokens.tokenize(documents_envelope(spark, SF01)))
    assert _same(totals, batch)


def test_update_mode_job_rejects_file_sink(spark, doc_log, tmp_dir):
    df, mode = jobs.running_totals(replay_records(spark, doc_log))
    with pytest.raises(ValueError, match="append-only"):
        jobs.start(df, mode, "parquet", os.path.join(tmp_dir, "ck"), path=os.path.join(tmp_dir, "o"))


def test_run_cli_passes_lateness(spark, reading_log, tmp_dir):
    from eventide.plans import run
    out = os.path.join(tmp_dir, "out")
    run.main(["j3", "--source", "replay", "--replay", reading_log, "--sink", "parquet", "--out", out,
              "--name", "j3", "--checkpoint", os.path.join(tmp_dir, "ck"), "--available-now",
              "--lateness", "2 minutes"], spark=spark)
    # a short lateness closes more windows of the last slice than the 1 hour default
    assert spark.read.parquet(out).count() > 40134


def test_alert_stream_general_window_shape(spark, reading_log, tmp_dir):
    """Length not a multiple of the slide (gcd buckets, window_time re-windowing)."""
    df, mode = jobs.windowed_alert(replay_records(spark, reading_log), length=50, slide=20)
    out = _run_parquet(spark, df, mode, tmp_dir)
    reads = values.readings(events_envelope(spark, SF01, "reading", keep=()))
    batch = windows.windowed_alert(windows.sliding_mean(reads, 50, 20))
    last = out.agg(F.max("window_start")).first()[0]
    out_ntz = out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert out.count() > 20000  # 50 s windows sliding by 20 s: ~2.5 windows per event
    assert _same(out_ntz, batch.where(F.col("window_start") <= F.lit(last).cast("timestamp_ntz")))


def test_bounded_run_of_a_per_batch_job_is_whole(spark, doc_log, tmp_dir):
    """A bounded replay through the command line emits every batch and token."""
    from eventide.plans import run
    out = os.path.join(tmp_dir, "out")
    run.main(["j1", "--source", "replay", "--replay", doc_log, "--sink", "parquet", "--out", out,
              "--name", "j1", "--checkpoint", os.path.join(tmp_dir, "ck"), "--available-now"], spark=spark)
    got = spark.read.parquet(out)
    assert sorted(r[0] for r in got.select("batch_id").distinct().collect()) == [0, 1, 2, 3, 4]
    assert got.agg(F.sum("n")).first()[0] == tokens.tokenize(documents_envelope(spark, SF01)).count()


def test_bounded_run_keeps_unevenly_advancing_partitions(spark, tmp_dir):
    from eventide.plans import run
    recs = events_envelope(spark, SF01, "type", keep=())
    skewed = recs.withColumn("offset", F.when(F.col("partition") == 0, F.col("offset") * 1000)
                             .otherwise(F.col("offset"))).withColumn("batch_id", F.expr("`offset` div 500"))
    path, out = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "out")
    write_replay_log(skewed, path, 5)
    run.main(["j7", "--source", "replay", "--replay", path, "--sink", "parquet", "--out", out,
              "--name", "j7", "--checkpoint", os.path.join(tmp_dir, "ck"), "--available-now"], spark=spark)
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] == skewed.count()


def test_bounded_run_is_whole_in_memory_and_on_the_console(spark, tmp_dir, capfd):
    """Partitions that advance unevenly lose nothing there either, and ``--once``
    drops slices that the log holds twice."""
    from eventide.plans import run
    recs = events_envelope(spark, SF01, "type", keep=())
    skewed = recs.withColumn("offset", F.when(F.col("partition") == 0, F.col("offset") * 1000)
                             .otherwise(F.col("offset"))).withColumn("batch_id", F.expr("`offset` div 500"))
    path = os.path.join(tmp_dir, "log")
    skewed.unionByName(skewed).write.parquet(path)
    args = ["j7", "--source", "replay", "--replay", path, "--available-now"]
    run.main([*args, "--sink", "memory", "--name", "whole_j7"], spark=spark)
    run.main([*args, "--sink", "memory", "--name", "once_j7", "--once"], spark=spark)
    assert spark.table("whole_j7").agg(F.sum("n")).first()[0] == 2 * skewed.count()
    assert spark.table("once_j7").agg(F.sum("n")).first()[0] == skewed.count()
    run.main([*args, "--sink", "console", "--name", "shown_j7"], spark=spark)
    assert "batch_id" in capfd.readouterr().out


def test_time_clock_without_record_times_fails(spark, doc_log, tmp_dir):
    df, mode = jobs.word_count_per_batch(replay_records(spark, doc_log), clock="time")
    with pytest.raises(Exception, match="needs a record time"):
        _run_parquet(spark, df, mode, tmp_dir)


def test_odd_hours_stay_in_the_stream(spark, tmp_dir):
    rows = [("t", 0, i, 0, f"2024-01-01T{h}:00:00|~|0.0.0.0|~|/e?uid=u&sid=s") for i, h in
            enumerate(["05", "9X", "25"])]
    recs = spark.createDataFrame(rows, "topic string, partition int, offset long, batch_id long, value string") \
        .withColumn("key", F.lit("k")).withColumn("ts", F.lit("2024-01-01 05:00:00").cast("timestamp"))
    path = os.path.join(tmp_dir, "log")
    recs.write.parquet(path)
    df, mode = jobs.pv_counters(replay_records(spark, path))
    got = _run_memory(spark, df, mode, tmp_dir)
    assert _same(got, logs.pv_rollup(logs.parse_log(recs)))


def test_progress_reports_late_rows(spark, reading_log, tmp_dir):
    df, mode = jobs.offset_report(replay_records(spark, reading_log))
    q = jobs.start(df, mode, "parquet", os.path.join(tmp_dir, "ck"), path=os.path.join(tmp_dir, "o"),
                   trigger=AVAILABLE_NOW)
    q.awaitTermination()
    assert all(r["late_rows"] == 0 for r in jobs.progress_offsets(q))


def test_start_policy_none_and_ignored_options(spark, doc_log, tmp_dir):
    from eventide.plans import run
    base = ["j4", "--source", "replay", "--replay", doc_log, "--name", "wc",
            "--checkpoint", os.path.join(tmp_dir, "log")]
    with pytest.raises(ValueError, match="no stored position"):
        run.main([*base, "--catch-up", "--starting", "none"], spark=spark)
    assert run.main([*base, "--catch-up"], spark=spark) == 1
    assert run.main([*base, "--catch-up", "--starting", "none"], spark=spark) is None
    for extra in (["--catch-up", "--rate", "5"], ["--catch-up", "--starting", "latest"], ["--starting", "none"]):
        with pytest.raises(SystemExit):
            run.main([*base, *extra], spark=spark)
