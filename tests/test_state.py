"""Results kept between runs: stream state as a table, bitmaps, bucketed totals,
sorted batches, records delivered twice, streams that go on from positions."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from eventide.operators import logs, offsets, tokens, values
from eventide.plans import jobs as pj
from eventide.plans import run as cli
from eventide.schemas import WORD_TOTAL
from eventide.sinks import bucketed
from eventide.sinks.commit_log import CommitLog
from eventide.sources import relations
from eventide.sources.records import documents_envelope, events_envelope
from eventide.streaming import jobs, sources, state
from eventide.streaming.sources import replay_records, write_replay_log

NOW = {"availableNow": True}


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _docs(spark):
    return documents_envelope(spark, SF01).drop("doc_id")


def _lines(spark):
    return events_envelope(spark, SF01, "log", keep=())


def test_totals_of_a_stopped_stream_are_read_from_its_checkpoint(spark, tmp_dir):
    log, src = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "src")
    write_replay_log(_docs(spark), log, 5, files_per_slice=1)
    args = ["j4", "--source", "replay", "--replay", src, "--sink", "state", "--name", "t", "--available-now",
            "--checkpoint", os.path.join(tmp_dir, "ck")]
    whole = spark.read.parquet(log)
    for part in ("batch_id <= 1", "batch_id > 1"):       # two runs of one stream
        whole.where(part).write.mode("append").parquet(src)
        cli.main(args, spark=spark)
        got = state.running_totals(spark, os.path.join(tmp_dir, "ck"))
        want = whole if part == "batch_id > 1" else whole.where(part)
        assert _same(got, tokens.running_total(tokens.tokenize(want)))
    out = os.path.join(tmp_dir, "totals")
    cli.main([*args, "--snapshot", out], spark=spark)
    assert _same(spark.read.parquet(out), tokens.running_total(tokens.tokenize(whole)))


def test_counters_of_a_stopped_stream_equal_the_batch_rollup(spark, tmp_dir):
    log, out, ck = (os.path.join(tmp_dir, x) for x in ("log", "out", "ck"))
    write_replay_log(_lines(spark), log, 5, files_per_slice=1)
    args = ["j5-pv", "--source", "replay", "--replay", log, "--sink", "parquet", "--out", out, "--name", "pv",
            "--available-now", "--checkpoint", ck]
    cli.main(args, spark=spark)
    batch = logs.pv_rollup(logs.parse_log(_lines(spark)))
    closed, open_ = spark.read.parquet(out), state.pv_counters(spark, ck)
    assert 0 < open_.count() < 50 < closed.count() and closed.count() < batch.count()
    assert closed.groupBy("hour", "site_id").count().where("count > 1").count() == 0
    assert _same(state.pv_counters(spark, ck, out), batch)
    # an hour that both hold, as after a crash between files and commit, counts once
    open_.write.mode("append").parquet(os.path.join(tmp_dir, "both"))
    closed.write.mode("append").parquet(os.path.join(tmp_dir, "both"))
    assert _same(state.pv_counters(spark, ck, os.path.join(tmp_dir, "both")), batch)
    assert _same(state.pv_counters(spark, ck, os.path.join(tmp_dir, "none")), open_)


def test_bitmaps_equal_distinct_users(spark):
    rows = [("d1", u) for u in ("1", "32767", "32768", "9999999999", "0", "07", "-3", "x", "", "10000000000", "1", "x")]
    members = spark.createDataFrame([*rows, ("d2", "5"), ("d3", "y")], "day string, user_id string")
    got = logs.uv_from_bitmaps(logs.uv_bitmaps(members), logs.other_members(members))
    assert {r["day"]: r["uv"] for r in got.collect()} == {"d1": 10, "d2": 1, "d3": 1}
    parsed = logs.parse_log(_lines(spark))
    maps = logs.uv_bitmaps(logs.with_day(parsed))
    assert _same(logs.uv_from_bitmaps(maps, logs.other_members(logs.with_day(parsed))), logs.uv_by_day(parsed))
    assert _same(logs.uv_from_bitmaps(logs.merge_bitmaps(maps, maps)), logs.uv_by_day(parsed))


def test_daily_users_after_five_commits_are_one_row_per_day_and_bucket(spark, tmp_dir):
    log = CommitLog(spark, os.path.join(tmp_dir, "log"), module="web", grp="g")
    recs = _lines(spark)
    for upto in range(5):
        assert pj.catch_up_pv_uv(log, recs.where(F.col("batch_id") <= upto)) == upto + 1
    parsed = logs.parse_log(recs)
    assert _same(pj.committed_uv(log), logs.uv_by_day(parsed))
    assert _same(pj.committed_pv(log), logs.pv_rollup(parsed))
    held = spark.read.parquet(log.latest_path("uv_bitmaps"))
    assert held.count() == held.select("day", "bucket").distinct().count()
    assert held.count() <= 2 * 30                             # ids 0 to 149: buckets 0 and 1 of each day


def test_two_writers_of_one_commit_do_not_mix(spark, tmp_dir, monkeypatch):
    """The second writer took the same id: the first one's results stay whole."""
    first, second = (CommitLog(spark, os.path.join(tmp_dir, "log")) for _ in range(2))
    docs = _docs(spark)
    monkeypatch.setattr(second, "last_commit", lambda: None)
    pj.catch_up_word_totals(first, docs.where("batch_id = 0"))
    monkeypatch.setattr(second, "positions", lambda: spark.createDataFrame([], first.positions().schema))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        pj.catch_up(second, docs, {"totals": lambda p: tokens.running_total(tokens.tokenize(p))})
    want = tokens.running_total(tokens.tokenize(docs.where("batch_id = 0")))
    assert _same(first.latest("totals", WORD_TOTAL), want)
    assert _same(first.table("totals").drop("commit_id"), want)


def test_bucketed_totals_move_only_the_new_counts(spark, tmp_dir):
    docs, n = _docs(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = CommitLog(spark, os.path.join(tmp_dir, "log"))
    for upto in (0, 2, 4):
        pj.catch_up_word_totals(log, docs.where(F.col("batch_id") <= upto), buckets=n)
    want = tokens.running_total(tokens.tokenize(docs))
    state_now = bucketed.read_bucketed(spark, log.latest_path("totals"), WORD_TOTAL, "word", n)
    assert _same(state_now, want)
    files = spark.read.parquet(log.latest_path("totals")).inputFiles()
    assert len(files) == n                                     # one sorted file per bucket
    merged = tokens.merge_totals(state_now, tokens.running_total(tokens.tokenize(docs)))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
    stored_side = plan[plan.index("Bucketed: true") - 600:plan.index("Bucketed: true")]
    assert "Exchange" not in stored_side.split("\n")[-1]
    assert _same(merged, want.select("word", (2 * F.col("cnt")).alias("cnt")))


def test_each_sorted_batch_reads_in_order(spark, tmp_dir):
    log, out = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "out")
    write_replay_log(_docs(spark), log, 5, files_per_slice=1)
    cli.main(["j6", "--source", "replay", "--replay", log, "--sink", "parquet", "--out", out, "--name", "s",
              "--available-now"], spark=spark)
    batch = tokens.word_count_per_batch(tokens.tokenize(_docs(spark), keep=("batch_id",)))
    for b in range(5):
        got = []
        folder = os.path.join(out, f"batch_id={b}")
        for f in sorted(x for x in os.listdir(folder) if x.startswith("part-")):
            got += [(r["word"], r["n"]) for r in spark.read.parquet(os.path.join(folder, f)).collect()]
        want = tokens.sort_by_count(batch.where(F.col("batch_id") == b)).collect()
        assert got == [(r["word"], r["n"]) for r in want]
    # a stream's closed batches are added once each
    added = os.path.join(tmp_dir, "added")
    assert pj.sort_new_batches(batch.where("batch_id < 2"), added) == 2
    assert pj.sort_new_batches(batch, added) == 3
    assert pj.sort_new_batches(batch, added) == 0
    assert _same(spark.read.parquet(added).withColumn("batch_id", F.col("batch_id").cast("bigint")), batch)


def test_slices_delivered_twice_count_once(spark, tmp_dir):
    recs = events_envelope(spark, SF01, "type", keep=()).withColumn("ts", F.col("ts").cast("timestamp"))
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    for b in range(5):
        for _ in range(2):
            recs.where(F.col("batch_id") == b).coalesce(1).write.mode("append").parquet(src)
    track = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    old = spark.conf.get(track)
    spark.conf.set(track, "true")
    try:
        df, mode = jobs.value_count_per_batch(replay_records(spark, src), once=True)
        q = jobs.start(df, mode, "parquet", ck, path=out, trigger=NOW)
        q.awaitTermination()
    finally:
        spark.conf.set(track, old)
    closed = spark.read.parquet(out)
    want = values.value_count_per_batch(events_envelope(spark, SF01, "type", keep=()))
    assert sorted(r[0] for r in closed.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    assert _same(closed, want.where("batch_id < 4"))
    kept = [sum(o["numRowsTotal"] for o in p["stateOperators"] if o["operatorName"].startswith("dedupe"))
            for p in q.recentProgress]
    assert kept and max(kept) <= 3 * 2000                    # at most the open batches' positions


def test_a_replayed_stream_goes_on_from_committed_positions(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    recs = events_envelope(spark, SF01, "fields", keep=())
    write_replay_log(recs, log, 5, files_per_slice=1)
    name = "goes-on-" + uuid.uuid4().hex[:8]    # the shared checkpoint folder outlives a test run
    done = CommitLog(spark, job=name, module="m", grp="g")
    pj.catch_up(done, recs.where("partition < 3 and batch_id <= 1"), {"sizes": values.batch_size})
    out = os.path.join(tmp_dir, "out")
    args = ["j8", "--source", "replay", "--replay", log, "--starting", "committed", "--sink", "parquet", "--out", out,
            "--name", name, "--module", "m", "--group", "g", "--available-now"]
    cli.main(args, spark=spark)
    want = values.split_three_fields(offsets.resume_scan(recs, done.positions()))
    assert want.count() == 10000 - 3 * 1000
    assert _same(spark.read.parquet(out), want)
    # later commits do not change where a restarted stream goes on
    pj.catch_up(done, recs, {"sizes": values.batch_size})
    cli.main(args, spark=spark)
    assert _same(spark.read.parquet(out), want)


def test_start_by_time_in_kafka_options():
    o = sources.kafka_options("h:1", topics=["a", "b"], starting_times=sources.starting_times({"a": 2, "b": 1}, 1700000000000))
    assert o["startingOffsetsByTimestamp"] == (
        '{"a": {"0": 1700000000000, "1": 1700000000000}, "b": {"0": 1700000000000}}')
    assert "startingOffsets" not in o and o["startingOffsetsByTimestampStrategy"] == "latest"
    with pytest.raises(SystemExit):
        cli.main(["j1", "--starting-timestamp", "5", "--name", "x"])
    with pytest.raises(SystemExit):
        cli.main(["j1", "--source", "replay", "--starting-timestamp", "5", "--name", "x"])


def test_slices_of_a_skewed_column_hold_equal_rows(spark):
    ids = spark.range(20_000).select(F.expr("cast(pow(id / 20000, 6) * 1e12 as bigint)").alias("k")).unionByName(
        spark.createDataFrame([(None,)] * 7, "k bigint"))
    cuts = relations.quantile_cuts(ids, "k", 8)
    parts = relations.slice_predicates("k", cuts)
    sizes = [ids.where(p).count() for p in parts]
    assert len(parts) == 8 and sum(sizes) == 20_007 and max(sizes) <= 2 * 20_007 / 8
    equal = [ids.where(f"k >= {i} * 125000000000 and k < {i + 1} * 125000000000").count() for i in range(8)]
    assert max(equal) > 5 * 20_007 / 8                        # what equal ranges would give
    assert relations.slice_predicates("k", []) == ["1 = 1"]
    assert relations.quantile_cuts(ids.where("k is null"), "k", 4) == []
    assert relations.slice_predicates("c", ["o'x"]) == ["c < 'o''x' OR c IS NULL", "c >= 'o''x'"]


def test_balanced_read_passes_its_slices_to_the_database(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, predicates=None, properties=None, **kw:
                        seen.update(url=url, table=table, predicates=predicates, properties=properties))

    def column_only(s, options, table, column, n):
        assert table == "(SELECT k FROM t) q"
        return spark.range(100).select(F.col("id").alias("k"))
    relations.jdbc_balanced(spark, {"url": "jdbc:x", "user": "u"}, "t", "k", 4, read=column_only)
    assert seen["url"] == "jdbc:x" and seen["properties"] == {"user": "u"} and len(seen["predicates"]) == 4
