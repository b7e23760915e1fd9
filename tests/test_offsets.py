"""Ledger, resume and window edge cases on hand-written fixtures."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventide.operators import offsets, windows
from eventide.schemas import LEDGER


def _records(spark, rows):
    """rows: (topic, partition, offset, batch_id)"""
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, batch_id bigint")


def test_hash_layout_splits_at_last_dash(spark):
    ledger = spark.createDataFrame(
        [("m", "g", "my-topic", 0, 9), ("m", "g", "views", 3, 7), ("m", "other", "t", 0, 1)], LEDGER)
    got = sorted(tuple(r) for r in offsets.ledger_load_hash(offsets.ledger_as_hash(ledger), "g").collect())
    assert got == [("my-topic", 0, 9), ("views", 3, 7)]


def test_hash_layout_rejects_non_numeric_offset(spark):
    rows = spark.createDataFrame([("g", "t-0", "abc")], "grp string, field string, value string")
    with pytest.raises(PySparkException):
        offsets.ledger_load_hash(rows, "g").collect()


def test_flat_load_defaults_missing_partitions_to_zero(spark):
    ledger = spark.createDataFrame([("m", "g", "t", 1, 40)], LEDGER)
    parts = spark.createDataFrame([("t", p) for p in range(3)], "topic string, partition int")
    got = sorted(tuple(r) for r in offsets.ledger_load_flat(parts, ledger).collect())
    assert got == [("t", 0, 0), ("t", 1, 40), ("t", 2, 0)]


def test_resume_with_empty_ledger_reads_everything(spark):
    recs = _records(spark, [("t", p, o, o // 2) for p in range(2) for o in range(5)])
    pos = offsets.empty_ledger(spark)
    assert offsets.resume_scan(recs, pos).count() == 10


def test_resume_skips_committed_offsets(spark):
    recs = _records(spark, [("t", p, o, o // 2) for p in range(2) for o in range(5)])
    pos = spark.createDataFrame([("m", "g", "t", 0, 3)], LEDGER)
    got = sorted((r["partition"], r["offset"]) for r in offsets.resume_scan(recs, pos).collect())
    assert got == [(0, 3), (0, 4)] + [(1, o) for o in range(5)]


def test_ledger_update_is_idempotent(spark):
    recs = _records(spark, [("t", 0, o, o // 2) for o in range(6)])
    ranges = offsets.offset_ranges(recs.where("batch_id = 1"))
    once = offsets.ledger_update(offsets.empty_ledger(spark), ranges, "m", "g")
    twice = offsets.ledger_update(once, ranges, "m", "g")
    assert [tuple(r) for r in twice.collect()] == [("m", "g", "t", 0, 4)]
    # replaying an older batch never moves the position back
    older = offsets.offset_ranges(recs.where("batch_id = 0"))
    assert offsets.ledger_update(twice, older, "m", "g").first()["until_offset"] == 4


def test_offset_ranges_half_open(spark):
    recs = _records(spark, [("t", 0, o, o // 3) for o in range(7)])
    got = sorted(tuple(r) for r in offsets.offset_ranges(recs).collect())
    assert got == [("t", 0, 0, 0, 3, 3), ("t", 0, 1, 3, 6, 3), ("t", 0, 2, 6, 7, 1)]


def test_latest_start_policy(spark):
    recs = _records(spark, [("t", 0, o, o // 2) for o in range(6)])
    pos = offsets.start_positions(recs, "latest", log_end_batch=0)
    assert [r["offset"] for r in offsets.resume_scan(recs, pos).orderBy("offset").collect()] == [2, 3, 4, 5]
    assert offsets.resume_scan(recs, offsets.start_positions(recs, "earliest")).count() == 6
    with pytest.raises(ValueError):
        offsets.start_positions(recs, "none")


def test_sliding_mean_matches_brute_force(spark):
    base = dt.datetime(2024, 1, 1, 23, 58, 0)
    rows = [(base + dt.timedelta(seconds=7 * i), (i * 37) % 50) for i in range(60)]
    df = (spark.createDataFrame(rows, "ts timestamp_ntz, reading int")
          .withColumn("day", F.date_format("ts", "yyyy-MM-dd")))
    got = {(r["window_start"], r["day"]): r["mean"] for r in windows.sliding_mean(df).collect()}
    # brute force: every window start s (multiple of 24 s) with s <= t < s + 120
    expect: dict = {}
    epoch = dt.datetime(1970, 1, 1)
    for t, v in rows:
        sec = int((t - epoch).total_seconds())
        last = sec - sec % 24
        for i in range(5):
            s = last - 24 * i
            if s + 120 > sec:
                key = (epoch + dt.timedelta(seconds=s), t.strftime("%Y-%m-%d"))
                expect.setdefault(key, []).append(v)
    assert got.keys() == expect.keys()
    for k, vs in expect.items():
        assert got[k] == pytest.approx(sum(vs) / len(vs))
    # windows across midnight report both days
    assert any(k[1] == "2024-01-02" for k in got) and any(k[1] == "2024-01-01" for k in got)


def test_sliding_mean_general_slide(spark):
    """Length not a multiple of the slide: buckets of gcd(length, slide)."""
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(base + dt.timedelta(seconds=3 * i), i % 11) for i in range(80)]
    df = (spark.createDataFrame(rows, "ts timestamp_ntz, reading int")
          .withColumn("day", F.lit("d")))
    got = {r["window_start"]: r["mean"] for r in windows.sliding_mean(df, 50, 20).collect()}
    native = {r["s"]: r["m"] for r in df.groupBy(F.window("ts", "50 seconds", "20 seconds").start.alias("s"))
              .agg(F.avg("reading").alias("m")).collect()}
    assert got.keys() == native.keys()
    for k in got:
        assert got[k] == pytest.approx(native[k])


def test_none_policy_requires_every_position(spark):
    parts = spark.createDataFrame([("t", 0), ("t", 1)], "topic string, partition int")
    full = spark.createDataFrame([("m", "g", "t", 0, 5), ("m", "g", "t", 1, 7)], LEDGER)
    assert offsets.require_positions(parts, full).count() == 2
    with pytest.raises(ValueError):
        offsets.require_positions(parts, full.where("partition = 0"))


def test_assign_batches_caps_records_per_partition(spark):
    recs = _records(spark, [("t", p, o, -1) for p in range(2) for o in range(7)])
    got = offsets.assign_batches(recs, cap=3)
    per = {(r["partition"], r["batch_id"]): r["n"]
           for r in got.groupBy("partition", "batch_id").count().withColumnRenamed("count", "n").collect()}
    assert per == {(p, b): n for p in range(2) for b, n in [(0, 3), (1, 3), (2, 1)]}
