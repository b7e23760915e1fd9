"""Kafka option building, start positions and the relation helpers.

The Kafka connector jar is not installed here, so the source is checked by
its options only; the replay source stands in for it in the streaming tests.
"""

import contextlib
import io
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from eventide.schemas import LEDGER
from eventide.sources import relations
from eventide.sources.records import documents_envelope, events_envelope
from eventide.streaming import sources as ks


def test_rate_cap_conversion():
    # 100 records/s/partition, 4 partitions, 5 s batches
    assert ks.max_offsets_per_trigger(100, 4, 5) == 2000


def test_subscribe_options():
    o = ks.kafka_options("b:9092", topics=["clicks", "t2"], max_offsets=2000, max_poll_records=20000)
    assert o == {"kafka.bootstrap.servers": "b:9092", "startingOffsets": "earliest",
                 "failOnDataLoss": "true", "subscribe": "clicks,t2",
                 "maxOffsetsPerTrigger": "2000", "kafka.max.poll.records": "20000"}


def test_assign_options_and_exclusive_modes():
    o = ks.kafka_options("b:9092", assign={"test": [3]}, starting="latest")
    assert json.loads(o["assign"]) == {"test": [3]} and o["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        ks.kafka_options("b:9092")
    with pytest.raises(ValueError):
        ks.kafka_options("b:9092", topics=["a"], assign={"a": [0]})


def test_starting_offsets_from_ledger(spark):
    ledger = spark.createDataFrame(
        [("m", "g", "views", 0, 1000), ("m", "g", "views", 2, 10), ("m", "g", "other", 0, 5)], LEDGER)
    got = json.loads(ks.starting_offsets(ledger, {"views": 4}))
    assert got == {"views": {"0": 1000, "1": -2, "2": 10, "3": -2}}
    got = json.loads(ks.starting_offsets(ledger.where("false"), {"views": 2}, default=ks.LATEST))
    assert got == {"views": {"0": -1, "1": -1}}


def test_envelope_layout(spark):
    r = events_envelope(spark, SF01, keep=("event_id",))
    assert r.schema.fieldNames()[:7] == ["topic", "partition", "offset", "batch_id", "ts", "key", "value"]
    stats = r.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                                       F.count(F.lit(1)).alias("n")).collect()
    assert all(s["lo"] == 0 and s["hi"] == s["n"] - 1 for s in stats)  # dense offsets
    d = documents_envelope(spark, SF01)
    assert d.agg(F.max("batch_id")).first()[0] == 4


def test_param_query_binds_and_pushes_down(spark):
    ev = relations.relation(spark, "events", SF01)
    df = relations.param_query(spark, "SELECT event_id FROM {ev} WHERE user_id = :uid", {"uid": 42}, ev=ev)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "PushedFilters" in plan and "42" in plan
    assert df.count() == ev.where("user_id = 42").count()


def test_scalar_query_null_on_empty(spark):
    ev = relations.relation(spark, "events", SF01).where("event_id < 0")
    assert relations.scalar_query(ev, F.max("event_id")).first()["v"] is None


def test_jdbc_options_from_session(spark, monkeypatch):
    monkeypatch.setenv("EVENTIDE_JDBC_URL", "jdbc:mysql://db/test")
    spark.conf.set("eventide.jdbc.user", "u")
    try:
        assert relations.jdbc_options(spark) == {"url": "jdbc:mysql://db/test", "user": "u"}
    finally:
        spark.conf.unset("eventide.jdbc.user")


def test_kafka_batch_options_start_at_positions(spark):
    ledger = spark.createDataFrame([("m", "g", "views", 1, 40)], LEDGER)
    base = ks.kafka_options("b:9092", topics=["views"], max_offsets=2000)
    o = ks.kafka_batch_options(base, ledger, {"views": 2})
    assert "maxOffsetsPerTrigger" not in o and o["endingOffsets"] == "latest"
    assert json.loads(o["startingOffsets"]) == {"views": {"0": -2, "1": 40}}
    assert o["subscribe"] == "views"


class _Rows:
    def __init__(self, row):
        self.row = row

    def first(self):
        return self.row


def test_jdbc_partitioned_reads_bounds_then_slices(monkeypatch, spark):
    calls = []

    def fake(spark_, options, table=None, query=None, **kw):
        calls.append({"table": table, "query": query, **kw})
        return _Rows((5, 905)) if query else "relation"

    monkeypatch.setattr(relations, "jdbc_table", fake)
    out = relations.jdbc_partitioned(spark, {"url": "jdbc:x"}, "events", "event_id", 8)
    assert out == "relation"
    assert calls[0]["query"] == "SELECT min(event_id) AS lo, max(event_id) AS hi FROM events"
    assert calls[1] == {"table": "events", "query": None, "partition_column": "event_id",
                        "lower": 5, "upper": 905, "num_partitions": 8}


def test_jdbc_partitioned_empty_table_single_slice(monkeypatch, spark):
    calls = []

    def fake(spark_, options, table=None, query=None, **kw):
        calls.append(kw)
        return _Rows((None, None)) if query else "relation"

    monkeypatch.setattr(relations, "jdbc_table", fake)
    assert relations.jdbc_partitioned(spark, {}, "t", "id", 8) == "relation"
    assert calls[1] == {}


def test_relation_chooses_jdbc_when_options_given(monkeypatch, spark):
    monkeypatch.setattr(relations, "jdbc_table", lambda s, o, table=None, **kw: ("jdbc", table, o))
    assert relations.relation(spark, "events", jdbc={"url": "u"}) == ("jdbc", "events", {"url": "u"})
    assert relations.relation(spark, "events", SF01).columns[0] == "event_id"


def test_cli_requires_partitions_for_kafka_catch_up():
    from eventide.plans import run
    with pytest.raises(SystemExit):
        run.main(["j4", "--source", "kafka", "--bootstrap", "b:9092", "--topics", "t",
                  "--catch-up", "--name", "x"], spark=object())


def test_catch_up_reads_a_growing_topic_to_one_end(spark):
    """Records that arrive between two actions are beyond the pinned end."""
    from eventide.streaming import sources
    log = [("t", 0, o) for o in range(5)]

    def load(options):
        end = options["endingOffsets"]
        upto = None if end == "latest" else json.loads(end)["t"]["0"]
        df = spark.createDataFrame([r for r in log if upto is None or r[2] < upto],
                                   "topic string, partition int, offset long")
        for c in ("key", "value"):
            df = df.withColumn(c, F.lit("x").cast("binary"))
        log.append(("t", 0, len(log)))  # one more after every read
        return df.withColumn("timestamp", F.current_timestamp())
    none = spark.createDataFrame([], "topic string, partition int, until_offset long")
    got = sources.kafka_batch_records(spark, {}, none, {"t": 2}, 500, load=load)
    assert got.agg(F.max("offset")).first()[0] == 4 and got.count() == 5


def test_cluster_masters_need_a_shared_folder():
    from eventide.session import is_local
    assert is_local("local[8]") and is_local("local") and not is_local("local-cluster[3,2,1000]")
    assert not is_local("spark://host:7077")
