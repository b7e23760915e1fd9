"""Registered queries: one Spark plan and one independent SQL oracle per key.

Each query takes ``(spark, sf_dir)`` and reads the given tables in full;
derived inputs (the ledger, stored totals) are computed from the same tables.
The oracle SQL restates the semantics directly over the raw columns for DuckDB,
without going through the text payloads the Spark side parses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.text import text_to_compact, text_to_epoch_millis
from eventide.operators import logs, offsets, tokens, values, windows
from eventide.plans.replay import consumer_ledger, with_newest
from eventide.session import stored
from eventide.sources.records import documents_envelope, events_envelope
from eventide.sources.relations import param_query as _param_query
from eventide.sources.relations import relation, scalar_query as _scalar_query

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = ORACLE_PREFIX + sql
        return fn
    return deco


# Shared oracle relations (DuckDB). r: record envelope over events; g: page views
# straight from the events' columns; t: tokens of documents; l: ledger the
# consumers left behind; w: 120 s / 24 s sliding means per day.
ORACLE_PREFIX = """
WITH r AS (
  SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
         event_id // 4 AS "offset", event_id // 4 // 500 AS batch_id, ts,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "key",
         CAST(trunc(value) AS INTEGER) AS reading, event_id, user_id, event_type
  FROM events),
g AS (SELECT batch_id, strftime(ts, '%Y-%m-%d-%H') AS hour, CAST(user_id AS VARCHAR) AS user_id,
        event_type AS site_id FROM r),
t AS (
  SELECT doc_id, doc_id // 4 // 50 AS batch_id,
         unnest(CASE WHEN text = '' THEN ['']
                     WHEN rtrim(text, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(text, ' '), ' ') END) AS word
  FROM documents),
l AS (
  SELECT 'm1' AS module, 'g1' AS grp, topic, "partition", max("offset") + 1 AS until_offset
  FROM r WHERE "partition" IN (0, 1, 2) AND batch_id <= 1 GROUP BY topic, "partition"
  UNION ALL
  SELECT 'm2', 'g1', topic, "partition", max("offset") + 1
  FROM r WHERE "partition" = 3 AND batch_id <= 0 GROUP BY topic, "partition"),
w AS (
  SELECT make_timestamp(CAST(1000000 * (b - 24 * i) AS BIGINT)) AS window_start,
         substr("key", 1, 10) AS day, avg(reading) AS mean
  FROM (SELECT *, CAST(floor(epoch(ts) / 24) AS BIGINT) * 24 AS b FROM r), range(5) s(i)
  GROUP BY 1, 2)
"""


def _events(spark, sf, payload="reading", **kw):
    return events_envelope(spark, sf, payload, **kw)


def _parsed(spark, sf, keep=()):
    return logs.parse_log(_events(spark, sf, "log"), keep=keep)


def _tokens(spark, sf, keep=("doc_id", "batch_id")):
    return tokens.tokenize(documents_envelope(spark, sf), keep=keep)


def _ledger(spark, sf):
    """The ledger, aggregated once and stored."""
    return stored(consumer_ledger(_events(spark, sf, "type")), "ledger")


def _reads(spark, sf):
    return values.readings(_events(spark, sf, "reading"))


def _reads_with_id(spark, sf):
    return values.readings(_events(spark, sf, "reading"), keep=("event_id",))


# ---------------------------------------------------------------- sources

@query("record_scan", 'SELECT topic, "partition", "offset", "key" FROM r')
def record_scan(spark, sf):
    return _events(spark, sf).select("topic", "partition", "offset", "key")


@query("resume_scan", """SELECT r."partition", r."offset" FROM r
  LEFT JOIN (SELECT * FROM l WHERE module = 'm1' AND grp = 'g1') x
    ON r.topic = x.topic AND r."partition" = x."partition"
  WHERE r."offset" >= coalesce(x.until_offset, 0)""")
def resume_scan(spark, sf):
    recs = _events(spark, sf, "type")
    pos = offsets.ledger_for(_ledger(spark, sf), "m1", "g1")
    return offsets.resume_scan(recs, pos).select("partition", "offset")


@query("resume_scan_by_group", """SELECT r."partition", r."offset" FROM r
  LEFT JOIN (SELECT * FROM l WHERE module = 'm2' AND grp = 'g1' AND topic IN ('events')) x
    ON r.topic = x.topic AND r."partition" = x."partition"
  WHERE r."offset" >= coalesce(x.until_offset, 0)""")
def resume_scan_by_group(spark, sf):
    recs = _events(spark, sf, "type")
    pos = offsets.ledger_for(_ledger(spark, sf), "m2", "g1", ["events"])
    return offsets.resume_scan(recs, pos).select("partition", "offset")


@query("first_run_scan", """SELECT r."partition", r."offset" FROM r
  LEFT JOIN (SELECT * FROM l WHERE grp = 'never-committed') x
    ON r.topic = x.topic AND r."partition" = x."partition"
  WHERE r."offset" >= coalesce(x.until_offset, 0)""")
def first_run_scan(spark, sf):
    # a group with no stored position: the ledger lookup is empty -> all records
    recs = _events(spark, sf, "type")
    pos = offsets.ledger_for(_ledger(spark, sf), grp="never-committed")
    return offsets.resume_scan(recs, pos).select("partition", "offset")


@query("start_latest_scan", """SELECT r."partition", r."offset" FROM r
  LEFT JOIN (SELECT topic, "partition", max("offset") + 1 AS u FROM r WHERE batch_id <= 1
             GROUP BY 1, 2) x ON r.topic = x.topic AND r."partition" = x."partition"
  WHERE r."offset" >= coalesce(x.u, 0)""")
def start_latest_scan(spark, sf):
    # consumer started with auto.offset.reset=latest when the log held batches 0-1
    recs = _events(spark, sf, "type")
    pos = stored(offsets.start_positions(recs, "latest", log_end_batch=1), "log-ends")
    return offsets.resume_scan(recs, pos).select("partition", "offset")


@query("batch_plan", 'SELECT "partition", "offset", batch_id FROM r')
def batch_plan(spark, sf):
    return offsets.batch_plan(_events(spark, sf))


@query("ledger_load_flat", """SELECT p.topic, p."partition", coalesce(x.until_offset, 0) AS from_offset
  FROM (SELECT DISTINCT topic, "partition" FROM r) p
  LEFT JOIN (SELECT * FROM l WHERE module = 'm1') x
    ON p.topic = x.topic AND p."partition" = x."partition" """)
def ledger_load_flat(spark, sf):
    recs = _events(spark, sf, "type")
    parts = recs.select("topic", "partition").distinct()
    return offsets.ledger_load_flat(parts, offsets.ledger_for(_ledger(spark, sf), "m1"))


@query("ledger_load_hash", """SELECT topic, "partition", until_offset AS from_offset
  FROM l WHERE grp = 'g1'""")
def ledger_load_hash(spark, sf):
    # store the ledger in the hash layout (field "topic-partition"), then load it back
    hashed = offsets.ledger_as_hash(_ledger(spark, sf))
    return offsets.ledger_load_hash(hashed, "g1")


@query("ledger_load_module", """SELECT topic, "partition", until_offset FROM l
  WHERE module = 'm1' AND grp = 'g1' AND topic IN ('events')""")
def ledger_load_module(spark, sf):
    return offsets.ledger_for(_ledger(spark, sf), "m1", "g1", ["events"]).select(
        "topic", "partition", "until_offset")


@query("jdbc_scan", "SELECT event_id, event_type FROM events")
def jdbc_scan(spark, sf):
    return relation(spark, "events", sf).select("event_id", "event_type")


@query("param_query", "SELECT event_id FROM events WHERE user_id = 42 AND event_type = 'click'")
def param_query(spark, sf):
    return _param_query(
        spark, "SELECT event_id FROM {ev} WHERE user_id = :uid AND event_type = :et",
        {"uid": 42, "et": "click"}, ev=relation(spark, "events", sf))


@query("scalar_query", "SELECT max(event_id) AS v FROM events")
def scalar_query(spark, sf):
    return _scalar_query(relation(spark, "events", sf), F.max("event_id"))


# ------------------------------------------------------ projections, filters

@query("value_projection", "SELECT text AS value FROM documents")
def value_projection(spark, sf):
    return values.value_projection(documents_envelope(spark, sf))


@query("key_value_projection", 'SELECT "key", CAST(reading AS VARCHAR) AS value FROM r')
def key_value_projection(spark, sf):
    return values.key_value_projection(_events(spark, sf, "reading"))


@query("tokenize", "SELECT doc_id, word FROM t")
def tokenize(spark, sf):
    return _tokens(spark, sf, keep=("doc_id",))


@query("token_pairs", "SELECT word, CAST(1 AS INTEGER) AS one FROM t")
def token_pairs(spark, sf):
    return tokens.token_pairs(_tokens(spark, sf, keep=()))


@query("split_three_fields", """SELECT CAST(event_id AS VARCHAR) AS f0, event_type AS f1,
  CAST(user_id AS VARCHAR) AS f2 FROM events""")
def split_three_fields(spark, sf):
    return values.split_three_fields(_events(spark, sf, "fields", keep=()))


@query("parse_log", "SELECT hour, user_id, site_id FROM g")
def parse_log(spark, sf):
    return _parsed(spark, sf)


@query("process_logs", "SELECT batch_id, hour, user_id, site_id FROM g")
def process_logs(spark, sf):
    return logs.process_logs(_events(spark, sf, "log"))


@query("day_key", 'SELECT event_id, substr("key", 1, 10) AS day FROM r')
def day_key(spark, sf):
    return _reads_with_id(spark, sf).select("event_id", "day")


@query("cast_reading", "SELECT event_id, reading FROM r")
def cast_reading(spark, sf):
    return _reads_with_id(spark, sf).select("event_id", "reading")


@query("fixed_position_split", """SELECT event_id, substr("key", 1, 8) AS head,
  substr("key", 10) AS tail FROM r""")
def fixed_position_split(spark, sf):
    return values.fixed_position_split(_events(spark, sf, "date"), keep=("event_id",))


@query("metric_keys", """SELECT concat('pv_', hour) AS metric_key, count(*) AS n FROM g GROUP BY hour
  UNION ALL SELECT concat('site_pv_', site_id, '_', hour), count(*) FROM g GROUP BY site_id, hour
  UNION ALL SELECT concat('uv_', substr(hour, 1, 10)), count(DISTINCT user_id) FROM g
  GROUP BY substr(hour, 1, 10)""")
def metric_keys(spark, sf):
    return logs.metric_keys(_parsed(spark, sf))


@query("malformed_lines", "SELECT event_id % 97 <> 0 AS parsed, count(*) AS n FROM r GROUP BY 1")
def malformed_lines(spark, sf):
    return logs.malformed_lines(_events(spark, sf, "log_with_bad", keep=()))


@query("threshold_flag", "SELECT window_start, day, mean > 22 AS flag FROM w")
def threshold_flag(spark, sf):
    return windows.threshold_flag(windows.sliding_mean(_reads(spark, sf)))


@query("point_lookup", "SELECT word, count(*) AS n FROM t WHERE word = 'the' GROUP BY 1")
def point_lookup(spark, sf):
    return tokens.word_count(_tokens(spark, sf, keep=())).where(F.col("word") == "the")


# ------------------------------------------------------------ joins, merges

@query("merge_running_total", "SELECT word, count(*) AS cnt FROM t GROUP BY 1")
def merge_running_total(spark, sf):
    # stored totals of all earlier batches, upserted with the newest batch
    recs = with_newest(documents_envelope(spark, sf))
    counts = stored(tokens.tokenize(recs, keep=("newest",)).groupBy("word", "newest").agg(
        F.count(F.lit(1)).alias("cnt")), "totals")  # the texts are read once
    state, delta = counts.where("not newest"), counts.where("newest")
    return tokens.merge_totals(state, delta)


# ----------------------------------------------------------- aggregations

@query("word_count_per_batch", "SELECT batch_id, word, count(*) AS n FROM t GROUP BY 1, 2")
def word_count_per_batch(spark, sf):
    return tokens.word_count_per_batch(_tokens(spark, sf, keep=("batch_id",)))


@query("word_count", "SELECT word, count(*) AS n FROM t GROUP BY 1")
def word_count(spark, sf):
    return tokens.word_count(_tokens(spark, sf, keep=()))


@query("value_count_per_batch", """SELECT batch_id, event_type AS value, count(*) AS n
  FROM r GROUP BY 1, 2""")
def value_count_per_batch(spark, sf):
    return values.value_count_per_batch(_events(spark, sf, "type", keep=()))


@query("batch_size", "SELECT batch_id, count(*) AS n FROM r GROUP BY 1")
def batch_size(spark, sf):
    return values.batch_size(_events(spark, sf, keep=()))


@query("pv_by_hour", "SELECT hour, count(*) AS pv FROM g GROUP BY 1")
def pv_by_hour(spark, sf):
    return logs.pv_by_hour(_parsed(spark, sf))


@query("pv_by_site_hour", "SELECT site_id, hour, count(*) AS pv FROM g GROUP BY 1, 2")
def pv_by_site_hour(spark, sf):
    return logs.pv_by_site_hour(_parsed(spark, sf))


@query("pv_rollup", """SELECT hour, site_id, count(*) AS pv FROM g
  GROUP BY GROUPING SETS ((hour), (hour, site_id))""")
def pv_rollup(spark, sf):
    return logs.pv_rollup(_parsed(spark, sf))


@query("uv_by_day", "SELECT substr(hour, 1, 10) AS day, count(DISTINCT user_id) AS uv FROM g GROUP BY 1")
def uv_by_day(spark, sf):
    return logs.uv_by_day(_parsed(spark, sf))


@query("uv_members", "SELECT DISTINCT substr(hour, 1, 10) AS day, user_id FROM g")
def uv_members(spark, sf):
    return logs.uv_members(_parsed(spark, sf))


@query("mean_by_day", 'SELECT substr("key", 1, 10) AS day, avg(reading) AS mean FROM r GROUP BY 1')
def mean_by_day(spark, sf):
    return values.mean_by_day(_reads(spark, sf))


@query("alert_summary", """SELECT string_agg(day, '=' ORDER BY day) AS data, bool_and(mean > 22) AS result
  FROM (SELECT substr("key", 1, 10) AS day, avg(reading) AS mean FROM r GROUP BY 1)""")
def alert_summary(spark, sf):
    return values.alert_summary(_reads(spark, sf))


@query("running_total", "SELECT word, count(*) AS cnt FROM t GROUP BY 1")
def running_total(spark, sf):
    return tokens.running_total(_tokens(spark, sf, keep=()))


@query("offset_ranges", """SELECT topic, "partition", batch_id, min("offset") AS from_offset,
  max("offset") + 1 AS until_offset, count(*) AS n FROM r GROUP BY 1, 2, 3""")
def offset_ranges(spark, sf):
    return offsets.offset_ranges(_events(spark, sf, keep=()))


@query("partitions_per_batch", 'SELECT batch_id, count(DISTINCT "partition") AS n FROM r GROUP BY 1')
def partitions_per_batch(spark, sf):
    return offsets.partitions_per_batch(_events(spark, sf, keep=()))


# ------------------------------------------------ windows, sorts, set ops

@query("sliding_mean", "SELECT window_start, day, mean FROM w")
def sliding_mean(spark, sf):
    return windows.sliding_mean(_reads(spark, sf))


@query("windowed_alert", """SELECT window_start, string_agg(day, '=' ORDER BY day) AS data,
  bool_and(mean > 22) AS result FROM w GROUP BY 1""")
def windowed_alert(spark, sf):
    return windows.windowed_alert(windows.sliding_mean(_reads(spark, sf)))


@query("word_count_sorted", "SELECT word, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, word")
def word_count_sorted(spark, sf):
    return tokens.sort_by_count(tokens.word_count(_tokens(spark, sf, keep=())))


@query("top_words", "SELECT word, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, word LIMIT 10")
def top_words(spark, sf):
    return tokens.top_words(tokens.word_count(_tokens(spark, sf, keep=())), 10)


@query("uv_members_merge", "SELECT DISTINCT substr(hour, 1, 10) AS day, user_id FROM g")
def uv_members_merge(spark, sf):
    # stored day sets (all earlier batches) merged with the newest batch's members
    recs = with_newest(_events(spark, sf, "log", keep=()))
    seen = stored(logs.with_day(logs.parse_log(recs, keep=("newest",))).select(
        "day", "user_id", "newest").distinct(), "members")  # the lines are read once
    side = (lambda cond: seen.where(cond).select("day", "user_id"))
    return logs.merge_members(side("not newest"), side("newest"))


# ------------------------------------------------------------ functions

@query("time_to_epoch_millis", """SELECT event_id,
  epoch_ms(strptime("key", '%Y-%m-%d %H:%M:%S')) AS ms FROM r""")
def time_to_epoch_millis(spark, sf):
    return _events(spark, sf, "date").select("event_id", text_to_epoch_millis("value").alias("ms"))


@query("time_to_compact", """SELECT event_id,
  strftime(strptime("key", '%Y-%m-%d %H:%M:%S'), '%Y%m%d%H%M%S') AS compact FROM r""")
def time_to_compact(spark, sf):
    return _events(spark, sf, "date").select("event_id", text_to_compact("value").alias("compact"))


# ---------------------------------------------------------- commits, sinks

@query("ledger_update", """SELECT module, grp, topic, "partition", max(until_offset) AS until_offset FROM (
  SELECT module, grp, topic, "partition", until_offset FROM l WHERE module = 'm1' AND grp = 'g1'
  UNION ALL
  SELECT 'm1', 'g1', r.topic, r."partition", max(r."offset") + 1 FROM r
  LEFT JOIN (SELECT * FROM l WHERE module = 'm1' AND grp = 'g1') x
    ON r.topic = x.topic AND r."partition" = x."partition"
  WHERE r."offset" >= coalesce(x.until_offset, 0) GROUP BY 1, 2, 3, 4)
  GROUP BY 1, 2, 3, 4""")
def ledger_update(spark, sf):
    # m1/g1 resumes from its positions, consumes the rest of the log, commits
    recs = _events(spark, sf, "type", keep=())
    mine = offsets.ledger_for(_ledger(spark, sf), "m1", "g1")
    ranges = offsets.offset_ranges(offsets.resume_scan(recs, mine))
    return offsets.ledger_update(mine, ranges, "m1", "g1")


@query("alert_rows", """SELECT string_agg(day, '=' ORDER BY day) AS data,
  CAST(bool_and(mean > 22) AS VARCHAR) AS result FROM w GROUP BY window_start""")
def alert_rows(spark, sf):
    return windows.alert_rows(windows.sliding_mean(_reads(spark, sf)))


@query("ledger_keys", """SELECT concat(topic, '_', "partition") AS flat_key,
  concat(topic, '-', "partition") AS hash_field, concat(module, ':', grp, ':', topic) AS module_key,
  until_offset FROM l""")
def ledger_keys(spark, sf):
    return offsets.ledger_keys(_ledger(spark, sf))


FLAGSHIP = "pv_by_hour"
