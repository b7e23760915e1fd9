"""Edge cases of the payload parsers (FIXTURES.md section 3)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventide.functions import text
from eventide.operators import logs, tokens, values


def _one_col(spark, vals, ddl="v string"):
    return spark.createDataFrame([(v,) for v in vals], ddl)


@pytest.mark.parametrize("value, expected", [
    ("", [""]),
    (" ", []),
    ("   ", []),
    (" a", ["", "a"]),
    ("a  b ", ["a", "", "b"]),
    ("a\nb c", ["a\nb", "c"]),
    ("a\t b", ["a\t", "b"]),
    ("word", ["word"]),
])
def test_space_tokens_follow_java_split(spark, value, expected):
    got = _one_col(spark, [value]).select(text.space_tokens("v").alias("t")).first()["t"]
    assert got == expected


@pytest.mark.parametrize("value, expected", [
    ("a||b||c", ["a", "b", "c"]),
    ("a||b||c||d||e", ["a", "b", "c", "d", "e"]),
    ("a||b||", ["a", "b"]),
    ("||", []),
    ("", [""]),
    ("a||||c", ["a", "", "c"]),
])
def test_java_split_drops_trailing_empties(spark, value, expected):
    got = _one_col(spark, [value]).select(
        text.java_split("v", text.THREE_FIELD_SEPARATOR).alias("t")).first()["t"]
    assert got == expected


def test_three_fields_ignores_extras(spark):
    df = _one_col(spark, ["1||click||7||x||y"]).withColumnRenamed("v", "value")
    assert values.split_three_fields(df).first().asDict() == {"f0": "1", "f1": "click", "f2": "7"}


def test_three_fields_fails_on_two_fields(spark):
    df = _one_col(spark, ["1||click"]).withColumnRenamed("v", "value")
    with pytest.raises(PySparkException):
        values.split_three_fields(df).collect()


def test_parse_log_edge_cases(spark):
    lines = [
        "2024-01-01T10:00:00|~|ip|~|/e?uid=7&sid=click",    # good
        "2024-01-01T1|~|ip|~|/e?uid=7&sid=click",           # short time: dropped
        "2024-01-01T10:00:00|~|ip",                          # two fields: dropped
        "2024-01-01T10:00:00|~|ip|~|/e?uid=7",              # 2 uri pieces: dropped
        "2024-01-01T10:00:00|~|ip|~|/e?uid=&sid=view",      # empty user: kept
        "2024-01-01T10:00:00|~|ip|~|/e?a=1|b=2|extra",      # names ignored, '|' splits
    ]
    df = _one_col(spark, lines).withColumnRenamed("v", "value")
    got = sorted(tuple(r) for r in logs.parse_log(df).collect())
    assert got == sorted([("2024-01-01-10", "7", "click"), ("2024-01-01-10", "", "view"),
                          ("2024-01-01-10", "1", "2")])
    counts = {r["parsed"]: r["n"] for r in logs.malformed_lines(df).collect()}
    assert counts == {True: 3, False: 3}


def test_hour_replaces_every_T(spark):
    df = _one_col(spark, ["TTTT-01-01T10:00|~|ip|~|/e?u=1&s=2"]).withColumnRenamed("v", "value")
    assert logs.parse_log(df).first()["hour"] == "-----01-01-10"


def test_strict_reading(spark):
    ok = spark.createDataFrame([("2024-01-01 00:00:00", "12"), ("2024-01-01 00:00:01", "-3")],
                               "key string, value string").withColumn("ts", F.lit(None))
    assert [r["reading"] for r in values.readings(ok).collect()] == [12, -3]
    for bad in [" 12 ", "x", "1.5", "12\n", "\t7"]:
        df = spark.createDataFrame([("2024-01-01 00:00:00", bad)], "key string, value string") \
            .withColumn("ts", F.lit(None))
        with pytest.raises(PySparkException):
            values.readings(df).collect()
        assert values.readings(df, strict=False).count() == 0


def test_short_key_fails_strict_and_drops_lenient(spark):
    for key in ["2024-01", None]:
        df = spark.createDataFrame([(key, "5")], "key string, value string").withColumn("ts", F.lit(None))
        with pytest.raises(PySparkException):
            values.readings(df).collect()
        assert values.readings(df, strict=False).count() == 0


def test_fixed_position_split(spark):
    df = _one_col(spark, ["20240101 rest of it", "short", "12345678"])
    got = [tuple(r) for r in values.fixed_position_split(df, "v").collect()]
    assert got == [("20240101", "rest of it"), (None, None), ("12345678", None)]


def test_time_functions(spark):
    df = _one_col(spark, ["2019-06-28 16:58:55"])
    r = df.select(text.text_to_epoch_millis("v").alias("ms"),
                  text.text_to_compact("v").alias("c")).first()
    assert r["ms"] == 1561741135000
    assert r["c"] == "20190628165855"


def test_time_functions_ignore_session_zone(spark):
    df = _one_col(spark, ["2019-06-28 16:58:55"])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        r = df.select(text.text_to_epoch_millis("v").alias("ms"),
                      text.text_to_compact("v").alias("c")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ms"] == 1561741135000 and r["c"] == "20190628165855"


def test_word_count_same_word_many_partitions(spark):
    df = _one_col(spark, ["a b a", "a", "b c", ""] * 5).repartition(4).withColumnRenamed("v", "value")
    got = {r["word"]: r["n"] for r in tokens.word_count(tokens.tokenize(df)).collect()}
    assert got == {"a": 15, "b": 10, "c": 5, "": 5}


def test_merge_totals(spark):
    state = spark.createDataFrame([("a", 3), ("b", 1)], "word string, cnt bigint")
    delta = spark.createDataFrame([("a", 2), ("c", 5)], "word string, cnt bigint")
    got = {r["word"]: r["cnt"] for r in tokens.merge_totals(state, delta).collect()}
    assert got == {"a": 5, "b": 1, "c": 5}


def test_alert_reduce_joins_sorted_days(spark):
    means = spark.createDataFrame([("2024-01-02", 30.0), ("2024-01-01", 25.0)],
                                  "day string, mean double")
    r = values.flag_and_join(means).first()
    assert (r["data"], r["result"]) == ("2024-01-01=2024-01-02", True)
    means2 = spark.createDataFrame([("2024-01-02", 30.0), ("2024-01-01", 22.0)],
                                   "day string, mean double")
    assert values.flag_and_join(means2).first()["result"] is False
