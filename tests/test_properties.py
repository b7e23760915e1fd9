"""Property tests: the native column expressions agree with a plain-Python
statement of the reference's Java string semantics on random inputs.

Each hypothesis example is a batch of strings evaluated in one Spark job.
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventide.functions import text
from eventide.operators import logs

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def java_split(s: str, sep: str) -> list[str]:
    """``String.split`` with a literal separator and limit 0."""
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def parse_log_ref(line: str):
    """The log-line parse, stated in plain Python: None where Java would throw."""
    fields = line.split("|~|")
    if len(fields[0]) < 13 or len(fields) < 3:
        return None
    hour = fields[0][:13].replace("T", "-")
    uri = re.split("[=|&]", fields[2])
    if len(uri) < 4:
        return None
    return (hour, uri[1], uri[3])


def _eval(spark, values, col):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", col.alias("o")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(st.text(alphabet="ab \n\t", max_size=12), min_size=1, max_size=60))
def test_space_tokens_property(spark, values):
    assert _eval(spark, values, text.space_tokens("v")) == [java_split(v, " ") for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="a|b", max_size=12), min_size=1, max_size=60))
def test_double_bar_split_property(spark, values):
    got = _eval(spark, values, text.java_split("v", text.THREE_FIELD_SEPARATOR))
    assert got == [java_split(v, "||") for v in values]


line_part = st.text(alphabet="2024-01T0:9|~=&ab", max_size=20)


@SETTINGS
@given(st.lists(st.tuples(line_part, line_part, line_part, st.integers(1, 4)),
                min_size=1, max_size=60))
def test_parse_log_property(spark, parts):
    lines = ["|~|".join(p[:p[3]]) if p[3] < 4 else "|~|".join(p[:3]) for p in parts]
    lines += ["2024-01-01T10:00:00|~|x|~|" + p[2] for p in parts]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = {r["i"]: (r["hour"], r["user_id"], r["site_id"])
           for r in logs.parse_log(df, keep=("i",)).collect()}
    for i, line in enumerate(lines):
        assert got.get(i) == parse_log_ref(line), line


@SETTINGS
@given(st.lists(st.text(alphabet="ab \n", max_size=40), min_size=1, max_size=40),
       st.integers(1, 6))
def test_chunked_tokenize_equals_whole(spark, values, chunk):
    from eventide.operators import tokens
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    whole = tokens.word_count(tokens.tokenize(df, keep=("i",)), by=("i",))
    chunked = tokens.word_count(tokens.tokenize(df, keep=("i",), chunk_chars=chunk), by=("i",))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, chunked.collect()))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3 * 86400), st.integers(-50, 500)), min_size=1, max_size=80),
       st.sampled_from([(120, 24), (50, 20), (60, 60), (90, 35), (10, 4)]))
def test_sliding_mean_equals_native_window(spark, rows, shape):
    import datetime as dt

    from pyspark.sql import functions as F

    from eventide.operators import windows
    length, slide = shape
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(seconds=s), r) for s, r in rows]
    df = (spark.createDataFrame(data, "ts timestamp_ntz, reading int")
          .withColumn("day", F.date_format("ts", "yyyy-MM-dd")))
    ours = {(r["window_start"], r["day"]): r["mean"]
            for r in windows.sliding_mean(df, length, slide).collect()}
    native = {(r["s"], r["day"]): r["m"] for r in
              df.groupBy(F.window("ts", f"{length} seconds", f"{slide} seconds").start.alias("s"), "day")
              .agg(F.avg("reading").alias("m")).collect()}
    assert ours == native


def parse_int_ref(s: str):
    """``Integer.parseInt``: optional sign, ASCII digits, 32-bit range; else None."""
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return None
    v = int(s)
    return v if -2**31 <= v <= 2**31 - 1 else None


@SETTINGS
@given(st.lists(st.one_of(st.text(alphabet="+-0123456789 x\n\t", max_size=12),
                          st.integers(-2**33, 2**33).map(str)), min_size=1, max_size=60))
def test_lenient_int_matches_parse_int(spark, values):
    got = _eval(spark, values, text.strict_int("v", strict=False))
    assert got == [parse_int_ref(v) for v in values]
