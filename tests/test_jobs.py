"""The nine job compositions equal the registered queries they are built from."""

from conftest import SF01
from eventide.plans import jobs
from eventide.sources.records import documents_envelope, events_envelope

import __spark_entry__ as entry


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_jobs_equal_registered_queries(spark):
    q = entry.queries()
    docs = documents_envelope(spark, SF01)
    assert _same(jobs.j1_word_count(docs), q["word_count_per_batch"](spark, SF01))
    assert _same(jobs.j2_token_pairs(docs), q["token_pairs"](spark, SF01))
    assert _same(jobs.j3_temperature_alert(events_envelope(spark, SF01, "reading")),
                 q["alert_rows"](spark, SF01))
    assert _same(jobs.j4_running_totals(docs), q["running_total"](spark, SF01))
    j5 = jobs.j5_pv_uv(events_envelope(spark, SF01, "log"))
    assert _same(j5["pv"], q["pv_rollup"](spark, SF01))
    assert _same(j5["uv"], q["uv_by_day"](spark, SF01))
    assert _same(j5["metrics"], q["metric_keys"](spark, SF01))
    j6 = jobs.j6_sorted_word_count(docs).collect()
    assert all((a["batch_id"], -a["n"], a["word"]) <= (b["batch_id"], -b["n"], b["word"])
               for a, b in zip(j6, j6[1:]))
    assert _same(jobs.j7_value_count(events_envelope(spark, SF01, "type")),
                 q["value_count_per_batch"](spark, SF01))
    j8 = jobs.j8_delimited_events(events_envelope(spark, SF01, "fields"))
    assert _same(j8["fields"], q["split_three_fields"](spark, SF01))
    assert _same(j8["sizes"], q["batch_size"](spark, SF01))
    j9 = jobs.j9_offset_report(events_envelope(spark, SF01))
    assert _same(j9["ranges"], q["offset_ranges"](spark, SF01))
    assert _same(j9["partitions"], q["partitions_per_batch"](spark, SF01))
