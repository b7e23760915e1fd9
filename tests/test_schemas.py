"""Schema contract: operator outputs have the declared names and types."""

import os

from conftest import SF01
from eventide import schemas
from eventide.operators import logs, offsets, tokens, values, windows
from eventide.sources.records import documents_envelope, events_envelope
from eventide.streaming.sources import replay_records, write_replay_log


def fields(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_replayed_envelope_matches_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    write_replay_log(events_envelope(spark, SF01, keep=()).where("batch_id = 0"), path, 1)
    assert fields(replay_records(spark, path).schema) == fields(schemas.ENVELOPE)


def test_operator_outputs_match_schemas(spark):
    recs = events_envelope(spark, SF01, keep=())
    assert fields(offsets.offset_ranges(recs).schema) == fields(schemas.OFFSET_RANGE)
    parsed = logs.parse_log(events_envelope(spark, SF01, "log", keep=()))
    assert fields(parsed.schema) == fields(schemas.PARSED_LOG)
    reads = values.readings(events_envelope(spark, SF01, "reading"))
    assert fields(windows.alert_rows(windows.sliding_mean(reads)).schema) == fields(schemas.ALERT_ROW)
    totals = tokens.running_total(tokens.tokenize(documents_envelope(spark, SF01)))
    assert fields(totals.schema) == fields(schemas.WORD_TOTAL)
    ledger = offsets.ledger_update(offsets.empty_ledger(spark), offsets.offset_ranges(recs), "m", "g")
    assert fields(ledger.schema) == fields(schemas.LEDGER)
