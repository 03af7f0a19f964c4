import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, event, messages
from tidemark.operators.quality import dlq_depth, ingest_stats
from tidemark.operators.validation import decode_messages, redrive, split_valid, validate
from tidemark.sources.feature_tables import load_event_lines, load_events

NOW = "2024-02-05 00:00:00"


def _errors(spark, values):
    rows = validate(decode_messages(messages(spark, values))).orderBy("offset").collect()
    return [r.errors for r in rows]


def test_valid_event_and_defaults(spark):
    valid, dead = split_valid(decode_messages(messages(spark, [event()])), NOW)
    row = valid.first()
    assert row.event_timestamp == T0
    assert (row.merchant_category, row.is_online, row.card_present, row.country_code) == (
        "unknown",
        False,
        True,
        "US",
    )
    assert row.latitude is None
    assert dead.count() == 0


@pytest.mark.parametrize(
    "change, named",
    [
        ({"amount": -10.0}, "amount"),
        ({"amount": "NaN"}, "amount"),
        ({"amount": "ten"}, "amount"),
        ({"amount": ...}, "amount"),
        ({"transaction_type": "invalid_type"}, "transaction_type"),
        ({"transaction_type": "Purchase"}, "transaction_type"),
        ({"latitude": 91.0}, "latitude"),
        ({"latitude": "north"}, "latitude"),
        ({"longitude": -180.5}, "longitude"),
        ({"account_id": ...}, "account_id"),
        ({"event_id": None}, "event_id"),
        ({"merchant_id": ...}, "merchant_id"),
        ({"timestamp": "soon"}, "timestamp"),
        ({"timestamp": ...}, "timestamp"),
        ({"country_code": "USAX"}, "country_code"),
        ({"is_online": "perhaps"}, "is_online"),
        ({"card_present": "perhaps"}, "card_present"),
    ],
)
def test_each_rule(spark, change, named):
    assert _errors(spark, [event(**change)]) == [[named]]


def test_edges_that_pass(spark):
    values = [
        event(amount=0),
        event(amount="12.5"),
        event(latitude=90.0, longitude=-180.0),
        event(country_code="USA"),
        event(transaction_type="refund"),
        event(timestamp="2024-01-15T10:30:00+02:00"),
        event(timestamp="2024-01-15T10:30:00"),
        event(extra_field=1),
    ]
    assert _errors(spark, values) == [[]] * len(values)


def test_time_zones_become_utc(spark):
    values = [event(timestamp="2024-01-15T10:30:00+02:00"), event(timestamp="2024-01-15T10:30:00.123456Z")]
    rows = decode_messages(messages(spark, values)).orderBy("offset").collect()
    assert [str(r.event_timestamp) for r in rows] == [
        "2024-01-15 08:30:00",
        "2024-01-15 10:30:00.123456",
    ]


def test_malformed_json_and_null_value(spark):
    assert _errors(spark, ['{"event_id": ', "not json", None, "[1]"]) == [["malformed"]] * 4


def test_several_errors_in_field_order(spark):
    assert _errors(spark, [event(amount=-1, latitude=100.0, account_id=...)]) == [
        ["account_id", "amount", "latitude"]
    ]


def test_envelope(spark):
    raw = [event(), event(amount=-5), '{"cut": ']
    valid, dead = split_valid(decode_messages(messages(spark, raw)), NOW)
    assert valid.count() == 1
    rows = dead.orderBy("source_offset").collect()
    assert [r.source_offset for r in rows] == [1, 2]
    assert rows[0].error_reason == "Validation error: amount"
    assert rows[1].error_reason == "Validation error: malformed"
    assert rows[1].original_message == '{"cut": '
    assert rows[0].source_topic == "topic" and rows[0].source_partition == 1
    assert str(rows[0].failed_at) == NOW
    assert rows[0].metadata == {}


def test_redrive_after_repair(spark):
    _, dead = split_valid(decode_messages(messages(spark, [event(amount=-5)])), NOW)
    assert redrive(dead).first().errors == ["amount"]
    repaired = dead.withColumn(
        "original_message", F.regexp_replace("original_message", "-5", "5")
    )
    row = redrive(repaired).first()
    assert row.errors == [] and row.amount == 5.0 and row.offset == 0


def test_stats_and_depth(spark):
    raw = [event(), event(), event(amount=-5), event(latitude=95), event(amount=-1)]
    valid, dead = split_valid(decode_messages(messages(spark, raw)), NOW)
    stats = ingest_stats(valid, dead).first()
    assert (stats.processed, stats.failed, stats.dlq_routed) == (2, 0, 3)
    depth = {r.error_reason: (r.depth, r.alert) for r in dlq_depth(dead, 1).collect()}
    assert depth == {
        "Validation error: amount": (2, True),
        "Validation error: latitude": (1, False),
    }


def test_event_files_skip_bad_rows(spark, tmp_path):
    import json

    good, bad = event(event_id="e1"), event(event_id="e2", amount=-1)
    (tmp_path / "array.json").write_text(json.dumps([good, bad, event(event_id="e3")]))
    rows = load_events(spark, str(tmp_path / "array.json"), True).orderBy("event_id").collect()
    assert [r.event_id for r in rows] == ["e1", "e3"]
    lines = "\n".join([json.dumps(good), "{broken", json.dumps(bad), ""])
    (tmp_path / "lines.json").write_text(lines)
    rows = load_event_lines(spark, str(tmp_path / "lines.json")).collect()
    assert [r.event_id for r in rows] == ["e1"]
    assert rows[0].country_code == "US"
