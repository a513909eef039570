"""Single-row checks of every validation rule (V1-V21) and the clean rules."""

import pytest
from pyspark.sql import types as T

from notifyq import schema as S
from notifyq.operators.clean import normalise, tag_clean
from notifyq.operators.validate import tag_validation, typed_valid

SCHEMA = T.StructType(
    S.RAW_SCHEMA.fields + [T.StructField("row_ord", T.LongType()), T.StructField("batch_id", T.StringType())]
)

GOOD = {
    "notification_id": "N1", "event_id": "E1", "event_type": "LIKE", "user_id": "U1",
    "source_user_id": "U2", "post_id": "P1", "comment_id": None,
    "created_at": "2026-05-03 12:00:00", "device": "MOBILE", "delivery_channel": "PUSH",
    "priority": "LOW", "seen": "true", "status": "SENT", "app_version": "1.0.0",
    "country": "CL", "latency_ms": "100",
}


def _reason(spark, **changes):
    row = dict(GOOD, **changes)
    df = spark.createDataFrame([tuple(row[c] for c in S.RAW_COLUMNS) + (1, "b")], SCHEMA)
    return tag_validation(tag_clean(normalise(df))).select("reject_reason").first()[0]


CASES = [
    ({}, None),
    ({"notification_id": "  "}, "notification_id_missing"),
    ({"event_id": None}, "event_id_missing"),
    ({"user_id": ""}, "user_id_missing"),
    ({"source_user_id": None}, "source_user_id_missing"),
    ({"app_version": None}, "app_version_missing"),
    ({"event_type": "SHARE"}, "event_type_domain"),
    ({"event_type": " like\t"}, None),
    ({"device": "SMART_TV"}, "device_domain"),
    ({"device": " web"}, None),
    ({"delivery_channel": "SMS"}, "delivery_channel_domain"),
    ({"priority": "URGENT"}, "priority_domain"),
    ({"status": "UNKNOWN"}, "status_domain"),
    ({"country": "US"}, "country_domain"),
    ({"created_at": None}, "created_at_missing"),
    ({"created_at": "2027-01-01 10:00:00"}, "created_at_future"),
    ({"seen": "maybe"}, "seen_not_boolean"),
    ({"seen": "FALSE"}, None),
    ({"seen": "0"}, None),
    ({"latency_ms": "-250"}, "latency_negative"),
    ({"latency_ms": "-0.5"}, None),
    ({"latency_ms": "abc"}, None),
    ({"source_user_id": "U1"}, "self_event"),
    ({"event_type": "COMMENT", "comment_id": None}, "comment_id_required"),
    ({"event_type": "COMMENT", "comment_id": "C1", "post_id": None}, "post_id_required"),
    ({"event_type": "FOLLOW", "post_id": None}, None),
    ({"delivery_channel": "EMAIL", "created_at": "2026-05-03 23:00:00"}, "email_quiet_hours"),
    ({"delivery_channel": "EMAIL", "created_at": "2026-05-03 06:59:59"}, "email_quiet_hours"),
    ({"delivery_channel": "EMAIL", "created_at": "2026-05-03 07:00:00"}, None),
    ({"event_type": "FOLLOW", "post_id": None, "priority": "HIGH"}, "follow_high_priority"),
    ({"app_version": "0.9.0"}, "sent_app_version_too_old"),
    ({"app_version": "0.9.0", "status": "PENDING"}, None),
    ({"app_version": "x.1"}, None),
    ({"created_at": "2026/13/40 99:99:99"}, "bad_ts"),
    ({"created_at": ""}, "bad_ts"),
    ({"created_at": "2026-5-3 1:2:3"}, None),
    ({"created_at": "2026-02-30 10:00:00"}, "bad_ts"),
]


@pytest.mark.parametrize("changes,expected", CASES)
def test_rule(spark, changes, expected):
    assert _reason(spark, **changes) == expected


def test_reasons_joined_in_rule_order(spark):
    r = _reason(spark, notification_id=None, country="US", seen="x")
    assert r == "notification_id_missing; country_domain; seen_not_boolean"


def test_dedup_keeps_first_in_row_order_and_ignores_null_ids(spark):
    rows = [
        (dict(GOOD, notification_id="N1"), 3),
        (dict(GOOD, notification_id="N1"), 1),
        (dict(GOOD, notification_id="N1", created_at="bad"), 2),
        (dict(GOOD, notification_id=None), 4),
        (dict(GOOD, notification_id=None), 5),
    ]
    schema = SCHEMA
    df = spark.createDataFrame([tuple(r[c] for c in S.RAW_COLUMNS) + (o, "b") for r, o in rows], schema)
    out = {r.row_ord: r.clean_reason for r in tag_clean(normalise(df)).collect()}
    assert out == {1: None, 2: "dup_id", 3: "dup_id", 4: None, 5: None}


def test_typed_valid_output(spark):
    schema = SCHEMA
    row = dict(GOOD, latency_ms="12.9", seen="1", post_id="  ")
    row["event_type"] = "FOLLOW"
    df = spark.createDataFrame([tuple(row[c] for c in S.RAW_COLUMNS) + (1, "b")], schema)
    v = typed_valid(tag_validation(tag_clean(normalise(df)))).first()
    assert v.latency_ms == 12 and v.seen is True and v.post_id is None
    assert str(v.created_at) == "2026-05-03 12:00:00"
