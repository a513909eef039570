"""Load operators on small hand-made frames."""

import json

from notifyq.operators import load


def _frames(spark):
    dest = spark.createDataFrame([("N1", 10), ("N2", 20)], "notification_id string, latency_ms int")
    batch = spark.createDataFrame([("N2", 21), ("N3", 30), ("N4", None)], "notification_id string, latency_ms int")
    return dest, batch


def test_existing_new_and_union(spark):
    dest, batch = _frames(spark)
    assert sorted(r[0] for r in load.existing_ids(batch, dest).collect()) == ["N2"]
    assert sorted(r[0] for r in load.new_rows(batch, dest).collect()) == ["N3", "N4"]
    after = load.load_into(batch, dest)
    assert sorted(r[0] for r in after.collect()) == ["N1", "N2", "N3", "N4"]
    # The existing row wins: N2 keeps its stored value.
    assert {r[0]: r[1] for r in after.collect()}["N2"] == 20
    # Loading the same batch again inserts nothing.
    assert load.new_rows(batch, after).count() == 0


def test_load_audit_counts(spark):
    dest, batch = _frames(spark)
    a = load.load_audit(batch, dest, source="f.csv").first()
    assert (a.rows_in, a.rows_inserted, a.rows_already_present, a.destination_total) == (3, 2, 1, 4)
    assert a.cipher == "Fernet" and a.source_file == "f.csv"


def test_destination_coercions(spark):
    df = spark.createDataFrame([(" ", "C1", None, "true")], "post_id string, comment_id string, latency_ms string, seen string")
    r = load.destination_coercions(df).first()
    assert r.post_id is None and r.comment_id == "C1" and r.latency_ms == 0 and r.seen is True


def test_reject_payload_keeps_nulls_and_masks_ids(spark):
    from notifyq import schema as S

    cols = {c: None for c in S.RAW_COLUMNS}
    cols.update(notification_id="N9", user_id="U0002", source_user_id="U0003", latency_ms="abc")
    row = tuple(cols[c] for c in S.RAW_COLUMNS) + ("validate", "seen_not_boolean")
    schema = ", ".join(f"{c} string" for c in S.RAW_COLUMNS) + ", stage string, reject_reason string"
    out = load.reject_audit(spark.createDataFrame([row], schema)).first()
    payload = json.loads(out.payload)
    assert list(payload) == S.RAW_COLUMNS
    assert payload["user_id"] == "U***" and payload["source_user_id"] == "U***"
    assert payload["post_id"] is None and payload["latency_ms"] == "abc"
    full = load.reject_audit(spark.createDataFrame([row], schema), load.RejectPayloadOptions(mask_ids=False)).first()
    assert json.loads(full.payload)["user_id"] == "U0002"
