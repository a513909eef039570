"""An anomaly catalogue file joined with the rows of its landing file."""

import json

from notifyq import schema as S
from notifyq.operators.anomalies import catalogue_outcome, read_catalogue
from notifyq.plans.run import Run
from notifyq.sources.files import read_raw_csv
from test_operational import ROW, write

GOOD = {"device": "MOBILE", "country": "CL", "app_version": "1.0.0"}
#: (injected values, name in the catalogue, code that must be among the reasons).
CASES = [
    ({"notification_id": "N003"}, "repeated id", S.CLEAN_DUP),
    ({"event_type": "SHARE"}, "event type outside the domain", "event_type_domain"),
    ({"created_at": "2026/13/40 99:99:99"}, "impossible timestamp", S.CLEAN_BAD_TS),
    ({"created_at": "2031-01-01 10:00:00"}, "future timestamp", "created_at_future"),
    ({"source_user_id": ""}, "no source user", "source_user_id_missing"),
    ({"user_id": "U7", "source_user_id": "U7"}, "self event", "self_event"),
    ({"device": "FRIDGE"}, "device outside the domain", "device_domain"),
    ({"delivery_channel": "SMS"}, "channel outside the domain", "delivery_channel_domain"),
    ({"latency_ms": "-250"}, "negative latency", "latency_negative"),
    ({"event_type": "COMMENT"}, "comment without id", "comment_id_required"),
    ({"seen": "maybe"}, "seen is no boolean", "seen_not_boolean"),
    ({"notification_id": ""}, "no id", "notification_id_missing"),
]


def test_every_catalogued_anomaly_is_found_on_its_line(spark, workdir):
    rows = [{**GOOD, "notification_id": f"N{k:03d}"} for k in range(60)]
    catalogue = []
    for k, (values, name, _) in enumerate(CASES):
        at = 7 + 4 * k
        rows[at] = {**rows[at], **values}
        entry = {"row_number_csv": at + 2, "notification_id": {**ROW, **rows[at]}["notification_id"]}
        catalogue.append({**entry, "issue" if k % 2 else "tipo_anomalia": name})
    catalogue.append({"row_number_csv": 999, "notification_id": "GONE", "issue": "beyond the file"})
    write(f"{workdir}/in/n.csv", rows)
    with open(f"{workdir}/catalogue.json", "w") as f:
        json.dump(catalogue, f, indent=2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")  # a file of several splits
    try:
        raw = read_raw_csv(spark, f"{workdir}/in")
        assert raw.rdd.getNumPartitions() > 1
        got = {r.line: r for r in catalogue_outcome(read_catalogue(spark, f"{workdir}/catalogue.json"), Run(raw).tagged).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == len(catalogue)
    for entry, (_, name, code) in zip(catalogue, CASES):
        r = got[entry["row_number_csv"]]
        assert r.anomaly == name and r.found_id == r.notification_id and r.rejected
        assert code in r.reject_reason.split("; ")
    assert (got[999].found_id, got[999].rejected) == (None, False)
