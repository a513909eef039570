"""The operational path on CSV files: values, rejects and manifest from Python's csv and int."""

import csv
import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.functions.protect import generate_key
from notifyq.plans import runner
from notifyq.sources.files import read_raw_csv
from notifyq.sources.manifest import file_manifest

ROW = {
    "notification_id": "N1", "event_id": "E1", "user_id": "U1", "source_user_id": "U2", "event_type": "LIKE", "post_id": "P1",
    "comment_id": "", "created_at": "2025-03-01 12:00:00", "device": "IOS", "delivery_channel": "PUSH", "priority": "LOW",
    "seen": "true", "status": "SENT", "app_version": "3.1", "country": "US", "latency_ms": "5",
}


def write(path, rows, columns=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, columns or S.RAW_COLUMNS)
        out.writeheader()
        out.writerows({**{c: "" for c in S.RAW_COLUMNS}, **ROW, **r} for r in rows)


def stored_rejects(spark, root):
    rows = runner.read_or_empty(spark, runner.Tables(root).rejected, runner.REJECT_SCHEMA)
    return sorted(r.notification_id for r in rows.collect())


def test_rejects_of_files_of_one_name_are_kept_once(spark, workdir):
    root, key = f"{workdir}/t", generate_key()
    bad = {"device": "TOASTER"}
    write(f"{workdir}/x/n1.csv", [{**bad, "notification_id": "N1"}])
    write(f"{workdir}/y/n1.csv", [{**bad, "notification_id": "N7"}, {**bad, "notification_id": "N7", "event_id": "E9"}])
    for run, folder in (("a", "x"), ("b", "y"), ("c", "x")):
        runner.run_batch(spark, read_raw_csv(spark, f"{workdir}/{folder}"), root, key, run_id=run)
    assert stored_rejects(spark, root) == ["N1", "N7", "N7"]
    for k in range(5):  # more files in the folder move rows to other tasks and positions
        write(f"{workdir}/x/a{k}.csv", [{**bad, "notification_id": f"M{k}"}])
    runner.run_batch(spark, read_raw_csv(spark, f"{workdir}/x"), root, key, run_id="d")
    assert stored_rejects(spark, root) == ["M0", "M1", "M2", "M3", "M4", "N1", "N7", "N7"]


def test_latency_beyond_int_and_the_clock(spark, workdir):
    day = lambda n: (dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=n)).strftime("%Y-%m-%d %H:%M:%S")
    values = ["-3000000000", "3000000000", "-0.5", "-1", "7"]
    rows = [{"notification_id": f"L{k}", "latency_ms": v} for k, v in enumerate(values)]
    rows += [{"notification_id": "PAST", "created_at": day(-1)}, {"notification_id": "FUTURE", "created_at": day(2)}]
    write(f"{workdir}/in/n.csv", rows)
    tagged, _ = runner.stage_clean_validate(spark, read_raw_csv(spark, f"{workdir}/in"), f"{workdir}/t", "r")
    reason = {r.notification_id: r.reject_reason or "" for r in tagged.collect()}
    for k, v in enumerate(values):
        assert ("latency_negative" in reason[f"L{k}"]) == (int(float(v)) < 0)
    assert "created_at_future" in reason["FUTURE"] and "created_at_future" not in reason["PAST"]
    from notifyq.operators.validate import typed_valid

    got = {r.notification_id: r.latency_ms for r in typed_valid(tagged.withColumn("reject_reason", F.lit(None).cast("string"))).collect()}
    assert [got[f"L{k}"] for k in range(5)] == [int(float(v)) for v in values]


def test_csv_dialect(spark, workdir):
    write(f"{workdir}/q/n.csv", [{"event_id": 'a "b" c'}, {"event_id": "two\nlines"}])
    got = read_raw_csv(spark, f"{workdir}/q", multi_line=True).collect()
    assert sorted(r.event_id for r in got) == ['a "b" c', "two\nlines"]
    columns = list(S.RAW_COLUMNS)
    i, j = columns.index("user_id"), columns.index("source_user_id")
    columns[i], columns[j] = columns[j], columns[i]
    write(f"{workdir}/swapped/n.csv", [{}], columns)
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, f"{workdir}/swapped").collect()


def test_manifest_tells_files_of_one_name_apart(spark, workdir):
    write(f"{workdir}/x/n1.csv", [{}])
    write(f"{workdir}/y/n1.csv", [{}, {"notification_id": "N2"}])
    got = file_manifest(spark, [f"{workdir}/x", f"{workdir}/y"], paths=True).collect()
    for r in got:
        with open(r.path.removeprefix("file:").replace("///", "/"), "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == r.sha256
    assert sorted((r.source_file, r.rows, r.lines) for r in got) == [("n1.csv", 1, 2), ("n1.csv", 2, 3)]
