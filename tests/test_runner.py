"""End to end through CSV files: read (S1), run every stage, write the tables, rerun."""

import os

from pyspark.sql import functions as F

from conftest import SF0001
from notifyq import schema as S
from notifyq.functions.protect import generate_key
from notifyq.plans.runner import Tables, latest_kpis, reset_tables, run_batch
from notifyq.sources.files import latest_batch_id, read_raw_csv
from notifyq.sources.fixtures import raw_notifications
from notifyq.sources.manifest import file_manifest


def _write_landing(spark, workdir):
    landing = os.path.join(workdir, "landing")
    raw = raw_notifications(spark, SF0001).orderBy("row_ord")
    # Two landing files named by batch (sortable), written in row order.
    for name, cond in (("notifications_20240115", F.col("batch_id") <= "20240115"),
                       ("notifications_20240130", F.col("batch_id") > "20240115")):
        tmp = os.path.join(workdir, "tmp_" + name)
        raw.where(cond).select(*S.RAW_COLUMNS).coalesce(1).write.option("header", True).csv(tmp)
        part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
        os.makedirs(landing, exist_ok=True)
        os.rename(os.path.join(tmp, part), os.path.join(landing, name + ".csv"))
    return landing


def test_csv_read_keeps_na_text_and_order(spark, workdir):
    p = os.path.join(workdir, "x.csv")
    with open(p, "w") as f:
        f.write(",".join(S.RAW_COLUMNS) + "\n")
        f.write("N1,NA,null," + ",".join([""] * 13) + "\n")
        f.write("N2,E2,LIKE," + ",".join([""] * 13) + "\n")
    df = read_raw_csv(spark, p).orderBy("row_ord").collect()
    assert df[0].event_id == "NA" and df[0].event_type == "null" and df[0].user_id is None
    assert [r.notification_id for r in df] == ["N1", "N2"]
    assert df[0].batch_id == "x"


def test_run_batch_end_to_end_and_idempotent(spark, workdir):
    landing = _write_landing(spark, workdir)
    root = os.path.join(workdir, "tables")
    key = generate_key()
    raw = read_raw_csv(spark, landing)
    assert latest_batch_id(raw).first()[0] == "notifications_20240130"
    s1 = run_batch(spark, raw, root, key, run_id="r1")
    assert (s1.rows_in, s1.clean_removed, s1.validation_rejected) == (1000, 24, 312)
    assert (s1.rows_inserted, s1.rows_already_present, s1.destination_total) == (664, 0, 664)
    s2 = run_batch(spark, read_raw_csv(spark, landing), root, key, run_id="r2")
    assert (s2.rows_inserted, s2.rows_already_present, s2.destination_total) == (0, 664, 664)
    t = Tables(root)
    assert spark.read.parquet(t.rejected).count() == 336, "rejects are not appended twice"
    assert spark.read.parquet(t.load_audit).count() == 2
    dest = spark.read.parquet(t.destination)
    assert dest.count() == 664 and "user_id" not in dest.columns
    lk = {r.kpi: r for r in latest_kpis(spark, root).collect()}
    assert lk["avg_latency_ms"].run_id == "r2" and lk["avg_latency_ms"].value == 15347.01
    m = file_manifest(spark, landing).orderBy("source_file").collect()
    assert [r.rows for r in m] == [sum(1 for _ in open(os.path.join(landing, r.source_file))) - 1 for r in m]
    assert all(len(r.sha256) == 64 for r in m)
    reset_tables(spark, root)
    assert spark.read.parquet(t.destination).count() == 0


def test_land_raw_partitions_by_batch(spark, workdir):
    from notifyq.sources.manifest import land_raw

    landing = _write_landing(spark, workdir)
    out = os.path.join(workdir, "raw_table")
    land_raw(read_raw_csv(spark, landing).drop("row_ord"), out)
    parts = sorted(d for d in os.listdir(out) if d.startswith("batch_id="))
    assert parts == ["batch_id=notifications_20240115", "batch_id=notifications_20240130"]
    assert spark.read.parquet(out).count() == 1000


def test_run_batch_on_an_empty_file(spark, workdir):
    p = os.path.join(workdir, "landing", "notifications_20240201.csv")
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as f:
        f.write(",".join(S.RAW_COLUMNS) + "\n")
    s = run_batch(spark, read_raw_csv(spark, os.path.dirname(p)), os.path.join(workdir, "t"), generate_key(), run_id="e")
    assert (s.rows_in, s.valid, s.rows_inserted, s.destination_total) == (0, 0, 0, 0)


def test_retried_run_replaces_its_own_run_rows(spark, workdir):
    landing = _write_landing(spark, workdir)
    root = os.path.join(workdir, "tables")
    key = generate_key()
    for _ in range(2):  # the same run id twice, as after a driver failure
        run_batch(spark, read_raw_csv(spark, landing), root, key, run_id="r1")
    t = Tables(root)
    audit = spark.read.parquet(t.load_audit).collect()
    assert [(r.rows_inserted, r.rows_already_present, r.destination_total) for r in audit] == [(664, 0, 664)]
    assert spark.read.parquet(t.kpis).count() == 5
    assert spark.read.parquet(t.destination).count() == 664


def test_command_line_run_and_kpis(spark, workdir, capsys):
    from notifyq.__main__ import main

    landing = _write_landing(spark, workdir)
    key_file = os.path.join(workdir, "key")
    with open(key_file, "w") as f:
        f.write(generate_key())
    root = os.path.join(workdir, "cli")
    assert main(["run", "--landing", landing, "--root", root, "--key-file", key_file, "--run-id", "c1"]) == 0
    out = capsys.readouterr().out
    assert "rows_inserted: 664" in out and "kpis_met: 2/5" in out
    manifest = spark.read.parquet(Tables(root).manifest)
    assert manifest.agg(F.sum("rows")).first()[0] == spark.read.parquet(Tables(root).raw).count() == 1000
    newest = os.path.join(workdir, "newest")
    assert main(["run", "--landing", landing, "--root", newest, "--key-file", key_file, "--run-id", "c2", "--newest"]) == 0
    held = spark.read.parquet(Tables(newest).manifest).collect()
    assert [r.source_file for r in held] == ["notifications_20240130.csv"]
    assert {r.batch_id for r in spark.read.parquet(Tables(newest).raw).collect()} == {"notifications_20240130"}
    capsys.readouterr()
    assert main(["kpis", "--root", root]) == 0
    assert "p95_latency_ms" in capsys.readouterr().out


def test_stages_one_at_a_time_on_stored_inputs(spark, workdir):
    from notifyq.plans.runner import stage_clean_validate, stage_kpis, stage_load

    landing = _write_landing(spark, workdir)
    root = os.path.join(workdir, "stages")
    key = generate_key()
    _, st = stage_clean_validate(spark, read_raw_csv(spark, landing), root, "s1")
    assert (st["rows_in"], st["clean_removed"], st["validation_rejected"], st["valid"]) == (1000, 24, 312, 664)
    audit = stage_load(spark, root, "s1", key)  # reads the stored tagged table
    assert (audit.rows_in, audit.rows_inserted, audit.destination_total) == (664, 664, 664)
    rows = {r.kpi: r for r in stage_kpis(spark, root, "s1")}  # recomputes counts from storage
    assert rows["avg_latency_ms"].value == 15347.01 and rows["reject_rate_pct"].value == 33.6
