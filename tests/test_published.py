"""Loads published as a whole, constraints before publication, the bucketed destination."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from notifyq import schema as S
from notifyq.functions.protect import generate_key
from notifyq.operators import constraints as C
from notifyq.operators import load
from notifyq.plans import runner
from notifyq.plans.queries import QUERIES
from notifyq.sources import published
from notifyq.sources.fixtures import raw_notifications


class Killed(RuntimeError):
    pass


def kill(*_):
    raise Killed


def raw_of(spark, newest: bool):
    raw = raw_notifications(spark, SF0001)
    last = raw.agg(F.max(S.BATCH_ID)).first()[0]
    return raw.where((F.col(S.BATCH_ID) == last) == newest)


def test_a_run_killed_before_its_commit_leaves_no_visible_row(spark, workdir, monkeypatch):
    root, key = f"{workdir}/t", generate_key()
    runner.run_batch(spark, raw_of(spark, False), root, key, run_id="r1", as_of=S.DEFAULT_AS_OF)
    before = runner.destination_rows(spark, root).count()
    kpis = {r.kpi: r.value for r in runner.stage_kpis(spark, root, "r1")}
    rejects = runner.rejected_rows(spark, root).count()

    commit = published.commit
    monkeypatch.setattr(published, "commit", kill)
    with pytest.raises(Killed):  # the rejects are written, their commit is not
        runner.run_batch(spark, raw_of(spark, True), root, key, run_id="r2", as_of=S.DEFAULT_AS_OF)
    assert runner.rejected_rows(spark, root).count() == rejects < spark.read.parquet(f"{root}/rejected").count()
    monkeypatch.setattr(published, "commit", lambda s, r, table, *a: kill() if table == "destination" else commit(s, r, table, *a))
    for _ in range(2):  # the rows are written, checked and audited, and not published
        with pytest.raises(Killed):
            runner.run_batch(spark, raw_of(spark, True), root, key, run_id="r2", as_of=S.DEFAULT_AS_OF)
    there = spark.read.parquet(f"{root}/destination")
    new = (there.count() - before) // 2
    assert new > 0 and there.count() == before + 2 * new
    assert runner.destination_rows(spark, root).count() == before
    assert {r.kpi: r.value for r in runner.stage_kpis(spark, root, "r1")} == kpis
    assert [r.run_id for r in runner.load_audits(spark, root).collect()] == ["r1"]

    monkeypatch.setattr(published, "commit", commit)
    done = runner.run_batch(spark, raw_of(spark, True), root, key, run_id="r2", as_of=S.DEFAULT_AS_OF)
    assert (done.rows_inserted, done.destination_total) == (new, before + new)
    rows = runner.destination_rows(spark, root)
    assert rows.count() == before + new == rows.select("notification_id").distinct().count()
    again = runner.run_batch(spark, raw_of(spark, True), root, key, run_id="r2", as_of=S.DEFAULT_AS_OF)
    assert again == done and runner.destination_rows(spark, root).count() == before + new

    gone = published.remove_unpublished(spark, root, "destination", f"{root}/destination")
    assert len(gone) == 2 and runner.destination_rows(spark, root).count() == before + new
    assert spark.read.parquet(f"{root}/destination").count() == before + new


def test_stored_load_inserts_the_rows_of_the_query_without_moving_the_destination(spark, workdir):
    root, key = f"{workdir}/t", generate_key()
    runner.run_batch(spark, raw_of(spark, False), root, key, run_id="r1", as_of=S.DEFAULT_AS_OF)
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")  # more than the table's buckets
    try:
        tagged, _ = runner.stage_clean_validate(spark, raw_notifications(spark, SF0001), root, "r2", as_of=S.DEFAULT_AS_OF)
        from notifyq.operators.validate import typed_valid

        batch = load.protect_ids(typed_valid(tagged), key)
        for rows in (load.new_rows(batch, runner.destination_rows(spark, root)),
                     batch.join(load.destination_ids(runner.destination_rows(spark, root)), load.ID, "left_anti")):
            # Texts to trim hold line breaks, which are no nodes.
            lines = [x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if re.match(r"[ :+-]*[A-Z]", x)]
            at = next(k for k, x in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x)
            indent = lambda x: len(x) - len(x.lstrip(" :+-"))
            depth, above = indent(lines[at]), []
            for line in reversed(lines[:at]):
                if indent(line) < depth:
                    depth = indent(line)
                    above.append(line)
            joined = next(k for k, x in enumerate(above) if "Join" in x)
            assert not any("Exchange" in x for x in above[:joined]), "\n".join(lines)
            assert "load_id" in lines[at].partition("PartitionFilters:")[2]
        audit = runner.stage_load(spark, root, "r2", key)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    want = {r.notification_id for r in QUERIES["idempotent_load"](spark, SF0001).collect()}
    got = {r.notification_id for r in runner.destination_rows(spark, root).where("run_id = 'r2'").collect()}
    assert got == want and audit.rows_inserted == len(want)
    total = {r.table_name: r.rows for r in QUERIES["table_counts"](spark, SF0001).collect()}
    assert runner.destination_rows(spark, root).count() == total["destination"] == audit.destination_total


def test_the_table_is_declared_again_over_its_folder(spark, workdir):
    root, key = f"{workdir}/t", generate_key()
    runner.run_batch(spark, raw_of(spark, False), root, key, run_id="r1", as_of=S.DEFAULT_AS_OF)
    rows = runner.destination_rows(spark, root).count()
    spark.sql(f"DROP TABLE {published.table_name(root + '/destination')}")  # as a new session finds it
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert runner.destination_rows(spark, root).count() == rows
        name = published.table_name(root + "/destination")
        assert "4" in [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Num Buckets"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_each_mandatory_column_is_tested(spark):
    for column in C.DESTINATION_NOT_NULL:
        row = spark.range(1).select(*[F.lit(None if c == column else "x").cast("string").alias(c) for c in C.DESTINATION_NOT_NULL])
        with pytest.raises(C.ConstraintError, match=f"{column} is not null: 1 rows"):
            C.enforce("destination", row, C.destination_constraints(), unique="notification_id")


def test_a_row_against_a_constraint_stops_the_load(spark, workdir, monkeypatch):
    root, key = f"{workdir}/t", generate_key()
    event = QUERIES["valid_rows"](spark, SF0001).where("batch_id < '20240120'").agg(F.min("event_id")).first()[0]
    protect = load.protect_ids
    lost = F.when(F.col("event_id") != event, F.col("user_id_enc"))
    monkeypatch.setattr(load, "protect_ids", lambda v, *a: protect(v, *a).withColumn("user_id_enc", lost))
    with pytest.raises(C.ConstraintError) as e:
        runner.run_batch(spark, raw_of(spark, False), root, key, run_id="r1", as_of=S.DEFAULT_AS_OF)
    assert e.value.counts == {"user_id_enc is not null": 1} and e.value.rows[0]["event_id"] == event
    assert runner.destination_rows(spark, root).count() == 0 and runner.load_audits(spark, root).count() == 0


def test_domain_and_unique(spark):
    rows = spark.createDataFrame([("a", "clean"), ("a", "clean"), ("b", "load"), (None, "clean"), (None, "clean")], "id string, stage string")
    with pytest.raises(C.ConstraintError) as e:
        C.enforce("t", rows, [C.domain("stage", ["clean", "validate"])], unique="id")
    assert e.value.counts == {"stage in (clean, validate)": 1, "id is unique": 2}
    assert {"id": "b", "stage": "load"} in e.value.rows and {"id": "a", "copies": 2} in e.value.rows
    ok = rows.where("stage = 'clean'").dropDuplicates(["id"])
    assert C.enforce("t", ok, [C.domain("stage", ["clean", "validate"])], unique="id") == 2
    assert C.enforce("t", ok.limit(0), C.not_null("id"), unique="id") == 0


def test_a_stage_that_does_not_reject_stops_the_rejects(spark, workdir, monkeypatch):
    audit = load.reject_audit
    monkeypatch.setattr(load, "reject_audit", lambda r: audit(r).withColumn("stage", F.lit("load")))
    root = f"{workdir}/t"
    with pytest.raises(C.ConstraintError, match="stage in"):
        runner.stage_clean_validate(spark, raw_of(spark, False), root, "r1", as_of=S.DEFAULT_AS_OF)
    assert runner.rejected_rows(spark, root).count() == 0


def test_payload_of_stored_rejects_is_a_variant_with_its_fields(spark, workdir):
    root = f"{workdir}/t"
    tagged, _ = runner.stage_clean_validate(spark, raw_notifications(spark, SF0001), root, "r1", as_of=S.DEFAULT_AS_OF)
    rows = runner.rejected_rows(spark, root)
    assert rows.schema["payload"].dataType.simpleString() == "variant"
    got = {(r.stage, r.country): r.rows for r in load.payload_counts(rows, "country").collect()}
    want = {(r.stage, r.country): r.rows for r in QUERIES["reject_payload_counts"](spark, SF0001).collect()}
    assert got == want and sum(got.values()) == 336
    ids = rows.select(F.variant_get("payload", "$.user_id", "string").alias("u")).where("u IS NOT NULL")
    assert ids.where("u NOT LIKE '_***'").count() == 0
