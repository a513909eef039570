"""Physical-plan properties that matter at scale."""

import os

from pyspark.sql import functions as F

from conftest import SF0001
from notifyq.operators import load
from notifyq.plans.queries import QUERIES, make_run


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tagging_uses_no_window_and_prunes_the_scan(spark):
    plan = _plan(make_run(spark, SF0001).tagged)
    assert "Window" not in plan, "dedup must not sort a whole id group in one task"
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans and all("props" not in ln for ln in scans), "unused columns reach the scan"


def test_destination_side_of_the_load_reads_only_the_key(spark, workdir):
    run = make_run(spark, SF0001)
    path = os.path.join(workdir, "dest")
    run.prior_destination.write.parquet(path)
    dest = spark.read.parquet(path)
    plan = _plan(load.new_rows(run.protected_valid, dest))
    dest_scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "dest" in ln]
    assert dest_scans and all("ReadSchema: struct<notification_id:string>" in ln for ln in dest_scans)


def test_few_incoming_ids_leave_a_large_destination_in_place(spark, workdir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        ids = F.concat(F.lit("N"), F.col("id").cast("string")).alias("notification_id")
        spark.range(300_000).select(ids, F.lit("x" * 20).alias("device")).write.parquet(f"{workdir}/dest")
        spark.range(299_950, 300_050).select(ids, F.lit("y").alias("device")).write.parquet(f"{workdir}/batch")
        batch, dest = spark.read.parquet(f"{workdir}/batch"), spark.read.parquet(f"{workdir}/dest")
        new = load.new_rows(batch, dest)
        assert new.count() == 50
        lines = _plan(new).splitlines()
        scan = next(k for k, ln in enumerate(lines) if "FileScan" in ln and "/dest" in ln)
        indent = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
        above, depth = [], indent(lines[scan])
        for ln in reversed(lines[:scan]):
            if indent(ln) < depth:
                depth = indent(ln)
                above.append(ln)
        joined = next(k for k, ln in enumerate(above) if "Join" in ln)
        assert "BroadcastHashJoin" in above[joined] and not any("Exchange" in ln for ln in above[:joined])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_cartesian_products_in_registered_queries(spark):
    skip = {"model_comparison", "best_model", "confusion_matrix", "roc_points", "scored_rows",
            "stratified_split", "class_weights", "file_manifest"}
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        plan = _plan(fn(spark, SF0001))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_skewed_id_join_is_split_by_aqe(spark):
    """With a hot id and small skew thresholds, AQE splits the probe side of the dedup
    join instead of giving the hot partition to one task."""
    from notifyq import schema as S
    from notifyq.operators.clean import normalise, tag_clean

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 20000
        base = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("N"), F.col("id").cast("string"))).alias("notification_id"),
            F.col("id").alias("row_ord"),
        )
        cols = [F.lit("x").alias(c) for c in S.RAW_COLUMNS if c != "notification_id"]
        raw = base.select("notification_id", *cols, "row_ord", F.lit("b").alias("batch_id")).select(*S.RAW_COLUMNS, "row_ord", "batch_id")
        t = tag_clean(normalise(raw))
        assert t.where(F.col("clean_reason") == "dup_id").count() == (n + 2) // 3 - 1
        t.collect()  # runs this Dataset's own plan, so its adaptive plan is final
        plan = t._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_spreading_only_touches_single_split_inputs(spark, workdir):
    from notifyq.session import spread_small_input

    cores = spark.sparkContext.defaultParallelism
    many = os.path.join(workdir, "many")
    spark.range(0, 10000, 1, cores * 2).write.parquet(many)
    wide = spark.read.parquet(many)
    assert wide.rdd.getNumPartitions() >= cores
    assert spread_small_input(wide) is wide  # large inputs: no extra shuffle
    one = os.path.join(workdir, "one")
    spark.range(0, 10000, 1, 1).write.parquet(one)
    small = spark.read.parquet(one)
    assert spread_small_input(small).rdd.getNumPartitions() == cores
