"""Hot keys: one id holding a third of the rows, a third of the ids null."""

from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.operators.clean import normalise, tag_clean


def test_hot_and_null_ids(spark):
    n = 3000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("N"), F.col("id").cast("string"))).alias("notification_id"),
        F.col("id").alias("row_ord"),
    )
    cols = [(F.lit(None).cast("string") if c == "created_at" else F.lit("x")).alias(c)
            for c in S.RAW_COLUMNS if c != "notification_id"]
    raw = base.select("notification_id", *cols, "row_ord", F.lit("b").alias("batch_id")).select(*S.RAW_COLUMNS, "row_ord", "batch_id")
    t = tag_clean(normalise(raw))
    dup = t.where(F.col("clean_reason") == "dup_id")
    assert dup.count() == n // 3 - 1
    first_hot = t.where((F.col("notification_id") == "HOT") & F.col("clean_reason").isNull()).select("row_ord").collect()
    assert [r.row_ord for r in first_hot] == [0]
    assert t.where(F.col("notification_id").isNull() & (F.col("clean_reason") == "dup_id")).count() == 0
    assert t.where(F.col("notification_id") == "HOT").select(F.max("id_copies")).first()[0] == n // 3


def test_dedup_is_independent_of_partitioning(spark):
    from conftest import SF0001
    from notifyq.sources.fixtures import raw_notifications

    raw = raw_notifications(spark, SF0001)
    a = {(r.row_ord, r.clean_reason) for r in tag_clean(normalise(raw)).collect()}
    b = {(r.row_ord, r.clean_reason) for r in tag_clean(normalise(raw.repartition(7, F.rand(1)))).collect()}
    assert a == b
