"""Raw notification rows derived from the driver's ``events`` table.

The derivation is the fixture specification: each of the 16 raw text columns is a
function of one event row, with anomalies injected at fixed residues of the event id
(FIXTURES.md, section 3). It is a projection only, so it runs as one narrow stage next
to the Parquet scan and scales with the events table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.session import spread_small_input


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _by_mod(e: Column, m: int, values: list[str]) -> Column:
    """values[e % m] as a CASE expression."""
    r = e % F.lit(m)
    expr = None
    for i, v in enumerate(values):
        expr = F.when(r == i, F.lit(v)) if expr is None else expr.when(r == i, F.lit(v))
    return expr


def raw_from_events(events: DataFrame) -> DataFrame:
    """events -> raw notifications: 16 nullable strings + row_ord + batch_id."""
    e = F.col("event_id")
    et = (
        F.when(F.col("event_type") == "click", F.lit("LIKE"))
        .when(F.col("event_type") == "view", F.lit("like "))
        .when(F.col("event_type") == "purchase", F.lit("COMMENT"))
        .when(F.col("event_type") == "signup", F.lit("FOLLOW"))
        .when(e % 5 == 0, F.lit("SHARE"))
        .otherwise(F.lit("LIKE"))
    )
    user = F.concat(F.lit("U"), _pad(F.col("user_id"), 4))
    cols = {
        "notification_id": F.when(e % 97 == 5, F.lit(None).cast("string"))
        .when(e % 101 == 7, F.concat(F.lit("N"), _pad(e - 1, 7)))
        .otherwise(F.concat(F.lit("N"), _pad(e, 7))),
        "event_id": F.concat(F.lit("E"), _pad(e, 7)),
        "event_type": et,
        "user_id": user,
        "source_user_id": F.when(e % 89 == 3, user)
        .when(e % 83 == 11, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("U"), _pad(F.col("user_id") + 1 + e % 149, 4))),
        "post_id": F.when((et == "FOLLOW") | (e % 61 == 2), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("P"), _pad(e % 50, 4))),
        "comment_id": F.when(
            (et == "COMMENT") & (e % 53 != 4), F.concat(F.lit("C"), _pad(e, 7))
        ),
        "created_at": F.when(e % 67 == 9, F.lit("2026/13/40 99:99:99"))
        .when(e % 71 == 13, F.lit("2027-01-01 10:00:00"))
        .when(e % 173 == 1, F.lit(None).cast("string"))
        .otherwise(F.date_trunc("second", F.col("ts")).cast("string")),
        "device": F.when(e % 79 == 17, F.lit("SMART_TV"))
        .when(e % 2 == 0, F.lit("MOBILE"))
        .otherwise(F.lit(" web")),
        "delivery_channel": F.when(e % 73 == 21, F.lit("SMS")).otherwise(
            _by_mod(e, 3, ["PUSH", "EMAIL", "IN_APP"])
        ),
        "priority": F.when(e % 59 == 8, F.lit("URGENT")).otherwise(
            _by_mod(e, 4, ["LOW", "MEDIUM", "HIGH", "medium"])
        ),
        "seen": F.when(e % 109 == 30, F.lit("maybe")).otherwise(
            _by_mod(e, 4, ["true", "FALSE", "1", "0"])
        ),
        "status": F.when(e % 107 == 40, F.lit("UNKNOWN"))
        .when(e % 10 < 7, F.lit("SENT"))
        .when(e % 10 < 9, F.lit("PENDING"))
        .otherwise(F.lit("FAILED")),
        "app_version": F.when(e % 103 == 6, F.lit(None).cast("string"))
        .when(e % 47 == 20, F.lit("0.9.0"))
        .otherwise(_by_mod(e, 4, ["1.0.0", "1.1.0", "1.2.0", "2.0.0"])),
        "country": F.when(e % 113 == 50, F.lit("US")).otherwise(
            _by_mod(e, 4, ["CL", "AR", "PE", "MX"])
        ),
        "latency_ms": F.when(e % 127 == 60, F.lit("-250"))
        .when(e % 131 == 70, F.lit("abc"))
        .when(e % 10 == 9, F.lit(None).cast("string"))
        .otherwise(F.floor(F.col("value") * 300).cast("bigint").cast("string")),
    }
    return events.select(
        *[cols[c].alias(c) for c in S.RAW_COLUMNS],
        e.cast("bigint").alias(S.ROW_ORD),
        F.date_format(F.col("ts"), "yyyyMMdd").alias(S.BATCH_ID),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events table, only the columns the notification rows use."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    return spread_small_input(events)


def raw_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 over the driver tables: the raw landing rows of every batch."""
    return raw_from_events(read_events(spark, sf_dir))
