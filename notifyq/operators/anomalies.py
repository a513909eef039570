"""Anomaly catalogue vs. rejects (S8, J4, re-aimed).

The data generator documents which anomaly it injected into which row. Such a catalogue
file is read and joined with the tagged rows of its landing file on the line number
(``read_catalogue``, ``catalogue_outcome``): was each row rejected, and by which rule? For the
driver tables the catalogue is derived from ``events`` with the generator's own rules
(FIXTURES.md section 3), independently of the pipeline, and left-joined to the tagged rows
on the row number: for each anomaly, how many rows carry it, how many were rejected at all,
and how many were rejected with the expected reason code. A catalogue row's expected code
can be missed legitimately when an earlier stage already removed the row (a duplicate
or bad-timestamp row never reaches validation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.operators.ranking import ranked_within_groups

#: Fields of a catalogue file, as its writers name them; the anomaly is a text or a name.
CATALOGUE_SCHEMA = "row_number_csv long, notification_id string, issue string, tipo_anomalia string"


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(line, notification_id, anomaly) from a JSON array; an empty id is null."""
    rows = spark.read.schema(CATALOGUE_SCHEMA).option("multiLine", True).json(path)
    return rows.select(
        F.col("row_number_csv").alias("line"),
        F.nullif("notification_id", F.lit("")).alias("notification_id"),
        F.coalesce("tipo_anomalia", "issue").alias("anomaly"),
    )


def with_lines(tagged: DataFrame) -> DataFrame:
    """Rows of CSV files with ``line``: their number in the file, the header being 1. The rows of
    a file are numbered by all tasks that hold some (``ranking``)."""
    order = [F.col(f"{S.ROW_ORD}.offset"), F.col(f"{S.ROW_ORD}.pos")]
    rows = tagged.withColumn("_file", F.col(f"{S.ROW_ORD}.file"))
    ranked = ranked_within_groups(rows, ["_file"], order, rank_col="_rank", size_col=None)
    return ranked.withColumn("line", F.col("_rank") + 1).drop("_file", "_rank")


def catalogue_outcome(catalogue: DataFrame, tagged: DataFrame) -> DataFrame:
    """Each catalogue row with the row on its line (null where the file has none): its id,
    whether it was rejected, at which stage and why."""
    found = with_lines(tagged.select(S.ROW_ORD, "notification_id", "stage", "reject_reason"))
    rows = found.select("line", F.col("notification_id").alias("found_id"), "stage", "reject_reason")
    return catalogue.join(rows, "line", "left").select(
        "line", "anomaly", "notification_id", "found_id", "stage", "reject_reason",
        F.col("reject_reason").isNotNull().alias("rejected"),
    )


def catalogue_from_events(events: DataFrame) -> DataFrame:
    """(row_ord, anomaly, expected_code): one row per injected anomaly."""
    e = F.col("event_id")
    t = F.col("event_type")
    sent = (e % 10 < 7) & (e % 107 != 40)
    like_or_comment = t.isin("click", "view", "purchase") | ((t == "error") & (e % 5 != 0))
    # (anomaly, expected reject code, injection condition)
    entries = [
        ("missing_notification_id", "notification_id_missing", e % 97 == 5),
        ("duplicate_notification_id", S.CLEAN_DUP, (e % 101 == 7) & (e % 97 != 5)),
        ("unknown_event_type", "event_type_domain", (t == "error") & (e % 5 == 0)),
        ("self_event", "self_event", e % 89 == 3),
        ("missing_source_user", "source_user_id_missing", (e % 83 == 11) & (e % 89 != 3)),
        ("missing_post_id", "post_id_required", (e % 61 == 2) & like_or_comment),
        ("missing_comment_id", "comment_id_required", (t == "purchase") & (e % 53 == 4)),
        ("bad_timestamp", S.CLEAN_BAD_TS, e % 67 == 9),
        ("future_timestamp", "created_at_future", (e % 71 == 13) & (e % 67 != 9)),
        ("missing_timestamp", "created_at_missing", (e % 173 == 1) & (e % 67 != 9) & (e % 71 != 13)),
        ("unknown_device", "device_domain", e % 79 == 17),
        ("unknown_channel", "delivery_channel_domain", e % 73 == 21),
        ("unknown_priority", "priority_domain", e % 59 == 8),
        ("non_boolean_seen", "seen_not_boolean", e % 109 == 30),
        ("unknown_status", "status_domain", e % 107 == 40),
        ("missing_app_version", "app_version_missing", e % 103 == 6),
        ("old_app_version_sent", "sent_app_version_too_old", (e % 47 == 20) & (e % 103 != 6) & sent),
        ("unknown_country", "country_domain", e % 113 == 50),
        ("negative_latency", "latency_negative", e % 127 == 60),
    ]
    items = F.array(
        *[
            F.struct(F.lit(name).alias("anomaly"), F.lit(code).alias("expected_code"), cond.alias("_hit"))
            for name, code, cond in entries
        ]
    )
    return events.select(
        e.cast("bigint").alias(S.ROW_ORD),
        F.explode(F.filter(items, lambda x: x["_hit"])).alias("_a"),
    ).select(S.ROW_ORD, "_a.anomaly", "_a.expected_code")


def anomaly_recall(catalogue: DataFrame, tagged: DataFrame) -> DataFrame:
    """Per anomaly: injected rows, rejected rows, rows rejected with the expected code."""
    outcome = tagged.select(S.ROW_ORD, "reject_reason")
    j = catalogue.join(outcome, S.ROW_ORD, "left")
    codes = F.split(F.coalesce(F.col("reject_reason"), F.lit("")), "; ")
    caught = F.array_contains(codes, F.col("expected_code"))
    return j.groupBy("anomaly", "expected_code").agg(
        F.count(F.lit(1)).alias("injected"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
        F.count_if(caught).alias("caught"),
    ).withColumn("recall", F.round(F.col("caught") / F.col("injected"), 4))
