"""Validate stage: rule tagging (V*), split (C3), typed output (P10, P11), report (A2).

Validation is one narrow projection over the clean-tagged frame: no shuffle, no UDF.
The tagged frame carries both reasons, so every downstream table (valid rows,
rejects, labelled rows, counts) is a filter or aggregate of the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.functions.text import blank_to_null
from notifyq.operators.rules import Rule, default_rules, reason_text


def tag_validation(clean_tagged: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``validation_reason``, ``reject_reason`` (clean or validation), ``stage``
    (clean / validate / null when valid) and ``label`` (1 rejected, 0 valid)."""
    rules = list(rules) if rules is not None else default_rules()
    passed_clean = F.col("clean_reason").isNull()
    # Two projections on purpose: ``nullif(x, '')`` expands to ``if(x = '', null, x)``;
    # with ``x`` a column, Catalyst keeps the 21-rule text built once per row.
    out = clean_tagged.withColumn("_reasons", F.when(passed_clean, reason_text(rules)))
    v_reason = F.nullif(F.col("_reasons"), F.lit(""))
    reject = F.coalesce(F.col("clean_reason"), v_reason)
    stage = F.when(F.col("clean_reason").isNotNull(), F.lit(S.STAGE_CLEAN)).when(
        v_reason.isNotNull(), F.lit(S.STAGE_VALIDATE)
    )
    # One projection for the derived columns (each withColumn would re-analyse the plan).
    return out.withColumns(
        {
            "validation_reason": v_reason,
            "reject_reason": reject,
            "stage": stage,
            "label": reject.isNotNull().cast("int"),
        }
    ).drop("_reasons")


def typed_valid(tagged: DataFrame) -> DataFrame:
    """P10 + P11: the 16 typed columns of a valid row, plus lineage."""
    extra = [c for c in (S.ROW_ORD, S.BATCH_ID) if c in tagged.columns]
    return tagged.where(F.col("reject_reason").isNull()).select(
        "notification_id",
        "event_id",
        "event_type",
        "user_id",
        "source_user_id",
        blank_to_null("post_id").alias("post_id"),
        blank_to_null("comment_id").alias("comment_id"),
        F.col("created_ts").alias("created_at"),
        "device",
        "delivery_channel",
        "priority",
        F.col("seen_bool").alias("seen"),
        "status",
        "app_version",
        "country",
        F.col("latency_num").try_cast("bigint").alias("latency_ms"),
        *extra,
    )


def rejects(tagged: DataFrame, stage: str | None = None) -> DataFrame:
    """Rejected rows with their reason: the 16 text columns as received (trimmed)."""
    cond = F.col("reject_reason").isNotNull()
    if stage is not None:
        cond = cond & (F.col("stage") == stage)
    extra = [c for c in (S.ROW_ORD, S.BATCH_ID) if c in tagged.columns]
    return tagged.where(cond).select(*S.RAW_COLUMNS, *extra, "stage", "reject_reason")


def rule_counts(tagged: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Violations per rule over the rows that reached validation, zero counts kept.

    One aggregate of ``count_if`` per rule (partial aggregation, one tiny shuffle),
    then an unpivot of the single row.
    """
    rules = list(rules) if rules is not None else default_rules()
    reached = tagged.where(F.col("clean_reason").isNull())
    agg = reached.agg(
        *[F.count_if(F.coalesce(r.fails, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("rule_order"), F.lit(r.code).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, r in enumerate(rules)
        ]
    )
    return agg.select(F.inline(pairs))


def validation_report(tagged: DataFrame) -> DataFrame:
    """A2: rows that reached validation, valid, rejected and % valid (0 when empty)."""
    reached = tagged.where(F.col("clean_reason").isNull())
    return reached.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("validation_reason").isNull()).alias("valid"),
        F.count_if(F.col("validation_reason").isNotNull()).alias("rejected"),
    ).select(
        "total",
        "valid",
        "rejected",
        F.round(
            F.coalesce(F.try_divide(F.col("valid") * F.lit(100.0).cast("double"), F.col("total")), F.lit(0.0)),
            2,
        ).alias("valid_pct"),
    )
