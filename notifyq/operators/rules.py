"""Validation rules (V1-V21) as a declarative list of ``(code, failing predicate)``.

The list drives three things: the joined reject reason of a row, the per-rule counts
and the documentation. Users extend validation by passing their own rules. A
predicate is a Column that is true when the row *fails*; null counts as pass.

Predicates read the normalised frame (clean.normalise): text columns are already
trimmed and categories upper-cased, ``seen_bool``/``created_ts``/``latency_num`` are
parsed. V0 ("latency is not numeric") cannot fire after cleaning, which already turned
unparseable latency into null; it is reported as the clean metric ``bad_latency``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from notifyq import schema as S


@dataclass(frozen=True)
class Rule:
    code: str
    fails: Column
    description: str = ""


def _blank(c: str) -> Column:
    # Columns are trimmed by normalise, so blank = null or ''.
    return F.coalesce(F.col(c), F.lit("")) == F.lit("")


def _outside(c: str, domain: Sequence[str]) -> Column:
    return ~F.coalesce(F.col(c), F.lit("")).isin(*domain)


def default_rules(as_of: str = S.DEFAULT_AS_OF) -> list[Rule]:
    """The rules in reporting order. ``as_of`` replaces the wall clock for V13."""
    ts = F.col("created_ts")
    hour = F.hour(ts)
    major = F.split_part(F.col("app_version"), F.lit("."), F.lit(1)).try_cast("int")
    return [
        Rule("notification_id_missing", _blank("notification_id"), "V1 blank id"),
        Rule("event_id_missing", _blank("event_id"), "V2 blank event id"),
        Rule("user_id_missing", _blank("user_id"), "V3 blank user id"),
        Rule("source_user_id_missing", _blank("source_user_id"), "V4 blank source user"),
        Rule("app_version_missing", _blank("app_version"), "V5 blank app version"),
        Rule("event_type_domain", _outside("event_type", S.EVENT_TYPES), "V6"),
        Rule("device_domain", _outside("device", S.DEVICES), "V7"),
        Rule("delivery_channel_domain", _outside("delivery_channel", S.DELIVERY_CHANNELS), "V8"),
        Rule("priority_domain", _outside("priority", S.PRIORITIES), "V9"),
        Rule("status_domain", _outside("status", S.STATUSES), "V10"),
        Rule("country_domain", _outside("country", S.COUNTRIES), "V11"),
        Rule("created_at_missing", ts.isNull(), "V12 no timestamp"),
        Rule(
            "created_at_future",
            ts > F.lit(as_of).cast("timestamp_ntz"),
            "V13 later than as_of",
        ),
        Rule("seen_not_boolean", F.col("seen_bool").isNull(), "V14"),
        Rule("latency_negative", F.col("latency_num") <= -1, "V15 truncated latency below zero"),
        Rule(
            "self_event",
            ~_blank("user_id")
            & ~_blank("source_user_id")
            & (F.col("user_id") == F.col("source_user_id")),
            "V16",
        ),
        Rule(
            "comment_id_required",
            (F.col("event_type") == "COMMENT") & _blank("comment_id"),
            "V17",
        ),
        Rule(
            "post_id_required",
            F.col("event_type").isin("LIKE", "COMMENT") & _blank("post_id"),
            "V18",
        ),
        Rule(
            "email_quiet_hours",
            (F.col("delivery_channel") == "EMAIL")
            & ts.isNotNull()
            & ((hour >= S.QUIET_HOUR_START) | (hour < S.QUIET_HOUR_END)),
            "V19",
        ),
        Rule(
            "follow_high_priority",
            (F.col("event_type") == "FOLLOW") & (F.col("priority") == "HIGH"),
            "V20",
        ),
        Rule(
            "sent_app_version_too_old",
            (F.col("status") == "SENT")
            & ~_blank("app_version")
            & (major < S.MIN_SENT_MAJOR_VERSION),
            "V21 unparseable versions pass",
        ),
    ]


def reason_text(rules: Sequence[Rule]) -> Column:
    """Every failing code, joined with '; ' in rule order; '' when none fails."""
    parts = [F.when(F.coalesce(r.fails, F.lit(False)), F.lit(r.code)) for r in rules]
    return F.concat_ws("; ", *parts)


def reason_column(rules: Sequence[Rule]) -> Column:
    """``reason_text`` with null for a row that passes every rule."""
    return F.nullif(reason_text(rules), F.lit(""))


def rule_codes(rules: Sequence[Rule]) -> list[str]:
    return [r.code for r in rules]
