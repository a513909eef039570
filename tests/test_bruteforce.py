"""Spark tagging vs. a row-by-row Python implementation of the same specification,
on random messy rows (Hypothesis). Independent of both the Spark code and the SQL
oracle, so a shared misreading of a rule would show up here."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from notifyq import schema as S
from notifyq.operators.clean import normalise, tag_clean
from notifyq.operators.validate import tag_validation

SCHEMA = T.StructType(
    S.RAW_SCHEMA.fields + [T.StructField("row_ord", T.LongType()), T.StructField("batch_id", T.StringType())]
)
AS_OF = dt.datetime(2026, 6, 1)
TS_RE = re.compile(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$")
NUM_RE = re.compile(r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$")


def _parse_ts(s):
    if s is None or not TS_RE.match(s):
        return None
    d, t = s.split(" ")
    y, m, day = (int(x) for x in d.split("-"))
    hh, mm, ss = (int(x) for x in t.split(":"))
    try:
        return dt.datetime(y, m, day, hh, mm, ss)
    except ValueError:
        return None


def _num(s):
    if s is None or not NUM_RE.match(s):
        return None
    return float(s)


def python_tags(rows):
    """rows: list of dicts (16 raw columns + row_ord). Returns {row_ord: reason}."""
    norm = []
    for r in rows:
        n = {c: (r[c].strip() if r[c] is not None else None) for c in S.RAW_COLUMNS}
        for c in S.UPPER_COLUMNS:
            if n[c] is not None:
                n[c] = n[c].upper()
        low = n["seen"].lower() if n["seen"] is not None else None
        n["seen_bool"] = True if low in ("true", "1") else False if low in ("false", "0") else None
        n["ts"] = _parse_ts(n["created_at"])
        n["lat"] = _num(n["latency_ms"])
        n["row_ord"] = r["row_ord"]
        norm.append(n)
    first = {}
    for n in sorted(norm, key=lambda x: x["row_ord"]):
        if n["notification_id"] is not None:
            first.setdefault(n["notification_id"], n["row_ord"])
    out = {}
    for n in norm:
        if n["notification_id"] is not None and first[n["notification_id"]] != n["row_ord"]:
            out[n["row_ord"]] = "dup_id"
            continue
        if n["created_at"] is not None and n["ts"] is None:
            out[n["row_ord"]] = "bad_ts"
            continue

        def blank(c):
            return not n[c]

        codes = []
        for c, code in [("notification_id", "notification_id_missing"), ("event_id", "event_id_missing"),
                        ("user_id", "user_id_missing"), ("source_user_id", "source_user_id_missing"),
                        ("app_version", "app_version_missing")]:
            if blank(c):
                codes.append(code)
        for c, dom in [("event_type", S.EVENT_TYPES), ("device", S.DEVICES),
                       ("delivery_channel", S.DELIVERY_CHANNELS), ("priority", S.PRIORITIES),
                       ("status", S.STATUSES), ("country", S.COUNTRIES)]:
            if (n[c] or "") not in dom:
                codes.append(f"{c}_domain")
        if n["ts"] is None:
            codes.append("created_at_missing")
        elif n["ts"] > AS_OF:
            codes.append("created_at_future")
        if n["seen_bool"] is None:
            codes.append("seen_not_boolean")
        if n["lat"] is not None and int(n["lat"]) < 0:
            codes.append("latency_negative")
        if not blank("user_id") and not blank("source_user_id") and n["user_id"] == n["source_user_id"]:
            codes.append("self_event")
        if n["event_type"] == "COMMENT" and blank("comment_id"):
            codes.append("comment_id_required")
        if n["event_type"] in ("LIKE", "COMMENT") and blank("post_id"):
            codes.append("post_id_required")
        if n["delivery_channel"] == "EMAIL" and n["ts"] is not None and (n["ts"].hour >= 23 or n["ts"].hour < 7):
            codes.append("email_quiet_hours")
        if n["event_type"] == "FOLLOW" and n["priority"] == "HIGH":
            codes.append("follow_high_priority")
        if n["status"] == "SENT" and not blank("app_version"):
            try:
                if int(n["app_version"].split(".")[0]) < 1:
                    codes.append("sent_app_version_too_old")
            except ValueError:
                pass
        out[n["row_ord"]] = "; ".join(codes) or None
    return out


def _text(values):
    pads = st.sampled_from(["", " ", "\t", "  ", "\n"])
    core = st.sampled_from(values)
    return st.one_of(st.none(), st.builds(lambda a, v, b: a + v + b, pads, core, pads))


ROW = st.fixed_dictionaries({
    "notification_id": _text(["N1", "N2", "N3", "", "nan"]),
    "event_id": _text(["E1", ""]),
    "event_type": _text(["LIKE", "like", "COMMENT", "FOLLOW", "SHARE"]),
    "user_id": _text(["U1", "U2", ""]),
    "source_user_id": _text(["U1", "U2", ""]),
    "post_id": _text(["P1", ""]),
    "comment_id": _text(["C1", ""]),
    "created_at": _text(["2026-05-03 12:00:00", "2026-5-3 23:59:59", "2026-05-03 06:00:00",
                         "2027-01-01 10:00:00", "2026/13/40 99:99:99", "2026-02-30 10:00:00", ""]),
    "device": _text(["MOBILE", "web", "SMART_TV"]),
    "delivery_channel": _text(["PUSH", "EMAIL", "in_app", "SMS"]),
    "priority": _text(["LOW", "medium", "HIGH", "URGENT"]),
    "seen": _text(["true", "FALSE", "1", "0", "maybe"]),
    "status": _text(["SENT", "PENDING", "FAILED", "UNKNOWN"]),
    "app_version": _text(["1.0.0", "0.9.0", "x.1", "2", ""]),
    "country": _text(["CL", "ar", "US"]),
    "latency_ms": _text(["100", "-250", "-0.5", "abc", "1e3", "", "-1"]),
})


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=30))
def test_spark_tagging_matches_row_by_row_python(spark, rows):
    rows = [dict(r, row_ord=i) for i, r in enumerate(rows)]
    df = spark.createDataFrame([tuple(r[c] for c in S.RAW_COLUMNS) + (r["row_ord"], "b") for r in rows], SCHEMA)
    got = {r.row_ord: r.reject_reason for r in tag_validation(tag_clean(normalise(df))).collect()}
    assert got == python_tags(rows)
