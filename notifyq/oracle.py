"""DuckDB oracle SQL for the registered queries (driver contract, ``oracle_sql()``).

Hand-written from the specification, separately from the Spark code: the Spark side
deduplicates with an aggregate + salted join, the oracle with a window; the Spark side
builds rule predicates as Column objects, the oracle as SQL text. Tables are the
pre-registered views (``events`` ...). Counts are cast to BIGINT and ratios to DOUBLE
and rounded, so types and last digits agree between the engines.
"""

from __future__ import annotations

_TS_RE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
_NUM_RE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


_WS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
       "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _strip(c: str) -> str:
    """Python str.strip(): trim every Unicode whitespace character from both ends."""
    return f"trim({c}, '{_WS}')"


# Raw notification rows from events (FIXTURES.md section 3).
RAW_CTE = """
raw AS (
  SELECT
    CASE WHEN event_id % 97 = 5 THEN NULL
         WHEN event_id % 101 = 7 THEN 'N' || lpad(CAST(event_id - 1 AS VARCHAR), 7, '0')
         ELSE 'N' || lpad(CAST(event_id AS VARCHAR), 7, '0') END AS notification_id,
    'E' || lpad(CAST(event_id AS VARCHAR), 7, '0') AS event_id,
    et AS event_type,
    'U' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS user_id,
    CASE WHEN event_id % 89 = 3 THEN 'U' || lpad(CAST(user_id AS VARCHAR), 4, '0')
         WHEN event_id % 83 = 11 THEN NULL
         ELSE 'U' || lpad(CAST(user_id + 1 + event_id % 149 AS VARCHAR), 4, '0') END AS source_user_id,
    CASE WHEN et = 'FOLLOW' OR event_id % 61 = 2 THEN NULL
         ELSE 'P' || lpad(CAST(event_id % 50 AS VARCHAR), 4, '0') END AS post_id,
    CASE WHEN et = 'COMMENT' AND event_id % 53 <> 4
         THEN 'C' || lpad(CAST(event_id AS VARCHAR), 7, '0') END AS comment_id,
    CASE WHEN event_id % 67 = 9 THEN '2026/13/40 99:99:99'
         WHEN event_id % 71 = 13 THEN '2027-01-01 10:00:00'
         WHEN event_id % 173 = 1 THEN NULL
         ELSE CAST(date_trunc('second', ts) AS VARCHAR) END AS created_at,
    CASE WHEN event_id % 79 = 17 THEN 'SMART_TV' WHEN event_id % 2 = 0 THEN 'MOBILE' ELSE ' web' END AS device,
    CASE WHEN event_id % 73 = 21 THEN 'SMS' WHEN event_id % 3 = 0 THEN 'PUSH'
         WHEN event_id % 3 = 1 THEN 'EMAIL' ELSE 'IN_APP' END AS delivery_channel,
    CASE WHEN event_id % 59 = 8 THEN 'URGENT' WHEN event_id % 4 = 0 THEN 'LOW'
         WHEN event_id % 4 = 1 THEN 'MEDIUM' WHEN event_id % 4 = 2 THEN 'HIGH' ELSE 'medium' END AS priority,
    CASE WHEN event_id % 109 = 30 THEN 'maybe' WHEN event_id % 4 = 0 THEN 'true'
         WHEN event_id % 4 = 1 THEN 'FALSE' WHEN event_id % 4 = 2 THEN '1' ELSE '0' END AS seen,
    CASE WHEN event_id % 107 = 40 THEN 'UNKNOWN' WHEN event_id % 10 < 7 THEN 'SENT'
         WHEN event_id % 10 < 9 THEN 'PENDING' ELSE 'FAILED' END AS status,
    CASE WHEN event_id % 103 = 6 THEN NULL WHEN event_id % 47 = 20 THEN '0.9.0'
         WHEN event_id % 4 = 0 THEN '1.0.0' WHEN event_id % 4 = 1 THEN '1.1.0'
         WHEN event_id % 4 = 2 THEN '1.2.0' ELSE '2.0.0' END AS app_version,
    CASE WHEN event_id % 113 = 50 THEN 'US' WHEN event_id % 4 = 0 THEN 'CL'
         WHEN event_id % 4 = 1 THEN 'AR' WHEN event_id % 4 = 2 THEN 'PE' ELSE 'MX' END AS country,
    CASE WHEN event_id % 127 = 60 THEN '-250' WHEN event_id % 131 = 70 THEN 'abc'
         WHEN event_id % 10 = 9 THEN NULL
         ELSE CAST(CAST(floor(value * 300) AS BIGINT) AS VARCHAR) END AS latency_ms,
    CAST(event_id AS BIGINT) AS row_ord,
    strftime(ts, '%Y%m%d') AS batch_id
  FROM (
    SELECT *,
      CASE WHEN event_type = 'click' THEN 'LIKE' WHEN event_type = 'view' THEN 'like '
           WHEN event_type = 'purchase' THEN 'COMMENT' WHEN event_type = 'signup' THEN 'FOLLOW'
           WHEN event_id % 5 = 0 THEN 'SHARE' ELSE 'LIKE' END AS et
    FROM events
  ) e
)"""

_TEXT = ["notification_id", "event_id", "user_id", "source_user_id", "post_id", "comment_id",
         "created_at", "seen", "app_version", "latency_ms"]
_UPPER = ["event_type", "device", "delivery_channel", "priority", "status", "country"]
_RAW_ORDER = ["notification_id", "event_id", "event_type", "user_id", "source_user_id", "post_id",
              "comment_id", "created_at", "device", "delivery_channel", "priority", "seen",
              "status", "app_version", "country", "latency_ms"]
RAW_COLS = ", ".join(_RAW_ORDER)


def _norm_select() -> str:
    parts = []
    for c in _RAW_ORDER:
        parts.append(f"upper({_strip(c)}) AS {c}" if c in _UPPER else f"{_strip(c)} AS {c}")
    return ",\n    ".join(parts)


NORM_CTE = f"""
trimmed AS (
  SELECT
    {_norm_select()},
    row_ord, batch_id
  FROM raw
),
norm AS (
  SELECT {RAW_COLS},
    CASE WHEN lower(seen) IN ('true', '1') THEN TRUE
         WHEN lower(seen) IN ('false', '0') THEN FALSE END AS seen_bool,
    CASE WHEN regexp_matches(created_at, '{_TS_RE}') THEN try_cast(created_at AS TIMESTAMP) END AS created_ts,
    CASE WHEN regexp_matches(latency_ms, '{_NUM_RE}') THEN try_cast(latency_ms AS DOUBLE) END AS latency_num,
    row_ord, batch_id
  FROM trimmed
)"""

CLEAN_CTE = """
cleaned AS (
  SELECT *,
    CASE WHEN notification_id IS NOT NULL
              AND row_number() OVER (PARTITION BY notification_id ORDER BY row_ord) > 1 THEN 'dup_id'
         WHEN created_at IS NOT NULL AND created_ts IS NULL THEN 'bad_ts' END AS clean_reason,
    CASE WHEN notification_id IS NULL THEN CAST(0 AS BIGINT)
         ELSE CAST(count(*) OVER (PARTITION BY notification_id) AS BIGINT) END AS id_copies
  FROM norm
)"""

# Rule order and failing conditions (V1-V21), written directly as SQL.
RULES_SQL = [
    ("notification_id_missing", "coalesce(notification_id, '') = ''"),
    ("event_id_missing", "coalesce(event_id, '') = ''"),
    ("user_id_missing", "coalesce(user_id, '') = ''"),
    ("source_user_id_missing", "coalesce(source_user_id, '') = ''"),
    ("app_version_missing", "coalesce(app_version, '') = ''"),
    ("event_type_domain", "coalesce(event_type, '') NOT IN ('LIKE', 'COMMENT', 'FOLLOW')"),
    ("device_domain", "coalesce(device, '') NOT IN ('MOBILE', 'WEB')"),
    ("delivery_channel_domain", "coalesce(delivery_channel, '') NOT IN ('PUSH', 'EMAIL', 'IN_APP')"),
    ("priority_domain", "coalesce(priority, '') NOT IN ('LOW', 'MEDIUM', 'HIGH')"),
    ("status_domain", "coalesce(status, '') NOT IN ('SENT', 'PENDING', 'FAILED')"),
    ("country_domain", "coalesce(country, '') NOT IN ('CL', 'AR', 'PE', 'MX')"),
    ("created_at_missing", "created_ts IS NULL"),
    ("created_at_future", "created_ts > TIMESTAMP '2026-06-01 00:00:00'"),
    ("seen_not_boolean", "seen_bool IS NULL"),
    ("latency_negative", "trunc(latency_num) < 0"),
    ("self_event", "coalesce(user_id, '') <> '' AND coalesce(source_user_id, '') <> '' AND user_id = source_user_id"),
    ("comment_id_required", "event_type = 'COMMENT' AND coalesce(comment_id, '') = ''"),
    ("post_id_required", "event_type IN ('LIKE', 'COMMENT') AND coalesce(post_id, '') = ''"),
    ("email_quiet_hours", "delivery_channel = 'EMAIL' AND created_ts IS NOT NULL AND (hour(created_ts) >= 23 OR hour(created_ts) < 7)"),
    ("follow_high_priority", "event_type = 'FOLLOW' AND priority = 'HIGH'"),
    ("sent_app_version_too_old", "status = 'SENT' AND coalesce(app_version, '') <> '' AND try_cast(split_part(app_version, '.', 1) AS INTEGER) < 1"),
]

_REASON = "nullif(concat_ws('; ', " + ", ".join(
    f"CASE WHEN coalesce({cond}, FALSE) THEN '{code}' END" for code, cond in RULES_SQL
) + "), '')"

TAGGED_CTE = f"""
vtag AS (
  SELECT *, CASE WHEN clean_reason IS NULL THEN {_REASON} END AS validation_reason
  FROM cleaned
),
tagged AS (
  SELECT *,
    coalesce(clean_reason, validation_reason) AS reject_reason,
    CASE WHEN clean_reason IS NOT NULL THEN 'clean'
         WHEN validation_reason IS NOT NULL THEN 'validate' END AS stage,
    CAST(CASE WHEN coalesce(clean_reason, validation_reason) IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM vtag
)"""

VALID_CTE = """
valid AS (
  SELECT notification_id, event_id, event_type, user_id, source_user_id,
    nullif(post_id, '') AS post_id, nullif(comment_id, '') AS comment_id,
    created_ts AS created_at, device, delivery_channel, priority, seen_bool AS seen,
    status, app_version, country, try_cast(trunc(latency_num) AS BIGINT) AS latency_ms,
    row_ord, batch_id
  FROM tagged WHERE reject_reason IS NULL
),
latest AS (SELECT max(batch_id) AS batch_id FROM raw),
prior_dest AS (SELECT * FROM valid WHERE batch_id < (SELECT batch_id FROM latest)),
dest AS (SELECT * FROM valid)"""

BASE = "WITH " + ",".join([RAW_CTE, NORM_CTE, CLEAN_CTE, TAGGED_CTE, VALID_CTE])

_KPI_CTE = """,
dm AS (
  SELECT count(*) AS destination_rows,
    coalesce(100.0 * (count(notification_id) + count(event_id) + count(event_type) + count(user_id)
      + count(source_user_id) + count(created_at) + count(device) + count(delivery_channel)
      + count(priority) + count(seen) + count(status) + count(country)) / nullif(count(*) * 12, 0), 0.0) AS completeness_pct,
    count(*) FILTER (WHERE status = 'SENT' AND latency_ms IS NOT NULL) AS sent_rows,
    coalesce(100.0 * count(*) FILTER (WHERE status = 'SENT' AND latency_ms IS NOT NULL AND latency_ms <= 30000)
      / nullif(count(*) FILTER (WHERE status = 'SENT' AND latency_ms IS NOT NULL), 0), 0.0) AS sla_compliance_pct,
    coalesce(avg(latency_ms) FILTER (WHERE status = 'SENT' AND latency_ms IS NOT NULL), 0.0) AS avg_latency_ms,
    coalesce(quantile_cont(latency_ms, 0.95) FILTER (WHERE status = 'SENT' AND latency_ms IS NOT NULL), 0.0) AS p95_latency_ms
  FROM dest
),
rc AS (
  SELECT count(*) AS rows_initial,
    count(*) FILTER (WHERE stage = 'clean') AS clean_removed,
    count(*) FILTER (WHERE stage = 'validate') AS validation_rejected
  FROM tagged
),
kv AS (
  SELECT dm.*, rc.*, rc.clean_removed + rc.validation_rejected AS rejected_total,
    coalesce(100.0 * (rc.clean_removed + rc.validation_rejected) / nullif(rc.rows_initial, 0), 0.0) AS reject_rate_pct
  FROM dm, rc
),
report AS (
  SELECT 0 AS kpi_order, 'completeness_pct' AS kpi, completeness_pct AS v, 95.0 AS target, TRUE AS higher_is_better FROM kv
  UNION ALL SELECT 1, 'reject_rate_pct', reject_rate_pct, 15.0, FALSE FROM kv
  UNION ALL SELECT 2, 'sla_compliance_pct', sla_compliance_pct, 85.0, TRUE FROM kv
  UNION ALL SELECT 3, 'avg_latency_ms', avg_latency_ms, 10000.0, FALSE FROM kv
  UNION ALL SELECT 4, 'p95_latency_ms', p95_latency_ms, 30000.0, FALSE FROM kv
),
kpi_rep AS (
  SELECT kpi_order, kpi, round(CAST(v AS DOUBLE), 2) AS value, CAST(target AS DOUBLE) AS target,
    higher_is_better,
    CASE WHEN higher_is_better THEN v >= target ELSE v <= target END AS met
  FROM report
)"""


def _q(body: str, kpi: bool = False) -> str:
    return BASE + (_KPI_CTE if kpi else "") + "\n" + body


ORACLE: dict[str, str] = {
    "raw_notifications": _q(f"SELECT {RAW_COLS}, row_ord, batch_id FROM raw"),
    "latest_batch": _q(
        "SELECT batch_id, count(*) AS rows FROM raw WHERE batch_id = (SELECT batch_id FROM latest) GROUP BY batch_id"
    ),
    "normalised_rows": _q(
        f"""SELECT {RAW_COLS}, CAST(seen_bool AS DOUBLE) AS seen_bool,
          strftime(created_ts, '%Y-%m-%d %H:%M:%S') AS created_ts, latency_num, row_ord, batch_id
        FROM norm"""
    ),
    "clean_metrics": _q(
        """SELECT count(*) AS rows_in,
          count(*) FILTER (WHERE clean_reason IS NULL) AS rows_out,
          count(*) FILTER (WHERE clean_reason = 'dup_id') AS duplicates,
          count(*) FILTER (WHERE clean_reason = 'bad_ts') AS bad_timestamps,
          count(*) FILTER (WHERE seen IS NOT NULL AND seen_bool IS NULL) AS bad_seen,
          count(*) FILTER (WHERE latency_ms IS NOT NULL AND latency_num IS NULL) AS bad_latency
        FROM tagged"""
    ),
    "clean_rejects": _q(
        f"SELECT {RAW_COLS}, row_ord, batch_id, stage, reject_reason FROM tagged WHERE stage = 'clean'"
    ),
    "first_per_id": _q(
        """SELECT notification_id, row_ord, event_id, created_at, batch_id FROM (
          SELECT *, row_number() OVER (PARTITION BY notification_id ORDER BY row_ord) AS rn
          FROM norm WHERE notification_id IS NOT NULL) WHERE rn = 1"""
    ),
    "valid_rows": _q(
        """SELECT notification_id, event_id, event_type, user_id, source_user_id, post_id, comment_id,
          strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, device, delivery_channel, priority,
          seen, status, app_version, country, CAST(latency_ms AS DOUBLE) AS latency_ms, row_ord, batch_id
        FROM valid"""
    ),
    "validation_rejects": _q(
        f"SELECT {RAW_COLS}, row_ord, batch_id, stage, reject_reason FROM tagged WHERE stage = 'validate'"
    ),
    "validation_report": _q(
        """SELECT count(*) AS total,
          count(*) FILTER (WHERE validation_reason IS NULL) AS valid,
          count(*) FILTER (WHERE validation_reason IS NOT NULL) AS rejected,
          round(coalesce(100.0 * count(*) FILTER (WHERE validation_reason IS NULL) / nullif(count(*), 0), 0.0), 2) AS valid_pct
        FROM tagged WHERE clean_reason IS NULL"""
    ),
    "rule_counts": _q(
        " UNION ALL ".join(
            f"SELECT {i} AS rule_order, '{code}' AS rule, count(*) FILTER (WHERE coalesce({cond}, FALSE)) AS violations FROM tagged WHERE clean_reason IS NULL"
            for i, (code, cond) in enumerate(RULES_SQL)
        )
    ),
    "reject_reason_counts": _q(
        "SELECT reject_reason, count(*) AS rows FROM tagged WHERE label = 1 GROUP BY reject_reason"
    ),
    "completeness": _q(
        "SELECT destination_rows, round(completeness_pct, 4) AS completeness_pct FROM kv", kpi=True
    ),
    "raw_completeness": _q(
        "SELECT count(*) AS rows, round(100.0 * ("
        + " + ".join(f"count(*) FILTER (WHERE coalesce({c}, '') <> '')" for c in _RAW_ORDER)
        + ") / (count(*) * 16), 4) AS raw_completeness_pct FROM raw"
    ),
    "reject_rate": _q(
        "SELECT rows_initial, clean_removed, validation_rejected, rejected_total, round(reject_rate_pct, 4) AS reject_rate_pct FROM kv",
        kpi=True,
    ),
    "sla_compliance": _q(
        "SELECT sent_rows, round(sla_compliance_pct, 4) AS sla_compliance_pct FROM kv", kpi=True
    ),
    "latency_kpis": _q(
        "SELECT sent_rows, round(avg_latency_ms, 2) AS avg_latency_ms, round(p95_latency_ms, 2) AS p95_latency_ms FROM kv",
        kpi=True,
    ),
    "kpi_report": _q("SELECT * FROM kpi_rep", kpi=True),
    "kpi_alerts": _q(
        """SELECT count(*) FILTER (WHERE NOT met) AS alerts, count(*) FILTER (WHERE met) AS met,
          count(*) AS kpis,
          CAST(count(*) FILTER (WHERE met) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) AS met_text
        FROM kpi_rep""",
        kpi=True,
    ),
    "errors_by_stage": _q(
        """SELECT 0 AS stage_order, 'ingest' AS stage, CAST(0 AS BIGINT) AS errors
        UNION ALL SELECT 1, 'clean', clean_removed FROM rc
        UNION ALL SELECT 2, 'validate', validation_rejected FROM rc
        UNION ALL SELECT 3, 'load', CAST(0 AS BIGINT)""",
        kpi=True,
    ),
    "kpi_latest": _q(
        """, lrc AS (
          SELECT count(*) AS rows_initial,
            count(*) FILTER (WHERE stage = 'clean') AS clean_removed,
            count(*) FILTER (WHERE stage = 'validate') AS validation_rejected
          FROM tagged WHERE batch_id = (SELECT batch_id FROM latest)
        ), lrate AS (
          SELECT coalesce(100.0 * (clean_removed + validation_rejected) / nullif(rows_initial, 0), 0.0) AS r FROM lrc
        )
        SELECT (SELECT batch_id FROM latest) AS batch_id, kpi_order, kpi,
          round(CAST(CASE WHEN kpi = 'reject_rate_pct' THEN (SELECT r FROM lrate) ELSE v END AS DOUBLE), 2) AS value,
          CAST(target AS DOUBLE) AS target, higher_is_better,
          CASE WHEN kpi = 'reject_rate_pct' THEN (SELECT r FROM lrate) <= target
               WHEN higher_is_better THEN v >= target ELSE v <= target END AS met
        FROM report""",
        kpi=True,
    ),
    "existing_ids": _q(
        "SELECT notification_id FROM valid WHERE notification_id IN (SELECT notification_id FROM prior_dest)"
    ),
    "idempotent_load": _q(
        """SELECT notification_id, event_id, event_type, post_id, comment_id,
          strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, device, delivery_channel, priority,
          seen, status, app_version, country, CAST(latency_ms AS DOUBLE) AS latency_ms, row_ord, batch_id
        FROM valid WHERE notification_id NOT IN (SELECT notification_id FROM prior_dest)"""
    ),
    "destination_rows": _q(
        """SELECT notification_id, event_id, event_type, nullif(trim(post_id), '') AS post_id,
          nullif(trim(comment_id), '') AS comment_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
          device, delivery_channel, priority,
          coalesce(seen, FALSE) AS seen, status, app_version, country, coalesce(latency_ms, 0) AS latency_ms,
          row_ord, batch_id, user_id AS user_id_decrypted, source_user_id AS source_user_id_decrypted
        FROM dest"""
    ),
    "masked_ids": _q(
        """SELECT row_ord, notification_id,
          coalesce(substr(user_id, 1, 1), '') || '***' AS user_id_masked,
          coalesce(substr(source_user_id, 1, 1), '') || '***' AS source_user_id_masked
        FROM norm"""
    ),
    "load_audit": _q(
        """SELECT 'events' AS source_file, count(*) AS rows_in,
          count(*) FILTER (WHERE notification_id NOT IN (SELECT notification_id FROM prior_dest)) AS rows_inserted,
          count(*) FILTER (WHERE notification_id IN (SELECT notification_id FROM prior_dest)) AS rows_already_present,
          (SELECT count(*) FROM prior_dest) + count(*) FILTER (WHERE notification_id NOT IN (SELECT notification_id FROM prior_dest)) AS destination_total,
          'Fernet' AS cipher
        FROM valid"""
    ),
    "reject_audit": _q(
        """SELECT notification_id, stage, reject_reason,
          CAST(to_json(struct_pack(notification_id := notification_id, event_id := event_id,
            event_type := event_type,
            user_id := CASE WHEN user_id IS NOT NULL THEN coalesce(substr(user_id, 1, 1), '') || '***' END,
            source_user_id := CASE WHEN source_user_id IS NOT NULL THEN coalesce(substr(source_user_id, 1, 1), '') || '***' END,
            post_id := post_id, comment_id := comment_id, created_at := created_at, device := device,
            delivery_channel := delivery_channel, priority := priority, seen := seen, status := status,
            app_version := app_version, country := country, latency_ms := latency_ms)) AS VARCHAR) AS payload,
          row_ord, batch_id
        FROM tagged WHERE reject_reason IS NOT NULL"""
    ),
    "reject_payload_counts": _q(
        "SELECT stage, country, count(*) AS rows FROM tagged WHERE reject_reason IS NOT NULL GROUP BY stage, country"
    ),
    "table_counts": _q(
        """SELECT 'destination' AS table_name, count(*) AS rows FROM dest
        UNION ALL SELECT 'rejected', count(*) FROM tagged WHERE reject_reason IS NOT NULL
        UNION ALL SELECT 'load_audit', CAST(1 AS BIGINT)"""
    ),
    "run_summary": _q(
        """SELECT rc.rows_initial AS rows_in, rc.clean_removed, rc.validation_rejected,
          (SELECT count(*) FROM valid) AS valid,
          (SELECT count(*) FROM valid WHERE notification_id NOT IN (SELECT notification_id FROM prior_dest)) AS rows_inserted,
          (SELECT count(*) FROM prior_dest) AS rows_already_present,
          (SELECT count(*) FROM dest) AS destination_total,
          (SELECT CAST(count(*) FILTER (WHERE met) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) FROM kpi_rep) AS kpis_met
        FROM rc""",
        kpi=True,
    ),
}


# ---- profile ---------------------------------------------------------------------------

_LABELLED = _RAW_ORDER + ["reject_reason", "label"]


def _fblank(c: str) -> str:
    return f"coalesce(upper({_strip(c)}) IN ('', 'NAN', 'NONE'), TRUE)"


_NUMERIC = ["latency_ms_num", "hour", "ts_invalid", "latency_negative", "self_event",
            "n_missing_fields", "dup_notification_id", "missing_post_id", "missing_comment_id"]

FEATURES_CTE = f""",
feats AS (
  SELECT row_ord, notification_id,
    {", ".join(f"upper({_strip(c)}) AS {c}" for c in ["event_type", "device", "delivery_channel", "priority", "status", "country", "app_version"])},
    latency_num AS latency_ms_num,
    CAST(hour(created_ts) AS INTEGER) AS hour,
    CAST(created_ts IS NULL AS INTEGER) AS ts_invalid,
    CAST(coalesce(latency_num < 0, FALSE) AS INTEGER) AS latency_negative,
    CAST(user_id IS NOT NULL AND source_user_id IS NOT NULL AND user_id = source_user_id AS INTEGER) AS self_event,
    CAST({" + ".join(f"CAST({_fblank(c)} AS INTEGER)" for c in ["notification_id", "event_id", "user_id", "source_user_id", "app_version"])} AS INTEGER) AS n_missing_fields,
    CAST(id_copies > 1 AND NOT {_fblank("notification_id")} AS INTEGER) AS dup_notification_id,
    CAST({_fblank("post_id")} AS INTEGER) AS missing_post_id,
    CAST({_fblank("comment_id")} AS INTEGER) AS missing_comment_id,
    label
  FROM tagged
)"""


def _corr(a: str, b: str) -> str:
    x = (f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) "
         f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return f"CASE WHEN isnan({x}) THEN NULL ELSE round({x}, 2) + 0.0 END"


_CORR_VARS = _NUMERIC + ["label"]
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, {_corr(a, b)} AS corr FROM feats"
    for a in _CORR_VARS for b in _CORR_VARS
)


def _mode_sql(col: str, source: str) -> str:
    return (f"(SELECT {col} FROM (SELECT {col}, count(*) AS n FROM {source} WHERE {col} IS NOT NULL "
            f"GROUP BY {col}) ORDER BY n DESC, {col} ASC LIMIT 1)")


ORACLE.update({
    "labelled_rows": _q(f"SELECT {', '.join(_LABELLED)}, row_ord, batch_id FROM tagged"),
    "model_features": _q(FEATURES_CTE + "\nSELECT * REPLACE (CAST(hour AS DOUBLE) AS hour) FROM feats"),
    "duplicate_id_rows": _q(
        f"SELECT notification_id, row_ord, id_copies, label FROM tagged WHERE id_copies > 1 AND NOT {_fblank('notification_id')}"
    ),
    "exact_duplicates": _q(
        f"""SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_LABELLED)} FROM tagged)) AS distinct_rows,
          count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_LABELLED)} FROM tagged)) AS exact_duplicates
        FROM tagged"""
    ),
    "label_distribution": _q(
        "SELECT label, count(*) AS rows, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM tagged GROUP BY label"
    ),
    "null_profile": _q(
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
            f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 1) AS null_pct FROM tagged"
            for c in _LABELLED
        ) + ") WHERE nulls > 0"
    ),
    "latency_stats": _q(
        f"""SELECT 0 AS measure_order, 'mean' AS measure, round(avg(latency_num), 1) AS latency_ms FROM tagged
        UNION ALL SELECT 1, 'median', round(quantile_cont(latency_num, 0.5), 1) FROM tagged
        UNION ALL SELECT 2, 'mode', round({_mode_sql('latency_num', 'tagged')}, 1)
        UNION ALL SELECT 3, 'min', round(min(latency_num), 1) FROM tagged
        UNION ALL SELECT 4, 'p25', round(quantile_cont(latency_num, 0.25), 1) FROM tagged
        UNION ALL SELECT 5, 'p75', round(quantile_cont(latency_num, 0.75), 1) FROM tagged
        UNION ALL SELECT 6, 'max', round(max(latency_num), 1) FROM tagged"""
    ),
    "category_modes": _q(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, {_mode_sql(c, 'tagged')} AS mode"
            for c in ["event_type", "device", "delivery_channel", "priority", "status", "country"]
        )
    ),
    "priority_counts": _q(
        "SELECT priority, count(*) AS rows FROM tagged WHERE priority IS NOT NULL GROUP BY priority"
    ),
    "latency_histogram": _q(
        """, lim AS (SELECT min(latency_num) AS lo, max(latency_num) AS hi, count(latency_num) AS n FROM tagged),
        binned AS (
          SELECT CAST(least(40, coalesce(floor((latency_num - lo) / nullif(hi - lo, 0) * 40), 0) + 1) AS INTEGER) AS bin
          FROM tagged, lim WHERE latency_num IS NOT NULL
        ),
        cnt AS (SELECT bin, count(*) AS rows FROM binned GROUP BY bin)
        SELECT CAST(g.bin AS INTEGER) AS bin,
          round(lo + (g.bin - 1) * (hi - lo) / 40, 4) AS bin_start,
          round(lo + g.bin * (hi - lo) / 40, 4) AS bin_end,
          coalesce(cnt.rows, 0) AS rows
        FROM lim, range(1, 41) g(bin) LEFT JOIN cnt ON cnt.bin = g.bin
        WHERE lim.n > 0"""
    ),
    "reject_rate_by_priority": _q(
        "SELECT priority, count(*) AS rows, round(avg(label), 4) AS reject_rate FROM tagged WHERE priority IS NOT NULL GROUP BY priority"
    ),
    "correlation_matrix": _q(FEATURES_CTE + "\n" + _CORR_SQL),
    "label_correlation_rank": _q(
        FEATURES_CTE + f""", cm AS ({_CORR_SQL})
        SELECT var_a AS feature, corr,
          CAST(row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, var_a) AS INTEGER) AS abs_rank
        FROM cm WHERE var_b = 'label' AND var_a <> 'label'"""
    ),
})


# ---- model -------------------------------------------------------------------------------

_SPLIT_CTE = """,
ranked AS (
  SELECT row_ord, label,
    row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', '42', CAST(row_ord AS VARCHAR))), row_ord) AS rk,
    count(*) OVER (PARTITION BY label) AS n
  FROM tagged
),
splits AS (
  SELECT row_ord, label, CASE WHEN rk <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM ranked
)"""

ORACLE.update({
    "stratified_split": _q(_SPLIT_CTE + "\nSELECT * FROM splits"),
    "class_weights": _q(
        _SPLIT_CTE + """
        SELECT label, count(*) AS rows,
          round((SELECT count(*) FROM splits WHERE split = 'train') * 1.0
            / ((SELECT count(DISTINCT label) FROM splits WHERE split = 'train') * count(*)), 6) AS class_weight
        FROM splits WHERE split = 'train' GROUP BY label"""
    ),
})

_CATALOGUE = [
    ("missing_notification_id", "notification_id_missing", "event_id % 97 = 5"),
    ("duplicate_notification_id", "dup_id", "event_id % 101 = 7 AND event_id % 97 <> 5"),
    ("unknown_event_type", "event_type_domain", "event_type = 'error' AND event_id % 5 = 0"),
    ("self_event", "self_event", "event_id % 89 = 3"),
    ("missing_source_user", "source_user_id_missing", "event_id % 83 = 11 AND event_id % 89 <> 3"),
    ("missing_post_id", "post_id_required",
     "event_id % 61 = 2 AND (event_type IN ('click', 'view', 'purchase') OR (event_type = 'error' AND event_id % 5 <> 0))"),
    ("missing_comment_id", "comment_id_required", "event_type = 'purchase' AND event_id % 53 = 4"),
    ("bad_timestamp", "bad_ts", "event_id % 67 = 9"),
    ("future_timestamp", "created_at_future", "event_id % 71 = 13 AND event_id % 67 <> 9"),
    ("missing_timestamp", "created_at_missing", "event_id % 173 = 1 AND event_id % 67 <> 9 AND event_id % 71 <> 13"),
    ("unknown_device", "device_domain", "event_id % 79 = 17"),
    ("unknown_channel", "delivery_channel_domain", "event_id % 73 = 21"),
    ("unknown_priority", "priority_domain", "event_id % 59 = 8"),
    ("non_boolean_seen", "seen_not_boolean", "event_id % 109 = 30"),
    ("unknown_status", "status_domain", "event_id % 107 = 40"),
    ("missing_app_version", "app_version_missing", "event_id % 103 = 6"),
    ("old_app_version_sent", "sent_app_version_too_old",
     "event_id % 47 = 20 AND event_id % 103 <> 6 AND event_id % 10 < 7 AND event_id % 107 <> 40"),
    ("unknown_country", "country_domain", "event_id % 113 = 50"),
    ("negative_latency", "latency_negative", "event_id % 127 = 60"),
]

ORACLE["anomaly_recall"] = _q(
    ", cat AS (" + " UNION ALL ".join(
        f"SELECT CAST(event_id AS BIGINT) AS row_ord, '{n}' AS anomaly, '{c}' AS expected_code FROM events WHERE {w}"
        for n, c, w in _CATALOGUE
    ) + """)
    SELECT anomaly, expected_code, count(*) AS injected,
      count(*) FILTER (WHERE t.reject_reason IS NOT NULL) AS rejected,
      count(*) FILTER (WHERE list_contains(string_split(coalesce(t.reject_reason, ''), '; '), expected_code)) AS caught,
      round(count(*) FILTER (WHERE list_contains(string_split(coalesce(t.reject_reason, ''), '; '), expected_code)) / count(*), 4) AS recall
    FROM cat LEFT JOIN tagged t USING (row_ord)
    GROUP BY anomaly, expected_code"""
)
