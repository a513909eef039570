"""Table schemas and the fixed values of the notification data model.

Every constant in the block marked FIXED VALUES must equal the specification of the
data-quality process (column dictionary, allowed domains, KPI targets); changing one
changes which rows are rejected or which KPI is met.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# FIXED VALUES (must equal the specification)
# --------------------------------------------------------------------------------------

# The 16 input columns, in file order.
RAW_COLUMNS = [
    "notification_id",
    "event_id",
    "event_type",
    "user_id",
    "source_user_id",
    "post_id",
    "comment_id",
    "created_at",
    "device",
    "delivery_channel",
    "priority",
    "seen",
    "status",
    "app_version",
    "country",
    "latency_ms",
]

# Characters stripped from both ends of every text value: the characters Python's
# ``str.strip()`` treats as whitespace (the cleaning step strips with it).
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Category columns that cleaning upper-cases.
UPPER_COLUMNS = ["event_type", "device", "delivery_channel", "priority", "status", "country"]

# Text -> boolean map applied to lower-cased `seen`.
BOOL_TRUE = ["true", "1"]
BOOL_FALSE = ["false", "0"]

# Accepted `created_at` text: the fixed format YYYY-MM-DD HH:MM:SS, one or two digits
# allowed in every field but the year.
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
# Accepted numeric text for `latency_ms` (decimal, optional sign and exponent).
NUMBER_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Allowed domains.
EVENT_TYPES = ["LIKE", "COMMENT", "FOLLOW"]
DEVICES = ["MOBILE", "WEB"]
DELIVERY_CHANNELS = ["PUSH", "EMAIL", "IN_APP"]
PRIORITIES = ["LOW", "MEDIUM", "HIGH"]
STATUSES = ["SENT", "PENDING", "FAILED"]
COUNTRIES = ["CL", "AR", "PE", "MX"]

# EMAIL quiet hours: rejected when hour >= 23 or hour < 7.
QUIET_HOUR_START = 23
QUIET_HOUR_END = 7
# SENT needs app_version major >= 1.
MIN_SENT_MAJOR_VERSION = 1
# SLA: a SENT notification meets the SLA when delivered in at most 30 000 ms.
SLA_MAX_LATENCY_MS = 30000
# P95 latency percentile.
LATENCY_PERCENTILE = 0.95

# KPI targets: (kpi, target, higher_is_better), in report order.
KPI_TARGETS = [
    ("completeness_pct", 95.0, True),
    ("reject_rate_pct", 15.0, False),
    ("sla_compliance_pct", 85.0, True),
    ("avg_latency_ms", 10000.0, False),
    ("p95_latency_ms", 30000.0, False),
]

# Mandatory destination columns measured by the completeness KPI.
MANDATORY_COLUMNS = [
    "notification_id",
    "event_id",
    "event_type",
    "user_id_enc",
    "source_user_id_enc",
    "created_at",
    "device",
    "delivery_channel",
    "priority",
    "seen",
    "status",
    "country",
]

# Model feature lists.
CATEGORICAL_FEATURES = [
    "event_type",
    "device",
    "delivery_channel",
    "priority",
    "status",
    "country",
    "app_version",
]
NUMERIC_FEATURES = [
    "latency_ms_num",
    "hour",
    "ts_invalid",
    "latency_negative",
    "self_event",
    "n_missing_fields",
    "dup_notification_id",
    "missing_post_id",
    "missing_comment_id",
]
# Ids counted by n_missing_fields.
ID_FIELDS = ["notification_id", "event_id", "user_id", "source_user_id", "app_version"]
# Texts the model treats as blank (after trim and upper-case).
FEATURE_BLANKS = ["", "NAN", "NONE"]
# Category columns profiled for their mode.
PROFILE_CATEGORIES = ["event_type", "device", "delivery_channel", "priority", "status", "country"]
# Latency histogram bins.
HISTOGRAM_BINS = 40
# Stratified split: test share and seed.
TEST_FRACTION = 0.2
SPLIT_SEED = 42

# Stage names.
STAGE_INGEST = "ingest"
STAGE_CLEAN = "clean"
STAGE_VALIDATE = "validate"
STAGE_LOAD = "load"
STAGES = [STAGE_INGEST, STAGE_CLEAN, STAGE_VALIDATE, STAGE_LOAD]

# Clean-stage reject codes.
CLEAN_DUP = "dup_id"
CLEAN_BAD_TS = "bad_ts"

# The fixed "now" used by the future-timestamp rule when a run does not pass one.
DEFAULT_AS_OF = "2026-06-01 00:00:00"

# --------------------------------------------------------------------------------------
# Spark schemas
# --------------------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

VALID_SCHEMA = T.StructType(
    [
        T.StructField("notification_id", T.StringType(), True),
        T.StructField("event_id", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("source_user_id", T.StringType(), True),
        T.StructField("post_id", T.StringType(), True),
        T.StructField("comment_id", T.StringType(), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
        T.StructField("device", T.StringType(), True),
        T.StructField("delivery_channel", T.StringType(), True),
        T.StructField("priority", T.StringType(), True),
        T.StructField("seen", T.BooleanType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("app_version", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("latency_ms", T.LongType(), True),
    ]
)

VALID_COLUMNS = [f.name for f in VALID_SCHEMA.fields]

# Lineage columns carried next to the data columns.
ROW_ORD = "row_ord"
BATCH_ID = "batch_id"
