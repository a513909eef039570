"""Operational run: ingest -> clean -> validate -> load -> KPIs, writing every table.

Tables live under one root folder, which must be shared storage on a cluster:

    stage/tagged/run_id=.../outcome=valid|clean|validate   K3, K5, K6 (one write)
    rejected/load_id=.../stage=.../batch_id=...             K4, K6, K9 (published, idempotent)
    destination/load_id=.../batch_id=...                    K8, K11 (published, bucketed by id)
    commits/table=.../run_id=...                            which tries' rows are visible
    load_audit/run_id=...                                   K10 (published with the destination)
    runs/{clean_metrics,validation_report,kpis}/run_id=...  K7 ("latest" = max_by)
    raw/run_id=..., manifest/run_id=...                     K1, K2 (``stage_ingest``)

The tagged rows are written once per run, partitioned by outcome: this cuts the lineage
(a lost executor recomputes from that table, not from the raw scan and dedup join) and
both sinks read their partition instead of recomputing the tagging twice. Both sinks are
written, checked against the constraints of their table and then published
(``sources/published``): a run that ends in between leaves no visible row, and its retry
starts afresh. Re-running the same input changes nothing: destination rows
are anti-joined on ``notification_id``, reject rows on ``(batch_id, stage, row_ord, payload)``
(the original process appended them again, Q9), and a retried run replaces its own metric and
KPI rows (dynamic partition overwrite of its ``run_id``). One writer per root is assumed.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq import schema as S
from notifyq.functions.protect import FernetKey
from notifyq.operators import constraints, kpis, load, validate
from notifyq.plans.run import Run
from notifyq.sources import published
from notifyq.sources.files import exact_path, newest_file, read_raw_csv
from notifyq.sources.manifest import file_manifest, landed_before
from notifyq.sources.published import path_exists, read_or_empty


@dataclass(frozen=True)
class Tables:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def destination(self) -> str:
        return self.path("destination")

    @property
    def rejected(self) -> str:
        return self.path("rejected")

    @property
    def load_audit(self) -> str:
        return self.path("load_audit")

    @property
    def kpis(self) -> str:
        return self.path("runs/kpis")

    @property
    def clean_metrics(self) -> str:
        return self.path("runs/clean_metrics")

    @property
    def validation_report(self) -> str:
        return self.path("runs/validation_report")

    @property
    def raw(self) -> str:
        return self.path("raw")

    @property
    def manifest(self) -> str:
        return self.path("manifest")

    def tagged(self, run_id: str) -> str:
        return self.path(f"stage/tagged/run_id={run_id}")


DEST_SCHEMA = T.StructType(
    [f for f in S.VALID_SCHEMA.fields if f.name not in ("user_id", "source_user_id")]
    + [
        T.StructField("user_id_enc", T.StringType()),
        T.StructField("source_user_id_enc", T.StringType()),
        T.StructField(S.ROW_ORD, T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("run_id", T.StringType()),
        # Partition columns.
        T.StructField("load_id", T.StringType()),
        T.StructField(S.BATCH_ID, T.StringType()),
    ]
)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("notification_id", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("payload", T.VariantType()),
        # Digest of the payload's text: variants cannot be compared.
        T.StructField("payload_sha", T.StringType()),
        T.StructField(S.ROW_ORD, T.LongType()),
        T.StructField("rejected_at", T.TimestampNTZType()),
        T.StructField("run_id", T.StringType()),
        # Partition columns.
        T.StructField("load_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField(S.BATCH_ID, T.StringType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_already_present", T.LongType()),
        T.StructField("destination_total", T.LongType()),
        T.StructField("cipher", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("run_id", T.StringType()),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("lines", T.LongType()),
        T.StructField("lines_digest", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("landed_before", T.BooleanType()),
        T.StructField("run_id", T.StringType()),
    ]
)

DESTINATION, REJECTED = "destination", "rejected"


TAG_METRICS = [
    ("rows_in", lambda: F.count(F.lit(1))),
    ("clean_removed", lambda: F.count_if(F.col("stage") == S.STAGE_CLEAN)),
    ("duplicates", lambda: F.count_if(F.col("clean_reason") == S.CLEAN_DUP)),
    ("bad_timestamps", lambda: F.count_if(F.col("clean_reason") == S.CLEAN_BAD_TS)),
    ("bad_seen", lambda: F.count_if(F.col("seen").isNotNull() & F.col("seen_bool").isNull())),
    ("bad_latency", lambda: F.count_if(F.col("latency_ms").isNotNull() & F.col("latency_num").isNull())),
    ("validation_rejected", lambda: F.count_if(F.col("stage") == S.STAGE_VALIDATE)),
    ("valid", lambda: F.count_if(F.col("label") == 0)),
]


def _write_run_row(df: DataFrame, path: str) -> DataFrame:
    """Append the rows of one run, replacing that run's earlier rows if it is retried:
    partitioned by ``run_id`` with dynamic partition overwrite."""
    df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("run_id").parquet(path)
    return df


def _now_literal(ts: dt.datetime):
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def new_run_id() -> str:
    return _utc_now().strftime("%Y%m%d_%H%M%S")


def read_tagged(spark: SparkSession, root: str, run_id: str, schema: T.StructType | None = None) -> DataFrame:
    """The stored clean + validate output of a run (the input of the later stages)."""
    path = Tables(root).tagged(run_id)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.parquet(path)


def stage_stats(tagged: DataFrame) -> dict:
    """Stage counts of a tagged table: one aggregate over a few narrow columns."""
    return tagged.agg(*[f().alias(n) for n, f in TAG_METRICS]).first().asDict()


def _numbered_rejects(rej: DataFrame) -> DataFrame:
    """Rejects with a ``row_ord`` that a later run gives the same row again.

    Rows of CSV files have a position that depends on how the files are split over tasks.
    Instead, the equal rows of one file (full path) are counted and numbered: the number of
    a row depends on its file's content only, and files of one name in different folders,
    or new content under an old path, stay apart by path and payload."""
    if not isinstance(rej.schema[S.ROW_ORD].dataType, T.StructType):
        return rej
    same = ["notification_id", "reject_reason", "payload", "stage", S.BATCH_ID, F.col(f"{S.ROW_ORD}.file").alias("_file")]
    counted = rej.groupBy(*same).agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return numbered.withColumn(S.ROW_ORD, F.xxhash64("_file", "_k")).drop("_file", "_n", "_k")


def stage_ingest(
    spark: SparkSession, landing: str | list[str], root: str, run_id: str, newest_only: bool = False
) -> DataFrame:
    """Ingest stage (K1, K2, S2): keep the landed rows and the manifest of their files under
    the run's id (with the files whose content an earlier run has landed marked), and return the kept rows, so that later stages read no CSV again.
    ``newest_only`` takes the file whose name sorts last and reads no other."""
    t = Tables(root)
    if newest_only:
        landing = exact_path(newest_file(spark, landing))
    raw = read_raw_csv(spark, landing)
    raw.write.mode("overwrite").parquet(f"{t.raw}/run_id={run_id}")
    kept = spark.read.schema(raw.schema).parquet(f"{t.raw}/run_id={run_id}")
    files = file_manifest(spark, landing, paths=True)
    earlier = read_or_empty(spark, t.manifest, MANIFEST_SCHEMA).where(F.col("run_id") != run_id)
    files = landed_before(files, earlier)
    _write_run_row(files.withColumn("run_id", F.lit(run_id)), t.manifest)
    return kept


def stage_clean_validate(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    run_id: str,
    as_of: str | None = None,
    rules=None,
) -> tuple[DataFrame, dict]:
    """Clean + validate stage (K3-K6, K9, A1, A2): tag every row, write the tagged table
    once (partitioned by outcome), the rejects and the two stage reports. Returns the
    stored tagged table and its stage counts."""
    now = _utc_now()
    t = Tables(root)
    # The clock is read once for a run, so that all its rows meet the same bound.
    run = Run(raw, as_of=as_of or now.strftime("%Y-%m-%d %H:%M:%S"), rules=list(rules or []))
    # The tagged rows are written once; the stage counts are one aggregate over the
    # written table, which reads only the few columns they need. (DataFrame.observe
    # would save that scan, but an observed session can no longer serialize pyspark.ml
    # models that keep a training summary.)
    run.tagged.withColumn("outcome", F.coalesce(F.col("stage"), F.lit("valid"))).write.mode(
        "overwrite"
    ).partitionBy("outcome").parquet(t.tagged(run_id))
    written = T.StructType(run.tagged.schema.fields + [T.StructField("outcome", T.StringType())])
    tagged = read_tagged(spark, root, run_id, written)
    st = stage_stats(tagged)

    publish_rejects(spark, tagged, root, run_id, now)

    # Stage reports (A1, A2 -> K7).
    reached = st["rows_in"] - st["clean_removed"]
    spark.createDataFrame(
        [(run_id, now, st["rows_in"], reached, st["duplicates"], st["bad_timestamps"], st["bad_seen"], st["bad_latency"])],
        "run_id string, computed_at timestamp_ntz, rows_in bigint, rows_out bigint, duplicates bigint, "
        "bad_timestamps bigint, bad_seen bigint, bad_latency bigint",
    ).transform(lambda d: _write_run_row(d, t.clean_metrics))
    valid_pct = round(100.0 * (reached - st["validation_rejected"]) / reached, 2) if reached else 0.0
    spark.createDataFrame(
        [(run_id, now, reached, reached - st["validation_rejected"], st["validation_rejected"], valid_pct)],
        "run_id string, computed_at timestamp_ntz, total bigint, valid bigint, rejected bigint, valid_pct double",
    ).transform(lambda d: _write_run_row(d, t.validation_report))
    return tagged, st


def publish_rejects(spark: SparkSession, tagged: DataFrame, root: str, run_id: str, now: dt.datetime) -> None:
    """Rejects with reason and payload (K4, K6, K9), each row once over all runs: those not
    seen before are written under the run, checked (stage among the two that reject, reason and
    payload present) and published. The payload is a variant, so its fields can be queried."""
    if published.is_committed(spark, root, REJECTED, run_id):
        return
    t, load_id = Tables(root), published.new_load_id()
    rej = _numbered_rejects(load.reject_audit(validate.rejects(tagged)))
    rej = rej.withColumns(
        {
            "payload_sha": F.sha2("payload", 256),
            "payload": F.parse_json("payload"),
            "run_id": F.lit(run_id),
            "load_id": F.lit(load_id),
            "rejected_at": _now_literal(now),
        }
    )
    # Only batches of this run can hold the same rows again.
    keys = [S.BATCH_ID, "stage", S.ROW_ORD, "payload_sha"]
    seen = rejected_rows(spark, root).select(*keys).join(rej.select(S.BATCH_ID).distinct(), S.BATCH_ID, "left_semi")
    # ``rebalance``: AQE sizes the output tasks per partition value (splitting a hot
    # batch, merging small ones), so the table gets few, well-sized files.
    new = rej.join(seen, keys, "left_anti").select(*REJECT_SCHEMA.names)
    new.hint("rebalance", "stage", S.BATCH_ID).write.mode("append").partitionBy("load_id", "stage", S.BATCH_ID).parquet(t.rejected)
    staged = read_or_empty(spark, t.rejected, REJECT_SCHEMA).where(F.col("load_id") == load_id)
    rows = constraints.enforce(REJECTED, staged, constraints.reject_constraints())
    published.commit(spark, root, REJECTED, run_id, load_id, rows, now)


def rejected_rows(spark: SparkSession, root: str) -> DataFrame:
    """The published rejects of all runs."""
    return published.visible(read_or_empty(spark, Tables(root).rejected, REJECT_SCHEMA), root, REJECTED)


def _declared(spark: SparkSession, root: str, buckets: int | None = None) -> str:
    return published.declare(spark, Tables(root).destination, DEST_SCHEMA, ["load_id", S.BATCH_ID], load.ID, buckets)


def destination_rows(spark: SparkSession, root: str) -> DataFrame:
    """The published rows of the destination."""
    return published.visible(spark.table(_declared(spark, root)), root, DESTINATION)


def load_audits(spark: SparkSession, root: str) -> DataFrame:
    """The audit rows of the published loads."""
    return published.visible(read_or_empty(spark, Tables(root).load_audit, AUDIT_SCHEMA), root, DESTINATION)


def stage_load(
    spark: SparkSession,
    root: str,
    run_id: str,
    key: str | FernetKey,
    tagged: DataFrame | None = None,
    source: str = "",
    buckets: int | None = None,
) -> Row:
    """Load stage (J1, J2, K8, K10, K11, P12, P14): protect ids and insert the run's valid
    rows that the destination does not hold yet; returns the audit row.

    The rows are written under the run's id, checked against the table's constraints, and
    published with their audit by one commit. A run that has committed is not loaded again and
    gives the audit it gave. ``buckets`` is taken when the destination is new."""
    now = _utc_now()
    t = Tables(root)
    if published.is_committed(spark, root, DESTINATION, run_id):
        return load_audits(spark, root).where(F.col("run_id") == run_id).first()
    k = key if isinstance(key, FernetKey) else FernetKey(key)
    tagged = tagged if tagged is not None else read_tagged(spark, root, run_id)
    valid = validate.typed_valid(tagged)
    if isinstance(valid.schema[S.ROW_ORD].dataType, T.StructType):
        valid = valid.withColumn(S.ROW_ORD, F.xxhash64(S.ROW_ORD))
    name, load_id = _declared(spark, root, buckets), published.new_load_id()
    protected = load.protect_ids(valid, k, int(time.time()))
    new = load.new_rows(protected, destination_rows(spark, root)).withColumns(
        {"loaded_at": _now_literal(now), "run_id": F.lit(run_id), "load_id": F.lit(load_id)}
    )
    published.append(new, name, load.ID, published.buckets_of(spark, t.destination))
    staged = spark.table(name).where(F.col("load_id") == load_id)
    inserted = constraints.enforce(DESTINATION, staged, constraints.destination_constraints(), unique=load.ID)
    rows_in = valid.count()
    total = published.committed_rows(spark, root, DESTINATION) + inserted
    audit = spark.createDataFrame(
        [(source or run_id, rows_in, inserted, rows_in - inserted, total, load.CIPHER_NAME, load_id, now, run_id)], AUDIT_SCHEMA
    )
    constraints.enforce("load_audit", audit, constraints.audit_constraints())
    _write_run_row(audit, t.load_audit)
    published.commit(spark, root, DESTINATION, run_id, load_id, inserted, now)
    return audit.first()


def stage_kpis(
    spark: SparkSession, root: str, run_id: str, stats: dict | None = None
) -> list[Row]:
    """KPI stage (A3-A9 -> K7): the five KPIs over the destination after the load, with
    the run's reject counts; versioned by run. Returns the report rows."""
    now = _utc_now()
    t = Tables(root)
    st = stats if stats is not None else stage_stats(read_tagged(spark, root, run_id))
    counts = spark.createDataFrame(
        [(st["rows_in"], st["clean_removed"], st["validation_rejected"])],
        "rows_initial bigint, clean_removed bigint, validation_rejected bigint",
    )
    destination = destination_rows(spark, root)
    report = kpis.kpi_report(kpis.with_counts(kpis.stored_measures(destination), counts))
    rows = report.collect()  # five rows
    spark.createDataFrame(rows, report.schema).select(
        F.lit(run_id).alias("run_id"), _now_literal(now).alias("computed_at"), "*"
    ).transform(lambda d: _write_run_row(d, t.kpis))
    return rows


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    key: str | FernetKey,
    run_id: str | None = None,
    as_of: str | None = None,
    source: str = "",
) -> Row:
    """Run every stage over ``raw`` and write the tables under ``root``; returns the run
    summary row (A12). ``run_id`` names the run (P24: passed in, not read per stage).
    The stages can also be run one at a time on stored inputs: ``stage_clean_validate``,
    then ``stage_load`` and ``stage_kpis`` with the same ``run_id``."""
    run_id = run_id or new_run_id()
    tagged, st = stage_clean_validate(spark, raw, root, run_id, as_of=as_of)
    audit_row = stage_load(spark, root, run_id, key, tagged=tagged, source=source)
    rows = stage_kpis(spark, root, run_id, stats=st)
    inserted = audit_row["rows_inserted"]
    met = sum(1 for r in rows if r["met"])
    return Row(
        run_id=run_id,
        rows_in=st["rows_in"],
        clean_removed=st["clean_removed"],
        validation_rejected=st["validation_rejected"],
        valid=st["valid"],
        rows_inserted=inserted,
        rows_already_present=st["valid"] - inserted,
        destination_total=audit_row["destination_total"],
        kpis_met=f"{met}/{len(rows)}",
    )


def latest_kpis(spark: SparkSession, root: str) -> DataFrame:
    """K7 "latest": per KPI, the row of the most recent run."""
    runs = spark.read.parquet(Tables(root).kpis)
    row = F.struct(*[c for c in runs.columns if c != "kpi"])
    return runs.groupBy("kpi").agg(F.max_by(row, F.col("computed_at")).alias("_r")).select("kpi", "_r.*")


def reset_tables(spark: SparkSession, root: str) -> None:
    """Empty destination, rejected and load_audit (explicit call only). The commits go
    first, so that the rows are out of sight at once."""
    t = Tables(root)
    for table in (DESTINATION, REJECTED):
        published.forget(spark, root, table)
    spark.sql(f"DROP TABLE IF EXISTS {published.table_name(t.destination)}")
    for path, schema in ((t.destination, DEST_SCHEMA), (t.rejected, REJECT_SCHEMA), (t.load_audit, AUDIT_SCHEMA)):
        if path_exists(spark, path):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_model_outputs(comparison: DataFrame, correlation: DataFrame, out_dir: str) -> None:
    """Model metrics as JSON, correlation matrix as CSV (small, coalesced to 1)."""
    comparison.coalesce(1).write.mode("overwrite").json(f"{out_dir}/metrics")
    correlation.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out_dir}/correlation")
