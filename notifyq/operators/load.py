"""Load stage: protect ids (P12, P14), idempotent insert (J1, J2, K8, K11, U2),
destination coercions (P15), reject audit rows (K9, P16), load audit (A11, K10).

Idempotency is a join on ``notification_id``. The ids that the destination holds already
are found by an inner join, which reads only that column of the destination and can
broadcast the incoming ids where they are few, so that the destination stays in place;
an anti join could not broadcast its left side. The incoming rows are then anti-joined
with those hits alone. ``load_audit`` counts both sides of one snapshot; a stored run
takes its audit from the destination after the insert (``plans/runner``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq import schema as S
from notifyq.functions.protect import FernetKey, encrypt_columns
from notifyq.functions.text import mask_id

ID = "notification_id"
CIPHER_NAME = "Fernet"


def protect_ids(valid: DataFrame, key: str | FernetKey, issued_at: int | None = None) -> DataFrame:
    """P12 + P14: encrypt user ids into ``*_enc`` columns and drop the clear text."""
    out = encrypt_columns(valid, ["user_id", "source_user_id"], key, issued_at, row_key=ID)
    return out.drop("user_id", "source_user_id")


def destination_ids(destination: DataFrame) -> DataFrame:
    """Only the key column of the destination (column pruning reaches the scan)."""
    return destination.select(ID)


def existing_ids(batch: DataFrame, destination: DataFrame) -> DataFrame:
    """The incoming ids that the destination, whose ids are unique, already holds."""
    return destination_ids(destination).join(batch.select(ID), ID)


def new_rows(batch: DataFrame, destination: DataFrame) -> DataFrame:
    """Incoming rows whose id is not in the destination."""
    return batch.join(existing_ids(batch, destination), ID, "left_anti")


def load_into(batch: DataFrame, destination: DataFrame) -> DataFrame:
    """The destination after an idempotent insert of ``batch``."""
    return destination.unionByName(new_rows(batch, destination), allowMissingColumns=True)


def load_audit(
    batch: DataFrame, destination: DataFrame, source: str = "", cipher: str = CIPHER_NAME
) -> DataFrame:
    """Rows in, inserted, already present and destination total after load.

    One full outer join of the incoming ids with the destination ids gives all three
    counts in one aggregate (incoming rows, rows on both sides, destination rows), so
    each side is read once; ids are unique on both sides (the destination's key, and
    the deduplicated valid rows).
    """
    incoming = batch.select(F.col(ID).alias("_in"))
    present = destination_ids(destination).select(F.col(ID).alias("_dest"))
    row = incoming.join(present, F.col("_in") == F.col("_dest"), "full_outer").agg(
        F.count("_in").alias("rows_in"),
        F.count_if(F.col("_in").isNotNull() & F.col("_dest").isNotNull()).alias("rows_already_present"),
        F.count("_dest").alias("destination_before"),
    )
    return row.select(
        F.lit(source).alias("source_file"),
        F.col("rows_in"),
        (F.col("rows_in") - F.col("rows_already_present")).alias("rows_inserted"),
        F.col("rows_already_present"),
        (F.col("destination_before") + F.col("rows_in") - F.col("rows_already_present")).alias(
            "destination_total"
        ),
        F.lit(cipher).alias("cipher"),
    )


def destination_coercions(destination: DataFrame) -> DataFrame:
    """The relational copy's rules: optional ids null when blank, ``seen`` boolean,
    latency integer with missing or unparseable values stored as 0."""
    out = destination
    for c in ("post_id", "comment_id"):
        if c in out.columns:
            out = out.withColumn(c, F.nullif(F.trim(F.col(c)), F.lit("")))
    if "latency_ms" in out.columns:
        out = out.withColumn(
            "latency_ms", F.coalesce(F.col("latency_ms").try_cast("double").try_cast("int"), F.lit(0))
        )
    if "seen" in out.columns:
        out = out.withColumn("seen", F.coalesce(F.col("seen").cast("boolean"), F.lit(False)))
    return out


def payload_counts(audit: DataFrame, field: str) -> DataFrame:
    """Rejects by stage and one field of their payload, which may be JSON text or a variant;
    a payload without the field counts under null."""
    payload = F.col("payload")
    if isinstance(audit.schema["payload"].dataType, T.StringType):
        payload = F.parse_json(payload)
    value = F.variant_get(payload, f"$.{field}", "string")
    return audit.select("stage", value.alias(field)).groupBy("stage", field).agg(F.count(F.lit(1)).alias("rows"))


@dataclass
class RejectPayloadOptions:
    mask_ids: bool = True


def reject_audit(
    rejected: DataFrame, options: RejectPayloadOptions | None = None
) -> DataFrame:
    """K9 + P16: one audit row per reject: id, stage, reason and a JSON payload of the
    row as text with nulls kept. User ids are masked in the payload unless disabled."""
    opts = options or RejectPayloadOptions()
    fields = []
    for c in S.RAW_COLUMNS:
        v = F.col(c).cast("string")
        if opts.mask_ids and c in ("user_id", "source_user_id"):
            v = F.when(F.col(c).isNotNull(), mask_id(F.col(c)))
        fields.append(v.alias(c))
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    extra = [c for c in (S.ROW_ORD, S.BATCH_ID) if c in rejected.columns]
    return rejected.select(
        F.col(ID),
        F.col("stage"),
        F.col("reject_reason"),
        payload.alias("payload"),
        *extra,
    )
