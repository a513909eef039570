"""KPI stage.

All KPIs of a run come from one global aggregate over the tagged rows: a partial aggregate
per task plus a single-row merge. Its exact P95 (``percentile``) keeps a value -> count map of
the whole milliseconds; ``approx_percentile`` is available as an option. A stored destination,
which grows without end, has its own aggregate and finds its P95 by distributed selection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.operators.quantiles import exact_percentiles


def _d(x: float) -> Column:
    return F.lit(float(x)).cast("double")


def _pct(num: Column, den: Column) -> Column:
    """100 * num / den, 0 when den is 0 (Q19)."""
    return F.coalesce(F.try_divide(num.cast("double") * _d(100.0), den), _d(0.0))


def sent_with_latency() -> Column:
    """C4: SENT rows with a numeric latency."""
    return (F.col("status") == "SENT") & F.col("latency_ms").try_cast("double").isNotNull()


def _measures(present: Sequence[str], rows: Column, approximate_p95: bool) -> list[Column]:
    """Completeness of the given columns (A3), SLA (A5, C5), mean (A6) and P95 (A7) latency."""
    lat = F.col("latency_ms").try_cast("double")
    sent = sent_with_latency()
    non_null = None
    for c in present:
        term = F.count(F.col(c))
        non_null = term if non_null is None else non_null + term
    cells = rows * F.lit(len(present))
    if approximate_p95:
        p95 = F.percentile_approx(F.when(sent, lat), F.lit(S.LATENCY_PERCENTILE), F.lit(10000))
    else:
        p95 = F.percentile(F.when(sent, lat), F.lit(S.LATENCY_PERCENTILE))
    return [
        rows.alias("destination_rows"),
        _pct(non_null if non_null is not None else F.lit(0), cells).alias("completeness_pct"),
        F.count_if(sent).alias("sent_rows"),
        _pct(F.count_if(sent & (lat <= S.SLA_MAX_LATENCY_MS)), F.count_if(sent)).alias(
            "sla_compliance_pct"
        ),
        F.coalesce(F.avg(F.when(sent, lat)), _d(0.0)).alias("avg_latency_ms"),
        F.coalesce(p95.cast("double"), _d(0.0)).alias("p95_latency_ms"),
    ]


def stored_measures(destination: DataFrame, mandatory: Sequence[str] = S.MANDATORY_COLUMNS) -> DataFrame:
    """``destination_measures`` of a stored table of any size: the exact P95 by distributed
    selection over its two columns, instead of a buffer of all distinct latencies."""
    sent = destination.where(sent_with_latency())
    p95 = exact_percentiles(sent, F.col("latency_ms"), [S.LATENCY_PERCENTILE])[0]
    row = destination_measures(destination, mandatory, approximate_p95=True)
    return row.withColumn("p95_latency_ms", _d(0.0 if p95 is None else p95))


def destination_measures(
    destination: DataFrame,
    mandatory: Sequence[str] = S.MANDATORY_COLUMNS,
    approximate_p95: bool = False,
) -> DataFrame:
    """One row: completeness (A3), SLA (A5, C5), mean (A6) and P95 (A7) latency."""
    present = [c for c in mandatory if c in destination.columns]
    return destination.agg(*_measures(present, F.count(F.lit(1)), approximate_p95))


def _counts(counted: Column) -> list[Column]:
    return [
        F.count_if(counted).alias("rows_initial"),
        F.count_if(counted & (F.col("stage") == S.STAGE_CLEAN)).alias("clean_removed"),
        F.count_if(counted & (F.col("stage") == S.STAGE_VALIDATE)).alias("validation_rejected"),
    ]


def run_counts(tagged: DataFrame) -> DataFrame:
    """One row: initial rows, clean removals, validation rejects (A4 inputs, A10)."""
    return tagged.agg(*_counts(F.lit(True)))


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Merge one-row frames with disjoint columns into one row (union + max, no join)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols.extend(f.columns)
    return out.agg(*[F.max(c).alias(c) for c in cols])


def kpi_values(destination: DataFrame, counts: DataFrame, approximate_p95: bool = False) -> DataFrame:
    """One row with the five unrounded KPI values and their inputs."""
    return with_counts(destination_measures(destination, approximate_p95=approximate_p95), counts)


def with_counts(measures: DataFrame, counts: DataFrame) -> DataFrame:
    """The measures of a destination and the counts of a run as one row of KPI values."""
    return _with_reject_rate(combine_rows(measures, counts))


def run_kpi_values(
    tagged: DataFrame, counted: Column | None = None, approximate_p95: bool = False
) -> DataFrame:
    """The row of ``kpi_values`` from one aggregate over the tagged rows of a run.

    Ids are unique among them after the clean stage, so the destination after the load
    holds the valid rows. A protected id is null where the clear one is, so the ids are
    counted without enciphering them. ``counted`` limits the rows of the reject rate.
    """
    loaded = F.col("reject_reason").isNull()
    source = {"created_at": "created_ts", "seen": "seen_bool"}
    cells = {
        c: F.when(loaded, F.col(source.get(c, c.removesuffix("_enc")))) for c in S.MANDATORY_COLUMNS
    }
    cells["status"] = F.when(loaded, F.col("status"))
    cells["latency_ms"] = F.when(loaded, F.col("latency_num").try_cast("bigint"))
    rows = tagged.select(
        "stage",
        loaded.alias("_loaded"),
        (F.lit(True) if counted is None else counted).alias("_counted"),
        *[v.alias(c) for c, v in cells.items()],
    )
    return _with_reject_rate(
        rows.agg(
            *_measures(S.MANDATORY_COLUMNS, F.count_if("_loaded"), approximate_p95),
            *_counts(F.col("_counted")),
        )
    )


def _with_reject_rate(row: DataFrame) -> DataFrame:
    rejected = F.col("clean_removed") + F.col("validation_rejected")
    return row.withColumn("rejected_total", rejected).withColumn(
        "reject_rate_pct", _pct(rejected, F.col("rows_initial"))
    )


def kpi_report(values: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(kpi, value rounded to 2, target, met) in report order; ``met`` is decided on
    the unrounded value, higher- or lower-is-better per KPI."""
    items = []
    for i, (name, target, higher) in enumerate(S.KPI_TARGETS):
        v = F.col(name)
        met = v >= _d(target) if higher else v <= _d(target)
        items.append(
            F.struct(
                F.lit(i).alias("kpi_order"),
                F.lit(name).alias("kpi"),
                F.round(v, 2).alias("value"),
                _d(target).alias("target"),
                F.lit(higher).alias("higher_is_better"),
                met.alias("met"),
            )
        )
    return values.select(*keep, F.inline(F.array(*items)))


def kpi_alerts(report: DataFrame) -> DataFrame:
    """Number of KPIs off target and the "met/total" text."""
    return report.agg(
        F.count_if(~F.col("met")).alias("alerts"),
        F.count_if(F.col("met")).alias("met"),
        F.count(F.lit(1)).alias("kpis"),
    ).select(
        "alerts",
        "met",
        "kpis",
        F.concat(F.col("met").cast("string"), F.lit("/"), F.col("kpis").cast("string")).alias(
            "met_text"
        ),
    )


def errors_by_stage(counts: DataFrame) -> DataFrame:
    """A10: errors per stage; ingest and load have no row-level errors (0)."""
    items = [
        F.struct(F.lit(0).alias("stage_order"), F.lit(S.STAGE_INGEST).alias("stage"), F.lit(0).cast("bigint").alias("errors")),
        F.struct(F.lit(1).alias("stage_order"), F.lit(S.STAGE_CLEAN).alias("stage"), F.col("clean_removed").cast("bigint").alias("errors")),
        F.struct(F.lit(2).alias("stage_order"), F.lit(S.STAGE_VALIDATE).alias("stage"), F.col("validation_rejected").cast("bigint").alias("errors")),
        F.struct(F.lit(3).alias("stage_order"), F.lit(S.STAGE_LOAD).alias("stage"), F.lit(0).cast("bigint").alias("errors")),
    ]
    return counts.select(F.inline(F.array(*items)))


def raw_completeness(raw: DataFrame, columns: Sequence[str] = S.RAW_COLUMNS) -> DataFrame:
    """Q18: the completeness measure on raw rows (non-blank cells / all cells), since on
    the destination it is 100 by construction."""
    non_blank = None
    for c in columns:
        term = F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
        non_blank = term if non_blank is None else non_blank + term
    return raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(_pct(non_blank, F.count(F.lit(1)) * F.lit(len(columns))), 4).alias(
            "raw_completeness_pct"
        ),
    )
