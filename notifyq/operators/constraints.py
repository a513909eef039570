"""Table constraints (K8, K9): not null, domain and unique, tested in one aggregate before rows
are published. A load that breaks one stops and says which rows do."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notifyq import schema as S


@dataclass(frozen=True)
class Constraint:
    """A rule of a table; ``broken`` is true of the rows against it."""

    name: str
    broken: Column


def not_null(*columns: str) -> list[Constraint]:
    return [Constraint(f"{c} is not null", F.col(c).isNull()) for c in columns]


def domain(column: str, values: Sequence[str]) -> Constraint:
    """Values outside the list break it; null is for ``not_null``."""
    return Constraint(f"{column} in ({', '.join(values)})", ~F.col(column).isin(*values))


class ConstraintError(ValueError):
    """Rows against the constraints of a table: how many against each, and some of them."""

    def __init__(self, table: str, counts: dict[str, int], rows: list[dict]):
        self.table, self.counts, self.rows = table, counts, rows
        told = "; ".join(f"{name}: {n} rows" for name, n in counts.items())
        super().__init__(f"{table}: {told}; such as {rows}")


def broken_counts(rows: DataFrame, constraints: Sequence[Constraint], unique: str | None = None) -> DataFrame:
    """One row: the number of rows (``rows``) and of rows against each constraint (c0, c1, ...);
    with ``unique`` also the number of rows that share its value (``shared``). One aggregate
    serves all: per value of ``unique`` first, pre-aggregated in each task, then over all."""
    found = [F.count_if(c.broken).alias(f"c{k}") for k, c in enumerate(constraints)]
    names = [f"c{k}" for k in range(len(constraints))]
    if unique is None:
        return rows.agg(F.count(F.lit(1)).alias("rows"), *found)
    each = rows.groupBy(F.col(unique).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *found)
    shared = F.sum(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), F.col("_n")).otherwise(F.lit(0)))
    zero = F.lit(0).cast("bigint")
    return each.agg(
        F.coalesce(F.sum("_n"), zero).alias("rows"),
        *[F.coalesce(F.sum(c), zero).alias(c) for c in names],
        F.coalesce(shared, zero).alias("shared"),
    )


def enforce(
    table: str, rows: DataFrame, constraints: Sequence[Constraint], unique: str | None = None, show: int = 20
) -> int:
    """The number of rows, if none breaks a constraint; else ConstraintError with up to
    ``show`` of those that do."""
    told = broken_counts(rows, constraints, unique).first()
    counts = {c.name: told[f"c{k}"] for k, c in enumerate(constraints) if told[f"c{k}"]}
    if unique is not None and told["shared"]:
        counts[f"{unique} is unique"] = told["shared"]
    if not counts:
        return told["rows"]
    bad = [c.broken for c in constraints if c.name in counts]
    some = []
    if bad:
        either = bad[0]
        for more in bad[1:]:
            either = either | more
        some = rows.where(F.coalesce(either, F.lit(False))).limit(show).collect()
    if len(some) < show and f"{unique} is unique" in counts:
        keys = rows.groupBy(unique).agg(F.count(F.lit(1)).alias("copies")).where(F.col(unique).isNotNull() & (F.col("copies") > 1))
        some += keys.limit(show - len(some)).collect()
    raise ConstraintError(table, counts, [r.asDict() for r in some])


#: Columns that every row of the destination has. Latency may be null here: a missing one is
#: stored as such (``load.destination_coercions`` gives the relational 0).
DESTINATION_NOT_NULL = [
    "notification_id", "event_id", "event_type", "user_id_enc", "source_user_id_enc", "created_at", "device",
    "delivery_channel", "priority", "seen", "status", "app_version", "country",
]


def destination_constraints() -> list[Constraint]:
    return not_null(*DESTINATION_NOT_NULL)


def reject_constraints() -> list[Constraint]:
    return [*not_null("stage", "reject_reason", "payload"), domain("stage", [S.STAGE_CLEAN, S.STAGE_VALIDATE])]


def audit_constraints() -> list[Constraint]:
    return not_null("source_file", "rows_in", "rows_inserted", "rows_already_present", "destination_total", "cipher")
