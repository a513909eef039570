"""One data-quality run as lazy DataFrames.

``prepare_run`` wires the stages over a raw landing table: normalise -> clean tags ->
validation tags -> {valid, rejected} -> load -> KPIs. Nothing executes here; each sink
or query is one Catalyst plan. The only shuffles in the row path are the id statistics
and its join (clean.py), and the destination id join of the load.

Scenario used when the raw table comes from several landing batches (``batch_id``):
earlier daily runs already loaded the valid rows of every batch but the newest, so
this run's load inserts the newest batch and reports the rest as already present.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.functions.protect import FernetKey, generate_key
from notifyq.operators import clean, kpis, load, validate
from notifyq.operators.rules import Rule, default_rules
from notifyq.sources.files import latest_batch_id


@dataclass
class Run:
    raw: DataFrame
    as_of: str = S.DEFAULT_AS_OF
    rules: list[Rule] = field(default_factory=list)
    key: FernetKey | None = None
    issued_at: int = 0
    # A7 opt-in: approx_percentile for P95 (bounded sketch) instead of the exact value.
    approximate_p95: bool = False

    def __post_init__(self):
        if not self.rules:
            self.rules = default_rules(self.as_of)
        if self.key is None:
            self.key = FernetKey(generate_key())

    # ---- clean + validate ------------------------------------------------------------
    @cached_property
    def normalised(self) -> DataFrame:
        return clean.normalise(self.raw)

    @cached_property
    def tagged(self) -> DataFrame:
        return validate.tag_validation(clean.tag_clean(self.normalised), self.rules)

    @cached_property
    def valid(self) -> DataFrame:
        return validate.typed_valid(self.tagged)

    @cached_property
    def rejected(self) -> DataFrame:
        return validate.rejects(self.tagged)

    # ---- batches and load --------------------------------------------------------------
    @cached_property
    def latest_batch(self) -> DataFrame:
        return latest_batch_id(self.raw)

    def _in_latest(self, df: DataFrame, latest: bool) -> DataFrame:
        # A scalar subquery: Spark runs the one-value aggregate once and the test is a
        # plain filter (and a partition filter on a batch_id-partitioned table).
        newest = self.latest_batch.scalar()
        cond = F.col(S.BATCH_ID) == newest if latest else F.col(S.BATCH_ID) < newest
        return df.where(cond)

    @cached_property
    def protected_valid(self) -> DataFrame:
        return load.protect_ids(self.valid, self.key, self.issued_at)

    @cached_property
    def prior_destination(self) -> DataFrame:
        """What the earlier daily runs loaded: valid rows of all but the newest batch."""
        return self._in_latest(self.protected_valid, latest=False)

    @cached_property
    def prior_ids(self) -> DataFrame:
        return self._in_latest(self.valid, latest=False).select("notification_id")

    @cached_property
    def destination(self) -> DataFrame:
        """The destination after this run's idempotent load (prior rows + new rows).

        Earlier runs loaded the valid rows of the earlier batches, so those rows are
        present; a row of the newest batch is inserted unless its id is already there
        (J2). One left join of the incoming rows with the loaded ids gives both, instead
        of a union of two separately computed branches.
        """
        present = self.prior_ids.withColumn("_present", F.lit(True))
        flagged = self.protected_valid.join(present, "notification_id", "left")
        newest = self.latest_batch.scalar()
        keep = (F.col(S.BATCH_ID) < newest) | F.col("_present").isNull()
        return flagged.where(keep).drop("_present")

    # ---- KPIs ------------------------------------------------------------------------------
    @cached_property
    def counts(self) -> DataFrame:
        return kpis.run_counts(self.tagged)

    @cached_property
    def kpi_values(self) -> DataFrame:
        return kpis.run_kpi_values(self.tagged, approximate_p95=self.approximate_p95)

    @cached_property
    def kpi_report(self) -> DataFrame:
        return kpis.kpi_report(self.kpi_values)
