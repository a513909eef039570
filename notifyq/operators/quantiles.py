"""Exact percentiles by distributed selection.

``percentile`` keeps every distinct value of the input in one buffer, which grows with the data
where values are measured numbers. Here each wanted rank is closed in on instead: a sketch of
bounded size gives two values that lie closely around it, one aggregate counts the rows below,
at and between them exactly, and the search goes on with the rows in between. A pass leaves a few
ten-thousandths of the rows, so it ends after one or two; when few enough are left they are
looked at. The driver sees one row for each pass and at most ``KEEP`` values for each rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that the driver looks at, for each rank, at most.
KEEP = 1 << 14
#: Accuracy of the sketch: its values are at most rows / ACCURACY ranks away.
ACCURACY = 10_000


@dataclass(frozen=True)
class Search:
    """The value of rank ``rank`` (from 0) among the rows between ``low`` and ``high``, both
    excluded and None for no bound, of which there are ``rows``."""

    rank: int
    rows: int
    low: float | None = None
    high: float | None = None

    def inside(self, v: Column) -> Column:
        out = F.lit(True)
        if self.low is not None:
            out = out & (v > F.lit(self.low))
        if self.high is not None:
            out = out & (v < F.lit(self.high))
        return out


def _near(values: DataFrame, searches: Sequence[Search]) -> list[tuple[float, float]]:
    """Two values around each rank, from one sketch for each search."""
    v = F.col("v")
    sketches = []
    for k, s in enumerate(searches):
        margin = 2 / ACCURACY
        at = s.rank / s.rows
        around = F.array(F.lit(max(0.0, at - margin)), F.lit(min(1.0, at + margin)))
        sketches.append(F.percentile_approx(F.when(s.inside(v), v), around, ACCURACY).alias(f"s{k}"))
    row = values.agg(*sketches).first()
    return [tuple(row[f"s{k}"]) for k in range(len(searches))]


def _narrowed(values: DataFrame, searches: Sequence[Search]) -> list[Search | float]:
    """Each search between closer bounds, or the value found."""
    v = F.col("v")
    bounds = _near(values, searches)
    counts = []
    for k, (s, (a, b)) in enumerate(zip(searches, bounds)):
        tests = {"below": v < a, "at_a": v == a, "between": (v > a) & (v < b), "at_b": v == b}
        counts += [F.count_if(s.inside(v) & test).alias(f"{name}{k}") for name, test in tests.items()]
    row = values.agg(*counts).first()
    out: list[Search | float] = []
    for k, (s, (a, b)) in enumerate(zip(searches, bounds)):
        below, at_a, between, at_b = (row[f"{name}{k}"] for name in ("below", "at_a", "between", "at_b"))
        if a == b:
            at_b = 0
        rest = s.rank - below
        if rest < 0:
            out.append(replace(s, rows=below, high=a))
        elif rest < at_a:
            out.append(a)
        elif rest < at_a + between:
            out.append(Search(rest - at_a, between, a, b))
        elif rest < at_a + between + at_b:
            out.append(b)
        else:
            out.append(Search(rest - at_a - between - at_b, s.rows - below - at_a - between - at_b, b, s.high))
    return out


def ranked_values(values: DataFrame, rows: int, ranks: Sequence[int]) -> dict[int, float]:
    """The value at each rank (from 0) of the ``rows`` non-null values in column v."""
    open_: dict[int, Search] = {r: Search(r, rows) for r in set(ranks)}
    found: dict[int, float] = {}
    while open_:
        few = {r: s for r, s in open_.items() if s.rows <= KEEP}
        for bounds in {(s.low, s.high) for s in few.values()}:
            mine = {r: s for r, s in few.items() if (s.low, s.high) == bounds}
            held = sorted(x["v"] for x in values.where(next(iter(mine.values())).inside(F.col("v"))).collect())
            found |= {r: held[s.rank] for r, s in mine.items()}
        wide = {r: s for r, s in open_.items() if r not in few}
        open_ = {}
        if wide:
            for r, got in zip(wide, _narrowed(values, list(wide.values()))):
                if isinstance(got, Search):
                    open_[r] = got
                else:
                    found[r] = got
    return found


def exact_percentiles(rows: DataFrame, value: Column, fractions: Sequence[float]) -> list[float | None]:
    """Percentiles of the non-null values, interpolated between neighbours; None without any.

    ``rows`` is read a few times: hand in a stored table, or a checkpoint of a costly plan."""
    values = rows.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    n = values.count()
    if not n:
        return [None] * len(fractions)
    at = [(n - 1) * f for f in fractions]
    held = ranked_values(values, n, [r for x in at for r in (math.floor(x), math.ceil(x))])
    out = []
    for x in at:
        low, high = math.floor(x), math.ceil(x)
        out.append(held[low] if low == high else (high - x) * held[low] + (x - low) * held[high])
    return out


def modes(counts: DataFrame, by: Sequence[str], value: str, count: str) -> DataFrame:
    """(by..., value): the most frequent non-null value of each group, the smallest of equals,
    from counted values; each group's state is one value."""
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col(count)).alias("n"), F.col(value).alias("v"))))
    return counts.groupBy(*by).agg(best.alias("_b")).select(*by, F.col("_b.v").alias(value))
