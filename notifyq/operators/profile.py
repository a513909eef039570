"""Profiling of the labelled rows.

Labelled rows are the tagged frame itself: every input row is either valid (label 0) or
rejected at clean or validation (label 1), so "valid union rejected" is a projection,
not a union of two scans. Every profile is a global or low-cardinality aggregate:
partial aggregation per task, then a merge of at most a few hundred groups. Exact
percentiles are found by distributed selection and modes by counting values first
(``quantiles``), so no buffer holds all distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.functions.text import is_feature_blank, strip_ws
from notifyq.operators.quantiles import exact_percentiles, modes
from notifyq.session import checkpoint_dir

LABELLED_COLUMNS = S.RAW_COLUMNS + ["reject_reason", "label"]


def labelled_rows(tagged: DataFrame) -> DataFrame:
    """The 16 text columns, the reason and the 0/1 label."""
    extra = [c for c in (S.ROW_ORD, S.BATCH_ID) if c in tagged.columns]
    return tagged.select(*LABELLED_COLUMNS, *extra)


def model_features(tagged: DataFrame) -> DataFrame:
    """M1 (P17, P19-P21, D3): 7 categorical + 9 numeric features, key and label.

    ``dup_notification_id`` uses the per-id copy count computed once by the clean stage
    (``id_copies``), so it costs no extra shuffle.
    """
    lat = F.col("latency_num")
    ts = F.col("created_ts")
    user = F.col("user_id")
    source = F.col("source_user_id")
    n_missing = None
    for c in S.ID_FIELDS:
        term = is_feature_blank(c).cast("int")
        n_missing = term if n_missing is None else n_missing + term
    cats = [F.upper(strip_ws(c)).alias(c) for c in S.CATEGORICAL_FEATURES]
    nums = [
        lat.alias("latency_ms_num"),
        F.hour(ts).alias("hour"),
        ts.isNull().cast("int").alias("ts_invalid"),
        F.coalesce(lat < 0, F.lit(False)).cast("int").alias("latency_negative"),
        (user.isNotNull() & source.isNotNull() & (user == source)).cast("int").alias("self_event"),
        n_missing.alias("n_missing_fields"),
        ((F.col("id_copies") > 1) & ~is_feature_blank("notification_id")).cast("int").alias(
            "dup_notification_id"
        ),
        is_feature_blank("post_id").cast("int").alias("missing_post_id"),
        is_feature_blank("comment_id").cast("int").alias("missing_comment_id"),
    ]
    return tagged.select(F.col(S.ROW_ORD), F.col("notification_id"), *cats, *nums, F.col("label"))


def duplicate_id_rows(tagged: DataFrame) -> DataFrame:
    """D3: every copy of an id that occurs more than once (blank ids excluded)."""
    cond = (F.col("id_copies") > 1) & ~is_feature_blank("notification_id")
    return tagged.where(cond).select("notification_id", S.ROW_ORD, "id_copies", "label")


def exact_duplicates(labelled: DataFrame, columns: Sequence[str] = LABELLED_COLUMNS) -> DataFrame:
    """Rows that repeat another row in every column (nulls equal).

    Rows are compared by a SHA-256 digest of their JSON text, so the distinct count
    shuffles 32 bytes per row instead of the whole row.
    """
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)
    return labelled.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(digest).alias("distinct_rows")
    ).select("rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows")).alias("exact_duplicates"))


def label_distribution(labelled: DataFrame) -> DataFrame:
    """Rows per label and the share of the total. The total is a window over the
    grouped result (one row per label), so the rows are scanned once."""
    from pyspark.sql import Window

    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    return counts.select(
        "label", "rows", F.round(F.col("rows") * F.lit(100.0).cast("double") / total, 1).alias("pct")
    )


def null_profile(labelled: DataFrame, columns: Sequence[str] = LABELLED_COLUMNS) -> DataFrame:
    """A14 + C6 + T2: null count and % per column, columns with nulls only."""
    agg = labelled.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(columns)],
    )
    items = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("nulls")) for i, c in enumerate(columns)]
    )
    return (
        agg.select("_n", F.inline(items))
        .where(F.col("nulls") > 0)
        .select(
            "column_name",
            "nulls",
            F.round(F.col("nulls") * F.lit(100.0).cast("double") / F.col("_n"), 1).alias("null_pct"),
        )
    )


def latency_stats(tagged: DataFrame) -> DataFrame:
    """Mean, median, mode (smallest on ties), min, p25, p75, max; 1 digit.

    The latencies alone are kept in the checkpoint folder, as the exact percentiles take a few
    passes (``quantiles``); the mode is the best of the counted values."""
    checkpoint_dir(tagged.sparkSession)
    kept = tagged.select(F.col("latency_num").alias("v")).where(F.col("v").isNotNull()).checkpoint()
    median, p25, p75 = exact_percentiles(kept, F.col("v"), [0.5, 0.25, 0.75])
    counted = kept.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    row = counted.agg(
        F.try_divide(F.sum(F.col("v") * F.col("n")), F.sum("n")).alias("mean"),
        F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("mode"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    measures = [
        ("mean", F.col("mean")),
        ("median", F.lit(median)),
        ("mode", F.col("mode")),
        ("min", F.col("min")),
        ("p25", F.lit(p25)),
        ("p75", F.lit(p75)),
        ("max", F.col("max")),
    ]
    items = F.array(
        *[
            F.struct(F.lit(i).alias("measure_order"), F.lit(n).alias("measure"), F.round(v.cast("double"), 1).alias("latency_ms"))
            for i, (n, v) in enumerate(measures)
        ]
    )
    return row.select(F.inline(items))


def category_modes(labelled: DataFrame, columns: Sequence[str] = S.PROFILE_CATEGORIES) -> DataFrame:
    """Most frequent value per category column (nulls ignored, ties -> smallest).

    Equal rows of the categories are counted first, inside each task and then by key; only
    their counts are unpivoted, counted by (column, value), and the best of them taken."""
    tuples = labelled.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    each = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("mode")) for c in columns])
    counted = tuples.select("n", F.inline(each)).groupBy("variable", "mode").agg(F.sum("n").alias("n"))
    # A column without a value keeps its row, with a null mode.
    return modes(counted, ["variable"], "mode", "n")


def value_counts(labelled: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value of one column."""
    return labelled.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def reject_rate_by(labelled: DataFrame, column: str) -> DataFrame:
    """A20 + T3: share of rejected rows per non-null value."""
    return (
        labelled.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("label"), 4).alias("reject_rate"))
    )


def latency_histogram(tagged: DataFrame, bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between min and max (the max falls in the last bin); every
    bin is listed, empty ones with 0."""
    lat = F.col("latency_num")
    values = tagged.where(lat.isNotNull())
    # One scalar subquery for both bounds (each subquery is a pass over the input).
    bounds = values.agg(F.struct(F.min(lat).alias("lo"), F.max(lat).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = (hi - lo) / F.lit(bins)
    pos = F.coalesce(F.floor(F.try_divide(lat - lo, hi - lo) * bins), F.lit(0))
    counts = values.select(F.least(F.lit(bins), pos + 1).cast("int").alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("rows")
    )
    # One row per bin, derived from the bin counts (the same aggregate, so Spark reuses
    # its exchange) -- an empty input has no bins.
    grid = counts.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 0).select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    return (
        grid.join(counts, "bin", "left")
        .select(
            "bin",
            F.round(lo + (F.col("bin") - 1) * width, 4).alias("bin_start"),
            F.round(lo + F.col("bin") * width, 4).alias("bin_end"),
            F.coalesce(F.col("rows"), F.lit(0).cast("bigint")).alias("rows"),
        )
    )


def _merged(parts: Column) -> Column:
    """Moments of the union of disjoint parts (n, a, b, ab, aa, bb): sizes, means of two
    columns, and their co-moments around these means (Chan's update)."""

    def add(acc: Column, x: Column) -> Column:
        n = acc["n"] + x["n"]
        weight = acc["n"] * x["n"] / n
        da, db = x["a"] - acc["a"], x["b"] - acc["b"]
        return F.struct(
            n.alias("n"),
            (acc["a"] + da * x["n"] / n).alias("a"),
            (acc["b"] + db * x["n"] / n).alias("b"),
            (acc["ab"] + x["ab"] + da * db * weight).alias("ab"),
            (acc["aa"] + x["aa"] + da * da * weight).alias("aa"),
            (acc["bb"] + x["bb"] + db * db * weight).alias("bb"),
        )

    none = F.struct(*[_zero().alias(c) for c in ("n", "a", "b", "ab", "aa", "bb")])
    return F.aggregate(parts, none, add)


def _zero() -> Column:
    return F.lit(0.0).cast("double")


def correlation_matrix(features: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation, 2 digits, null for zero variance.

    Rows are grouped by which columns are null, at most a few patterns, and each pattern gets
    its size, means and covariances in one aggregate: each row goes in once, as it is. A pair's
    rows are those of the patterns that hold both columns, so its moments are merged from these.
    ``try_divide`` makes zero variance null instead of an ANSI error (``corr`` raises).
    """
    cols = list(columns) if columns is not None else S.NUMERIC_FEATURES + ["label"]
    at = range(len(cols))
    pairs = [(i, j) for i in at for j in at if i <= j]
    there = F.concat(*[F.col(f"x{i}").isNotNull().cast("int").cast("string") for i in at])
    rows = features.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    patterns = rows.groupBy(there.alias("there")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in at],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs],
    )
    moments = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.lit(j).alias("j"),
                F.struct(
                    "n",
                    F.col(f"m{i}").alias("a"),
                    F.col(f"m{j}").alias("b"),
                    (F.col(f"c{i}_{j}") * F.col("n")).alias("ab"),
                    (F.col(f"c{i}_{i}") * F.col("n")).alias("aa"),
                    (F.col(f"c{j}_{j}") * F.col("n")).alias("bb"),
                ).alias("part"),
            )
            for i, j in pairs
        ]
    )
    held = (F.substring("there", F.col("i") + 1, F.lit(1)) == "1") & (F.substring("there", F.col("j") + 1, F.lit(1)) == "1")
    per_pair = (
        patterns.select("there", F.inline(moments))
        .groupBy("i", "j")
        .agg(F.sort_array(F.collect_list(F.when(held, F.col("part")))).alias("parts"))
        .withColumn("all", _merged(F.col("parts")))
        .select("i", "j", F.try_divide(F.col("all.ab"), F.sqrt("all.aa") * F.sqrt("all.bb")).alias("c"))
    )
    names = F.array(*[F.lit(c) for c in cols])
    fwd = F.struct(F.col("i").alias("x"), F.col("j").alias("y"), F.col("c"))
    rev = F.struct(F.col("j").alias("x"), F.col("i").alias("y"), F.col("c"))
    # The full symmetric matrix: every off-diagonal pair in both orders.
    full = per_pair.select(
        F.inline(F.when(F.col("i") == F.col("j"), F.array(fwd)).otherwise(F.array(fwd, rev)))
    )
    return full.select(
        F.element_at(names, F.col("x") + 1).alias("var_a"),
        F.element_at(names, F.col("y") + 1).alias("var_b"),
        (F.round(F.col("c"), 2) + F.lit(0.0)).alias("corr"),
    )


def label_correlation_rank(matrix: DataFrame, target: str = "label") -> DataFrame:
    """Correlation of each feature with the label, ranked by absolute value
    (nulls last). The input has one row per feature, so the ranking window is tiny."""
    from pyspark.sql import Window

    w = Window.orderBy(F.abs(F.col("corr")).desc_nulls_last(), F.col("feature"))
    return (
        matrix.where((F.col("var_b") == target) & (F.col("var_a") != target))
        .select(F.col("var_a").alias("feature"), F.col("corr"))
        .withColumn("abs_rank", F.row_number().over(w))
    )
