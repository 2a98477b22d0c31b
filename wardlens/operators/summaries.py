"""Descriptive tables: summaries, frequencies, cross tables, histograms, correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.bands import age_interval
from .metrics import ratio
from .ordered import average_ranks, long_values, quantile_table
from .skew import null_safe_join

_STATS = ["n_miss", "n", "mean", "std", "min", "max"]


def _stat_struct(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.struct(
        F.lit(name).alias("variable"),
        F.count(F.when(x.isNull(), F.lit(1))).alias("n_miss"),
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )


def describe_long(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Missing, count, mean, standard deviation, minimum, maximum per variable.

    One pass over the rows; the wide result row is then turned into one row per
    variable.  Rows with a null class are left out.
    """
    rows = df.na.drop(subset=list(by)) if by else df
    wide = rows.groupBy(*by).agg(F.array(*[_stat_struct(c) for c in columns]).alias("_s"))
    return wide.select(*by, F.inline("_s")).select(*by, "variable", *_STATS)


def dataset_info(df: DataFrame, label: str = fv.LABEL) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"), F.count(F.when(F.col(label).isNull(), F.lit(1))).alias("missing_label")
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with its missing count from one pass."""
    cells = [
        F.struct(
            F.lit(i + 1).cast("bigint").alias("position"),
            F.lit(name).alias("variable"),
            F.lit(kind).alias("type"),
            F.count(F.when(F.col(name).isNull(), F.lit(1))).alias("n_miss"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def range_report(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """How many values lie outside their clinical range; nulls are not counted."""
    ranges = {c: r for c, r in (ranges or fv.CLINICAL_RANGES).items() if c in df.columns}
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"),
            F.count(F.when((F.col(c) < low) | (F.col(c) > high), F.lit(1))).alias("n_outside"),
        )
        for c, (low, high) in ranges.items()
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def data_summary(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One row: size, events, age, median stay and mean share of missing cells."""
    features = [c for c in (features or fv.BASE_FEATURES) if c in df.columns]
    missing = [F.avg(F.col(c).isNull().cast("double")) for c in features]
    share = sum(missing[1:], missing[0]) / len(missing)
    base = df.agg(
        F.count("*").alias("n_patients"),
        F.lit(len(features)).cast("bigint").alias("n_features"),
        F.sum(fv.LABEL).cast("bigint").alias("adverse_event_n"),
        F.avg(fv.LABEL).alias("adverse_event_rate"),
        F.avg("age").alias("age_mean"),
        F.stddev_samp("age").alias("age_std"),
        share.alias("missing_pct"),
    )
    median = quantile_table(df, ["length_of_stay"], [50]).agg(F.first("q50")).scalar()
    return base.withColumn("los_median", median)


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Count and percent per value; the total is one number, not a window."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", 100.0 * F.col("n") / total)


def cross_table(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Counts of ``rows`` by ``columns``; the fixed value list saves a distinct pass."""
    cells = [F.count(F.when(F.col(columns) == v, F.lit(1))).alias(f"{columns}_{v}") for v in values]
    return df.groupBy(rows).agg(*cells)


def class_means(df: DataFrame, by: str, variable: str) -> DataFrame:
    """n, mean and standard deviation per class and, with row_type 0, overall."""
    rows = df.na.drop(subset=[by])
    return rows.rollup(by).agg(
        (1 - F.grouping(by)).cast("bigint").alias("row_type"),
        F.count(variable).alias("n"),
        F.avg(variable).alias("mean"),
        F.stddev_samp(variable).alias("std"),
    )


def group_means(df: DataFrame, columns: list[str], by: str = fv.LABEL) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns])


def age_band_rate(df: DataFrame) -> DataFrame:
    """Event rate and count per right-closed age interval; ages outside drop out."""
    banded = df.withColumn("age_interval", age_interval(F.col("age"))).na.drop(subset=["age_interval"])
    return banded.groupBy("age_interval").agg(F.avg(fv.LABEL).alias("ae_rate"), F.count(fv.LABEL).alias("n"))


def _bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin; the top edge belongs to the last bin."""
    share = ratio(value - low, high - low)
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("bigint")


def histogram(
    df: DataFrame, columns: list[str], bins: int, by: list[str] = (), common_range: bool = False
) -> DataFrame:
    """Count and density per (by, feature, bin), empty bins included.

    Bin edges span the minimum to maximum of each group, or of all rows together
    with ``common_range``; a range of one value is widened by 0.5 on either side.
    Values collapse to counts before they meet the edges.  Null is a group of its own.
    """
    by = list(by)
    group = [*by, "feature"]
    long = long_values(df, columns, by)
    counts = long.groupBy(*group, "value").agg(F.count("*").alias("_n"))
    span = ["feature"] if common_range else group
    low, high = F.min("value"), F.max("value")
    half = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    limits = counts.groupBy(*span).agg((low - half).alias("low"), (high + half).alias("high"))
    totals = counts.groupBy(*group).agg(F.sum("_n").alias("_total"))
    ranges = null_safe_join(totals, limits, span)
    binned = (
        null_safe_join(counts, limits, span)
        .withColumn("bin", _bin_index(F.col("value"), F.col("low"), F.col("high"), bins))
        .groupBy(*group, "bin")
        .agg(F.sum("_n").alias("n"))
    )
    every = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    width = (F.col("high") - F.col("low")) / bins
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return null_safe_join(every, binned, [*group, "bin"], "left").select(
        *group,
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_from"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_to"),
        n.alias("n"),
        ratio(n, F.col("_total") * width).alias("density"),
    )


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present."""
    cells = [
        F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), F.corr(F.col(a), F.col(b)).alias("r"))
        for a, b in combinations(columns, 2)
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def label_correlations(df: DataFrame, features: list[str] | None = None, label: str = fv.LABEL) -> DataFrame:
    """Correlation of each feature with the label, strongest first."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.corr(F.col(c), F.col(label)).alias("r"))
        for c in features or fv.BASE_FEATURES
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c")).orderBy(F.desc("r"), "feature")


def mann_whitney(
    df: DataFrame, features: list[str] | None = None, label: str = fv.LABEL, ties: bool = False
) -> DataFrame:
    """Two-sample rank test of every feature between the labels.

    U of the label-0 sample, its tie-corrected normal deviate with continuity
    correction, and both means; ``n_tied`` too, the number of values that occur more than
    once, where ``ties`` is set.  Works on distinct values, all features in one pass.
    """
    features = features or fv.BASE_FEATURES
    rows = df.filter(F.col(label).isNotNull())
    is_event = F.col(label).cast("bigint")
    ranked = average_ranks(long_values(rows, features, [label]), "value", ["feature"], {"pos": is_event})
    neg = F.col("n") - F.col("pos")
    n = F.col("n").cast("double")
    base = ranked.groupBy("feature").agg(
        (F.max("total_n") - F.max("total_pos")).cast("double").alias("n0"),
        F.max("total_pos").cast("double").alias("n1"),
        F.sum(neg * F.col("avg_rank")).alias("_r0"),
        F.sum(n * n * n - n).alias("_ties"),
        F.count(F.when(F.col("n") > 1, F.lit(1))).alias("n_tied"),
        F.sum(neg * F.col("value")).alias("_sum0"),
        F.sum(F.col("pos") * F.col("value")).alias("_sum1"),
    )
    n0, n1 = F.col("n0"), F.col("n1")
    both = n0 + n1
    u = F.col("_r0") - n0 * (n0 + 1) / 2.0
    spread = F.sqrt(n0 * n1 / 12.0 * (both + 1 - F.col("_ties") / (both * (both - 1))))
    u_large = F.greatest(u, n0 * n1 - u)
    return base.select(
        "feature",
        F.col("n0").cast("bigint").alias("n_no_event"),
        F.col("n1").cast("bigint").alias("n_event"),
        F.try_divide(F.col("_sum0"), n0).alias("mean_no_event"),
        F.try_divide(F.col("_sum1"), n1).alias("mean_event"),
        u.alias("u"),
        F.try_divide(u_large - n0 * n1 / 2.0 - 0.5, spread).alias("z"),
        *(["n_tied"] if ties else []),
    )


def batch_summary(scored: DataFrame) -> DataFrame:
    """n, flagged, share flagged, mean score of a scored table."""
    return scored.agg(
        F.count("*").alias("n_patients"),
        F.count(F.when(F.col("adverse_event_flag") == 1, F.lit(1))).alias("n_high_risk"),
        F.avg(F.col("adverse_event_flag").cast("double")).alias("high_risk_share"),
        F.avg("risk_score").alias("mean_risk_score"),
    )


