"""Evaluation of a score against a 0/1 label.

Everything except the plain confusion counts is computed from one row per distinct
score, so ties are exact and work after the first aggregation does not grow with
the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LABEL
from .ordered import average_ranks, neighbours, quantile_name, quantile_table, rank_group, running_totals, value_counts


def score_totals(df: DataFrame, score: str = "score", label: str = LABEL, by: list[str] = ()) -> DataFrame:
    """Per distinct score: n, pos and their running totals from the lowest score."""
    rows = df.filter(F.col(label).isNotNull())
    counts = value_counts(rows, score, by, {"pos": F.col(label).cast("bigint")})
    return running_totals(counts, score, ["n", "pos"], by)


# --- expressions over score totals -------------------------------------------------
def _neg() -> Column:
    return F.col("n") - F.col("pos")


def neg_below() -> Column:
    """Non-events with a lower score."""
    return (F.col("cum_n") - F.col("n")) - (F.col("cum_pos") - F.col("pos"))


def _flagged() -> Column:
    """Rows with this score or a higher one."""
    return F.col("total_n") - F.col("cum_n") + F.col("n")


def _hits() -> Column:
    return F.col("total_pos") - F.col("cum_pos") + F.col("pos")


def _total_neg() -> Column:
    return F.col("total_n") - F.col("total_pos")


def ratio(top: Column, bottom: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


# --- ranking metrics -----------------------------------------------------------------
def ranking_metrics(totals: DataFrame, by: list[str] = ()) -> DataFrame:
    """ROC AUC (ties count one half) and step-wise average precision in one pass."""
    wins = F.sum(F.col("pos") * (neg_below() + _neg() / 2.0))
    pairs = F.max("total_pos").cast("double") * F.max(_total_neg())
    step = ratio(F.col("pos"), F.col("total_pos")) * ratio(_hits(), _flagged())
    return totals.groupBy(*by).agg(
        F.max("total_n").alias("n"),
        F.max("total_pos").alias("n_pos"),
        F.try_divide(wins, pairs).alias("roc_auc"),
        F.sum(step).alias("avg_precision"),
    )


def concordance(totals: DataFrame, by: list[str] = ()) -> DataFrame:
    """Pair counts of the association table: concordant, discordant, tied, c, D, gamma, tau-a."""
    base = totals.groupBy(*by).agg(
        F.max("total_n").cast("double").alias("_n"),
        (F.max("total_pos").cast("double") * F.max(_total_neg())).alias("pairs"),
        F.sum(F.col("pos").cast("double") * neg_below()).alias("_conc"),
        F.sum(F.col("pos").cast("double") * _neg()).alias("_tied"),
    )
    base = base.withColumn("_disc", F.col("pairs") - F.col("_conc") - F.col("_tied"))
    lead = F.col("_conc") - F.col("_disc")
    return base.select(
        *by,
        "pairs",
        (100 * ratio(F.col("_conc"), F.col("pairs"))).alias("percent_concordant"),
        (100 * ratio(F.col("_disc"), F.col("pairs"))).alias("percent_discordant"),
        (100 * ratio(F.col("_tied"), F.col("pairs"))).alias("percent_tied"),
        ratio(lead, F.col("pairs")).alias("somers_d"),
        ratio(lead, F.col("_conc") + F.col("_disc")).alias("gamma"),
        ratio(lead, 0.5 * F.col("_n") * (F.col("_n") - 1)).alias("tau_a"),
        ratio(F.col("_conc") + 0.5 * F.col("_tied"), F.col("pairs")).alias("c"),
    )


def roc_points(totals: DataFrame, score: str = "score") -> DataFrame:
    """One point per distinct score, highest first, plus the origin (null threshold)."""
    points = totals.select(
        F.col(score).alias("threshold"),
        _hits().alias("tp"),
        (_flagged() - _hits()).alias("fp"),
        ratio(_hits(), F.col("total_pos")).alias("tpr"),
        ratio(_flagged() - _hits(), _total_neg()).alias("fpr"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    origin = totals.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        zero.alias("tp"), zero.alias("fp"), none.alias("tpr"), none.alias("fpr"),
    )
    return points.unionByName(origin)


def bending_roc_points(totals: DataFrame, score: str = "score") -> DataFrame:
    """The points of ``roc_points`` without those on the straight line between their neighbours.

    A point lies on it where the next lower score adds as many events and non-events as its
    own; the highest and the lowest score stay.
    """
    beside = neighbours(totals, score, ["n", "pos"])
    same = (F.col("lower.n") == F.col("n")) & (F.col("lower.pos") == F.col("pos"))
    bends = F.col("higher").isNull() | F.col("lower").isNull() | ~same
    return roc_points(beside.filter(bends).drop("lower", "higher"), score)


def pr_points(totals: DataFrame, score: str = "score") -> DataFrame:
    """One point per distinct score plus the final point (recall 0, precision 1)."""
    points = totals.select(
        F.col(score).alias("threshold"),
        ratio(_hits(), _flagged()).alias("precision"),
        ratio(_hits(), F.col("total_pos")).alias("recall"),
    )
    last = totals.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(last)


def youden_threshold(totals: DataFrame, score: str = "score", by: list[str] = ()) -> DataFrame:
    """The score that maximises tpr - fpr; among equals the highest score.

    Compared as whole numbers (tp * negatives - fp * positives), so equal is equal.
    """
    wide = "decimal(38,0)"
    lead = _hits().cast("decimal(19,0)") * _total_neg().cast("decimal(19,0)") - (
        _flagged() - _hits()
    ).cast("decimal(19,0)") * F.col("total_pos").cast("decimal(19,0)")
    best = F.max(
        F.struct(
            lead.cast(wide).alias("lead"),
            F.col(score).alias("threshold"),
            ratio(_hits(), F.col("total_pos")).alias("tpr"),
            ratio(_flagged() - _hits(), _total_neg()).alias("fpr"),
        )
    )
    return totals.groupBy(*by).agg(best.alias("_b")).select(
        *by, "_b.threshold", "_b.tpr", "_b.fpr", (F.col("_b.tpr") - F.col("_b.fpr")).alias("youden_j")
    )


# --- threshold metrics -------------------------------------------------------------------
def confusion(df: DataFrame, threshold: float | Column, score: str = "score", label: str = LABEL, by: list[str] = ()) -> DataFrame:
    """Counts and rates at a threshold; undefined rates are 0."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    said = F.col(score) >= threshold
    truth = F.col(label) == 1
    n_of = lambda test: F.count(F.when(test, F.lit(1)))
    base = df.groupBy(*by).agg(
        n_of(said & truth).alias("tp"),
        n_of(said & ~truth).alias("fp"),
        n_of(~said & truth).alias("fn"),
        n_of(~said & ~truth).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ["tp", "fp", "fn", "tn"])
    return base.withColumns(
        {
            "sensitivity": ratio(tp, tp + fn),
            "specificity": ratio(tn, tn + fp),
            "ppv": ratio(tp, tp + fp),
            "npv": ratio(tn, tn + fn),
            "n_patients": tp + fp + fn + tn,
            "n_adverse": tp + fn,
        }
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy and both averages.

    Takes the one-row result of ``confusion`` and returns five rows.
    """
    tp, fp, fn, tn = (F.col(c) for c in ["tp", "fp", "fn", "tn"])

    def entry(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"), s.alias("support")
        )

    parts = counts.select(
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"), ratio(2 * tn, 2 * tn + fn + fp).alias("f0"),
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"), ratio(2 * tp, 2 * tp + fn + fp).alias("f1"),
        (tn + fp).alias("s0"), (tp + fn).alias("s1"), ratio(tp + tn, tp + tn + fp + fn).alias("acc"),
    )
    n = F.col("s0") + F.col("s1")
    mean = lambda a, b: (F.col(a) + F.col(b)) / 2.0
    weighted = lambda a, b: ratio(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), n)
    acc = F.col("acc")
    rows = F.array(
        entry("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        entry("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        entry("accuracy", acc, acc, acc, n),
        entry("macro avg", mean("p0", "p1"), mean("r0", "r1"), mean("f0", "f1"), n),
        entry("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"), weighted("f0", "f1"), n),
    )
    return parts.select(F.inline(rows))


# --- calibration ------------------------------------------------------------------------------
def calibration_by_quantile(df: DataFrame, score: str = "score", label: str = LABEL, bins: int = 10) -> DataFrame:
    """Mean score and observed rate of labelled rows per quantile bin; empty bins do not appear."""
    inner = [100.0 * i / bins for i in range(1, bins)]
    df = df.filter(F.col(label).isNotNull())
    edges = quantile_table(df, [score], inner).agg(F.first(F.array(*[quantile_name(p) for p in inner])))
    counts = value_counts(df, score, (), {"pos": F.col(label).cast("bigint")}).withColumn("_edges", edges.scalar())
    binned = counts.withColumn("bin", F.size(F.filter("_edges", lambda e: e < F.col(score))).cast("bigint"))
    return binned.groupBy("bin").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col(score) * F.col("n")) / F.sum("n")).alias("mean_score"),
        (F.sum("pos") / F.sum("n")).alias("observed_rate"),
    )


def decile_counts(df: DataFrame, score: str = "score", label: str = LABEL, groups: int = 10) -> DataFrame:
    """(prob_decile, n, pos, score_sum) of labelled rows by rank group, ties together."""
    ranked = average_ranks(df.filter(F.col(label).isNotNull()), score, (), {"pos": F.col(label).cast("bigint")})
    return (
        ranked.withColumn("prob_decile", rank_group(groups))
        .groupBy("prob_decile")
        .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum(F.col(score) * F.col("n")).alias("score_sum"))
    )


def calibration_by_decile(df: DataFrame, score: str = "score", label: str = LABEL, groups: int = 10) -> DataFrame:
    """Deciles plus the overall row (``row_type`` 0, null decile)."""
    deciles = decile_counts(df, score, label, groups)
    rolled = deciles.rollup("prob_decile").agg(
        (1 - F.grouping("prob_decile")).cast("bigint").alias("row_type"),
        F.sum("n").alias("n_patients"),
        (F.sum("score_sum") / F.sum("n")).alias("mean_pred"),
        (F.sum("pos") / F.sum("n")).alias("mean_obs"),
    )
    return rolled


def hosmer_lemeshow(df: DataFrame, score: str = "score", label: str = LABEL, groups: int = 10) -> DataFrame:
    """Chi-square of observed against expected events over rank groups, and its df.

    A group whose expected events are none or all of its rows adds nothing.
    """
    expected, n = F.col("score_sum"), F.col("n")
    term = F.try_divide((F.col("pos") - expected) ** 2, expected * (1 - expected / n))
    return decile_counts(df, score, label, groups).agg(
        F.count("*").alias("n_groups"),
        F.sum(term).alias("chi_square"),
        (F.count("*") - 2).alias("df"),
    )
