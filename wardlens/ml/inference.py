"""Statistical baseline: odds ratios, stepwise selection, fit statistics, classification, contrast."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.tails import normal_two_sided
from ..operators import metrics
from ..sources.materialize import written
from .newton import Logit, LogitFit, fit_logits, logit_rows, packed_rows

Z95 = 1.959964


def coefficient_rows(fit: LogitFit, features: list[str]) -> list[tuple]:
    """(variable, estimate, se, wald z, p, odds ratio, lower, upper); intercept last."""
    errors = [math.sqrt(max(v, 0.0)) for v in fit.covariance.diagonal()]
    out = []
    for name, b, se in [*zip(features, fit.beta[1:], errors[1:]), ("Intercept", fit.beta[0], errors[0])]:
        z = b / se if se > 0 else 0.0
        out.append((name, float(b), float(se), float(z), normal_two_sided(z),
                    _odds(b), _odds(b - Z95 * se), _odds(b + Z95 * se)))
    return out


def _odds(eta: float) -> float:
    """exp(eta), infinite where no number is large enough, as for a coefficient that the rows do not determine."""
    return math.exp(eta) if eta < 709.7 else math.inf


COEFFICIENTS = (
    "variable string, estimate double, std_error double, z double, p double, "
    "odds_ratio double, lower_cl double, upper_cl double"
)


def univariate_odds_ratios(df: DataFrame, features: list[str] | None = None, label: str = fv.LABEL) -> DataFrame:
    """Odds ratio with 95% Wald limits of each feature on its own, all fits in the same passes."""
    features = features or fv.BASE_FEATURES
    rows = packed_rows(logit_rows(df, features, label))
    fits = fit_logits(rows, [Logit(c, (i,)) for i, c in enumerate(features)])
    found = [coefficient_rows(fit, [fit.logit.key])[0] for fit in fits]
    table = [(r[0], fv.ODDS_RATIO_LABELS.get(r[0], r[0]), *r[5:]) for r in found]
    schema = "variable string, label string, odds_ratio double, lower_cl double, upper_cl double"
    return df.sparkSession.createDataFrame(table, schema)


def complete_rows(df: DataFrame, features: list[str], label: str = fv.LABEL) -> DataFrame:
    """The rows that have every feature and the label, written in blocks for ``fit_logits``."""
    return packed_rows(logit_rows(df.na.drop(subset=[*features, label]), features, label))


def started(fit: LogitFit, columns: tuple[int, ...]) -> np.ndarray:
    """First coefficients of ``columns``: those of ``fit``, and zero for the columns it does not have."""
    known = dict(zip(fit.logit.columns, fit.beta[1:]))
    return np.array([fit.beta[0], *(known.get(c, 0.0) for c in columns)])


# --- stepwise selection --------------------------------------------------------------
def stepwise_logit(
    df: DataFrame,
    features: list[str] | None = None,
    enter: float = 0.05,
    stay: float = 0.10,
    label: str = fv.LABEL,
    rows: DataFrame | None = None,
):
    """Enter by score test, leave by Wald test.  Returns (fit, chosen, history rows).

    The passes that fit a step's model also take the score tests of the next one, and a step's
    fit starts at the coefficients of the one before.  ``rows`` are the ``complete_rows`` where
    they are there already.
    """
    features = features or fv.BASE_FEATURES
    rows = complete_rows(df, features, label) if rows is None else rows
    place = {c: i for i, c in enumerate(features)}

    def fitted(chosen: list[str], before: LogitFit | None = None) -> LogitFit:
        inside, rest = tuple(place[c] for c in chosen), tuple(place[c] for c in features if c not in chosen)
        return fit_logits(rows, [Logit("step", inside, rest)], starts=before and [started(before, inside)])[0]

    chosen: list[str] = []
    fit = fitted(chosen)
    history: list[tuple] = []
    seen: set[tuple] = set()
    while len(chosen) < len(features):
        tests = {features[i]: v for i, v in fit.score_tests().items()}
        best = max(tests, key=tests.get)
        p = normal_two_sided(math.sqrt(max(tests[best], 0.0)))
        if p >= enter:
            break
        chosen = [*chosen, best]
        history.append((len(history) + 1, "enter", best, tests[best], p))
        fit = fitted(chosen, fit)
        while chosen:
            worst = max(coefficient_rows(fit, chosen)[:-1], key=lambda r: r[4])
            if worst[4] < stay:
                break
            chosen = [c for c in chosen if c != worst[0]]
            history.append((len(history) + 1, "remove", worst[0], worst[3] ** 2, worst[4]))
            fit = fitted(chosen, fit)
        state = tuple(sorted(chosen))
        if state in seen:  # the same set again: entering and leaving would alternate
            break
        seen.add(state)
    return (fit if chosen else None), chosen, history


def fit_statistics(fit: LogitFit, n: int, n_terms: int) -> list[tuple]:
    """-2 log L, AIC, SC with and without covariates, R-square and its rescaled form."""
    full, null = -2 * fit.log_likelihood, -2 * fit.null_log_likelihood
    r2 = 1 - math.exp((full - null) / n)
    return [
        ("-2 Log L", null, full),
        ("AIC", null + 2, full + 2 * (n_terms + 1)),
        ("SC", null + math.log(n), full + (n_terms + 1) * math.log(n)),
        ("R-Square", None, r2),
        ("Max-rescaled R-Square", None, r2 / (1 - math.exp(-null / n))),
    ]


FIT_STATISTICS = "criterion string, intercept_only double, with_covariates double"


def linear_score(fit: LogitFit, chosen: list[str]) -> Column:
    """The fitted score on the logit scale; null where a value is missing."""
    eta = F.lit(float(fit.beta[0]))
    for c, b in zip(chosen, fit.beta[1:]):
        eta = eta + F.lit(float(b)) * F.col(c)
    return eta


def probability(eta: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-eta))


# --- classification without the row itself -----------------------------------------------
def left_out_probability(fit: LogitFit, chosen: list[str], label: str = fv.LABEL) -> Column:
    """Each row's probability under the coefficients that one step away from the fit leaves it out.

    The spread of a row is x' V x with V the inverse information; its leverage is p (1 - p)
    times that, and its share of the fit moves its score by spread (y - p) / (1 - leverage).
    """
    eta = linear_score(fit, chosen)
    p = probability(eta)
    design = [F.lit(1.0), *[F.col(c).cast("double") for c in chosen]]
    v = fit.covariance
    spread = F.lit(0.0)
    for i, a in enumerate(design):
        for j, b in enumerate(design[: i + 1]):
            spread = spread + F.lit(float(v[i, j]) * (1 if i == j else 2)) * a * b
    moved = eta - spread * (F.col(label) - p) / (1.0 - p * (1.0 - p) * spread)
    return probability(moved)


def classification_table(
    df: DataFrame, fit: LogitFit, chosen: list[str], cutoffs: tuple[float, ...] = (0.5,), label: str = fv.LABEL
) -> DataFrame:
    """Per cutoff: right and wrong events and non-events, and their percentages, each row
    judged by coefficients that leave it out.  Rows with a missing value are not classified."""
    scored = df.filter(F.col(label).isNotNull()).select(F.col(label), left_out_probability(fit, chosen, label).alias("score"))
    each = scored.filter(F.col("score").isNotNull()).withColumn("cutoff", F.explode(F.array(*[F.lit(float(c)) for c in cutoffs])))
    counts = metrics.confusion(each, F.col("cutoff"), label=label, by=["cutoff"])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    percent = lambda a, b: 100 * metrics.ratio(a, b)
    return counts.select(
        "cutoff",
        tp.alias("correct_event"), tn.alias("correct_nonevent"), fp.alias("incorrect_event"), fn.alias("incorrect_nonevent"),
        percent(tp + tn, tp + tn + fp + fn).alias("percent_correct"),
        percent(tp, tp + fn).alias("sensitivity"), percent(tn, tn + fp).alias("specificity"),
        percent(fp, tp + fp).alias("false_positive"), percent(fn, tn + fn).alias("false_negative"),
    )


# --- areas of two scores -----------------------------------------------------------------------
def roc_contrast(df: DataFrame, first: str, second: str, label: str = fv.LABEL) -> DataFrame:
    """Both areas, their difference with its standard error, and chi-square (1 df) of no difference.

    The placement of an event is the share of non-events that score lower (ties one half), that
    of a non-event the share of events that score higher.  Both come from the running totals of
    each score; the areas' covariance is the placements' covariance among the events over their
    number plus that among the non-events.
    """
    rows = df.filter(F.col(label).isNotNull() & F.col(first).isNotNull() & F.col(second).isNotNull())
    rows = written(rows.select(F.col(first).cast("double").alias("a"), F.col(second).cast("double").alias("b"), F.col(label).cast("int").alias("y")), "contrast")
    placed = rows
    for name in ("a", "b"):
        totals = metrics.score_totals(rows, name, "y")
        neg_below, pos_above = metrics.neg_below(), F.col("total_pos") - F.col("cum_pos")
        half_neg, half_pos = (F.col("n") - F.col("pos")) / 2.0, F.col("pos") / 2.0
        shares = totals.select(
            name,
            metrics.ratio(neg_below + half_neg, F.col("total_n") - F.col("total_pos")).alias("event"),
            metrics.ratio(pos_above + half_pos, F.col("total_pos")).alias("other"),
        )
        placed = placed.join(shares, name).withColumn(f"v{name}", F.when(F.col("y") == 1, F.col("event")).otherwise(F.col("other")))
        placed = placed.drop("event", "other")
    per_class = placed.groupBy("y").agg(
        F.count("*").alias("n"), F.avg("va").alias("area_a"), F.avg("vb").alias("area_b"),
        *[(F.covar_samp(x, z) / F.count("*")).alias(f"s_{x}{z}") for x, z in (("va", "va"), ("vb", "vb"), ("va", "vb"))],
    )
    spread = lambda name: F.sum(f"s_{name}")
    areas = per_class.agg(
        F.sum("n").alias("n"), F.max(F.when(F.col("y") == 1, F.col("n"))).alias("n_events"),
        F.max(F.when(F.col("y") == 1, F.col("area_a"))).alias("area_a"), F.max(F.when(F.col("y") == 1, F.col("area_b"))).alias("area_b"),
        F.sqrt(spread("vava")).alias("std_error_a"), F.sqrt(spread("vbvb")).alias("std_error_b"),
        F.sqrt(F.greatest(spread("vava") + spread("vbvb") - 2 * spread("vavb"), F.lit(0.0))).alias("std_error"),
    )
    areas = areas.withColumn("difference", F.col("area_a") - F.col("area_b"))
    return areas.withColumn("chi_square", F.try_divide(F.col("difference") ** 2, F.col("std_error") ** 2))


def baseline_tables(df: DataFrame, features: list[str] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The tables of ``baseline_model``, each made when it is asked for; only the two fits are made at once."""
    spark = df.sparkSession
    features = features or fv.BASE_FEATURES
    rows = complete_rows(df, features)
    fit, chosen, history = stepwise_logit(df, features, rows=rows)
    steps = spark.createDataFrame(history, "step int, action string, variable string, chi_square double, p double")
    if fit is None:
        return {"steps": lambda: steps}
    every = tuple(range(len(features)))
    full = fit_logits(rows, [Logit("full", every)], starts=[started(fit, every)])[0]
    complete = df.na.drop(subset=[*features, fv.LABEL])
    scored = df.withColumn("pred_prob", probability(linear_score(fit, chosen)))
    both = complete.select(fv.LABEL, linear_score(fit, chosen).alias("stepwise"), linear_score(full, features).alias("full"))
    return {
        "steps": lambda: steps,
        "coefficients": lambda: spark.createDataFrame(coefficient_rows(fit, chosen), COEFFICIENTS),
        "full_coefficients": lambda: spark.createDataFrame(coefficient_rows(full, features), COEFFICIENTS),
        "fit_statistics": lambda: spark.createDataFrame(fit_statistics(fit, fit.n, len(chosen)), FIT_STATISTICS),
        "predictions": lambda: scored,
        "goodness_of_fit": lambda: metrics.hosmer_lemeshow(scored.filter("pred_prob is not null"), "pred_prob"),
        "association": lambda: metrics.concordance(metrics.score_totals(scored, "pred_prob")),
        "classification": lambda: classification_table(complete, fit, chosen),
        "roc_contrast": lambda: roc_contrast(both, "full", "stepwise"),
    }


def baseline_model(df: DataFrame, features: list[str] | None = None) -> dict[str, DataFrame]:
    """Stepwise model of the cleaned table: coefficients, steps, fit statistics and scores, its
    goodness of fit, association and classification, and its contrast with the model of all features."""
    return {name: make() for name, make in baseline_tables(df, features).items()}
