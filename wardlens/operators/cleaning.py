"""Cleaning of the feature matrix: duplicates, ranges, fences, imputation, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import as_long, clip
from ..functions.bands import age_group, flag, heart_rate_category, stay_category
from ..sources.materialize import written
from .ordered import as_fields, quantile_table
from .skew import null_safe_join

COMPLETE_CASE_COLUMNS = [*fv.BASE_FEATURES, fv.LABEL]
# copies of one row that are written back together
COPIES_PER_BLOCK = 100_000


# --- duplicates -------------------------------------------------------------------
def _first_rows(df: DataFrame, key: str) -> DataFrame:
    """The smallest row per key in column order, as struct ``_first``, and the row count.

    An aggregate, not a window: partial minima form before the shuffle, so a key with
    very many copies costs no more than any other.
    """
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_first"), F.count("*").alias("_rows"))


def dedup_keep(df: DataFrame, key: str = "icustay_id") -> DataFrame:
    """One row per key: the first in full row order, so the choice is repeatable."""
    first = _first_rows(df, key)
    return first.select(key, "_first.*").select(*df.columns)


def dedup_drop(df: DataFrame, key: str = "icustay_id") -> DataFrame:
    """The rows ``dedup_keep`` leaves out, each as often as it occurs.

    Equal rows are counted once, and all that follows reads the counts.  Copies are
    written back in blocks, so that a row with very many of them is many tasks' work.
    """
    rest = [c for c in df.columns if c != key]
    copies = written(df.groupBy(*df.columns).agg(F.count("*").alias("_copies")), "row_counts")
    repeated = (
        copies.groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("_first"), F.sum("_copies").alias("_rows"))
        .filter(F.col("_rows") > 1)
        .select(key, "_first")
    )
    is_first = F.struct(*rest).eqNullSafe(F.col("_first"))
    left_over = (
        null_safe_join(copies, repeated, [key])
        .withColumn("_copies", F.col("_copies") - as_long(is_first))
        .filter(F.col("_copies") > 0)
        .drop("_first")
    )
    last = F.ceil(F.col("_copies") / F.lit(COPIES_PER_BLOCK)) - 1
    in_block = F.least(F.lit(COPIES_PER_BLOCK), F.col("_copies") - F.col("_block") * COPIES_PER_BLOCK)
    blocks = (
        left_over.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .withColumn("_copies", in_block)
        .repartition(key, "_block")
        .drop("_block")
    )
    repeat = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    return blocks.withColumn("_copy", repeat).select(*df.columns)


# --- ranges and fences -----------------------------------------------------------------
def valid_ranges_only(df: DataFrame) -> DataFrame:
    """Rows with a plausible age and stay; a missing age or stay goes too."""
    low, high = fv.COHORT_AGE
    stay = F.col("length_of_stay")
    return df.filter(F.col("age").between(low, high) & (stay > 0) & (stay <= fv.STAY_DAYS_MAX))


def outlier_fences(df: DataFrame, columns: list[str] = fv.FENCED) -> DataFrame:
    """Quartiles, IQR and the 3 x IQR fences, one row per feature."""
    q = quantile_table(df, columns, [25, 75], "averaged")
    q = q.withColumnsRenamed({"q25": "q1", "q75": "q3"})
    wide = fv.FENCE_IQR_MULTIPLE * F.col("iqr")
    return q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns(
        {"fence_low": F.col("q1") - wide, "fence_high": F.col("q3") + wide}
    )


def drop_outliers(df: DataFrame, missing_policy: str = "reference", fences: DataFrame | None = None) -> DataFrame:
    """Drop rows outside the fences, themselves limited by hard clinical bounds.

    A missing heart rate, creatinine or WBC counts as below every bound under
    ``missing_policy="reference"`` and the row goes; ``"keep"`` lets it pass.
    """
    if missing_policy not in ("reference", "keep"):
        raise ValueError(f"unknown missing_policy: {missing_policy!r}")
    fences = fences if fences is not None else outlier_fences(df)
    at = lambda feature, bound: F.col("_fences")[feature][bound]
    limits = {
        "heart_rate_mean": (
            F.greatest(at("heart_rate_mean", "fence_low"), F.lit(20.0)),
            F.least(at("heart_rate_mean", "fence_high"), F.lit(280.0)),
        ),
        "creatinine_max": (F.lit(0.0), F.least(at("creatinine_max", "fence_high"), F.lit(30.0))),
        "wbc_mean": (F.lit(0.0), F.least(at("wbc_mean", "fence_high"), F.lit(150.0))),
    }
    missing_passes = F.lit(missing_policy == "keep")
    out = df.withColumn("_fences", as_fields(fences, list(limits)))
    for column, (low, high) in limits.items():
        out = out.filter(F.coalesce(F.col(column).between(low, high), missing_passes))
    return out.drop("_fences")


# --- imputation ----------------------------------------------------------------------------
def strata_medians(df: DataFrame) -> DataFrame:
    """Medians per label of the seven columns, as published (and unused there too)."""
    q = quantile_table(df, list(fv.STRATA_MEDIANS), [50], "averaged", [fv.LABEL])
    picks = [F.max(F.when(F.col("feature") == c, F.col("q50"))).alias(n) for c, n in fv.STRATA_MEDIANS.items()]
    return q.groupBy(fv.LABEL).agg(*picks)


def impute_rules(df: DataFrame) -> DataFrame:
    """Clinical defaults for missing values, with indicator columns."""
    no_hr, no_crea, no_wbc = (F.col(c).isNull() for c in ["heart_rate_mean", "creatinine_max", "wbc_mean"])
    fill = lambda c, v: F.coalesce(F.col(c), F.lit(v))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return df.withColumns(
        {
            "heart_rate_mean": fill("heart_rate_mean", 80.0),
            "creatinine_max": fill("creatinine_max", 1.0),
            "creatinine_mean": F.when(no_crea, F.lit(1.0)).otherwise(F.col("creatinine_mean")),
            "wbc_mean": fill("wbc_mean", 9.0),
            "wbc_max": F.when(no_wbc, F.lit(9.0)).otherwise(F.col("wbc_max")),
            "lactate_max": fill("lactate_max", 1.5),
            "hemoglobin_min": fill("hemoglobin_min", 12.0),
            "platelets_min": fill("platelets_min", 200.0),
            "drug_count": zero("drug_count"),
            "polypharmacy_score": zero("polypharmacy_score"),
            "polypharmacy_flag": zero("polypharmacy_flag"),
            "gender": zero("gender"),
            "lab_abnormality_score": zero("lab_abnormality_score"),
            "hr_imputed": as_long(no_hr),
            "crea_imputed": as_long(no_crea),
            "wbc_imputed": as_long(no_wbc),
            "any_imputed": as_long(no_hr | no_crea | no_wbc),
        }
    )


# --- derived clinical columns -----------------------------------------------------------------
def clinical_columns(df: DataFrame) -> DataFrame:
    """Bands, flags, the composite index and the fixed creatinine z-score."""
    tachycardia = flag(F.col("heart_rate_mean") > 100)
    renal = flag(F.col("creatinine_max") > 1.5)
    leuko = flag(F.col("wbc_mean") > 12)
    index = (
        0.25 * tachycardia
        + 0.30 * renal
        + 0.20 * leuko
        + 0.15 * F.col("polypharmacy_flag")
        + 0.10 * flag(F.col("lab_abnormality_score") >= 2)
    )
    return df.withColumns(
        {
            "age_group": age_group(F.col("age")),
            "los_category": stay_category(F.col("length_of_stay")),
            "tachycardia": tachycardia.cast("bigint"),
            "renal_impairment": renal.cast("bigint"),
            "leukocytosis": leuko.cast("bigint"),
            "clinical_risk_index": index,
            "creatinine_zscore": (F.col("creatinine_max") - fv.CREATININE_CENTRE) / fv.CREATININE_SPREAD,
            "hr_category": heart_rate_category(F.col("heart_rate_mean")),
        }
    )


# --- winsorizing -------------------------------------------------------------------------------
def winsorize(df: DataFrame, percents: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Cap columns at their percentiles (averaged definition).

    The columns do not influence each other, so one quantile pass serves them all.
    A missing value takes the lower cap, as it compares below it.
    """
    percents = percents or fv.WINSORIZE_PERCENT
    wanted = sorted({p for pair in percents.values() for p in pair})
    caps = as_fields(quantile_table(df, list(percents), wanted, "averaged"), list(percents))
    name = lambda p: "q" + f"{p:g}".replace(".", "_")
    out = df.withColumn("_caps", caps)
    bound = lambda c, p: F.col("_caps")[c][name(p)]
    capped: dict[str, Column] = {
        c: F.coalesce(clip(F.col(c).cast("double"), bound(c, low), bound(c, high)), bound(c, low))
        for c, (low, high) in percents.items()
    }
    return out.withColumns(capped).drop("_caps")


def complete_cases(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=columns or COMPLETE_CASE_COLUMNS)


def clean(matrix: DataFrame, missing_policy: str = "reference") -> DataFrame:
    """The whole cleaning chain, from raw matrix to model-ready table.

    The fences, the caps and the result all read the rows without duplicates, so these are written."""
    valid = written(valid_ranges_only(dedup_keep(matrix)), "valid_rows")
    kept = drop_outliers(valid, missing_policy)
    return complete_cases(winsorize(clinical_columns(impute_rules(kept))))
