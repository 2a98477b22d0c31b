"""Derived model features as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import clip
from ..functions.bands import flag


def derived_columns() -> dict[str, Column]:
    """The 17 derived features over the base columns.

    Missing inputs take a default inside the derivation only; the base columns keep
    their nulls for the imputer that follows.
    """
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(d)) for c, d in fv.DERIVATION_DEFAULTS.items()}
    age, hr, crea, wbc = x["age"], x["heart_rate_mean"], x["creatinine_max"], x["wbc_mean"]
    los, drugs = x["length_of_stay"], x["drug_count"]
    lab, poly = x["lab_abnormality_score"], x["polypharmacy_score"]
    tachy, renal, leuko = flag(hr > 100), flag(crea > 1.5), flag(wbc > 12)
    long_stay, many_drugs, critical = flag(los >= 7), flag(poly >= 7), flag(lab >= 3)
    composite = (
        0.20 * tachy + 0.25 * renal + 0.20 * leuko + 0.15 * flag(lab >= 2) + 0.10 * many_drugs + 0.10 * long_stay
    )
    return {
        "tachycardia_flag": tachy,
        "renal_impairment_flag": renal,
        "leukocytosis_flag": leuko,
        "elderly_flag": flag(age >= 65),
        "long_stay_flag": long_stay,
        "high_polypharmacy_flag": many_drugs,
        "critical_labs_flag": critical,
        "organ_failure_score": renal + critical + leuko,
        "composite_clinical_risk": clip(composite, 0.0, 1.0),
        "age_creatinine_interaction": (age / 65.0) * (crea / 1.2),
        "hr_los_interaction": (hr / 80.0) * F.log1p(los),
        "drug_lab_interaction": drugs * (lab + 1),
        "poly_creatinine_interaction": poly * crea,
        "log_creatinine": F.log1p(crea),
        "log_los": F.log1p(los),
        "log_wbc": F.log1p(wbc),
        "log_drugs": F.log1p(drugs),
    }


def with_defaults(df: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Add columns that are absent; nulls in present columns stay."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def with_base_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Absent base features become 0.0."""
    return with_defaults(df, dict.fromkeys(columns or fv.BASE_FEATURES, 0.0))


def engineer_features(
    df: DataFrame, columns: list[str] | None = None, add_interactions: bool = True, keep: list[str] = ()
) -> DataFrame:
    """Base features as DOUBLE, then the 17 derived ones, in fixed order."""
    columns = columns or fv.BASE_FEATURES
    base = with_base_columns(df, columns).select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    if not add_interactions:
        return base
    # a derivation input outside ``columns`` takes its default
    known = with_defaults(base, {c: None for c in fv.DERIVATION_DEFAULTS})
    return known.withColumns(derived_columns()).select(*keep, *columns, *fv.DERIVED_FEATURES)


def feature_metadata(spark) -> DataFrame:
    names = "name string, type string, category string, description string, min_val double, max_val double"
    return spark.createDataFrame(fv.FEATURE_METADATA, names)


def feature_dictionary(spark) -> DataFrame:
    return spark.createDataFrame(
        fv.FEATURE_DICTIONARY, "variable string, description string, type string, missing_action string"
    )
