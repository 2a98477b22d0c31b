"""Feature extraction: seven base tables to one row per ICU stay.

Two published variants exist and differ on purpose; they are kept apart as ``a``
and ``b``.  Tall tables (chart events, labs, prescriptions) are reduced to their
join key first, with partial aggregation ahead of the shuffle, and only the reduced
form meets the cohort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import as_long, numeric_round
from ..sources.clinical import ClinicalTables
from ..sources.materialize import written
from .skew import key_counts, salted_join


# --- scalar expressions ------------------------------------------------------------
def seconds_between(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1e6)


def age_years(dob: str = "dob", at: str = "admittime") -> Column:
    return seconds_between(dob, at) / F.lit(fv.SECONDS_PER_YEAR)


def gender_code(col: Column, other: int | None) -> Column:
    """M is 1, F is 0; any other text becomes ``other`` (null in a, 0 in b)."""
    code = F.when(col == "M", F.lit(1)).when(col == "F", F.lit(0))
    code = code if other is None else code.otherwise(F.lit(other))
    return code.cast("bigint")


def is_high_risk_drug(drug: Column) -> Column:
    return F.lower(drug).rlike("|".join(fv.HIGH_RISK_DRUGS))


def _value_of(items: int | list[int]) -> Column:
    items = items if isinstance(items, list) else [items]
    return F.when(F.col("itemid").isin(items), F.col("valuenum"))


def _count_rules(*rules: Column) -> Column:
    """How many rows satisfy any of the rules (each rule names its own item)."""
    return F.sum(as_long(F.coalesce(reduce(lambda a, b: a | b, rules), F.lit(False))))


def _item(item: int | list[int], test) -> Column:
    items = item if isinstance(item, list) else [item]
    return F.col("itemid").isin(items) & test(F.col("valuenum"))


# --- cohorts -----------------------------------------------------------------------
def _cohort(t: ClinicalTables, stays: DataFrame, admission_columns: list[str], age_test) -> DataFrame:
    """patients x admissions x stays; the filters run before the joins.

    A patient or admission has few rows, and what skew there is the adaptive engine splits.
    """
    admissions = t.admissions.filter(F.col("has_chartevents_data") == 1).select(
        "hadm_id", "subject_id", "admittime", *admission_columns
    )
    patients = t.patients.select("subject_id", "gender", "dob")
    admitted = admissions.join(patients, "subject_id").withColumn("age_years", age_years())
    return stays.join(admitted.filter(age_test(F.col("age_years"))), "hadm_id")


def cohort_a(t: ClinicalTables) -> DataFrame:
    low, high = fv.COHORT_AGE
    stays = t.icustays.filter(F.col("los") > 0).select(
        "icustay_id",
        "hadm_id",
        F.col("intime").alias("icu_intime"),
        F.col("outtime").alias("icu_outtime"),
        F.col("los").alias("icu_los_days"),
    )
    joined = _cohort(
        t,
        stays,
        ["dischtime", "deathtime", "hospital_expire_flag", "diagnosis"],
        lambda age: age.between(low, high),
    )
    return joined.select(
        "subject_id", "gender", "dob", "hadm_id", "admittime", "dischtime", "deathtime",
        F.col("hospital_expire_flag").cast("bigint").alias("hospital_expire_flag"),
        "diagnosis", "icustay_id", "icu_intime", "icu_outtime", "icu_los_days", "age_years",
    )


def discharge_label(expired: Column, location: Column) -> Column:
    bad = (expired == 1) | location.isin(fv.ADVERSE_DISCHARGE)
    return as_long(F.coalesce(bad, F.lit(False)))


def cohort_b(t: ClinicalTables) -> DataFrame:
    stays = t.icustays.filter(F.col("los") >= 1).select("icustay_id", "hadm_id", "intime", "outtime")
    joined = _cohort(
        t,
        stays,
        ["dischtime", "admission_type", "insurance", "ethnicity", "hospital_expire_flag", "discharge_location"],
        lambda age: age >= fv.COHORT_AGE[0],
    )
    return joined.select(
        "subject_id", "hadm_id", "icustay_id",
        F.col("age_years").alias("age"),
        gender_code(F.col("gender"), 0).alias("gender"),
        (seconds_between("intime", "outtime") / 3600.0).alias("icu_los_hours"),
        (seconds_between("admittime", "dischtime") / 86400.0).alias("hosp_los_days"),
        "admission_type", "insurance", "ethnicity",
        F.col("hospital_expire_flag").cast("bigint").alias("hospital_expire_flag"),
        discharge_label(F.col("hospital_expire_flag"), F.col("discharge_location")).alias("adverse_event"),
    )


# --- vitals --------------------------------------------------------------------------
def heart_rate_by_stay(t: ClinicalTables) -> DataFrame:
    """Heart-rate summary of every stay with at least one plausible reading."""
    readings = t.chartevents.filter(
        F.col("itemid").isin(fv.HEART_RATE_ITEMS)
        & F.col("valuenum").between(*fv.HEART_RATE_RANGE)
        & ~F.col("error").eqNullSafe(1)
    )
    value = F.col("valuenum")
    return readings.groupBy("icustay_id").agg(
        F.avg(value).alias("heart_rate_mean"),
        F.min(value).alias("heart_rate_min"),
        F.max(value).alias("heart_rate_max"),
        F.stddev_samp(value).alias("heart_rate_std"),
    )


def vitals_a(t: ClinicalTables, cohort: DataFrame) -> DataFrame:
    """Heart rate of the cohort's stays (the stay id is unique on both sides)."""
    return heart_rate_by_stay(t).join(cohort.select("icustay_id"), "icustay_id")


def vitals_b(t: ClinicalTables) -> DataFrame:
    """Twelve measures over five item groups in one pass; no range filter."""
    hr, sbp = _value_of(fv.HEART_RATE_ITEMS), _value_of(fv.SYSTOLIC_ITEMS)
    spo2, temp = _value_of(fv.SPO2_ITEMS), _value_of(fv.TEMPERATURE_ITEMS)
    resp = _value_of(fv.RESPIRATION_ITEMS)
    readings = t.chartevents.filter(F.col("valuenum").isNotNull() & ~F.col("error").eqNullSafe(1))
    return readings.groupBy("icustay_id").agg(
        F.avg(hr).alias("heart_rate_mean"),
        F.max(hr).alias("heart_rate_max"),
        F.min(hr).alias("heart_rate_min"),
        F.stddev_samp(hr).alias("heart_rate_std"),
        F.avg(sbp).alias("sbp_mean"),
        F.min(sbp).alias("sbp_min"),
        F.avg(spo2).alias("spo2_mean"),
        F.min(spo2).alias("spo2_min"),
        F.avg(temp).alias("temp_mean"),
        F.max(temp).alias("temp_max"),
        F.avg(resp).alias("resp_rate_mean"),
        F.max(resp).alias("resp_rate_max"),
    )


# --- labs ----------------------------------------------------------------------------
LAB_MEASURES_A = [
    "creatinine_max", "creatinine_mean", "wbc_mean", "wbc_max", "lactate_max",
    "lactate_mean", "hemoglobin_min", "hemoglobin_mean", "platelets_min", "platelets_mean",
]


def labs_by_admission_a(t: ClinicalTables) -> DataFrame:
    """Five labs pivoted to ten measures and a critical-value count, one pass."""
    items = [fv.CREATININE, fv.WBC, fv.LACTATE, fv.HEMOGLOBIN, fv.PLATELETS]
    crea, wbc, lact = _value_of(fv.CREATININE), _value_of(fv.WBC), _value_of(fv.LACTATE)
    hgb, plt = _value_of(fv.HEMOGLOBIN), _value_of(fv.PLATELETS)
    results = t.labevents.filter(F.col("itemid").isin(items) & (F.col("valuenum") > 0))
    return results.groupBy("hadm_id").agg(
        F.max(crea).alias("creatinine_max"),
        F.avg(crea).alias("creatinine_mean"),
        F.avg(wbc).alias("wbc_mean"),
        F.max(wbc).alias("wbc_max"),
        F.max(lact).alias("lactate_max"),
        F.avg(lact).alias("lactate_mean"),
        F.min(hgb).alias("hemoglobin_min"),
        F.avg(hgb).alias("hemoglobin_mean"),
        F.min(plt).alias("platelets_min"),
        F.avg(plt).alias("platelets_mean"),
        _count_rules(
            _item(fv.CREATININE, lambda v: v > 3.5),
            _item(fv.WBC, lambda v: (v > 12) | (v < 3)),
            _item(fv.LACTATE, lambda v: v > 4),
            _item(fv.HEMOGLOBIN, lambda v: v < 7),
            _item(fv.PLATELETS, lambda v: v < 80),
        ).alias("lab_abnormality_score"),
    )


def labs_a(t: ClinicalTables, cohort: DataFrame, fanout: str = "per_stay") -> DataFrame:
    """Labs of the cohort's admissions.

    ``fanout="per_stay"`` counts every critical lab once per cohort stay of its
    admission, as the published join does; maxima, minima and means do not change
    under that repetition, so the count is multiplied instead of the rows.
    ``fanout="once"`` counts each lab once.
    """
    stays = key_counts(cohort, "hadm_id", "n_stays")
    joined = labs_by_admission_a(t).join(stays, "hadm_id")
    return joined.withColumn("lab_abnormality_score", _fanned(fanout)).drop("n_stays")


def _fanned(fanout: str) -> Column:
    if fanout not in ("per_stay", "once"):
        raise ValueError(f"unknown fanout: {fanout!r}")
    score = F.col("lab_abnormality_score")
    return score * F.col("n_stays") if fanout == "per_stay" else score


def labs_b(t: ClinicalTables) -> DataFrame:
    """Twelve measures and an abnormal-value count over all positive lab values."""
    crea, wbc = _value_of(fv.CREATININE), _value_of(fv.WBC_ITEMS)
    hgb, glucose = _value_of(fv.HEMOGLOBIN), _value_of(fv.GLUCOSE)
    results = t.labevents.filter(F.col("valuenum") > 0)
    return results.groupBy("hadm_id").agg(
        F.max(crea).alias("creatinine_max"),
        F.avg(crea).alias("creatinine_mean"),
        F.avg(wbc).alias("wbc_mean"),
        F.max(wbc).alias("wbc_max"),
        F.avg(_value_of(fv.SODIUM)).alias("sodium_mean"),
        F.avg(_value_of(fv.POTASSIUM)).alias("potassium_mean"),
        F.avg(hgb).alias("hemoglobin_mean"),
        F.min(hgb).alias("hemoglobin_min"),
        F.min(_value_of(fv.PLATELETS)).alias("platelet_min"),
        F.max(glucose).alias("glucose_max"),
        F.avg(glucose).alias("glucose_mean"),
        F.max(_value_of(fv.BUN)).alias("bun_max"),
        _count_rules(
            _item(fv.CREATININE, lambda v: v > 1.2),
            _item(fv.WBC_ITEMS, lambda v: v > 11),
            _item(fv.SODIUM, lambda v: (v < 135) | (v > 145)),
            _item(fv.POTASSIUM, lambda v: (v < 3.5) | (v > 5.0)),
            _item(fv.HEMOGLOBIN, lambda v: v < 8),
            _item(fv.PLATELETS, lambda v: v < 100),
        ).alias("lab_abnormality_count"),
    )


# --- medications ------------------------------------------------------------------------
def _distinct_values(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Distinct (hadm_id, kind, value).

    The shuffle hashes the value as well, so one admission with very many
    prescriptions is spread over all partitions.
    """
    long = rows.unpivot("hadm_id", [F.col(c).alias(k) for k, c in kinds.items()], "kind", "value")
    return long.filter(F.col("value").isNotNull()).distinct()


def _count_kind(kind: str, extra: Column | None = None) -> Column:
    test = F.col("kind") == kind
    return F.count(F.when(test if extra is None else test & extra, F.lit(1)))


def polypharmacy_score(drugs: Column) -> Column:
    return F.least(drugs.cast("double") / 2, F.lit(10.0))


def medications_by_admission_a(t: ClinicalTables) -> DataFrame:
    rows = t.prescriptions.filter(F.col("drug").isNotNull() & F.col("startdate").isNotNull())
    distinct = _distinct_values(rows, {"drug": "drug", "code": "formulary_drug_cd"})
    counts = distinct.groupBy("hadm_id").agg(
        _count_kind("drug").alias("drug_count"),
        _count_kind("code").alias("unique_drug_formulations"),
        _count_kind("drug", is_high_risk_drug(F.col("value"))).alias("high_risk_drug_count"),
    )
    return counts.withColumns(
        {
            "polypharmacy_flag": as_long(F.col("drug_count") >= fv.POLYPHARMACY_DRUGS),
            "polypharmacy_score": polypharmacy_score(F.col("drug_count")),
        }
    )


def medications_a(t: ClinicalTables, cohort: DataFrame) -> DataFrame:
    """Distinct counts do not change when rows repeat, so a semi join is enough."""
    kept = key_counts(cohort, "hadm_id").select("hadm_id")
    return medications_by_admission_a(t).join(kept, "hadm_id", "left_semi")


def medications_b(t: ClinicalTables) -> DataFrame:
    rows = t.prescriptions.filter(F.col("drug").isNotNull())
    distinct = _distinct_values(rows, {"drug": "drug", "type": "drug_type"})
    counts = distinct.groupBy("hadm_id").agg(
        _count_kind("drug").alias("drug_count"), _count_kind("type").alias("drug_type_count")
    )
    return counts.withColumns(
        {
            "polypharmacy_flag": as_long(F.col("drug_count") >= fv.POLYPHARMACY_DRUGS),
            "polypharmacy_score": F.col("drug_count"),
        }
    )


# --- labels --------------------------------------------------------------------------------
def readmissions(t: ClinicalTables) -> DataFrame:
    """More than one ICU stay in the admission, over all stays."""
    stays = key_counts(t.icustays, "hadm_id", "icu_stays_count")
    return stays.withColumn("icu_readmission", as_long(F.col("icu_stays_count") > 1))


def sepsis_admissions(t: ClinicalTables) -> DataFrame:
    coded = t.diagnoses_icd.filter(F.col("icd9_code").isin(fv.SEPSIS_CODES))
    return coded.select("hadm_id").distinct().withColumn("has_sepsis", F.lit(1).cast("bigint"))


def _label_columns() -> dict[str, Column]:
    readmitted = F.coalesce(F.col("icu_readmission"), F.lit(0).cast("bigint"))
    sepsis = F.coalesce(F.col("has_sepsis"), F.lit(0).cast("bigint"))
    critical = as_long(F.coalesce(F.col("lab_abnormality_score") >= fv.CRITICAL_LAB_LABEL, F.lit(False)))
    return {
        "icu_readmission": readmitted,
        "has_sepsis": sepsis,
        "critical_labs": critical,
        "adverse_event": F.greatest(F.col("hospital_expire_flag"), readmitted, sepsis, critical),
    }


def labels_a(t: ClinicalTables, cohort: DataFrame, labs: DataFrame) -> DataFrame:
    """Composite label: death, readmission, sepsis code or critical labs.

    The cohort is read several times; pass a written one.
    """
    facts = (
        key_counts(cohort, "hadm_id")
        .join(readmissions(t).drop("icu_stays_count"), "hadm_id", "left")
        .join(sepsis_admissions(t), "hadm_id", "left")
        .join(labs.select("hadm_id", "lab_abnormality_score"), "hadm_id", "left")
    )
    stays = cohort.select("icustay_id", "hadm_id", "subject_id", "hospital_expire_flag")
    joined = salted_join(stays, facts.drop("n_rows"), "hadm_id", "left", counts=facts.select("hadm_id", "n_rows"))
    return joined.withColumns(_label_columns()).drop("lab_abnormality_score")


# --- matrices -------------------------------------------------------------------------------
MATRIX_A_DIGITS = {
    "heart_rate_mean": 2, "heart_rate_min": 2, "heart_rate_max": 2, "heart_rate_std": 2,
    "creatinine_max": 3, "creatinine_mean": 3, "wbc_mean": 3, "wbc_max": 3,
    "lactate_max": 3, "hemoglobin_min": 3, "platelets_min": 2,
}
MATRIX_A_ZEROS = ["lab_abnormality_score", "drug_count", "high_risk_drug_count", "polypharmacy_flag"]


def feature_matrix_a(t: ClinicalTables, cohort: DataFrame | None = None, fanout: str = "per_stay") -> DataFrame:
    """One row per cohort stay.

    All admission-grain pieces meet on ``hadm_id`` first, where the key is unique on
    every side and one partitioning serves all of them.  The stays join that frame
    once, salted, and the heart rate once on the unique stay id.
    """
    cohort = cohort if cohort is not None else written(cohort_a(t), "cohort_a")
    stays = key_counts(cohort, "hadm_id", "n_stays")
    admission = (
        stays.join(labs_by_admission_a(t), "hadm_id", "left")
        .join(medications_by_admission_a(t), "hadm_id", "left")
        .join(readmissions(t), "hadm_id", "left")
        .join(sepsis_admissions(t), "hadm_id", "left")
        .withColumn("lab_abnormality_score", _fanned(fanout))
    )
    joined = salted_join(
        cohort, admission.drop("n_stays"), "hadm_id", "left", counts=stays, count="n_stays"
    ).join(heart_rate_by_stay(t), "icustay_id", "left")

    measured = {c: numeric_round(F.col(c), d) for c, d in MATRIX_A_DIGITS.items()}
    counted = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in MATRIX_A_ZEROS}
    full = joined.withColumns(
        {
            **_label_columns(),
            **measured,
            **counted,
            "age": numeric_round(F.col("age_years"), 1),
            "gender": gender_code(F.col("gender"), None),
            "length_of_stay": numeric_round(F.col("icu_los_days"), 2),
            "polypharmacy_score": numeric_round(F.coalesce(F.col("polypharmacy_score"), F.lit(0.0)), 2),
        }
    )
    return full.select(
        *fv.ID_COLUMNS, "age", "gender", "length_of_stay", *MATRIX_A_DIGITS, *MATRIX_A_ZEROS,
        "polypharmacy_score", "adverse_event", "hospital_expire_flag", "icu_readmission",
        "has_sepsis", "critical_labs", "admittime", "icu_intime", "diagnosis",
    )


MATRIX_B_COLUMNS = [
    "subject_id", "hadm_id", "icustay_id", "age", "gender", "icu_los_hours", "hosp_los_days",
    "admission_type", "hospital_expire_flag", "adverse_event", *fv.MATRIX_B_DEFAULTS,
]


def feature_matrix_b(t: ClinicalTables, cohort: DataFrame | None = None) -> DataFrame:
    """One row per stay of cohort b, clinical defaults filled in."""
    cohort = cohort if cohort is not None else written(cohort_b(t), "cohort_b")
    stays = key_counts(cohort, "hadm_id", "n_stays")
    labs = labs_b(t).withColumnRenamed("lab_abnormality_count", "lab_abnormality_score")
    admission = stays.join(labs, "hadm_id", "left").join(medications_b(t), "hadm_id", "left")
    joined = salted_join(
        cohort, admission.drop("n_stays"), "hadm_id", "left", counts=stays, count="n_stays"
    ).join(vitals_b(t), "icustay_id", "left")
    return joined.na.fill(fv.MATRIX_B_DEFAULTS).select(*MATRIX_B_COLUMNS)


def length_of_stay_from_hours(matrix_b: DataFrame) -> DataFrame:
    """Matrix b holds hours only; models need the stay in days."""
    return matrix_b.withColumn("length_of_stay", F.col("icu_los_hours") / 24.0)


def cohort_summary(matrix: DataFrame) -> DataFrame:
    mean = lambda c, d: numeric_round(F.avg(c), d)
    return matrix.agg(
        F.count("*").alias("total_patients"),
        F.sum("adverse_event").alias("adverse_events"),
        numeric_round(F.avg("adverse_event") * 100.0, 2).alias("adverse_event_rate_pct"),
        mean("age", 1).alias("mean_age"),
        mean("length_of_stay", 2).alias("mean_icu_los_days"),
    )
