"""Registered queries of the extraction layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric_round
from ..operators import extract, sketches
from ..sources.materialize import written
from .oracle_ctes import CTES, r6, with_ctes
from .registry import register, tables


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All DOUBLE columns rounded for comparison; only ever the last step."""
    return df.withColumns({c: numeric_round(F.col(c), digits) for c, t in df.dtypes if t == "double"})


def _oracle(cte: str, doubles: str) -> str:
    swaps = ", ".join(f"{r6(c)} as {c}" for c in doubles.split())
    return with_ctes(f"select * replace ({swaps}) from {cte}" if doubles else f"select * from {cte}")


@register("cohort_a", _oracle("cohort_a", "icu_los_days age_years"))
def cohort_a(spark, sf):
    return rounded(extract.cohort_a(tables(spark, sf)))


@register("cohort_b", _oracle("cohort_b", "age icu_los_hours hosp_los_days"))
def cohort_b(spark, sf):
    return rounded(extract.cohort_b(tables(spark, sf)))


@register("vitals_a", _oracle("heart_rate_a", "heart_rate_mean heart_rate_min heart_rate_max heart_rate_std"))
def vitals_a(spark, sf):
    t = tables(spark, sf)
    return rounded(extract.vitals_a(t, extract.cohort_a(t)))


@register(
    "vitals_b",
    _oracle(
        "vitals_b",
        "heart_rate_mean heart_rate_max heart_rate_min heart_rate_std sbp_mean sbp_min spo2_mean spo2_min "
        "temp_mean temp_max resp_rate_mean resp_rate_max",
    ),
)
def vitals_b(spark, sf):
    return rounded(extract.vitals_b(tables(spark, sf)))


_LABS_A = " ".join(extract.LAB_MEASURES_A)


@register("labs_a", _oracle("labs_a", _LABS_A))
def labs_a(spark, sf):
    t = tables(spark, sf)
    return rounded(extract.labs_a(t, extract.cohort_a(t)))


@register("labs_a_semi", _oracle("labs_a_once", _LABS_A))
def labs_a_semi(spark, sf):
    t = tables(spark, sf)
    return rounded(extract.labs_a(t, extract.cohort_a(t), fanout="once"))


@register(
    "labs_b",
    _oracle(
        "labs_b",
        "creatinine_max creatinine_mean wbc_mean wbc_max sodium_mean potassium_mean hemoglobin_mean "
        "hemoglobin_min platelet_min glucose_max glucose_mean bun_max",
    ),
)
def labs_b(spark, sf):
    return rounded(extract.labs_b(tables(spark, sf)))


@register("meds_a", _oracle("meds_a", "polypharmacy_score"))
def meds_a(spark, sf):
    t = tables(spark, sf)
    return rounded(extract.medications_a(t, extract.cohort_a(t)))


@register(
    "distinct_by_sketch",
    with_ctes("""select drug_type, count(distinct hadm_id) n_admissions, count(distinct drug) n_drugs, true as admissions_near, true as drugs_near
      from prescriptions where startdate is not null group by drug_type"""),
)
def distinct_by_sketch(spark, sf):
    """Admissions and drugs per drug type from monthly sketches, checked against the exact counts.

    An estimate is near where it is within four standard errors of the exact count.
    """
    rows = tables(spark, sf).prescriptions.filter(F.col("startdate").isNotNull())
    columns = ["hadm_id", "drug"]
    partials = written(sketches.distinct_partials(rows, F.trunc("startdate", "month"), ["drug_type"], columns), "distinct_partials")
    merged = sketches.merged_distinct(partials, ["drug_type"], columns).withColumnRenamed("drug_type", "_type")
    exact = rows.groupBy("drug_type").agg(F.count_distinct("hadm_id").alias("n_admissions"), F.count_distinct("drug").alias("n_drugs"))
    near = lambda estimate, n: F.abs(F.col(estimate) - F.col(n)) <= 4 * sketches.relative_error() * F.col(n)
    joined = exact.join(merged, exact["drug_type"].eqNullSafe(merged["_type"]))
    return joined.select(
        "drug_type", "n_admissions", "n_drugs",
        near("hadm_id", "n_admissions").alias("admissions_near"), near("drug", "n_drugs").alias("drugs_near"),
    )


@register("meds_b", _oracle("meds_b", ""))
def meds_b(spark, sf):
    return extract.medications_b(tables(spark, sf))


@register("readmissions", _oracle("readmit", ""))
def readmissions(spark, sf):
    return extract.readmissions(tables(spark, sf))


@register("sepsis_admissions", _oracle("sepsis", ""))
def sepsis_admissions(spark, sf):
    return extract.sepsis_admissions(tables(spark, sf))


@register("labels_a", _oracle("labels_a", ""))
def labels_a(spark, sf):
    t = tables(spark, sf)
    cohort = written(extract.cohort_a(t), "cohort_a")
    return extract.labels_a(t, cohort, extract.labs_a(t, cohort))


@register("label_b", with_ctes("select icustay_id, hospital_expire_flag, adverse_event from cohort_b"))
def label_b(spark, sf):
    return extract.cohort_b(tables(spark, sf)).select("icustay_id", "hospital_expire_flag", "adverse_event")


@register("feature_matrix_a", _oracle("matrix_a", ""))
def feature_matrix_a(spark, sf):
    return extract.feature_matrix_a(tables(spark, sf))


_B_DOUBLES = (
    "age icu_los_hours hosp_los_days creatinine_max creatinine_mean wbc_mean wbc_max sodium_mean potassium_mean "
    "hemoglobin_mean hemoglobin_min platelet_min glucose_max bun_max heart_rate_mean heart_rate_max heart_rate_std "
    "sbp_mean sbp_min spo2_mean spo2_min temp_mean resp_rate_mean"
)


@register("feature_matrix_b", _oracle("matrix_b", _B_DOUBLES))
def feature_matrix_b(spark, sf):
    return rounded(extract.feature_matrix_b(tables(spark, sf)))


@register(
    "matrix_b_model_columns",
    with_ctes(f"""select icustay_id, {r6('age')} age, {r6('icu_los_hours / 24.0')} length_of_stay,
      {r6('heart_rate_mean')} heart_rate_mean, lab_abnormality_score, drug_count, polypharmacy_score, adverse_event
      from matrix_b"""),
)
def matrix_b_model_columns(spark, sf):
    full = extract.length_of_stay_from_hours(extract.feature_matrix_b(tables(spark, sf)))
    return rounded(
        full.select(
            "icustay_id", "age", "length_of_stay", "heart_rate_mean", "lab_abnormality_score",
            "drug_count", "polypharmacy_score", "adverse_event",
        )
    )


@register(
    "cohort_summary",
    with_ctes("""select count(*) total_patients, cast(sum(adverse_event) as bigint) adverse_events,
      cast(round(cast(avg(adverse_event) * 100.0 as decimal(38,12)), 2) as double) adverse_event_rate_pct,
      cast(round(cast(avg(age) as decimal(38,12)), 1) as double) mean_age,
      cast(round(cast(avg(length_of_stay) as decimal(38,12)), 2) as double) mean_icu_los_days from matrix_a"""),
)
def cohort_summary(spark, sf):
    from .registry import matrix_a

    return extract.cohort_summary(matrix_a(spark, sf))


assert "matrix_a" in CTES
