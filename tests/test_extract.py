"""Extraction rules on a handful of hand-made clinical rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardlens.operators import extract
from wardlens.sources.clinical import ClinicalTables

BORN = datetime(1950, 1, 1)
IN = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    ts = "timestamp_ntz"
    patients = make(
        [(1, "M", BORN), (2, "F", datetime(2005, 1, 1)), (3, "U", datetime(1900, 1, 1))],
        f"subject_id bigint, gender string, dob {ts}",
    )
    admissions = make(
        [
            (10, 1, IN, IN, None, 0, 1, "x", "E", "I", "A", "HOME"),
            (11, 1, IN, IN, IN, 1, 1, "x", "E", "I", "A", "HOME"),
            (12, 1, IN, IN, None, 0, 0, "x", "E", "I", "A", "HOME"),
            (20, 2, IN, IN, None, 0, 1, "x", "E", "I", "A", "HOME"),
            (30, 3, IN, IN, None, 0, 1, "x", "E", "I", "A", "DEAD/EXPIRED"),
        ],
        f"hadm_id bigint, subject_id bigint, admittime {ts}, dischtime {ts}, deathtime {ts}, hospital_expire_flag int, "
        "has_chartevents_data int, diagnosis string, admission_type string, insurance string, ethnicity string, "
        "discharge_location string",
    )
    icustays = make(
        [(101, 10, IN, IN, 2.0), (102, 10, IN, IN, 0.5), (103, 10, IN, IN, None), (111, 11, IN, IN, 3.0),
         (121, 12, IN, IN, 1.0), (201, 20, IN, IN, 1.0), (301, 30, IN, IN, 1.0)],
        f"icustay_id bigint, hadm_id bigint, intime {ts}, outtime {ts}, los double",
    )
    chart = make(
        [(101, 211, 80.0, None), (101, 220045, 100.0, 0), (101, 211, 90.0, 1), (101, 211, 350.0, None),
         (101, 211, None, None), (111, 211, 60.0, None), (101, 646, 97.0, None)],
        "icustay_id bigint, itemid int, valuenum double, error int",
    )
    labs = make(
        [(10, 50912, 4.0), (10, 51301, 13.0), (10, 51222, 6.0), (10, 50912, 3.5), (10, 51265, None),
         (10, 50813, 0.0), (11, 51301, 2.0), (11, 51300, 20.0)],
        "hadm_id bigint, itemid int, valuenum double",
    )
    drugs = [("Heparin", "h1"), ("heparin", "h1"), ("Aspirin", "a1"), ("Aspirin", "a2"), ("Insulin", None), (None, "n"), ("Late", "l")]
    prescriptions = make(
        [(10, d, c, "MAIN", None if d == "Late" else IN) for d, c in drugs],
        f"hadm_id bigint, drug string, formulary_drug_cd string, drug_type string, startdate {ts}",
    )
    diagnoses = make([(11, "99592"), (11, "78552"), (10, "V10")], "hadm_id bigint, icd9_code string")
    return ClinicalTables(patients, admissions, icustays, chart, labs, prescriptions, diagnoses)


def test_cohorts(tables):
    # 103 has no los, 121 no chart data, 201 is a minor, 301 is over 110
    assert sorted(r.icustay_id for r in extract.cohort_a(tables).collect()) == [101, 102, 111]
    b = {r.icustay_id: r for r in extract.cohort_b(tables).collect()}
    assert sorted(b) == [101, 111, 301]
    assert (b[101].gender, b[301].gender) == (1, 0)
    assert (b[101].adverse_event, b[111].adverse_event, b[301].adverse_event) == (0, 1, 1)


def test_heart_rate(tables):
    got = {r.icustay_id: r for r in extract.heart_rate_by_stay(tables).collect()}
    assert (got[101].heart_rate_mean, got[101].heart_rate_min, got[101].heart_rate_max) == (90.0, 80.0, 100.0)
    assert got[111].heart_rate_std is None


def test_lab_fanout(tables):
    cohort = extract.cohort_a(tables)
    per_stay = {r.hadm_id: r.lab_abnormality_score for r in extract.labs_a(tables, cohort).collect()}
    once = {r.hadm_id: r.lab_abnormality_score for r in extract.labs_a(tables, cohort, "once").collect()}
    assert once == {10: 3, 11: 1} and per_stay == {10: 6, 11: 1}
    with pytest.raises(ValueError):
        extract.labs_a(tables, cohort, "twice")
    b = {r.hadm_id: r for r in extract.labs_b(tables).collect()}
    assert (b[11].wbc_mean, b[11].lab_abnormality_count) == (11.0, 1)


def test_medications(tables):
    row = extract.medications_by_admission_a(tables).first()
    assert (row.drug_count, row.unique_drug_formulations, row.high_risk_drug_count) == (4, 3, 3)
    assert (row.polypharmacy_flag, row.polypharmacy_score) == (0, 2.0)
    b = extract.medications_b(tables).first()
    assert (b.drug_count, b.drug_type_count, b.polypharmacy_flag, b.polypharmacy_score) == (5, 1, 1, 5)


def test_labels_and_matrix(tables):
    got = {r.icustay_id: r for r in extract.feature_matrix_a(tables).collect()}
    assert (got[101].icu_readmission, got[101].critical_labs, got[101].has_sepsis, got[101].adverse_event) == (1, 1, 0, 1)
    assert (got[111].icu_readmission, got[111].critical_labs, got[111].has_sepsis, got[111].adverse_event) == (0, 0, 1, 1)
    assert got[111].drug_count == 0 and got[111].polypharmacy_score == 0.0
    assert got[101].age == 70.0 and got[102].heart_rate_mean is None
    plain = {r.icustay_id: r.critical_labs for r in extract.feature_matrix_a(tables, fanout="once").collect()}
    assert plain == {101: 1, 102: 1, 111: 0}


def test_matrix_does_not_depend_on_salting(tables, monkeypatch):
    from wardlens.operators import skew

    want = sorted(map(str, extract.feature_matrix_a(tables).collect()))
    monkeypatch.setattr(skew, "HOT_ROWS", 1)
    assert sorted(map(str, extract.feature_matrix_a(tables).collect())) == want


def test_matrix_b_defaults(tables):
    got = {r.icustay_id: r for r in extract.length_of_stay_from_hours(extract.feature_matrix_b(tables)).collect()}
    assert (got[301].creatinine_max, got[301].wbc_mean, got[301].heart_rate_std) == (1.0, 8.0, 10.0)
    assert (got[301].drug_count, got[301].lab_abnormality_score) == (0, 0)
    assert got[101].spo2_min == 97.0 and got[101].length_of_stay == 0.0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm_and_prune(spark):
    from wardlens.plans.registry import tables as driver_tables

    t = driver_tables(spark, "/root/testdata/sf0.001")
    text = plan_of(extract.feature_matrix_a(t))
    for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]:
        assert bad not in text
    assert "l_extendedprice" not in text and "o_totalprice" not in text
    real = t.chartevents.filter(F.col("valuenum") > 0)
    assert "partial_avg" in plan_of(real.groupBy("icustay_id").agg(F.avg("valuenum")))
