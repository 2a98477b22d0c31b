"""Truth tables of bands, flags, points, categories and number helpers."""

import math

import pytest
from pyspark.sql import functions as F

from wardlens import fixed_values as fv
from wardlens.functions import bands, clip, numeric_round
from wardlens.functions.tails import chi_square_tail, normal_two_sided
from wardlens.operators import cleaning, explain, extract, features, scoring


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")


def out(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


@pytest.mark.parametrize(
    "fn, values, expected",
    [
        (bands.age_group, [None, 18.0, 44.9, 45.0, 64.9, 65.0, 79.9, 80.0, 110.0],
         ["Young", "Young", "Young", "Middle", "Middle", "Senior", "Senior", "Elderly", "Elderly"]),
        (bands.stay_category, [None, 0.9, 1.0, 2.9, 3.0, 6.9, 7.0],
         ["Short", "Short", "Medium", "Medium", "Long", "Long", "Very Long"]),
        (bands.heart_rate_category, [None, 59.9, 60.0, 99.9, 100.0, 129.9, 130.0],
         ["Brady", "Brady", "Normal", "Normal", "Tachy", "Tachy", "Extreme"]),
        (bands.age_interval, [None, 18.0, 18.1, 45.0, 45.1, 65.0, 80.0, 80.1, 110.0, 110.1],
         [None, None, "18-44", "18-44", "45-64", "45-64", "65-79", "80+", "80+", None]),
        (bands.risk_category, [0.0, 0.1999, 0.20, 0.3999, 0.40, 0.6499, 0.65, 1.0],
         ["Low", "Low", "Moderate", "Moderate", "High", "High", "Critical", "Critical"]),
        (bands.bedside_category, [0.0, 3.0, 4.0, 7.0, 8.0, 11.0, 12.0, 16.0],
         ["Low", "Low", "Moderate", "Moderate", "High", "High", "Critical", "Critical"]),
    ],
)
def test_bands(spark, fn, values, expected):
    assert out(column(spark, values), fn(F.col("x"))) == expected


def test_bedside_points(spark):
    names = "age double, heart_rate_mean double, creatinine_max double, wbc_mean double, drug_count double, lab_abnormality_score double"
    rows = [
        (44.9, 80.0, 1.2, 4.0, 4.0, 0.0),
        (45.0, 59.9, 1.3, 12.0, 5.0, 3.0),
        (65.0, 100.0, 2.0, 12.1, 9.0, 4.0),
        (80.0, 130.0, 5.1, 3.9, 10.0, 9.0),
        (79.0, 129.9, 5.0, 8.0, 10.0, 2.0),
        (None, None, None, None, None, None),
    ]
    got = scoring.bedside_score(spark.createDataFrame(rows, names)).collect()
    parts = [(r.age_score, r.hr_score, r.crea_score, r.wbc_score, r.drug_score, r.lab_score, r.ae_risk_score) for r in got]
    assert parts == [
        (0, 0, 0, 0, 0, 0, 0),
        (1, 2, 1, 0, 1, 3, 8),
        (2, 1, 1, 1, 1, 3, 9),
        (3, 3, 3, 2, 2, 3, 16),
        (2, 1, 2, 0, 2, 2, 9),
        (0, 2, 0, 2, 0, 3, 7),
    ]


def test_numeric_round_is_half_up_on_decimals(spark):
    df = column(spark, [2.675, 1.005, -2.675, 0.125, None])
    assert out(df, numeric_round(F.col("x"), 2)) == [2.68, 1.01, -2.68, 0.13, None]


def test_clip_keeps_null_and_is_idempotent(spark):
    df = column(spark, [None, -1.0, 0.5, 9.0])
    once = clip(F.col("x"), 0.0, 1.0)
    assert out(df, once) == [None, 0.0, 0.5, 1.0]
    assert out(df, clip(once, 0.0, 1.0)) == [None, 0.0, 0.5, 1.0]


def test_high_risk_drugs(spark):
    names = ["Heparin Sodium", "INSULIN", "xWarfarin", "Morphine Sulfate", "anticoagulant", "Opioid", "sedatives", "Aspirin"]
    assert out(column(spark, names, "string"), extract.is_high_risk_drug(F.col("x"))) == [True] * 7 + [False]


def test_discharge_label_and_gender(spark):
    rows = [(0, 1, "HOME"), (1, 0, "HOSPICE-HOME"), (2, 0, "HOSPICE-MEDICAL FACILITY"), (3, 0, "DEAD/EXPIRED"), (4, 0, None), (5, 0, "HOME")]
    df = spark.createDataFrame(rows, "i int, e int, x string")
    assert out(df, extract.discharge_label(F.col("e"), F.col("x"))) == [1, 1, 1, 1, 0, 0]
    sex = column(spark, ["M", "F", "U", None], "string")
    assert out(sex, extract.gender_code(F.col("x"), None)) == [1, 0, None, None]
    assert out(sex, extract.gender_code(F.col("x"), 0)) == [1, 0, 0, 0]


FLAGS = [
    ("heart_rate_mean", 100.0, "tachycardia_flag", 0.0), ("heart_rate_mean", 100.1, "tachycardia_flag", 1.0),
    ("creatinine_max", 1.5, "renal_impairment_flag", 0.0), ("creatinine_max", 1.6, "renal_impairment_flag", 1.0),
    ("wbc_mean", 12.0, "leukocytosis_flag", 0.0), ("wbc_mean", 12.1, "leukocytosis_flag", 1.0),
    ("age", 64.9, "elderly_flag", 0.0), ("age", 65.0, "elderly_flag", 1.0),
    ("length_of_stay", 6.9, "long_stay_flag", 0.0), ("length_of_stay", 7.0, "long_stay_flag", 1.0),
    ("polypharmacy_score", 6.9, "high_polypharmacy_flag", 0.0), ("polypharmacy_score", 7.0, "high_polypharmacy_flag", 1.0),
    ("lab_abnormality_score", 2.0, "critical_labs_flag", 0.0), ("lab_abnormality_score", 3.0, "critical_labs_flag", 1.0),
]


def test_derived_flags(spark):
    calm = dict.fromkeys(fv.BASE_FEATURES, 1.0)
    rows = [tuple({**calm, c: v}.values()) for c, v, _, _ in FLAGS]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in fv.BASE_FEATURES))
    got = features.engineer_features(df.coalesce(1)).collect()
    assert [r[f] for r, (_, _, f, _) in zip(got, FLAGS)] == [want for *_, want in FLAGS]


def test_derived_features_have_no_nulls_and_26_columns(spark):
    nulls = spark.createDataFrame([tuple([None] * 9)], ", ".join(f"{c} double" for c in fv.BASE_FEATURES))
    row = features.engineer_features(nulls).first()
    assert len(row) == 26 and all(row[c] is not None for c in fv.DERIVED_FEATURES)
    assert row["log_creatinine"] == pytest.approx(math.log(2)) and row["elderly_flag"] == 1.0
    assert features.engineer_features(nulls, add_interactions=False).columns == fv.BASE_FEATURES


def test_absent_columns_become_zero(spark):
    df = spark.createDataFrame([(70.0,)], "age double")
    row = features.engineer_features(df).first()
    assert row["creatinine_max"] == 0.0 and row["log_creatinine"] == 0.0 and row["elderly_flag"] == 1.0


def test_magnitude_and_direction(spark):
    df = column(spark, [0.11, -0.11, 0.1, 0.021, -0.02, 0.0])
    assert out(df, explain.magnitude(F.col("x"))) == ["high", "high", "medium", "medium", "low", "low"]
    up, down = fv.DIRECTION_UP, fv.DIRECTION_DOWN
    assert out(df, explain.direction(F.col("x"))) == [up, down, up, up, down, down]


def test_percent_text_matches_printf(spark):
    values = [i / 10000 for i in range(0, 10001, 5)]
    assert out(column(spark, values), scoring.percent_text(F.col("x"))) == [f"{v:.1%}" for v in values]


def test_half_even_score(spark):
    df = column(spark, [0.12345, 0.12355, 0.5])
    got = [r.risk_score for r in scoring.risk_records(df, 0.5, "x").orderBy("i").collect()]
    assert got == [0.1234, 0.1236, 0.5]


def test_tails():
    assert normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert chi_square_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert chi_square_tail(7.814728, 3) == pytest.approx(0.05, abs=1e-6)
    assert chi_square_tail(15.507313, 8) == pytest.approx(0.05, abs=1e-6)
    assert chi_square_tail(0.0, 4) == 1.0


def test_clinical_index_weights(spark):
    row = (70.0, 4.0, 101.0, 1.6, 12.1, 1, 2)
    names = "age double, length_of_stay double, heart_rate_mean double, creatinine_max double, wbc_mean double, polypharmacy_flag int, lab_abnormality_score int"
    got = cleaning.clinical_columns(spark.createDataFrame([row], names)).first()
    assert got.clinical_risk_index == pytest.approx(1.0)
    assert got.creatinine_zscore == pytest.approx((1.6 - 1.1) / 1.4)
