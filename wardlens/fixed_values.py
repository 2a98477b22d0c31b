"""Fixed values.

Every constant below must equal the published clinical definition for results to
match: column names, item ids, diagnosis codes, cut points, weights, default
values and message texts.  They are plain data; the logic that uses them lives in
``wardlens.operators`` and ``wardlens.functions``.
"""

# --- columns -----------------------------------------------------------------
ID_COLUMNS = ["subject_id", "hadm_id", "icustay_id"]
LABEL = "adverse_event"
BASE_FEATURES = [
    "age",
    "gender",
    "length_of_stay",
    "heart_rate_mean",
    "creatinine_max",
    "wbc_mean",
    "drug_count",
    "polypharmacy_score",
    "lab_abnormality_score",
]
DERIVED_FEATURES = [
    "tachycardia_flag",
    "renal_impairment_flag",
    "leukocytosis_flag",
    "elderly_flag",
    "long_stay_flag",
    "high_polypharmacy_flag",
    "critical_labs_flag",
    "organ_failure_score",
    "composite_clinical_risk",
    "age_creatinine_interaction",
    "hr_los_interaction",
    "drug_lab_interaction",
    "poly_creatinine_interaction",
    "log_creatinine",
    "log_los",
    "log_wbc",
    "log_drugs",
]

# --- valid ranges ------------------------------------------------------------
CLINICAL_RANGES = {
    "age": (18.0, 110.0),
    "gender": (0.0, 1.0),
    "length_of_stay": (0.1, 365.0),
    "heart_rate_mean": (20.0, 300.0),
    "creatinine_max": (0.1, 30.0),
    "wbc_mean": (0.1, 200.0),
    "drug_count": (0.0, 200.0),
    "polypharmacy_score": (0.0, 10.0),
    "lab_abnormality_score": (0.0, 20.0),
}
# (low, low is inclusive, high or None)
RECORD_BOUNDS = {
    "age": (18.0, True, 110.0),
    "gender": (0.0, True, 1.0),
    "length_of_stay": (0.0, False, 365.0),
    "heart_rate_mean": (20.0, True, 300.0),
    "creatinine_max": (0.0, True, 30.0),
    "wbc_mean": (0.0, True, 200.0),
    "drug_count": (0.0, True, 200.0),
    "polypharmacy_score": (0.0, True, 10.0),
    "lab_abnormality_score": (0.0, True, None),
}

# --- item ids ----------------------------------------------------------------
HEART_RATE_ITEMS = [211, 220045]
SYSTOLIC_ITEMS = [51, 442, 455, 6701, 220179, 220050]
SPO2_ITEMS = [646, 220277]
TEMPERATURE_ITEMS = [678, 223761]
RESPIRATION_ITEMS = [615, 618, 220210, 224690]
CREATININE = 50912
WBC = 51301
WBC_ITEMS = [51300, 51301]
LACTATE = 50813
HEMOGLOBIN = 51222
PLATELETS = 51265
SODIUM = 50983
POTASSIUM = 50971
GLUCOSE = 50931
BUN = 51006

# --- cohort, label and drug definitions ----------------------------------------
SECONDS_PER_YEAR = 365.25 * 86400
COHORT_AGE = (18, 110)
HEART_RATE_RANGE = (20, 300)
SEPSIS_CODES = [
    "99591", "99592", "78552", "99811", "99812", "5849", "5845", "5846", "5847",
    "99859", "99802",
]
ADVERSE_DISCHARGE = ["DEAD/EXPIRED", "HOSPICE-MEDICAL FACILITY", "HOSPICE-HOME"]
HIGH_RISK_DRUGS = [
    "anticoagul", "warfarin", "heparin", "insulin", "opioid", "morphine", "sedative",
]
CRITICAL_LAB_LABEL = 3
POLYPHARMACY_DRUGS = 5

# --- defaults of matrix b (null replaced by) -------------------------------------
MATRIX_B_DEFAULTS = {
    "creatinine_max": 1.0,
    "creatinine_mean": 1.0,
    "wbc_mean": 8.0,
    "wbc_max": 8.0,
    "sodium_mean": 140.0,
    "potassium_mean": 4.0,
    "hemoglobin_mean": 12.0,
    "hemoglobin_min": 12.0,
    "platelet_min": 200.0,
    "glucose_max": 100.0,
    "bun_max": 15.0,
    "lab_abnormality_score": 0,
    "heart_rate_mean": 80.0,
    "heart_rate_max": 80.0,
    "heart_rate_std": 10.0,
    "sbp_mean": 120.0,
    "sbp_min": 120.0,
    "spo2_mean": 98.0,
    "spo2_min": 98.0,
    "temp_mean": 37.0,
    "resp_rate_mean": 16.0,
    "drug_count": 0,
    "polypharmacy_score": 0,
    "polypharmacy_flag": 0,
}

# --- cleaning --------------------------------------------------------------------
STAY_DAYS_MAX = 365
FENCE_IQR_MULTIPLE = 3
FENCED = ["heart_rate_mean", "creatinine_max", "wbc_mean", "length_of_stay"]
STRATA_MEDIANS = {
    "heart_rate_mean": "med_hr",
    "creatinine_max": "med_crea",
    "wbc_mean": "med_wbc",
    "lactate_max": "med_lac",
    "hemoglobin_min": "med_hgb",
    "platelets_min": "med_plt",
    "polypharmacy_score": "med_poly",
}
WINSORIZE_PERCENT = {
    "length_of_stay": (1, 99),
    "heart_rate_mean": (1, 99),
    "creatinine_max": (1, 99),
    "wbc_mean": (1, 99),
    "drug_count": (0, 99),
}
# creatinine z-score centre and spread
CREATININE_CENTRE = 1.1
CREATININE_SPREAD = 1.4

# --- feature derivation -------------------------------------------------------------
DERIVATION_DEFAULTS = {
    "age": 65.0,
    "heart_rate_mean": 80.0,
    "creatinine_max": 1.0,
    "wbc_mean": 9.0,
    "length_of_stay": 2.0,
    "drug_count": 5.0,
    "lab_abnormality_score": 0.0,
    "polypharmacy_score": 2.5,
}
SCORING_DEFAULTS = {
    "age": 65.0,
    "gender": 0.0,
    "length_of_stay": 3.0,
    "heart_rate_mean": 88.0,
    "creatinine_max": 1.0,
    "wbc_mean": 9.0,
    "drug_count": 5.0,
    "polypharmacy_score": 2.5,
    "lab_abnormality_score": 0.0,
}
CLIP_PERCENT = (0.5, 99.5)

# --- risk categories and messages ------------------------------------------------------
RISK_CUTS = [(0.20, "Low"), (0.40, "Moderate"), (0.65, "High")]
RISK_TOP = "Critical"
RISK_MESSAGES = {
    "Low": "Low adverse event risk. Continue standard ICU monitoring protocols.",
    "Moderate": "Moderate risk. Increase monitoring frequency; review medication list.",
    "High": "High risk. Consider clinical review, escalation, and family notification.",
    "Critical": "CRITICAL RISK. Immediate intensivist review strongly recommended.",
}
DIRECTION_UP = "↑ increases risk"
DIRECTION_DOWN = "↓ decreases risk"
MAGNITUDE_HIGH = 0.10
MAGNITUDE_MEDIUM = 0.02
FLAG_YES = "⚠ Yes"
FLAG_NO = "✓ No"

# --- feature dictionaries --------------------------------------------------------------
FEATURE_METADATA = [
    ("age", "continuous", "Demographics", "Patient age (years)", 18.0, 110.0),
    ("gender", "binary", "Demographics", "Sex: 1=Male, 0=Female", 0.0, 1.0),
    ("length_of_stay", "continuous", "ICU", "ICU length of stay (days)", 0.1, 365.0),
    ("heart_rate_mean", "continuous", "Vitals", "Mean heart rate (bpm)", 20.0, 300.0),
    ("creatinine_max", "continuous", "Labs", "Maximum serum creatinine (mg/dL)", 0.1, 30.0),
    ("wbc_mean", "continuous", "Labs", "Mean WBC count (K/µL)", 0.1, 200.0),
    ("drug_count", "count", "Medications", "Distinct drugs prescribed", 0.0, 200.0),
    ("polypharmacy_score", "continuous", "Medications", "Polypharmacy burden score (0–10)", 0.0, 10.0),
    ("lab_abnormality_score", "count", "Labs", "Count of critical lab abnormalities", 0.0, 20.0),
]
FEATURE_DICTIONARY = [
    ("age", "Patient age in years", "continuous", "Clinical reference 65"),
    ("gender", "Patient sex (1=Male, 0=Female)", "binary", "Mode imputation"),
    ("length_of_stay", "ICU length of stay in days", "continuous", "Exclude negatives"),
    ("heart_rate_mean", "Mean heart rate during ICU stay", "continuous", "Clinical default 80"),
    ("creatinine_max", "Maximum serum creatinine", "continuous", "Clinical default 1.0"),
    ("wbc_mean", "Mean white blood cell count", "continuous", "Clinical default 9.0"),
    ("drug_count", "Total distinct drugs prescribed", "count", "Zero imputation"),
    ("polypharmacy_score", "Polypharmacy burden score 0-10", "continuous", "Zero imputation"),
    ("lab_abnormality_score", "Count of critical lab values", "count", "Zero imputation"),
    ("adverse_event", "Composite adverse outcome label", "binary", "Target variable"),
]
ODDS_RATIO_LABELS = {
    "age": "Age (years)",
    "gender": "Gender (1=Male)",
    "length_of_stay": "ICU Length of Stay",
    "heart_rate_mean": "Mean Heart Rate",
    "creatinine_max": "Max Creatinine",
    "wbc_mean": "Mean WBC",
    "drug_count": "Drug Count",
    "polypharmacy_score": "Polypharmacy Score",
    "lab_abnormality_score": "Lab Abnormality Score",
}
