"""A score that no model fit can move, for queries about scores.

The coefficients are plain test values; every metric query uses this score so that
its SQL twin never depends on a fitted model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIXED_BETA = {
    "age": 0.02,
    "length_of_stay": 0.04,
    "lab_abnormality_score": 0.15,
    "drug_count": 0.05,
    "heart_rate_mean": 0.01,
    "creatinine_max": 0.11,
}


def logit_score():
    return (
        F.lit(-1.5)
        + 0.02 * (F.col("age") - 65)
        + 0.04 * F.col("length_of_stay")
        + 0.15 * F.col("lab_abnormality_score")
        + 0.05 * F.col("drug_count")
    )


def with_fixed_score(matrix: DataFrame, digits: int | None = 3) -> DataFrame:
    """Rounded to three digits by default, so that ties occur."""
    score = 1.0 / (1.0 + F.exp(-logit_score()))
    return matrix.withColumn("score", F.round(score, digits) if digits else score)


RAW_SCORE_SQL = (
    "1e0/(1e0+exp(-(-1.5e0 + 0.02e0*(age-65) + 0.04e0*length_of_stay + "
    "0.15e0*lab_abnormality_score + 0.05e0*drug_count)))"
)
SCORE_SQL = f"round({RAW_SCORE_SQL}, 3)"
