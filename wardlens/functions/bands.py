"""Banding of values into labels and points.

In the source rules a missing value compares as smaller than every number, so a
missing value falls into the first band that has only an upper limit.  ``under``
spells that out, because a null comparison in Spark is null.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def under(col: Column, limit: float) -> Column:
    return col.isNull() | (col < limit)


def at_most(col: Column, limit: float) -> Column:
    return col.isNull() | (col <= limit)


def chain(cases: list[tuple[Column, object]], last) -> Column:
    """First matching case wins."""
    (test, value), *rest = cases
    out = F.when(test, F.lit(value))
    for test, value in rest:
        out = out.when(test, F.lit(value))
    return out.otherwise(F.lit(last))


def flag(test: Column) -> Column:
    """1.0 where the test is true, 0.0 where it is false or unknown."""
    return F.coalesce(test, F.lit(False)).cast("double")


def age_group(age: Column) -> Column:
    return chain([(under(age, 45), "Young"), (age < 65, "Middle"), (age < 80, "Senior")], "Elderly")


def stay_category(days: Column) -> Column:
    return chain([(under(days, 1), "Short"), (days < 3, "Medium"), (days < 7, "Long")], "Very Long")


def heart_rate_category(rate: Column) -> Column:
    return chain([(under(rate, 60), "Brady"), (rate < 100, "Normal"), (rate < 130, "Tachy")], "Extreme")


def age_interval(age: Column) -> Column:
    """Right-closed intervals; 18.0 itself and values beyond 110 fall out as null."""
    return (
        F.when((age > 18) & (age <= 45), F.lit("18-44"))
        .when((age > 45) & (age <= 65), F.lit("45-64"))
        .when((age > 65) & (age <= 80), F.lit("65-79"))
        .when((age > 80) & (age <= 110), F.lit("80+"))
    )


def bedside_points() -> dict[str, Column]:
    """The six part scores of the bedside score."""
    age, rate, crea = F.col("age"), F.col("heart_rate_mean"), F.col("creatinine_max")
    wbc, drugs, lab = F.col("wbc_mean"), F.col("drug_count"), F.col("lab_abnormality_score")
    parts = {
        "age_score": chain([(under(age, 45), 0), (age < 65, 1), (age < 80, 2)], 3),
        "hr_score": chain([(under(rate, 60), 2), (rate < 100, 0), (rate < 130, 1)], 3),
        "crea_score": chain([(at_most(crea, 1.2), 0), (crea <= 2.0, 1), (crea <= 5.0, 2)], 3),
        "wbc_score": chain([(wbc.between(4, 12), 0), (wbc > 12, 1)], 2),
        "drug_score": chain([(under(drugs, 5), 0), (drugs < 10, 1)], 2),
        "lab_score": F.least(lab, F.lit(3)),
    }
    return {name: points.cast("bigint") for name, points in parts.items()}


def bedside_total() -> Column:
    return reduce(add, [F.col(c) for c in ["age_score", "hr_score", "crea_score", "wbc_score", "drug_score", "lab_score"]])


def bedside_category(total: Column) -> Column:
    return chain([(at_most(total, 3), "Low"), (total <= 7, "Moderate"), (total <= 11, "High")], "Critical")


def risk_category(score: Column) -> Column:
    return chain([(score < cut, name) for cut, name in fv.RISK_CUTS], fv.RISK_TOP)


def risk_message(category: Column) -> Column:
    return chain([(category == name, text) for name, text in fv.RISK_MESSAGES.items()], None)
