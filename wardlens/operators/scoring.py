"""From a probability column to risk records, and input validation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.bands import bedside_category, bedside_points, bedside_total, risk_category, risk_message
from .features import with_defaults


# --- validation ---------------------------------------------------------------------
def _violation(name: str, bound: tuple[float, bool, float | None]) -> Column:
    low, inclusive, high = bound
    value = F.col(name).cast("double")
    bad = value.isNull() | (value < low if inclusive else value <= low)
    if high is not None:
        bad = bad | (value > high)
    return F.when(bad | F.isnan(value), F.lit(name))


def with_reasons(df: DataFrame) -> DataFrame:
    """Add ``reasons``: the features that are missing or outside their bounds."""
    checks = [_violation(c, b) for c, b in fv.RECORD_BOUNDS.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*checks)))


def validate_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and rejected rows with their reasons."""
    checked = with_reasons(df)
    clean = F.size("reasons") == 0
    return checked.filter(clean).drop("reasons"), checked.filter(~clean)


def with_scoring_defaults(df: DataFrame) -> DataFrame:
    """Defaults for absent input columns of a batch file."""
    return with_defaults(df, fv.SCORING_DEFAULTS)


# --- records -----------------------------------------------------------------------------
def risk_records(scored: DataFrame, threshold: float, probability: str = "probability_event") -> DataFrame:
    """Rounded score, category, decision and message for a probability column.

    Category and decision use the unrounded probability; the reported score is
    rounded half to even at four digits.
    """
    p = F.col(probability)
    return scored.withColumns(
        {
            "risk_score": F.bround(p, 4),
            "risk_category": risk_category(p),
            "adverse_event_flag": (p >= threshold).cast("int").cast("bigint"),
            "threshold_used": F.lit(float(threshold)),
        }
    ).withColumn("clinical_message", risk_message(F.col("risk_category")))


def with_record_fields(records: DataFrame, version: str, model_name: str) -> DataFrame:
    """Input features as a map, model version and scoring time: the full record."""
    pairs = [x for c in fv.BASE_FEATURES for x in (F.lit(c), F.col(c).cast("double"))]
    return records.withColumns(
        {
            "input_features": F.create_map(*pairs),
            "model_version": F.lit(f"{version}:{model_name}"),
            "timestamp": F.current_timestamp(),
        }
    )


def display_columns(records: DataFrame) -> DataFrame:
    """The three columns of the batch result table."""
    return records.select(
        F.col("risk_score").alias("Risk Score"),
        F.col("risk_category").alias("Category"),
        F.when(F.col("adverse_event_flag") == 1, fv.FLAG_YES).otherwise(fv.FLAG_NO).alias("High Risk"),
    )


def feature_title(name: Column) -> Column:
    return F.initcap(F.regexp_replace(name, "_", " "))


def percent_text(share: Column) -> Column:
    """A share as a percentage with one decimal.

    Rounds the exact binary value of ``100 * share``, as C and Python print it.  The
    JVM formatter rounds the shortest decimal text instead and turns 20.95 (really
    20.9499...) into 21.0.
    """
    percent = share * 100.0

    def tenths(bits: int) -> Column:
        whole = F.lit(Decimal(2**bits))
        units = (percent * float(2**bits)).cast("bigint").cast("decimal(20,0)") * 10
        rest = units % whole
        down = ((units - rest) / whole).cast("bigint")
        up = (rest * 2 > whole) | ((rest * 2 == whole) & (down % 2 == 1))
        return down + F.when(up, 1).otherwise(0)

    # small values have finer binary digits; both scales stay below 2^63
    rounded = F.when(percent < 1, tenths(62)).otherwise(tenths(56))
    return F.format_string("%.1f%%", rounded.cast("double") / 10.0)


def interpretation(score: Column, feature: Column, direction: Column) -> Column:
    """One sentence naming the main driver of a score."""
    return F.concat(
        F.lit("This patient's predicted risk of "), percent_text(score), F.lit(" is primarily driven by '"),
        feature, F.lit("' which "), direction, F.lit("."),
    )


# --- bedside score ---------------------------------------------------------------------------
def bedside_score(df: DataFrame) -> DataFrame:
    """Six part scores, their total (0-16) and its category."""
    return (
        df.withColumns(bedside_points())
        .withColumn("ae_risk_score", bedside_total())
        .withColumn("risk_category", bedside_category(F.col("ae_risk_score")))
    )


def display_clips(df: DataFrame) -> DataFrame:
    """Creatinine limited to 0..10 and drug count to 0..30 for plotted tables."""
    from ..functions import clip

    return df.withColumns(
        {
            "creatinine_max": clip(F.col("creatinine_max"), 0.0, 10.0),
            "drug_count": clip(F.col("drug_count").cast("double"), 0.0, 30.0),
        }
    )
