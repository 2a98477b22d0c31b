"""Distinct counts from sketches that merge: one per period and group, united on read.

A sketch of 2^k registers has a relative standard error of about 1.04 / sqrt(2^k) and a fixed
size, so a new period costs one pass over its own rows, and any set of periods is counted by
uniting sketches.  The exact counts stay the default of the library.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 12


def relative_error(log_registers: int = LOG_REGISTERS) -> float:
    """Standard error of an estimate, relative to the count."""
    return 1.04 / math.sqrt(1 << log_registers)


def distinct_partials(
    df: DataFrame, period: Column, by: list[str], columns: list[str], log_registers: int = LOG_REGISTERS
) -> DataFrame:
    """(period, by..., one sketch per column); null values are not counted."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), log_registers).alias(c) for c in columns]
    return df.groupBy(period.alias("period"), *by).agg(*sketches)


def merged_distinct(partials: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by..., estimate per column) over all periods in ``partials``; filter them before."""
    united = partials.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in columns])
    return united.select(*by, *[F.hll_sketch_estimate(c).alias(c) for c in columns])
