"""Small numeric column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numeric_round(col: Column, digits: int) -> Column:
    """Round half away from zero on a decimal, then return DOUBLE.

    The value first becomes DECIMAL(38,12).  That removes the last-digit noise a
    floating sum picks up from the order of its inputs, so the rounded result does
    not depend on the partitioning.
    """
    return F.round(col.cast("decimal(38,12)"), digits).cast("double")


def clip(col: Column, low, high) -> Column:
    """Limit a column to [low, high]; null stays null (least/greatest skip nulls)."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(col.isNotNull(), F.greatest(F.least(col, high), low))


def as_long(flag: Column) -> Column:
    """Boolean to BIGINT 0/1."""
    return flag.cast("int").cast("bigint")


def row_hash(seed: int, *cols: Column) -> Column:
    """Hex digest that orders rows pseudo-randomly but repeatably.

    Depends on the values only, never on the partition a row sits in, so a lost
    executor that recomputes its rows draws the same order.
    """
    parts = [c.cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def unit_hash(seed: int, *cols: Column) -> Column:
    """The first 32 bits of ``row_hash`` as a DOUBLE in [0, 1)."""
    head = F.conv(F.substring(row_hash(seed, *cols), 1, 8), 16, 10).cast("double")
    return head / F.lit(float(2**32))
