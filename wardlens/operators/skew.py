"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this many rows on.  At most |many| / HOT_ROWS keys can be hot,
# so the hot-key list stays small whatever the data: 10^12 rows give <= 10^6 keys.
HOT_ROWS = 1_000_000
SALTS = 64


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which a null key meets a null key; the keys appear once."""
    if not keys:
        raise ValueError("a join needs keys")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def key_counts(many: DataFrame, key: str, count: str = "n_rows") -> DataFrame:
    """Rows per key.  Partial counts form before the shuffle, so a hot key is cheap."""
    return many.groupBy(key).agg(F.count("*").alias(count))


def salted_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    count: str = "n_rows",
    hot_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join a many-side to a side that has one row per key.

    Rows of hot keys are spread over ``salts`` partitions and the one-side row of a
    hot key is repeated once per salt; all other keys carry salt 0 and join as usual.
    Rows without a key match nothing and are spread too.
    ``counts`` may pass the key counts when the caller has them already.
    """
    hot_rows = hot_rows or HOT_ROWS
    counts = counts if counts is not None else key_counts(many, key, count)
    hot = counts.filter(F.col(count) >= hot_rows).select(key, F.lit(True).alias("_hot"))
    others = [c for c in many.columns if c != key]
    spread = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    left = (
        many.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0)))
        .drop("_hot")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = (
        one.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot")
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")
