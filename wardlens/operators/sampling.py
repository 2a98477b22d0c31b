"""Repeatable shuffles: folds, splits, class weights, small samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixed_values import LABEL
from ..functions import row_hash
from .skew import null_safe_join



def hash_chars(df: DataFrame) -> int:
    """Leading hex digits of the hash that cut it into a few ranges per shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 + (partitions.bit_length() + 3) // 4


def shuffled_numbers(
    df: DataFrame, ids: list[str], by: list[str] = (), seed: int = 42, name: str = "row_no", total: str = "n_group"
) -> DataFrame:
    """Number rows 1..n in hash order within each ``by`` group, and add n.

    The hash order depends on the ids only.  Rows are numbered inside ranges of the
    hash and shifted by the totals of the lower ranges, so a group of any size is
    spread over all partitions.  Rows with a null in ``by`` are a group like any other.
    """
    by = list(by)
    hashed = df.withColumn("_hash", row_hash(seed, *[F.col(c) for c in ids]))
    hashed = hashed.withColumn("_range", F.substring("_hash", 1, hash_chars(df)))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    below = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    per_range = hashed.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    offsets = per_range.select(
        *by,
        "_range",
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"),
        F.sum("_n").over(group).alias(total),
    )
    inside = W.partitionBy(*by, "_range").orderBy("_hash", *ids)
    return (
        null_safe_join(hashed, offsets, [*by, "_range"])
        .withColumn(name, F.col("_below") + F.row_number().over(inside))
        .drop("_hash", "_range", "_below")
    )


def stratified_folds(df: DataFrame, ids: list[str], k: int = 5, label: str = LABEL, seed: int = 42) -> DataFrame:
    """Add ``fold``: shuffled per label, fold sizes differ by at most one per label."""
    numbered = shuffled_numbers(df, ids, [label], seed)
    return numbered.withColumn("fold", F.pmod(F.col("row_no") - 1, F.lit(k))).drop("row_no", "n_group")


def stratified_split(
    df: DataFrame, ids: list[str], test_share: float = 0.2, label: str = LABEL, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: the first ``test_share`` of each label in hash order."""
    numbered = shuffled_numbers(df, ids, [label], seed)
    cut = F.floor(F.col("n_group") * F.lit(test_share) + 0.5)
    return numbered.withColumn("is_test", F.col("row_no") <= cut).drop("row_no", "n_group")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (2 * n_class), one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_class"))
    both = W.partitionBy(F.lit(0))
    return counts.withColumn("class_weight", F.sum("n_class").over(both) / (2.0 * F.col("n_class")))


def with_class_weight(df: DataFrame, label: str = LABEL, name: str = "class_weight") -> DataFrame:
    """Add the balanced weight of each row's class (two classes, so a map lookup)."""
    table = class_weights(df, label)
    lookup = table.agg(F.map_from_entries(F.collect_list(F.struct(label, "class_weight")))).scalar()
    return df.withColumn("_weights", lookup).withColumn(name, F.col("_weights")[F.col(label)]).drop("_weights")


def repeatable_head(df: DataFrame, ids: list[str], n: int, seed: int = 42) -> DataFrame:
    """A sample of n rows that is the same on every run (``limit`` alone is not)."""
    hashed = df.withColumn("_hash", row_hash(seed, *[F.col(c) for c in ids]))
    return hashed.orderBy("_hash", *ids).limit(n).drop("_hash")
