"""Order statistics over a whole table without a one-task window.

A global running sum is built in three steps.  Rows are first reduced to one row
per distinct value, so a value that a third of all rows share costs one row.  The
distinct values are then cut into ranges of similar size; the range edges come from
an approximate quantile sketch and only balance the work.  Each range is summed on
its own and shifted by the exact totals of the ranges below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.materialize import written
from .skew import null_safe_join

SKETCH_PER_RANGE = 20  # the sketch may misplace an edge by a 20th of a range


def default_ranges(df: DataFrame) -> int:
    """One range per shuffle partition."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def edges_below(edges: Column, value: Column, ranges: int) -> Column:
    """How many of the sorted ``edges`` lie below a value, by binary search."""
    widths = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, ranges.bit_length())))])

    def step(low: Column, width: Column) -> Column:
        at = low + width
        return F.when((at <= F.size(edges)) & (F.get(edges, at - 1) < value), at).otherwise(low)

    return F.aggregate(widths, F.lit(0), step)


def value_counts(df: DataFrame, value: str, by: list[str] = (), sums: dict[str, Column] | None = None) -> DataFrame:
    """One row per distinct non-null value with its row count and further sums."""
    extra = [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"), *extra)


def long_values(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """(keep..., feature, value) with one row per non-null cell."""
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(list(keep), columns, "feature", "value")
    return long.filter(F.col("value").isNotNull())


def _in_ranges(counts: DataFrame, key: str, by: list[str], ranges: int | None = None) -> DataFrame:
    """``counts``, written, with the number of the range of ``key`` in ``_range``."""
    ranges = max(2, ranges or default_ranges(counts))
    counts = written(counts, "value_counts")  # read several times, and much smaller than the rows
    probs = [(i + 1) / ranges for i in range(ranges - 1)]
    edges = F.percentile_approx(key, probs, SKETCH_PER_RANGE * ranges).alias("_edges")
    if by:
        edged = null_safe_join(counts, counts.groupBy(*by).agg(edges), by)
    else:
        edged = counts.withColumn("_edges", counts.agg(edges).scalar())
    return edged.withColumn("_range", edges_below(F.col("_edges"), F.col(key), ranges)).drop("_edges")


def neighbours(counts: DataFrame, key: str, columns: list[str], ranges: int | None = None) -> DataFrame:
    """Add ``lower`` and ``higher``: structs of ``columns`` of the rows of next lower and higher ``key``.

    Null where there is no such row.  Neighbours are found inside ranges of the key; the first
    and last row of each range are carried to the ranges beside it.
    """
    ranged = _in_ranges(counts, key, [], ranges)
    own = F.struct(*columns)
    borders = ranged.groupBy("_range").agg(F.min_by(own, key).alias("_first"), F.max_by(own, key).alias("_last"))
    across = W.partitionBy(F.lit(0)).orderBy("_range")  # one row per range
    borders = borders.select("_range", F.lag("_last").over(across).alias("_below"), F.lead("_first").over(across).alias("_above"))
    inside = W.partitionBy("_range").orderBy(key)
    return (
        ranged.join(borders, "_range")
        .withColumns({
            "lower": F.coalesce(F.lag(own).over(inside), F.col("_below")),
            "higher": F.coalesce(F.lead(own).over(inside), F.col("_above")),
        })
        .drop("_range", "_below", "_above")
    )


def running_totals(
    counts: DataFrame, key: str, sums: list[str], by: list[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add ``cum_<s>`` (up to and including ``key``) and ``total_<s>`` for each sum.

    ``counts`` has one row per (by, key).  Null is a group of its own.  Edge and offset
    tables hold one row per group and range; how they are joined is left to their size.
    """
    by = list(by)
    ranged = _in_ranges(counts, key, by, ranges)

    per_range = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    below = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{s}").over(below), F.lit(0)).alias(f"_below_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(group).alias(f"total_{s}") for s in sums],
    )
    inside = W.partitionBy(*by, "_range").orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    return (
        null_safe_join(ranged, offsets, [*by, "_range"])
        .withColumns({f"cum_{s}": F.col(f"_below_{s}") + F.sum(s).over(inside) for s in sums})
        .drop("_range", *[f"_below_{s}" for s in sums])
    )


# --- ranks -------------------------------------------------------------------------
def average_ranks(df: DataFrame, value: str, by: list[str] = (), sums: dict[str, Column] | None = None) -> DataFrame:
    """Per distinct value: count, total and the average rank its ties share."""
    names = ["n", *(sums or {})]
    totals = running_totals(value_counts(df, value, by, sums), value, names, by)
    return totals.withColumn("avg_rank", F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0)


def rank_group(groups: int) -> Column:
    """Ties share a group; groups are numbered from 0."""
    return F.floor(F.col("avg_rank") * groups / (F.col("total_n") + 1)).cast("bigint")


def with_rank_group(df: DataFrame, value: str, groups: int = 10, name: str = "rank_group") -> DataFrame:
    """Add each row's rank group.

    The group is a step function of the value, so rows need only the lowest value of
    each group (at most ``groups`` of them), not a join to the ranked values.
    """
    steps = (
        average_ranks(df, value)
        .withColumn("_g", rank_group(groups))
        .groupBy("_g")
        .agg(F.min(value).alias("_from"))
        .agg(F.sort_array(F.collect_list(F.struct("_from", "_g"))))
    )
    reached = F.filter("_steps", lambda s: s["_from"] <= F.col(value))
    return (
        df.withColumn("_steps", steps.scalar())
        .withColumn(name, F.when(F.col(value).isNotNull(), F.element_at(reached, -1)["_g"]))
        .drop("_steps")
    )


# --- quantiles ------------------------------------------------------------------------
def quantile_name(percent: float) -> str:
    return "q" + f"{percent:g}".replace(".", "_")


def _linear(percent: float) -> Column:
    """Linear interpolation between order statistics."""
    at = (F.max("total_n") - 1) * F.lit(percent / 100.0)
    row_at = (F.col("total_n") - 1) * F.lit(percent / 100.0)
    low = F.min(F.when(F.col("cum_n") > F.floor(row_at), F.col("value")))
    high = F.min(F.when(F.col("cum_n") > F.floor(row_at) + 1, F.col("value")))
    return low + (F.coalesce(high, low) - low) * (at - F.floor(at))


def _averaged_steps(percent: float) -> Column:
    """Inverse distribution function, averaged where n*p is whole (definition 5).

    n*p is kept in whole units of 1/100 percent, so the test for "whole" is exact.
    """
    units = int(round(percent * 100))
    step = F.col("total_n") * units
    j = F.floor(step / 10000.0)
    low = F.min(F.when(F.col("cum_n") >= F.greatest(j, F.lit(1)), F.col("value")))
    high = F.min(F.when(F.col("cum_n") >= F.least(j + 1, F.col("total_n")), F.col("value")))
    whole = (F.max("total_n") * units) % 10000 == 0
    return F.when(whole, (low + high) / 2.0).otherwise(high)


def quantiles_of_totals(totals: DataFrame, percents: list[float], method: str, by: list[str]) -> DataFrame:
    """n and ``q<percent>`` columns per group of ``running_totals`` over ``value``."""
    rules = {"linear": _linear, "averaged": _averaged_steps}
    if method not in rules:
        raise ValueError(f"unknown quantile method: {method!r}")
    return totals.groupBy(*by).agg(
        F.max("total_n").alias("n"), *[rules[method](p).alias(quantile_name(p)) for p in percents]
    )


def quantile_table(
    df: DataFrame, columns: list[str], percents: list[float], method: str = "linear", by: list[str] = ()
) -> DataFrame:
    """Exact quantiles, one row per (by, feature): n and ``q<percent>`` columns.

    All columns share one pass.  ``method`` is ``linear`` or ``averaged``.
    """
    group = [*by, "feature"]
    counts = value_counts(long_values(df, columns, by), "value", group)
    return quantiles_of_totals(running_totals(counts, "value", ["n"], group), percents, method, group)


def as_fields(table: DataFrame, features: list[str], key: str = "feature") -> Column:
    """A small keyed table as one struct value with a field per feature, null where it has no row.

    A field is found by its place; looking up a map by name for every bound of every row cost
    more than all else that was done to the row.
    """
    rest = F.struct(*[c for c in table.columns if c != key])
    fields = [F.first(F.when(F.col(key) == f, rest), ignorenulls=True).alias(f) for f in features]
    return table.agg(F.struct(*fields)).scalar()
