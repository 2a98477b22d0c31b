"""Null labels, NaN, constants and ties: no row is lost and no number is wrong."""

import math

import pytest
from pyspark.sql import functions as F

from wardlens.fixed_values import LABEL
from wardlens.functions.tails import doubled_upper_tail
from wardlens.operators import metrics, ordered, sampling, summaries
from wardlens.operators.skew import null_safe_join
from wardlens.sources import readers


@pytest.fixture(scope="module")
def part_labelled(spark):
    """100 rows, 25 of them without a label."""
    label = F.when(F.col("id") % 4 != 0, (F.col("id") % 3 == 0).cast("int"))
    return spark.range(100).select("id", label.alias(LABEL), (F.col("id") / 100).alias("score")).persist()


def test_folds_and_splits_keep_rows_without_a_label(part_labelled):
    folds = sampling.stratified_folds(part_labelled, ["id"], 5)
    assert folds.count() == 100
    sizes = [r["count"] for r in folds.filter(f"{LABEL} is null").groupBy("fold").count().collect()]
    assert sizes == [5] * 5
    split = sampling.stratified_split(part_labelled, ["id"])
    assert (split.count(), split.filter("is_test").count()) == (100, 20)


def test_groups_without_a_name_keep_their_totals(part_labelled):
    counts = ordered.value_counts(part_labelled, "score", [LABEL])
    got = ordered.running_totals(counts, "score", ["n"], [LABEL], ranges=5)
    assert {r[LABEL]: r["t"] for r in got.groupBy(LABEL).agg(F.max("total_n").alias("t")).collect()} == {None: 25, 0: 50, 1: 25}
    assert {r[LABEL]: r["m"] for r in got.groupBy(LABEL).agg(F.max("cum_n").alias("m")).collect()} == {None: 25, 0: 50, 1: 25}
    hist = summaries.histogram(part_labelled, ["score"], 5, [LABEL])
    assert hist.agg(F.sum("n")).first()[0] == 100


@pytest.mark.parametrize("ranges", [2, 4, 512, 2000])
def test_ranges_do_not_change_totals(spark, ranges):
    df = spark.range(3000).select((F.col("id") % 701).cast("double").alias("v"))
    counts = ordered.value_counts(df, "v")
    got = sorted((r["v"], r["cum_n"], r["total_n"]) for r in ordered.running_totals(counts, "v", ["n"], ranges=ranges).collect())
    running, expected = 0, []
    for v in range(701):
        running += len(range(v, 3000, 701))
        expected.append((float(v), running, 3000))
    assert got == expected


def test_edges_below_is_a_count(spark):
    edges = [1.0, 2.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 5.5, 10.0)], "v double").withColumn("e", F.array(*map(F.lit, edges)))
    got = df.select("v", ordered.edges_below(F.col("e"), F.col("v"), 6).alias("n")).collect()
    assert all(r["n"] == sum(e < r["v"] for e in edges) for r in got)


def test_calibration_counts_labelled_rows_alone(part_labelled):
    by_quantile = metrics.calibration_by_quantile(part_labelled).agg(F.sum("n")).first()[0]
    whole = metrics.calibration_by_decile(part_labelled).filter("row_type = 0").first()
    assert by_quantile == whole["n_patients"] == 75
    assert whole["mean_obs"] == pytest.approx(25 / 75)


def test_goodness_of_fit_with_certain_groups(spark):
    rows = [(0.0, 0)] * 10 + [(1.0, 1)] * 10 + [(0.5, i % 2) for i in range(10)]
    got = metrics.hosmer_lemeshow(spark.createDataFrame(rows, f"score double, {LABEL} int")).first()
    assert got["chi_square"] == pytest.approx(0.0)


def test_a_constant_group_gets_a_range_of_one(spark):
    got = summaries.histogram(spark.createDataFrame([(3.0,)] * 7, "v double"), ["v"], 4).collect()
    full = [r for r in got if r["n"]]
    assert len(got) == 4 and (full[0]["bin"], full[0]["n"], full[0]["density"]) == (2, 7, pytest.approx(4.0))
    assert (min(r["bin_from"] for r in got), max(r["bin_to"] for r in got)) == (2.5, 3.5)


def test_text_that_means_missing(spark):
    texts = ["1.5", "NaN", "nan", "n/a", None, "", "1e3"]
    df = spark.createDataFrame([(t, 1) for t in texts], f"age string, {LABEL} int")
    got = [r["age"] for r in readers.coerce_numeric(df).collect()]
    assert got == [1.5, None, None, None, None, None, 1000.0]
    doubles = spark.createDataFrame([(math.nan, 1), (2.0, 0)], f"age double, {LABEL} int")
    assert [r["age"] for r in readers.coerce_numeric(doubles).collect()] == [None, 2.0]


def test_rank_test_of_tied_samples(spark):
    tied = spark.createDataFrame([(1.0, i % 2) for i in range(10)], f"v double, {LABEL} int")
    got = summaries.mann_whitney(tied, ["v"]).first()
    assert (got["u"], got["z"]) == (12.5, None)
    assert doubled_upper_tail(-0.1) == 1.0 and doubled_upper_tail(1.959964) == pytest.approx(0.05, abs=1e-6)


def test_null_keys_meet(spark):
    a = spark.createDataFrame([(1, 1), (None, 2)], "k int, x int")
    b = spark.createDataFrame([(1, 3), (None, 4)], "k int, y int")
    assert sorted(map(str, null_safe_join(a, b, ["k"]).collect())) == ["Row(k=1, x=1, y=3)", "Row(k=None, x=2, y=4)"]
