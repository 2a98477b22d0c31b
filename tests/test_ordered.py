"""Order statistics, ranks, folds and salted joins against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlens.operators import ordered, sampling, skew


def frame(spark, seed=1, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one value holds a third of the rows
        a = 5.0 if rng.random() < 0.34 else round(rng.gauss(0, 3), 1)
        rows.append((i, rng.randint(0, 1), None if rng.random() < 0.1 else a, float(rng.randint(0, 9))))
    return rows, spark.createDataFrame(rows, "id bigint, label int, a double, b double")


def averaged(values, percent):
    xs = sorted(values)
    k, rest = divmod(len(xs) * int(round(percent * 100)), 10000)
    if rest == 0:
        return (xs[max(k, 1) - 1] + xs[min(k + 1, len(xs)) - 1]) / 2
    return xs[k]


@pytest.mark.parametrize("parts", [1, 7])
def test_quantiles(spark, parts):
    rows, df = frame(spark)
    percents = [0, 0.5, 1, 25, 50, 75, 99, 99.5, 100]
    for method in ["linear", "averaged"]:
        got = {r.feature: r for r in ordered.quantile_table(df.repartition(parts), ["a", "b"], percents, method).collect()}
        for col, at in [("a", 2), ("b", 3)]:
            xs = [r[at] for r in rows if r[at] is not None]
            assert got[col].n == len(xs)
            for p in percents:
                want = np.percentile(xs, p) if method == "linear" else averaged(xs, p)
                assert got[col][ordered.quantile_name(p)] == pytest.approx(want), (method, col, p)


def test_quantile_definitions_differ(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    assert ordered.quantile_table(df, ["x"], [25], "averaged").first().q25 == 1.5
    assert ordered.quantile_table(df, ["x"], [25]).first().q25 == 1.75
    with pytest.raises(ValueError):
        ordered.quantile_table(df, ["x"], [25], "other")


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_running_totals_do_not_depend_on_ranges(spark, ranges):
    rows, df = frame(spark)
    counts = ordered.value_counts(df, "a", ["label"])
    got = ordered.running_totals(counts, "a", ["n"], ["label"], ranges).collect()
    for label in (0, 1):
        c = Counter(r[2] for r in rows if r[1] == label and r[2] is not None)
        want, cum = {}, 0
        for v in sorted(c):
            cum += c[v]
            want[v] = (cum, sum(c.values()))
        assert {r.a: (r.cum_n, r.total_n) for r in got if r.label == label} == want


def test_average_ranks_and_rank_groups(spark):
    rows, df = frame(spark)
    xs = [r[2] for r in rows if r[2] is not None]
    ranks = {v: np.mean([i + 1 for i, x in enumerate(sorted(xs)) if x == v]) for v in set(xs)}
    got = {r.a: r.avg_rank for r in ordered.average_ranks(df, "a").collect()}
    assert got == pytest.approx(ranks)
    grouped = ordered.with_rank_group(df, "a", 10, "g").collect()
    assert len(grouped) == len(rows)
    for r in grouped:
        want = None if r.a is None else int(ranks[r.a] * 10 // (len(xs) + 1))
        assert r.g == want


def test_folds_and_split(spark):
    rows, df = frame(spark)
    folded = sampling.stratified_folds(df, ["id"], 5, "label").collect()
    sizes = defaultdict(Counter)
    for r in folded:
        sizes[r.label][r.fold] += 1
    for counts in sizes.values():
        assert len(counts) == 5 and max(counts.values()) - min(counts.values()) <= 1
    again = {r.id: r.fold for r in sampling.stratified_folds(df.repartition(7), ["id"], 5, "label").collect()}
    assert again == {r.id: r.fold for r in folded}
    split = sampling.stratified_split(df, ["id"], 0.2, "label").collect()
    for label in (0, 1):
        mine = [r.is_test for r in split if r.label == label]
        assert sum(mine) == int(len(mine) * 0.2 + 0.5)


def test_shuffled_numbers_are_a_permutation(spark):
    _, df = frame(spark)
    numbers = sorted(r.row_no for r in sampling.shuffled_numbers(df, ["id"]).collect())
    assert numbers == list(range(1, 601))


def test_class_weights(spark):
    _, df = frame(spark)
    total = sampling.with_class_weight(df, "label").agg(F.sum("class_weight")).first()[0]
    assert total == pytest.approx(600)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(3)
    many = [(None if i % 10 == 0 else (7 if i % 3 == 0 else rng.randint(0, 40)), i) for i in range(500)]
    left = spark.createDataFrame(many, "k int, v int")
    right = spark.createDataFrame([(k, f"r{k}") for k in range(0, 30)], "k int, w string")
    plain = left.join(right, "k", how).select("k", "v", "w")
    salted = skew.salted_join(left, right, "k", how, hot_rows=50, salts=8).select("k", "v", "w")
    key = lambda r: (r.v,)
    assert sorted(salted.collect(), key=key) == sorted(plain.collect(), key=key)
