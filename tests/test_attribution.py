"""Exact tree contributions, keyed permutations, thinned curves, exact rank test, sketches."""

import json
from itertools import combinations
from math import comb, factorial

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wardlens import fixed_values as fv
from wardlens.functions import tails
from wardlens.ml import attribution, models, newton, shapley, trees
from wardlens.operators import metrics, ordered, sketches, summaries


def ensemble(kind, n_trees=4):
    rng = np.random.default_rng(7)
    bins = rng.integers(0, 12, (200, 5)).astype(np.uint8)
    label = (rng.random(200) < 1 / (1 + np.exp(2 - bins[:, 0] / 3 - (bins[:, 1] > 6)))).astype(np.uint8)
    record = {"bins": bins.tobytes(), "label": label.tobytes(), "fold": np.zeros(200, np.int8).tobytes(), "key": np.arange(200).tobytes()}
    spec = {"forest": trees.TreeSpec("forest", n_trees, 4, 5, node_features=3), "boost": trees.TreeSpec("boost", n_trees, 3, 1)}[kind]
    edges, bin_map = np.tile(np.arange(trees.MAX_BINS) + 0.5, (5, 1)), np.tile(np.arange(256), (5, 1)).astype(np.uint8)
    fit = trees.Fit((kind, -1), spec, -1, bin_map, edges, (1.0, 1.0), -0.2)
    rows = trees.BlockRows(record, fit)
    grown = []
    for i in range(n_trees):
        grown.append(trees.grow_in_block(rows, i))
        if kind == "boost":
            rows.add(grown[-1])
    return trees.TreeEnsembleModel.of(fit, grown, models.VECTOR), bins[:30].astype(float)


def value_of(nodes, at, x, known):
    f = nodes["feature"][at]
    if f < 0:
        return nodes["value"][at]
    left = nodes["left"][at]
    if f in known:
        return value_of(nodes, left + (x[f] > nodes["threshold"][at]), x, known)
    return sum(nodes["cover"][c] / nodes["cover"][at] * value_of(nodes, c, x, known) for c in (left, left + 1))


@pytest.mark.parametrize("kind", ["forest", "boost"])
def test_contributions_are_the_sum_over_subsets(kind):
    model, x = ensemble(kind)
    nodes, paths = model.nodes(), shapley.leaf_paths(model.nodes())
    got = shapley.contributions(x, paths)
    total = lambda row, known: sum(value_of(nodes, r, row, known) for r in nodes["roots"])
    for row, phi in zip(x[:8], got):
        for f in range(5):
            rest = [k for k in range(5) if k != f]
            want = sum(
                factorial(s) * factorial(4 - s) / factorial(5) * (total(row, {*c, f}) - total(row, set(c)))
                for s in range(5) for c in combinations(rest, s)
            )
            assert phi[f] == pytest.approx(want, abs=1e-10)
    assert shapley.base_value(paths) == pytest.approx(total(x[0], set()))
    assert got.sum(axis=1) + shapley.base_value(paths) == pytest.approx(trees.raw_scores(x, nodes), abs=1e-9)


@pytest.mark.parametrize("kind", ["forest", "boost"])
def test_contributions_add_up_to_the_score(spark, kind):
    model, x = ensemble(kind, 12)
    rows = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["icustay_id", models.VECTOR])
    found = shapley.tree_contributions(model, rows, list("abcde"), ["icustay_id"])
    scores = {r.icustay_id: r[models.PROBABILITY] for r in models.event_probability(model, rows).collect()}
    for r in found.collect():
        total = r.base_value + sum(e.contribution for e in r.contributions)
        p = scores[r.icustay_id]
        assert total == pytest.approx(p if kind == "forest" else np.log(p / (1 - p)), abs=1e-9)
        assert [e.feature for e in r.contributions] == list("abcde")


def test_permutations_are_permutations_and_differ(spark):
    for n in (1, 2, 7, 100):
        rows = spark.range(n).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5))))
        got = rows.select("id", "k", attribution.permuted(F.col("id"), F.lit(n).cast("bigint"), F.xxhash64("k")).alias("p")).collect()
        orders = {}
        for r in sorted(got):
            orders.setdefault(r.k, []).append(r.p)
        assert all(sorted(o) == list(range(n)) for o in orders.values())
        if n == 100:
            assert len({tuple(o) for o in orders.values()}) == 6
            steps = {(b - a) % n for o in orders.values() for a, b in zip(o, o[1:])}
            assert len(steps) > 50  # no rotation of one order
            assert np.corrcoef(orders[0], range(n))[0, 1] == pytest.approx(0, abs=0.35)


def test_thinned_curve_has_no_straight_points_and_the_same_area(spark):
    rng = np.random.default_rng(1)
    rows = [(float(s), int(rng.random() < 0.3 + s / 100)) for s in rng.integers(0, 60, 400)]
    rows += [(200.0 + i, 1) for i in range(9)] + [(300.0 + i // 2, i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "score double, adverse_event int").repartition(5)
    totals = metrics.score_totals(df)
    every = sorted((r.fp, r.tp) for r in metrics.roc_points(totals).collect())
    kept = sorted((r.fp, r.tp) for r in metrics.bending_roc_points(totals).collect())
    want = [every[0], every[1]]
    for a, b, c in zip(every[1:], every[2:], every[3:]):
        if (b[0] - a[0], b[1] - a[1]) != (c[0] - b[0], c[1] - b[1]):
            want.append(b)
    assert kept == sorted({*want, every[-1]}) and len(kept) < len(every) - 8
    area = lambda p: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(p, p[1:]))
    assert area(kept) == pytest.approx(area(every))


@pytest.mark.parametrize("ranges", [2, 3, 50])
def test_neighbours_across_ranges(spark, ranges):
    keys = sorted({int(v) for v in np.random.default_rng(2).integers(0, 500, 80)})
    df = spark.createDataFrame([(k, k * 2) for k in keys], "k int, v int").repartition(4)
    got = {r.k: (r.lower and r.lower.v, r.higher and r.higher.v) for r in ordered.neighbours(df, "k", ["v"], ranges).collect()}
    assert got == {k: (2 * a if a is not None else None, 2 * b if b is not None else None) for a, k, b in zip([None, *keys], keys, [*keys[1:], None])}
    assert ordered.neighbours(df.filter("k < 0"), "k", ["v"]).collect() == []


def test_exact_rank_test_is_enumeration(spark):
    for n, m in ((1, 1), (3, 4), (5, 6), (8, 3)):
        us = [sum(r - i for i, r in enumerate(c)) for c in combinations(range(n + m), n)]
        for u in range(n * m + 1):
            assert tails.rank_sum_tail(u, n, m) == pytest.approx(sum(v >= u for v in us) / comb(n + m, n))
    df = spark.createDataFrame([(float(v), y) for v, y in [(1, 0), (2, 0), (4, 0), (3, 1), (5, 1), (6, 1), (7, 1)]], "v double, adverse_event int")
    r = summaries.mann_whitney(df, ["v"], ties=True).withColumn("p", tails.two_sided_rank_p("u", "n_no_event", "n_event", "z", "n_tied")).first()
    assert r.u == 1.0 and r.n_tied == 0 and r.p == pytest.approx(2 * 2 / comb(7, 3))
    assert tails.rank_test_p(1.0, 3, 4, r.z, 1) == pytest.approx(tails.doubled_upper_tail(r.z))
    assert tails.rank_test_p(5000 * 4.0, 8, 5000, 0.0, 0) == 1.0
    assert tails.rank_test_p(0.0, 0, 4, None, 0) is None


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("month"), (F.col("id") % 2).alias("g"), (F.col("id") * 7 % 20_000).cast("string").alias("v"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).alias("w"),
    )
    partials = sketches.distinct_partials(df, F.col("month"), ["g"], ["v", "w"])
    exact = {r.g: (r.v, r.w) for r in df.groupBy("g").agg(F.count_distinct("v").alias("v"), F.count_distinct("w").alias("w")).collect()}
    for r in sketches.merged_distinct(partials, ["g"], ["v", "w"]).collect():
        assert r.v == pytest.approx(exact[r.g][0], rel=4 * sketches.relative_error())
        assert r.w == exact[r.g][1]
    some = partials.filter("month < 3")
    want = {r.g: r.v for r in df.filter("month < 3").groupBy("g").agg(F.count_distinct("v").alias("v")).collect()}
    assert {r.g: r.v for r in sketches.merged_distinct(some, ["g"], ["v"]).collect()} == pytest.approx(want, rel=4 * sketches.relative_error())


def test_long_paths_without_a_table_of_patterns(monkeypatch):
    rng = np.random.default_rng(2)
    leaves, width, k = 30, 4, 6
    paths = {
        "value": rng.random(leaves), "width": rng.integers(0, width + 1, leaves),
        "feature": np.array([rng.permutation(k)[:width] for _ in range(leaves)]),
        "low": rng.normal(size=(leaves, width)) - 1, "high": rng.normal(size=(leaves, width)) + 1, "share": rng.random((leaves, width)),
    }
    paths["share"][rng.random((leaves, width)) < 0.1] = 0.0
    x = rng.normal(size=(70, k))
    table = shapley.contributions(x, paths)
    monkeypatch.setattr(shapley, "TABLE_WIDTH", 1)
    assert np.allclose(shapley.contributions(x, paths), table, atol=1e-12)


def test_contributions_of_one_file_are_many_tasks(spark):
    nodes = {"feature": [0, -1, -1], "threshold": [0.5, 0.0, 0.0], "left": [1, -1, -1], "value": [0.3, 0.1, 0.7], "cover": [4.0, 2.0, 2.0],
             "gain": [1.0, 0.0, 0.0], "roots": [0], "features": 1, "boosted": False, "start": 0.0}
    model = trees.TreeEnsembleModel()
    model._set(featuresCol="features", ensemble=json.dumps(nodes))
    rows = spark.range(100).select(F.col("id").alias("icustay_id"), array_to_vector(F.array(F.col("id") % 2 * 1.0)).alias("features")).coalesce(1)
    found = shapley.tree_contributions(model, rows, ["a"], ["icustay_id"])
    assert found.select(F.spark_partition_id()).distinct().count() > 1
    got = {(r["icustay_id"] % 2, round(r["contributions"][0]["contribution"], 9)) for r in found.collect()}
    assert got == {(0, -0.3), (1, 0.3)}


def test_rows_times_features_are_not_broadcast(spark, monkeypatch):
    """The planner takes exploded rows for as few as the file holds; only the rows may be a hashed side."""
    model = newton.LinearProbabilityModel()
    model._set(featuresCol="features", slopes=[1.5, -0.5], offset=0.25)
    rows = spark.range(60).select(F.col("id").alias("icustay_id"), (F.col("id") % 3 == 2).cast("int").alias("adverse_event"),
                                  array_to_vector(F.array(F.col("id") % 3 * 1.0, F.col("id") % 5 * 1.0)).alias("features"))
    seen, real = [], metrics.score_totals
    monkeypatch.setattr(metrics, "score_totals", lambda df, **rest: (seen.append(df), real(df, **rest))[1])
    found = {r["feature"]: r["importance"] for r in attribution.permutation_importance(model, rows, ["a", "b"], ["icustay_id"], 3).collect()}
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("ShuffledHashJoin") == 2
    assert found["a"] > 0.2 > abs(found["b"])
    p = model.transform(rows).select("icustay_id", vector_to_array("probability")[1].alias("p")).collect()
    eta = {r["icustay_id"]: 0.25 + r["icustay_id"] % 3 * 1.5 - r["icustay_id"] % 5 * 0.5 for r in p}
    assert all(abs(r["p"] - 1 / (1 + np.exp(-eta[r["icustay_id"]]))) < 1e-12 for r in p)


def test_contributions_by_ranks_are_those_by_values():
    model, x = ensemble("forest")
    paths = shapley.leaf_paths(model.nodes())
    x[0, 0], x[1, 1], x[2, 2] = np.nan, np.inf, -np.inf
    x[3], x[4] = model.nodes()["threshold"].max(), 0.5  # on cut points
    paths["low"][0, 0], paths["high"][0, 0] = 9.0, 1.0  # holds nothing
    want = sum(
        shapley._plain_contributions(x, paths, np.flatnonzero(paths["width"] == w), w) for w in np.unique(paths["width"]) if w
    )
    assert shapley.contributions(x, paths) == pytest.approx(want.T, abs=1e-12)
    ranks, first, last = shapley._ranks(np.ascontiguousarray(x.T), paths)
    for leaf, j in np.ndindex(*paths["low"].shape):
        f = paths["feature"][leaf, j]
        inside = (x[:, f] > paths["low"][leaf, j]) & (x[:, f] <= paths["high"][leaf, j])
        assert ((ranks[f] >= first[leaf, j]) & (ranks[f] <= last[leaf, j])).tolist() == inside.tolist()


def test_forest_explanations_fit_no_logistic_model(monkeypatch, tmp_path, spark):
    from wardlens.plans import queries_models as q

    fitted, model = [], ensemble("forest")[0]
    rows = spark.createDataFrame([(1, Vectors.dense([1.0] * 5))], ["icustay_id", models.VECTOR])
    kept = type("Kept", (), {"pipeline": type("Stages", (), {"stages": [model]})})
    monkeypatch.setattr(q, "_fits", lambda spark, sf, names: fitted.extend(names) or {n: kept for n in names})
    monkeypatch.setattr(q, "_test_rows", lambda spark, sf: rows)
    monkeypatch.setattr(q.st, "MODEL_COLUMNS", list("abcde"))
    q._forest_contributions(spark, str(tmp_path))
    assert fitted == ["random_forest"]


def linear_and_forest():
    linear = newton.LinearProbabilityModel()
    linear._set(featuresCol=models.VECTOR, slopes=[0.4, -0.2, 0.0, 0.9, 0.1], offset=-3.0)
    return {"linear": linear, "forest": ensemble("forest")[0]}


@pytest.mark.parametrize("kind", ["linear", "forest"])
@pytest.mark.parametrize("draws", [1, 4])
def test_sampled_contributions_in_arrays_are_those_of_scored_tables(spark, kind, draws):
    """Also of rows whose ids repeat or are null; a scored table is what a classifier without ``scorer`` gets."""
    classifier, x = linear_and_forest()[kind], ensemble("forest")[1]
    ids = [None if i % 7 == 3 else i // 2 for i in range(len(x))]
    rows = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in zip(ids, x)], ["icustay_id", models.VECTOR])
    background = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], rows.columns)
    plain = type("Plain", (), {"transform": staticmethod(classifier.transform)})()
    assert not hasattr(plain, "scorer")
    found, want = (attribution.sampled_shapley(c, rows, list("abcde"), ["icustay_id"], draws, background) for c in (classifier, plain))
    assert "MapInArrow" in found._jdf.queryExecution().toString() and found.schema == want.schema
    got, told = ({(r.icustay_id, r.feature): (r.contribution, r.std_error) for r in f.collect()} for f in (found, want))
    assert set(got) == set(told) and len(got) == 5 * len(set(ids))
    for key, (value, error) in told.items():
        assert got[key][0] == pytest.approx(value, abs=1e-12)
        assert got[key][1] is None if draws == 1 else got[key][1] == pytest.approx(error, abs=1e-12)


@pytest.mark.parametrize("kind", ["linear", "forest"])
def test_importance_in_tasks_is_that_of_joins(spark, monkeypatch, kind):
    classifier, x = linear_and_forest()[kind], np.tile(ensemble("forest")[1], (4, 1))
    labels = [None if i % 11 == 5 else int(r[0] + i % 5 > 8) for i, r in enumerate(x)]
    schema = ["icustay_id", fv.LABEL, models.VECTOR]
    rows = spark.createDataFrame([(i, y, Vectors.dense(r)) for i, (y, r) in enumerate(zip(labels, x))], schema)
    args = (rows, list("abcde"), ["icustay_id"], 3)
    joins, called = attribution._auc_by_joins, []
    monkeypatch.setattr(attribution, "_auc_by_joins", lambda *a: called.append(1) or joins(*a))
    monkeypatch.setattr(attribution, "PACKED_ROWS", 30)
    monkeypatch.setattr(attribution, "JOINED_ROWS", 0)
    got = {r.feature: r[1:] for r in attribution.permutation_importance(classifier, *args).collect()}
    assert not called
    monkeypatch.setattr(attribution, "TABLE_BYTES", 0)
    want = {r.feature: r[1:] for r in attribution.permutation_importance(classifier, *args).collect()}
    assert called and set(got) == set("abcde")
    for f in want:
        assert tuple(got[f]) == pytest.approx(tuple(want[f]), abs=1e-12)


def test_permutation_is_the_one_of_single_numbers(spark):
    for n in (1, 7, 40_000):
        key = spark.range(1).select(F.xxhash64(F.lit(42), F.lit(3), F.lit(-1)).alias("k")).first().k
        h = np.array([42], np.uint64)
        for v in (42, 3, -1):
            h = attribution._hashed(v, h)
        assert h.view(np.int64)[0] == key
        want = spark.range(n).select(attribution.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(key)).alias("p")).collect()
        assert sorted(r.p for r in want) == list(range(n))
        assert attribution.permutation(n, h[0]).tolist() == [r.p for r in want]


def test_area_of_no_rows_or_one_class_is_unknown():
    assert attribution.auc(np.array([]), np.array([])) is None
    assert attribution.auc(np.array([0.1, 0.2]), np.array([1, 1])) is None
    assert attribution.auc(np.array([0.3, 0.3, 0.1]), np.array([1, 0, 0])) == 0.75


def test_scores_of_arrays_are_those_of_tables_to_the_last_bit(spark):
    rng = np.random.default_rng(3)
    near = np.concatenate([np.nextafter(v, [-9, 9]) for v in (np.log(2) / 2, -np.log(2) / 2, 1.5 * np.log(2), 2.0**-28)])
    x = np.concatenate([rng.normal(0, 1, 4000), rng.normal(0, 40, 2000), rng.normal(0, 1e-8, 500), near, [0.0, -0.0, 709.7, 710, -745, -746, np.inf, -np.inf, np.nan]])
    told = np.array([r[0] for r in spark.createDataFrame([(float(v),) for v in x], "v double").coalesce(1).select(F.exp("v")).collect()])
    assert newton.strict_exp(x).tobytes() == told.tobytes()
    model = linear_and_forest()["linear"]
    rows = rng.normal(0, 3, (3000, 5))
    table = spark.createDataFrame([(Vectors.dense(r),) for r in rows], [models.VECTOR]).coalesce(1)
    told = np.array([r[models.PROBABILITY] for r in models.event_probability(model, table).collect()])
    assert (model.scorer()(list(rows.T)) == told).all()
