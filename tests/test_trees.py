"""Tree ensembles against a plain recursive version, and one block against many."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wardlens import fixed_values as fv
from wardlens.ml import models, trees
from wardlens.ml.stages import MODEL_COLUMNS

K = 5
SPECS = {
    "forest": trees.TreeSpec("forest", trees=3, depth=4, min_leaf=4, node_features=2, balanced=True),
    "extra": trees.TreeSpec("extra", trees=3, depth=4, min_leaf=4, node_features=3),
    "boost": trees.TreeSpec("boost", trees=4, depth=3, min_leaf=1, row_share=0.8, rate=0.1),
    "second": trees.TreeSpec("boost", trees=4, depth=4, min_leaf=3, second_order=True, l2=1.0, min_hessian=0.5,
                             tree_features=0.6, rate=0.3, event_weight=3.0),
    "leaves": trees.TreeSpec("boost", trees=3, depth=5, min_leaf=2, second_order=True, rate=0.3, max_leaves=6),
}


def data(n=300, seed=3):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 20, (n, K)).astype(np.uint8)
    bins[:, 3] = rng.integers(0, 2, n)
    label = (rng.random(n) < 1 / (1 + np.exp(3 - bins[:, 0] / 5 - 2 * bins[:, 3]))).astype(np.uint8)
    return bins, label, rng.integers(0, 4, n).astype(np.int8), rng.integers(0, 1 << 62, n)


def record(bins, label, fold, key):
    return {"bins": bins.tobytes(), "label": label.tobytes(), "fold": fold.tobytes(), "key": key.tobytes()}


def fit_of(name, fold=1):
    edges = np.tile(np.arange(trees.MAX_BINS) * 1.5, (K, 1))
    bin_map = np.tile(np.arange(256), (K, 1)).clip(2, 17).astype(np.uint8)  # as clipping does
    return trees.Fit((name, fold), SPECS[name], fold, bin_map, edges, (0.8, 1.4) if name != "boost" else (1.0, 1.0), -0.3)


# --- plain version: sets of rows and loops ------------------------------------------------------
def plain_tree(fit, number, x, label, key, score):
    spec = fit.spec
    u = lambda k, salt: float(trees.uniform(np.array([k], np.uint64), spec.seed, fit.number, number, salt)[0])
    weight = [fit.weights[y] for y in label]
    unit = trees.UNIT
    if spec.kind == "boost":
        p = [1 / (1 + math.exp(-s)) for s in score]
        rows = [i for i in range(len(x)) if spec.row_share == 1 or u(key[i], 4) < spec.row_share]
        g = [round(weight[i] * (label[i] - p[i]) * unit) / unit for i in range(len(x))]
        h = [round(weight[i] * p[i] * (1 - p[i]) * unit) / unit for i in range(len(x))]
        times = [1] * len(x)
    else:
        times = [1] * len(x)
        if spec.kind == "forest":
            pmf = [math.exp(-1) / math.factorial(i) for i in range(12)]
            times = [sum(u(k, 4) > sum(pmf[: j + 1]) for j in range(12)) for k in key]
        rows = [i for i in range(len(x)) if times[i]]
    usable = list(range(K))
    if spec.tree_features < 1:
        usable = sorted(sorted(usable, key=lambda f: u(f, 1))[: round(spec.tree_features * K)])

    def score_of(part):
        if spec.kind != "boost":
            w = [sum(times[i] * weight[i] for i in part if label[i] == c) for c in (0, 1)]
            return (w[0] ** 2 + w[1] ** 2) / sum(w)
        return sum(g[i] for i in part) ** 2 / (sum(h[i] for i in part) + spec.l2)

    def gain(left, right):
        if spec.kind == "boost" and not spec.second_order:
            mean = [sum(g[i] for i in part) / len(part) for part in (left, right)]
            return len(left) * len(right) / len(left + right) * (mean[0] - mean[1]) ** 2
        return score_of(left) + score_of(right) - score_of(left + right)

    def best_split(node, part):
        looked = usable
        if spec.node_features is not None:
            looked = sorted(sorted(usable, key=lambda f: u(node * 65536 + f, 2))[: spec.node_features])
        found = None
        for f in looked:
            values = sorted({int(x[i, f]) for i in part})
            cuts = values[:-1]
            if spec.kind == "extra":
                low, high = fit.edges[f, values[0]], fit.edges[f, values[-1]]
                at = low + u(node * 65536 + f, 3) * (high - low)
                cuts = [max(b for b in range(trees.MAX_BINS) if fit.edges[f, b] <= at)] if len(values) > 1 else []
            for cut in cuts:
                left, right = [i for i in part if x[i, f] <= cut], [i for i in part if x[i, f] > cut]
                if min(len(left), len(right)) < max(1, spec.min_leaf):
                    continue
                if spec.second_order and min(sum(h[i] for i in left), sum(h[i] for i in right)) < spec.min_hessian:
                    continue
                v = gain(left, right)
                if v > 1e-12 and (found is None or v > found[0] + 1e-12):
                    found = (v, f, cut, left, right)
        return found

    nodes = {0: rows}
    out, level, n = {}, [0], 1
    for depth in range(spec.depth + 1):
        following = []
        for node in level:
            part = nodes[node]
            if spec.kind == "boost":
                value = spec.rate * sum(g[i] for i in part) / (sum(h[i] for i in part) + spec.l2)
            else:
                w = [sum(times[i] * weight[i] for i in part if label[i] == c) for c in (0, 1)]
                value = w[1] / sum(w)
            split = best_split(node, part) if depth < spec.depth else None
            out[node] = (value, split and split[:3], n)
            if split:
                nodes[n], nodes[n + 1] = split[3:]
                following += [n, n + 1]
                n += 2
        level = following
    if spec.max_leaves:
        leaves, kept = [0], set()
        while len(leaves) < spec.max_leaves:
            able = [v for v in leaves if out[v][1]]
            if not able:
                break
            best = max(able, key=lambda v: out[v][1][0])
            kept.add(best)
            leaves.remove(best)
            leaves += [out[best][2], out[best][2] + 1]
        out = {v: (value, split if v in kept else None, left) for v, (value, split, left) in out.items()}
    return out


def plain_leaf(tree, row):
    node = 0
    while tree[node][1]:
        _, f, cut = tree[node][1]
        node = tree[node][2] + int(row[f] > cut)
    return node


@pytest.mark.parametrize("name", SPECS)
def test_ensemble_is_the_plain_version_tree_by_tree(name):
    bins, label, fold, key = data()
    fit = fit_of(name)
    rows = trees.BlockRows(record(bins, label, fold, key), fit)
    inside = fold != 1
    x, label, key = bins[inside].clip(2, 17), label[inside].astype(int), key[inside]
    score = [-0.3] * len(x)
    for number in range(fit.spec.trees):
        got, want = trees.grow_in_block(rows, number), plain_tree(fit, number, x, label, key, score)
        assert len(got.feature) == len(want)
        for node, (value, split, left) in want.items():
            assert got.value[node] == pytest.approx(value, abs=1e-12)
            if split:
                assert (got.feature[node], got.cut[node], got.left[node]) == (split[1], split[2], left)
                assert got.gain[node] == pytest.approx(split[0], abs=1e-9)
            else:
                assert got.feature[node] == -1
        leaves = [plain_leaf(want, r) for r in x]
        assert got.leaf_of(x).tolist() == leaves
        if fit.spec.kind == "boost":
            rows.add(got)
            score = [s + want[v][0] for s, v in zip(score, leaves)]


def test_many_blocks_grow_the_trees_of_one(spark, monkeypatch):
    monkeypatch.setattr(trees, "LEVEL_TREES", 4)
    monkeypatch.setattr(trees, "SETTLE_TREES", 2)
    bins, label, fold, key = data()
    rows = [tuple(record(*(a[i : i + 70] for a in (bins, label, fold, key))).values()) for i in range(0, 300, 70)]
    schema = "bins binary, label binary, fold binary, key binary"
    many = spark.createDataFrame([tuple(map(bytearray, r)) for r in rows], schema).repartition(3)
    one = spark.createDataFrame([tuple(map(bytearray, record(bins, label, fold, key).values()))], schema)
    fits = [fit_of(name, fold) for name in SPECS for fold in (-1, 2)]
    grown = [trees.grow(blocks, n, fits) for blocks, n in ((many, len(rows)), (one, 1))]
    for fit in fits:
        a, b = ([t.to_dict() for t in g[fit.key]] for g in grown)
        assert a == b and len(a) == fit.spec.trees


def test_cover_and_split_of_equal_rows():
    bins = np.zeros((10, K), np.uint8)
    rows = trees.BlockRows(record(bins, np.arange(10).astype(np.uint8) % 2, np.zeros(10, np.int8), np.arange(10)), fit_of("extra", -1))
    tree = trees.grow_in_block(rows, 0)
    assert tree.feature == [-1] and tree.value[0] == pytest.approx(5 * 1.4 / (5 * 0.8 + 5 * 1.4))


@pytest.fixture(scope="module")
def fitted(spark, matrix):
    prep = models.fit_preprocessing(matrix)
    rows = models.training_rows(matrix.withColumn("fold", F.lit(models.ALL_ROWS)), ["icustay_id"], prep.stages[0], MODEL_COLUMNS)
    specs = {n: c.trees for n, c in models.model_configs(trees=6, boosters=True).items() if c.trees}
    return prep, models.fit_ensembles(rows, specs, {models.ALL_ROWS: prep}, MODEL_COLUMNS)


def test_bins_and_vectors_reach_the_same_leaves(spark, matrix, fitted):
    """Scoring the prepared vectors is routing the bins: every row lands where it was counted."""
    prep, ensembles = fitted
    vectors = prep.transform(matrix).select("icustay_id", fv.LABEL, models.VECTOR).persist()
    n, events = matrix.count(), matrix.filter(F.col(fv.LABEL) == 1).count()
    for (name, _), model in ensembles.items():
        nodes = model.nodes()
        x = np.array([r[0].toArray() for r in vectors.select(models.VECTOR).collect()])
        leaves = []
        for root in nodes["roots"]:
            at = np.full(len(x), root)
            while (nodes["feature"][at] >= 0).any():
                f = nodes["feature"][at]
                at = np.where(f >= 0, nodes["left"][at] + (x[np.arange(len(x)), np.maximum(f, 0)] > nodes["threshold"][at]), at)
            leaves.append(at)
        if name == "extra_trees":  # all rows: covers are sums of class weights
            label = np.array([r[0] for r in vectors.select(fv.LABEL).collect()])
            w = np.where(label == 1, n / (2 * events), n / (2 * (n - events)))
            for at in leaves:
                for leaf in np.unique(at):
                    assert nodes["cover"][leaf] == pytest.approx(w[at == leaf].sum())
                    assert nodes["value"][leaf] == pytest.approx(w[(at == leaf) & (label == 1)].sum() / w[at == leaf].sum())
        p = [r[0] for r in models.event_probability(model, vectors).select(models.PROBABILITY).collect()]
        assert p == pytest.approx(trees.ensemble_probability(x, nodes).tolist())
    vectors.unpersist()


def test_saved_ensemble_scores_alike(spark, matrix, fitted, tmp_path):
    prep, ensembles = fitted
    pipeline = PipelineModel(stages=[*prep.stages, ensembles["gradient_boosting", models.ALL_ROWS]])
    pipeline.write().overwrite().save(str(tmp_path / "m"))
    rows = matrix.limit(50).persist()
    score = lambda m: [r[0] for r in models.event_probability(m, rows).orderBy("icustay_id").select(models.PROBABILITY).collect()]
    assert score(PipelineModel.load(str(tmp_path / "m"))) == score(pipeline)
    assert sum(ensembles["random_forest", models.ALL_ROWS].featureImportances.toArray()) == pytest.approx(1)


def test_unlabelled_rows_and_missing_values(spark):
    rows = [(i, float(i % 9) if i % 4 else None, 1.0 if i % 3 else None, None if i % 10 == 0 else int(i % 9 > 4)) for i in range(400)]
    df = spark.createDataFrame(rows, f"icustay_id bigint, a double, b double, {fv.LABEL} int").withColumn("fold", F.lit(-1))
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    from wardlens.ml.stages import FillModel

    same = SQLTransformer(statement="SELECT * FROM __THIS__")
    prep = PipelineModel(stages=[same, FillModel.of(["a", "b"], [100.0, 1.0]), VectorAssembler(inputCols=["a", "b"], outputCol=models.VECTOR)])
    spec = trees.TreeSpec("boost", trees=5, depth=2, min_leaf=1)
    rows = models.training_rows(df, ["icustay_id"], same, ["a", "b"])
    model = models.fit_ensembles(rows, {"m": spec}, {-1: prep}, ["a", "b"])["m", -1]
    scored = models.event_probability(model, prep.transform(df)).filter("a is not null and b = 1").collect()
    assert {r.a > 4: True for r in scored} == {True: True, False: True}
    assert min(r[models.PROBABILITY] for r in scored if r.a > 4) > max(r[models.PROBABILITY] for r in scored if r.a <= 4)


def test_a_training_set_of_some_100_000_rows_is_one_block(spark):
    """Its trees grow in tasks; a job per level of every boosted tree took longer than all the sums."""
    rows = spark.range(70_000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).alias("y"),
                                      F.lit(0).alias("fold"), F.xxhash64("id").alias("_key"))
    blocks, n = trees.binned_blocks(rows, ["a"], trees.bin_edges(rows, ["a"]), "y", "fold", "_key")
    assert n == 1 and len(blocks.first()["label"]) == 70_000


def test_a_brother_is_what_its_parent_has_besides():
    bins, label, fold, key = data(400)
    rows = trees.BlockRows(record(bins, label, fold, key), fit_of("boost"))
    used, channels = rows.channels(0)
    x, channels = rows.x[used], [c[used] for c in channels]
    at = 1 + (x[:, 0] > 8).astype(np.int64) + 2 * (x[:, 1] > 15)  # 1, 2: pair of one parent; 3, 4: of another
    feats = np.tile(np.arange(K), (4, 1))
    whole = trees.level_sums(x, at, channels, [1, 2, 3, 4], feats)
    parents = whole.reshape(2, 2, *whole.shape[1:]).sum(axis=1)
    assert (trees._sums_of_pairs(x, at, channels, [1, 2, 3, 4], feats, parents) == whole).all()
    for i, node in enumerate([1, 2, 3, 4]):
        for f in range(K):
            assert (whole[i, f, :, 0] == np.bincount(x[at == node, f], minlength=trees.MAX_BINS)).all()


def test_the_last_level_adds_up_one_feature():
    growth = trees.Growth(fit_of("boost"), 0)
    growth.level = growth.spec.depth
    assert growth.looked_at().shape == (1, 1)


def test_a_training_set_of_600_000_rows_is_one_block(spark):
    """Six times sf0.1: by a job per level, 300 boosted trees of it took more than 1,500 jobs."""
    rows = spark.range(600_000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).alias("y"),
                                       F.lit(0).alias("fold"), F.xxhash64("id").alias("_key"))
    blocks, n = trees.binned_blocks(rows, ["a"], trees.bin_edges(rows, ["a"]), "y", "fold", "_key")
    assert n == 1 and len(blocks.first()["label"]) == 600_000


@pytest.mark.parametrize("name", ["forest", "second"])
def test_sums_do_not_depend_on_how_nodes_are_taken(name, monkeypatch):
    """Node by node or all nodes of a level together, from rows per node or nodes per row."""
    bins, label, fold, key = data(500)
    rows = trees.BlockRows(record(bins, label, fold, key), fit_of(name, -1))
    _, channels = rows.channels(0)
    at = (rows.x[:, 0] > 8).astype(np.int64) + 2 * (rows.x[:, 1] > 15)
    feats = np.array([[0, 2], [1, 4], [0, 3], [2, 3]])
    found = []
    for few in (0, 1 << 30):
        monkeypatch.setattr(trees, "FEW_ROWS", few)
        found += [trees.level_sums(rows.x, a, channels, [0, 1, 2, 3], feats) for a in (at, [np.flatnonzero(at == i) for i in range(4)])]
    assert all((f == found[0]).all() for f in found) and found[0][..., 0].sum() == 2 * 500


def test_large_nodes_are_added_up_by_joint_tables_to_the_same_sums():
    bins, label, fold, key = data(9000)
    feats = np.array([[0, 1, 3], [1, 2, 4]])
    for name in SPECS:
        rows = trees.BlockRows(record(bins, label, fold, key), fit_of(name))
        used, channels = rows.channels(0)
        stand = [r[used[r]] for r in np.array_split(np.arange(len(rows.x)), [5500])]
        columns = np.ascontiguousarray(rows.x.T)
        want = trees._sums(columns, stand, channels, feats, False)
        assert (trees.level_sums(rows.x, stand, channels, [1, 2], feats, False, rows.bins) == want).all()
        same = feats[[0, 0]]
        joint = rows.joint(same[0])
        assert len(joint) < 3
        want = trees._sums(columns, stand, channels, same, True)
        assert (trees.level_sums(rows.x, stand, channels, [1, 2], same, True, rows.bins, joint) == want).all()


def test_scores_move_alike_by_known_leaves():
    bins, label, fold, key = data(9000)
    for name in ("boost", "second", "leaves"):
        known, plain = (trees.BlockRows(record(bins, label, fold, key), fit_of(name)) for _ in range(2))
        for number in range(3):
            leaves = []
            known.add(trees.grow_in_block(known, number, leaves), leaves)
            plain.add(trees.grow_in_block(plain, number))
            assert (known.score == plain.score).all()


def test_series_do_not_depend_on_the_fits_beside(spark):
    bins, label, fold, key = data()
    schema = "bins binary, label binary, fold binary, key binary"
    block = spark.createDataFrame([tuple(map(bytearray, record(bins, label, fold, key).values()))], schema)
    beside = trees.grow(block, 1, [fit_of("boost"), fit_of("extra")])["extra", 1]
    alone = trees.replace(fit_of("extra"), spec=trees.replace(SPECS["extra"], series=1))
    assert [t.to_dict() for t in trees.grow(block, 1, [alone])["extra", 1]] == [t.to_dict() for t in beside]


def test_a_query_fits_no_other_model(monkeypatch, tmp_path, spark):
    from wardlens.plans import queries_models as q

    fitted = []
    monkeypatch.setattr(q, "_fits", lambda spark, sf, names: fitted.append(names) or {n: n for n in names})
    assert q._model(spark, str(tmp_path), "extra_trees") == "extra_trees"
    assert list(q._models(spark, str(tmp_path), q.TREES)) == q.TREES
    assert fitted == [["extra_trees"], ["random_forest", "gradient_boosting"]]
    assert [q._config(n).trees.series for n in (*q.TREES, *q.BOOSTERS)] == [0, 1, 2, 0, 1]


def test_a_team_grows_the_trees_of_one_block(spark, monkeypatch):
    """Members that hold some blocks each, in one stage; and the aggregates by level, where no team can hold the rows."""
    monkeypatch.setattr(trees, "TEAM_ROWS", 40)
    bins, label, fold, key = data()
    rows = [tuple(record(*(a[i : i + 60] for a in (bins, label, fold, key))).values()) for i in range(0, 300, 60)]
    schema = "bins binary, label binary, fold binary, key binary"
    many = spark.createDataFrame([tuple(map(bytearray, r)) for r in rows], schema)
    one = spark.createDataFrame([tuple(map(bytearray, record(bins, label, fold, key).values()))], schema)
    fits = [trees.replace(fit_of(name, fold), number=i) for i, (name, fold) in enumerate((n, f) for n in SPECS for f in (-1, 2))]
    places, members, most = trees._placed(many)
    assert members == 5 and most == 60 and sorted(places.values()) == [0, 1, 2, 3, 4]
    want = trees._grow_in_tasks(one, fits)
    jobs = []
    by_level = trees._one_level
    monkeypatch.setattr(trees, "_one_level", lambda *a: jobs.append(1) or by_level(*a))
    for held, groups in ((trees.TEAM_BYTES, 1), (64 * 60 * 4, 4), (0, 0)):
        monkeypatch.setattr(trees, "TEAM_BYTES", held)
        if groups:
            assert len(trees._team_fits(fits, most)) >= groups
        found = trees.grow(many, len(rows), fits)
        assert {k: [t.to_dict() for t in v] for k, v in found.items()} == {k: [t.to_dict() for t in v] for k, v in want.items()}
        assert bool(jobs) == (not held)
