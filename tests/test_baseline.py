"""Batched logistic fits, classification without the row itself, contrast of two areas."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from wardlens import fixed_values as fv
from wardlens.functions.tails import chi_square_tail
from wardlens.ml import inference, models, newton, stages


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(0.4 - x @ np.array([0.9, -0.5, 0.0])))).astype(int)
    data = [(i, *map(float, r), int(v), i % 4) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, f"icustay_id bigint, a double, b double, c double, {fv.LABEL} int, fold int").persist()


def test_batched_fits_are_the_single_ones(spark, rows):
    columns = ["a", "b", "c"]
    sets = [("a",), ("b", "c"), ("a", "b", "c")]
    logits = [newton.Logit(s, tuple(columns.index(c) for c in s)) for s in sets]
    for fit in newton.fit_logits(newton.logit_rows(rows, columns, fv.LABEL), logits):
        names = list(fit.logit.key)
        vectors = VectorAssembler(inputCols=names, outputCol="f").transform(rows)
        one = GeneralizedLinearRegression(family="binomial", featuresCol="f", labelCol=fv.LABEL, maxIter=50, tol=1e-12).fit(vectors)
        got = inference.coefficient_rows(fit, names)
        assert [r[1] for r in got] == pytest.approx([*one.coefficients, one.intercept], abs=1e-8)
        assert [r[2] for r in got] == pytest.approx(list(one.summary.coefficientStandardErrors), abs=1e-8)
        assert -2 * fit.log_likelihood == pytest.approx(one.summary.deviance, abs=1e-8)
        assert -2 * fit.null_log_likelihood == pytest.approx(one.summary.nullDeviance, abs=1e-8)


def test_folds_weights_ridge_and_preprocessing(rows):
    """A logit that leaves a fold out, weights classes, is penalised and sees scaled columns."""
    form = [("fill", np.zeros(3)), ("clip", np.full(3, -1.0), np.full(3, 1.5)), ("shift", np.array([0.1, 0.2, 0.3]), np.array([2.0, 1.0, 0.5]))]
    logit = newton.Logit("m", (0, 1, 2), ridge=10.0, balanced=True, fold=2, prepare=form)
    made = rows.select(F.array("a", "b", "c").alias("x"), F.col(fv.LABEL).alias("y"), "fold")
    fit = newton.fit_logits(made, [logit])[0]
    local = np.array([tuple(r) for r in rows.filter("fold <> 2").select("a", "b", "c", fv.LABEL).collect()])
    x, y = stages.apply_arrays(form, local[:, :3]), local[:, 3]
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    p = 1 / (1 + np.exp(-(fit.beta[0] + x @ fit.beta[1:])))
    assert (w * (y - p)).sum() == pytest.approx(0, abs=1e-8)
    assert x.T @ (w * (y - p)) - 10.0 * fit.beta[1:] == pytest.approx(np.zeros(3), abs=1e-8)
    assert fit.n == len(y)


def test_array_form_is_the_stages(spark, matrix):
    columns = fv.BASE_FEATURES
    raw = matrix.select("icustay_id", *[F.col(c).cast("double").alias(c) for c in columns]).limit(200).persist()
    for scaler in ("robust", "standard", "power"):
        fitted = stages.build_preprocessing(columns, scaler=scaler, use_clinical_features=False).fit(raw)
        want = [tuple(r) for r in fitted.transform(raw).orderBy("icustay_id").select(*columns).collect()]
        x = np.array([[np.nan if v is None else v for v in r] for r in raw.orderBy("icustay_id").select(*columns).collect()], float)
        assert stages.apply_arrays(stages.array_form(fitted.stages, columns), x) == pytest.approx(np.array(want), abs=1e-9)


def test_one_class_or_separated(spark, rows):
    with pytest.raises(ValueError, match="both classes"):
        newton.fit_logits(newton.logit_rows(rows.filter(f"{fv.LABEL} = 1"), ["a"], fv.LABEL), [newton.Logit("x", (0,))])
    apart = rows.withColumn("a", F.col(fv.LABEL) * 2.0 - 1.0)
    fit = newton.fit_logits(newton.logit_rows(apart, ["a"], fv.LABEL), [newton.Logit("x", (0,))])[0]
    assert fit.beta[1] > 5 and fit.log_likelihood > -1e-3


def test_row_left_out_is_near_the_refit(spark, rows):
    """The one-step coefficients stand close to those of fits without the row."""
    small = rows.limit(60).persist()
    columns = ["a", "b"]
    fit = newton.fit_logits(newton.logit_rows(small, columns, fv.LABEL), [newton.Logit("x", (0, 1))])[0]
    got = {r[0]: r[1] for r in small.select("icustay_id", inference.left_out_probability(fit, columns)).collect()}
    plain = {r[0]: r[1] for r in small.select("icustay_id", inference.probability(inference.linear_score(fit, columns))).collect()}
    data = [(r.icustay_id, r.a, r.b, r[fv.LABEL]) for r in small.collect()]
    x, y = np.array([[1, a, b] for _, a, b, _ in data]), np.array([d[3] for d in data])
    errors, moves = [], []
    for i, (key, *_) in enumerate(data):
        keep = np.arange(len(data)) != i
        beta = np.array(fit.beta)
        for _ in range(30):
            p = 1 / (1 + np.exp(-x[keep] @ beta))
            beta = beta + np.linalg.solve((x[keep] * (p * (1 - p))[:, None]).T @ x[keep], x[keep].T @ (y[keep] - p))
        refit = 1 / (1 + math.exp(-x[i] @ beta))
        errors.append(abs(got[key] - refit))
        moves.append(abs(plain[key] - refit))
    assert max(errors) < 0.02 and sum(errors) < 0.1 * sum(moves)
    table = inference.classification_table(small, fit, columns, (0.3, 0.5)).orderBy("cutoff").collect()
    for r in table:
        said = np.array([got[d[0]] >= r.cutoff for d in data])
        assert (r.correct_event, r.incorrect_event) == ((said & (y == 1)).sum(), (said & (y == 0)).sum())
        assert r.percent_correct == pytest.approx(100 * (said == (y == 1)).mean())


def test_contrast_is_the_all_pairs_estimator(spark, rows):
    df = rows.select(fv.LABEL, F.round("a", 1).alias("s"), F.round(F.col("a") + F.col("b"), 1).alias("t"))
    r = inference.roc_contrast(df, "s", "t").first()
    local = np.array([tuple(v) for v in df.collect()], float)
    pos, neg = local[local[:, 0] == 1], local[local[:, 0] == 0]
    wins = [(pos[:, None, k] > neg[None, :, k]) + 0.5 * (pos[:, None, k] == neg[None, :, k]) for k in (1, 2)]
    areas = [w.mean() for w in wins]
    s10, s01 = np.cov([w.mean(axis=1) for w in wins]), np.cov([w.mean(axis=0) for w in wins])
    cov = s10 / len(pos) + s01 / len(neg)
    assert (r.area_a, r.area_b) == pytest.approx(areas)
    assert (r.std_error_a, r.std_error_b) == pytest.approx(np.sqrt(np.diag(cov)))
    z = (areas[0] - areas[1]) ** 2 / (cov[0, 0] + cov[1, 1] - 2 * cov[0, 1])
    assert r.chi_square == pytest.approx(z) and 0 < chi_square_tail(r.chi_square, 1) < 1
    same = inference.roc_contrast(df, "s", "s").first()
    assert same.difference == 0 and same.chi_square is None


def test_baseline_tables_of_the_fitted_model(spark, rows):
    df = rows.withColumnRenamed("fold", "other")
    out = inference.baseline_model(df, ["a", "b", "c"])
    assert [r.variable for r in out["steps"].orderBy("step").collect()][0] == "a"
    n = rows.count()
    c = out["classification"].first()
    assert c.correct_event + c.correct_nonevent + c.incorrect_event + c.incorrect_nonevent == n
    assert out["association"].first().c == pytest.approx(out["roc_contrast"].first().area_b)
    assert out["goodness_of_fit"].first().n_groups == 10
    assert out["full_coefficients"].count() == 4


def test_linear_model_scores_and_saves(spark, rows, tmp_path):
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol=models.VECTOR).transform(rows)
    fit = newton.fit_logits(newton.logit_rows(rows, ["a", "b", "c"], fv.LABEL), [newton.Logit("x", (0, 1, 2))])[0]
    model = newton.LinearProbabilityModel.of(fit, models.VECTOR)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = newton.LinearProbabilityModel.load(str(tmp_path / "m"))
    got = models.event_probability(loaded, vectors).select(models.PROBABILITY, inference.probability(inference.linear_score(fit, ["a", "b", "c"]))).collect()
    assert [r[0] for r in got] == pytest.approx([r[1] for r in got])
    assert list(loaded.coefficients) == fit.beta[1:].tolist()


def test_packed_rows_give_the_same_fits(rows, monkeypatch):
    """Blocks hold every row once, folds and missing values included."""
    monkeypatch.setattr(newton, "BLOCK_ROWS", 7)
    holes = rows.withColumn("b", F.when(F.col("icustay_id") % 9 > 0, F.col("b")))
    made = holes.select(F.array("a", "b", "c").alias("x"), F.col(fv.LABEL).alias("y"), "fold")
    packed = newton.packed_rows(made)
    assert made.count() > packed.count() >= 400 / 7
    logits = [newton.Logit("all", (0, 1, 2)), newton.Logit("out", (0, 2), tested=(1,), fold=1, balanced=True, ridge=2.0)]
    for one, two in zip(newton.fit_logits(made, logits), newton.fit_logits(packed, logits)):
        assert one.beta == pytest.approx(two.beta, abs=1e-12) and (one.n, one.n_events) == (two.n, two.n_events)
        assert one.information == pytest.approx(two.information, rel=1e-9)


def test_stepwise_takes_few_passes(rows, monkeypatch):
    """A step's fit starts at the coefficients of the one before; each began at zero."""
    passes, sums = [], newton._sums
    monkeypatch.setattr(newton, "_sums", lambda *a: passes.append(1) or sums(*a))
    columns = ["a", "b", "c"]
    fit, chosen, _ = inference.stepwise_logit(rows, columns)
    warm = len(passes)
    cold = newton.fit_logits(newton.logit_rows(rows, columns, fv.LABEL), [newton.Logit("m", tuple(map(columns.index, chosen)))])[0]
    assert fit.beta == pytest.approx(cold.beta, abs=1e-9)
    assert warm <= 5 * (1 + len(chosen))


def test_a_table_of_the_baseline_is_made_when_asked_for(rows, monkeypatch):
    """The steps need no goodness of fit and no contrast; every query made all tables."""
    monkeypatch.setattr(inference.metrics, "hosmer_lemeshow", lambda *a: pytest.fail("not asked for"))
    monkeypatch.setattr(inference, "roc_contrast", lambda *a: pytest.fail("not asked for"))
    tables = inference.baseline_tables(rows, ["a", "b", "c"])
    assert tables["steps"]().count() >= 1 and tables["classification"]().count() == 1
