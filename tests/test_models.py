"""Preprocessing stages, model jobs, attribution and streaming."""

import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardlens import fixed_values as fv
from wardlens.ml import attribution, inference, models
from wardlens.ml import stages as st
from wardlens.operators import scoring
from wardlens.plans import jobs
from wardlens.streaming import score_stream

HEALTHY = dict(age=34, gender=1, length_of_stay=1.25, heart_rate_mean=74, creatinine_max=0.9, wbc_mean=7.2, drug_count=2,
               polypharmacy_score=1.0, lab_abnormality_score=0)
SICK = dict(age=79, gender=0, length_of_stay=11.5, heart_rate_mean=121, creatinine_max=4.2, wbc_mean=23.5, drug_count=17,
            polypharmacy_score=8.5, lab_abnormality_score=5)


def patients(spark, *people):
    rows = [(i, *[float(p[c]) if p[c] is not None else None for c in fv.BASE_FEATURES]) for i, p in enumerate(people)]
    return spark.createDataFrame(rows, "icustay_id bigint, " + ", ".join(f"{c} double" for c in fv.BASE_FEATURES))


@pytest.fixture(scope="module")
def trained(spark, matrix, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("model"))
    return folder, jobs.train_job(matrix, folder=folder, folds=2, only=["logistic_regression"], version="test_v0")


def test_one_pass_fit_equals_the_chain(spark, matrix):
    rows = st.ClinicalFeatures().transform(matrix)
    columns = [*fv.BASE_FEATURES, "log_wbc", "organ_failure_score"]
    fused = st.fit_robust_chain(rows, columns)
    chain = st.build_preprocessing(columns, use_clinical_features=False).fit(rows).stages
    for a, b in zip(fused, chain):
        names = ["first"] if isinstance(a, st.FillModel) else ["first", "second"]
        for name in names:
            assert a.getOrDefault(name) == pytest.approx(b.getOrDefault(name))


def test_zero_iqr_column_is_only_centred(spark):
    df = spark.createDataFrame([(0.0,)] * 9 + [(1.0,)], "x double")
    out = st.RobustScaler(inputCols=["x"]).fit(df).transform(df)
    assert sorted(r.x for r in out.collect()) == [0.0] * 9 + [1.0]


def test_yeo_johnson_recovers_a_log_shape(spark):
    import math
    import random

    rng = random.Random(2)
    df = spark.createDataFrame([(math.exp(rng.gauss(1, 0.7)) - 1,) for _ in range(800)], "x double")
    model = st.YeoJohnsonScaler(inputCols=["x"]).fit(df)
    assert abs(model.getOrDefault("first")[0]) < 0.2
    row = model.transform(df).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1)


def test_preprocessing_saves_and_loads(spark, matrix, tmp_path):
    columns = ["age", "wbc_mean"]
    rows = matrix.select("icustay_id", *[F.col(c).cast("double").alias(c) for c in columns])
    model = st.build_preprocessing(columns, use_clinical_features=False).fit(rows)
    model.write().overwrite().save(str(tmp_path / "prep"))
    loaded = PipelineModel.load(str(tmp_path / "prep"))
    key = lambda r: r.icustay_id
    want = sorted(model.transform(rows).collect(), key=key)
    assert sorted(loaded.transform(rows).collect(), key=key) == want
    assert all(v is not None for r in want for v in r)


def test_training_job(spark, trained):
    folder, out = trained
    best = out["best"]
    assert best.roc_auc > 0.55 and 0 < best.threshold < 1
    assert {"cv_roc_auc_mean", "cv_roc_auc_std", "cv_precision_mean"} <= set(best.cv_metrics)
    pipeline, info = models.load_model(spark, f"{folder}")
    for key in ["version", "best_model_name", "feature_names", "optimal_threshold", "cv_metrics", "test_metrics"]:
        assert key in info
    assert info["version"] == "test_v0" and len(info["feature_names"]) == 26
    assert out["cv"].count() == 2 and out["comparison"].count() == 1


def test_scoring_and_validation(spark, trained):
    pipeline, info = models.load_model(spark, trained[0])
    people = patients(spark, HEALTHY, SICK, {**SICK, "age": 5}, {**SICK, "length_of_stay": 0}, {**SICK, "wbc_mean": None},
                      {**SICK, "lab_abnormality_score": 99})
    out = jobs.score_job(pipeline, info, people)
    scores = {r.icustay_id: r for r in out["records"].collect()}
    assert sorted(scores) == [0, 1, 5]
    assert scores[1].risk_score > scores[0].risk_score
    assert scores[1].input_features["age"] == float(SICK["age"]) and scores[1].model_version == "test_v0:logistic_regression"
    assert scores[1].clinical_message == fv.RISK_MESSAGES[scores[1].risk_category]
    reasons = {r.icustay_id: r.reasons for r in out["rejected"].collect()}
    assert reasons == {2: ["age"], 3: ["length_of_stay"], 4: ["wbc_mean"]}
    assert out["summary"].first().n_patients == 3


def test_evaluation_report(spark, trained, tmp_path):
    pipeline, info = models.load_model(spark, trained[0])
    tables = jobs.evaluate_job(pipeline, info, trained[1]["test"], importance_repeats=0, folder=str(tmp_path))
    m = tables["metrics"].first()
    assert m.roc_auc == pytest.approx(info["test_metrics"]["roc_auc"])
    assert m.tp + m.fp + m.fn + m.tn == m.n_patients == trained[1]["test"].count()
    doc = spark.read.json(f"{tmp_path}/evaluation_report").first()
    assert doc.model_name == "logistic_regression" and json.loads(doc.metadata)["version"] == "test_v0"


def test_shapley_values_add_up(spark, trained):
    pipeline, info = models.load_model(spark, trained[0])
    prep, classifier = PipelineModel(stages=pipeline.stages[:-1]), pipeline.stages[-1]
    rows = prep.transform(trained[1]["test"].limit(20)).select("icustay_id", models.VECTOR).persist()
    draws = 3
    got = attribution.sampled_shapley(classifier, rows, st.MODEL_COLUMNS, ["icustay_id"], draws=draws)
    total = {r.icustay_id: r.s for r in got.groupBy("icustay_id").agg(F.sum("contribution").alias("s")).collect()}
    p = {r.icustay_id: r.p for r in models.event_probability(classifier, rows).select("icustay_id", F.col(models.PROBABILITY).alias("p")).collect()}
    # the same hash order picks the background rows
    hashed = rows.withColumn("_h", F.xxhash64("icustay_id", F.lit(42))).orderBy("_h", "icustay_id").limit(draws)
    base = sum(p[r.icustay_id] for r in hashed.collect()) / draws
    assert total == pytest.approx({i: v - base for i, v in p.items()}, abs=1e-9)


def test_permutation_importance_finds_the_signal(spark):
    rows = spark.createDataFrame([(i, float(i % 2), float(i % 2), float(i % 5)) for i in range(200)], "icustay_id bigint, adverse_event double, a double, b double")
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=["a", "b"], outputCol=models.VECTOR).transform(rows)
    fitted = LogisticRegression(featuresCol=models.VECTOR, labelCol="adverse_event", regParam=0.01).fit(vectors)
    kept = vectors.select("icustay_id", "adverse_event", models.VECTOR)
    got = {r.feature: r.importance for r in attribution.permutation_importance(fitted, kept, ["a", "b"], ["icustay_id"], repeats=3).collect()}
    assert got["a"] > 0.3 and abs(got["b"]) < 0.05


def test_stepwise_and_odds_ratio(spark):
    import math
    import random

    rng = random.Random(4)
    rows = []
    for _ in range(1500):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((a, b, int(rng.random() < 1 / (1 + math.exp(-(0.9 * a - 0.5))))))
    df = spark.createDataFrame(rows, "a double, b double, adverse_event int")
    model, chosen, history = inference.stepwise_logit(df, ["a", "b"])
    assert chosen[0] == "a" and history[0][1] == "enter"
    odds = {r.variable: r for r in inference.univariate_odds_ratios(df, ["a", "b"]).collect()}
    assert odds["a"].lower_cl > 1.5 and odds["b"].lower_cl < 1.2
    stats = {s[0]: s for s in inference.fit_statistics(model, 1500, len(chosen))}
    assert stats["-2 Log L"][2] < stats["-2 Log L"][1] and 0 < stats["R-Square"][2] < stats["Max-rescaled R-Square"][2] < 1


def test_select_best():
    def fake(name, auc):
        return models.FittedModel(name, None, "", 0.5, 0.5, 0.5, {"cv_roc_auc_mean": auc})

    assert models.select_best({"model_a": fake("model_a", 0.70), "model_b": fake("model_b", 0.82)}).name == "model_b"
    assert {"logistic_regression", "random_forest", "gradient_boosting", "extra_trees"} == set(models.model_configs())
    assert {"weighted_boosting", "balanced_boosting"} <= set(models.model_configs(boosters=True))


def test_stream_equals_batch(spark, trained, tmp_path):
    pipeline, info = models.load_model(spark, trained[0])
    people = patients(spark, HEALTHY, SICK, {**SICK, "age": 5})
    people.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(people.schema).parquet(str(tmp_path / "in"))
    score_stream(pipeline, info, source, ["icustay_id"], str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {r.icustay_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r.icustay_id: r.risk_score for r in jobs.score_job(pipeline, info, people)["records"].collect()}
    assert {i: r.risk_score for i, r in got.items()} == {**batch, 2: None}
    assert got[2].reasons == ["age"]


def test_importance_proxy_and_vectors(spark, trained):
    from wardlens.operators import explain

    pipeline, _ = models.load_model(spark, trained[0])
    imp = attribution.linear_importance(pipeline.stages[-1], st.MODEL_COLUMNS)
    assert len(imp) == 26 and min(imp.values()) >= 0
    rows = PipelineModel(stages=pipeline.stages[:-1]).transform(patients(spark, SICK))
    assert explain.importance_proxy(rows, imp, ["icustay_id"], 8).count() == 8
    assert rows.select(F.size(vector_to_array(models.VECTOR)).alias("n")).first().n == 26
    assert scoring.with_scoring_defaults(spark.range(1)).first().heart_rate_mean == 88.0


def test_folds_and_final_trees_are_grown_side_by_side(spark, monkeypatch, tmp_path):
    """Each waits for the other; one after the other, the boosted trees of the final fit kept one core of many."""
    from threading import Barrier

    from wardlens.plans import queries_models

    both = Barrier(2, timeout=20)
    summary = "model string, fold int, roc_auc double, avg_precision double, precision double, recall double, f1 double"
    rows = [(name, 0, 0.5, 0.5, 0.5, 0.5, 0.5) for name in queries_models.CONFIGS]
    monkeypatch.setattr(queries_models, "_split", lambda *a: (None, None))

    def fits(spark, sf, names):
        if queries_models.LOGISTIC not in names:
            both.wait()
        return {n: models.FittedModel(n, None, "", 0.5, 0.5, 0.5) for n in names}

    monkeypatch.setattr(queries_models, "_fits", fits)
    monkeypatch.setattr(models, "cross_validate", lambda *a, **k: both.wait() >= 0 and spark.createDataFrame(rows, summary))
    found = queries_models._compared(spark, str(tmp_path))
    assert {n: m.cv_metrics["cv_roc_auc_mean"] for n, m in found.items()} == dict.fromkeys(queries_models.CONFIGS, 0.5)


def test_evaluation_tables_do_not_wait_for_the_importance(spark, monkeypatch, tmp_path):
    """Only the importance query permutes columns; every evaluation query did."""
    from wardlens.plans import queries_models

    best = models.FittedModel("m", PipelineModel(stages=[]), "", 0.5, 0.5, 0.5)
    monkeypatch.setattr(queries_models, "_compared", lambda *a: {"m": best})
    monkeypatch.setattr(queries_models, "_split", lambda *a: (None, spark.range(1)))
    scored = spark.createDataFrame([(i, i % 2, i / 10) for i in range(10)], f"icustay_id bigint, {fv.LABEL} int, score double")
    monkeypatch.setattr(jobs, "score_column", lambda *a: scored)
    monkeypatch.setattr(jobs.attribution, "permutation_importance", lambda *a: pytest.fail("not asked for"))
    assert queries_models.evaluation_metrics(spark, str(tmp_path)).count() == 1
    monkeypatch.setattr(jobs, "importance_table", lambda *a: "importance")
    assert queries_models.evaluation_importance(spark, str(tmp_path)) == "importance"
