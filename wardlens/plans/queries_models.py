"""Registered queries of sources, preprocessing stages, models and attribution."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.tails import chi_square_p, stars, two_sided_rank_p
from ..ml import attribution, inference, models, newton, shapley
from ..ml import stages as st
from ..operators import explain, metrics, summaries
from ..operators.sampling import stratified_split
from ..sources import readers, sinks
from ..sources.materialize import data_version, fresh_folder, materialize
from ..streaming.scoring import score_stream, scored_records
from . import jobs
from .fixed_score import FIXED_BETA, SCORE_SQL, with_fixed_score
from .oracle_ctes import linear_quantile, r6, with_ctes
from .queries_clean import cleaned
from .queries_extract import rounded
from .queries_score import scored
from .registry import matrix_a, register

IDS = ["icustay_id"]
_KEPT: dict[tuple, object] = {}


def _once(spark, sf: str, name: str, build: Callable):
    """Fit a model once per application and data folder."""
    slot = (spark.sparkContext.applicationId, sf, data_version(spark, sf), name)
    if slot not in _KEPT:
        _KEPT[slot] = build()
    return _KEPT[slot]


# --- sources and sinks ------------------------------------------------------------------
_MODEL_TABLE = "select icustay_id, " + ", ".join(f"cast({c} as double) {c}" for c in [*fv.BASE_FEATURES, fv.LABEL]) + " from matrix_a"


@register("csv_round_trip", with_ctes(_MODEL_TABLE))
def csv_round_trip(spark, sf):
    """Export ordered by stay id with a header, read back with an explicit schema."""
    path = fresh_folder(spark, "csv")
    matrix = matrix_a(spark, sf).select("icustay_id", *fv.BASE_FEATURES, fv.LABEL)
    sinks.write_csv(matrix, path, order_by=["icustay_id"])
    schema = ", ".join(f"{c} string" for c in [*fv.BASE_FEATURES, fv.LABEL])
    return readers.load_data(spark, "csv", path, schema=f"icustay_id bigint, {schema}")


_DIRTY_AGE = "case when hadm_id % 5 = 0 then 'n/a' else cast(age as varchar) end"


@register(
    "coerced_and_labelled",
    with_ctes(f"""select icustay_id, try_cast({_DIRTY_AGE} as double) age, cast(adverse_event as double) adverse_event
      from matrix_a where hadm_id % 13 <> 0"""),
)
def coerced_and_labelled(spark, sf):
    """Text that is no number becomes null; rows without a label go."""
    dirty = matrix_a(spark, sf).select(
        "icustay_id",
        F.when(F.col("hadm_id") % 5 == 0, "n/a").otherwise(F.col("age").cast("string")).alias("age"),
        F.when(F.col("hadm_id") % 13 != 0, F.col(fv.LABEL)).alias(fv.LABEL),
    )
    return readers.drop_unlabelled(readers.coerce_numeric(dirty))


@register("features_and_target", with_ctes(
    "select icustay_id, " + ", ".join(f"cast({c} as double) {c}" for c in fv.BASE_FEATURES) + ", cast(adverse_event as integer) adverse_event from matrix_a"))
def features_and_target(spark, sf):
    return readers.split_features_target(matrix_a(spark, sf), keep=IDS)


# --- fit and apply stages ------------------------------------------------------------------
_BASE = fv.BASE_FEATURES


def _stage_oracle(fit: str, apply: Callable[[str], str]) -> str:
    """``fit`` names one-row statistics, ``apply`` gives the expression per column."""
    columns = ", ".join(f"{r6(apply(c))} {c}" for c in _BASE)
    return with_ctes(f"select icustay_id, {columns} from matrix_a, fitted", {"fitted": f"select {fit} from matrix_a"})


def _doubles(spark, sf):
    return matrix_a(spark, sf).select("icustay_id", *[F.col(c).cast("double").alias(c) for c in _BASE])


def _fit_apply(stage, spark, sf):
    rows = _doubles(spark, sf)
    return rounded(stage.fit(rows).transform(rows))


def _qs(*percents: float) -> str:
    return ", ".join(f"{linear_quantile(c, p)} {c}_{i}" for c in _BASE for i, p in enumerate(percents))


@register("impute_median", _stage_oracle(_qs(50), lambda c: f"coalesce(cast({c} as double), {c}_0)"))
def impute_median(spark, sf):
    return _fit_apply(st.MedianImputer(inputCols=_BASE), spark, sf)


@register("impute_mean", _stage_oracle(", ".join(f"avg({c}) {c}_0" for c in _BASE), lambda c: f"coalesce(cast({c} as double), {c}_0)"))
def impute_mean(spark, sf):
    return _fit_apply(st.MeanImputer(inputCols=_BASE), spark, sf)


@register(
    "clip_percentile",
    _stage_oracle(_qs(*fv.CLIP_PERCENT), lambda c: f"case when {c} is not null then greatest(least(cast({c} as double), {c}_1), {c}_0) end"),
)
def clip_percentile(spark, sf):
    return _fit_apply(st.PercentileClipper(inputCols=_BASE), spark, sf)


@register("scale_robust", _stage_oracle(_qs(25, 50, 75), lambda c: f"({c} - {c}_1) / (case when {c}_2 - {c}_0 = 0 then 1e0 else {c}_2 - {c}_0 end)"))
def scale_robust(spark, sf):
    return _fit_apply(st.RobustScaler(inputCols=_BASE), spark, sf)


@register(
    "scale_standard",
    _stage_oracle(", ".join(f"avg({c}) {c}_0, stddev_pop({c}) {c}_1" for c in _BASE), lambda c: f"({c} - {c}_0) / {c}_1"),
)
def scale_standard(spark, sf):
    return _fit_apply(st.StandardScaler(inputCols=_BASE), spark, sf)


@register("yeo_johnson_fixed", _stage_oracle("count(*) n_rows", lambda c: f"(pow(cast({c} as double) + 1, 0.5e0) - 1) / 0.5e0"))
def yeo_johnson_fixed(spark, sf):
    n = len(_BASE)
    model = st.YeoJohnsonModel.of(_BASE, [0.5] * n, [0.0] * n, [1.0] * n)
    return rounded(model.transform(_doubles(spark, sf)))


@register("yeo_johnson_fit")
def yeo_johnson_fit(spark, sf):
    """Fitted exponents per feature, on the imputed columns."""
    rows = _doubles(spark, sf)
    filled = st.MedianImputer(inputCols=_BASE).fit(rows).transform(rows)
    lams = st.YeoJohnsonScaler(inputCols=_BASE).exponents(filled)
    return spark.createDataFrame(sorted(lams.items()), "feature string, exponent double")


_CHAIN = {
    "f1": "select " + ", ".join(f"{linear_quantile(c, 50)} {c}_m" for c in _BASE) + " from matrix_a",
    "s1": "select icustay_id, " + ", ".join(f"coalesce(cast({c} as double), {c}_m) {c}" for c in _BASE) + " from matrix_a, f1",
    "f2": "select " + ", ".join(f"{linear_quantile(c, 0.5)} {c}_a, {linear_quantile(c, 99.5)} {c}_b" for c in _BASE) + " from s1",
    "s2": "select icustay_id, " + ", ".join(f"greatest(least({c}, {c}_b), {c}_a) {c}" for c in _BASE) + " from s1, f2",
    "f3": "select " + ", ".join(f"{linear_quantile(c, 25)} {c}_l, {linear_quantile(c, 50)} {c}_c, {linear_quantile(c, 75)} {c}_h" for c in _BASE) + " from s2",
}


@register(
    "preprocessing_chain",
    with_ctes("select icustay_id, " + ", ".join(
        f"{r6(f'({c} - {c}_c) / (case when {c}_h = {c}_l then 1e0 else {c}_h - {c}_l end)')} {c}" for c in _BASE) + " from s2, f3", _CHAIN),
)
def preprocessing_chain(spark, sf):
    """Impute, clip and scale, each fitted on the output of the one before."""
    rows = _doubles(spark, sf)
    return rounded(st.build_preprocessing(use_clinical_features=False).fit(rows).transform(rows))


# --- tests with p-values ------------------------------------------------------------------------
@register("mann_whitney_p")
def mann_whitney_p(spark, sf):
    """The rank test with its p-value: exact for small samples without ties, 1 where all values are tied."""
    table = summaries.mann_whitney(matrix_a(spark, sf), ties=True)
    p = two_sided_rank_p("u", "n_no_event", "n_event", "z", "n_tied")
    return table.withColumn("p", p).withColumn("significance", stars(F.col("p"))).drop("n_tied")


@register("hosmer_lemeshow_p")
def hosmer_lemeshow_p(spark, sf):
    table = metrics.hosmer_lemeshow(scored(spark, sf))
    return table.withColumn("p", chi_square_p("chi_square", "df"))


# --- statistical baseline -----------------------------------------------------------------------------
def _baseline(spark, sf, table: str):
    """One table of the baseline, whose fits are made once."""
    tables = _once(spark, sf, "baseline", lambda: inference.baseline_tables(cleaned(spark, sf)))
    return _once(spark, sf, f"baseline:{table}", tables[table])


@register("odds_ratios")
def odds_ratios(spark, sf):
    return inference.univariate_odds_ratios(cleaned(spark, sf))


@register("stepwise")
def stepwise(spark, sf):
    return _baseline(spark, sf, "steps")


@register("logit_coefficients")
def logit_coefficients(spark, sf):
    return _baseline(spark, sf, "coefficients")


@register("logit_fit_statistics")
def logit_fit_statistics(spark, sf):
    return _baseline(spark, sf, "fit_statistics")


@register("logit_calibration")
def logit_calibration(spark, sf):
    return metrics.calibration_by_decile(_baseline(spark, sf, "predictions"), "pred_prob")


@register("logit_goodness_of_fit")
def logit_goodness_of_fit(spark, sf):
    """Lack of fit of the fitted baseline over ten groups of its score, with p."""
    table = _baseline(spark, sf, "goodness_of_fit")
    return table.withColumn("p", chi_square_p("chi_square", "df"))


@register("logit_association")
def logit_association(spark, sf):
    """Concordant, discordant and tied pairs of the fitted baseline."""
    return _baseline(spark, sf, "association")


@register("logit_classification")
def logit_classification(spark, sf):
    """Classification at 0.5, every row judged by coefficients that leave it out."""
    return _baseline(spark, sf, "classification")


@register("logit_full_model")
def logit_full_model(spark, sf):
    """Coefficients of the model of all nine features."""
    return _baseline(spark, sf, "full_coefficients")


@register("logit_roc_contrast")
def logit_roc_contrast(spark, sf):
    """Area of the model of all features against that of the stepwise model, with p."""
    table = _baseline(spark, sf, "roc_contrast")
    return table.withColumn("p", chi_square_p("chi_square", F.lit(1)))


_CONTRAST = {
    "two": f"select a, b, y from (select {SCORE_SQL} a, cast(creatinine_max as double) b, {fv.LABEL} y from matrix_a) where a is not null and b is not null and y is not null",
    "size": "select count(*) n, sum(y) n1, count(*) - sum(y) n0 from two",
    "ranked": """select y, rank() over (order by a) + (count(*) over (partition by a) - 1) / 2e0 ra, rank() over (order by b) + (count(*) over (partition by b) - 1) / 2e0 rb,
      rank() over (partition by y order by a) + (count(*) over (partition by y, a) - 1) / 2e0 oa,
      rank() over (partition by y order by b) + (count(*) over (partition by y, b) - 1) / 2e0 ob from two""",
    "placed": """select y, case when y = 1 then (ra - oa) / n0 else 1 - (ra - oa) / n1 end va,
      case when y = 1 then (rb - ob) / n0 else 1 - (rb - ob) / n1 end vb from ranked, size""",
    "spread": """select sum(case when y = 1 then ma end) area_a, sum(case when y = 1 then mb end) area_b, sum(aa / k) saa, sum(bb / k) sbb, sum(ab / k) sab
      from (select y, count(*) k, avg(va) ma, avg(vb) mb, var_samp(va) aa, var_samp(vb) bb, covar_samp(va, vb) ab from placed group by y)""",
}


@register(
    "roc_contrast",
    with_ctes(f"""select n, cast(n1 as bigint) n_events, {r6('area_a')} area_a, {r6('area_b')} area_b, {r6('sqrt(saa)')} std_error_a, {r6('sqrt(sbb)')} std_error_b,
      {r6('sqrt(saa + sbb - 2 * sab)')} std_error, {r6('area_a - area_b')} difference, {r6('(area_a - area_b) ** 2 / (saa + sbb - 2 * sab)')} chi_square
      from spread, size""", _CONTRAST),
)
def roc_contrast(spark, sf):
    """Areas of the fixed score and of creatinine alone, and whether they differ."""
    return rounded(inference.roc_contrast(with_fixed_score(matrix_a(spark, sf)), "score", "creatinine_max"))


_GIVEN = [c for c in FIXED_BETA]
_TERMS = ["1e0", *[f"cast({c} as double)" for c in _GIVEN]]
_ETA = " + ".join(["-1.5e0", *[f"{b}e0 * {c}" for c, b in FIXED_BETA.items()]])
_NAMES = ["Intercept", *_GIVEN]


@register(
    "logit_sums_given",
    with_ctes(" union all ".join(
        f"select '{_NAMES[i]}' as first_term, '{_NAMES[j]}' as second_term, {r6(f'sum({_TERMS[i]} * {_TERMS[j]} * p * (1 - p)) / count(*)')} information, {r6(f'sum({_TERMS[i]} * (y - p)) / count(*)')} gradient from given"
        for i in range(len(_NAMES)) for j in range(len(_NAMES))),
        {"given": f"select *, {fv.LABEL} y, 1e0 / (1e0 + exp(-({_ETA}))) p from matrix_a where {fv.LABEL} is not null and " + " and ".join(f"{c} is not null" for c in _GIVEN)}),
)
def logit_sums_given(spark, sf):
    """Information matrix and gradient per row of a logistic model with given coefficients."""
    logit = newton.Logit("given", tuple(range(len(_GIVEN))))
    rows = newton.logit_rows(matrix_a(spark, sf), _GIVEN, fv.LABEL)
    sums = newton.sums_at(rows, logit, [-1.5, *FIXED_BETA.values()])
    k = len(_NAMES)
    whole = sums.agg(F.map_from_entries(F.collect_list(F.struct("place", "total"))).alias("t"))  # k * k + k + 3 numbers
    entries = [
        F.struct(F.lit(_NAMES[i]).alias("first_term"), F.lit(_NAMES[j]).alias("second_term"),
                 (F.col("t")[k + i * k + j] / F.col("t")[k + k * k + 1]).alias("information"),
                 (F.col("t")[i] / F.col("t")[k + k * k + 1]).alias("gradient"))
        for i in range(k) for j in range(k)
    ]
    return rounded(whole.select(F.inline(F.array(*entries))))


# --- models -------------------------------------------------------------------------------------------
def _split(spark, sf):
    """Train and test rows, the split written once."""
    build = lambda: stratified_split(matrix_a(spark, sf), IDS)
    marked = materialize(spark, "split", sf, build)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


CONFIGS = models.model_configs()
BOOSTERS = {k: c for k, c in models.model_configs(boosters=True).items() if k not in CONFIGS}
LOGISTIC = "logistic_regression"


TREES = [n for n in CONFIGS if n != LOGISTIC]


def _config(name: str) -> models.ModelConfig:
    """The configuration of a model, whose draws do not depend on the models fitted beside it."""
    config = (CONFIGS | BOOSTERS)[name]
    group = next((g for g in (TREES, [*BOOSTERS]) if name in g), None)
    return replace(config, trees=replace(config.trees, series=group.index(name))) if group else config


def _prep(spark, sf, train) -> PipelineModel:
    """The preprocessing of all final models."""
    return _once(spark, sf, "prep", lambda: models.fit_preprocessing(train))


def _fits(spark, sf, names: list[str]) -> dict[str, models.FittedModel]:
    train, test = _split(spark, sf)
    return models.train_models(train, test, {n: _config(n) for n in names}, prep=_prep(spark, sf, train), ids=tuple(IDS))


def _models(spark, sf, names: list[str]) -> dict[str, models.FittedModel]:
    """Fitted models; those not fitted before are fitted side by side, and no others."""
    kept = _once(spark, sf, "models", dict)
    missing = [n for n in names if n not in kept]
    if missing:
        kept |= _fits(spark, sf, missing)
    return {n: kept[n] for n in names}


def _model(spark, sf, name: str) -> models.FittedModel:
    return _models(spark, sf, [name])[name]


def _compared(spark, sf) -> dict[str, models.FittedModel]:
    """All models with their cross-validated metrics.

    The folds and the final trees are grown side by side, as a boosted ensemble keeps one core."""
    _split(spark, sf)  # written before both read it
    models.in_parallel({"folds": lambda: _cv_table(spark, sf), "trees": lambda: _models(spark, sf, TREES)}, 2)
    summary = {r["model"]: r.asDict() for r in models.cv_summary(_cv_table(spark, sf)).collect()}
    out = _models(spark, sf, [*CONFIGS])
    for name, fitted in out.items():
        fitted.cv_metrics = {k: v for k, v in summary[name].items() if k != "model"}
    return out


def _info(fitted: models.FittedModel) -> dict:
    return models.metadata(fitted, "v1")


def _scores(spark, sf, name: str):
    fitted = _model(spark, sf, name)
    out = models.event_probability(fitted.pipeline, matrix_a(spark, sf))
    return out.select(*IDS, fv.LABEL, F.col(models.PROBABILITY).alias("score"))


@register("lr_scores")
def lr_scores(spark, sf):
    return _scores(spark, sf, "logistic_regression")


@register("rf_scores")
def rf_scores(spark, sf):
    return _scores(spark, sf, "random_forest")


@register("gbt_scores")
def gbt_scores(spark, sf):
    return _scores(spark, sf, "gradient_boosting")


@register("et_scores")
def et_scores(spark, sf):
    return _scores(spark, sf, "extra_trees")


@register("booster_scores")
def booster_scores(spark, sf):
    """Both boosters with weighted classes, one below the other."""
    _models(spark, sf, [*BOOSTERS])  # side by side
    parts = [_scores(spark, sf, n).withColumn("model", F.lit(n)) for n in BOOSTERS]
    return reduce(DataFrame.unionByName, parts)


@register("model_comparison")
def model_comparison(spark, sf):
    """All models at full size, best cross-validated AUC first."""
    return models.comparison_table(spark, _compared(spark, sf))


@register("best_model")
def best_model(spark, sf):
    return models.best_row(model_comparison(spark, sf))


def _cv_table(spark, sf):
    """Five folds of every model."""
    return _once(spark, sf, "cv", lambda: models.cross_validate(_split(spark, sf)[0], IDS, CONFIGS, folds=5))


@register("cv_table")
def cv_table(spark, sf):
    return _cv_table(spark, sf)


@register("cv_summary")
def cv_summary(spark, sf):
    return models.cv_summary(_cv_table(spark, sf))


def _best(spark, sf) -> models.FittedModel:
    """The model that the comparison selects."""
    return _once(spark, sf, "best", lambda: models.select_best(_compared(spark, sf)))


def _evaluation(spark, sf) -> dict:
    """The tables of the best model; its importance, which scores the rows 260 times more, has its own query."""

    def build():
        best = _best(spark, sf)
        return jobs.evaluate_job(best.pipeline, _info(best), _split(spark, sf)[1], importance_repeats=0)

    return _once(spark, sf, "evaluation", build)


@register("evaluation_metrics")
def evaluation_metrics(spark, sf):
    return _evaluation(spark, sf)["metrics"]


@register("evaluation_report")
def evaluation_report(spark, sf):
    return _evaluation(spark, sf)["class_report"]


@register("evaluation_roc_points")
def evaluation_roc_points(spark, sf):
    return _evaluation(spark, sf)["roc_points"]


@register("evaluation_pr_points")
def evaluation_pr_points(spark, sf):
    return _evaluation(spark, sf)["pr_points"]


@register("evaluation_calibration")
def evaluation_calibration(spark, sf):
    return _evaluation(spark, sf)["calibration"]


@register("evaluation_histogram")
def evaluation_histogram(spark, sf):
    return _evaluation(spark, sf)["score_histogram"]


@register("evaluation_importance")
def evaluation_importance(spark, sf):
    build = lambda: jobs.importance_table(_best(spark, sf).pipeline, _split(spark, sf)[1])
    return _once(spark, sf, "importance", build)


def _all_scored(out: dict, *fields: str):
    """Scored rows, and rejected ones with their reasons."""
    good = out["records"].select(*IDS, "risk_score", "risk_category", "adverse_event_flag", *fields)
    bad = out["rejected"].select(*IDS, F.concat_ws(",", "reasons").alias("rejected_for"))
    return good.unionByName(bad, allowMissingColumns=True)


@register("saved_model_scores")
def saved_model_scores(spark, sf):
    """Save the pipeline and its metadata, load both, score with the loaded copy."""
    fitted = _model(spark, sf, "logistic_regression")
    folder = fresh_folder(spark, "model")
    models.save_model(spark, fitted, folder)
    pipeline, info = models.load_model(spark, folder)
    return _all_scored(jobs.score_job(pipeline, info, matrix_a(spark, sf)), "model_version")


@register("batch_scoring")
def batch_scoring(spark, sf):
    fitted = _model(spark, sf, "logistic_regression")
    return _all_scored(jobs.score_job(fitted.pipeline, _info(fitted), matrix_a(spark, sf)), "clinical_message")


@register("batch_scoring_summary")
def batch_scoring_summary(spark, sf):
    fitted = _model(spark, sf, "logistic_regression")
    return jobs.score_job(fitted.pipeline, _info(fitted), matrix_a(spark, sf))["summary"]


@register("stream_scores")
def stream_scores(spark, sf):
    """The whole matrix as a file stream, scored until all available input is done."""
    fitted = _model(spark, sf, "logistic_regression")
    folder = fresh_folder(spark, "stream")
    matrix = matrix_a(spark, sf).select(*IDS, *_BASE)
    matrix.write.parquet(f"{folder}/in")
    source = spark.readStream.schema(matrix.schema).parquet(f"{folder}/in")
    query = score_stream(fitted.pipeline, _info(fitted), source, IDS, f"{folder}/out", f"{folder}/state")
    query.awaitTermination()
    out = scored_records(fitted.pipeline, _info(fitted), matrix, IDS)
    return spark.read.schema(out.schema).parquet(f"{folder}/out").withColumn("reasons", F.concat_ws(",", "reasons"))


# --- attribution ------------------------------------------------------------------------------------------
def _test_rows(spark, sf):
    """The test rows as every final model sees them, written once."""
    train, test = _split(spark, sf)
    build = lambda: _prep(spark, sf, train).transform(test).select(*IDS, fv.LABEL, *st.MODEL_COLUMNS, models.VECTOR)
    return materialize(spark, "test_vectors", sf, build)


def _test_vectors(spark, sf):
    return _model(spark, sf, LOGISTIC).pipeline.stages[-1], _test_rows(spark, sf)


@register("perm_importance")
def perm_importance(spark, sf):
    classifier, rows = _test_vectors(spark, sf)
    narrow = rows.select(*IDS, fv.LABEL, models.VECTOR)
    return attribution.permutation_importance(classifier, narrow, st.MODEL_COLUMNS, IDS)


@register("top_importance")
def top_importance(spark, sf):
    return perm_importance(spark, sf).orderBy(F.desc("importance"), "feature").limit(15)


@register("shapley_sampled")
def shapley_sampled(spark, sf):
    """Sampled contributions of the logistic model with their standard errors."""
    classifier, rows = _test_vectors(spark, sf)
    return attribution.sampled_shapley(classifier, rows.select(*IDS, models.VECTOR), st.MODEL_COLUMNS, IDS, draws=16)


def _forest_contributions(spark, sf):
    """Exact contributions of the random forest on the test rows."""
    rows = _test_rows(spark, sf)
    forest = _model(spark, sf, "random_forest").pipeline.stages[-1]
    build = lambda: shapley.tree_contributions(forest, rows.select(*IDS, models.VECTOR), st.MODEL_COLUMNS, IDS)
    return materialize(spark, "forest_contributions", sf, build)


@register("tree_contributions")
def tree_contributions(spark, sf):
    """Every feature's exact contribution to the forest's probability of every test row."""
    return _forest_contributions(spark, sf).select(*IDS, "base_value", F.inline("contributions"))


@register("tree_explanations")
def tree_explanations(spark, sf):
    """The eight largest contributions to the forest's probability of every test row."""
    return explain.top_contributions(_forest_contributions(spark, sf), IDS, 8)


@register("tree_importance")
def tree_importance(spark, sf):
    """Mean absolute contribution of each feature to the forest's probability."""
    return explain.mean_absolute(_forest_contributions(spark, sf))


@register("model_linear_contributions")
def model_linear_contributions(spark, sf):
    """beta * (x - mean) of the fitted logistic model on its scaled inputs, top eight."""
    classifier, rows = _test_vectors(spark, sf)
    beta = dict(zip(st.MODEL_COLUMNS, [float(b) for b in classifier.coefficients.toArray()]))
    entries = explain.linear_contributions(rows, beta, IDS)
    return explain.top_contributions(entries, IDS, 8)


@register("model_importance_proxy")
def model_importance_proxy(spark, sf):
    classifier, rows = _test_vectors(spark, sf)
    return explain.importance_proxy(rows, attribution.linear_importance(classifier, st.MODEL_COLUMNS), IDS, 8)
