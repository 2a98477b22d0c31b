"""Whole jobs: clean, train, evaluate, score.  Each takes DataFrames and returns DataFrames."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..ml import attribution, models
from ..ml.stages import MODEL_COLUMNS
from ..operators import cleaning, metrics, scoring, summaries
from ..sources.materialize import written
from ..sources.sinks import write_csv, write_parquet

IDS = ["icustay_id"]


def clean_job(matrix: DataFrame, folder: str, missing_policy: str = "reference") -> DataFrame:
    """Clean the matrix and export it with its feature dictionary."""
    from ..operators.features import feature_dictionary

    write_parquet(cleaning.clean(matrix, missing_policy), f"{folder}/cleaned")
    write_csv(feature_dictionary(matrix.sparkSession), f"{folder}/feature_dictionary")
    return matrix.sparkSession.read.parquet(f"{folder}/cleaned")


def train_job(
    df: DataFrame,
    ids: list[str] = IDS,
    folder: str | None = None,
    folds: int = 5,
    test_share: float = 0.2,
    version: str = "v1",
    trees: int = 300,
    boosters: bool = False,
    only: list[str] | None = None,
    seed: int = 42,
) -> dict:
    """Split, cross-validate, fit all models, pick the best by CV AUC, save it.

    ``folds=0`` skips cross-validation and picks by test AUC.
    """
    spark = df.sparkSession
    configs = models.model_configs(trees, seed, boosters)
    configs = {k: c for k, c in configs.items() if only is None or k in only}
    train, test = models.split(df, ids, test_share, seed)
    cv = models.cross_validate(train, ids, configs, folds, seed) if folds else None
    results = models.train_models(train, test, configs, ids=tuple(ids))
    if cv is not None:
        for row in models.cv_summary(cv).collect():
            results[row["model"]].cv_metrics = {k: v for k, v in row.asDict().items() if k != "model"}
    best = models.select_best(results)
    info = models.save_model(spark, best, folder, version) if folder else models.metadata(best, version)
    return {
        "best": best,
        "results": results,
        "metadata": info,
        "cv": cv,
        "comparison": models.comparison_table(spark, results),
        "test": test,
    }


def score_column(pipeline: PipelineModel, df: DataFrame) -> DataFrame:
    return models.event_probability(pipeline, df).withColumn("score", F.col(models.PROBABILITY))


def importance_table(pipeline: PipelineModel, test: DataFrame, ids: list[str] = IDS, repeats: int = 10) -> DataFrame:
    """Permutation importance of every feature on ``test``, the most important first."""
    prep = PipelineModel(stages=pipeline.stages[:-1])
    vectors = prep.transform(test).select(*ids, fv.LABEL, models.VECTOR)
    found = attribution.permutation_importance(pipeline.stages[-1], vectors, MODEL_COLUMNS, ids, repeats)
    return found.orderBy(F.desc("importance"), "feature")


def evaluate_job(
    pipeline: PipelineModel, info: dict, test: DataFrame, ids: list[str] = IDS, importance_repeats: int = 10,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """All evaluation tables of a saved model on rows it was not trained on."""
    threshold = info["optimal_threshold"]
    scored = written(score_column(pipeline, test).select(*ids, fv.LABEL, "score"), "evaluated")
    totals = metrics.score_totals(scored)
    counts = metrics.confusion(scored, threshold)
    ranking = metrics.ranking_metrics(totals).select("roc_auc", "avg_precision")
    # both sides are single rows; a scalar subquery puts them side by side
    pair = ranking.select(F.struct("*")).scalar()
    one = counts.withColumn("_r", pair).select("_r.*", F.lit(threshold).alias("threshold"), *counts.columns)
    tables = {
        "metrics": one,
        "class_report": metrics.class_report(counts),
        "roc_points": metrics.roc_points(totals),
        "pr_points": metrics.pr_points(totals),
        "calibration": metrics.calibration_by_quantile(scored),
        "score_histogram": summaries.histogram(scored, ["score"], 40, [fv.LABEL]),
    }
    if importance_repeats:
        tables["importance"] = importance_table(pipeline, test, ids, importance_repeats)
    if folder:
        write_report(one, tables["class_report"], info, f"{folder}/evaluation_report")
    return tables


def write_report(one: DataFrame, report: DataFrame, info: dict, path: str) -> None:
    """The evaluation report as one JSON document."""
    text = json.dumps(info)
    entries = report.agg(F.collect_list(F.struct(*report.columns))).scalar()
    one.withColumns(
        {
            "model_name": F.lit(info["best_model_name"]),
            "classification_report": entries,
            "metadata": F.lit(text),
        }
    ).coalesce(1).write.mode("overwrite").json(path)


def score_job(pipeline: PipelineModel, info: dict, df: DataFrame) -> dict[str, DataFrame]:
    """Score a table of any size; rows that fail validation are kept apart with reasons."""
    accepted, rejected = scoring.validate_records(scoring.with_scoring_defaults(df))
    scored = models.event_probability(pipeline, accepted)
    records = scoring.risk_records(scored, info["optimal_threshold"], models.PROBABILITY)
    full = scoring.with_record_fields(records, info["version"], info["best_model_name"])
    return {"records": full, "rejected": rejected, "summary": summaries.batch_summary(records)}


def run_pipeline(
    df: DataFrame, folder: str, folds: int = 5, quick: bool = False, evaluate: bool = True, trees: int = 300,
    only: list[str] | None = None,
) -> dict:
    """Train and evaluate on the frame that is passed in.  ``quick`` uses two folds."""
    trained = train_job(df, folder=f"{folder}/model", folds=2 if quick else folds, trees=trees, only=only)
    out = {"train": trained}
    if evaluate:
        pipeline, info = models.load_model(df.sparkSession, f"{folder}/model")
        out["evaluation"] = evaluate_job(pipeline, info, trained["test"], folder=folder)
    return out


def baseline_job(cleaned: DataFrame, folder: str) -> dict[str, DataFrame]:
    """The statistical baseline and its exported tables."""
    from ..ml.inference import baseline_model, univariate_odds_ratios

    odds = univariate_odds_ratios(cleaned)
    model = baseline_model(cleaned)
    bedside = scoring.bedside_score(cleaned)
    write_csv(odds, f"{folder}/odds_ratios")
    write_csv(bedside, f"{folder}/clinical_scores", keep=[*fv.ID_COLUMNS, "ae_risk_score", "risk_category", fv.LABEL])
    out = {"odds_ratios": odds, "clinical_scores": bedside, **model}
    if "predictions" in model:
        out["calibration"] = metrics.calibration_by_decile(model["predictions"], "pred_prob")
        for name in ("coefficients", "fit_statistics", "goodness_of_fit", "association", "classification", "roc_contrast"):
            write_csv(model[name], f"{folder}/logit_{name}")
        write_csv(out["calibration"], f"{folder}/calibration")
    return out


def stack(tables: list[DataFrame]) -> DataFrame:
    """Result tables one above the other, matched by name, absent columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)

