"""Jobs and readers as a user calls them: catalog tables, cleaning, baseline, thresholds."""

import pytest
from pyspark.sql import functions as F

from wardlens.fixed_values import BASE_FEATURES, LABEL
from wardlens.ml import models
from wardlens.operators import extract
from wardlens.plans import jobs
from wardlens.plans.registry import tables
from wardlens.sources import from_tables, readers
from wardlens.sources.clinical import TABLE_NAMES
from wardlens.sources.materialize import data_version, fresh_folder, materialize, shared_folder, written

SMALL = "/root/testdata/sf0.001"


def test_catalog_tables_give_the_same_cohort(spark):
    t = tables(spark, SMALL)
    spark.sql("create database if not exists ward_test")
    try:
        for name in TABLE_NAMES:
            getattr(t, name).write.mode("overwrite").saveAsTable(f"ward_test.{name}")
        got = extract.cohort_a(from_tables(spark, "ward_test"))
        assert sorted(got.select("icustay_id").collect()) == sorted(extract.cohort_a(t).select("icustay_id").collect())
    finally:
        spark.sql("drop database ward_test cascade")


def test_loading_a_catalog_table(spark, matrix):
    matrix.select(*BASE_FEATURES, F.when(F.col("age") > 30, F.col(LABEL)).alias(LABEL)).createOrReplaceTempView("ward_features")
    got = readers.load_data(spark, "table", table="ward_features")
    assert got.count() == matrix.filter("age > 30").count()
    assert {t for c, t in got.dtypes if c in BASE_FEATURES} == {"double"}


def test_clean_job_writes_both_tables(spark, matrix):
    folder = fresh_folder(spark, "clean")
    got = jobs.clean_job(matrix, folder)
    assert 0 < got.count() <= matrix.count()
    assert spark.read.option("header", True).csv(f"{folder}/feature_dictionary").count() > 0


def test_baseline_job_exports_its_tables(spark, matrix):
    folder = fresh_folder(spark, "baseline")
    clean = jobs.clean_job(matrix, folder)
    out = jobs.baseline_job(clean, folder)
    odds = spark.read.option("header", True).csv(f"{folder}/odds_ratios")
    assert odds.count() == out["odds_ratios"].count() > 0
    scores = spark.read.option("header", True).csv(f"{folder}/clinical_scores")
    assert scores.count() == clean.count()


def test_thresholds_from_rows_of_their_own(matrix):
    train, rest = models.split(matrix, ["icustay_id"], 0.4)
    held, test = models.split(rest, ["icustay_id"], 0.5)
    config = {k: c for k, c in models.model_configs().items() if k == "logistic_regression"}
    prep = models.fit_preprocessing(train)
    own = models.train_models(train, test, config, prep=prep, threshold_rows=held)["logistic_regression"]
    scores = {r[0] for r in models.event_probability(own.pipeline, held).select(models.PROBABILITY).collect()}
    assert own.threshold in scores


def test_best_row_is_the_highest_auc(spark):
    schema = "model string, cv_auc double, test_auc double, test_ap double, threshold double, description string"
    rows = [("b", 0.7, 0.1, 0.1, 0.5, ""), ("a", 0.7, 0.2, 0.1, 0.5, ""), ("c", 0.6, 0.9, 0.1, 0.5, "")]
    got = models.best_row(spark.createDataFrame(rows, schema)).collect()
    assert [r["model"] for r in got] == ["a"] and got[0]["cv_auc"] == 0.7


def test_a_fit_without_both_classes_says_so(matrix):
    from wardlens.ml.inference import baseline_model

    with pytest.raises(ValueError, match="both classes"):
        baseline_model(matrix.filter(f"{LABEL} = 0"))


def test_written_tables_follow_the_data(spark, tmp_path):
    folder = str(tmp_path / "data")
    spark.range(3).write.parquet(folder)
    build = lambda: spark.read.parquet(folder)
    before = data_version(spark, folder)
    assert materialize(spark, "probe", folder, build).count() == 3
    spark.range(5).write.mode("overwrite").parquet(folder)
    assert data_version(spark, folder) != before
    assert materialize(spark, "probe", folder, build).count() == 5
    assert all(f.startswith("file:") for f in written(spark.range(2), "probe").inputFiles())
    assert shared_folder(spark)
