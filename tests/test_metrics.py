"""Metrics on hand-made scores."""

import random

import pytest
from pyspark.sql import functions as F

from wardlens.operators import metrics

SIX = [(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0), (0.4, 1), (0.1, 0)]


def scored(spark, rows):
    return spark.createDataFrame([(float(s), l) for s, l in rows], "score double, adverse_event int")


def test_six_rows(spark):
    totals = metrics.score_totals(scored(spark, SIX))
    row = metrics.ranking_metrics(totals).first()
    assert row.roc_auc == pytest.approx(0.611111, abs=1e-6)
    assert row.avg_precision == pytest.approx(0.7)
    assert (row.n, row.n_pos) == (6, 3)
    roc = metrics.roc_points(totals).orderBy("fpr", "tpr").collect()
    assert [(r.tp, r.fp) for r in roc] == [(0, 0), (1, 0), (1, 1), (2, 2), (3, 2), (3, 3)]
    # highest among equally good thresholds
    assert metrics.youden_threshold(totals).first().threshold == 0.9


def test_auc_against_all_pairs_and_reversed(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 1), int(rng.random() < 0.3)) for _ in range(300)]
    pos = [s for s, l in rows if l]
    neg = [s for s, l in rows if not l]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    df = scored(spark, rows)
    auc = metrics.ranking_metrics(metrics.score_totals(df)).first().roc_auc
    mirrored = metrics.ranking_metrics(metrics.score_totals(df.withColumn("score", -F.col("score")))).first().roc_auc
    assert auc == pytest.approx(want) and mirrored == pytest.approx(1 - want)
    c = metrics.concordance(metrics.score_totals(df)).first()
    assert c.c == pytest.approx(want)
    assert c.percent_concordant + c.percent_discordant + c.percent_tied == pytest.approx(100)


def test_groups_are_independent(spark):
    df = scored(spark, SIX).withColumn("m", F.lit("x")).unionByName(
        scored(spark, [(s, 1 - l) for s, l in SIX]).withColumn("m", F.lit("y"))
    )
    got = {r.m: r.roc_auc for r in metrics.ranking_metrics(metrics.score_totals(df, by=["m"]), ["m"]).collect()}
    assert got["x"] == pytest.approx(0.611111, abs=1e-6) and got["y"] == pytest.approx(1 - 0.611111, abs=1e-6)


def test_published_confusion_counts(spark):
    rows = [(1.0, 1)] * 78 + [(0.0, 0)] * 400 + [(1.0, 0)] * 497 + [(0.0, 1)] * 25
    counts = metrics.confusion(scored(spark, rows), 0.5)
    r = counts.first()
    assert (r.tp, r.tn, r.fp, r.fn) == (78, 400, 497, 25)
    assert r.sensitivity == pytest.approx(0.757282, abs=1e-6)
    assert r.specificity == pytest.approx(0.445931, abs=1e-6)
    assert r.ppv == pytest.approx(0.135652, abs=1e-6)
    assert r.npv == pytest.approx(0.941176, abs=1e-6)
    report = {x["class"]: x for x in metrics.class_report(counts).collect()}
    assert report["accuracy"].precision == pytest.approx(0.478)
    assert report["1"].f1_score == pytest.approx(0.230088, abs=1e-6)
    assert report["0"].support == 897


def test_undefined_rates_are_zero(spark):
    r = metrics.confusion(scored(spark, [(0.1, 0), (0.2, 0)]), 0.5).first()
    assert (r.sensitivity, r.ppv, r.specificity, r.npv) == (0.0, 0.0, 1.0, 1.0)
    assert metrics.ranking_metrics(metrics.score_totals(scored(spark, [(0.1, 0), (0.2, 0)]))).first().roc_auc is None


def test_calibration_covers_all_rows(spark):
    rng = random.Random(9)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(400)]
    df = scored(spark, rows)
    assert sum(r.n for r in metrics.calibration_by_quantile(df).collect()) == 400
    deciles = metrics.calibration_by_decile(df).collect()
    assert [r.n_patients for r in deciles if r.row_type == 0] == [400]
    assert sum(r.n_patients for r in deciles if r.row_type == 1) == 400
