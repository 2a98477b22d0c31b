"""Cleaning rules on hand rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardlens import fixed_values as fv
from wardlens.operators import cleaning, summaries
from wardlens.sources import coerce_numeric, load_data

COLUMNS = (
    "icustay_id bigint, age double, gender bigint, length_of_stay double, heart_rate_mean double, creatinine_max double, "
    "creatinine_mean double, wbc_mean double, wbc_max double, lactate_max double, hemoglobin_min double, "
    "platelets_min double, drug_count bigint, polypharmacy_score double, polypharmacy_flag bigint, "
    "lab_abnormality_score bigint, adverse_event bigint"
)


def row(i, age=60.0, los=3.0, hr=80.0, crea=1.0, wbc=9.0, label=0):
    return (i, age, 1, los, hr, crea, crea, wbc, wbc, None, None, None, 4, 2.0, 0, 1, label)


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def ids(df):
    return sorted(r.icustay_id for r in df.select("icustay_id").collect())


def test_dedup_with_many_copies(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "COPIES_PER_BLOCK", 7)
    rows = [row(1)] * 40 + [row(1, age=70.0)] * 3 + [row(2)] + [row(3, age=50.0), row(3, age=40.0)]
    df = frame(spark, rows)
    kept = cleaning.dedup_keep(df)
    assert {r.icustay_id: r.age for r in kept.collect()} == {1: 60.0, 2: 60.0, 3: 40.0}
    dropped = Counter((r.icustay_id, r.age) for r in cleaning.dedup_drop(df).collect())
    assert dropped == {(1, 60.0): 39, (1, 70.0): 3, (3, 50.0): 1}


def test_ranges(spark):
    rows = [row(1, age=17.9), row(2, age=18.0), row(3, age=110.0), row(4, age=110.1), row(5, los=0.0), row(6, los=365.0),
            row(7, los=366.0), row(8, age=None), row(9, los=None)]
    assert ids(cleaning.valid_ranges_only(frame(spark, rows))) == [2, 3, 6]
    report = {r.feature: r.n_outside for r in summaries.range_report(frame(spark, rows)).collect()}
    assert report["age"] == 2 and report["length_of_stay"] == 2 and report["wbc_mean"] == 0


def test_fences_and_missing_policy(spark):
    rows = [row(i, hr=80.0 + i % 5, crea=1.0 + (i % 4) / 10, wbc=9.0 + i % 3) for i in range(40)]
    rows += [row(100, hr=290.0), row(101, crea=31.0), row(102, wbc=151.0), row(103, hr=10.0), row(104, hr=95.0)]
    rows += [row(200, hr=None), row(201, crea=None), row(202, wbc=None)]
    df = frame(spark, rows)
    normal = list(range(40))
    assert ids(cleaning.drop_outliers(df)) == normal
    assert ids(cleaning.drop_outliers(df, "keep")) == normal + [200, 201, 202]
    with pytest.raises(ValueError):
        cleaning.drop_outliers(df, "other")


def test_imputation_branches(spark):
    df = frame(spark, [row(1), row(2, hr=None), row(3, crea=None), row(4, wbc=None)])
    got = {r.icustay_id: r for r in cleaning.impute_rules(df).collect()}
    assert [got[i].any_imputed for i in (1, 2, 3, 4)] == [0, 1, 1, 1]
    assert got[2].heart_rate_mean == 80.0 and got[2].hr_imputed == 1
    assert (got[3].creatinine_max, got[3].creatinine_mean) == (1.0, 1.0)
    assert (got[4].wbc_mean, got[4].wbc_max) == (9.0, 9.0)
    assert (got[1].lactate_max, got[1].hemoglobin_min, got[1].platelets_min) == (1.5, 12.0, 200.0)


def test_winsorize(spark):
    rows = [row(i, hr=float(i)) for i in range(1, 201)] + [row(999, hr=None)]
    got = {r.icustay_id: r.heart_rate_mean for r in cleaning.winsorize(frame(spark, rows)).collect()}
    # n = 200: 1% is (x2 + x3) / 2 and 99% is (x198 + x199) / 2
    assert (got[1], got[2], got[3], got[100]) == (2.5, 2.5, 3.0, 100.0)
    assert (got[200], got[199], got[198]) == (198.5, 198.5, 198.0)
    assert got[999] == 2.5


def test_clean_drops_incomplete_rows_only(spark):
    rows = [row(i, hr=80.0 + i % 7, label=i % 2) for i in range(30)] + [row(50, age=12.0), row(51, hr=None)]
    cleaned = cleaning.clean(frame(spark, rows))
    assert ids(cleaned) == list(range(30))
    assert cleaned.filter(F.col("any_imputed") == 1).count() == 0
    assert ids(cleaning.clean(frame(spark, rows), "keep")) == list(range(30)) + [51]


def test_loader(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("age,wbc_mean,adverse_event\n70,abc,1\n71,9.5,0\n72,8.0,\n")
    df = load_data(spark, "csv", str(path), schema="age string, wbc_mean string, adverse_event string")
    assert [(r.age, r.wbc_mean, r.adverse_event) for r in df.orderBy("age").collect()] == [(70.0, None, 1.0), (71.0, 9.5, 0.0)]
    assert load_data(spark, "csv", str(path)).count() == 2
    with pytest.raises(ValueError):
        load_data(spark, "synthetic")
    with pytest.raises(Exception):
        load_data(spark, "csv", str(tmp_path / "absent.csv")).count()
    assert coerce_numeric(spark.createDataFrame([("x",)], "age string")).first().age is None


def test_describe_leaves_out_null_classes(spark):
    df = spark.createDataFrame([(1.0, 0), (3.0, 0), (5.0, None)], "age double, adverse_event int")
    got = summaries.describe_long(df, ["age"], [fv.LABEL]).collect()
    assert [(r.adverse_event, r.n, r["mean"]) for r in got] == [(0, 2, 2.0)]


def test_histogram_counts_every_value_once(spark):
    df = spark.createDataFrame([(float(i % 7), i % 2) for i in range(70)] + [(6.0, 1)], "age double, adverse_event int")
    h = summaries.histogram(df, ["age"], 5, [fv.LABEL])
    assert h.agg(F.sum("n")).first()[0] == 71 and h.count() == 10
    area = h.groupBy(fv.LABEL).agg(F.sum(F.col("density") * (F.col("bin_to") - F.col("bin_from"))).alias("a")).collect()
    assert [r.a for r in area] == pytest.approx([1.0, 1.0])


def test_rows_without_duplicates_are_made_once(spark, matrix):
    """Fences, caps and result read one written table; each made the rows anew before."""
    plan = cleaning.clean(matrix, "keep")._jdf.queryExecution().optimizedPlan().toString()
    assert "valid_rows" in str(cleaning.clean(matrix, "keep").inputFiles()) and "_first" not in plan


def test_bounds_are_fields_not_entries_of_a_map(spark, matrix):
    from wardlens.operators.ordered import as_fields, quantile_table

    table = quantile_table(matrix, ["age", "wbc_mean"], [25, 75], "averaged")
    got = spark.range(1).select(as_fields(table, ["age", "wbc_mean", "none"]).alias("b")).select("b.*").first()
    want = {r["feature"]: (r["n"], r["q25"], r["q75"]) for r in table.collect()}
    assert (tuple(got["age"]), tuple(got["wbc_mean"]), got["none"]) == (want["age"], want["wbc_mean"], None)


def test_scans_are_cut_into_small_parts_and_never_into_larger_ones(spark):
    from wardlens import session

    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for given, want in (("128m", session.SCAN_BYTES), ("16m", 16 << 20)):
            spark.conf.set(name, given)
            session._TUNED.clear()
            session.tune(spark)
            assert session._bytes(spark, spark.conf.get(name)) == want
    finally:
        spark.conf.set(name, before)
