"""Preprocessing stages for Spark ML pipelines.

They work on named DOUBLE columns and replace them in place.  A fit is one
distributed quantile or moment pass over all columns; the fitted model holds one
number or two per column and applies them as plain column expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import clip
from ..operators.features import derived_columns, with_base_columns, with_defaults
from ..operators.ordered import (
    long_values,
    quantile_name,
    quantile_table,
    quantiles_of_totals,
    running_totals,
    value_counts,
)

MODEL_COLUMNS = [*fv.BASE_FEATURES, *fv.DERIVED_FEATURES]


class ClinicalFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the 17 derived features; absent base columns become 0."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        based = with_base_columns(dataset)
        based = based.withColumns({c: F.col(c).cast("double") for c in fv.BASE_FEATURES})
        return with_defaults(based, {c: None for c in fv.DERIVATION_DEFAULTS}).withColumns(derived_columns())


class _PerColumn(Params):
    """Shared parameters: column names and up to three fitted numbers per column."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to replace", TypeConverters.toListString)
    first = Param(Params._dummy(), "first", "first number per column", TypeConverters.toListFloat)
    second = Param(Params._dummy(), "second", "second number per column", TypeConverters.toListFloat)
    third = Param(Params._dummy(), "third", "third number per column", TypeConverters.toListFloat)

    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)

    def numbers(self, *params) -> list[tuple]:
        return list(zip(self.columns(), *[self.getOrDefault(p) for p in params]))


class _ColumnModel(_PerColumn, Model, DefaultParamsReadable, DefaultParamsWritable):
    @classmethod
    def of(cls, columns: list[str], first, second=None, third=None):
        model = cls()
        model._set(inputCols=list(columns), first=[float(v) for v in first])
        if second is not None:
            model._set(second=[float(v) for v in second])
        if third is not None:
            model._set(third=[float(v) for v in third])
        return model


class FillModel(_ColumnModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.numbers(self.first)})


class ClipModel(_ColumnModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        bounds = self.numbers(self.first, self.second)
        return dataset.withColumns({c: clip(F.col(c), low, high) for c, low, high in bounds})


class ShiftScaleModel(_ColumnModel):
    """(x - first) / second"""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = self.numbers(self.first, self.second)
        return dataset.withColumns({c: (F.col(c) - shift) / scale for c, shift, scale in pairs})


class YeoJohnsonModel(_ColumnModel):
    """Power transform with exponent ``first``, then (y - second) / third."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        triples = self.numbers(self.first, self.second, self.third)
        return dataset.withColumns(
            {c: (yeo_johnson(F.col(c), F.lit(lam)) - shift) / scale for c, lam, shift, scale in triples}
        )


def array_form(stages: list[Model], columns: list[str]) -> list[tuple]:
    """What the column stages do, as (kind, numbers per column...), for rows held as arrays."""
    kinds = {FillModel: "fill", ClipModel: "clip", ShiftScaleModel: "shift", YeoJohnsonModel: "power"}
    out = []
    for stage in stages:
        if list(stage.columns()) != list(columns):
            raise ValueError("a stage works on other columns than the rows hold")
        numbers = [stage.getOrDefault(p) for p in (stage.first, stage.second, stage.third) if stage.isDefined(p)]
        out.append((kinds[type(stage)], *(np.array(v, float) for v in numbers)))
    return out


def apply_arrays(form: list[tuple], x: np.ndarray) -> np.ndarray:
    """The stages of ``array_form`` on rows (n, columns); a missing value is NaN."""
    for kind, first, *rest in form:
        if kind == "fill":
            x = np.where(np.isnan(x), first, x)
        elif kind == "clip":
            x = np.clip(x, first, rest[0])
        elif kind == "shift":
            x = (x - first) / rest[0]
        else:
            with np.errstate(invalid="ignore", divide="ignore"):
                up = np.where(np.abs(first) < 1e-9, np.log1p(x), ((x + 1) ** first - 1) / first)
                other = 2 - first
                down = np.where(np.abs(other) < 1e-9, -np.log1p(-x), -((1 - x) ** other - 1) / other)
            x = (np.where(x >= 0, up, down) - rest[0]) / rest[1]
    return x


class _ColumnEstimator(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _quantiles(self, dataset: DataFrame, percents: list[float]) -> dict[str, list[float]]:
        """Per column; one row per column reaches the driver."""
        columns = self.getInputCols()
        rows = {r["feature"]: r for r in quantile_table(dataset, columns, percents).collect()}
        empty = [c for c in columns if c not in rows]
        if empty:
            raise ValueError(f"no values to fit on: {empty}")
        return {c: [float(rows[c][quantile_name(p)]) for p in percents] for c in columns}

    def _moments(self, dataset: DataFrame) -> dict[str, tuple[float, float]]:
        columns = self.getInputCols()
        row = dataset.agg(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).first()
        empty = [c for c in columns if row[f"m_{c}"] is None]
        if empty:
            raise ValueError(f"no values to fit on: {empty}")
        return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


class MedianImputer(_ColumnEstimator):
    def _fit(self, dataset: DataFrame) -> FillModel:
        q = self._quantiles(dataset, [50])
        return FillModel.of(self.getInputCols(), [q[c][0] for c in self.getInputCols()])


class MeanImputer(_ColumnEstimator):
    def _fit(self, dataset: DataFrame) -> FillModel:
        m = self._moments(dataset)
        return FillModel.of(self.getInputCols(), [m[c][0] for c in self.getInputCols()])


class PercentileClipper(_ColumnEstimator):
    lowerPercent = Param(Params._dummy(), "lowerPercent", "lower percentile", TypeConverters.toFloat)
    upperPercent = Param(Params._dummy(), "upperPercent", "upper percentile", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, lowerPercent=fv.CLIP_PERCENT[0], upperPercent=fv.CLIP_PERCENT[1]):
        Estimator.__init__(self)
        self._set(**{"lowerPercent": lowerPercent, "upperPercent": upperPercent, **self._input_kwargs})

    def _fit(self, dataset: DataFrame) -> ClipModel:
        percents = [self.getOrDefault(self.lowerPercent), self.getOrDefault(self.upperPercent)]
        q = self._quantiles(dataset, percents)
        columns = self.getInputCols()
        return ClipModel.of(columns, [q[c][0] for c in columns], [q[c][1] for c in columns])


class RobustScaler(_ColumnEstimator):
    """(x - median) / IQR; a column whose IQR is 0 is only centred."""

    def _fit(self, dataset: DataFrame) -> ShiftScaleModel:
        q = self._quantiles(dataset, [25, 50, 75])
        columns = self.getInputCols()
        spread = [q[c][2] - q[c][0] for c in columns]
        return ShiftScaleModel.of(columns, [q[c][1] for c in columns], [s if s != 0 else 1.0 for s in spread])


class StandardScaler(_ColumnEstimator):
    """(x - mean) / population standard deviation."""

    def _fit(self, dataset: DataFrame) -> ShiftScaleModel:
        m = self._moments(dataset)
        columns = self.getInputCols()
        return ShiftScaleModel.of(columns, [m[c][0] for c in columns], [m[c][1] or 1.0 for c in columns])


def yeo_johnson(x: Column, lam: Column) -> Column:
    up = F.when(F.abs(lam) < 1e-9, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    rest = 2 - lam
    down = F.when(F.abs(rest) < 1e-9, -F.log1p(-x)).otherwise(-(F.pow(1 - x, rest) - 1) / rest)
    return F.when(x >= 0, up).otherwise(down)


class YeoJohnsonScaler(_ColumnEstimator):
    """Exponent by maximum likelihood per column, then standardisation.

    The likelihood of a whole grid of exponents is one aggregate over the distinct
    values; the grid is then narrowed around the best point of each column.
    """

    STEPS = (0.5, 0.05, 0.005, 0.0005)

    def exponents(self, dataset: DataFrame) -> dict[str, float]:
        columns = self.getInputCols()
        counts = value_counts(long_values(dataset, columns), "value", ["feature"]).persist()
        means = {c: m for c, (m, _) in self._moments(dataset).items()}
        best = dict.fromkeys(columns, 1.0)
        try:
            for step in self.STEPS:
                offsets = [i * step for i in range(-10, 11)]
                best.update(self._best(counts, best, means, offsets))
        finally:
            counts.unpersist()
        return best

    @staticmethod
    def _best(counts: DataFrame, around: dict, means: dict, offsets: list[float]) -> dict[str, float]:
        def by_feature(values: dict) -> Column:
            return F.create_map(*[x for c, v in values.items() for x in (F.lit(c), F.lit(float(v)))])[F.col("feature")]

        tried = (
            counts.withColumn("_offset", F.explode(F.array(*[F.lit(o) for o in offsets])))
            .withColumn("lam", by_feature(around) + F.col("_offset"))
            .withColumn("_mean", by_feature(means))
        )
        # deviations from a point near the centre keep the variance sum accurate
        y = yeo_johnson(F.col("value"), F.col("lam")) - yeo_johnson(F.col("_mean"), F.col("lam"))
        n = F.col("n")
        sums = tried.withColumn("_y", y).groupBy("feature", "lam").agg(
            F.sum(n).alias("N"),
            F.sum(n * F.col("_y")).alias("s1"),
            F.sum(n * F.col("_y") * F.col("_y")).alias("s2"),
            F.sum(n * F.signum("value") * F.log1p(F.abs("value"))).alias("jac"),
        )
        var = F.col("s2") / F.col("N") - (F.col("s1") / F.col("N")) ** 2
        fit = sums.filter(var > 0).withColumn(
            "loglik", -F.col("N") / 2.0 * F.log(var) + (F.col("lam") - 1) * F.col("jac")
        )
        rows = fit.groupBy("feature").agg(F.max_by("lam", "loglik").alias("lam")).collect()
        return {r["feature"]: float(r["lam"]) for r in rows}

    def _fit(self, dataset: DataFrame) -> YeoJohnsonModel:
        columns = self.getInputCols()
        lams = self.exponents(dataset)
        shaped = dataset.select(*[yeo_johnson(F.col(c), F.lit(lams[c])).alias(c) for c in columns])
        m = self._moments(shaped)
        return YeoJohnsonModel.of(
            columns, [lams[c] for c in columns], [m[c][0] for c in columns], [m[c][1] or 1.0 for c in columns]
        )


def fit_robust_chain(dataset: DataFrame, columns: list[str]) -> list[Model]:
    """Median imputer, percentile clipper and robust scaler from one sorted pass.

    Gives the same numbers as fitting the three stages one after the other.  Each
    stage is monotone per column, so the order statistics it would see follow from
    those of the raw column: imputing inserts the missing count at the median, and
    clipping moves only the ends.
    """
    n_all = dataset.count()
    counts = value_counts(long_values(dataset, columns), "value", ["feature"])
    totals = running_totals(counts, "value", ["n"], ["feature"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        medians = quantiles_of_totals(totals, [50], "linear", ["feature"]).collect()
        median = {r["feature"]: float(r["q50"]) for r in medians}
        missing = {r["feature"]: n_all - r["n"] for r in medians}
        if set(median) != set(columns):
            raise ValueError(f"no values to fit on: {sorted(set(columns) - set(median))}")

        def of_feature(values: dict) -> Column:
            return F.create_map(*[x for c, v in values.items() for x in (F.lit(c), F.lit(v))])[F.col("feature")]

        low, high = fv.CLIP_PERCENT
        places = {p: (n_all - 1) * (p / 100.0) for p in (low, 25, 50, 75, high)}
        spots = sorted({min(int(h) + up, n_all - 1) for h in places.values() for up in (0, 1)})
        known = totals.withColumn("_m", of_feature(median)).withColumn("_gap", of_feature(missing))
        value, cum = F.col("value"), F.col("cum_n")
        rows = known.groupBy("feature").agg(
            F.coalesce(F.sum(F.when(value < F.col("_m"), F.col("n"))), F.lit(0)).alias("below"),
            F.coalesce(F.sum(F.when(value <= F.col("_m"), F.col("n"))), F.lit(0)).alias("up_to"),
            *[F.min(F.when(cum > r, value)).alias(f"at_{r}") for r in spots],
            *[F.min(F.when(cum > F.lit(r) - F.col("_gap"), value)).alias(f"shifted_{r}") for r in spots],
        ).collect()
    finally:
        totals.unpersist()

    fitted = {}
    for row in rows:
        m, gap = median[row["feature"]], missing[row["feature"]]

        def statistic(r: int) -> float:
            if r < row["below"]:
                return row[f"at_{r}"]
            return m if r < row["up_to"] + gap else row[f"shifted_{r}"]

        def between(p: float, shape=lambda v: v) -> float:
            h = places[p]
            a, b = shape(statistic(int(h))), shape(statistic(min(int(h) + 1, n_all - 1)))
            return a + (b - a) * (h - int(h))

        floor, top = between(low), between(high)
        q1, q2, q3 = (between(p, lambda v: max(min(v, top), floor)) for p in (25, 50, 75))
        fitted[row["feature"]] = (m, floor, top, q2, (q3 - q1) or 1.0)
    fill, floors, tops, centres, scales = zip(*[fitted[c] for c in columns])
    return [FillModel.of(columns, fill), ClipModel.of(columns, floors, tops), ShiftScaleModel.of(columns, centres, scales)]


def build_preprocessing(
    columns: list[str] | None = None,
    scaler: str = "robust",
    imputer: str = "median",
    use_clinical_features: bool = True,
) -> Pipeline:
    """[clinical features] -> impute -> clip -> scale, each fitted on the previous output."""
    columns = columns or (MODEL_COLUMNS if use_clinical_features else fv.BASE_FEATURES)
    imputers = {"median": MedianImputer, "mean": MeanImputer}
    scalers = {"robust": RobustScaler, "standard": StandardScaler, "power": YeoJohnsonScaler}
    stages = [ClinicalFeatures()] if use_clinical_features else []
    stages += [
        imputers[imputer](inputCols=columns),
        PercentileClipper(inputCols=columns),
        scalers[scaler](inputCols=columns),
    ]
    return Pipeline(stages=stages)
