"""Many logistic regressions at once, by Newton steps over one aggregate.

Each step is one pass over the rows.  A task adds up, for every logit that is not done,
the gradient, the information matrix and the log likelihood of its rows; Spark adds the
tasks' sums up, and the driver solves the small systems.  A logit may use some of the
columns, leave a fold out, weight its classes, carry a ridge penalty, and see the columns
through its own preprocessing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import written
from .stages import apply_arrays

BLOCK_ROWS = 8192  # of ``packed_rows``
MAX_STEPS = 60
TOLERANCE = 1e-20  # of the decrement, twice what the objective could still gain


@dataclass(frozen=True)
class Logit:
    """One regression of ``y`` on an intercept and the ``columns`` (positions in ``x``).

    The rows of ``fold`` are left out.  ``tested`` columns have no coefficient, but their
    gradient and information are taken as well, for score tests.
    """

    key: object
    columns: tuple[int, ...]
    tested: tuple[int, ...] = ()
    ridge: float = 0.0
    balanced: bool = False
    fold: int | None = None
    prepare: list = field(default_factory=list)


@dataclass
class LogitFit:
    logit: Logit
    beta: np.ndarray  # intercept first
    gradient: np.ndarray  # with the tested columns behind
    information: np.ndarray
    log_likelihood: float
    n: int
    n_events: int

    @property
    def covariance(self) -> np.ndarray:
        m = len(self.beta)
        return np.linalg.pinv(self.information[:m, :m], hermitian=True)

    @property
    def null_log_likelihood(self) -> float:
        return sum(k * math.log(k / self.n) for k in (self.n_events, self.n - self.n_events) if k)

    def score_tests(self) -> dict[int, float]:
        """Chi-square (1 df) of adding each tested column."""
        m, inner = len(self.beta), self.covariance
        out = {}
        for at, column in enumerate(self.logit.tested, m):
            cross = self.information[at, :m]
            spread = self.information[at, at] - cross @ inner @ cross
            out[column] = float(self.gradient[at] ** 2 / spread) if spread > 1e-12 else 0.0
        return out


def _rows_of(batch: pa.RecordBatch):
    """(x, y, fold) as arrays, of an Arrow batch of rows or of ``packed_rows``."""
    if not pa.types.is_binary(batch.schema.field("x").type):
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        yield x, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
        return
    for x, y, fold in zip(*(batch.column(c) for c in ("x", "y", "fold"))):
        y = np.frombuffer(y.as_buffer(), np.int32)
        yield np.frombuffer(x.as_buffer()).reshape(-1, len(y)).T, y, np.frombuffer(fold.as_buffer(), np.int32)


def packed_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (x, y, fold) written as blocks of at most ``BLOCK_ROWS``, x a column at a time, which
    every pass of ``fit_logits`` hands over as they lie."""

    def of(batches):
        held, size = [], 0

        def out():
            x, y, fold = (np.concatenate(part) for part in zip(*held))
            cells = [x.T.tobytes(), y.astype(np.int32).tobytes(), fold.astype(np.int32).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["x", "y", "fold"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK_ROWS - size)
                held += _rows_of(part)
                at, size = at + part.num_rows, size + part.num_rows
                if size == BLOCK_ROWS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return written(rows.mapInArrow(of, "x binary, y binary, fold binary"), "logit_blocks")


def _class_counts(rows: DataFrame) -> DataFrame:
    """(fold, y, count) of rows or of ``packed_rows``."""
    if rows.schema["x"].dataType.typeName() != "binary":
        return rows.groupBy("fold", "y").count()

    def of(batches):
        for batch in batches:
            for y, fold in zip(*(batch.column(c) for c in ("y", "fold"))):
                pairs = np.stack([np.frombuffer(c.as_buffer(), np.int32) for c in (fold, y)])
                (folds, labels), n = np.unique(pairs, axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(folds), pa.array(labels), pa.array(n)], ["fold", "y", "n"])

    counts = rows.select("y", "fold").mapInArrow(of, "fold int, y int, n bigint")
    return counts.groupBy("fold", "y").agg(F.sum("n").alias("count"))


def _sums(logits: list[Logit], betas: list[np.ndarray], weights: list[tuple[float, float]]):
    """Arrow rows (x, y, fold) -> per logit the sums of this task, one row per number."""

    def of(batches):
        totals: list = [None] * len(logits)
        for x, y, fold in (part for batch in batches if batch.num_rows for part in _rows_of(batch)):
            for i, (logit, beta, (w0, w1)) in enumerate(zip(logits, betas, weights)):
                inside = slice(None) if logit.fold is None else fold != logit.fold
                seen, own = apply_arrays(logit.prepare, x[inside])[:, [*logit.columns, *logit.tested]], y[inside].astype(float)
                whole = ~np.isnan(seen).any(axis=1)
                if not whole.all():
                    seen, own = seen[whole], own[whole]
                design = np.column_stack([np.ones(len(own)), seen])
                eta = design[:, : len(beta)] @ beta
                w = np.where(own == 1, w1, w0)
                p = 1.0 / (1.0 + np.exp(-eta))
                loss = w * (np.logaddexp(0.0, eta) - own * eta)
                info = (design * (w * p * (1 - p))[:, None]).T @ design
                part = np.concatenate([design.T @ (w * (own - p)), info.ravel(), [loss.sum(), len(own), own.sum()]])
                totals[i] = part if totals[i] is None else totals[i] + part
        for i, total in enumerate(totals):
            if total is not None:
                n = len(total)
                arrays = [pa.array(np.full(n, i, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(total)]
                yield pa.RecordBatch.from_arrays(arrays, ["logit", "place", "total"])

    return of


def logit_rows(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """The labelled rows in the form that ``fit_logits`` reads; missing values stay missing."""
    x = F.array(*[F.col(c).cast("double") for c in columns])
    return df.filter(F.col(label).isNotNull()).select(x.alias("x"), F.col(label).cast("int").alias("y"), F.lit(0).alias("fold"))


def sums_at(rows: DataFrame, logit: Logit, beta: list[float]) -> DataFrame:
    """(place, total): gradient, information, loss, rows and events at given coefficients."""
    sums = rows.mapInArrow(_sums([logit], [np.array(beta, float)], [(1.0, 1.0)]), "logit int, place int, total double")
    return sums.groupBy("place").agg(F.sum("total").alias("total"))


def _class_weights(rows: DataFrame, logits: list[Logit]) -> list[tuple[float, float]]:
    counts = {(r["fold"], int(r["y"])): r["count"] for r in _class_counts(rows).collect()}  # folds x classes
    out = []
    for logit in logits:
        n0, n1 = (sum(n for (f, y), n in counts.items() if y == c and (logit.fold is None or f != logit.fold)) for c in (0, 1))
        if not n0 or not n1:
            raise ValueError(f"a logistic fit needs rows of both classes, found {n0} and {n1}")
        out.append(((n0 + n1) / (2.0 * n0), (n0 + n1) / (2.0 * n1)) if logit.balanced else (1.0, 1.0))
    return out


def fit_logits(
    rows: DataFrame, logits: list[Logit], max_steps: int = MAX_STEPS, starts: list[np.ndarray] | None = None
) -> list[LogitFit]:
    """Fit all ``logits`` on ``rows`` (x array of doubles, y 0 or 1, fold; or ``packed_rows`` of them), which are
    read once a step.  ``starts`` has the first coefficients of each, zeros where it is None.

    A row counts for a logit where all columns it looks at have a value.  A step that loses likelihood is halved.  A logit whose classes
    are separated has no maximum; it stops after ``max_steps`` with large coefficients.
    """
    weights = _class_weights(rows, logits)
    betas = [np.zeros(1 + len(g.columns)) for g in logits] if starts is None else [np.array(b, float) for b in starts]
    steps: list[np.ndarray | None] = [None] * len(logits)
    before = [math.inf] * len(logits)
    found: list[LogitFit | None] = [None] * len(logits)
    for turn in range(max_steps):
        live = [i for i, f in enumerate(found) if f is None]
        if not live:
            break
        sums = rows.mapInArrow(
            _sums([logits[i] for i in live], [betas[i] for i in live], [weights[i] for i in live]),
            "logit int, place int, total double",
        )
        totals: dict[int, dict] = {}
        for r in sums.groupBy("logit", "place").agg(F.sum("total").alias("total")).collect():
            totals.setdefault(live[r["logit"]], {})[r["place"]] = r["total"]
        for i in live:
            logit, beta = logits[i], betas[i]
            m, k = len(beta), 1 + len(logit.columns) + len(logit.tested)
            flat = np.array([totals[i][j] for j in range(len(totals[i]))])
            gradient, info, (loss, n, events) = flat[:k], flat[k : k + k * k].reshape(k, k), flat[k + k * k :]
            ridge = np.full(m, logit.ridge)
            ridge[0] = 0.0
            objective = loss + 0.5 * float(ridge @ (beta * beta))
            if steps[i] is not None and objective > before[i] + 1e-9 * abs(before[i]):
                steps[i] = steps[i] / 2
                betas[i] = beta - steps[i]
                continue
            slope = gradient[:m] - ridge * beta
            step = np.linalg.lstsq(info[:m, :m] + np.diag(ridge), slope, rcond=None)[0]
            if not 0 < events < n:
                raise ValueError(f"a logistic fit needs complete rows of both classes, found {int(events)} events in {int(n)} rows")
            if float(slope @ step) < TOLERANCE * (1 + abs(objective)) or turn == max_steps - 1:
                found[i] = LogitFit(logit, beta, gradient, info, -float(loss), int(n), int(events))
            else:
                before[i], steps[i], betas[i] = objective, step, beta + step
    return found


def strict_exp(x: np.ndarray) -> np.ndarray:
    """exp to the last bit as ``F.exp`` has it (fdlibm), so that scores which are equal in a table are equal here."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        high = np.ascontiguousarray(x).view(np.int64) >> 32 & 0x7FFFFFFF
        k = np.trunc(1.44269504088896338700 * x + np.copysign(0.5, x))
        k = np.where(high > 0x3FD62E42, np.where(high < 0x3FF0A2B2, np.sign(x), k), 0.0)
        k = np.clip(np.nan_to_num(k), -1100, 1100)
        hi, lo = x - k * 6.93147180369123816490e-01, k * 1.90821492927058770002e-10
        r = hi - lo
        t = r * r
        c = r - t * (1.66666666666666019037e-01 + t * (-2.77777777770155933842e-03 + t * (
            6.61375632143793436117e-05 + t * (-1.65339022054652515390e-06 + t * 4.13813679705723846039e-08))))
        y = np.ldexp(1.0 - ((lo - (r * c) / (2.0 - c)) - hi), k.astype(np.int32))
        y = np.where(high < 0x3E300000, 1.0 + x, y)
        return np.where(x > 7.09782712893383973096e02, np.inf, np.where(x < -7.45133219101941108420e02, 0.0, y))


class LinearProbabilityModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Scores vectors by a logistic function; adds ``probability`` (of no event, of the event)."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    slopes = Param(Params._dummy(), "slopes", "coefficient per feature", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "intercept", TypeConverters.toFloat)

    @classmethod
    def of(cls, fit: LogitFit, features_col: str) -> LinearProbabilityModel:
        model = cls()
        model._set(featuresCol=features_col, slopes=fit.beta[1:].tolist(), offset=float(fit.beta[0]))
        return model

    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(self.getOrDefault(self.slopes))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.offset)

    def scorer(self) -> Callable[[list[np.ndarray]], np.ndarray]:
        """The event probability of rows whose features are given as columns; equal rows score alike."""
        slopes, offset = self.getOrDefault(self.slopes), self.intercept

        def scores(columns: list[np.ndarray]) -> np.ndarray:
            eta = np.full(len(columns[0]), offset)
            for column, b in zip(columns, slopes):  # in the order of ``_transform``
                eta += column * b
            return 1.0 / (1.0 + strict_exp(-eta))

        return scores

    def _transform(self, dataset: DataFrame) -> DataFrame:
        terms = F.zip_with(
            vector_to_array(F.col(self.getOrDefault(self.featuresCol))),
            F.array(*[F.lit(b) for b in self.getOrDefault(self.slopes)]),
            lambda x, b: x * b,
        )
        eta = F.aggregate(terms, F.lit(self.intercept), lambda a, t: a + t)
        scored = dataset.withColumn("_event", 1.0 / (1.0 + F.exp(-eta)))
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_event"), F.col("_event")))).drop("_event")
