"""Regression models on MLlib: fitting, search, metrics, importances, effects."""

from __future__ import annotations

import itertools
import logging
import math
import random
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.operators.lookup import stack_tables
from demandframe.operators.metrics import regression_metrics
from demandframe.operators.ordered import DEFAULT, Blocking, row_index
from demandframe.operators.prep import dummies

log = logging.getLogger(__name__)

LINEAR = {"linear", "ridge", "lasso", "elasticnet"}
TREES = {"boosted", "gradient_boosting", "random_forest"}

# MLlib's limit on tree depth.
MAX_DEPTH = 30


class PenalisedRegression(Estimator):
    """Linear, ridge, lasso or elastic-net regression with penalties in the textbook scale.

    Ridge adds ``alpha`` times the squared coefficients to the *sum* of squared errors; the others
    add their penalty to half the *mean* squared error. MLlib divides the label by its standard
    deviation before it applies the L2 part, so that part is multiplied by the deviation here. Row
    count and deviation are those of the table being fitted, so every fold gets its own.
    """

    kind = Param(Params._dummy(), "kind", "linear, ridge, lasso or elasticnet", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "L1 share of the penalty", TypeConverters.toFloat)
    fitIntercept = Param(Params._dummy(), "fitIntercept", "fit an intercept", TypeConverters.toBoolean)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "tolerance", TypeConverters.toFloat)

    def __init__(self, kind: str, label: str, params: Mapping):
        super().__init__()
        self._set(
            kind=kind, labelCol=label, alpha=params.get("alpha", 1.0), l1Ratio=params.get("l1_ratio", 0.5),
            fitIntercept=params.get("fit_intercept", True), maxIter=params.get("max_iter", 1000), tol=params.get("tol", 1e-9),
        )

    def _penalty(self, dataset: DataFrame) -> tuple[float, float]:
        """(regParam, elasticNetParam)."""
        kind, alpha = self.getOrDefault(self.kind), self.getOrDefault(self.alpha)
        if kind == "linear":
            return 0.0, 0.0
        if kind == "lasso":
            return alpha, 1.0
        label = self.getOrDefault(self.labelCol)
        n, spread = dataset.agg(F.count(label), F.coalesce(F.stddev_pop(label), F.lit(0.0))).first()
        if kind == "ridge":
            return alpha * spread / n, 0.0
        ratio = self.getOrDefault(self.l1Ratio)
        total = alpha * ratio + alpha * (1 - ratio) * spread
        return total, (alpha * ratio / total if total else 0.0)

    def _fit(self, dataset: DataFrame):
        strength, ratio = self._penalty(dataset)
        return LinearRegression(
            featuresCol="features", labelCol=self.getOrDefault(self.labelCol), solver="normal", standardization=False,
            regParam=strength, elasticNetParam=ratio, fitIntercept=self.getOrDefault(self.fitIntercept),
            maxIter=self.getOrDefault(self.maxIter), tol=self.getOrDefault(self.tol),
        ).fit(dataset)


def _boosted(label: str, params: Mapping, validation_col: str | None) -> GBTRegressor:
    model = GBTRegressor(
        featuresCol="features", labelCol=label, maxIter=int(params.get("n_estimators", 100)), stepSize=float(params.get("learning_rate", 0.1)),
        maxDepth=_depth(params, 5), minInstancesPerNode=max(1, int(params.get("min_child_weight", 1))),
        minInfoGain=float(params.get("gamma", 0.0)), subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy=str(params.get("colsample_bytree", "all")) if params.get("colsample_bytree", 1.0) != 1.0 else "all",
        seed=int(params.get("random_state", 42)),
    )
    return model.setValidationIndicatorCol(validation_col) if validation_col else model


def _depth(params: Mapping, default: int | None) -> int:
    """MLlib has no trees without a limit, so none is passed off as one."""
    depth = params.get("max_depth", default)
    if depth is None or int(depth) > MAX_DEPTH:
        raise ValueError(f"max_depth must be given and at most {MAX_DEPTH}, the limit of MLlib's trees")
    return int(depth)


def _forest(label: str, params: Mapping) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=int(params.get("n_estimators", 100)),
        maxDepth=_depth(params, None), bootstrap=bool(params.get("bootstrap", True)), minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
        seed=int(params.get("random_state", 42)),
    )


def estimator(name: str, label: str, params: Mapping | None = None, validation_col: str | None = None):
    """MLlib estimator for a model name; parameter names are the usual ones (alpha, max_depth, …)."""
    params = params or {}
    if name in LINEAR:
        return PenalisedRegression(name, label, params)
    if name in ("boosted", "gradient_boosting"):
        return _boosted(label, params, validation_col)
    if name == "random_forest":
        return _forest(label, params)
    if name == "poisson":
        return GeneralizedLinearRegression(
            family="poisson", link="log", featuresCol="features", labelCol=label, regParam=float(params.get("alpha", 0.0)),
            maxIter=int(params.get("max_iter", 50)), tol=params.get("tol", 1e-9), fitIntercept=params.get("fit_intercept", True),
        )
    raise ValueError(f"unknown model {name!r}")


def assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def fit(
    name: str, train: DataFrame, label: str, features: Sequence[str], params: Mapping | None = None, validation_col: str | None = None
) -> PipelineModel:
    """Fit one model; the result is a saved-and-loaded-as-one pipeline (assembler, regressor)."""
    used = train.select(*features, label, *([validation_col] if validation_col else []))
    return Pipeline(stages=[assemble(features), estimator(name, label, params, validation_col)]).fit(used)


def predict(df: DataFrame, model: Transformer, out: str = "prediction") -> DataFrame:
    made = model.transform(df)
    extra = [c for c in made.columns if c not in df.columns and c != "prediction"]
    made = made.drop(*extra)
    return made if out == "prediction" else made.withColumnRenamed("prediction", out)


# ---- search --------------------------------------------------------------------------------


def param_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]


def sampled_grid(grid: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` different points of the grid (all of them if it is smaller), reproducible.

    Points are drawn by number, so a large grid is never listed.
    """
    names = sorted(grid)
    size = math.prod(len(grid[n]) for n in names)
    picked = random.Random(seed).sample(range(size), min(n_iter, size))
    points = []
    for number in picked:
        point = {}
        for n in names:
            number, i = divmod(number, len(grid[n]))
            point[n] = grid[n][i]
        points.append(point)
    return points


def with_folds(df: DataFrame, order: str, k: int, out: str = "fold", blocking: Blocking = DEFAULT) -> DataFrame:
    """Contiguous folds in table order; the first n mod k folds are one row longer."""
    numbered = row_index(df, order, out="_i", total="_n", blocking=blocking)
    small = F.floor(F.col("_n") / k).cast("bigint")
    extra = F.pmod("_n", F.lit(k)).cast("bigint")
    long_rows = extra * (small + 1)
    fold = F.when(F.col("_i") < long_rows, F.floor(F.col("_i") / (small + 1))).otherwise(
        extra + F.floor((F.col("_i") - long_rows) / F.greatest(small, F.lit(1)))
    )
    return numbered.withColumn(out, fold.cast("int")).drop("_i", "_n")


def centre(train: DataFrame, label: str, features: Sequence[str]) -> np.ndarray:
    """Means of features and label over all rows: what is subtracted before products are made, so that large offsets cost no digits."""
    means = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate([*features, label])]).first()
    if any(m is None or math.isnan(m) for m in means):
        empty = [c for c, m in zip([*features, label], means) if m is None or math.isnan(m)]
        raise ValueError(f"no number in, or NaN among, the values of {empty}")
    return np.array(means, dtype=float)


def require_complete(train: DataFrame, columns: Sequence[str]) -> None:
    """ValueError that names the columns that hold NULL or NaN, looked for in one pass."""
    gaps = train.agg(*[F.max((F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).cast("int")).alias(f"g{i}") for i, c in enumerate(columns)]).first()
    bad = [c for c, g in zip(columns, gaps) if g]
    if bad:
        raise ValueError(f"columns with NULL or NaN: {bad}")


def fold_products(train: DataFrame, label: str, features: Sequence[str], fold_col: str, about: np.ndarray | None = None) -> dict[int, np.ndarray]:
    """Cross-products of (features, label, 1) per fold, about the point ``about``: all a linear search needs, in one pass.

    Each task multiplies its own batches and gives the rows of one matrix per fold; Spark adds the cells up and puts rows together.
    """
    names = [*features, label]
    width = len(names) + 1
    shift = np.zeros(len(names)) if about is None else about

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z = np.column_stack([batch[names].to_numpy(dtype=float) - shift, np.ones(len(batch))])
            folds = batch[fold_col].to_numpy()
            for f in np.unique(folds):
                part = z[folds == f]
                sums[int(f)] = sums.get(int(f), 0.0) + part.T @ part
        if sums:
            yield pd.DataFrame([(f, i, r.tolist()) for f, m in sums.items() for i, r in enumerate(m)], columns=["fold", "i", "cells"])

    slim = train.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(fold_col).cast("int").alias(fold_col))
    parts = slim.mapInPandas(multiply, "fold int, i int, cells array<double>")
    cells = parts.select("fold", "i", F.posexplode("cells").alias("j", "v")).groupBy("fold", "i", "j").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("fold", "i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("r")).select("fold", "i", F.transform("r", lambda x: x["v"]).alias("r")).collect()
    products: dict[int, np.ndarray] = {}
    for r in rows:
        products.setdefault(r["fold"], np.zeros((width, width)))[r["i"]] = r["r"]
    return products


def _shrink(value: float, by: float) -> float:
    return math.copysign(max(abs(value) - by, 0.0), value)


def linear_from_products(name: str, params: Mapping, product: np.ndarray) -> np.ndarray:
    """Coefficients (features, intercept) of a linear-family model from its cross-products."""
    n, p = product[-1, -1], len(product) - 2
    xx, xy = product[:p, :p], product[:p, p]
    mean_x, mean_y = product[:p, -1] / n, product[p, -1] / n
    if params.get("fit_intercept", True):
        xx, xy = xx - n * np.outer(mean_x, mean_x), xy - n * mean_x * mean_y
    else:
        mean_x, mean_y = np.zeros(p), 0.0
    alpha = float(params.get("alpha", 1.0))
    if name == "linear":
        w = np.linalg.lstsq(xx, xy, rcond=None)[0]
    elif name == "ridge":
        w = np.linalg.solve(xx + alpha * np.eye(p), xy)
    else:
        ratio = 1.0 if name == "lasso" else float(params.get("l1_ratio", 0.5))
        a, b, w = xx / n, xy / n, np.zeros(p)
        for _ in range(int(params.get("max_iter", 1000))):
            old = w.copy()
            for j in range(p):
                scale = a[j, j] + alpha * (1 - ratio)
                w[j] = _shrink(b[j] - a[j] @ w + a[j, j] * w[j], alpha * ratio) / scale if scale else 0.0
            if np.abs(w - old).max() <= 1e-10 * max(1.0, np.abs(w).max()):
                break
    return np.append(w, mean_y - mean_x @ w)


def _about(points: Sequence[Mapping], train: DataFrame, label: str, features: Sequence[str]) -> np.ndarray | None:
    """The means, unless a model without intercept needs products about the origin."""
    return centre(train, label, features) if all(p.get("fit_intercept", True) for p in points) else None


def _product_scores(name: str, points: Sequence[Mapping], products: Mapping[int, np.ndarray]) -> list[float]:
    """Negative mean squared error of every point, averaged over the held-out folds."""
    whole = sum(products.values())
    scores = []
    for point in points:
        errors = []
        for held_out in products.values():
            w = linear_from_products(name, point, whole - held_out)
            p = len(w) - 1
            v = np.concatenate([-w[:p], [1.0], -w[p:]])
            errors.append(float(v @ held_out @ v) / held_out[-1, -1])
        scores.append(-float(np.mean(errors)))
    return scores


def search(
    name: str, grid: Mapping[str, Sequence], train: DataFrame, label: str, features: Sequence[str], k: int = 5, method: str = "grid",
    n_iter: int = 10, seed: int = 42, scoring: str = "neg_mean_squared_error", fold_col: str = "fold", parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """(refitted best model, cv table with one row per point: point, params, score, cv_rmse).

    ``train`` carries the fold column (``with_folds``). Scores are negative errors: higher is better,
    the first best wins. Linear models by squared error need one pass for the whole grid (cross-products
    per fold) and one fit; for all others every fold and point is a Spark job, several at a time.
    """
    points = param_grid(grid) if method == "grid" else sampled_grid(grid, n_iter, seed)
    if name in LINEAR and scoring == "neg_mean_squared_error":
        require_complete(train, [*features, label])
        about = _about(points, train, label, features)
        scores = _product_scores(name, points, fold_products(train, label, features, fold_col, about))
        table = _cv_table(train, points, scores)
        return fit(name, train, label, features, points[_first_best(scores)]), table
    used = assemble(features).transform(train).select("features", label, F.col(fold_col).cast("int").alias(fold_col)).persist()
    try:
        metric = {"neg_mean_squared_error": "mse", "neg_mean_absolute_error": "mae"}[scoring]
        judge = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
        candidates = [estimator(name, label, p) for p in points]
        first = candidates[0]
        maps = [{first.getParam(q.name): v for q, v in c.extractParamMap().items()} for c in candidates]
        cv = CrossValidator(
            estimator=first, estimatorParamMaps=maps, evaluator=judge, numFolds=k, foldCol=fold_col, parallelism=parallelism
        ).fit(used)
        scores = [-m for m in cv.avgMetrics]
    finally:
        used.unpersist()
    return PipelineModel(stages=[assemble(features), cv.bestModel]), _cv_table(train, points, scores)


def _first_best(scores: Sequence[float]) -> int:
    return max(range(len(scores)), key=lambda i: (scores[i], -i))


def _cv_table(train: DataFrame, points: Sequence[Mapping], scores: Sequence[float]) -> DataFrame:
    best = _first_best(scores)
    rows = [(i, str(points[i]), float(scores[i]), math.sqrt(max(0.0, -scores[i])), int(i == best)) for i in range(len(points))]
    return train.sparkSession.createDataFrame(rows, "point int, params string, score double, cv_rmse double, best int")


def cv_rmse(cv: CrossValidatorModel | DataFrame) -> float:
    """Root of the best mean squared error of a search."""
    if isinstance(cv, DataFrame):
        return cv.where("best = 1").first()["cv_rmse"]
    return math.sqrt(min(cv.avgMetrics))


def _stacked_by_products(
    name: str, params: Sequence[Mapping], train: DataFrame, label: str, features: Sequence[str], fold_col: str
) -> DataFrame:
    """(point, fold, label, prediction) of linear models: every row is scored by each point's model of its fold."""
    require_complete(train, [*features, label])
    about = _about(params, train, label, features)
    products = fold_products(train, label, features, fold_col, about)
    whole = sum(products.values())

    def weights(p: Mapping, part: np.ndarray) -> list[float]:
        w = linear_from_products(name, p, whole - part)
        if about is not None:  # the intercept back at the origin
            w[-1] += about[-1] - about[:-1] @ w[:-1]
        return [float(v) for v in w]

    rows = [(int(f), i, weights(p, part)) for f, part in products.items() for i, p in enumerate(params)]
    fitted = train.sparkSession.createDataFrame(rows, "fold int, point int, w array<double>")
    inputs = F.array(*[F.col(c).cast("double") for c in features], F.lit(1.0))
    shaped = train.select(F.col(fold_col).cast("int").alias("fold"), F.col(label).alias("label"), inputs.alias("x"))
    product = F.aggregate(F.zip_with("w", "x", lambda w, x: w * x), F.lit(0.0), lambda total, v: total + v)
    # one row per fold and point, made on the driver
    return shaped.join(F.broadcast(fitted), "fold").select("point", "fold", "label", product.alias("prediction"))


def _stacked_by_fits(
    name: str, params: Sequence[Mapping], train: DataFrame, label: str, features: Sequence[str], k: int, fold_col: str
) -> DataFrame:
    """The same for any model: one fit per fold and point."""
    parts = []
    for i, p in enumerate(params):
        for f in range(k):
            model = fit(name, train.where(F.col(fold_col) != f), label, features, p)
            scored = predict(train.where(F.col(fold_col) == f), model)
            parts.append(scored.select(F.lit(i).alias("point"), F.lit(f).alias("fold"), F.col(label).alias("label"), "prediction"))
    return stack_tables(*parts)


def cross_validate(
    name: str, params: Sequence[Mapping], train: DataFrame, label: str, features: Sequence[str], k: int = 5, fold_col: str = "fold", refit: str = "rmse"
) -> tuple[PipelineModel, DataFrame]:
    """Several metrics per point: (model refitted on all rows, table point, params, rmse, mae, best).

    Predictions of all folds and points are scored in one aggregation, then averaged over the folds.
    """
    used = train.select(*features, label, fold_col).persist()
    try:
        if name in LINEAR:
            stacked = _stacked_by_products(name, params, used, label, features, fold_col)
        else:
            stacked = _stacked_by_fits(name, params, used, label, features, k, fold_col)
        per_fold = regression_metrics(stacked, "label", "prediction", ["point", "fold"])
        means = per_fold.groupBy("point").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae")).collect()
    finally:
        used.unpersist()
    best = min(means, key=lambda r: (r[refit], r["point"]))["point"]
    rows = [(r["point"], str(dict(params[r["point"]])), r["rmse"], r["mae"], int(r["point"] == best)) for r in means]
    table = train.sparkSession.createDataFrame(rows, "point int, params string, rmse double, mae double, best int")
    return fit(name, train, label, features, params[best]), table


# ---- inspection ----------------------------------------------------------------------------


def regressor(model: PipelineModel):
    return model.stages[-1]


def importances(model: PipelineModel, names: Sequence[str], spark=None, top: int | None = None) -> DataFrame:
    """(feature, importance) of a tree model, largest first, ties by name."""
    values = regressor(model).featureImportances.toArray()
    session = spark or _session()
    made = session.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")
    made = made.orderBy(F.desc("importance"), F.asc("feature"))
    return made.limit(top) if top else made


def coefficients(model: PipelineModel, names: Sequence[str], spark=None) -> DataFrame:
    """(term, coefficient) with the intercept as 'Intercept'."""
    stage = regressor(model)
    rows = [("Intercept", float(stage.intercept)), *[(n, float(v)) for n, v in zip(names, stage.coefficients.toArray())]]
    return (spark or _session()).createDataFrame(rows, "term string, coefficient double")


def effects_pct(model: PipelineModel, names: Sequence[str], spark=None) -> DataFrame:
    """(term, coefficient, effect_pct): percent change of the expected count per unit of the term."""
    return coefficients(model, names, spark).withColumn("effect_pct", 100 * (F.exp("coefficient") - 1))


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


# ---- Poisson -------------------------------------------------------------------------------


# What MLlib says of a singular or diverging fit.
UNFITTABLE = ("SingularMatrixException", "not positive definite", "singular", "NaN", "Infinity", "requirement failed")


def singular(e: Exception) -> bool:
    """Whether a solver on the JVM found a singular matrix, by the classes of the error and its causes."""
    cause, names = getattr(e, "java_exception", None), []
    while cause is not None:
        names.append(cause.getClass().getSimpleName())
        cause = cause.getCause()
    return "SingularMatrixException" in names


def _unfittable(e: Exception) -> bool:
    """Whether a fit failed by its data and not for lack of executors, memory or columns."""
    return any(mark in str(e) for mark in UNFITTABLE)


def poisson_steps(
    df: DataFrame, label: str, formulas: Sequence[Sequence[str]], domains: Mapping[str, Sequence] | None = None, fallback: float = 1e-4
) -> tuple[PipelineModel, list[str], float]:
    """Fit nested formulas in order; stop at the first failure and keep the last success.

    A formula is a list of terms; terms in ``domains`` enter as dummies. If not even the first one can
    be fitted, the largest is fitted with an L2 penalty. Returns (model, feature names, penalty);
    ``df`` must already hold the dummies (``poisson_table``).
    """
    domains = domains or {}

    def expand(terms: Sequence[str]) -> list[str]:
        out: list[str] = []
        for t in terms:
            out += [f"{t}_{v}" for v in list(domains[t])[1:]] if t in domains else [t]
        return out

    kept: tuple[PipelineModel, list[str], float] | None = None
    for terms in formulas:
        names = expand(terms)
        try:
            kept = (fit("poisson", df, label, names), names, 0.0)
        except Exception as e:
            if not _unfittable(e):
                raise
            log.warning("formula %s ends the sequence: %s", list(terms), str(e).split("\n")[0])
            break
    if kept is None:
        names = expand(formulas[-1])
        kept = (fit("poisson", df, label, names, {"alpha": fallback}), names, fallback)
    return kept


def poisson_table(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    return dummies(df, domains, drop_first=True)


def poisson_log_likelihood(model: PipelineModel, df: DataFrame, label: str) -> float:
    """Log-likelihood of a Poisson fit, read back from its AIC."""
    stage = regressor(model)
    summary = stage.evaluate(PipelineModel(stages=model.stages[:-1]).transform(df))
    k = len(stage.coefficients) + int(stage.getFitIntercept())
    # GeneralizedLinearRegressionSummary counts rank parameters in its AIC
    rank = summary.rank if summary.rank else k
    return (2 * rank - summary.aic) / 2
