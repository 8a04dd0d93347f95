"""Train every configured model, score it on every split, rank."""

from __future__ import annotations

import logging
from collections.abc import Mapping

import numpy as np
from pyspark.errors import IllegalArgumentException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandframe.operators import metrics as m
from demandframe.operators import fold_search, models
from demandframe.operators.prep import TablePrep, impute_median
from demandframe.sources import tables as io
from demandframe.sources.publish import JobOutput, load_models, read_output

log = logging.getLogger(__name__)

# Default hyper-parameter grids.
ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
DEFAULT_CONFIG = {
    "linear": {"enabled": True, "method": "grid", "folds": 5, "grid": {"fit_intercept": [True, False]}},
    "ridge": {
        "enabled": True, "method": "random", "n_iter": 20, "folds": 5,
        "grid": {"alpha": ALPHAS, "fit_intercept": [True, False], "max_iter": [1000, 5000, 10000]},
    },
    "lasso": {
        "enabled": True, "method": "random", "n_iter": 20, "folds": 5,
        "grid": {"alpha": ALPHAS, "fit_intercept": [True, False], "max_iter": [1000, 5000, 10000]},
    },
    "elasticnet": {
        "enabled": True, "method": "random", "n_iter": 30, "folds": 5,
        "grid": {
            "alpha": [0.001, 0.01, 0.1, 1.0, 10.0], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9],
            "fit_intercept": [True, False], "max_iter": [1000, 5000],
        },
    },
    "random_forest": {
        "enabled": False, "method": "grid", "folds": 3,
        "grid": {"n_estimators": [50, 100, 200], "max_depth": [10, 20, 30], "min_samples_leaf": [1, 2, 4]},
    },
    "gradient_boosting": {
        "enabled": False, "method": "grid", "folds": 3,
        "grid": {"n_estimators": [100, 200], "learning_rate": [0.01, 0.1, 0.2], "max_depth": [3, 5, 7], "subsample": [0.8, 1.0]},
    },
    "boosted": {
        "enabled": True, "method": "random", "n_iter": 30, "folds": 3,
        "grid": {
            "n_estimators": [100, 200, 500, 1000], "learning_rate": [0.01, 0.05, 0.1, 0.2], "max_depth": [3, 5, 7, 9],
            "min_child_weight": [1, 3, 5], "gamma": [0, 0.1, 0.2], "subsample": [0.7, 0.8, 0.9, 1.0],
            "colsample_bytree": [0.6, 0.7, 0.8, 0.9], "random_state": [42],
        },
    },
}


# What an unfit model or wrong settings raise; a lost executor or a full disk is neither, and stops the job.
OWN_FAULTS = (ValueError, KeyError, TypeError, np.linalg.LinAlgError, IllegalArgumentException)


def train_models(
    config: Mapping[str, Mapping], table: DataFrame, label: str, order: str, split: str = "split", seed: int = 42, prep: TablePrep | None = None
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """(models by name, metrics per model and split, status per model).

    ``table`` holds all splits, the label, the order column and the features (everything else). Without ``prep`` missing feature
    values get training medians first; with it the features are its raw columns, prepared anew in every fold of a search
    and kept with the model. The status table has (model, status, message): trained, disabled, or failed by its data or
    settings. Every other error stops the job.
    """
    if prep is None:
        features = [c for c in table.columns if c not in (label, order, split)]
        table = impute_median(table, features, split)
    table = table.persist()
    fitted: dict[str, PipelineModel] = {}
    status: list[tuple[str, str, str]] = []
    try:
        train = table.where(F.col(split) == "train")
        folded: dict[int, DataFrame] = {}
        for name, job in config.items():
            if not job.get("enabled", True):
                status.append((name, "disabled", ""))
                continue
            try:
                k = job.get("folds", 5)
                if k not in folded:
                    folded[k] = models.with_folds(train, order, k)
                kind, method, n_iter = job.get("model", name), job.get("method", "grid"), job.get("n_iter", 10)
                if prep is None:
                    model, _ = models.search(kind, job["grid"], folded[k], label, features, k, method, n_iter, seed)
                else:
                    model, _ = fold_search.search(kind, job["grid"], folded[k], label, prep, method, n_iter, seed)
            except Exception as e:
                if not isinstance(e, OWN_FAULTS) and not models.singular(e):
                    raise
                log.exception("model %s failed and is left out", name)
                status.append((name, "failed", f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"))
                continue
            fitted[name] = model
            status.append((name, "trained", ""))
        if not fitted:
            raise ValueError(f"no model could be trained: {status}")
        values = evaluate_models(fitted, table, label, split).collect()
    finally:
        table.unpersist()
    session = table.sparkSession
    rows = [(r["model"], r[split], r["n"], r["rmse"], r["mae"], r["r2"], r["mape"]) for r in values]
    schema = f"model string, {split} string, n bigint, rmse double, mae double, r2 double, mape double"
    return fitted, session.createDataFrame(rows, schema), session.createDataFrame(status, "model string, status string, message string")


def train_all(
    config: Mapping[str, Mapping], table: DataFrame, label: str, order: str, split: str = "split", seed: int = 42
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """``train_models`` without its status table."""
    fitted, scores, _ = train_models(config, table, label, order, split, seed)
    return fitted, scores


def evaluate_models(fitted: Mapping[str, PipelineModel], table: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Metrics per model and split: one scan is scored by every model, then aggregated once."""
    scored, cells = table, []
    for i, (name, model) in enumerate(fitted.items()):
        scored = models.predict(scored, model, f"_p{i}")
        cells.append(F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("prediction")))
    rows = scored.select(split, label, F.inline(F.array(*cells)))
    return m.metrics_by_split(rows, label, "prediction", split, ["model"])


def ranking(metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(comparison table, best row by test error)."""
    table = m.comparison_table(metrics)
    return table, m.best_model(table)


def run(
    spark: SparkSession, source: str, target: str, label: str, order: str, config: Mapping[str, Mapping] = DEFAULT_CONFIG, split: str = "split",
    seed: int = 42, prep: TablePrep | None = None,
) -> DataFrame:
    """Train from the splits that the job "prepare" published in ``source``; publish models, ``metrics``, ``status``, ``comparison`` and
    ``best`` as the job "train" in ``target``. Returns the published metrics."""
    table = io.require_rows(read_output(spark, source, "prepare", "splits"), source)
    fitted, scores, status = train_models(config, table, label, order, split, seed, prep)
    out = JobOutput(spark, target, "train")
    for name, model in fitted.items():
        out.model(name, model)
    written = out.table("metrics", scores)
    out.table("status", status)
    comparison, best = ranking(written)
    out.table("comparison", comparison)
    out.publish({"best": out.table("best", best).first()["Model"]})
    return written


def compare_saved(spark: SparkSession, folder: str, test: DataFrame, label: str, job: str = "train") -> DataFrame:
    """(model, n, rmse, mae) on ``test`` of every model that the job published, the smallest error first: the table is read once."""
    fitted = load_models(spark, folder, job)
    whole = test.withColumn("_all", F.lit("test"))
    return evaluate_models(fitted, whole, label, "_all").select("model", "n", "rmse", "mae").orderBy("rmse", "model")
