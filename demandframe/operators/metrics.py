"""Regression metrics and model comparison tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("rmse", "mae", "r2", "mape")


def metric_columns(y: str, yhat: str) -> dict[str, Column]:
    """All metrics as aggregates of one pass; total variance comes from the mergeable ``var_pop``."""
    a, p = F.col(y).cast("double"), F.col(yhat).cast("double")
    err = a - p
    n = F.count("*")
    sse = F.sum(err * err)
    sst = F.var_pop(a) * n
    share = F.avg(F.when(a != 0, F.abs(err / a)))
    return {
        "n": n,
        "rmse": F.sqrt(sse / n),
        "mae": F.avg(F.abs(err)),
        "r2": F.when(sst > 0, 1 - sse / sst).when(sse == 0, 1.0).otherwise(F.when(n > 0, 0.0)),
        "mape": F.when(n > 0, F.coalesce(share * 100, F.lit(float("inf")))),
    }


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, n, rmse, mae, r2, mape) over the rows where both values are present.

    mape is in percent over rows with y <> 0, infinite if there are none. With constant y, r2 is 1
    for an exact prediction and 0 otherwise.
    """
    known = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    return known.groupBy(*by).agg(*[e.alias(m) for m, e in metric_columns(y, yhat).items()])


def metrics_by_split(df: DataFrame, y: str, yhat: str, split: str = "split", by: Sequence[str] = ()) -> DataFrame:
    return regression_metrics(df, y, yhat, [*by, split])


def metrics_long(metrics: DataFrame, ids: Sequence[str] = ("model", "split")) -> DataFrame:
    """(ids…, metric, value)."""
    return metrics.select(*ids, *METRICS).unpivot(list(ids), list(METRICS), "metric", "value")


def comparison_table(
    metrics: DataFrame, model: str = "model", split: str = "split", splits: Sequence[str] = ("train", "valid", "test"), which: Sequence[str] = ("rmse", "mae", "r2")
) -> DataFrame:
    """One row per model with a column ``<Split>_<METRIC>`` for each split and metric."""
    cells = [
        F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s.capitalize()}_{m.upper()}") for s in splits for m in which
    ]
    return metrics.groupBy(F.col(model).alias("Model")).agg(*cells)


def best_model(comparison: DataFrame, metric: str = "Test_RMSE", tie: str = "Model") -> DataFrame:
    """The row with the smallest metric; missing metrics never win."""
    return comparison.where(F.col(metric).isNotNull()).orderBy(F.asc(metric), F.asc(tie)).limit(1)


def residuals(df: DataFrame, y: str, yhat: str, out: str = "residual") -> DataFrame:
    return df.withColumn(out, F.col(y) - F.col(yhat))


def degradation(reference: DataFrame, current: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """(on…, rmse_ref, rmse_cur, rmse_delta, rmse_pct_increase); the percentage is NULL for rmse_ref <= 0.

    Without ``on`` both sides must be one row.
    """
    ref, cur = F.col("rmse_ref"), F.col("rmse_cur")
    if on:
        both = reference.select(*on, F.col("rmse").alias("rmse_ref")).join(
            current.select(*on, F.col("rmse").alias("rmse_cur")), list(on)
        )
    else:
        both = current.select(
            reference.select("rmse").scalar().alias("rmse_ref"), F.col("rmse").alias("rmse_cur")
        )
    return both.select(
        *on, "rmse_ref", "rmse_cur", (cur - ref).alias("rmse_delta"), F.when(ref > 0, (cur / ref - 1) * 100).alias("rmse_pct_increase")
    )


def poisson_evaluation(df: DataFrame, y: str, mu: str, llf: float | None = None) -> DataFrame:
    """One row: mae, rmse, mean, relative error in %, both errors over max(y), and the log-likelihood
    gain over the mean-only model. With the fitted log-likelihood also McFadden's pseudo-R²."""
    known = df.where(F.col(y).isNotNull() & F.col(mu).isNotNull())
    a, m = F.col(y).cast("double"), F.col(mu).cast("double")
    one = known.agg(
        F.avg(F.abs(a - m)).alias("mae"),
        F.sqrt(F.avg((a - m) * (a - m))).alias("rmse"),
        F.avg(a).alias("mean_y"),
        F.max(a).alias("max_y"),
        F.count("*").alias("n"),
        F.sum(a * F.log(m) - m).alias("fit_part"),
        F.sum(a).alias("sum_y"),
    )
    null_part = F.col("sum_y") * F.log("mean_y") - F.col("sum_y")
    gain = F.col("fit_part") - null_part
    full = F.lit(llf).cast("double")
    return one.select(
        "n",
        "mae",
        "rmse",
        (1 - full / (full - gain)).alias("pseudo_r2"),
        "mean_y",
        (F.col("mae") / F.col("mean_y") * 100).alias("relative_error_pct"),
        (F.col("mae") / F.col("max_y")).alias("mae_over_max"),
        (F.col("rmse") / F.col("max_y")).alias("rmse_over_max"),
        gain.alias("loglik_gain"),
    )


def dataset_summary(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """(split, samples, features)."""
    return df.groupBy(split).agg(F.count("*").alias("samples")).withColumn("features", F.lit(len(features)).cast("bigint"))


def metrics_document(reference: DataFrame, current: DataFrame, model_path: str, names: Sequence[str] = ("rmse", "mae", "r2")) -> DataFrame:
    """One nested row, ready to be written as a JSON document."""
    def block(t: DataFrame) -> Column:
        return t.select(F.struct(*names).alias("s")).scalar()

    change = degradation(reference, current).select("rmse_delta", "rmse_pct_increase")
    return change.select(
        F.lit(model_path).alias("model_path"),
        block(reference).alias("reference_metrics"),
        block(current).alias("drifted_metrics"),
        F.struct("rmse_delta", "rmse_pct_increase").alias("degradation"),
    )


def metric_rows(rows: Mapping[str, DataFrame]) -> DataFrame:
    """Metric tables of several models under one another, with a ``model`` column."""
    from demandframe.operators.lookup import stack_tables

    return stack_tables(*[t.withColumn("model", F.lit(name)) for name, t in rows.items()])
