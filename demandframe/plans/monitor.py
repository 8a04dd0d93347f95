"""The monitoring job: score scenarios, test every feature, raise alerts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandframe.functions.columns import flag
from demandframe.operators import drift
from demandframe.operators.lookup import stack_tables
from demandframe.operators.metrics import regression_metrics
from demandframe.operators.models import predict
from demandframe.operators.prep import align_columns
from demandframe.operators.typing import columns_of_kind
from demandframe.sources import tables as io
from demandframe.sources.publish import JobOutput, load_models, published


def aligned(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Dummies of text columns, then exactly the model's features and the target.

    The levels are those that the features name (``column_level``), not those seen in ``df``: a level that was the base in
    training has zeros everywhere, also where the table holds no such row, and no job is run to look.
    """
    text = sorted(columns_of_kind(df, "text"), key=len)
    missing = [f for f in features if f not in df.columns]
    new = {f: flag(F.col(c) == f[len(c) + 1 :]) for c in text for f in missing if f.startswith(f"{c}_")}
    return align_columns(df.withColumns(new) if new else df, [*features, target])


def scenario_summary(
    base: DataFrame, scenarios: Mapping[str, DataFrame] | DataFrame, model: PipelineModel, features: list[str], target: str
) -> DataFrame:
    """(scenario, rmse, mae, r2, delta_*, alert): all scenarios are scored and aggregated in one job.

    ``scenarios`` are tables by name, or one table of all with a column ``scenario``, as ``drift.perturbed`` makes it.
    """
    if isinstance(scenarios, DataFrame):
        stacked = aligned(scenarios, [*features, "scenario"], target)
    else:
        stacked = stack_tables(*[aligned(t, features, target).withColumn("scenario", F.lit(name)) for name, t in scenarios.items()])
    summary = drift.scenario_metrics(predict(stacked, model), target, "prediction")
    baseline = regression_metrics(predict(aligned(base, features, target), model), target, "prediction")
    return drift.alert_level(drift.delta_vs_baseline(summary, baseline))


def feature_reports(base: DataFrame, scenarios: Mapping[str, DataFrame] | DataFrame, target: str) -> DataFrame:
    """(scenario, feature, kind, statistic, p_value, drift_detected); the base is counted once for all scenarios."""
    return drift.scenario_reports(base, scenarios, target)


def run(
    spark: SparkSession, base: str, scenarios: Mapping[str, str], models: str, target: str, label: str, model: str | None = None
) -> DataFrame:
    """Monitor a published model: ``base`` and each scenario are Parquet paths, ``models`` is where the job "train" published.

    ``model`` names the model (default: the best by its comparison), which must take finished columns. Publishes ``summary``
    and ``features`` as the job "monitor" in ``target``; returns the published summary.
    """
    name = model or published(spark, models, "train")["facts"]["best"]
    fitted = load_models(spark, models)
    if name not in fitted:
        raise ValueError(f"no model {name!r} in {models}, but {sorted(fitted)}")
    first = fitted[name].stages[0]
    if not isinstance(first, VectorAssembler):
        raise ValueError(f"model {name!r} prepares raw columns itself; its features have no columns to align")
    before = io.require_rows(io.read_table(spark, base), base)
    after = {n: io.require_rows(io.read_table(spark, path), path) for n, path in scenarios.items()}
    out = JobOutput(spark, target, "monitor")
    summary = out.table("summary", scenario_summary(before, after, fitted[name], first.getInputCols(), label))
    out.table("features", feature_reports(before, after, label))
    out.publish({"model": name})
    return summary
