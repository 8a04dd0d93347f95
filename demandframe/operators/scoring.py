"""Batch scoring of request arrays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.operators.quality import validate_requests


def _vector_stages(model: Transformer) -> list[Transformer]:
    """The stages that work on the vector of a request's row: all behind the assembler that would make it."""
    if not isinstance(model, PipelineModel):
        return [model]
    stages = list(model.stages)
    if stages and isinstance(stages[0], VectorAssembler):
        stages = stages[1:]
    if not stages or any(not s.hasParam("inputCol") and not s.hasParam("featuresCol") for s in stages) or any(isinstance(s, VectorAssembler) for s in stages):
        raise ValueError("requests hold finished feature rows: only stages that take one vector can follow")
    return stages


def _linear(row: Column, model: LinearRegressionModel) -> Column:
    """The model's prediction for one feature row, as an expression."""
    weights = [float(w) for w in model.coefficients]
    total = reduce(lambda a, b: a + b, [F.get(row, F.lit(i)) * w for i, w in enumerate(weights)], F.lit(0.0)) + float(model.intercept)
    odd = F.raise_error(F.lit(f"a feature row does not have the model's {len(weights)} numbers"))
    return F.when(F.size(row) == len(weights), total).when(row.isNotNull(), odd.cast("double"))


def score_requests(df: DataFrame, model: Transformer, request_id: str, features: str, keep: Sequence[str] = ()) -> DataFrame:
    """(request_id, keep…, predictions ARRAY in row order), one row per row of ``df``, whatever its id.

    A request is an array of feature rows in the order of the model's features. A request without rows has an empty array of
    predictions, a NULL one NULL. A linear model is an expression over the array: nothing is moved. For other models rows are
    scored as ordinary rows and put back per request by a key of the request's own, so equal or NULL ids don't meet and
    a group is no larger than one request.
    """
    stages = _vector_stages(model)
    kept = [request_id, *keep]
    named = {c: f"_kept_{i}" for i, c in enumerate(kept)}
    asked = df.select(*[F.col(c).alias(n) for c, n in named.items()], F.col(features).alias("_rows"))
    answers = lambda found, p: found.select(*[F.col(n).alias(c) for c, n in named.items()], p.cast("array<double>").alias("predictions"))
    if len(stages) == 1 and isinstance(stages[0], LinearRegressionModel):
        return answers(asked, F.transform("_rows", lambda r: _linear(r, stages[0])))
    first = stages[0]
    vector = first.getInputCol() if first.hasParam("inputCol") else first.getFeaturesCol()
    some = F.coalesce(F.size("_rows") > 0, F.lit(False))
    told_apart = asked.where(some).withColumn("_request", F.monotonically_increasing_id())
    rows = told_apart.select("_request", *named.values(), F.posexplode("_rows").alias("_pos", "_row"))
    scored = rows.withColumn(vector, array_to_vector("_row"))
    for stage in stages:
        scored = stage.transform(scored)
    made = stages[-1].getPredictionCol()
    pair = F.struct("_pos", F.col(made).alias("p"))
    back = scored.groupBy("_request").agg(*[F.first(n).alias(n) for n in named.values()], F.sort_array(F.collect_list(pair)).alias("_pairs"))
    none = answers(asked.where(~some), F.when(F.col("_rows").isNotNull(), F.array()))
    return answers(back, F.transform("_pairs", lambda x: x["p"])).union(none)


def answer_requests(df: DataFrame, model: Transformer, request_id: str, features: str, n_features: int | None = None) -> DataFrame:
    """Every request with status, error and (for valid ones) predictions. Requests are told apart even if their ids are equal or NULL."""
    checked = validate_requests(df, features, n_features)
    good = score_requests(checked.where("status = 200"), model, request_id, features, ["status", "error"])
    bad = checked.where("status <> 200").select(request_id, "status", "error", F.lit(None).cast("array<double>").alias("predictions"))
    return good.select(request_id, "status", "error", "predictions").unionByName(bad)
