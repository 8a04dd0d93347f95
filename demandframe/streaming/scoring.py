"""The request path as a stream: validate, score, write; no state is kept between batches."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from demandframe.operators.scoring import answer_requests


def score_stream(
    stream: DataFrame, model: Transformer, request_id: str, features: str, path: str, checkpoint: str, n_features: int | None = None
) -> StreamingQuery:
    """Score everything available and stop. Each batch overwrites its own folder, so a batch that is
    run again after a failure does not write its answers twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        answers = answer_requests(batch, model, request_id, features, n_features)
        answers.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
