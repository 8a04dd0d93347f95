"""Outputs of a job, published as a whole.

A job writes its tables and models into a fresh folder and appends one row that names them to the manifest, as its last step.
Readers go by the manifest, so they see the outputs of a finished job or those of the one before it, never a mixture; a job
that dies half way leaves a folder that nothing names.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from demandframe.sources import tables as io

MANIFEST = "job string, run string, finished_ms bigint, folder string, tables array<string>, models array<string>, facts map<string,string>"


class JobOutput:
    """The outputs of one run of a job, under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, job: str):
        self.spark, self.root, self.job, self.run = spark, folder.rstrip("/"), job, uuid.uuid4().hex
        self.folder = f"{self.root}/{job}-{self.run}"
        self._tables: list[str] = []
        self._models: list[str] = []

    def table(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a table and give it back as read from the file."""
        io.write_table(df, f"{self.folder}/{name}", partition_by=partition_by, mode="errorifexists")
        self._tables.append(name)
        return io.read_table(self.spark, f"{self.folder}/{name}")

    def model(self, name: str, model: PipelineModel) -> None:
        model.write().save(f"{self.folder}/models/{name}")
        self._models.append(name)

    def publish(self, facts: Mapping[str, str] | None = None) -> Row:
        """Name the outputs in the manifest: the moment from which readers see them."""
        row = (self.job, self.run, time.time_ns() // 1_000_000, self.folder, self._tables, self._models, dict(facts or {}))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return published(self.spark, self.root, self.job, self.run)


def published(spark: SparkSession, folder: str, job: str, run: str | None = None) -> Row:
    """The manifest row of the run of this job that finished last (or of ``run``); FileNotFoundError if there is none."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{folder.rstrip('/')}/manifest").where(F.col("job") == job)
        last = (rows.where(F.col("run") == run) if run else rows).orderBy(F.desc("finished_ms"), F.desc("run")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = None
    if last is None:
        raise FileNotFoundError(f"no finished {job} job in {folder}")
    return last


def read_output(spark: SparkSession, folder: str, job: str, name: str) -> DataFrame:
    """A table of the run that finished last."""
    row = published(spark, folder, job)
    if name not in row["tables"]:
        raise FileNotFoundError(f"the {job} job in {folder} has no table {name!r}, but {row['tables']}")
    return io.read_table(spark, f"{row['folder']}/{name}")


def load_models(spark: SparkSession, folder: str, job: str = "train") -> dict[str, PipelineModel]:
    """The models of the run that finished last, by name."""
    row = published(spark, folder, job)
    return {name: io.load_model(f"{row['folder']}/models/{name}") for name in row["models"]}
