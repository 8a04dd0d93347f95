"""Reading and writing tables, metric documents and fitted models."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the raw hourly table.
RAW_COLUMNS = [
    "instant", "dteday", "season", "yr", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit",
    "temp", "atemp", "hum", "windspeed", "casual", "registered", "cnt", "mixed_type_col",
]


def read_csv_text(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """CSV with header, every column as text: no inference pass, and dirty values survive.

    Columns are addressed by name, so the order in the file does not matter.
    """
    try:
        df = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"input not found: {path}") from e
        raise
    if not df.columns:
        raise ValueError(f"input is empty: {path}")
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"input not found: {path}") from e
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise ValueError(f"input is empty: {path}") from e
        raise


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """The table itself, or ValueError if it has no row. Looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"{what} contains no data")
    return df


def with_file_order(df: DataFrame, out: str = "row_order") -> DataFrame:
    """Order of lines for a source that has no order column. Only right for a single file."""
    return df.withColumn(out, F.monotonically_increasing_id())


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_splits(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """All splits as one table partitioned by split: one write, and a filter reads one folder."""
    write_table(df, path, fmt, [split])


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    return read_table(spark, path).where(F.col(split) == name).drop(split)


def write_metrics_document(document: DataFrame, path: str) -> None:
    """A one-row nested table as JSON."""
    document.coalesce(1).write.mode("overwrite").json(path)


def read_metrics_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_models(models: Mapping[str, PipelineModel], folder: str) -> None:
    for name, model in models.items():
        save_model(model, f"{folder}/{name}")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate data that all executors reach: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on one machine (tests) a local folder is made.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    import tempfile

    return tempfile.mkdtemp(prefix="demandframe-")


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A path that nothing uses yet, in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)
