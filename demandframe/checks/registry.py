"""Queries over the sample tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("customer", "orders", "lineitem", "part", "events", "embeddings", "nation", "region", "supplier", "documents", "labels")


class Tables:
    """The sample tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, text: str) -> DataFrame:
        """A fixture: SQL that both engines read, with ``{table}`` for table names."""
        used = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


def plain(text: str) -> str:
    """The same fixture with bare table names, for the comparing engine."""
    return text.format(**{n: n for n in TABLES})


@dataclass(frozen=True)
class Check:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in CHECKS:
            raise ValueError(f"{name} registered twice")
        CHECKS[name] = Check(name, fn, sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded at the edge, small integers widened as the SQL side gives them."""
    new = {f.name: F.round(f.name, digits) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(new) if new else df
