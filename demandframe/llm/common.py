"""Small helpers of the text operators: shared folder, materialised tables, key columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. One is made only for a local session that names none."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str = "part", *folders: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage, survives lost executors.

    ``folders``: columns whose values get a folder each, so that a filter on them reads nothing else.
    """
    path = new_path(df.sparkSession, what)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


def fresh(taken: list[str], *names: str) -> list[str]:
    """Helper column names that clash with none of the taken ones."""
    low, out = {t.lower() for t in taken}, []
    for n in names:
        while n.lower() in low:
            n = f"_{n}"
        low.add(n.lower())
        out.append(n)
    return out


_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]):
    """What ``make`` returns, kept by a Python worker for its later tasks, but only until it is asked for another key.

    Spark gives the same workers to one stage after the other, so that what each of them kept would add up.
    """
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Lets go of what ``held`` keeps, before work that needs memory of its own."""
    _HELD.clear()
