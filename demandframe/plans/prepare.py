"""The preparation job: categories, split, dummies, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandframe.operators import prep
from demandframe.operators.typing import cast_columns, coerce_numeric, to_category
from demandframe.sources import tables as io
from demandframe.sources.publish import JobOutput


@dataclass(frozen=True)
class PrepareRules:
    """Column names of the preparation job. The defaults fit the cleaned hourly table."""

    key: str = "instant"
    domains: Mapping[str, Sequence] = field(
        default_factory=lambda: {"season": range(1, 5), "mnth": range(1, 13), "weekday": range(7), "weathersit": range(1, 5)}
    )
    integers: Sequence[str] = ("yr", "holiday", "workingday", "cnt", "registered", "casual", "instant", "mixed_type_col")
    doubles: Sequence[str] = ("temp", "atemp", "hum", "windspeed")
    drop: Sequence[str] = ("instant", "casual", "registered", "dteday")
    scale: Sequence[str] = ("temp", "atemp", "hum", "windspeed", "cnt")
    fractions: Mapping[str, float] = field(default_factory=lambda: {"train": 0.70, "valid": 0.15, "test": 0.15})
    seed: int = 333
    target: str = "cnt"


def converted(df: DataFrame, rules: PrepareRules = PrepareRules()) -> DataFrame:
    """Numbers where numbers belong, and category values outside their domain as NULL."""
    coded = [c for c, domain in rules.domains.items() if not any(isinstance(v, str) for v in domain)]
    whole = [c for c in [*rules.integers, *coded] if c in df.columns]
    df = coerce_numeric(df, [*whole, *rules.doubles])
    df = df.withColumns({c: F.col(c).cast("bigint") for c in whole})
    for c, domain in rules.domains.items():
        if c in df.columns:
            df = to_category(df, c, domain)
    return cast_columns(df, double=[c for c in rules.doubles if c in df.columns])


def split_table(df: DataFrame, rules: PrepareRules = PrepareRules()) -> DataFrame:
    """Split label, redundant columns gone, dummies in place: one projection over the input."""
    marked = prep.split(df, rules.key, rules.fractions, rules.seed)
    kept = marked.drop(*rules.drop)
    return prep.dummies(kept, {c: d for c, d in rules.domains.items() if c in kept.columns})


def prepare(df: DataFrame, rules: PrepareRules = PrepareRules()) -> tuple[DataFrame, DataFrame]:
    """(prepared table with a ``split`` column, fitted scaler statistics).

    The scaler sees training rows only and scales the target too.
    """
    table = split_table(converted(df, rules), rules)
    cols = [c for c in rules.scale if c in table.columns]
    stats = prep.minmax_fit(table.where(F.col("split") == "train"), cols)
    return prep.minmax_apply(table, stats, cols), stats


def require_splits(counts: Mapping[str, int], names: Sequence[str]) -> None:
    """ValueError that names the splits without a row."""
    empty = [n for n in names if not counts.get(n)]
    if empty:
        raise ValueError(f"splits without rows: {empty}; the input has too few rows for them")


def run(spark: SparkSession, source: str, target: str, rules: PrepareRules = PrepareRules(), fmt: str = "parquet") -> DataFrame:
    """Prepare a cleaned table (``fmt`` parquet or csv) and publish ``splits`` (by split) and ``scaler`` as the job "prepare" in ``target``.

    A missing or empty source, or a split without rows, is an error, and nothing is published. Returns the published splits.
    """
    table = io.read_csv_text(spark, source) if fmt == "csv" else io.read_table(spark, source)
    made, stats = prepare(io.require_rows(table, source), rules)
    out = JobOutput(spark, target, "prepare")
    splits = out.table("splits", made, ("split",))
    counts = {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()}
    require_splits(counts, list(rules.fractions))
    out.table("scaler", stats)
    out.publish({f"rows_{name}": str(n) for name, n in sorted(counts.items())})
    return splits
