"""Tables about model runs: leaderboard, promotion, versions, ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.functions import columns as fc

# Promotion thresholds (rmse strictly below, r2 strictly above).
THRESHOLDS = {"rmse": 100.0, "r2": 0.5}

# What stands for a missing metric, so that it never wins.
WORST = {"test_rmse": float("inf"), "test_mae": float("inf"), "test_r2": float("-inf"), "valid_rmse": float("inf")}


def with_worst(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in WORST.items() if c in df.columns})


def metric_fallback(*candidates: Column | str, default: float | None = None) -> Column:
    """First candidate that is neither missing nor zero; NaN if none (or ``default``)."""
    usable = [F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(0.0)) for c in candidates]
    return F.coalesce(*usable, F.lit(float("nan") if default is None else default))


def local_metrics(df: DataFrame) -> DataFrame:
    """Normalise a locally stored metrics table: new names first, old names as fallback.

    Columns that the table does not have count as missing.
    """
    def use(*names: str, default: float | None = None) -> Column:
        have = [n for n in names if n in df.columns] or [F.lit(None).cast("double")]
        return metric_fallback(*have, default=default)

    return df.withColumns(
        {
            "test_rmse": use("test_rmse", "rmse"),
            "test_mae": use("test_mae", "mae"),
            "test_r2": use("test_r2", "r2"),
            "valid_rmse": use("valid_rmse", default=float("inf")),
        }
    )


def leaderboard(metrics: DataFrame, local: DataFrame | None = None, n: int = 5, by: str = "test_rmse") -> DataFrame:
    """Best ``n`` tracked runs, plus every local model, ordered by the test error.

    ``metrics``: run_id, run_name, test_rmse, test_mae, test_r2, valid_rmse. Missing metrics count
    as the worst value. Ties are broken by run_id. NaN sorts last.
    """
    cols = ["model_type", "run_name", "run_id", "test_rmse", "test_mae", "test_r2", "valid_rmse"]
    runs = with_worst(metrics).withColumn("model_type", F.lit("tracked"))
    board = runs.orderBy(F.asc(by), F.asc("run_id")).limit(n).withColumn("run_id", F.substring("run_id", 1, 8)).select(*cols)
    if local is not None:
        board = board.unionByName(local_metrics(local).withColumn("model_type", F.lit("local")).select(*cols))
    return board.orderBy(F.asc(by), F.asc("run_id"))


def promote(board: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS, by: str = "test_rmse") -> DataFrame:
    """The best row with a ``promoted`` flag: test rmse below and test r2 above the thresholds."""
    best = board.orderBy(F.asc(by), F.asc("run_id")).limit(1)
    ok = (F.col("test_rmse") < thresholds["rmse"]) & (F.col("test_r2") > thresholds["r2"]) & ~F.isnan("test_rmse") & ~F.isnan("test_r2")
    return best.withColumn("promoted", fc.flag(ok))


def latest_versions(versions: DataFrame, name: str = "name", stage: str = "stage", version: str = "version", times: Sequence[str] = ("created_ms", "updated_ms")) -> DataFrame:
    """Newest version per (name, stage) with epoch milliseconds turned into UTC timestamps."""
    rest = [c for c in versions.columns if c not in (name, stage)]
    newest = versions.groupBy(name, stage).agg(F.max_by(F.struct(*rest), F.col(version)).alias("v")).select(name, stage, "v.*")
    return newest.select(*[fc.epoch_ms_to_utc(c).alias(c.removesuffix("_ms")) if c in times else F.col(c) for c in newest.columns])


def parse_model_id(df: DataFrame, c: str) -> DataFrame:
    """Add model_name, model_ref (stage or version) and error for ids of the form ``name:ref``."""
    name, ref, ok = fc.two_parts(c)
    return df.withColumns(
        {"model_name": name, "model_ref": ref, "error": F.when(~ok, F.lit("model id must be name:stage_or_version"))}
    )
