"""Daily time series: shaping, decomposition and naive forecasts.

After ``daily_first`` / ``daily_agg`` a series has one row per day, so its length is bounded by the
calendar; ordered steps still cut the days into blocks and never need a one-task window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.operators.ordered import Blocking, centered_mean, previous, row_index
from demandframe.operators.profile import quantiles

# one block per century
DAYS = Blocking(block_size=36525)
STEPS = Blocking(block_size=1_000_000)


# ---- shaping -------------------------------------------------------------------------------


def daily_first(df: DataFrame, date: str, y: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys…, ds, y): value of the first row of each day, NULL if that row's value is NULL."""
    day = F.col(date).cast("date").alias("ds")
    rows = df.select(*keys, day, F.col(y).cast("double").alias("y"), F.col(order).alias("_o")).where("ds IS NOT NULL")
    return rows.groupBy(*keys, "ds").agg(F.min_by("y", "_o").alias("y"))


def daily_agg(df: DataFrame, date: str, y: str, fn: str = "sum", keys: Sequence[str] = ()) -> DataFrame:
    """(keys…, ds, y) with fn one of sum, mean, median."""
    rows = df.select(*keys, F.col(date).cast("date").alias("ds"), F.col(y).cast("double").alias("y")).where("ds IS NOT NULL")
    if fn == "median":
        return quantiles(rows, ["y"], [0.5], [*keys, "ds"]).select(*keys, "ds", F.col("value").alias("y"))
    return rows.groupBy(*keys, "ds").agg({"sum": F.sum, "mean": F.avg}[fn]("y").alias("y"))


def regular_grid(df: DataFrame, ds: str = "ds", y: str = "y", keys: Sequence[str] = ()) -> DataFrame:
    """One row per day between the first and last day of each key; missing days have NULL."""
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    marked = df.withColumn("_key", key)
    ends = marked.groupBy("_key").agg(F.min(ds).alias("_lo"), F.max(ds).alias("_hi")).where("_lo IS NOT NULL")
    days = ends.select("_key", F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(ds))
    full = days.join(marked.select("_key", ds, y), ["_key", ds], "left")
    return full.select(*[F.col("_key").getField(k).alias(k) for k in keys], ds, y)


def resample_month(df: DataFrame, date: str, y: str, fn: str = "sum", keys: Sequence[str] = ()) -> DataFrame:
    """(keys…, month, y): month is its first day."""
    month = F.trunc(F.col(date).cast("date"), "month").alias("month")
    agg = {"sum": F.sum, "mean": F.avg}[fn]
    return df.where(F.col(date).isNotNull()).groupBy(*keys, month).agg(agg(F.col(y).cast("double")).alias("y"))


def month_subseries(monthly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys…, month_of_year, n, mean_y): what a month plot shows."""
    m = F.month("month").cast("bigint").alias("month_of_year")
    return monthly.groupBy(*keys, m).agg(F.count("y").alias("n"), F.avg("y").alias("mean_y"))


def split_by_date(df: DataFrame, ds: str, bounds: Mapping[str, tuple[str | None, str | None]], out: str = "split") -> DataFrame:
    """Label rows by date ranges, both ends inclusive; rows outside all ranges get NULL."""
    label = F.lit(None).cast("string")
    for name, (lo, hi) in reversed(list(bounds.items())):
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (F.col(ds) >= F.lit(lo).cast("date"))
        if hi is not None:
            inside = inside & (F.col(ds) <= F.lit(hi).cast("date"))
        label = F.when(inside, F.lit(name)).otherwise(label)
    return df.withColumn(out, label)


# ---- naive forecast and decomposition ------------------------------------------------------


def naive_forecast(
    df: DataFrame, ds: str, y: str, split: str = "split", keys: Sequence[str] = (), train: str = "train", test: str = "test", out: str = "yhat"
) -> DataFrame:
    """Walk-forward forecast: the first test day gets the last training value, later days the day before."""
    used = df.where(F.col(split).isin(train, test))
    return previous(used, y, ds, keys, out, DAYS).where(F.col(split) == test)


def decompose(df: DataFrame, ds: str, y: str, period: int = 7, keys: Sequence[str] = ()) -> DataFrame:
    """Additive decomposition of a regular series: trend, seasonal, resid columns.

    Trend is the centered moving average (NULL at both ends). The seasonal part is the mean of the
    detrended values per phase, shifted to mean zero.
    """
    placed = row_index(df, ds, keys, out="_t", blocking=DAYS).withColumn("_key", F.struct(*keys) if keys else F.lit(0))
    trended = centered_mean(placed, y, "_t", period, keys, "trend", STEPS)
    phase = F.pmod("_t", F.lit(period))
    means = trended.groupBy("_key", phase.alias("_phase")).agg(F.avg(F.col(y) - F.col("trend")).alias("_m"))
    centre = means.groupBy("_key").agg(F.avg("_m").alias("_c"))
    season = means.join(centre, "_key").select("_key", "_phase", (F.col("_m") - F.col("_c")).alias("seasonal"))
    out = trended.withColumn("_phase", phase).join(season, ["_key", "_phase"], "left")
    return out.select(*df.columns, "trend", "seasonal", (F.col(y) - F.col("trend") - F.col("seasonal")).alias("resid"))
