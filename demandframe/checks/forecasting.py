"""Daily series, decomposition and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.checks.registry import Tables, check, rounded
from demandframe.operators import series
from demandframe.operators.metrics import regression_metrics

FIRST = """SELECT CAST(o_orderdate AS DATE) AS ds, arg_min(o_totalprice, o_orderkey) AS y FROM orders GROUP BY 1"""
BOUNDS = {"train": (None, "2000-06-30"), "valid": ("2000-07-01", "2000-12-31"), "test": ("2001-01-01", "2001-12-31")}


def _first(t: Tables) -> DataFrame:
    return series.daily_first(t.orders, "o_orderdate", "o_totalprice", "o_orderkey")


def _sums(t: Tables, keys: list[str] | None = None) -> DataFrame:
    return series.daily_agg(t.orders, "o_orderdate", "o_totalprice", "sum", keys or [])


@check(
    "daily_first",
    """SELECT CAST(o_orderdate AS DATE) AS ds, first(y ORDER BY o_orderkey) AS y
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS y FROM orders)
       WHERE o_orderdate IS NOT NULL GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    x = t.orders.select("o_orderkey", F.when(k % 5 != 0, F.col("o_orderdate")).alias("d"), F.when(k % 7 != 0, F.col("o_totalprice")).alias("y"))
    return series.daily_first(x, "d", "y", "o_orderkey")


@check(
    "daily_agg",
    """SELECT CAST(o_orderdate AS DATE) AS ds, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean, round(quantile_cont(o_totalprice, 0.5), 4) AS median
       FROM orders GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    named = {"sum": "total", "mean": "mean", "median": "median"}
    parts = [series.daily_agg(t.orders, "o_orderdate", "o_totalprice", fn).withColumnRenamed("y", c) for fn, c in named.items()]
    out = parts[0].join(parts[1], "ds").join(parts[2], "ds")
    return out.select("ds", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"))


GRID = """g AS (SELECT CAST(unnest(generate_series(CAST(min(ds) AS TIMESTAMP), CAST(max(ds) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ds FROM f),
          r AS (SELECT g.ds, f.y FROM g LEFT JOIN f ON g.ds = f.ds)"""


@check("regular_grid", f"WITH f AS ({FIRST}), {GRID} SELECT ds, y FROM r")
def _(t: Tables) -> DataFrame:
    return series.regular_grid(_first(t))


SUMS_BY = "SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 1, 2"
GRID_BY = f"""f AS ({SUMS_BY}),
  g AS (SELECT o_orderpriority, CAST(unnest(generate_series(CAST(min(ds) AS TIMESTAMP), CAST(max(ds) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ds FROM f GROUP BY 1),
  r AS (SELECT g.o_orderpriority, g.ds, f.y FROM g LEFT JOIN f ON g.ds = f.ds AND g.o_orderpriority = f.o_orderpriority)"""


@check("regular_grid_keyed", f"WITH {GRID_BY} SELECT o_orderpriority, ds, round(y, 2) AS y FROM r")
def _(t: Tables) -> DataFrame:
    return rounded(series.regular_grid(_sums(t, ["o_orderpriority"]), keys=["o_orderpriority"]), 2)


@check("resample_month", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return rounded(series.resample_month(t.orders, "o_orderdate", "o_totalprice"), 2)


@check(
    "month_subseries",
    """SELECT month(m) AS month_of_year, count(*) AS n, round(avg(y), 4) AS mean_y FROM (SELECT date_trunc('month', o_orderdate) AS m, sum(o_totalprice) AS y FROM orders GROUP BY 1) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return rounded(series.month_subseries(series.resample_month(t.orders, "o_orderdate", "o_totalprice")), 4)


LABEL = """CASE WHEN ds <= DATE '2000-06-30' THEN 'train' WHEN ds BETWEEN DATE '2000-07-01' AND DATE '2000-12-31' THEN 'valid'
                WHEN ds BETWEEN DATE '2001-01-01' AND DATE '2001-12-31' THEN 'test' END AS split"""


@check("split_by_date", f"WITH f AS ({FIRST}) SELECT ds, y, {LABEL} FROM f")
def _(t: Tables) -> DataFrame:
    return series.split_by_date(_first(t), "ds", BOUNDS)


NAIVE = f"""WITH f AS ({FIRST}), {GRID}, s AS (SELECT *, {LABEL} FROM r WHERE y IS NOT NULL),
  n AS (SELECT ds, y, split, lag(y) OVER (ORDER BY ds) AS yhat FROM s WHERE split IN ('train', 'test')), o AS (SELECT * FROM n WHERE split = 'test')"""


def _naive(t: Tables) -> DataFrame:
    x = series.split_by_date(series.regular_grid(_first(t)), "ds", BOUNDS).where("y IS NOT NULL")
    return series.naive_forecast(x, "ds", "y")


@check("naive_forecast", f"{NAIVE} SELECT * FROM o")
def _(t: Tables) -> DataFrame:
    return _naive(t)


@check("naive_forecast_score", f"{NAIVE} SELECT count(*) AS n, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse, round(avg(abs(y - yhat)), 4) AS mae FROM o")
def _(t: Tables) -> DataFrame:
    return rounded(regression_metrics(_naive(t), "y", "yhat").select("n", "rmse", "mae"), 4)


DECOMPOSED = """x AS (SELECT $K ds, coalesce(y, 0) AS y, row_number() OVER ($P ORDER BY ds) - 1 AS t FROM r),
  tr AS (SELECT *, CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS trend FROM x WINDOW w AS ($P ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
  ph AS (SELECT $K t % 7 AS p, avg(y - trend) AS m FROM tr GROUP BY ALL), se AS (SELECT $K p, m - avg(m) OVER ($P) AS s FROM ph)
  SELECT $T tr.ds, round(y, 2) AS y, round(trend, 2) AS trend, round(s, 2) AS seasonal, round(y - trend - s, 2) AS resid FROM tr JOIN se ON tr.t % 7 = se.p $J"""


def _decomposed(keyed: bool) -> str:
    fill = {"$K": "o_orderpriority, ", "$P": "PARTITION BY o_orderpriority", "$T": "tr.o_orderpriority, ", "$J": "AND tr.o_orderpriority = se.o_orderpriority"}
    out = DECOMPOSED
    for k, v in fill.items():
        out = out.replace(k, v if keyed else "")
    return out


@check("decompose", f"WITH f AS (SELECT CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 1), {GRID}, {_decomposed(False)}")
def _(t: Tables) -> DataFrame:
    x = series.regular_grid(_sums(t)).fillna(0.0, ["y"])
    return rounded(series.decompose(x, "ds", "y", 7), 2)


@check("decompose_keyed", f"WITH {GRID_BY}, {_decomposed(True)}")
def _(t: Tables) -> DataFrame:
    x = series.regular_grid(_sums(t, ["o_orderpriority"]), keys=["o_orderpriority"]).fillna(0.0, ["y"])
    return rounded(series.decompose(x, "ds", "y", 7, ["o_orderpriority"]), 2)
