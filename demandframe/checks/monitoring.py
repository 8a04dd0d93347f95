"""Metrics, drift, experiment tables, request checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.checks.features import HALVES, split_sql
from demandframe.checks.registry import Tables, check, plain, rounded
from demandframe.operators import drift, experiments, quality
from demandframe.operators import metrics as m
from demandframe.operators.lookup import stack_tables
from demandframe.operators.ordered import Blocking

# ---- metrics -------------------------------------------------------------------------------

# Three simple forecasts of the line price: by its quantity, by the mean, and a poor one.
GUESSES = f"""
SELECT o_orderkey, {split_sql('o_orderkey')} AS split, model, y, yhat FROM (
  SELECT l_orderkey AS o_orderkey, CASE WHEN l_partkey % 23 = 0 THEN 0 ELSE l_extendedprice END AS y, 'by_quantity' AS model, 1500 * l_quantity AS yhat FROM {{lineitem}}
  UNION ALL SELECT l_orderkey, CASE WHEN l_partkey % 23 = 0 THEN 0 ELSE l_extendedprice END, 'flat', CAST(38000 AS DOUBLE) FROM {{lineitem}}
  UNION ALL SELECT l_orderkey, CASE WHEN l_partkey % 23 = 0 THEN 0 ELSE l_extendedprice END, 'poor', CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE 90000 - 1000 * l_quantity END FROM {{lineitem}}) z"""

METRIC_SQL = """count(*) AS n, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse, round(avg(abs(y - yhat)), 4) AS mae,
  round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs((y - yhat) / y)) FILTER (y <> 0) * 100, 4) AS mape"""


def _metric_digits(df: DataFrame) -> DataFrame:
    digits = {"rmse": 4, "mae": 4, "r2": 6, "mape": 4}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})


@check("regression_metrics", f"SELECT model, {METRIC_SQL} FROM ({plain(GUESSES)}) WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY model")
def _(t: Tables) -> DataFrame:
    return _metric_digits(m.regression_metrics(t.view(GUESSES), "y", "yhat", ["model"]))


@check(
    "regression_metrics_edge",
    """SELECT 'constant, exact' AS kind, count(*) AS n, 0.0::DOUBLE AS rmse, 0.0::DOUBLE AS mae, 1.0::DOUBLE AS r2, 0.0::DOUBLE AS mape FROM orders
       UNION ALL SELECT 'constant, off', count(*), 1.0, 1.0, 0.0, 20.0 FROM orders
       UNION ALL SELECT 'all zero', count(*), 1.0, 1.0, 0.0, 'infinity'::DOUBLE FROM orders""",
)
def _(t: Tables) -> DataFrame:
    def case(kind: str, y: float, p: float) -> DataFrame:
        return t.orders.select(F.lit(kind).alias("kind"), F.lit(y).alias("y"), F.lit(p).alias("p"))

    x = stack_tables(case("constant, exact", 5.0, 5.0), case("constant, off", 5.0, 6.0), case("all zero", 0.0, 1.0))
    return m.regression_metrics(x, "y", "p", ["kind"])


@check("metrics_by_split", f"SELECT model, split, {METRIC_SQL} FROM ({plain(GUESSES)}) WHERE yhat IS NOT NULL GROUP BY model, split")
def _(t: Tables) -> DataFrame:
    return _metric_digits(m.metrics_by_split(t.view(GUESSES), "y", "yhat", by=["model"]))


BY_SPLIT = f"s AS (SELECT model, split, {METRIC_SQL} FROM ({plain(GUESSES)}) WHERE yhat IS NOT NULL GROUP BY model, split)"


@check("metrics_long", f"WITH {BY_SPLIT} " + " UNION ALL ".join(f"SELECT model, split, '{k}' AS metric, {k} AS value FROM s" for k in m.METRICS))
def _(t: Tables) -> DataFrame:
    return m.metrics_long(_metric_digits(m.metrics_by_split(t.view(GUESSES), "y", "yhat", by=["model"])))


WIDE = ", ".join(f"max({k}) FILTER (split = '{s}') AS {s.capitalize()}_{k.upper()}" for s in ("train", "valid", "test") for k in ("rmse", "mae", "r2"))


@check("comparison_table", f'WITH {BY_SPLIT} SELECT model AS "Model", {WIDE} FROM s GROUP BY model')
def _(t: Tables) -> DataFrame:
    return m.comparison_table(_metric_digits(m.metrics_by_split(t.view(GUESSES), "y", "yhat", by=["model"])))


@check("best_model", f'WITH {BY_SPLIT}, c AS (SELECT model AS "Model", {WIDE} FROM s GROUP BY model) SELECT * FROM c ORDER BY Test_RMSE, "Model" LIMIT 1')
def _(t: Tables) -> DataFrame:
    return m.best_model(m.comparison_table(_metric_digits(m.metrics_by_split(t.view(GUESSES), "y", "yhat", by=["model"]))))


@check("residuals", f"SELECT o_orderkey, split, model, y, yhat, y - yhat AS residual FROM ({plain(GUESSES)})")
def _(t: Tables) -> DataFrame:
    return m.residuals(t.view(GUESSES), "y", "yhat")


@check(
    "degradation",
    f"""WITH {BY_SPLIT} SELECT a.model, a.rmse AS rmse_ref, b.rmse AS rmse_cur, round(b.rmse - a.rmse, 4) AS rmse_delta, round((b.rmse / a.rmse - 1) * 100, 6) AS rmse_pct_increase
        FROM s a JOIN s b ON a.model = b.model AND a.split = 'train' AND b.split = 'test'""",
)
def _(t: Tables) -> DataFrame:
    by = _metric_digits(m.metrics_by_split(t.view(GUESSES), "y", "yhat", by=["model"]))
    out = m.degradation(by.where("split = 'train'"), by.where("split = 'test'"), ["model"])
    return out.withColumns({"rmse_delta": F.round("rmse_delta", 4), "rmse_pct_increase": F.round("rmse_pct_increase", 6)})


@check(
    "metrics_document",
    f"""WITH {BY_SPLIT} SELECT 'models/by_quantity' AS model_path, a.rmse AS ref_rmse, a.mae AS ref_mae, a.r2 AS ref_r2, b.rmse AS cur_rmse, b.mae AS cur_mae, b.r2 AS cur_r2,
               round(b.rmse - a.rmse, 4) AS rmse_delta
        FROM s a JOIN s b ON a.model = b.model AND a.split = 'train' AND b.split = 'test' WHERE a.model = 'by_quantity'""",
)
def _(t: Tables) -> DataFrame:
    """The nested document, flattened for comparison."""
    by = _metric_digits(m.metrics_by_split(t.view(GUESSES).where("model = 'by_quantity'"), "y", "yhat"))
    doc = m.metrics_document(by.where("split = 'train'"), by.where("split = 'test'"), "models/by_quantity")
    pick = {"ref": "reference_metrics", "cur": "drifted_metrics"}
    return doc.select(
        "model_path", *[F.col(f"{block}.{k}").alias(f"{p}_{k}") for p, block in pick.items() for k in ("rmse", "mae", "r2")],
        F.round("degradation.rmse_delta", 4).alias("rmse_delta"),
    )


@check(
    "poisson_evaluation",
    """WITH x AS (SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS y, event_type FROM events),
            g AS (SELECT event_type, avg(y) AS mu FROM x GROUP BY event_type), z AS (SELECT y, mu FROM x JOIN g ON x.event_type = g.event_type),
            o AS (SELECT count(*) AS n, avg(abs(y - mu)) AS mae, sqrt(avg((y - mu) * (y - mu))) AS rmse, avg(y) AS mean_y, max(y) AS max_y,
                         sum(y * ln(mu) - mu) - (sum(y) * ln(avg(y)) - sum(y)) AS gain FROM z)
       SELECT n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(1 - (-5e6) / ((-5e6) - gain), 9) AS pseudo_r2, round(mean_y, 6) AS mean_y, round(mae / mean_y * 100, 6) AS relative_error_pct,
              round(mae / max_y, 6) AS mae_over_max, round(rmse / max_y, 6) AS rmse_over_max, round(gain, 3) AS loglik_gain FROM o""",
)
def _(t: Tables) -> DataFrame:
    x = t.events.select(F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("y"), "event_type")
    mu = x.groupBy("event_type").agg(F.avg("y").alias("mu"))
    out = m.poisson_evaluation(x.join(mu, "event_type"), "y", "mu", llf=-5e6)
    six = {c: F.round(c, 6) for c in ("mae", "rmse", "mean_y", "relative_error_pct", "mae_over_max", "rmse_over_max")}
    return out.withColumns({**six, "loglik_gain": F.round("loglik_gain", 3), "pseudo_r2": F.round("pseudo_r2", 9)})


@check("dataset_summary", f"SELECT split, count(*) AS samples, CAST(2 AS BIGINT) AS features FROM ({plain(GUESSES)}) GROUP BY split")
def _(t: Tables) -> DataFrame:
    return m.dataset_summary(t.view(GUESSES), ["quantity", "discount"])


# ---- drift tests ---------------------------------------------------------------------------

PARTS = """SELECT event_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, event_id % 10 = 0 AS tenth,
                  CASE WHEN day(ts) <= 15 THEN 'base' ELSE 'new' END AS half FROM {events}"""


def ks_sql(source: str, cols: list[str], factor: str = "1") -> str:
    """KS distance and asymptotic tail, per column of a table with a ``half`` column."""
    def one(c: str) -> str:
        return f"""SELECT '{c}' AS feature, v, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(b) AS DOUBLE) AS b FROM (
            SELECT CAST({c} AS DOUBLE) AS v, 1 AS a, 0 AS b FROM {source} WHERE half = 'base'
            UNION ALL SELECT CAST({c} * {factor} AS DOUBLE), 0, 1 FROM {source} WHERE half = 'new') WHERE v IS NOT NULL GROUP BY v"""

    return f"""u AS ({' UNION ALL '.join(one(c) for c in cols)}),
      c AS (SELECT feature, sum(a) OVER w / sum(a) OVER p AS fa, sum(b) OVER w / sum(b) OVER p AS fb, sum(a) OVER p AS na, sum(b) OVER p AS nb FROM u
            WINDOW w AS (PARTITION BY feature ORDER BY v), p AS (PARTITION BY feature)),
      d AS (SELECT feature, max(abs(fa - fb)) AS d, CAST(max(na) AS BIGINT) AS na, CAST(max(nb) AS BIGINT) AS nb FROM c GROUP BY feature),
      e AS (SELECT *, d * sqrt(na * nb / (na + nb)) AS t FROM d),
      f AS (SELECT feature, d, na, nb, t, 2 * sum((CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * i * i * t * t)) AS upper,
                   1 - sqrt(2 * pi()) / t * sum(exp(-(2 * i - 1) * (2 * i - 1) * pi() * pi() / (8 * t * t))) AS lower
            FROM e, (SELECT unnest(range(1, 101)) AS i) GROUP BY feature, d, na, nb, t),
      ks AS (SELECT feature, d AS statistic, na AS n_base, nb AS n_new,
                    CASE WHEN t <= 0.05 THEN 1.0 ELSE least(greatest(CASE WHEN t < 1.18 THEN lower ELSE upper END, 0.0), 1.0) END AS p_value FROM f)"""


KS_OUT = "SELECT feature, round(statistic, 6) AS statistic, n_base, n_new, round(p_value, 6) AS p_value, CAST(p_value < 0.05 AS INT) AS drift_detected FROM ks"


@check("ks_two_sample", f"WITH x AS ({plain(PARTS)}), {ks_sql('x', ['value', 'k'])} {KS_OUT}")
def _(t: Tables) -> DataFrame:
    x = t.view(PARTS)
    return rounded(drift.ks_two_sample(x.where("half = 'base'"), x.where("half = 'new'"), ["value", "k"]))


@check("ks_two_sample_blocks", f"WITH x AS ({plain(PARTS)}), {ks_sql('x', ['value', 'k'], 'CAST(1.1 AS DOUBLE)')} {KS_OUT}")
def _(t: Tables) -> DataFrame:
    """The new half raised by a tenth; distribution functions cut into many blocks."""
    x = t.view(PARTS)
    raised = x.where("half = 'new'").withColumns({"value": F.col("value") * 1.1, "k": F.col("k") * 1.1})
    blocks = Blocking(rows_per_block=1500, fraction=0.5)
    return rounded(drift.ks_two_sample(x.where("half = 'base'"), raised, ["value", "k"], blocking=blocks))


def chi2_sql(pairs: str, name: str) -> str:
    """Statistic and degrees of freedom from a (feature, r, c) table, every cell written out."""
    return f"""{name}_n AS (SELECT feature, r, c, count(*) AS n FROM {pairs} GROUP BY ALL),
      {name}_g AS (SELECT rr.feature, rr.r, cc.c, rr.nr, cc.nc, tt.nt, coalesce(n.n, 0) AS n
             FROM (SELECT feature, r, sum(n) AS nr FROM {name}_n GROUP BY ALL) rr JOIN (SELECT feature, c, sum(n) AS nc FROM {name}_n GROUP BY ALL) cc ON rr.feature = cc.feature
             JOIN (SELECT feature, sum(n) AS nt FROM {name}_n GROUP BY ALL) tt ON rr.feature = tt.feature
             LEFT JOIN {name}_n n ON n.feature = rr.feature AND n.r = rr.r AND n.c = cc.c),
      {name}_d AS (SELECT *, (count(DISTINCT r) OVER (PARTITION BY feature) - 1) * (count(DISTINCT c) OVER (PARTITION BY feature) - 1) AS dof FROM {name}_g),
      {name} AS (SELECT feature, sum(CASE WHEN dof = 1 THEN power(abs(n - nr * nc / nt) - least(0.5, abs(n - nr * nc / nt)), 2) ELSE power(n - nr * nc / nt, 2) END / (nr * nc / nt)) AS statistic,
                        max(dof) AS dof, CAST(sum(n) AS BIGINT) AS n FROM {name}_d GROUP BY feature)"""


# 5 % critical values of chi-square by degrees of freedom.
CRITICAL = {1: 3.841459, 2: 5.991465, 3: 7.814728, 4: 9.487729, 6: 12.591587, 8: 15.507313}
CRITICAL_SQL = "CASE dof " + " ".join(f"WHEN {k} THEN {v}" for k, v in CRITICAL.items()) + " END"


@check(
    "chi2_paired",
    f"""WITH h AS ({plain(PARTS)}), p AS (SELECT 'label' AS feature, event_type AS r, 'k' || CAST(k % 3 AS VARCHAR) AS c FROM h
                   UNION ALL SELECT 'same', CAST(tenth AS VARCHAR), CAST(tenth AS VARCHAR) FROM h), {chi2_sql('p', 'x')}
        SELECT feature, round(statistic, 4) AS statistic, dof, n, CAST(statistic > {CRITICAL_SQL} AS INT) AS drift_detected FROM x""",
)
def _(t: Tables) -> DataFrame:
    """Row-by-row pairs; the second feature pairs a column with itself, which counts as drift here."""
    x = t.view(PARTS)
    a = x.select("event_id", F.col("event_type").alias("label"), F.col("tenth").alias("same"))
    b = x.select("event_id", F.concat(F.lit("k"), (F.col("k") % 3).cast("string")).alias("label"), F.col("tenth").alias("same"))
    out = drift.chi2_paired(a, b, ["label", "same"], "event_id").drop("p_value")
    return out.withColumn("statistic", F.round("statistic", 4))


@check(
    "chi2_homogeneity",
    f"""WITH h AS ({plain(PARTS)}), p AS (SELECT 'event_type' AS feature, half AS r, event_type AS c FROM h
               UNION ALL SELECT 'tenth', half, CASE WHEN half = 'new' AND k > 50 THEN 'true' ELSE CAST(tenth AS VARCHAR) END FROM h), {chi2_sql('p', 'x')}
        SELECT feature, round(statistic, 6) AS statistic, dof, n, CAST(statistic > {CRITICAL_SQL} AS INT) AS drift_detected FROM x""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(PARTS)
    new = x.where("half = 'new'").withColumn("tenth", F.col("tenth") | (F.col("k") > 50))
    return rounded(drift.chi2_homogeneity(x.where("half = 'base'"), new, ["event_type", "tenth"]).drop("p_value"))


@check(
    "chi2_p_values",
    f"""WITH h AS ({plain(PARTS)}), p AS (SELECT 'event_type' AS feature, half AS r, event_type AS c FROM h
               UNION ALL SELECT 'third', half, CAST(k % 3 AS VARCHAR) FROM h), {chi2_sql('p', 'x')}
        SELECT feature, round(CASE dof WHEN 2 THEN exp(-statistic / 2) WHEN 4 THEN exp(-statistic / 2) * (1 + statistic / 2) END, 6) AS p_value FROM x""",
)
def _(t: Tables) -> DataFrame:
    """With two and four degrees of freedom the tail is a short closed form."""
    x = t.view(PARTS).withColumn("third", (F.col("k") % 3).cast("string"))
    out = drift.chi2_homogeneity(x.where("half = 'base'"), x.where("half = 'new'"), ["event_type", "third"])
    return rounded(out.select("feature", "p_value"))


REPORT = f"""WITH h AS ({plain(PARTS)}), {ks_sql('h', ['event_id', 'value', 'k'])},
  p AS (SELECT 'event_type' AS feature, half AS r, event_type AS c FROM h UNION ALL SELECT 'tenth', half, CAST(tenth AS VARCHAR) FROM h), {chi2_sql('p', 'x')},
  report AS (SELECT feature, 'ks' AS kind, round(statistic, 6) AS statistic, CAST(p_value < 0.05 AS INT) AS drift_detected FROM ks
             UNION ALL SELECT feature, 'chi2', round(statistic, 6), CAST(statistic > {CRITICAL_SQL} AS INT) FROM x)"""


@check("drift_report", f"{REPORT} SELECT * FROM report")
def _(t: Tables) -> DataFrame:
    x = t.view(PARTS)
    return rounded(drift.drift_report(x.where("half = 'base'"), x.where("half = 'new'"), exclude=["half"]).drop("p_value"))


CASES = {"moved": {"value": {"add": 20}}, "wrapped": {"k": {"add": 30, "mod": 100}, "value": {"add": 1, "clip": (0, 300)}}, "same": {}}
CASES_SQL = f"""WITH h0 AS ({plain(PARTS)}),
  h AS (SELECT 'base' AS half, event_type, value AS moved_value, value AS wrapped_value, value AS same_value, k AS moved_k, k AS wrapped_k, k AS same_k FROM h0
        UNION ALL SELECT 'new', event_type, value + 20, least(greatest(value + 1, 0), 300), value, k, (k + 30) % 100, k FROM h0),
  {ks_sql('h', ['moved_value', 'wrapped_value', 'same_value', 'moved_k', 'wrapped_k', 'same_k'])},
  p AS (SELECT s || '_event_type' AS feature, half AS r, event_type AS c FROM h, (VALUES ('moved'), ('wrapped'), ('same')) v(s)), {chi2_sql('p', 'x')},
  report AS (SELECT feature, 'ks' AS kind, statistic, p_value FROM ks UNION ALL SELECT feature, 'chi2', statistic, CASE WHEN statistic < 0.000001 THEN 1 END FROM x)
  SELECT split_part(feature, '_', 1) AS scenario, substr(feature, strpos(feature, '_') + 1) AS feature, kind, round(statistic, 6) AS statistic,
         round(p_value, 6) AS p_value, CAST(p_value < 0.05 AS INT) AS drift_detected FROM report"""


@check("scenario_reports", CASES_SQL)
def scenario_reports(t: Tables) -> DataFrame:
    """Three scenarios of the events in one table, each tested against the events."""
    x = t.view(PARTS).select("event_type", "value", "k")
    return rounded(drift.scenario_reports(x, drift.perturbed(x, CASES)))


@check(
    "perturbed",
    f"""WITH h AS ({plain(PARTS)}) SELECT event_id, 'moved' AS scenario, value + 20 AS value, k FROM h UNION ALL SELECT event_id, 'same', value, k FROM h
        UNION ALL SELECT event_id, 'wrapped', least(greatest(value + 1, 0), 300), (k + 30) % 100 FROM h""",
)
def perturbed(t: Tables) -> DataFrame:
    return drift.perturbed(t.view(PARTS).select("event_id", "value", "k"), CASES)


@check(
    "dataset_drift",
    f"""{REPORT} SELECT count(*) AS n_columns, CAST(sum(drift_detected) AS BIGINT) AS n_drifted, sum(drift_detected) / count(*) AS share_drifted,
                 CAST(sum(drift_detected) / count(*) >= 0.5 AS INT) AS dataset_drift FROM report""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(PARTS)
    return drift.dataset_drift(drift.drift_report(x.where("half = 'base'"), x.where("half = 'new'"), exclude=["half"]))


@check(
    "paired_distribution",
    f"""WITH x AS ({plain(HALVES)}), r AS (SELECT half, min(value) AS a, max(value) AS b, (max(value) - min(value)) / 30 AS w FROM x GROUP BY half),
        h AS (SELECT x.half, CAST(least(floor((value - a) / w), 29) AS BIGINT) AS bin, count(*) AS n FROM x JOIN r ON x.half = r.half GROUP BY ALL)
        SELECT r.half AS dataset, s.bin, round(a + s.bin * w, 6) AS lo, round(a + (s.bin + 1) * w, 6) AS hi, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(30)) AS bin) s, r LEFT JOIN h ON s.bin = h.bin AND r.half = h.half""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(HALVES)
    return rounded(drift.paired_distribution(x.where("half = 'base'"), x.where("half = 'new'"), "value", 30))


# ---- scenarios -----------------------------------------------------------------------------


@check(
    "perturb",
    """SELECT event_id, round(least(greatest(value / 490.02 + 0.1, 0.0), 1.0), 9) AS temp, round(least(greatest(value / 600 + 0.15, 0.0), 1.0), 9) AS hum,
              CAST((hour(ts) + 3) % 24 AS INT) AS hr FROM events""",
)
def _(t: Tables) -> DataFrame:
    x = t.events.select("event_id", (F.col("value") / 490.02).alias("temp"), (F.col("value") / 600).alias("hum"), F.hour("ts").alias("hr"))
    return rounded(drift.perturb(x), 9)


SCENARIOS = """
SELECT l_orderkey, l_extendedprice / 1000 AS y, s.scenario, CASE s.scenario WHEN 'base' THEN 1.5 * l_quantity WHEN 'more' THEN 1.5 * (l_quantity + 6)
       WHEN 'much more' THEN 1.5 * (l_quantity + 14) ELSE 1.5 * l_quantity * (1 - l_discount) END AS yhat
FROM {lineitem}, (VALUES ('base'), ('more'), ('much more'), ('discounted')) AS s(scenario)"""
SUMMARY = f"""sm AS (SELECT scenario, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae, 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2
              FROM ({plain(SCENARIOS)}) GROUP BY scenario)"""


def _summary(t: Tables) -> DataFrame:
    """Scenarios of one model on one table, stacked."""
    q, d = F.col("l_quantity"), F.col("l_discount")
    tables = {"base": q, "more": q + 6, "much more": q + 14, "discounted": q * (1 - d)}
    scored = [
        t.lineitem.select((F.col("l_extendedprice") / 1000).alias("y"), (1.5 * v).alias("yhat"), F.lit(n).alias("scenario")) for n, v in tables.items()
    ]
    return drift.scenario_metrics(stack_tables(*scored), "y", "yhat")


@check("scenario_metrics", f"WITH {SUMMARY} SELECT scenario, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM sm")
def _(t: Tables) -> DataFrame:
    return rounded(_summary(t))


DELTAS = f"""{SUMMARY}, dl AS (SELECT s.scenario, s.rmse, s.mae, s.r2, s.rmse - b.rmse AS delta_rmse, s.mae - b.mae AS delta_mae, s.r2 - b.r2 AS delta_r2
             FROM sm s, (SELECT * FROM sm WHERE scenario = 'base') b)"""
SHOWN = ", ".join(f"round({c}, 4) AS {c}" for c in ("rmse", "mae", "r2", "delta_rmse", "delta_mae", "delta_r2"))


@check("delta_vs_baseline", f"WITH {DELTAS} SELECT scenario, {SHOWN} FROM dl")
def _(t: Tables) -> DataFrame:
    s = _summary(t)
    return drift.delta_vs_baseline(s, s.where("scenario = 'base'"), 4)


@check("worst_scenario", f"WITH {DELTAS} SELECT scenario, {SHOWN} FROM dl ORDER BY abs(delta_rmse) DESC, scenario LIMIT 1")
def _(t: Tables) -> DataFrame:
    s = _summary(t)
    return rounded(drift.worst_scenario(drift.delta_vs_baseline(s, s.where("scenario = 'base'"))), 4)


@check(
    "alert_level",
    f"""WITH {DELTAS} SELECT scenario, CASE WHEN abs(delta_rmse) > 10 OR abs(delta_mae) > 10 OR delta_r2 < -0.05 THEN 'red'
               WHEN abs(delta_rmse) > 5 OR abs(delta_mae) > 5 THEN 'yellow' ELSE 'green' END AS alert, 'lines.csv' AS dataset_name FROM dl""",
)
def _(t: Tables) -> DataFrame:
    s = _summary(t)
    out = drift.alert_level(drift.delta_vs_baseline(s, s.where("scenario = 'base'")))
    named = drift.with_dataset_name(out.withColumn("path", F.lit("data/processed/lines.csv")), "path")
    return named.select("scenario", "alert", "dataset_name")


# ---- experiment tables ---------------------------------------------------------------------

# One run per supplier: the error of a per-supplier price rule.
RUNS = """
SELECT 'run-' || CAST(1000000 + l_suppkey AS STRING) || '-x' AS run_id, 'supplier ' || CAST(l_suppkey AS STRING) AS run_name,
       CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE sqrt(avg((y - yhat) * (y - yhat))) END AS test_rmse,
       CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE avg(abs(y - yhat)) END AS test_mae,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) END AS test_r2, CAST(NULL AS DOUBLE) AS valid_rmse
FROM (SELECT l_suppkey, l_extendedprice / 1000 AS y, 1.5 * l_quantity AS yhat FROM {lineitem}) z GROUP BY l_suppkey"""
LOCAL = """SELECT 'local_boosted' AS run_id, 'Boosted' AS run_name, CAST(0 AS DOUBLE) AS test_rmse, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS test_mae
           FROM (SELECT l_extendedprice / 1000 AS y, 1.5 * l_quantity AS yhat FROM {lineitem}) z"""
BOARD_COLUMNS = "model_type, run_name, run_id, round(test_rmse, 6) AS test_rmse, round(test_mae, 6) AS test_mae, round(test_r2, 6) AS test_r2, valid_rmse"
BOARD = f"""runs AS (SELECT 'tracked' AS model_type, run_name, substr(run_id, 1, 8) AS run_id, coalesce(test_rmse, 'inf'::DOUBLE) AS test_rmse, coalesce(test_mae, 'inf'::DOUBLE) AS test_mae,
                           coalesce(test_r2, '-inf'::DOUBLE) AS test_r2, coalesce(valid_rmse, 'inf'::DOUBLE) AS valid_rmse, run_id AS full_id FROM ({plain(RUNS)})),
  board AS (SELECT * EXCLUDE (full_id) FROM (SELECT * FROM runs ORDER BY test_rmse, full_id LIMIT 5)
            UNION ALL SELECT 'local', run_name, run_id, rmse, test_mae, 'nan'::DOUBLE, 'inf'::DOUBLE FROM ({plain(LOCAL)}))"""


def _board(t: Tables) -> DataFrame:
    return experiments.leaderboard(t.view(RUNS), t.view(LOCAL))


@check("leaderboard", f"WITH {BOARD} SELECT {BOARD_COLUMNS} FROM board")
def _(t: Tables) -> DataFrame:
    return rounded(_board(t))


@check(
    "promote",
    f"""WITH {BOARD}, b AS (SELECT {BOARD_COLUMNS} FROM board ORDER BY test_rmse, run_id LIMIT 1)
        SELECT *, CAST(test_rmse < 100 AND test_r2 > 0.5 AND NOT isnan(test_r2) AS INT) AS promoted FROM b""",
)
def _(t: Tables) -> DataFrame:
    return rounded(experiments.promote(_board(t)))


VERSIONS = """
SELECT p_brand AS name, p_type AS stage, p_partkey AS version, p_partkey * 60000 + 1600000000000 AS created_ms, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_partkey * 61000 + 1600000000123 END AS updated_ms,
       'run' || CAST(p_partkey AS STRING) AS run_id FROM {part}"""


@check(
    "latest_versions",
    f"""SELECT name, stage, max(version) AS version, epoch_ms(arg_max(created_ms, version)) AS created, epoch_ms((SELECT updated_ms FROM ({plain(VERSIONS)}) v WHERE v.version = max(x.version))) AS updated,
               arg_max(run_id, version) AS run_id FROM ({plain(VERSIONS)}) x GROUP BY name, stage""",
)
def _(t: Tables) -> DataFrame:
    return experiments.latest_versions(t.view(VERSIONS))


@check(
    "metric_fallback",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0 THEN l_tax WHEN l_discount <> 0 THEN l_discount ELSE 'nan'::DOUBLE END AS metric FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", experiments.metric_fallback("l_tax", "l_discount").alias("metric"))


MODEL_IDS = """
SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN p_brand WHEN p_partkey % 10 = 0 THEN p_brand || ':a:' || CAST(p_size AS STRING) ELSE p_brand || ':' || CAST(p_size AS STRING) END AS id FROM {part}"""


@check(
    "parse_model_id",
    f"""SELECT p_partkey, id, CASE WHEN ok THEN split_part(id, ':', 1) END AS model_name, CASE WHEN ok THEN split_part(id, ':', 2) END AS model_ref,
               CASE WHEN NOT ok THEN 'model id must be name:stage_or_version' END AS error
        FROM (SELECT *, length(id) - length(replace(id, ':', '')) = 1 AS ok FROM ({plain(MODEL_IDS)}))""",
)
def _(t: Tables) -> DataFrame:
    return experiments.parse_model_id(t.view(MODEL_IDS), "id")


# ---- requests ------------------------------------------------------------------------------


# Rows of four numbers in an embedding.
WIDTH = 16


def requests(t: Tables) -> DataFrame:
    """Each embedding as rows of four numbers, with every kind of broken request."""
    e = F.col("embedding").cast("array<double>")
    rows = [F.slice(e, 4 * i + 1, 4) for i in range(WIDTH)]
    good = F.array(*rows)
    ragged = F.array(rows[0], F.slice(e, 5, 3), *rows[2:])
    wide = F.array(*[F.slice(e, 5 * i + 1, 5) for i in range(12)])
    v = F.col("vec_id")
    body = (
        F.when(v % 7 == 0, F.lit(None))
        .when(v % 11 == 0, F.array().cast("array<array<double>>"))
        .when(v % 13 == 0, ragged)
        .when(v % 17 == 0, wide)
        .otherwise(good)
    )
    return t.embeddings.select("vec_id", body.alias("features"))


@check(
    "validate_requests",
    """SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 400 WHEN vec_id % 11 = 0 OR vec_id % 13 = 0 OR vec_id % 17 = 0 THEN 422 ELSE 200 END AS status,
              CASE WHEN vec_id % 7 = 0 THEN 'features missing' WHEN vec_id % 11 = 0 THEN 'features empty' WHEN vec_id % 13 = 0 THEN 'rows differ in length: 3,4'
                   WHEN vec_id % 17 = 0 THEN 'row length 5 but the model expects 4' END AS error FROM embeddings""",
)
def _(t: Tables) -> DataFrame:
    return quality.validate_requests(requests(t), "features", 4).select("vec_id", "status", "error")


@check(
    "validate_requests_any_width",
    "SELECT count(*) FILTER (vec_id % 7 > 0 AND vec_id % 11 > 0 AND vec_id % 13 > 0) AS accepted, count(*) FILTER (vec_id % 7 = 0 OR vec_id % 11 = 0 OR vec_id % 13 = 0) AS rejected FROM embeddings",
)
def _(t: Tables) -> DataFrame:
    x = quality.validate_requests(quality.as_requests(requests(t), "features"), "features")
    sides = stack_tables(quality.accepted(x).select(F.lit(1).alias("ok")), quality.rejected(x).select(F.lit(0).alias("ok")))
    return sides.agg(F.count_if(F.col("ok") == 1).alias("accepted"), F.count_if(F.col("ok") == 0).alias("rejected"))
