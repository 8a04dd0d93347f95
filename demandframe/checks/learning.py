"""Models, search, scoring, storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.checks.cleaning import CLEAN_SQL, EVENT_RULES, RAW_EVENTS
from demandframe.checks.features import ORDER_RULES, PREP_ORDERS, PREPARED_SQL, split_sql
from demandframe.checks.monitoring import WIDTH, requests
from demandframe.checks.registry import Tables, check, plain, rounded
from demandframe.operators import drift, fold_search, models, prep, scoring
from demandframe.operators.metrics import metrics_by_split
from demandframe.operators.ordered import Blocking
from demandframe.plans import clean, monitor, prepare, training
from demandframe.sources import publish
from demandframe.sources import tables as io
from demandframe.streaming.scoring import score_stream

# ---- linear family: one or two features have closed forms ----------------------------------

PRICED = "SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS y, l_quantity AS q, l_discount * 100 AS d FROM {lineitem}"
MOMENTS = f"""m AS (SELECT count(*) AS n, avg(y) AS my, avg(q) AS mq, avg(d) AS md, covar_pop(y, q) AS cyq, covar_pop(y, d) AS cyd, covar_pop(q, d) AS cqd,
                     var_pop(q) AS vq, var_pop(d) AS vd, sum(q * y) AS sqy, sum(q * q) AS sqq FROM ({plain(PRICED)}))"""


def _terms(slopes: dict[str, str], intercept: str, digits: int = 5) -> str:
    rows = [f"SELECT 'Intercept' AS term, round({intercept}, {digits}) AS coefficient FROM b"]
    rows += [f"SELECT '{n}', round({e}, {digits}) FROM b" for n, e in slopes.items()]
    return " UNION ALL ".join(rows)


def _coefficients(t: Tables, name: str, features: list[str], params: dict | None = None) -> DataFrame:
    model = models.fit(name, t.view(PRICED), "y", features, params)
    return rounded(models.coefficients(model, features, t.spark), 5)


@check(
    "linear_two_features",
    f"""WITH {MOMENTS}, b AS (SELECT *, (cyq * vd - cyd * cqd) / (vq * vd - cqd * cqd) AS bq, (cyd * vq - cyq * cqd) / (vq * vd - cqd * cqd) AS bd FROM m)
        {_terms({'q': 'bq', 'd': 'bd'}, 'my - bq * mq - bd * md')}""",
)
def _(t: Tables) -> DataFrame:
    return _coefficients(t, "linear", ["q", "d"])


@check("linear_sql_twin", f"SELECT round(regr_slope(y, q), 6) AS slope, round(regr_intercept(y, q), 6) AS intercept, round(regr_r2(y, q), 6) AS r2 FROM ({plain(PRICED)})")
def _(t: Tables) -> DataFrame:
    return t.view(PRICED).agg(
        F.round(F.regr_slope("y", "q"), 6).alias("slope"), F.round(F.regr_intercept("y", "q"), 6).alias("intercept"), F.round(F.regr_r2("y", "q"), 6).alias("r2")
    )


@check("linear_no_intercept", f"WITH {MOMENTS}, b AS (SELECT sqy / sqq AS bq FROM m) {_terms({'q': 'bq'}, '0.0')}")
def _(t: Tables) -> DataFrame:
    return _coefficients(t, "linear", ["q"], {"fit_intercept": False})


@check("ridge_one_feature", f"WITH {MOMENTS}, b AS (SELECT *, cyq * n / (vq * n + 1e6) AS bq FROM m) {_terms({'q': 'bq'}, 'my - bq * mq')}")
def _(t: Tables) -> DataFrame:
    return _coefficients(t, "ridge", ["q"], {"alpha": 1e6})


@check("ridge_no_intercept", f"WITH {MOMENTS}, b AS (SELECT *, sqy / (sqq + 1e6) AS bq FROM m) {_terms({'q': 'bq'}, '0.0')}")
def _(t: Tables) -> DataFrame:
    return _coefficients(t, "ridge", ["q"], {"alpha": 1e6, "fit_intercept": False})


@check("lasso_one_feature", f"WITH {MOMENTS}, b AS (SELECT *, sign(cyq) * greatest(abs(cyq) - 50, 0) / vq AS bq FROM m) {_terms({'q': 'bq'}, 'my - bq * mq')}")
def _(t: Tables) -> DataFrame:
    return _coefficients(t, "lasso", ["q"], {"alpha": 50.0})


@check(
    "elasticnet_one_feature",
    f"WITH {MOMENTS}, b AS (SELECT *, sign(cyq) * greatest(abs(cyq) - 15, 0) / (vq + 35) AS bq FROM m) {_terms({'q': 'bq'}, 'my - bq * mq')}",
)
def _(t: Tables) -> DataFrame:
    return _coefficients(t, "elasticnet", ["q"], {"alpha": 50.0, "l1_ratio": 0.3})


@check(
    "predict",
    f"""SELECT l_orderkey, l_linenumber, y, q, round(i + s * q, 5) AS yhat FROM ({plain(PRICED)}), (SELECT regr_slope(y, q) AS s, regr_intercept(y, q) AS i FROM ({plain(PRICED)}))""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(PRICED)
    out = models.predict(x, models.fit("linear", x, "y", ["q"]), "yhat")
    return out.select("l_orderkey", "l_linenumber", "y", "q", F.round("yhat", 5).alias("yhat"))


# ---- search --------------------------------------------------------------------------------

PARTS = "SELECT p_partkey, p_retailprice AS y, CAST(p_size AS DOUBLE) AS s, CAST(p_partkey % 7 AS DOUBLE) AS w FROM {part}"


def folds_sql(k: int, rows: str = PARTS, key: str = "p_partkey") -> str:
    return f"""SELECT *, CASE WHEN i < (n % {k}) * (n // {k} + 1) THEN i // (n // {k} + 1) ELSE n % {k} + (i - (n % {k}) * (n // {k} + 1)) // (n // {k}) END AS fold
               FROM (SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS i, count(*) OVER () AS n FROM ({plain(rows)}))"""


def _folded(t: Tables, k: int) -> DataFrame:
    return models.with_folds(t.view(PARTS), "p_partkey", k, blocking=Blocking(block_size=300))


@check("with_folds", f"SELECT p_partkey, y, s, w, CAST(fold AS INT) AS fold FROM ({folds_sql(7)})")
def _(t: Tables) -> DataFrame:
    return _folded(t, 7)


def cv_sql(points: list[dict], k: int, ridge: bool = False) -> str:
    """Mean squared error over the folds of one-feature fits, each from the other folds' moments."""
    rows = ", ".join(f"({i}, {p.get('alpha', 0.0) if ridge else 0.0}, {str(p.get('fit_intercept', True)).upper()})" for i, p in enumerate(points))
    return f"""f AS ({folds_sql(k)}), pt(point, alpha, icpt) AS (VALUES {rows}),
      b AS (SELECT point, icpt, h.fold, CASE WHEN icpt THEN covar_pop(y, s) * count(*) / (var_pop(s) * count(*) + alpha) ELSE sum(s * y) / (sum(s * s) + alpha) END AS b, avg(y) AS my, avg(s) AS ms
            FROM f, (SELECT DISTINCT fold FROM f) h, pt WHERE f.fold <> h.fold GROUP BY point, alpha, icpt, h.fold),
      e AS (SELECT b.point, f.fold, avg(power(y - (CASE WHEN icpt THEN my - b * ms ELSE 0 END + b * s), 2)) AS mse, avg(abs(y - (CASE WHEN icpt THEN my - b * ms ELSE 0 END + b * s))) AS mae
            FROM f JOIN b ON f.fold = b.fold GROUP BY b.point, f.fold),
      a AS (SELECT point, avg(mse) AS mse, avg(sqrt(mse)) AS rmse, avg(mae) AS mae FROM e GROUP BY point)"""


LINEAR_GRID = {"fit_intercept": [True, False]}


@check(
    "grid_search_linear",
    f"""WITH {cv_sql(models.param_grid(LINEAR_GRID), 7)} SELECT CAST(point AS INT) AS point, round(-mse, 3) AS score, round(sqrt(mse), 5) AS cv_rmse, CAST(mse = min(mse) OVER () AS INT) AS best FROM a""",
)
def _(t: Tables) -> DataFrame:
    _, table = models.search("linear", LINEAR_GRID, _folded(t, 7), "y", ["s"], 7)
    return table.select("point", F.round("score", 3).alias("score"), F.round("cv_rmse", 5).alias("cv_rmse"), "best")


RIDGE_GRID = {"alpha": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 1e5, 1e6], "fit_intercept": [True, False], "max_iter": [1000]}
RIDGE_POINTS = models.sampled_grid(RIDGE_GRID, 6, 42)


@check(
    "random_search_ridge",
    f"""WITH {cv_sql(RIDGE_POINTS, 6, True)} SELECT CAST(point AS INT) AS point, round(-mse, 3) AS score, round(sqrt(mse), 5) AS cv_rmse FROM a""",
)
def _(t: Tables) -> DataFrame:
    _, table = models.search("ridge", RIDGE_GRID, _folded(t, 6), "y", ["s"], 6, "random", 6, 42)
    return table.select("point", F.round("score", 3).alias("score"), F.round("cv_rmse", 5).alias("cv_rmse"))


@check(
    "cross_validate_two_metrics",
    f"WITH {cv_sql(models.param_grid(LINEAR_GRID), 3)} SELECT CAST(point AS INT) AS point, round(rmse, 5) AS rmse, round(mae, 5) AS mae, CAST(rmse = min(rmse) OVER () AS INT) AS best FROM a",
)
def _(t: Tables) -> DataFrame:
    _, table = models.cross_validate("linear", models.param_grid(LINEAR_GRID), _folded(t, 3), "y", ["s"], 3)
    return table.select("point", F.round("rmse", 5).alias("rmse"), F.round("mae", 5).alias("mae"), "best")


# ---- search with the preparation refitted in every fold ------------------------------------

# Prices rise with the key, so that folds differ in medians and ranges; the priority of the first rows is rare later on.
GAPPED = """SELECT o_orderkey, o_totalprice / 1000 + o_orderkey % 10 AS y, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 100 + o_orderkey END AS x,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderpriority < '3' AND o_orderkey % 3 > 0 THEN 'rush' ELSE 'calm' END AS g FROM {orders}"""
FILLED = f"""f AS ({folds_sql(5, GAPPED, "o_orderkey")}), h AS (SELECT DISTINCT fold AS held FROM f),
      s AS (SELECT held, median(x) AS med, min(x) AS lo, max(x) AS hi FROM f, h WHERE fold <> held GROUP BY held),
      c AS (SELECT held, min(g) AS first_level, arg_min(g, (-n, g)) AS mode FROM (SELECT held, g, count(*) AS n FROM f, h WHERE fold <> held AND g IS NOT NULL GROUP BY held, g) GROUP BY held)"""
FOLD_GRID = {"alpha": [0.01, 10.0, 1000.0], "fit_intercept": [True, False]}


def _gapped(t: Tables) -> DataFrame:
    return models.with_folds(t.view(GAPPED), "o_orderkey", 5)


def fold_search_sql(points: list[dict], feature: str) -> str:
    """Errors over the folds of one-feature ridge fits; the feature is made with the statistics of the other folds."""
    rows = ", ".join(f"({i}, {p['alpha']}, {str(p['fit_intercept']).upper()})" for i, p in enumerate(points))
    return f"""WITH {FILLED}, pt(point, alpha, icpt) AS (VALUES {rows}), z AS (SELECT held, fold, y, {feature} AS z FROM f, s JOIN c USING (held)),
      b AS (SELECT point, icpt, held, CASE WHEN icpt THEN covar_pop(y, z) * count(*) / (var_pop(z) * count(*) + alpha) ELSE sum(z * y) / (sum(z * z) + alpha) END AS b, avg(y) AS my, avg(z) AS mz
            FROM z, pt WHERE fold <> held GROUP BY point, alpha, icpt, held),
      e AS (SELECT point, held, avg(power(y - (CASE WHEN icpt THEN my - b * mz ELSE 0 END + b * z), 2)) AS mse FROM z JOIN b USING (held) WHERE fold = held GROUP BY point, held),
      a AS (SELECT point, avg(mse) AS mse FROM e GROUP BY point)
      SELECT CAST(point AS INT) AS point, round(-mse, 4) AS score, round(sqrt(mse), 5) AS cv_rmse, CAST(mse = min(mse) OVER () AS INT) AS best FROM a"""


@check(
    "fold_preparation",
    f"""WITH {FILLED}, w AS (SELECT median(x) AS med, min(x) AS lo, max(x) AS hi FROM f), m AS (SELECT arg_min(g, (-n, g)) AS mode FROM (SELECT g, count(*) AS n FROM f WHERE g IS NOT NULL GROUP BY g))
        SELECT CAST(held AS INT) AS held_out, round(med, 6) AS med, round(lo, 6) AS lo, round(hi, 6) AS hi, mode FROM s JOIN c USING (held)
        UNION ALL SELECT -1, round(med, 6), round(lo, 6), round(hi, 6), mode FROM w, m""",
)
def _(t: Tables) -> DataFrame:
    """Statistics of all rows but one fold's, for each fold, and of all rows (-1)."""
    rows = []
    for held, m in fold_search.fit_folds(_gapped(t), prep.TablePrep(numeric=["x"], categorical=["g"])).items():
        rows.append((-1 if held is None else held, *m.getOrDefault(m.ranges)["x"], m.getOrDefault(m.levels)["g"][0]))
    return rounded(t.spark.createDataFrame(rows, "held_out int, med double, lo double, hi double, mode string"))


def _fold_scores(t: Tables, maker: prep.TablePrep) -> DataFrame:
    _, table = fold_search.search("ridge", FOLD_GRID, _gapped(t), "y", maker)
    return table.select("point", F.round("score", 4).alias("score"), F.round("cv_rmse", 5).alias("cv_rmse"), "best")


@check("fold_search_numeric", fold_search_sql(models.param_grid(FOLD_GRID), "(coalesce(x, med) - lo) / (hi - lo)"))
def _(t: Tables) -> DataFrame:
    """Median and range of each fold's training rows."""
    return _fold_scores(t, prep.TablePrep(numeric=["x"]))


@check("fold_search_categorical", fold_search_sql(models.param_grid(FOLD_GRID), "CASE WHEN coalesce(g, mode) <> first_level THEN 1.0 ELSE 0.0 END"))
def _(t: Tables) -> DataFrame:
    """Mode and levels of each fold's training rows, the first level dropped."""
    return _fold_scores(t, prep.TablePrep(categorical=["g"]))


# ---- trees ---------------------------------------------------------------------------------

STEP = "SELECT p_partkey, p_retailprice AS y, CAST(CASE WHEN p_partkey % 10 < 4 THEN 1 ELSE 0 END AS DOUBLE) AS big, CAST(p_size AS DOUBLE) AS s FROM {part}"


@check("boosted_single_split", f"SELECT p_partkey, round(avg(y) OVER (PARTITION BY big), 5) AS prediction FROM ({plain(STEP)})")
def _(t: Tables) -> DataFrame:
    """One tree with one split on a yes/no feature predicts the two group means."""
    x = t.view(STEP)
    model = models.fit("boosted", x, "y", ["big"], {"n_estimators": 1, "max_depth": 1})
    return rounded(models.predict(x, model).select("p_partkey", "prediction"), 5)


@check("forest_one_tree", f"SELECT p_partkey, round(avg(y) OVER (PARTITION BY big), 5) AS prediction FROM ({plain(STEP)})")
def _(t: Tables) -> DataFrame:
    """Without drawing rows a forest of one tree is that tree: one split on a yes/no feature predicts the two group means."""
    x = t.view(STEP)
    return rounded(models.predict(x, models.fit("random_forest", x, "y", ["big"], {"n_estimators": 1, "max_depth": 1, "bootstrap": False})).select("p_partkey", "prediction"), 5)


TWO_STEPS = """SELECT p_partkey, p_retailprice + CASE WHEN p_partkey % 10 < 4 THEN 5000 ELSE 0 END + CASE WHEN p_partkey % 2 = 1 THEN 400 ELSE 0 END AS y,
               CAST(CASE WHEN p_partkey % 10 < 4 THEN 1 ELSE 0 END AS DOUBLE) AS big, CAST(p_partkey % 2 AS DOUBLE) AS odd FROM {part}"""


@check(
    "boosted_two_stages",
    f"""WITH a AS (SELECT *, avg(y) OVER (PARTITION BY big) AS f FROM ({plain(TWO_STEPS)}))
        SELECT p_partkey, round(f + 0.3 * avg(2 * (y - f)) OVER (PARTITION BY odd), 4) AS prediction FROM a""",
)
def _(t: Tables) -> DataFrame:
    """The second of two one-split trees fits the gradient that the first leaves (twice the residual), times the learning rate."""
    x = t.view(TWO_STEPS)
    for name in ("boosted", "gradient_boosting"):
        model = models.fit(name, x, "y", ["big", "odd"], {"n_estimators": 2, "max_depth": 1, "learning_rate": 0.3})
    return rounded(models.predict(x, model).select("p_partkey", "prediction"), 4)


@check("boosted_stops_early", f"SELECT p_partkey, round((SELECT avg(y) FROM ({plain(STEP)}) WHERE p_partkey % 4 > 0), 5) AS prediction, 1 AS trees FROM ({plain(STEP)})")
def _(t: Tables) -> DataFrame:
    """With nothing to split on, the second tree gains nothing on the validation rows: the mean of the others is left."""
    x = t.view(STEP).withColumn("flat", F.lit(1.0)).withColumn("held_out", F.col("p_partkey") % 4 == 0)
    model = models.fit("boosted", x, "y", ["flat"], {"n_estimators": 10, "max_depth": 2}, "held_out")
    return rounded(models.predict(x, model).select("p_partkey", "prediction"), 5).withColumn("trees", F.lit(models.regressor(model).getNumTrees))


@check("importances", "SELECT 'big' AS feature, 1.0::DOUBLE AS importance UNION ALL SELECT 'flat', 0.0")
def _(t: Tables) -> DataFrame:
    x = t.view(STEP).withColumn("flat", F.lit(1.0))
    model = models.fit("boosted", x, "y", ["flat", "big"], {"n_estimators": 1, "max_depth": 1})
    return models.importances(model, ["flat", "big"], t.spark, top=5)


def _tree_table(t: Tables) -> tuple[DataFrame, list[str]]:
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    x = t.part.select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"), F.col("p_retailprice").alias("y"))
    x = prep.split(prep.dummies(x, {"p_type": types}), "p_partkey")
    return x, ["p_size", *[f"p_type_{v}" for v in types[1:]]]


def _tree_metrics(t: Tables, name: str, params: dict, validation: bool = False) -> DataFrame:
    x, features = _tree_table(t)
    x = x.withColumn("held_out", F.col("split") == "valid")
    train = x.where("split <> 'test'") if validation else x.where("split = 'train'")
    model = models.fit(name, train, "y", features, params, "held_out" if validation else None)
    return metrics_by_split(models.predict(x, model), "y", "prediction")


@check("boosted_trees")
def _(t: Tables) -> DataFrame:
    return _tree_metrics(t, "boosted", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.2, "subsample": 0.8, "colsample_bytree": 0.7})


@check("boosted_trees_early_stopping")
def _(t: Tables) -> DataFrame:
    return _tree_metrics(t, "boosted", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3}, validation=True)


@check("gradient_boosting")
def _(t: Tables) -> DataFrame:
    return _tree_metrics(t, "gradient_boosting", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1})


@check("random_forest")
def _(t: Tables) -> DataFrame:
    return _tree_metrics(t, "random_forest", {"n_estimators": 10, "max_depth": 5, "min_samples_leaf": 2})


# ---- Poisson: one categorical feature has a closed form ------------------------------------

TYPED_COUNTS = "SELECT event_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS y, value / 100 AS v FROM {events}"


def _kinds(t: Tables) -> list[str]:
    return prep.observed_domain(t.events, "event_type")


@check(
    "poisson_effects",
    f"""WITH g AS (SELECT event_type, avg(y) AS m FROM ({plain(TYPED_COUNTS)}) GROUP BY event_type), r AS (SELECT m AS m0, event_type AS t0 FROM g ORDER BY event_type LIMIT 1)
        SELECT CASE WHEN event_type = t0 THEN 'Intercept' ELSE 'event_type_' || event_type END AS term, round(CASE WHEN event_type = t0 THEN ln(m) ELSE ln(m / m0) END, 6) AS coefficient,
               round(100 * (CASE WHEN event_type = t0 THEN m ELSE m / m0 END - 1), 4) AS effect_pct FROM g, r""",
)
def _(t: Tables) -> DataFrame:
    domain = {"event_type": _kinds(t)}
    x = models.poisson_table(t.view(TYPED_COUNTS), domain)
    model, names, _ = models.poisson_steps(x, "y", [["event_type"]], domain)
    out = models.effects_pct(model, names, t.spark)
    return out.select("term", F.round("coefficient", 6).alias("coefficient"), F.round("effect_pct", 4).alias("effect_pct"))


@check(
    "poisson_log_likelihood",
    f"SELECT round(sum(y * ln(m) - m - lgamma(y + 1)), 2) AS llf FROM (SELECT y, avg(y) OVER (PARTITION BY event_type) AS m FROM ({plain(TYPED_COUNTS)}))",
)
def _(t: Tables) -> DataFrame:
    domain = {"event_type": _kinds(t)}
    x = models.poisson_table(t.view(TYPED_COUNTS), domain)
    model, _, _ = models.poisson_steps(x, "y", [["event_type"]], domain)
    llf = models.poisson_log_likelihood(model, x, "y")
    return x.limit(1).select(F.round(F.lit(llf), 2).alias("llf"))


@check(
    "poisson_nested_to_one_category",
    f"""WITH g AS (SELECT event_type, avg(y) AS m FROM ({plain(TYPED_COUNTS)}) GROUP BY event_type), r AS (SELECT m AS m0, event_type AS t0 FROM g ORDER BY event_type LIMIT 1)
        SELECT CASE WHEN event_type = t0 THEN 'Intercept' ELSE 'event_type_' || event_type END AS term, round(CASE WHEN event_type = t0 THEN ln(m) ELSE ln(m / m0) END, 6) AS coefficient FROM g, r""",
)
def _(t: Tables) -> DataFrame:
    """Formulas that grow to the whole category: the last one fitted is left, with log group means."""
    domain = {"event_type": _kinds(t)}
    x = models.poisson_table(t.view(TYPED_COUNTS), domain)
    kind = f"event_type_{domain['event_type'][1]}"
    model, names, _ = models.poisson_steps(x, "y", [[kind], ["event_type"]], domain)
    out = models.effects_pct(model, names, t.spark)
    return out.select("term", F.round("coefficient", 6).alias("coefficient"))


@check("poisson_nested_formulas")
def _(t: Tables) -> DataFrame:
    domain = {"event_type": _kinds(t)}
    x = models.poisson_table(t.view(TYPED_COUNTS), domain)
    model, names, _ = models.poisson_steps(x, "y", [["v"], ["v", "event_type"]], domain)
    return models.effects_pct(model, names, t.spark)


# ---- training and monitoring ---------------------------------------------------------------

TRAINING = f"SELECT p_partkey, p_retailprice AS y, CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS s, {split_sql('p_partkey')} AS split FROM {{part}}"
FITTED = f"""x AS ({plain(TRAINING)}), md AS (SELECT quantile_cont(s, 0.5) AS m FROM x WHERE split = 'train'), z AS (SELECT * REPLACE (coalesce(s, m) AS s) FROM x, md),
  co AS (SELECT regr_slope(y, s) AS b, regr_intercept(y, s) AS a FROM z WHERE split = 'train')"""


TRAINED_SQL = f"""WITH {FITTED} SELECT 'linear' AS model, split, count(*) AS n, round(sqrt(avg(power(y - a - b * s, 2))), 4) AS rmse, round(avg(abs(y - a - b * s)), 4) AS mae,
               round(1 - sum(power(y - a - b * s, 2)) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs((y - a - b * s) / y)) * 100, 4) AS mape FROM z, co GROUP BY split"""


@check("train_all", TRAINED_SQL)
def _(t: Tables) -> DataFrame:
    """One model works, one is switched off, one is unknown and must not stop the others."""
    config = {
        "linear": {"folds": 4, "grid": {"fit_intercept": [True, False]}},
        "lasso": {"enabled": False, "grid": {"alpha": [1.0]}},
        "no_such_model": {"folds": 4, "grid": {"alpha": [1.0]}},
    }
    _, table = training.train_all(config, t.view(TRAINING), "y", "p_partkey")
    return table.select("model", "split", "n", *[F.round(c, 6 if c == "r2" else 4).alias(c) for c in ("rmse", "mae", "r2", "mape")])


@check(
    "evaluate_models",
    f"""WITH x AS (SELECT *, {split_sql('l_orderkey')} AS split FROM ({plain(PRICED)})),
        c AS (SELECT 'linear' AS model, regr_slope(y, q) AS b, regr_intercept(y, q) AS a FROM x WHERE split = 'train'
              UNION ALL SELECT 'through_zero', sum(q * y) / sum(q * q), 0 FROM x WHERE split = 'train')
        SELECT model, split, count(*) AS n, round(sqrt(avg(power(y - a - b * q, 2))), 5) AS rmse, round(avg(abs(y - a - b * q)), 5) AS mae FROM x, c GROUP BY model, split""",
)
def _(t: Tables) -> DataFrame:
    x = prep.split(t.view(PRICED), "l_orderkey")
    train = x.where("split = 'train'")
    fitted = {"linear": models.fit("linear", train, "y", ["q"]), "through_zero": models.fit("linear", train, "y", ["q"], {"fit_intercept": False})}
    out = training.evaluate_models(fitted, x, "y")
    return rounded(out.select("model", "split", "n", "rmse", "mae"), 5)


SHIFTED = f"""b AS (SELECT regr_slope(y, q) AS s, regr_intercept(y, q) AS a FROM ({plain(PRICED)})),
  sc AS (SELECT y, a + s * least(greatest(q + sh, 0), 50) AS p, name FROM ({plain(PRICED)}), b, (VALUES ('small', 2), ('large', 10)) v(name, sh)),
  base AS (SELECT sqrt(avg(power(y - a - s * q, 2))) AS rmse, avg(abs(y - a - s * q)) AS mae, 1 - sum(power(y - a - s * q, 2)) / (var_pop(y) * count(*)) AS r2 FROM ({plain(PRICED)}), b),
  su AS (SELECT name AS scenario, sqrt(avg(power(y - p, 2))) AS rmse, avg(abs(y - p)) AS mae, 1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)) AS r2 FROM sc GROUP BY name),
  dl AS (SELECT su.*, su.rmse - base.rmse AS dr, su.mae - base.mae AS dm, su.r2 - base.r2 AS d2 FROM su, base)"""


SUMMARY_SQL = f"""WITH {SHIFTED} SELECT scenario, round(rmse, 5) AS rmse, round(mae, 5) AS mae, round(r2, 5) AS r2, round(dr, 5) AS delta_rmse, round(dm, 5) AS delta_mae, round(d2, 5) AS delta_r2,
               CASE WHEN abs(dr) > 10 OR abs(dm) > 10 OR d2 < -0.05 THEN 'red' WHEN abs(dr) > 5 OR abs(dm) > 5 THEN 'yellow' ELSE 'green' END AS alert FROM dl"""


@check("scenario_summary", SUMMARY_SQL)
def _(t: Tables) -> DataFrame:
    x = t.view(PRICED)
    model = models.fit("linear", x, "y", ["q"])
    cases = {n: drift.perturb(x, {"q": {"add": sh, "clip": (0, 50)}}) for n, sh in (("small", 2), ("large", 10))}
    return rounded(monitor.scenario_summary(x, cases, model, ["q"], "y"), 5)


@check(
    "feature_reports",
    """SELECT 'moved' AS scenario, feature, kind, drift_detected FROM (VALUES ('q', 'ks', 1), ('d', 'ks', 0), ('flag', 'chi2', 0)) v(feature, kind, drift_detected)
       UNION ALL SELECT 'same', feature, kind, 0 FROM (VALUES ('q', 'ks'), ('d', 'ks'), ('flag', 'chi2')) v(feature, kind)""",
)
def _(t: Tables) -> DataFrame:
    x = t.lineitem.select(F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("y"))
    moved = drift.perturb(x, {"q": {"add": 3}})
    return monitor.feature_reports(x, {"moved": moved, "same": x}, "y").select("scenario", "feature", "kind", "drift_detected")


# ---- request scoring -----------------------------------------------------------------------

# Four numbers make a row, the label is an exact linear form of them, so predictions are known.
FORM = "2 * {0} - 1 * {1} + 0.5 * {2} + 0 * {3} + 1"


def _request_model(t: Tables):
    """Fitted on all rows of all requests."""
    e = F.col("embedding").cast("array<double>")
    x = t.embeddings.select(F.explode(F.array(*[F.slice(e, 4 * i + 1, 4) for i in range(WIDTH)])).alias("r")).select(*[F.col("r")[i].alias(f"x{i}") for i in range(4)])
    y = 2 * F.col("x0") - F.col("x1") + 0.5 * F.col("x2") + 1
    return models.fit("linear", x.withColumn("y", y), "y", [f"x{i}" for i in range(4)])


def _answers(part: int) -> str:
    cells = [f"CAST(embedding[{4 * part + i + 1}] AS DOUBLE)" for i in range(4)]
    return f"round({FORM.format(*cells)}, 5)"


# Ids of requests: two in three are shared by two requests, one in five is NULL.
SHARED_ID = "CASE WHEN vec_id % 5 = 0 THEN NULL ELSE vec_id // 3 END"

ANSWERED = f"""SELECT {SHARED_ID} AS request, CASE WHEN vec_id % 7 = 0 THEN 400 WHEN vec_id % 11 = 0 OR vec_id % 13 = 0 OR vec_id % 17 = 0 THEN 422 ELSE 200 END AS status,
  {', '.join(f'CASE WHEN vec_id % 7 > 0 AND vec_id % 11 > 0 AND vec_id % 13 > 0 AND vec_id % 17 > 0 THEN {_answers(i)} END AS p{i}' for i in range(WIDTH))} FROM embeddings"""


def _shared(t: Tables) -> DataFrame:
    return requests(t).select(F.expr(SHARED_ID.replace("//", "DIV")).alias("request"), "features")


def _flat(answers: DataFrame) -> DataFrame:
    return answers.select("request", "status", *[F.round(F.get("predictions", F.lit(i)), 5).alias(f"p{i}") for i in range(WIDTH)])


@check("answer_requests", ANSWERED)
def _(t: Tables) -> DataFrame:
    return _flat(scoring.answer_requests(_shared(t), _request_model(t), "request", "features", 4))


@check("score_stream", ANSWERED)
def _(t: Tables) -> DataFrame:
    """The same requests read as a stream of files, answered batch by batch into a folder."""
    folder = _scratch(t, "stream")
    io.write_table(_shared(t), f"{folder}/requests")
    schema = t.spark.read.parquet(f"{folder}/requests").schema
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/requests")
    query = score_stream(stream, _request_model(t), "request", "features", f"{folder}/answers", f"{folder}/progress", 4)
    query.awaitTermination()
    return _flat(t.spark.read.parquet(f"{folder}/answers"))


# ---- storage -------------------------------------------------------------------------------


def _scratch(t: Tables, name: str) -> str:
    import uuid

    return f"{io.shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


@check("csv_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def _(t: Tables) -> DataFrame:
    path = _scratch(t, "csv")
    io.write_table(t.orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).drop("o_orderpriority"), path, "csv")
    raw = io.require_rows(io.read_csv_text(t.spark, path, ["o_orderkey", "o_totalprice"]))
    from demandframe.operators.typing import coerce_numeric, parse_date, to_nullable_int

    x = to_nullable_int(coerce_numeric(raw, ["o_orderkey", "o_custkey", "o_totalprice"]), ["o_orderkey", "o_custkey"])
    return parse_date(x, "o_orderdate")


@check("split_round_trip", f"SELECT o_orderkey, o_totalprice FROM (SELECT *, {split_sql('o_orderkey')} AS split FROM orders) WHERE split = 'valid'")
def _(t: Tables) -> DataFrame:
    path = _scratch(t, "splits")
    io.write_splits(prep.split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey"), path)
    return io.read_split(t.spark, path, "valid")


@check(
    "saved_model_predicts",
    f"""SELECT l_orderkey, l_linenumber, y, round(i + s * q, 5) AS prediction FROM ({plain(PRICED)}), (SELECT regr_slope(y, q) AS s, regr_intercept(y, q) AS i FROM ({plain(PRICED)}))""",
)
def _(t: Tables) -> DataFrame:
    x, folder = t.view(PRICED), _scratch(t, "models")
    io.save_models({"linear": models.fit("linear", x, "y", ["q"])}, folder)
    out = models.predict(x, io.load_model(f"{folder}/linear"))
    return out.select("l_orderkey", "l_linenumber", "y", F.round("prediction", 5).alias("prediction"))


@check("clean_files", CLEAN_SQL)
def _(t: Tables) -> DataFrame:
    """The cleaning job from CSV file to written table."""
    folder = _scratch(t, "clean")
    io.write_table(t.view(RAW_EVENTS), f"{folder}/raw", "csv")
    return rounded(clean.run(t.spark, f"{folder}/raw", f"{folder}/cleaned", EVENT_RULES), 9)


# ---- jobs from files to published outputs --------------------------------------------------


@check("prepare_files", PREPARED_SQL)
def _(t: Tables) -> DataFrame:
    """The preparation job from a CSV file to what its manifest names."""
    folder = _scratch(t, "prepare")
    io.write_table(t.view(PREP_ORDERS), f"{folder}/cleaned", "csv")
    prepare.run(t.spark, f"{folder}/cleaned", f"{folder}/out", ORDER_RULES, "csv")
    return rounded(publish.read_output(t.spark, f"{folder}/out", "prepare", "splits"), 9)


def _published_splits(t: Tables, table: DataFrame, folder: str) -> None:
    out = publish.JobOutput(t.spark, folder, "prepare")
    out.table("splits", table, ("split",))
    out.publish()


@check("train_files", TRAINED_SQL)
def _(t: Tables) -> DataFrame:
    """Training from published splits to published metrics; one model is unknown and one disabled."""
    folder = _scratch(t, "train")
    _published_splits(t, t.view(TRAINING), folder)
    config = {"linear": {"folds": 4, "grid": {"fit_intercept": [True, False]}}, "lasso": {"enabled": False, "grid": {}}, "no_such_model": {"grid": {"alpha": [1.0]}}}
    training.run(t.spark, folder, folder, "y", "p_partkey", config)
    out = publish.read_output(t.spark, folder, "train", "metrics")
    return out.select("model", "split", "n", *[F.round(c, 6 if c == "r2" else 4).alias(c) for c in ("rmse", "mae", "r2", "mape")])


@check(
    "compare_saved_models",
    f"""WITH {FITTED}, zo AS (SELECT sum(s * y) / sum(s * s) AS b0 FROM z WHERE split = 'train'), p AS (
          SELECT 'linear' AS model, y, a + b * s AS p FROM z, co WHERE split = 'test' UNION ALL SELECT 'through_zero', y, b0 * s FROM z, zo WHERE split = 'test')
        SELECT model, count(*) AS n, round(sqrt(avg(power(y - p, 2))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae FROM p GROUP BY model""",
)
def _(t: Tables) -> DataFrame:
    """Two saved models, read back and compared on the test rows."""
    folder = _scratch(t, "compare")
    table = prep.impute_median(t.view(TRAINING), ["s"])
    _published_splits(t, table, folder)
    config = {"linear": {"grid": {"fit_intercept": [True]}}, "through_zero": {"model": "linear", "grid": {"fit_intercept": [False]}}}
    training.run(t.spark, folder, folder, "y", "p_partkey", config)
    test = publish.read_output(t.spark, folder, "prepare", "splits").where("split = 'test'")
    return rounded(training.compare_saved(t.spark, folder, test, "y"), 4)


@check("monitor_files", SUMMARY_SQL)
def _(t: Tables) -> DataFrame:
    """Monitoring of a published model over tables in files."""
    folder, x = _scratch(t, "monitor"), t.view(PRICED).select("y", "q")
    out = publish.JobOutput(t.spark, folder, "train")
    out.model("linear", models.fit("linear", x, "y", ["q"]))
    out.publish({"best": "linear"})
    paths = {}
    for name, table in [("base", x), *[(n, drift.perturb(x, {"q": {"add": sh, "clip": (0, 50)}})) for n, sh in (("small", 2), ("large", 10))]]:
        paths[name] = f"{folder}/{name}"
        io.write_table(table, paths[name])
    monitor.run(t.spark, paths.pop("base"), paths, folder, folder, "y")
    return rounded(publish.read_output(t.spark, folder, "monitor", "summary"), 5)
