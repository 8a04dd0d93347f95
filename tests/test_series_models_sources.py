import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandframe.operators import models, series
from demandframe.plans import training
from demandframe.sources import tables as io


def daily(spark, values, key="k", start=datetime.date(2011, 1, 1)):
    rows = [(key, start + datetime.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


# ---- series


def test_daily_first_takes_the_first_row_even_if_null(spark):
    d = datetime.datetime
    rows = [(2, d(2011, 1, 1, 1), 5.0), (1, d(2011, 1, 1, 0), None), (3, d(2011, 1, 3, 0), 7.0), (4, None, 9.0)]
    got = series.daily_first(spark.createDataFrame(rows, "i int, t timestamp_ntz, y double"), "t", "y", "i").orderBy("ds").collect()
    assert [(r["ds"].day, r["y"]) for r in got] == [(1, None), (3, 7.0)]


def test_grid_fills_missing_days(spark):
    df = daily(spark, [1, 2, 3, 4]).where("y <> 3")
    got = series.regular_grid(df, keys=["k"]).orderBy("ds").collect()
    assert [r["y"] for r in got] == [1.0, 2.0, None, 4.0]


def test_date_ranges_include_both_ends(spark):
    df = daily(spark, range(5))
    got = series.split_by_date(df, "ds", {"a": (None, "2011-01-02"), "b": ("2011-01-04", "2011-01-04")}).orderBy("ds").collect()
    assert [r["split"] for r in got] == ["a", "a", None, "b", None]


def test_naive_forecast_skips_validation(spark):
    df = daily(spark, [1, 2, 3, 4, 5, 6]).withColumn("split", F.expr("CASE WHEN y <= 2 THEN 'train' WHEN y <= 4 THEN 'valid' ELSE 'test' END"))
    got = series.naive_forecast(df, "ds", "y", keys=["k"]).orderBy("ds").collect()
    assert [r["yhat"] for r in got] == [2.0, 5.0]


def test_decompose_finds_a_weekly_pattern(spark):
    pattern = [3, -1, 0, 2, -2, -1, -1]
    df = daily(spark, [10 + 0.5 * i + pattern[i % 7] for i in range(70)])
    got = series.decompose(df, "ds", "y", 7, ["k"]).orderBy("ds").collect()
    assert [r["trend"] for r in got[:3]] == [None] * 3 and [r["trend"] for r in got[-3:]] == [None] * 3
    assert [r["seasonal"] for r in got[:7]] == pytest.approx(pattern)
    assert max(abs(r["resid"]) for r in got[3:-3]) < 1e-9


# ---- models


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(11)
    rows = []
    for i in range(240):
        x = [rng.gauss(0, 1) for _ in range(3)]
        rows.append((i, *x, 3 + 2 * x[0] - x[1] + 0.3 * x[2] + rng.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "i int, a double, b double, c double, y double"), np.array(rows)


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("alpha", [0.5, 30.0])
def test_ridge_matches_the_closed_form(sample, alpha, intercept):
    df, m = sample
    x, y = m[:, 1:4], m[:, 4]
    if intercept:
        x, y = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(x.T @ x + alpha * np.eye(3), x.T @ y)
    model = models.fit("ridge", df, "y", ["a", "b", "c"], {"alpha": alpha, "fit_intercept": intercept})
    assert models.regressor(model).coefficients.toArray() == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("ratio", [1.0, 0.4])
def test_sparse_penalties_match_coordinate_descent(sample, ratio):
    df, m = sample
    x, y = m[:, 1:4] - m[:, 1:4].mean(0), m[:, 4] - m[:, 4].mean()
    n, alpha, w = len(y), 0.4, np.zeros(3)
    for _ in range(500):
        for j in range(3):
            r = y - x @ w + x[:, j] * w[j]
            rho = x[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (x[:, j] @ x[:, j] / n + alpha * (1 - ratio))
    name = "lasso" if ratio == 1.0 else "elasticnet"
    model = models.fit(name, df, "y", ["a", "b", "c"], {"alpha": alpha, "l1_ratio": ratio})
    assert models.regressor(model).coefficients.toArray() == pytest.approx(w, abs=1e-4)


def test_folds_are_contiguous_with_long_ones_first(spark):
    df = spark.range(11).withColumnRenamed("id", "o")
    got = [r["fold"] for r in models.with_folds(df.repartition(4), "o", 3).orderBy("o").collect()]
    assert got == [0] * 4 + [1] * 4 + [2] * 3


def test_sampled_grid_is_reproducible_and_distinct():
    grid = {"a": list(range(100)), "b": list(range(100)), "c": list(range(1000))}
    one, two = models.sampled_grid(grid, 30, 42), models.sampled_grid(grid, 30, 42)
    assert one == two and len({tuple(sorted(p.items())) for p in one}) == 30
    assert len(models.sampled_grid({"a": [1, 2]}, 30)) == 2


def test_search_refits_on_all_rows(sample):
    df, _ = sample
    folded = models.with_folds(df, "i", 3)
    model, table = models.search("ridge", {"alpha": [0.01, 1e5]}, folded, "y", ["a", "b", "c"], 3)
    best = table.where("best = 1").first()
    assert "0.01" in best["params"]
    assert models.cv_rmse(table) == pytest.approx(best["cv_rmse"])
    direct = models.fit("ridge", df, "y", ["a", "b", "c"], {"alpha": 0.01})
    assert models.regressor(model).coefficients.toArray() == pytest.approx(models.regressor(direct).coefficients.toArray())


@pytest.mark.parametrize("name, params", [
    ("linear", {"fit_intercept": True}), ("linear", {"fit_intercept": False}), ("ridge", {"alpha": 7.0}), ("ridge", {"alpha": 7.0, "fit_intercept": False}),
    ("lasso", {"alpha": 0.3}), ("elasticnet", {"alpha": 0.3, "l1_ratio": 0.3}),
])
def test_products_give_the_fitted_model(sample, name, params):
    """The one-pass search and a fit of the same point on the same rows are the same model."""
    df, _ = sample
    features = ["a", "b", "c"]
    products = models.fold_products(models.with_folds(df, "i", 4).repartition(5), "y", features, "fold")
    assert sorted(products) == [0, 1, 2, 3]
    got = models.linear_from_products(name, params, sum(products.values()))
    stage = models.regressor(models.fit(name, df, "y", features, params))
    assert got == pytest.approx([*stage.coefficients.toArray(), stage.intercept], abs=1e-4)


def test_one_pass_search_agrees_with_fold_by_fold_search(sample):
    df, _ = sample
    folded = models.with_folds(df, "i", 3)
    grid = {"alpha": [0.1, 50.0], "fit_intercept": [True, False]}
    _, fast = models.search("ridge", grid, folded, "y", ["a", "b", "c"], 3)
    _, slow = models.cross_validate("ridge", models.param_grid(grid), folded, "y", ["a", "b", "c"], 3)
    one = {r["point"]: r["best"] for r in fast.collect()}
    two = {r["point"]: r["best"] for r in slow.collect()}
    assert one == two


def test_two_metric_search_both_ways(sample):
    df, _ = sample
    folded, points = models.with_folds(df, "i", 3), [{"alpha": 0.1}, {"alpha": 90.0, "fit_intercept": False}]
    _, fast = models.cross_validate("ridge", points, folded, "y", ["a", "b", "c"], 3)
    slow = models.regression_metrics(models._stacked_by_fits("ridge", points, folded, "y", ["a", "b", "c"], 3, "fold"), "label", "prediction", ["point", "fold"])
    means = slow.groupBy("point").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae")).orderBy("point").collect()
    for x, y in zip(fast.orderBy("point").collect(), means):
        assert (x["rmse"], x["mae"]) == (pytest.approx(y["rmse"]), pytest.approx(y["mae"]))


def test_search_keeps_its_digits_far_from_the_origin(spark):
    """A feature in epoch seconds and an exact slope of 3."""
    df = spark.createDataFrame([(i, 1.7e9 + 3600.0 * (i * 7 % 101), 3.0 * 3600 * (i * 7 % 101) + 5) for i in range(300)], "i long, t double, y double")
    _, table = models.search("linear", {"fit_intercept": [True]}, models.with_folds(df, "i", 4), "y", ["t"], 4)
    assert models.cv_rmse(table) < 1e-3


def test_search_of_many_features_is_the_same_path(spark):
    rng = random.Random(1)
    names = [f"x{j}" for j in range(230)]
    rows = [(i, *[rng.random() for _ in names]) for i in range(500)]
    df = spark.createDataFrame([(*r, r[1] - 2 * r[200] + 4) for r in rows], ["i", *names, "y"])
    _, table = models.search("ridge", {"alpha": [1e-6, 1e6]}, models.with_folds(df, "i", 3), "y", names, 3)
    assert models.cv_rmse(table) < 1e-3 and "1e-06" in table.where("best = 1").first()["params"]


def test_gaps_and_depth_are_named(spark, sample):
    df, _ = sample
    with pytest.raises(ValueError, match="'b'"):
        models.search("ridge", {"alpha": [1.0]}, models.with_folds(df.withColumn("b", F.expr("CASE WHEN i > 3 THEN b END")), "i", 3), "y", ["a", "b"], 3)
    for depth in (None, 31):
        with pytest.raises(ValueError, match="30"):
            models.fit("random_forest", df, "y", ["a"], {"max_depth": depth})


def test_singular_poisson_falls_back_to_a_penalty(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(float(v := rng.randint(0, 3)), float(v), float(rng.randint(0, 9) + v)) for _ in range(80)], "a double, b double, y double")
    model, names, penalty = models.poisson_steps(df, "y", [["a"], ["a", "b"]])
    assert names in (["a"], ["a", "b"])
    bad = df.withColumn("y", F.lit(-1.0))
    with pytest.raises(Exception):
        models.poisson_steps(bad, "y", [["a"]])


def test_importances_sum_to_one(spark, sample):
    df, _ = sample
    model = models.fit("random_forest", df, "y", ["a", "b", "c"], {"n_estimators": 5, "max_depth": 3})
    rows = models.importances(model, ["a", "b", "c"], spark).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert rows[0]["feature"] == "a"
    assert models.importances(model, ["a", "b", "c"], spark, top=2).count() == 2


def test_training_skips_disabled_and_survives_failures(spark, sample):
    df, _ = sample
    table = df.withColumn("split", F.expr("CASE WHEN i % 10 < 7 THEN 'train' WHEN i % 10 < 8 THEN 'valid' ELSE 'test' END"))
    config = {
        "linear": {"folds": 3, "grid": {"fit_intercept": [True]}},
        "broken": {"folds": 3, "grid": {"alpha": [1.0]}},
        "lasso": {"enabled": False, "grid": {"alpha": [1.0]}},
        "boosted": {"folds": 2, "method": "random", "n_iter": 1, "grid": {"n_estimators": [3], "max_depth": [2, 3]}},
    }
    fitted, scores = training.train_all(config, table, "y", "i")
    assert set(fitted) == {"linear", "boosted"}
    comparison, best = training.ranking(scores)
    assert comparison.columns[0] == "Model" and len(comparison.columns) == 10
    assert best.first()["Model"] == "linear"


def test_default_grids_have_the_expected_sizes():
    sizes = {name: len(models.param_grid(job["grid"])) for name, job in training.DEFAULT_CONFIG.items()}
    assert sizes["linear"] == 2 and sizes["ridge"] == 42 and sizes["elasticnet"] == 100 and sizes["boosted"] == 9216


# ---- sources


def test_missing_and_empty_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        io.read_csv_text(spark, str(tmp_path / "nothing.csv"))
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        io.read_csv_text(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "header.csv").write_text("a,b\n")
    with pytest.raises(ValueError):
        io.require_rows(io.read_csv_text(spark, str(tmp_path / "header.csv")))
    with pytest.raises(ValueError):
        io.read_csv_text(spark, str(tmp_path / "header.csv"), ["c"])


def test_split_filter_reads_one_folder(spark, tmp_path):
    df = spark.range(30).withColumn("split", F.when(F.col("id") % 3 == 0, "valid").otherwise("train"))
    io.write_splits(df, str(tmp_path / "t"))
    one = io.read_split(spark, str(tmp_path / "t"), "valid")
    assert one.count() == 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_checkpoint_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert io.shared_folder(spark) == named
    df = io.durable(spark.range(5))
    assert df.count() == 5
    assert named in spark.sparkContext.getCheckpointDir()


def test_requests_with_equal_or_no_ids_get_their_own_answers(spark, sample):
    from demandframe.operators import scoring

    df, _ = sample
    model = models.fit("linear", df.withColumn("y2", 2 * F.col("a") + 1), "y2", ["a"])
    requests = spark.createDataFrame([("r", [[1.0]]), ("r", [[2.0], [3.0]]), (None, [[4.0]]), (None, None), ("x", [])], "id string, rows array<array<double>>")
    got = [(r["id"], r["status"], [round(p, 6) for p in r["predictions"]] if r["predictions"] else None) for r in scoring.answer_requests(requests, model, "id", "rows", 1).collect()]
    assert sorted(got, key=str) == sorted([("r", 200, [3.0]), ("r", 200, [5.0, 7.0]), (None, 200, [9.0]), (None, 400, None), ("x", 422, None)], key=str)


def test_stages_between_assembler_and_model_are_run(spark, sample):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from demandframe.operators import scoring

    df, _ = sample
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True), LinearRegression(labelCol="y")]
    model = Pipeline(stages=stages).fit(df)
    rows = df.select("a", "b").limit(5).collect()
    want = [r["prediction"] for r in model.transform(spark.createDataFrame(rows)).collect()]
    got = scoring.score_requests(spark.createDataFrame([(1, [[float(v) for v in r] for r in rows])], "id int, rows array<array<double>>"), model, "id", "rows").first()
    assert got["predictions"] == pytest.approx(want)
    with pytest.raises(ValueError):
        scoring.score_requests(spark.createDataFrame([], "id int, rows array<array<double>>"), Pipeline(stages=stages[:1]).fit(df), "id", "rows")


@pytest.mark.parametrize("kind", ["linear", "forest"])
def test_requests_without_rows_are_kept(spark, kind):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    from demandframe.operators import scoring

    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(40)], "x double, y double")
    last = LinearRegression(featuresCol="f", labelCol="y") if kind == "linear" else RandomForestRegressor(featuresCol="f", labelCol="y", numTrees=3, seed=1)
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"), last]).fit(df)
    asked = spark.createDataFrame([(1, [[1.0], [2.0]]), (1, []), (None, None), (2, [[3.0]])], "id int, rows array<array<double>>")
    got = scoring.score_requests(asked, model, "id", "rows").collect()
    assert sorted((str(r["id"]), None if r["predictions"] is None else len(r["predictions"])) for r in got) == [("1", 0), ("1", 2), ("2", 1), ("None", None)]
    plain = {x: p for x, p in model.transform(df).select("x", "prediction").collect()}
    assert [p for r in got if r["id"] == 2 for p in r["predictions"]] == [pytest.approx(plain[3.0])]


def test_a_row_of_another_length_is_an_error(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from demandframe.operators import scoring

    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(40)], "x double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="y")]).fit(df)
    with pytest.raises(Exception, match="does not have the model's 1 numbers"):
        scoring.score_requests(spark.createDataFrame([(1, [[1.0, 2.0]])], "id int, rows array<array<double>>"), model, "id", "rows").collect()
