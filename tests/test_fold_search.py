"""Search with the preparation refitted in every fold, against a plain version that prepares fold by fold."""

import random
import statistics

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from demandframe.operators import fold_search, models
from demandframe.operators.prep import TablePrep

COLUMNS = "i long, a double, b double, g string, p double, y double, fold int"


def make(n=400, k=4, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = None if rng.random() < 0.2 else rng.gauss(i, 30)
        b = None if rng.random() < 0.1 else float(rng.randint(0, 5))
        g = None if rng.random() < 0.15 else rng.choice(["u", "v", "w"] if i > n // k else ["u", "first fold only"])
        p = 1e6 + rng.random()
        y = 1e4 + 0.3 * (a or 0) + 2 * (b or 0) + 5 * (g == "v") + 3 * p % 7 + rng.random()
        rows.append((i, a, b, g, p, y, i * k // n))
    return rows


def prepared(rows, held):
    """(features by name, y) of every row, by statistics of the rows outside the fold."""
    inside = [r for r in rows if r[6] != held]
    columns = []
    for j in (1, 2):
        values = [r[j] for r in inside if r[j] is not None]
        med, lo, hi = statistics.median(values), min(values), max(values)
        columns.append([((med if r[j] is None else r[j]) - lo) / ((hi - lo) or 1.0) for r in rows])
    seen = [r[3] for r in inside if r[3] is not None]
    levels = sorted(set(seen))
    mode = min(levels, key=lambda v: (-seen.count(v), v))
    columns += [[float((r[3] or mode) == v) for r in rows] for v in levels[1:]]
    return np.array([*columns, [r[4] for r in rows]]).T


def plain_score(rows, alpha, intercept):
    errors = []
    y, fold = np.array([r[5] for r in rows]), np.array([r[6] for r in rows])
    for f in sorted(set(fold)):
        x = prepared(rows, f)
        inside, outside = fold != f, fold == f
        mx, my = (x[inside].mean(axis=0), y[inside].mean()) if intercept else (0.0, 0.0)
        z, t = x[inside] - mx, y[inside] - my
        w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ t)
        errors.append(np.mean((y[outside] - my - (x[outside] - mx) @ w) ** 2))
    return -float(np.mean(errors))


MAKER = dict(numeric=["a", "b"], categorical=["g"], passthrough=["p"])


def test_one_pass_gives_the_errors_of_fold_by_fold_preparation(spark):
    rows = make()
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    grid = {"alpha": [0.01, 5.0, 500.0], "fit_intercept": [True, False]}
    model, table = fold_search.search("ridge", grid, df, "y", TablePrep(**MAKER))
    points = models.param_grid(grid)
    want = [plain_score(rows, p["alpha"], p["fit_intercept"]) for p in points]
    got = {r["point"]: r for r in table.collect()}
    assert [got[i]["score"] for i in range(len(points))] == pytest.approx(want, rel=1e-5)
    assert [i for i in got if got[i]["best"]] == [max(range(len(want)), key=lambda i: want[i])]
    assert fold_search.feature_names(model)[:2] == ["a", "b"]


def test_other_models_and_other_scores_go_fold_by_fold(spark):
    rows = make(200, 3)
    df = spark.createDataFrame(rows, COLUMNS)
    points = [{"alpha": 0.5}, {"alpha": 50.0}]
    fitted = fold_search.fit_folds(df, TablePrep(**MAKER))
    fast = fold_search._linear_scores("ridge", points, df, "y", fitted, "fold")
    slow = fold_search._fitted_scores("ridge", points, df, "y", fitted, "fold", "neg_mean_squared_error", 2)
    assert slow == pytest.approx(fast, rel=1e-4)
    model, table = fold_search.search("boosted", {"n_estimators": [2], "max_depth": [1, 2]}, df, "y", TablePrep(**MAKER), scoring="neg_mean_absolute_error")
    assert table.count() == 2 and models.predict(df, model).where("prediction IS NULL").count() == 0


def test_saved_search_predicts_raw_rows(spark, tmp_path):
    df = spark.createDataFrame(make(120, 3), COLUMNS)
    model, _ = fold_search.search("linear", {"fit_intercept": [True]}, df, "y", TablePrep(numeric=["a", "b"], categorical=["g"]))
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    new = spark.createDataFrame([(None, None, "never seen"), (3.0, 1.0, None)], "a double, b double, g string")
    one, two = (models.predict(new, m).collect() for m in (model, again))
    assert one == two and all(r["prediction"] is not None for r in one)


@pytest.mark.parametrize("shape", ["even", "ties", "far apart", "one value", "few", "infinite range"])
def test_medians_of_all_folds_but_one(spark, shape):
    rng = random.Random(shape)
    draw = {
        "even": lambda i: rng.random(), "ties": lambda i: float(rng.randint(0, 2)), "far apart": lambda i: 10.0 ** rng.randint(-200, 200), "one value": lambda i: 7.0,
        "few": lambda i: rng.random(), "infinite range": lambda i: rng.choice([-1.7e308, 1.7e308, 1.0, 2.0]),
    }[shape]
    rows = [(i, draw(i) + (i * 0.01 if shape == "even" else 0.0) if rng.random() < 0.9 else rng.choice([None, float("nan")]), i % 3 if shape == "ties" else i * 4 // 3000) for i in range(9 if shape == "few" else 3000)]
    df = spark.createDataFrame(rows, "i int, v double, fold int").repartition(3)
    got = fold_search.fold_medians(df, ["v"])
    for held in [None, *sorted({r[2] for r in rows})]:
        values = [r[1] for r in rows if r[2] != held and r[1] is not None and r[1] == r[1]]
        if values:
            low, high = statistics.median_low(values), statistics.median_high(values)
            assert got[held] == [pytest.approx(low + (high - low) * 0.5 if low != high else low, rel=1e-12)]
        else:
            assert got[held] == [None]


def test_the_source_is_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        reads.add(1)
        yield from batches

    df = spark.createDataFrame(make(100, 4), COLUMNS).coalesce(1).mapInArrow(count, COLUMNS)
    fold_search.search("ridge", {"alpha": [0.1, 1.0]}, df, "y", TablePrep(**MAKER))
    assert reads.value == 1


def test_what_cannot_be_prepared_is_named(spark):
    df = spark.createDataFrame(make(60, 3), COLUMNS)
    with pytest.raises(ValueError, match="'p'"):
        fold_search.search("ridge", {"alpha": [1.0]}, df.withColumn("p", F.expr("CASE WHEN i > 5 THEN p END")), "y", TablePrep(**MAKER))
    with pytest.raises(ValueError, match="a has no value outside fold 0"):
        fold_search.fit_folds(df.withColumn("a", F.expr("CASE WHEN fold = 0 THEN a END")), TablePrep(numeric=["a"]))
    with pytest.raises(ValueError, match="g has no value outside fold 0"):
        fold_search.fit_folds(df.withColumn("g", F.expr("CASE WHEN fold = 0 THEN g END")), TablePrep(categorical=["g"]))
    with pytest.raises(ValueError, match="two folds"):
        fold_search.fit_folds(df.where("fold = 0"), TablePrep(numeric=["a"]))
    with pytest.raises(ValueError, match="more than 2"):
        fold_search.fit_folds(df, TablePrep(categorical=["g"]), max_levels=2)
