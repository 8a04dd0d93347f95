import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from demandframe.operators import drift, experiments, metrics, prep, quality
from demandframe.operators.ordered import Blocking
from demandframe.plans import prepare


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- preparation


def hourly(spark, n=100):
    rng = random.Random(42)
    rows = []
    for i in range(n):
        a, b = rng.randint(0, 50), rng.randint(0, 200)
        rows.append((i + 1, "2011-01-01", rng.randint(1, 4), rng.randint(0, 1), rng.randint(1, 12), i % 24, 0, i % 7, 1, rng.randint(1, 4),
                     rng.random(), rng.random(), rng.random(), rng.random(), a, b, a + b))
    return frame(spark, rows, "instant int, dteday string, season int, yr int, mnth int, hr int, holiday int, weekday int, workingday int, weathersit int, "
                 "temp double, atemp double, hum double, windspeed double, casual int, registered int, cnt int")


def test_prepare_gives_the_model_schema(spark):
    made, stats = prepare.prepare(hourly(spark))
    plain = ["yr", "hr", "holiday", "workingday", "temp", "atemp", "hum", "windspeed", "cnt"]
    coded = [f"season_{i}" for i in range(2, 5)] + [f"mnth_{i}" for i in range(2, 13)] + [f"weekday_{i}" for i in range(1, 7)] + [f"weathersit_{i}" for i in range(2, 5)]
    assert set(made.columns) == {*plain, *coded, "split"}
    assert len(coded) == 23
    train = made.where("split = 'train'").agg(*[F.min(c).alias(f"{c}_lo") for c in ("temp", "cnt")], *[F.max(c).alias(f"{c}_hi") for c in ("temp", "cnt")]).first()
    assert (train["temp_lo"], train["temp_hi"], train["cnt_lo"], train["cnt_hi"]) == (0.0, 1.0, 0.0, 1.0)
    assert stats.count() == 1


def test_split_is_exhaustive_disjoint_and_repeatable(spark, partitions):
    df = spark.range(5000).withColumnRenamed("id", "k")
    first = prep.split(df, "k")
    assert quality.split_shares(first, {"train": 0.7, "valid": 0.15, "test": 0.15}).where("passed = 0").count() == 0
    assert quality.disjoint_keys(first, "k").first()["passed"] == 1
    partitions(3)
    again = prep.split(df.repartition(7), "k")
    assert first.join(again.withColumnRenamed("split", "s2"), "k").where("split <> s2").count() == 0
    other = prep.split(df, "k", seed=1)
    assert first.join(other.withColumnRenamed("split", "s2"), "k").where("split <> s2").count() > 500


@pytest.mark.parametrize("keys", ["id", "id * 4294967296 * 1000003", "id * 1000003 - 5000", "(id % 3) * 4294967296 + id DIV 3"])
def test_exact_split_is_right_to_the_row(spark, keys):
    """Also for keys that the hash can't tell apart."""
    for n in (0, 1, 2, 3, 10, 1001):
        df = spark.range(n).selectExpr(f"{keys} AS k", "1 AS place")
        got = prep.split_exact(df, "k")
        assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {
            s: c for s, c in zip(("train", "valid", "test"), (int(n * 0.7 + 0.5), int(n * 0.85 + 0.5) - int(n * 0.7 + 0.5), n - int(n * 0.85 + 0.5))) if c
        }
    again = prep.split_exact(df.repartition(7), "k")
    assert got.join(again.withColumnRenamed("split", "s2"), "k").where("split <> s2").count() == 0


@pytest.mark.parametrize("rows", ["id DIV 7 AS k", "id DIV 7 AS k, id AS other", "5 AS k", "5 AS k, id % 2 AS other", "5 AS k, id AS other", "CAST(NULL AS BIGINT) AS k"])
def test_exact_split_divides_equal_keys_at_a_border(spark, rows):
    """Also rows that are equal throughout; which rows go where does not depend on partitions."""
    for n in (10, 1001):
        df = spark.range(n).selectExpr(*rows.split(", "))
        got = prep.split_exact(df, "k")
        assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {
            "train": int(n * 0.7 + 0.5), "valid": int(n * 0.85 + 0.5) - int(n * 0.7 + 0.5), "test": n - int(n * 0.85 + 0.5)
        }
        assert got.columns == [*df.columns, "split"] and got.drop("split").exceptAll(df).isEmpty()
    again = prep.split_exact(df.repartition(7), "k")
    assert got.exceptAll(again).isEmpty() and again.exceptAll(got).isEmpty()


def test_null_keys_are_dealt_out(spark):
    df = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS other")
    for got in (prep.split(df, "k"), prep.split_exact(df, "k")):
        n = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
        assert 1900 < n["train"] < 2300 and n["valid"] > 300 and n["test"] > 300


def test_split_shares_hold_for_patterned_keys(spark):
    for keys in (F.col("id") * 1000, F.col("id") * 7 + 3, F.col("id") * 65536, F.col("id") + 10_000_000_000, -F.col("id")):
        df = prep.split(spark.range(20_000).select(keys.alias("k")), "k")
        shares = {r["split"]: r["count"] / 20_000 for r in df.groupBy("split").count().collect()}
        assert abs(shares["train"] - 0.7) < 0.05 and abs(shares["valid"] - 0.15) < 0.05, keys


def test_dummies_drop_first_and_null(spark):
    df = frame(spark, [(1, 1), (2, 2), (3, None), (4, 9)], "i int, c int")
    got = prep.dummies(df, {"c": [1, 2, 3]}).orderBy("i").collect()
    assert got[0].asDict() == {"i": 1, "c_2": 0, "c_3": 0}
    assert [(r["c_2"], r["c_3"]) for r in got] == [(0, 0), (1, 0), (0, 0), (0, 0)]


def test_too_many_levels_are_refused_not_cut(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        prep.observed_domain(df, "c", max_levels=20)


def test_constant_column_scales_to_zero(spark):
    df = frame(spark, [(3.0,), (3.0,), (None,)], "x double")
    got = prep.minmax_apply(df, prep.minmax_fit(df, ["x"]), ["x"]).collect()
    assert sorted([r["x"] for r in got], key=str) == [0.0, 0.0, None]


def test_scaling_does_not_clip_outside_training(spark):
    train = frame(spark, [(0.0,), (10.0,)], "x double")
    other = frame(spark, [(20.0,), (-5.0,)], "x double")
    assert sorted(r["x"] for r in prep.minmax_apply(other, prep.minmax_fit(train, ["x"]), ["x"]).collect()) == [-0.5, 2.0]


def test_columns_complete_in_training_are_not_imputed(spark):
    df = frame(spark, [(1.0, 1.0, "train"), (3.0, None, "train"), (None, None, "test"), (2.0, 5.0, "train")], "a double, b double, split string")
    got = prep.impute_median(df, ["a", "b"]).where("split = 'test'").first()
    assert (got["a"], got["b"]) == (None, 3.0)


def test_table_prep_survives_saving(spark, tmp_path):
    df = frame(spark, [(1.0, "a", 0.5), (None, "b", 1.0), (5.0, None, 2.0), (3.0, "b", 4.0)], "x double, c string, p double")
    model = Pipeline(stages=[prep.ColumnDropper(columns=["gone"]), prep.TablePrep(numeric=["x"], categorical=["c"], passthrough=["p"])]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    new = frame(spark, [(None, "z", 1.0), (9.0, None, 1.0)], "x double, c string, p double")
    got = again.transform(new).select(vector_to_array("features").alias("f")).collect()
    assert [list(r["f"]) for r in got] == [[0.5, 0.0, 1.0], [2.0, 1.0, 1.0]]
    assert again.stages[1].feature_names() == ["x", "c_b", "p"]


# ---- metrics


def brute(y, p):
    y, p = np.array(y), np.array(p)
    nz = y != 0
    return {
        "rmse": math.sqrt(np.mean((y - p) ** 2)), "mae": np.mean(abs(y - p)), "r2": 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(),
        "mape": np.mean(abs((y[nz] - p[nz]) / y[nz])) * 100,
    }


def test_metrics_against_numpy(spark):
    rng = random.Random(0)
    rows = [(rng.choice([0.0, 1.0, 2.5]) * 1e6 + rng.random(), 1e6 * rng.random()) for _ in range(200)] + [(0.0, 1.0)]
    got = metrics.regression_metrics(frame(spark, [*rows, (None, 1.0), (1.0, None)], "y double, p double"), "y", "p").first()
    assert got["n"] == 201
    for name, want in brute(*zip(*rows)).items():
        assert got[name] == pytest.approx(want)


def test_metrics_of_an_empty_group(spark):
    assert metrics.regression_metrics(frame(spark, [], "y double, p double"), "y", "p", ["y"]).count() == 0


def test_missing_metric_never_wins(spark):
    table = frame(spark, [("a", None), ("b", 2.0), ("c", 2.0)], "Model string, Test_RMSE double")
    assert metrics.best_model(table).first()["Model"] == "b"


def test_degradation_without_reference_error(spark):
    ref, cur = frame(spark, [(0.0,)], "rmse double"), frame(spark, [(2.0,)], "rmse double")
    row = metrics.degradation(ref, cur).first()
    assert (row["rmse_delta"], row["rmse_pct_increase"]) == (2.0, None)


def test_metrics_document_is_one_json_line(spark, tmp_path):
    from demandframe.sources import tables as io

    one = frame(spark, [(0.04, 0.02, 0.87)], "rmse double, mae double, r2 double")
    two = frame(spark, [(0.12, 0.08, -0.09)], "rmse double, mae double, r2 double")
    io.write_metrics_document(metrics.metrics_document(one, two, "m"), str(tmp_path / "doc"))
    got = io.read_metrics_document(spark, str(tmp_path / "doc")).first()
    assert got["degradation"]["rmse_pct_increase"] == pytest.approx(200.0)
    assert got["reference_metrics"]["mae"] == 0.02


# ---- drift


def ks_brute(a, b):
    grid = sorted({*a, *b})
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in grid)


@pytest.mark.parametrize("blocking", [Blocking(), Blocking(rows_per_block=15, fraction=1.0)])
def test_ks_against_brute_force(spark, blocking):
    rng = random.Random(1)
    a = [rng.gauss(0, 1) for _ in range(120)] + [0.0] * 60
    b = [rng.gauss(0.4, 1) for _ in range(90)] + [0.0] * 10
    fa, fb = (frame(spark, [(v,) for v in s], "x double") for s in (a, b))
    row = drift.ks_two_sample(fa, fb, "x", blocking=blocking).first()
    assert row["statistic"] == pytest.approx(ks_brute(a, b))
    assert (row["n_base"], row["n_new"]) == (180, 100)


def test_ks_tail_values(spark):
    """Published values of the Kolmogorov distribution."""
    df = frame(spark, [(0.5,), (0.8276,), (1.0,), (1.2238,), (1.3581,), (1.6276,), (0.01,), (5.0,)], "t double").withColumn("p", drift.kolmogorov_sf(F.col("t")))
    got = [round(r["p"], 3) for r in df.collect()]
    assert got == [0.964, 0.5, 0.27, 0.1, 0.05, 0.01, 1.0, 0.0]


def test_ks_with_an_empty_side(spark):
    a, b = frame(spark, [(1.0,), (2.0,)], "x double"), frame(spark, [(None,)], "x double")
    row = drift.ks_two_sample(a, b, "x").first()
    assert (row["p_value"], row["drift_detected"]) == (1.0, 0)
    both = drift.ks_two_sample(b, b, "x").collect()
    assert [(r["feature"], r["n_base"], r["p_value"], r["drift_detected"]) for r in both] == [("x", 0, 1.0, 0)]


def test_chi2_two_by_two_uses_yates(spark):
    def side(n, yes):
        return frame(spark, [("y" if i < yes else "n",) for i in range(n)], "c string")

    row = drift.chi2_homogeneity(side(30, 20), side(30, 10), "c").first()
    assert row["statistic"] == pytest.approx(5.4)
    assert row["dof"] == 1
    assert row["p_value"] == pytest.approx(math.erfc(math.sqrt(5.4 / 2)))


def test_chi2_counts_pairs_that_never_occur(spark):
    a = frame(spark, [("x",)] * 10 + [("y",)] * 10, "c string")
    b = frame(spark, [("y",)] * 10 + [("z",)] * 10, "c string")
    table = np.array([[10, 10, 0], [0, 10, 10]])
    e = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    row = drift.chi2_homogeneity(a, b, "c").first()
    assert row["statistic"] == pytest.approx(((table - e) ** 2 / e).sum())
    assert row["p_value"] == pytest.approx(math.exp(-row["statistic"] / 2))


def test_paired_chi2_calls_identical_tables_drift(spark):
    t = frame(spark, [(i, "ab"[i % 2]) for i in range(40)], "i int, c string")
    paired, fair = drift.chi2_paired(t, t, "c", "i").first(), drift.chi2_homogeneity(t, t, "c").first()
    assert (paired["drift_detected"], fair["drift_detected"]) == (1, 0)
    assert paired["statistic"] == pytest.approx(4 * (10 - 0.5) ** 2 / 10)


def test_missing_labels_are_a_label(spark):
    a, b = frame(spark, [(None,)] * 30, "c string"), frame(spark, [("x",)] * 30, "c string")
    assert drift.chi2_homogeneity(a, b, "c").first()["drift_detected"] == 1


def test_single_label_is_no_drift(spark):
    a = frame(spark, [("x",)] * 5, "c string")
    row = drift.chi2_homogeneity(a, a, "c").first()
    assert (row["statistic"], row["p_value"], row["drift_detected"]) == (0.0, 1.0, 0)


def test_perturb_touches_present_columns_only(spark):
    df = frame(spark, [(0.95, 22), (None, None)], "temp double, hr int")
    got = drift.perturb(df).collect()
    assert (got[0]["temp"], got[0]["hr"]) == (1.0, 1)
    assert (got[1]["temp"], got[1]["hr"]) == (None, None)


def test_alert_levels(spark):
    rows = [(1, 0.0, 0.0, 0.0), (2, 6.0, 0.0, 0.0), (3, 0.0, -6.0, 0.0), (4, 11.0, 0.0, 0.0), (5, 0.0, 0.0, -0.06), (6, 0.0, 0.0, 0.06)]
    got = drift.alert_level(frame(spark, rows, "i int, delta_rmse double, delta_mae double, delta_r2 double")).orderBy("i").collect()
    assert [r["alert"] for r in got] == ["green", "yellow", "yellow", "red", "red", "green"]


# ---- experiments and requests


def test_leaderboard_and_promotion(spark):
    runs = frame(spark, [("r1aaaaaaaa", "x", 50.0, 1.0, 0.9), ("r2bbbbbbbb", "y", None, 1.0, 0.95), ("r3cccccccc", "z", 50.0, 2.0, 0.1)],
                 "run_id string, run_name string, test_rmse double, test_mae double, test_r2 double").withColumn("valid_rmse", F.lit(None).cast("double"))
    board = experiments.leaderboard(runs, n=2)
    assert [r["run_id"] for r in board.collect()] == ["r1aaaaaa", "r3cccccc"]
    assert experiments.promote(board).first()["promoted"] == 1
    weak = board.withColumn("test_r2", F.lit(0.5))
    assert experiments.promote(weak).first()["promoted"] == 0


def test_local_metrics_fall_back(spark):
    local = frame(spark, [("b", "B", 0.0, 7.0, 2.0)], "run_id string, run_name string, test_rmse double, rmse double, mae double")
    row = experiments.local_metrics(local).first()
    assert (row["test_rmse"], row["test_mae"], row["valid_rmse"]) == (7.0, 2.0, math.inf)
    assert math.isnan(row["test_r2"])


@pytest.mark.parametrize(
    "features, n, status",
    [([[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]], 3, 200), (None, 3, 400), ([], 3, 422), ([[1.0, 2.0], [3.0, 4.0, 5.0]], 3, 422), ([[1.0, 2.0]], 3, 422), ([[1.0, 2.0]], None, 200)],
)
def test_request_checks(spark, features, n, status):
    df = frame(spark, [(1, features)], "i int, features array<array<double>>")
    row = quality.validate_requests(df, "features", n).first()
    assert row["status"] == status
    assert (row["error"] is None) == (status == 200)


def test_finite_rule(spark):
    df = frame(spark, [(1.0,), (math.inf,), (-math.inf,), (math.nan,), (None,)], "x double")
    assert quality.assert_table(df, {"finite": quality.finite("x")}).first()["violations"] == 3


def test_a_scenario_without_the_base_level_keeps_the_training_levels(spark):
    from demandframe.plans import monitor

    new = spark.createDataFrame([("b", 1.0, 5.0), ("c", 2.0, 6.0), (None, 3.0, 7.0)], "kind string, x double, y double")
    got = [tuple(r) for r in monitor.aligned(new, ["x", "kind_b", "kind_c"], "y").collect()]
    assert got == [(1.0, 1, 0, 5.0), (2.0, 0, 1, 6.0), (3.0, 0, 0, 7.0)]


def test_chi_square_tail(spark):
    import math

    cases = [(3.84, 1), (10.0, 4), (0.5, 7), (200.0, 150), (1.0, 900), (1e6 + 100, 1_000_000), (9e8, 900_000_000), (-1.0, 3)]
    rows = spark.createDataFrame([(float(x), float(k)) for x, k in cases], "x double, k double")
    got = [r["p"] for r in rows.select(drift.chi2_sf("x", "k").alias("p")).collect()]
    assert got[0] == pytest.approx(math.erfc(math.sqrt(3.84 / 2)), rel=1e-9) and got[1] == pytest.approx(math.exp(-5) * 6, rel=1e-9)
    assert got[7] == 1.0 and got[4] == pytest.approx(1.0)
    # near its mean a wide chi-square is nearly normal
    for p, (x, k) in zip(got[5:7], cases[5:7]):
        z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
        assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=1e-4)
