"""Jobs from files to published outputs."""

import random

import pytest
from pyspark.sql import functions as F

from demandframe.operators.prep import TablePrep
from demandframe.plans import monitor, prepare, training
from demandframe.sources import publish
from demandframe.sources import tables as io

RULES = prepare.PrepareRules(key="i", domains={"g": ["u", "v"]}, integers=("i",), doubles=("a",), drop=("gone",), scale=("a",), target="y")


@pytest.fixture
def raw(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.random(), rng.choice("uv"), float(i % 9), 1) for i in range(200)]
    df = spark.createDataFrame([(*r, 3 * r[1] + r[3]) for r in rows], "i long, a double, g string, b double, gone int, y double")
    io.write_table(df, str(tmp_path / "raw"))
    return str(tmp_path / "raw")


def test_a_reader_sees_the_run_that_finished_last(spark, tmp_path):
    folder = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError, match="no finished demo job"):
        publish.published(spark, folder, "demo")
    one = publish.JobOutput(spark, folder, "demo")
    one.table("t", spark.range(3))
    with pytest.raises(FileNotFoundError):  # written, not published
        publish.read_output(spark, folder, "demo", "t")
    row = one.publish({"note": "first"})
    assert row["tables"] == ["t"] and row["facts"] == {"note": "first"}
    two = publish.JobOutput(spark, folder, "demo")
    two.table("t", spark.range(7))  # a second run that dies here changes nothing
    assert publish.read_output(spark, folder, "demo", "t").count() == 3
    two.publish()
    assert publish.read_output(spark, folder, "demo", "t").count() == 7
    with pytest.raises(FileNotFoundError, match="has no table 'u'"):
        publish.read_output(spark, folder, "demo", "u")
    with pytest.raises(FileNotFoundError):
        publish.published(spark, folder, "another")


def test_prepare_train_compare_monitor(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    splits = prepare.run(spark, raw, out, RULES)
    assert {r[0] for r in splits.select("split").distinct().collect()} == {"train", "valid", "test"}
    facts = publish.published(spark, out, "prepare")["facts"]
    assert sum(int(v) for v in facts.values()) == 200
    config = {"linear": {"folds": 3, "grid": {"fit_intercept": [True]}}, "ridge": {"folds": 3, "grid": {"alpha": [1e6]}}, "off": {"enabled": False, "grid": {}}, "odd": {"grid": {"alpha": [1]}}}
    training.run(spark, out, out, "y", "i", config)
    status = {r["model"]: r for r in publish.read_output(spark, out, "train", "status").collect()}
    assert {m: r["status"] for m, r in status.items()} == {"linear": "trained", "ridge": "trained", "off": "disabled", "odd": "failed"}
    assert "unknown model" in status["odd"]["message"]
    assert publish.published(spark, out, "train")["facts"]["best"] == "linear"
    compared = training.compare_saved(spark, out, splits.where("split = 'test'"), "y").collect()
    assert [r["model"] for r in compared] == ["linear", "ridge"] and compared[0]["rmse"] < 1e-6 < compared[1]["rmse"]
    base, moved = str(tmp_path / "base"), str(tmp_path / "moved")
    io.write_table(splits.drop("split"), base)
    io.write_table(splits.drop("split").withColumn("b", F.col("b") + 20), moved)
    summary = monitor.run(spark, base, {"same": base, "moved": moved}, out, out, "y").collect()
    assert {r["scenario"]: r["alert"] for r in summary} == {"same": "green", "moved": "red"}
    report = {(r["scenario"], r["feature"]): r["drift_detected"] for r in publish.read_output(spark, out, "monitor", "features").collect()}
    assert report["moved", "b"] == 1 and report["same", "b"] == 0
    with pytest.raises(ValueError, match="no model 'x'"):
        monitor.run(spark, base, {}, out, out, "y", "x")


def test_a_split_without_rows_publishes_nothing(spark, raw, tmp_path):
    out, few = str(tmp_path / "out"), str(tmp_path / "few")
    io.write_table(spark.read.parquet(raw).limit(1), few)
    with pytest.raises(ValueError, match="splits without rows"):
        prepare.run(spark, few, out, RULES)
    with pytest.raises(FileNotFoundError):
        publish.published(spark, out, "prepare")
    io.write_table(spark.read.parquet(raw).limit(0), few)
    with pytest.raises(ValueError, match="contains no data"):
        prepare.run(spark, few, out, RULES)
    with pytest.raises(FileNotFoundError):
        prepare.run(spark, str(tmp_path / "nowhere"), out, RULES)
    with pytest.raises(FileNotFoundError, match="no finished prepare job"):
        training.run(spark, out, out, "y", "i", {})


def test_models_that_prepare_raw_columns(spark, raw):
    df = spark.read.parquet(raw).drop("gone").withColumn("a", F.expr("CASE WHEN i % 6 > 0 THEN a END")).withColumn("split", F.expr("CASE WHEN i % 4 > 0 THEN 'train' ELSE 'test' END"))
    prep = TablePrep(numeric=["a", "b"], categorical=["g"])
    fitted, scores, status = training.train_models({"linear": {"folds": 3, "grid": {"fit_intercept": [True]}}, "lasso": {"folds": 3, "grid": {"alpha": [0.001]}}}, df, "y", "i", prep=prep)
    assert set(fitted) == {"linear", "lasso"} and {r["status"] for r in status.collect()} == {"trained"}
    assert scores.where("split = 'test' AND model = 'linear'").first()["rmse"] < 1.5


def test_the_shipped_settings_run(spark, raw):
    """All linear models of the default settings, as they are."""
    df = spark.read.parquet(raw).select("i", "a", "b", "y", F.expr("CASE WHEN i % 4 > 0 THEN 'train' ELSE 'test' END").alias("split"))
    config = {n: c for n, c in training.DEFAULT_CONFIG.items() if n != "boosted"}
    _, scores, status = training.train_models(config, df, "y", "i")
    assert {r["model"]: r["status"] for r in status.collect()} == {n: "trained" if c["enabled"] else "disabled" for n, c in config.items()}
    assert scores.count() == 8


def test_an_error_that_is_not_the_models_stops_the_job(spark, raw, monkeypatch):
    df = spark.read.parquet(raw).select("i", "a", "y", F.lit("train").alias("split"))

    def lost(*_, **__):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(training.models, "search", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        training.train_models({"linear": {"grid": {"fit_intercept": [True]}}}, df, "y", "i")
