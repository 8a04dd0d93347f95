import pytest
from pyspark.sql import functions as F

from demandframe.operators import drift


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("base") / "t")
    rows = spark.range(3000).select(
        (F.col("id") % 101).cast("double").alias("a"), F.when(F.col("id") % 7 != 0, F.col("id") % 13).alias("b"),
        F.concat(F.lit("g"), F.col("id") % 5).alias("g"), (F.col("id") % 3 == 0).alias("f"), F.col("id").alias("y"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


SPECS = {"up": {"a": {"add": 9}}, "wrap": {"b": {"add": 4, "mod": 13}, "a": {"add": 1, "clip": (0.0, 60.0)}}, "same": {}}


def _rows(df):
    return {(r.scenario, r.feature, r.kind): (None if r.statistic is None else round(r.statistic, 9), round(r.p_value, 9), r.drift_detected) for r in df.collect()}


def test_as_one_report_per_scenario(base):
    tables = {n: drift.perturb(base, s) for n, s in SPECS.items()}
    tables["few labels"] = base.where("g <> 'g4'").withColumn("f", F.lit(None).cast("boolean")).drop("b")
    tables["empty"] = base.limit(0)
    expected = {}
    for n, t in tables.items():
        expected |= _rows(drift.drift_report(base, t, "y").withColumn("scenario", F.lit(n)))
    assert _rows(drift.scenario_reports(base, tables, "y")) == expected
    assert ("few labels", "b", "ks") not in expected and expected["few labels", "g", "chi2"][2] == 1


def test_one_table_of_all(base):
    stacked = drift.perturbed(base, SPECS).unionByName(drift.perturbed(base.limit(5), {"gone": {}}).withColumn("scenario", F.lit(None).cast("string")))
    assert _rows(drift.scenario_reports(base, stacked, "y")) == _rows(drift.scenario_reports(base, {n: drift.perturb(base, s) for n, s in SPECS.items()}, "y"))


def test_copies_are_those_of_perturb(base):
    got = drift.perturbed(base, SPECS)
    assert got.columns == [*base.columns, "scenario"]
    for n, s in SPECS.items():
        one = drift.perturb(base, s)
        assert sorted(map(str, got.where(F.col("scenario") == n).select(*[F.col(c).cast(one.schema[c].dataType) for c in base.columns]).collect())) == sorted(map(str, one.collect()))


def test_scans_do_not_grow_with_scenarios(base):
    def scans(k):
        cases = {f"s{i}": {"a": {"add": i}} for i in range(k)}
        return drift.scenario_reports(base, drift.perturbed(base, cases), "y")._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")

    assert scans(1) == scans(6)


def test_refused(base):
    with pytest.raises(ValueError, match="no scenarios"):
        drift.perturbed(base, {})
    with pytest.raises(ValueError, match="already has"):
        drift.perturbed(base, SPECS, "G")
    with pytest.raises(ValueError, match="share no column"):
        drift.scenario_reports(base, {"x": base.select("y")}, "y")


def test_pairs_shuffle_rows_once(base):
    """The pair of rows meets once; what is shuffled afterwards are counts."""
    t = base.withColumnRenamed("y", "r0").select("r0", "g", "f", "a")
    got = {r.feature: (r.n, r.dof, r.drift_detected) for r in drift.chi2_paired(t, t, ["g", "f"], "r0").collect()}
    assert got == {"g": (3000, 16, 1), "f": (3000, 1, 1)}
    plan = drift.chi2_paired(t, t, ["g", "f"], "r0")._jdf.queryExecution().optimizedPlan().toString()
    assert "unpivot" not in plan.lower() and plan.index("Generate inline") < plan.rindex("Join Inner")
