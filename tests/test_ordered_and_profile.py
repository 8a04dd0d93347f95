import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandframe.functions import columns as fc
from demandframe.operators import lookup, ordered, profile, ranking
from demandframe.operators.ordered import Blocking

BLOCKINGS = [Blocking(), Blocking(block_size=13), Blocking(rows_per_block=25, fraction=1.0), Blocking(rows_per_block=60, fraction=0.5)]


@pytest.fixture(scope="module")
def table(spark):
    """300 rows; one key holds most of them, another is NULL, a third of the values is missing."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        key = None if i % 17 == 0 else ("hot" if i % 3 else f"k{i % 5}")
        rows.append((i * 3, key, None if rng.random() < 0.33 else rng.randint(0, 40) / 4))
    rng.shuffle(rows)
    pdf = pd.DataFrame(sorted(rows), columns=["o", "k", "v"])
    return spark.createDataFrame(rows, "o bigint, k string, v double").repartition(5), pdf


def listed(df, c):
    return [None if v is None or v != v else v for v in (r[c] for r in df.orderBy("o").collect())]


def clean(series):
    return [None if pd.isna(v) else v for v in series]


@pytest.mark.parametrize("n", [1, 16])
@pytest.mark.parametrize("blocking", BLOCKINGS)
def test_ordered_operators_against_pandas(spark, table, partitions, blocking, n):
    partitions(n)
    df, pdf = table
    keyed = pdf.groupby("k", dropna=False)
    assert listed(ordered.fill_next_valid(df, "v", "o", blocking=blocking), "v") == clean(pdf["v"].bfill())
    assert listed(ordered.fill_next_valid(df, ["v"], "o", ["k"], blocking), "v") == clean(keyed["v"].bfill())
    assert listed(ordered.row_index(df, "o", blocking=blocking), "row_index") == list(range(300))
    assert listed(ordered.seq_in_group(df, ["k"], "o", blocking=blocking), "seq") == list(keyed.cumcount() + 1)
    assert listed(ordered.previous(df, "v", "o", blocking=blocking), "previous") == clean(pdf["v"].shift())
    assert listed(ordered.previous(df, "v", "o", ["k"], blocking=blocking), "previous") == clean(keyed["v"].shift())
    full = pdf.assign(v=pdf["v"].fillna(1.0))
    filled = df.fillna(1.0, ["v"])
    got = listed(ordered.centered_mean(filled, "v", "o", 7, blocking=blocking, chunk=20), "trend")
    want = clean(full["v"].rolling(7, center=True).mean())
    assert [None if g is None else round(g, 9) for g in got] == [None if w is None else round(w, 9) for w in want]
    sums = listed(ordered.running_sums(filled, "o", {"s": "v"}, blocking=blocking), "s")
    assert np.allclose(sums, full["v"].cumsum())


def test_chunks_smaller_than_the_window(spark):
    df = spark.range(40).select(F.col("id").alias("o"), F.col("id").cast("double").alias("v"))
    got = listed(ordered.centered_mean(df, "v", "o", 9, blocking=Blocking(block_size=3), chunk=2), "trend")
    assert got == [None] * 4 + [float(i) for i in range(4, 36)] + [None] * 4


def test_borders_follow_the_data(spark):
    df = spark.range(100_000).select((F.col("id") ** 3).alias("o"))
    b = ordered.sample_borders(df, "o", Blocking(rows_per_block=10_000, fraction=0.1))
    assert 80_000 < b.rows < 120_000
    sizes = ordered.with_block(df, "o", borders=b).groupBy("_block").count().toPandas()["count"]
    assert len(sizes) >= 9 and sizes.max() < 20_000


@pytest.mark.parametrize("blocking", [Blocking(block_size=3), Blocking(rows_per_block=3, fraction=1.0)])
def test_rows_without_an_order_come_first(spark, blocking):
    df = spark.createDataFrame([(None, 1.0)] + [(i, float(i)) for i in range(12)], "o long, v double")
    got = {r["o"]: r["s"] for r in ordered.running_sums(df, "o", {"s": "v"}, blocking=blocking).collect()}
    assert got == {None: 1.0, **{i: 1.0 + i * (i + 1) / 2 for i in range(12)}}


def test_blocks_grow_in_number_not_in_size(spark):
    df = spark.range(20_000).select(F.col("id").alias("o"))
    b = ordered.sample_borders(df, "o", Blocking(rows_per_block=50, fraction=1.0))
    assert len(b.cuts) > 300


def test_borders_are_the_same_in_every_branch(spark):
    """No partition id in the plan: the block is an expression over the order column."""
    df = spark.range(1000).select(F.col("id").alias("o"))
    blocked = ordered.with_block(df, "o", Blocking(rows_per_block=100, fraction=1.0))
    assert blocked.repartition(3).groupBy("o").agg(F.max("_block").alias("b")).join(blocked, "o").where("b <> _block").count() == 0


QS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("sketch", [20_000, 10])
@pytest.mark.parametrize("given", [[1.0, 2, 3, 4], [5.0] * 20, [1.0], list(range(57)), [1.0, 1, 1, 1e9, -1e-9], [1.0] * 500 + list(range(500)), [i**3 for i in range(400)]])
def test_quantiles_against_numpy(spark, monkeypatch, given, sketch):
    monkeypatch.setattr(profile, "SKETCH", sketch)
    df = spark.createDataFrame([(float(v),) for v in given], "x double").unionByName(spark.createDataFrame([(None,), (float("nan"),)], "x double"))
    got = {r["quantile"]: r["value"] for r in profile.quantiles(df, ["x"], QS).collect()}
    for q in QS:
        assert got[q] == pytest.approx(np.quantile(given, q))


def test_quantiles_by_group_against_pandas(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 4 else f"g{i % 3}", rng.gauss(0, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x double")
    want = pd.DataFrame(rows, columns=["g", "x"]).groupby("g")["x"].quantile(0.3)
    got = profile.quantiles(df, ["x"], [0.3], ["g"]).collect()
    assert {r["g"]: pytest.approx(r["value"]) for r in got} == dict(want)


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    got = {r["quantile"]: r["value"] for r in profile.quantiles(df, ["x"], [0.25, 0.5], accuracy=1000).collect()}
    assert abs(got[0.25] - 2500) < 30 and abs(got[0.5] - 5000) < 30


def test_describe_against_pandas(spark):
    given = [3.0, 1.0, 4.0, 1.0, 5.0, None]
    r = profile.describe(spark.createDataFrame([(v,) for v in given], "x double"), ["x"]).first()
    d = pd.Series(given).describe()
    assert [r[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(d))


def test_shape_stats_are_bias_corrected(spark):
    r = profile.shape_stats(spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)], "x double"), ["x"]).first()
    assert (round(r["skewness"], 3), round(r["kurtosis"], 3)) == (1.697, 3.152)
    two = profile.shape_stats(spark.createDataFrame([(1.0,), (2.0,)], "x double"), ["x"]).first()
    assert two["skewness"] is None and two["kurtosis"] is None


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (10, "a"), (9, "b")], "n int, s string")
    assert {r["column"]: r["mode"] for r in profile.modes(df, ["n", "s"]).collect()} == {"n": "9", "s": "a"}


def test_histogram_against_numpy(spark):
    for given in ([0.0, 1, 2, 3, 10, 10], [4.0, 4.0], [random.Random(1).random() for _ in range(200)]):
        df = spark.createDataFrame([(float(v),) for v in given], "x double")
        n, edges = np.histogram(given, bins=7)
        rows = profile.histogram(df, "x", 7).orderBy("bin").collect()
        assert [r["n"] for r in rows] == list(n)
        assert [r["lo"] for r in rows] == pytest.approx(list(edges[:-1]))


def test_box_stats(spark):
    given = [float(v) for v in (1, 2, 3, 4, 5, 6, 7, 8, 9, 100)]
    r = profile.box_stats(spark.createDataFrame([(v,) for v in given], "x double"), "x").first()
    assert (r["median"], r["whisker_lo"], r["whisker_hi"], r["n_out"]) == (5.5, 1.0, 9.0, 1)


def test_correlations_against_pandas(spark):
    rng = random.Random(5)
    rows = [(a := rng.random(), a * 2 + rng.random(), rng.random()) for _ in range(50)]
    want = pd.DataFrame(rows, columns=list("abc")).corr()
    for r in profile.correlations(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect():
        assert r["corr"] == pytest.approx(want.loc[r["a"], r["b"]])


def test_null_profile_lists_only_gaps(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "x", float("nan"))], "a int, b string, c double")
    assert {(r["column"], r["n_null"], r["pct"]) for r in profile.null_profile(df).collect()} == {("b", 1, 50.0), ("c", 1, 50.0)}


# ---- look-ups


def test_summary_join(spark):
    df = spark.range(50).select((F.col("id") % 7).alias("k"), "id")
    summary = df.groupBy("k").agg(F.max("id").alias("m"))
    got = lookup.join_summary(df, summary, ["k"]).collect()
    assert len(got) == 50 and all(r["m"] % 7 == r["k"] and r["m"] > 42 for r in got)


def test_with_stats_is_a_subquery(spark):
    df = spark.range(10)
    out = lookup.with_stats(df, df.agg(F.max("id").alias("m"), F.min("id").alias("lo")))
    assert {(r["m"], r["lo"]) for r in out.collect()} == {(9, 0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_flag_in_ignores_null(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "c int")
    members = spark.createDataFrame([(1,), (None,)], "c int")
    assert sorted(r["is_in"] for r in lookup.flag_in(df, "c", members).collect()) == [0, 0, 1]


def test_picks_break_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None), (4, 9.0)], "i int, v double")
    assert ranking.arg_min(df, "v", "i").first()["i"] == 1
    assert ranking.arg_max(df, "v", "i").first()["i"] == 4
    assert [r["i"] for r in ranking.top_k(df, [("v", "desc")], 3, ["i"]).collect()] == [4, 1, 2]
    assert ranking.first_row(df, "i").first()["i"] == 1


def test_median_matches_statistics(spark):
    given = [4.0, 1.0, 3.0, 2.0]
    row = profile.quantile_row(spark.createDataFrame([(v,) for v in given], "x double"), ["x"], [0.5]).first()
    assert row["x"][0] == statistics.median(given)


def test_a_round_of_selection_computes_a_column_once(spark, monkeypatch):
    """And not anew for each bound of each bracket."""
    df = spark.range(30_000).selectExpr("CAST(id * 7919 % 30011 AS STRING) AS t").select(fc.number_or_null("t").alias("v"))
    plans, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or collect(self))
    got = profile.select_ranks(df, ["v"], [0.1, 0.3, 0.5, 0.7, 0.9], lambda n, q: {int(n * q), int(n * q) + 1})["v"]
    monkeypatch.undo()
    ordered_values = sorted(r.v for r in df.collect())
    assert got == (30_000, {r: ordered_values[r] for q in (0.1, 0.3, 0.5, 0.7, 0.9) for r in (int(30_000 * q), int(30_000 * q) + 1)})
    # twice (the value, and whether it is NaN) in each of the two parts of a round
    assert plans and max(p.count("RLIKE") for p in plans) <= 4
