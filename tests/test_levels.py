import hashlib

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from demandframe.operators import levels


def _held(df):
    v = F.unwrap_udt(F.col("features"))
    return {r.k: dict(zip(r.i, r.x)) for r in df.select("k", v["indices"].alias("i"), v["values"].alias("x")).collect()}


@pytest.fixture
def few(spark):
    rows = [(1, "b", "x", 1.0), (2, "a", "x", 0.0), (3, "c", None, None), (4, "b", "y", 2.0), (5, None, "y", -1.0), (6, "c", "z", 5.0), (7, "c", "z", 5.0)]
    return spark.createDataFrame(rows, "k int, p string, q string, v double")


def test_ids_are_ranks_of_digests(few):
    got = {(r["column"], r.level): (r.n, r.id) for r in levels.level_table(few, ["p", "q"]).collect()}
    for c, values in {"p": ["b", "c"], "q": ["y", "z"]}.items():
        ranked = sorted(values, key=lambda x: hashlib.md5(x.encode()).hexdigest())
        assert [got[c, x][1] for x in ranked] == [0, 1]
    assert got["p", "a"] == (1, None) and got["p", "c"][0] == 3 and len(got) == 6
    every = levels.level_table(few, ["p"], drop_first=False)
    assert sorted(r.id for r in every.collect()) == [0, 1, 2]


def test_vectors(few, spark):
    coder = levels.fit_levels(few, ["p", "q"])
    ids = {(r["column"], r.level): r.id for r in coder.levels.collect()}
    names = {r.i: r.name for r in coder.names(["v"]).collect()}
    assert coder.width(["v"]) == 5 and sorted(names) == [0, 1, 2, 3, 4] and names[0] == "v"
    got = _held(coder.transform(few, ["v"]))
    for r in few.collect():
        expected = {0: r.v} if r.v else {}
        for c, start in (("p", 1), ("q", 3)):
            if ids.get((c, r[c])) is not None:
                expected[start + ids[c, r[c]]] = 1.0
                assert names[start + ids[c, r[c]]] == f"{c}_{r[c]}"
        if r.v is None:
            assert got[r.k].pop(0) != got[r.k].get(0)  # a NULL number is NaN
        assert got[r.k] == expected
    unseen = spark.createDataFrame([(1, "new", None), (2, "b", "a")], "k int, p string, q string")
    assert _held(coder.transform(unseen)) == {1: {}, 2: {ids["p", "b"]: 1.0}}
    by_mode = _held(coder.transform(unseen, fill_mode=True))
    mode = min("xyz", key=lambda x: (-{"x": 2, "y": 2, "z": 2}[x], x))
    assert by_mode[1] == ({} if ids["q", mode] is None else {2 + ids["q", mode]: 1.0})


def test_stored_dictionary(few, spark, tmp_path):
    coder = levels.fit_levels(few, ["q", "p"], str(tmp_path / "d"))
    again = levels.load_levels(spark, str(tmp_path / "d"), ["q", "p"])
    assert (again.sizes, again.modes) == (coder.sizes, coder.modes) == ({"q": 2, "p": 2}, {"q": "x", "p": "c"})
    assert _held(again.transform(few)) == _held(coder.transform(few))


def test_odd_tables(few, spark):
    with pytest.raises(ValueError, match="already has"):
        levels.level_ids(few.withColumn("P_ID", F.lit(1)), levels.level_table(few, ["p"]), ["p"])
    with pytest.raises(ValueError, match="already has"):
        levels.fit_levels(few, ["p"]).transform(few.withColumn("Features", F.lit(1)))
    with pytest.raises(ValueError, match="no columns"):
        levels.level_table(few, [])
    nothing = levels.fit_levels(few.limit(0), ["p"])
    assert nothing.sizes == {"p": 0} and nothing.modes == {"p": None}
    with pytest.raises(ValueError, match="can't have 0"):
        nothing.transform(few)
    assert _held(nothing.transform(few, ["k"])) == {k: {0: float(k)} for k in range(1, 8)}
    # repeated rows, other types, an extra column named like a helper
    odd = spark.createDataFrame([(1, True, 5), (1, True, 5), (2, None, 6)], "k int, b boolean, level int")
    assert levels.fit_levels(odd, ["b", "level"]).transform(odd).count() == 3


def test_ids_do_not_depend_on_partitions(few, partitions):
    one = sorted(levels.level_table(few.repartition(7), ["p", "q"]).collect())
    partitions(3)
    assert sorted(levels.level_table(few.coalesce(1), ["p", "q"]).collect()) == one


def test_a_hundred_thousand_levels(spark, monkeypatch):
    """Nothing of the size of the dictionary comes to the driver, and a model can be fitted on the vectors."""
    n, most = 100_000, []
    wide = spark.range(3 * n).select((F.col("id") % n).alias("level"), "id")
    frame = type(wide)
    real = frame.collect

    def counting(df):
        rows = real(df)
        most.append(len(rows))
        return rows

    monkeypatch.setattr(frame, "collect", counting)
    coder = levels.fit_levels(wide, ["level"])
    made = coder.transform(wide)
    monkeypatch.setattr(frame, "collect", real)
    assert coder.sizes == {"level": n - 1} and most == [1]
    v = F.unwrap_udt(F.col("features"))
    seen = made.select("level", v["size"].alias("size"), v["indices"].alias("i")).groupBy("level").agg(F.collect_set("i").alias("i"), F.max("size").alias("size"))
    s = seen.agg(F.count("*").alias("n"), F.max(F.size("i")).alias("sets"), F.max(F.size(F.col("i")[0])).alias("most"), F.count_distinct(F.col("i")[0]).alias("different"), F.min("size"), F.max("size")).first()
    assert tuple(s) == (n, 1, 1, n, n - 1, n - 1)  # the base level's empty list is one of the n lists


def test_linear_model_on_sparse_vectors(spark):
    rows = spark.range(4000).select(F.concat(F.lit("g"), F.col("id") % 40).alias("g"), F.rand(3).alias("x"), (F.col("id") % 40).cast("double").alias("effect"))
    rows = rows.withColumn("label", 2 * F.col("x") + F.col("effect"))
    coder = levels.fit_levels(rows, ["g"])
    fitted = LinearRegression(solver="l-bfgs", maxIter=500, tol=1e-12).fit(coder.transform(rows, ["x"]))
    names = {r.i: r.name for r in coder.names(["x"]).collect()}
    for i, w in enumerate(fitted.coefficients):
        assert w == pytest.approx(2.0 if i == 0 else float(names[i][3:]), abs=0.05)
