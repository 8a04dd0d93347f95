import datetime

import pytest
from pyspark.sql import functions as F

from demandframe.functions import columns as fc
from demandframe.operators import ordered, repair, typing
from demandframe.operators.ordered import Blocking
from demandframe.plans import clean

SMALL = Blocking(block_size=2)


def column(spark, values, kind="double", order="i"):
    rows = [(i, float(v) if kind == "double" and v is not None else v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"{order} bigint, c {kind}")


def values(df, c="c", order="i"):
    return [r[c] for r in df.orderBy(order).collect()]


# ---- typing


def test_number_texts(spark):
    texts = [" 12 ", "1e3", "1d", "2f", "nan", "inf", "-inf", "", None, "+.5", "5.", "1,5", "0x1F", "\t7\n", "--1", "1e"]
    got = values(typing.coerce_numeric(column(spark, texts, "string"), ["c"]))
    inf = float("inf")
    assert got == [12.0, 1000.0, None, None, None, inf, -inf, None, None, 0.5, 5.0, None, None, 7.0, None, None]


def test_nan_becomes_null(spark):
    assert values(typing.coerce_numeric(column(spark, [1.0, float("nan"), None]), ["c"])) == [1.0, None, None]


def test_non_numeric_values_are_counted(spark):
    df = spark.createDataFrame([("1", "x"), ("bad", "x"), ("bad", "2"), (None, "3")], "a string, b string")
    got = {(r["column"], r["value"], r["n"]) for r in typing.non_numeric_values(df, ["a", "b"]).collect()}
    assert got == {("a", "bad", 2), ("a", None, 1), ("b", "x", 2)}


def test_strict_dates(spark):
    texts = ["2011-01-01 00:00", "20110101", "2011/01/01", "2011-02-30", "2011-1-1", " 2011-12-31 ", None, "2011-13-01", "11-01-01"]
    d = datetime.date
    assert values(typing.parse_date(column(spark, texts, "string"), "c")) == [None, None, None, None, d(2011, 1, 1), d(2011, 12, 31), None, None, None]


@pytest.mark.parametrize(
    "given, expected",
    [([1.0, None, 3.0], [1, None, 3]), ([1e6, 2e6, 3e6], [1000000, 2000000, 3000000]), ([0.5, 1.5, 2.5, -0.5], [0, 2, 2, 0])],
)
def test_nullable_int_rounds_half_even(spark, given, expected):
    assert values(typing.to_nullable_int(column(spark, given), ["c"])) == expected


def test_weekday_starts_on_monday(spark):
    df = column(spark, [datetime.date(2011, 1, 3), datetime.date(2011, 1, 1), None], "date")
    assert [r["weekday"] for r in typing.date_parts(df, "c").orderBy("i").collect()] == [0, 5, None]


def test_columns_of_kind(spark):
    df = spark.createDataFrame([], "a int, b string, c boolean, d date, e double")
    assert typing.columns_of_kind(df, "number") == ["a", "e"]
    assert typing.columns_of_kind(df, "text") == ["b"]
    assert typing.columns_of_kind(df, "bool") == ["c"]
    assert typing.columns_of_kind(df, "time") == ["d"]


def test_two_parts(spark):
    df = column(spark, ["name:8", "name:Production", "name", "a:b:c:8", None], "string")
    left, right, ok = fc.two_parts("c")
    got = [tuple(r) for r in df.select("i", left, right, ok).orderBy("i").collect()]
    assert got == [(0, "name", "8", True), (1, "name", "Production", True), (2, None, None, False), (3, None, None, False), (4, None, None, False)]


def test_stem_and_base_name(spark):
    df = column(spark, ["data/x/dataset_wind_drift.csv", "plain", ".hidden"], "string")
    got = [tuple(r) for r in df.orderBy("i").select(fc.base_name("c"), fc.stem("c")).collect()]
    assert got == [("dataset_wind_drift.csv", "dataset_wind_drift"), ("plain", "plain"), (".hidden", ".hidden")]


# ---- bounds and fills


@pytest.mark.parametrize(
    "given, expected",
    [
        ([0.5, 0.8, 1.5, 2.0, 0.3], [0.5, 0.8, 0.3, 0.3, 0.3]),
        ([0.5, None, None, 0.8, 0.3], [0.5, 0.8, 0.8, 0.8, 0.3]),
        ([0.0, 0.5, 1.0, 0.75], [0.0, 0.5, 1.0, 0.75]),
        ([None, None, None], [None, None, None]),
        ([0.2, None, 1.7], [0.2, None, None]),
        ([], []),
    ],
)
@pytest.mark.parametrize("blocking", [SMALL, Blocking(), Blocking(rows_per_block=2, fraction=1.0)])
def test_bound_and_fill(spark, given, expected, blocking):
    assert values(repair.bound_and_fill(column(spark, given), {"c": 1.0}, "i", blocking=blocking)) == expected


def test_negative_values_stay_within_the_upper_bound(spark):
    assert values(repair.bound_to_null(column(spark, [-3.0, 2.0]), {"c": 1.0})) == [-3.0, None]


def test_clamp_keeps_null(spark):
    assert values(repair.clip_columns(column(spark, [None, -1.0, 0.5, 2.0]), {"c": (0.0, 1.0)})) == [None, 0.0, 0.5, 1.0]


# ---- outliers


def flagged(spark, given, k=1.5, **kw):
    return [i for i, v in enumerate(values(repair.iqr_flag(column(spark, given), ["c"], k, **kw), "c_outlier")) if v]


def test_iqr_flags(spark):
    assert flagged(spark, [10.0, 12, 11, 13, 10, 12, 1000, 15, 14, 11]) == [6]
    assert flagged(spark, [10.0, 10, 10, 100, 10, 10]) == [3]
    assert flagged(spark, [5.0] * 6) == []
    assert flagged(spark, [7.0]) == []
    assert {10, 11} <= set(flagged(spark, [5.0, 10, 12, 11, 13, 10, 12, 15, 14, 11, 50, -20]))
    strict = flagged(spark, [10.0, 12, 11, 13, 10, 12, 50, 15, 14, 11, 60], 1.5)
    lenient = flagged(spark, [10.0, 12, 11, 13, 10, 12, 50, 15, 14, 11, 60], 3.0)
    assert set(lenient) <= set(strict)


def test_only_exclusive_outliers_are_replaced(spark):
    rows = [(i, 10 + i % 3, 20 + i % 3, 30 + i % 3) for i in range(20)]
    rows += [(20, 900, 21, 31), (21, 900, 900, 31), (22, 11, 21, 900), (23, None, 900, 31)]
    df = spark.createDataFrame(rows, "i bigint, a bigint, b bigint, t bigint")
    got = {r["i"]: tuple(r)[1:] for r in repair.replace_exclusive_outliers(df, ["a", "b", "t"], 2.5).collect()}
    assert got[20] == (11, 21, 31)
    assert got[21] == (900, 900, 31)
    assert got[22] == (11, 21, 31)
    assert got[23] == (None, 21, 31)


# ---- counts


def triples(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i bigint, a bigint, b bigint, t bigint")


def read(df):
    return [tuple(r)[1:] for r in df.orderBy("i").collect()]


def test_fill_by_identity(spark):
    rows = [(1, 2, None), (None, 2, 5), (1, None, 5), (None, None, 5), (None, 2, None), (1, 2, 9)]
    assert read(repair.fill_by_identity(triples(spark, rows), "a", "b", "t")) == [(1, 2, 3), (3, 2, 5), (1, 4, 5), (None, None, 5), (None, 2, None), (1, 2, 9)]


def test_fix_identity(spark):
    rows = [(5, 20, 30), (10, 30, 50), (8, 25, 40), (9, 9, 1), (50, 1, 2), (1, 50, 2), (1, None, 2), (30, 2, 30)]
    got = read(repair.fix_identity(triples(spark, rows), "a", "b", "t"))
    assert got == [(5, 20, 25), (10, 30, 40), (8, 25, 33), (-8, 9, 1), (1, 1, 2), (1, 1, 2), (1, None, 2), (28, 2, 30)]


def test_whole_counts(spark):
    assert values(repair.whole_counts(column(spark, [5.0, -10.0, 8.5, 12.0, None]), ["c"])) == [5, 10, 8, 12, None]


def test_drop_rules(spark):
    rows = [(1, 2, 3), (None, 2, 3), (-1, 2, 1), (0, 0, 0)]
    df = triples(spark, rows)
    assert read(repair.drop_incomplete(df, ["a", "b", "t"])) == [(1, 2, 3), (-1, 2, 1), (0, 0, 0)]
    assert read(repair.drop_negative(df, ["a", "b", "t"])) == [(1, 2, 3), (None, 2, 3), (0, 0, 0)]


# ---- calendar


def test_repair_from_group_needs_a_donor(spark):
    rows = [(1, "d1", 9), (2, "d1", 3), (3, "d1", 2), (4, "d1", None), (5, "d2", 9), (6, None, 9), (7, None, 1)]
    df = spark.createDataFrame(rows, "i bigint, d string, c bigint")
    assert values(repair.repair_from_group(df, "c", [1, 2, 3, 4], ["d"], "i")) == [3, 3, 2, 3, 9, 9, 1]


def test_year_code_without_a_date_stays(spark):
    d = datetime.date
    rows = [(1, d(2011, 5, 1), 7), (2, d(2012, 5, 1), None), (3, d(2013, 5, 1), 5), (4, None, 5), (5, None, None), (6, d(2012, 1, 1), 0)]
    df = spark.createDataFrame(rows, "i bigint, d date, c bigint")
    got = repair.derive_when_invalid(df, "c", [0, 1], repair.year_code("c", "d", {2011: 0, 2012: 1}))
    assert values(got) == [0, 1, None, 5, None, 0]


def test_working_day(spark):
    d = datetime.date
    rows = [(1, d(2011, 1, 1), 0), (2, d(2011, 1, 3), 0), (3, d(2011, 1, 3), 1), (4, d(2011, 1, 3), None), (5, None, 1)]
    df = spark.createDataFrame(rows, "i bigint, d date, h bigint").withColumn("c", repair.working_day("d", "h"))
    assert values(df) == [0, 1, 0, 1, None]


def test_calendar_flag(spark):
    d = datetime.date
    df = column(spark, [d(2011, 7, 4), d(2011, 7, 5), None], "date")
    assert values(repair.calendar_flag(df, "c", clean.HOLIDAYS, "f"), "f") == [1, 0, 0]
    assert len(clean.HOLIDAYS) == 21


# ---- duplicates and hours


def hours(spark, given, key="d"):
    return spark.createDataFrame([(i, key, h) for i, h in enumerate(given)], "i bigint, d string, c bigint")


def test_complete_day_is_renumbered(spark):
    given = [(h * 7) % 24 for h in range(24)]
    assert values(repair.resequence_group(hours(spark, given), "d", "c", "i")) == list(range(24))


def test_day_with_one_row_too_many(spark):
    assert values(repair.resequence_group(hours(spark, list(range(25))), "d", "c", "i")) == [*range(24), None]


@pytest.mark.parametrize("given", [[5, 10, 15], list(range(23)), [3] * 26, [1]])
def test_other_days_are_untouched(spark, given):
    assert values(repair.resequence_group(hours(spark, given), "d", "c", "i")) == given


def test_rows_without_a_day_lose_their_hour(spark):
    assert values(repair.resequence_group(hours(spark, [4, 5], None), "d", "c", "i")) == [None, None]


def test_dedupe_treats_nulls_as_equal(spark):
    rows = [(3, None, 1), (1, None, 1), (2, "a", 1), (4, "a", None), (5, "a", None)]
    df = spark.createDataFrame(rows, "i bigint, k string, v bigint")
    assert sorted(r["i"] for r in repair.dedupe_keep_first(df, ["k", "v"], "i").collect()) == [1, 2, 4]


def test_strict_drop(spark):
    df = column(spark, [1.0])
    assert repair.drop_columns(df, ["gone"]).columns == ["i", "c"]
    with pytest.raises(KeyError):
        repair.drop_columns(df, ["gone"], strict=True)


# ---- the whole job


def raw_rows(n=200):
    start = datetime.datetime(2011, 1, 1)
    for i in range(n):
        at = start + datetime.timedelta(hours=i)
        a, b = i % 30, i % 100 + 1
        yield {
            "instant": i + 1, "dteday": at.strftime("%Y-%m-%d"), "season": 1, "yr": 0, "mnth": at.month, "hr": at.hour, "holiday": 0,
            "weekday": at.weekday(), "workingday": int(at.weekday() < 5), "weathersit": i % 4 + 1, "temp": (i % 10) / 10, "atemp": (i % 9) / 10,
            "hum": (i % 8) / 10, "windspeed": (i % 7) / 10, "casual": a, "registered": b, "cnt": a + b, "mixed_type_col": "x",
        }


def raw_table(spark, rows):
    cols = list(rows[0])
    texts = [tuple(None if r[c] is None else str(r[c]) for c in cols) for r in rows]
    return spark.createDataFrame(texts, ", ".join(f"{c} string" for c in cols))


def test_clean_table_passes_unchanged(spark):
    rows = list(raw_rows())
    got = clean.clean(raw_table(spark, rows)).orderBy("instant").collect()
    assert len(got) == len(rows)
    assert "mixed_type_col" not in got[0].asDict()
    assert all(g["casual"] + g["registered"] == g["cnt"] for g in got)
    assert [g["hr"] for g in got] == [r["hr"] for r in rows]
    assert [g["temp"] for g in got] == [r["temp"] for r in rows]


def test_dirty_five_rows(spark):
    rows = list(raw_rows(5))
    for r, season, temp, a, b, t, day in zip(
        rows, [1, 2, "invalid", 4, 1], [0.5, 0.6, 2.0, 0.7, 0.8], [5, 10, None, 15, 20], [20, 30, 40, 50, 60], [25, 40, 45, 65, 80], range(1, 6)
    ):
        r.update(season=season, temp=temp, casual=a, registered=b, cnt=t, dteday=f"2011-01-0{day}")
    got = clean.clean(raw_table(spark, rows)).orderBy("instant").collect()
    assert len(got) == 5
    assert max(g["temp"] for g in got) <= 1
    assert got[2]["temp"] == 0.7
    assert got[2]["casual"] == 5
    assert all(g["casual"] + g["registered"] == g["cnt"] for g in got)


def test_clean_job_does_not_depend_on_partitioning(spark, partitions):
    rows = list(raw_rows(150))
    for i, r in enumerate(rows):
        if i % 7 == 0:
            r.update(temp="1.5", season="bad", casual=None)
        if i % 11 == 0:
            r.update(dteday="?", hr=99, weathersit=9, windspeed="")
    seen = []
    for n, b in ((1, Blocking()), (16, Blocking(block_size=7)), (5, Blocking(rows_per_block=20, fraction=1.0))):
        partitions(n)
        df = raw_table(spark, rows).repartition(n)
        seen.append(sorted(map(str, clean.clean(df, clean.CleanRules(blocking=b)).collect())))
    assert seen[0] == seen[1] == seen[2]


def test_barrier_keeps_filters_small(spark):
    """A filter after the count step must not repeat the whole chain of expressions."""
    df = triples(spark, [(1, 2, 3)]).withColumns({c: F.col(c).cast("double") for c in "abt"})
    plan = repair.repair_counts(df, "a", "b", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000


def test_hour_groups_keep_hot_keys_apart(spark):
    """Rows of a group that is not renumbered are spread over many window partitions."""
    hot = spark.range(5000).select(F.col("id").alias("i"), F.lit("hot").alias("d"), (F.col("id") % 24).alias("c"))
    day = spark.range(5000, 5024).select(F.col("id").alias("i"), F.lit("day").alias("d"), F.lit(7).cast("bigint").alias("c"))
    out = repair.resequence_group(hot.unionByName(day), "d", "c", "i")
    assert values(out) == [*(i % 24 for i in range(5000)), *range(24)]
    assert "_spread" in out._jdf.queryExecution().optimizedPlan().toString()


def test_unknown_order_type_is_refused(spark):
    df = spark.createDataFrame([("a", 1.0)], "o string, c double")
    with pytest.raises(TypeError):
        ordered.with_block(df, "o", Blocking(block_size=10))
