"""Descriptive statistics. Exact quantiles are computed without gathering a column in one task."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandframe.operators.lookup import attach_row, join_summary, one_row

# Entries of the sketch that brackets a quantile: its rank error is one in this many rows. A whole column is narrowed down
# in rounds, so a coarse first bracket will do; a group has one.
SKETCH, GROUP_SKETCH = 1_000, 20_000
# Parts into which a round of selection cuts a bracket: so many counts per column and quantile come to the driver at most.
CELLS = 8192


def to_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by…, column, value DOUBLE) without NULL and NaN."""
    shaped = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return shaped.unpivot(list(by), list(cols), "column", "value").where("value IS NOT NULL AND NOT isnan(value)")


def _marks(qs: Sequence[float], sketch: int) -> list[float]:
    """Ranks between which the sketch brackets each quantile."""
    margin = 3.0 / sketch
    return [min(1.0, max(0.0, q + side * margin)) for q in qs for side in (-1, 1)]


def _cell(c: Column, low: float, high: float) -> Column:
    """Which of CELLS equal parts of [low, high] a value lies in; NULL outside, infinities beyond all others."""
    a, b = max(low, -sys.float_info.max), min(high, sys.float_info.max)
    scale = 1.0 if math.isfinite(b - a) else 0.5
    width = (b * scale - a * scale) or 1.0
    part = F.least(F.floor((c * scale - a * scale) / width * CELLS), F.lit(CELLS - 1))
    placed = F.when(c < a, -1).when(c > b, CELLS).otherwise(part)
    return F.when((c >= low) & (c <= high), placed)


def select_ranks(df: DataFrame, cols: Sequence[str], qs: Sequence[float], ranks: Callable[[int, float], set[int]]) -> dict[str, tuple[int, dict[int, float]]]:
    """(n, values by rank from 0) of each column that has values, by selection in rounds; ``ranks`` names the ranks near a share of n rows.

    A mergeable sketch brackets each rank. Then each round counts the values of a bracket by cells, and the cell with
    the rank is the next bracket, until it holds one value. What comes to the driver is at most CELLS counts per
    column and quantile; no task ever sees a column, and every size and distribution goes the same way.
    """
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    # a one-row inline: the filter on the brackets would else repeat the columns' expressions for each of its bounds
    rows = df.select(F.inline(F.array(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(value.values())]))))
    seen = {}
    marks = _marks(qs, SKETCH)
    per_column = [F.struct(F.count(f"v{i}"), F.min(f"v{i}"), F.max(f"v{i}"), F.percentile_approx(f"v{i}", marks, SKETCH)) for i in range(len(cols))]
    for i, r in enumerate(rows.agg(*[x.alias(f"s{i}") for i, x in enumerate(per_column)]).first()):
        n, least, most, found = r
        if n:
            seen[i] = n, least, most, found
    # (column, rank) -> (low, high, values below low); the ends of the distribution close a bracket
    open_: dict[tuple[int, int], tuple[float, float, int | None]] = {}
    for i, (n, least, most, found) in seen.items():
        for j, q in enumerate(qs):
            low = least if marks[2 * j] <= 0 or n <= SKETCH else found[2 * j]
            high = most if marks[2 * j + 1] >= 1 or n <= SKETCH else found[2 * j + 1]
            for rank in ranks(n, q):
                open_[i, rank] = low, high, None
    done: dict[tuple[int, int], float] = {}
    while open_:
        brackets = {b: k for k, b in enumerate(dict.fromkeys((i, low, high) for (i, _), (low, high, _) in open_.items()))}
        first = any(below is None for _, _, below in open_.values())
        wide = {b: k for b, k in brackets.items() if b[1] < b[2]}
        parts = []
        if wide:
            within = reduce(lambda a, b: a | b, [F.col(f"v{i}").between(low, high) for i, low, high in wide])
            placed = [F.struct(F.lit(k).alias("k"), _cell(F.col(f"v{i}"), low, high).alias("cell"), F.col(f"v{i}").alias("v")) for (i, low, high), k in wide.items()]
            near = rows.where(within).select(F.inline(F.array(*placed))).where("cell IS NOT NULL")
            parts.append(near.groupBy("k", "cell").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
        if first:  # in the same job the rows below the brackets of the sketch, and those of brackets that are one value
            count = lambda test: F.coalesce(F.sum(test.cast("long")), F.lit(0).cast("long")).alias("n")
            none, told = F.lit(None).cast("double"), []
            for (i, low, high), k in brackets.items():
                told.append(F.struct(F.lit(k).alias("k"), F.lit(-2).cast("long").alias("cell"), count(F.col(f"v{i}") < low), none.alias("low"), none.alias("high")))
                if low == high:
                    told.append(F.struct(F.lit(k).alias("k"), F.lit(0).cast("long").alias("cell"), count(F.col(f"v{i}") == low), F.lit(low).alias("low"), F.lit(high).alias("high")))
            parts.append(rows.agg(F.array(*told).alias("u")).select(F.inline("u")))
        counts = reduce(DataFrame.union, parts)
        cells: dict[int, list] = {}
        for r in sorted(counts.collect(), key=lambda r: (r.k, r.cell)):
            cells.setdefault(r.k, []).append(r)
        following = {}
        for (i, rank), (low, high, below) in open_.items():
            upto = below or 0
            for r in cells[brackets[i, low, high]]:
                if r.low is not None and upto <= rank < upto + r.n:
                    if r.low == r.high:
                        done[i, rank] = r.low
                    else:
                        following[i, rank] = r.low, r.high, upto
                    break
                upto += r.n
            else:  # the sketch left the rank out: the bracket becomes the whole column, in the same rounds
                following[i, rank] = seen[i][1], seen[i][2], 0
        open_ = following
    return {cols[i]: (n, {rank: v for (k, rank), v in done.items() if k == i}) for i, (n, *_) in seen.items()}


def _order_statistics(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[str, list[float]]:
    """The linearly interpolated quantiles of each column that has values."""
    out = {}
    for c, (n, at) in select_ranks(df, cols, qs, lambda n, q: {math.floor((n - 1) * q), math.ceil((n - 1) * q)}).items():
        values = []
        for q in qs:
            place = (n - 1) * q
            a, b = at[math.floor(place)], at[math.ceil(place)]
            values.append(a if a == b else a + (place - math.floor(place)) * (b - a))
        out[c] = values
    return out


def _group_arrays(long: DataFrame, qs: Sequence[float]) -> DataFrame:
    """(_group, q ARRAY) of (_group, value): a sketch brackets each quantile of a group, one scan counts what is below
    the brackets and the values inside them, and the neighbours of the rank are picked from these."""
    m, marks = len(qs), _marks(qs, GROUP_SKETCH)
    sketch = long.groupBy("_group").agg(F.count("*").alias("_n"), F.percentile_approx("value", marks, GROUP_SKETCH).alias("_m"), F.min("value").alias("_min"), F.max("value").alias("_max"))
    ends = []
    for i in range(m):
        # the neighbours of a rank may lie outside of the sketch's margin where a group has fewer rows than the sketch has entries
        low = F.when((F.col("_n") <= GROUP_SKETCH) | F.lit(marks[2 * i] <= 0), F.col("_min")).otherwise(F.col("_m")[2 * i])
        high = F.when((F.col("_n") <= GROUP_SKETCH) | F.lit(marks[2 * i + 1] >= 1), F.col("_max")).otherwise(F.col("_m")[2 * i + 1])
        ends += [low.alias(f"_lo{i}"), high.alias(f"_hi{i}")]
    near = long.join(sketch.select("_group", *ends), "_group")
    inside = [(F.col("value") >= F.col(f"_lo{i}")) & (F.col("value") <= F.col(f"_hi{i}")) for i in range(m)]
    below = [F.sum((F.col("value") < F.col(f"_lo{i}")).cast("long")).alias(f"_below{i}") for i in range(m)]
    kept = F.when(reduce(lambda a, b: a | b, inside), F.col("value"))
    own = [F.sum(inside[i].cast("long")).alias(f"_in{i}") for i in range(m)]
    cells = near.groupBy("_group", kept.alias("_v")).agg(*below, *own)
    group = Window.partitionBy("_group")
    upto = group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cells.select("_group", "_v", *[f"_in{i}" for i in range(m)], *[(F.sum(f"_below{i}").over(group) + F.sum(f"_in{i}").over(upto)).alias(f"_end{i}") for i in range(m)])
    ranked = ranked.join(sketch.select("_group", "_n"), "_group")
    picks, values = [], []
    for i, q in enumerate(qs):
        place = (F.col("_n") - 1) * F.lit(float(q))
        for rank, name in ((F.floor(place), "lo"), (F.ceil(place), "hi")):
            here = (F.col(f"_end{i}") - F.col(f"_in{i}") <= rank) & (rank < F.col(f"_end{i}"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{name}{i}"))
        a, b = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        missed = F.raise_error(F.lit("a sketch missed the rank it must bracket"))
        values.append(F.when(a.isNull() | b.isNull(), missed.cast("double")).otherwise(F.when(a == b, a).otherwise(a + (place - F.floor(place)) * (b - a))))
    return ranked.groupBy("_group", "_n").agg(*picks).select("_group", F.array(*values).alias("q"))


def quantile_arrays(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by…, column, q ARRAY): exact, linearly interpolated quantiles of the non-NULL values; columns without any are left out.

    Without ``by`` the selection runs when this is called, and the result holds the numbers. Groups keep to one plan: what a
    group sorts is GROUP_SKETCH of its distinct values, or a three-thousandth of them per quantile.
    """
    if by:
        long = to_long(df, cols, by).select(F.struct(*by, "column").alias("_group"), "value")
        return _group_arrays(long, qs).select("_group.*", "q")
    found = _order_statistics(df, cols, qs)
    kind = "array<struct<column:string,q:array<double>>>"
    rows = [F.struct(F.lit(c).alias("column"), F.array(*map(F.lit, v)).alias("q")) for c, v in found.items()]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows).cast(kind)))


def quantile_row(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """One row with an array of exact, linearly interpolated quantiles per column, found when this is called; NULL for a column without values."""
    found = _order_statistics(df, cols, qs)
    array = lambda v: F.array(*map(F.lit, v)) if v else F.lit(None).cast("array<double>")
    return df.sparkSession.range(1).select(*[array(found.get(c)).alias(c) for c in cols])


def quantiles(
    df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = (), accuracy: int | None = None
) -> DataFrame:
    """(by…, column, quantile, value). Exact unless ``accuracy`` asks for the sketch."""
    if accuracy:
        arrays = to_long(df, cols, by).groupBy(*by, "column").agg(F.percentile_approx("value", list(qs), accuracy).alias("q"))
    else:
        arrays = quantile_arrays(df, cols, qs, by)
    pairs = F.arrays_zip(F.array(*[F.lit(float(q)) for q in qs]).alias("quantile"), F.col("q").alias("value"))
    return arrays.select(*by, "column", F.inline(pairs).alias("quantile", "value"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) per numeric column."""
    long = to_long(df, cols)
    basic = long.groupBy("column").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    arrays = quantile_arrays(df, cols, [0.25, 0.5, 0.75], ())
    q = F.col("q")
    return basic.join(arrays, "column", "left").select(
        "column", "count", "mean", "std", "min", q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "max"
    )


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, count, unique, top, freq) per text column; ties for top go to the smallest value."""
    return _label_profile(df, cols).select("column", "count", "unique", "top", "freq")


def _label_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    shaped = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = shaped.unpivot([], list(cols), "column", "value").where("value IS NOT NULL")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def _label_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    best = F.min(F.struct((-F.col("n")).alias("minus"), F.col("value").alias("value")))
    grouped = _label_counts(df, cols).groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"), best.alias("b")
    )
    return grouped.select(
        "column", "count", "unique", F.col("b.value").alias("top"), (-F.col("b.minus")).alias("freq")
    )


def category_profile(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """(column, mode, cardinality, top_frequency, top_share) per categorical column.

    ``approximate`` replaces the exact cardinality by a sketch, with mode and frequency still exact.
    """
    prof = _label_profile(df, cols)
    if approximate:
        sketch = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        prof = prof.join(sketch.unpivot([], list(cols), "column", "est"), "column").withColumn("unique", F.col("est"))
    return prof.select(
        "column",
        F.col("top").alias("mode"),
        F.col("unique").alias("cardinality"),
        F.col("freq").alias("top_frequency"),
        (F.col("freq") * 100.0 / F.col("count")).alias("top_share"),
    )


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mode): the most frequent value as text, ties to the smallest value of its own type."""
    parts = None
    for c in cols:
        counted = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).agg(F.count("*").alias("_n"))
        best = counted.agg(F.min(F.struct((-F.col("_n")).alias("minus"), F.col("_v").alias("value"))).alias("b"))
        row = best.select(F.lit(c).alias("column"), F.col("b.value").cast("string").alias("mode"))
        parts = row if parts is None else parts.unionByName(row)
    return parts


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null, pct) for the columns that have NULL or NaN."""
    cols = list(cols or df.columns)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def missing(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()

    one = df.agg(F.count("*").alias("_n"), *[F.count_if(missing(c)).alias(c) for c in cols])
    long = one.unpivot(["_n"], cols, "column", "n_null")
    return long.where("n_null > 0").select("column", "n_null", (F.col("n_null") * 100.0 / F.col("_n")).alias("pct"))


def shape_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, skewness, kurtosis), both bias-corrected; NULL when there are too few values."""
    g = to_long(df, cols).groupBy("column").agg(
        F.count("*").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2")
    )
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.col("g1"))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return g.select("column", skew.alias("skewness"), kurt.alias("kurtosis"))


def _any_outlier(df: DataFrame, cols: Sequence[str], k: float) -> tuple[DataFrame, dict[str, Column], Column]:
    from demandframe.operators.repair import _outside

    ready = attach_row(df, quantile_row(df, cols, [0.25, 0.75]))
    flags = {c: _outside(c, F.col("_stats").getField(c), k) for c in cols}
    anywhere = F.lit(False)
    for f in flags.values():
        anywhere = anywhere | f
    return ready, flags, anywhere


def outlier_profile(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """(column, n_out, pct) per column plus a row '*' for rows with at least one outlier."""
    ready, flags, anywhere = _any_outlier(df, cols, k)
    one = ready.agg(
        F.count("*").alias("_n"), *[F.count_if(f).alias(c) for c, f in flags.items()], F.count_if(anywhere).alias("_any")
    )
    long = one.unpivot(["_n"], [*cols, "_any"], "column", "n_out")
    name = F.when(F.col("column") == "_any", "*").otherwise(F.col("column")).alias("column")
    return long.select(name, "n_out", (F.col("n_out") * 100.0 / F.col("_n")).alias("pct"))


def drop_outlier_rows(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    ready, _, anywhere = _any_outlier(df, cols, k)
    return ready.where(~anywhere).drop("_stats")


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """(value, n) by falling count, ties by value."""
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c)


def histogram(df: DataFrame, c: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """(bin, lo, hi, n) for equal-width bins, the last one closed; empty bins are kept."""
    x = F.col(c).cast("double")
    edges = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    if lo is not None:
        edges = df.sparkSession.range(1).select(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
    # numpy's rule for a constant column: half a unit to both sides
    flat = F.col("lo") == F.col("hi")
    edges = edges.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    s = one_row(edges)
    width = (s.getField("hi") - s.getField("lo")) / bins
    inside = x.between(s.getField("lo"), s.getField("hi"))
    number = F.least(F.floor((x - s.getField("lo")) / width), F.lit(bins - 1)).cast("bigint")
    counts = df.where(inside).groupBy(number.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (s.getField("lo") + F.col("bin") * width).alias("lo"),
        (s.getField("lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, c: str, by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """(by…, n, q1, median, q3, whisker_lo, whisker_hi, n_out): whiskers end on data points."""
    names = [f"_by{i}" for i in range(len(by))]
    x = df.select(*[F.col(b).alias(n) for b, n in zip(by, names)], F.col(c).cast("double").alias("x")).where("x IS NOT NULL")
    if not by:
        q = one_row(quantile_row(x, ["x"], [0.25, 0.5, 0.75])).getField("x")
        rows = x.withColumn("q", q)
    else:
        arrays = quantile_arrays(x, ["x"], [0.25, 0.5, 0.75], names).drop("column")
        keyed = x.withColumn("_group", F.struct(*names))
        rows = join_summary(keyed, arrays.select(F.struct(*names).alias("_group"), "q"), ["_group"])
    q1, q2, q3 = (F.col("q")[i] for i in range(3))
    lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    v = F.col("x")
    out = rows.groupBy(*names).agg(
        F.count("*").alias("n"),
        F.max(q1).alias("q1"),
        F.max(q2).alias("median"),
        F.max(q3).alias("q3"),
        F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.count_if((v < lo) | (v > hi)).alias("n_out"),
    )
    return out.select(*[F.col(n).alias(b) for b, n in zip(by, names)], *out.columns[len(by):])


def pivot_mean(df: DataFrame, row: str, col: str, y: str, values: Sequence, prefix: str = "") -> DataFrame:
    """Mean of ``y`` with one output column per listed value; one partial aggregation, no extra job."""
    cells = [F.avg(F.when(F.col(col) == v, F.col(y))).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(row).agg(*cells)


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every ordered pair of columns; rows where either is NULL are left out per pair."""
    cols = list(cols)
    half = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(half)])
    cells = []
    for i, (a, b) in enumerate(half):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"_c{i}").alias("corr")))
    return one.select(F.inline(F.array(*cells)))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) for the pairs that occur."""
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def invalid_values(df: DataFrame, c: str, valid: Sequence) -> DataFrame:
    """Distinct values outside the domain, NULL included."""
    return df.where(~F.coalesce(F.col(c).isin(list(valid)), F.lit(False))).select(c).distinct()


def table_info(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null, n_rows)."""
    one = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("non_null"),
            F.col("_n").alias("n_rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return one.select(F.inline(F.array(*cells)))


