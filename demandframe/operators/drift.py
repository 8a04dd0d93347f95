"""Two-sample drift tests, scenario perturbation and drift summary tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandframe.functions import columns as fc
from demandframe.operators.lookup import attach_row, compare_counts, stack_tables
from demandframe.operators.ordered import DEFAULT, Blocking, running_sums, sample_borders
from demandframe.operators.profile import histogram, to_long
from demandframe.operators.typing import columns_of_kind

ALPHA = 0.05

# Alert limits on the metric changes.
YELLOW = 5.0
RED = 10.0
RED_R2_DROP = 0.05

SERIES_TERMS = 100

SCENARIO = "_scenario"


# ---- Kolmogorov-Smirnov --------------------------------------------------------------------


def kolmogorov_sf(t: Column) -> Column:
    """Asymptotic tail probability of the scaled KS distance, from whichever series converges fast."""
    k = F.sequence(F.lit(1), F.lit(SERIES_TERMS)).cast("array<double>")
    zero = F.lit(0.0)
    sign = lambda i: F.when(i % 2 == 1, 1.0).otherwise(-1.0)
    upper = 2 * F.aggregate(k, zero, lambda acc, i: acc + sign(i) * F.exp(-2 * i * i * t * t))
    theta = F.aggregate(k, zero, lambda acc, i: acc + F.exp(-(2 * i - 1) * (2 * i - 1) * F.lit(math.pi**2) / (8 * t * t)))
    lower = 1 - F.lit(math.sqrt(2 * math.pi)) / t * theta
    p = F.when(t <= 0.05, 1.0).when(t < 1.18, lower).otherwise(upper)
    return F.when(t.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def _every_feature(found: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per tested column: a column that could not be tested has p = 1 and no drift."""
    names = found.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))
    full = names.join(found, "feature", "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("n_base", "n_new", "n", "dof", "drift_detected") if c in found.columns}
    return full.withColumns({**counts, "p_value": F.coalesce("p_value", F.lit(1.0))}).select(*found.columns)


def ks_two_sample(
    a: DataFrame, b: DataFrame, cols: Sequence[str] | str, alpha: float = ALPHA, blocking: Blocking = DEFAULT
) -> DataFrame:
    """(feature, statistic, n_base, n_new, p_value, drift_detected) for all columns in one job.

    Rows are first reduced to counts per distinct value; the two distribution functions are running
    sums over those, cut into blocks. NULLs are left out. An empty side gives p = 1 and no drift.
    The p-value is the asymptotic one.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    tested = _ks_by_scenario(to_long(a, cols), to_long(b, cols).withColumn(SCENARIO, F.lit("new")), ["new"], alpha, blocking)
    return _every_feature(tested.drop(SCENARIO), cols)


def _ks_by_scenario(base: DataFrame, new: DataFrame, names: Sequence[str], alpha: float, blocking: Blocking) -> DataFrame:
    """The KS test of each scenario in ``new`` (scenario, column, value) against ``base`` (column, value), which is counted once.

    One table of distinct values holds a counter for the base and one per scenario. A value that only other scenarios have
    repeats the distance at the value before it, so the greatest distance is right for each.
    """
    both = base.withColumn(SCENARIO, F.lit(None).cast("string")).unionByName(new)
    borders = sample_borders(both, "value", blocking)
    own = [F.count_if(F.col(SCENARIO) == name).alias(f"n{i}") for i, name in enumerate(names, 1)]
    counts = both.groupBy("column", "value").agg(F.count_if(F.col(SCENARIO).isNull()).alias("n0"), *own)
    run = running_sums(counts, "value", {f"c{i}": f"n{i}" for i in range(len(names) + 1)}, ["column"], totals=True, borders=borders)
    part = lambda i: F.col(f"c{i}") / F.nullif(f"c{i}_total", F.lit(0))
    found = run.groupBy("column").agg(
        F.max("c0_total").alias("n_base"),
        *[F.struct(F.max(F.abs(part(0) - part(i))).alias("statistic"), F.max(f"c{i}_total").alias("n_new")).alias(f"s{i}") for i in range(1, len(names) + 1)],
    )
    each = F.array(*[F.struct(F.lit(name).alias(SCENARIO), f"s{i}.statistic", f"s{i}.n_new") for i, name in enumerate(names, 1)])
    size = F.sqrt(F.col("n_base") * F.col("n_new") / (F.col("n_base") + F.col("n_new")))
    p = F.coalesce(kolmogorov_sf(size * F.col("statistic")), F.lit(1.0))
    tested = found.select(F.col("column").alias("feature"), "n_base", F.inline(each))
    tested = tested.select(SCENARIO, "feature", "statistic", "n_base", "n_new", p.alias("p_value"))
    return tested.withColumn("drift_detected", fc.flag(F.col("p_value") < alpha))


# ---- chi-square ----------------------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Tail probability of chi-square; runs on one row per feature."""

    def tail(x: float, k: float) -> float:
        """Regularised upper gamma at (k / 2, x / 2): a power series below the mean, a continued fraction above it.

        Either ends after some 9 sqrt(k) steps at most, so paired columns of many labels cost no long loop.
        """
        if not (x == x and k == k) or k < 1 or x <= 0:
            return 1.0
        a, h = k / 2.0, x / 2.0
        front = math.exp(a * math.log(h) - h - math.lgamma(a))
        if h < a + 1.0:
            term = total = 1.0 / a
            n = a
            while term > total * 1e-16:
                n += 1.0
                term *= h / n
                total += term
            return min(1.0, max(0.0, 1.0 - front * total))
        b = h + 1.0 - a
        c, d = 1e300, 1.0 / b
        value, i = d, 0
        while True:
            i += 1
            step = -i * (i - a)
            b += 2.0
            d = 1.0 / ((step * d + b) or 1e-300)
            c = (b + step / c) or 1e-300
            value *= c * d
            if abs(c * d - 1.0) < 1e-15 or i > 100 + 20 * math.sqrt(a):
                return min(1.0, max(0.0, front * value))

    return pd.Series([tail(float(x), float(k)) for x, k in zip(stat, dof)])


def _chi2_from_cells(cells: DataFrame, alpha: float) -> DataFrame:
    """Independence test on (feature, r, c, n) counts; Yates' correction with one degree of freedom.

    Pairs that never occur count too: a cell with expected e and observed 0 adds e, so their share
    is the total expectation minus the expectation of the pairs present. No pair is generated.
    """
    rows = cells.groupBy("feature", "r").agg(F.sum("n").alias("nr"))
    cols = cells.groupBy("feature", "c").agg(F.sum("n").alias("nc"))
    total = rows.groupBy("feature").agg(F.sum("nr").alias("total"), F.count("*").alias("levels_r"))
    width = cols.groupBy("feature").agg(F.count("*").alias("levels_c"))
    shape = total.join(width, "feature").withColumn("dof", (F.col("levels_r") - 1) * (F.col("levels_c") - 1))
    placed = cells.join(rows, ["feature", "r"]).join(cols, ["feature", "c"]).join(shape, "feature")
    e = F.col("nr").cast("double") * F.col("nc") / F.col("total")
    gap = F.abs(F.col("n") - e)
    fixed = F.when(F.col("dof") == 1, F.greatest(gap - F.least(gap, F.lit(0.5)), F.lit(0.0))).otherwise(gap)
    summed = placed.groupBy("feature").agg(
        F.sum(fixed * fixed / e).alias("present"),
        F.sum(e).alias("present_e"),
        F.count("*").alias("cells"),
        F.max("total").alias("n"),
        F.max("dof").alias("dof"),
        F.max("levels_r").alias("levels_r"),
        F.max("levels_c").alias("levels_c"),
    )
    absent_e = F.col("n") - F.col("present_e")
    n_absent = F.col("levels_r") * F.col("levels_c") - F.col("cells")
    # In a 2x2 table every |n - e| is the same number, so an absent cell's e equals the gap of the present ones.
    per_cell = absent_e / F.nullif(n_absent.cast("double"), F.lit(0.0))
    cut = per_cell - F.least(per_cell, F.lit(0.5))
    absent = (
        F.when(n_absent == 0, 0.0)
        .when(F.col("dof") == 1, n_absent * cut * cut / per_cell)
        .otherwise(absent_e)
    )
    stat = F.when(F.col("dof") == 0, F.lit(0.0)).otherwise(F.col("present") + absent)
    return summed.select(
        "feature", stat.alias("statistic"), F.col("dof").cast("bigint").alias("dof"), F.col("n").alias("n")
    ).withColumn("p_value", chi2_sf("statistic", F.col("dof").cast("double"))).withColumn(
        "drift_detected", fc.flag(F.col("p_value") < alpha)
    )


def chi2_paired(a: DataFrame, b: DataFrame, cols: Sequence[str] | str, order: str, alpha: float = ALPHA) -> DataFrame:
    """Row i of ``a`` against row i of ``b``: tests whether the paired labels are independent.

    Two identical tables are maximally dependent, so they come out as "drift"; for monitoring use
    ``chi2_homogeneity``.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)

    def labels(t: DataFrame, side: str) -> DataFrame:
        return t.select(F.col(order).alias("_order"), *[fc.text_or_nan(c).alias(f"{side}{i}") for i, c in enumerate(cols)])

    # rows meet once, with all columns; (feature, r, c) are counted in the task that joined them, so only counts are shuffled
    pairs = labels(a, "r").join(labels(b, "c"), "_order")
    each = [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r"), F.col(f"c{i}").alias("c")) for i, c in enumerate(cols)]
    cells = pairs.select(F.inline(F.array(*each))).groupBy("feature", "r", "c").agg(F.count("*").alias("n"))
    return _every_feature(_chi2_from_cells(cells, alpha), cols)


def chi2_homogeneity(a: DataFrame, b: DataFrame, cols: Sequence[str] | str, alpha: float = ALPHA) -> DataFrame:
    """Do both tables have the same label frequencies? (dataset x label) counts; NULL is the label 'nan'."""
    cols = [cols] if isinstance(cols, str) else list(cols)

    def labels(t: DataFrame, name: str) -> DataFrame:
        return _label_counts(t, cols).withColumn("r", F.lit(name))

    return _every_feature(_chi2_from_cells(labels(a, "base").unionByName(labels(b, "new")), alpha), cols)


def _label_counts(t: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by…, feature, c, n): rows per label; NULL is the label 'nan'."""
    text = t.select(*by, *[fc.text_or_nan(c).alias(c) for c in cols]).unpivot(list(by), list(cols), "feature", "c")
    return text.groupBy(*by, "feature", "c").agg(F.count("*").alias("n"))


# ---- reports -------------------------------------------------------------------------------


def drift_report(
    base: DataFrame, new: DataFrame, target: str | None = None, exclude: Sequence[str] = (), paired_by: str | None = None,
    alpha: float = ALPHA, blocking: Blocking = DEFAULT,
) -> DataFrame:
    """(feature, kind, statistic, p_value, drift_detected) for the columns both tables share.

    Numbers are tested by KS, text and booleans by chi-square. All numeric columns go through one
    job, all others through a second.
    """
    skip = {target, paired_by, *exclude}
    shared = [c for c in base.columns if c in new.columns and c not in skip]
    numeric = [c for c in columns_of_kind(base, "number") if c in shared]
    labels = [c for c in shared if c in columns_of_kind(base, "text") + columns_of_kind(base, "bool")]
    parts = []
    cols = ["feature", "kind", "statistic", "p_value", "drift_detected"]
    if numeric:
        parts.append(ks_two_sample(base, new, numeric, alpha, blocking).withColumn("kind", F.lit("ks")).select(*cols))
    if labels:
        tested = chi2_paired(base, new, labels, paired_by, alpha) if paired_by else chi2_homogeneity(base, new, labels, alpha)
        parts.append(tested.withColumn("kind", F.lit("chi2")).select(*cols))
    if not parts:
        raise ValueError("the tables share no column that can be tested")
    return stack_tables(*parts)


def scenario_reports(
    base: DataFrame, scenarios: Mapping[str, DataFrame] | DataFrame, target: str | None = None, exclude: Sequence[str] = (),
    alpha: float = ALPHA, blocking: Blocking = DEFAULT, scenario: str = "scenario",
) -> DataFrame:
    """(scenario, feature, kind, statistic, p_value, drift_detected): ``drift_report`` of every scenario against one base.

    ``scenarios`` are tables by name, or one table of all with a column ``scenario`` (rows where that is NULL are left out). The
    base is counted once for all of them, and so is a table of all: the scans don't grow with the number of scenarios. The names
    of the scenarios become counters, so they come to the driver.
    """
    if isinstance(scenarios, DataFrame):
        names = sorted(r[0] for r in scenarios.select(F.col(scenario).cast("string")).where(F.col(scenario).isNotNull()).distinct().collect())
        tables = [(names, scenarios.withColumn(SCENARIO, F.col(scenario).cast("string")).where(F.col(SCENARIO).isNotNull()).drop(scenario))]
    else:
        names = list(scenarios)
        tables = [([name], t.withColumn(SCENARIO, F.lit(name))) for name, t in scenarios.items()]
    skip = {target, *exclude}
    numbers, texts = columns_of_kind(base, "number"), columns_of_kind(base, "text") + columns_of_kind(base, "bool")
    held = [[c for c in base.columns if c in t.columns and c not in skip] for _, t in tables]
    wanted = [(n, c, "ks" if c in numbers else "chi2") for (own, _), cols in zip(tables, held) for n in own for c in cols if c in numbers or c in texts]
    if not wanted:
        raise ValueError("the tables share no column that can be tested")
    cols, parts = ["feature", "statistic", "p_value", "drift_detected"], []
    numeric = [c for c in numbers if any(c in h for h in held)]
    if numeric:
        new = stack_tables(*[to_long(t, own, [SCENARIO]) for (_, t), h in zip(tables, held) if (own := [c for c in numeric if c in h])])
        parts.append(_ks_by_scenario(to_long(base, numeric), new, names, alpha, blocking).select(SCENARIO, *cols, F.lit("ks").alias("kind")))
    labels = [c for c in texts if any(c in h for h in held)]
    if labels:
        new = [_label_counts(t, own, [SCENARIO]) for (_, t), h in zip(tables, held) if (own := [c for c in labels if c in h])]
        every = _label_counts(base, labels).withColumn(SCENARIO, F.explode(F.array(*[F.lit(n) for n in names])))
        cells = stack_tables(every.withColumn("r", F.lit("base")), *[t.withColumn("r", F.lit("new")) for t in new])
        keyed = cells.select(F.struct(SCENARIO, "feature").alias("feature"), "r", "c", "n")
        tested = _chi2_from_cells(keyed, alpha).withColumn(SCENARIO, F.col(f"feature.{SCENARIO}")).withColumn("feature", F.col("feature.feature"))
        parts.append(tested.select(SCENARIO, *cols, F.lit("chi2").alias("kind")))
    rows = base.sparkSession.createDataFrame(wanted, f"{SCENARIO} string, feature string, kind string")
    full = rows.join(stack_tables(*parts), [SCENARIO, "feature", "kind"], "left")
    return full.select(
        F.col(SCENARIO).alias("scenario"), "feature", "kind", "statistic", F.coalesce("p_value", F.lit(1.0)).alias("p_value"),
        F.coalesce("drift_detected", F.lit(0)).alias("drift_detected"),
    )


def dataset_drift(report: DataFrame, share: float = 0.5) -> DataFrame:
    """(n_columns, n_drifted, share_drifted, dataset_drift): drifted if at least ``share`` of the columns are."""
    n, d = F.count("*"), F.sum("drift_detected")
    return report.agg(n.alias("n_columns"), d.cast("bigint").alias("n_drifted"), (d / n).alias("share_drifted")).withColumn(
        "dataset_drift", fc.flag(F.col("share_drifted") >= share)
    )


def paired_distribution(a: DataFrame, b: DataFrame, c: str, bins: int = 30) -> DataFrame:
    """Data of the side-by-side plot: two histograms over each table's own range, or label counts."""
    if c not in columns_of_kind(a, "number"):
        return compare_counts(a, b, c)
    return stack_tables(
        histogram(a, c, bins).withColumn("dataset", F.lit("base")), histogram(b, c, bins).withColumn("dataset", F.lit("new"))
    ).select("dataset", "bin", "lo", "hi", "n")


# ---- scenarios -----------------------------------------------------------------------------

# The built-in climate and hour-shift scenario.
DEFAULT_SCENARIO = {
    "temp": {"add": 0.1, "clip": (0.0, 1.0)},
    "atemp": {"add": 0.1, "clip": (0.0, 1.0)},
    "hum": {"add": 0.15, "clip": (0.0, 1.0)},
    "hr": {"add": 3, "mod": 24},
}


def perturb(df: DataFrame, spec: Mapping[str, Mapping] = DEFAULT_SCENARIO) -> DataFrame:
    """What-if copy of a table: per present column add a constant, then clip or wrap around."""
    return df.withColumns({c: _changed(c, change) for c, change in spec.items() if c in df.columns})


def _changed(c: str, change: Mapping) -> Column:
    value = F.col(c) + F.lit(change.get("add", 0))
    if "mod" in change:
        value = F.pmod(value, F.lit(change["mod"]))
    if "clip" in change:
        value = fc.clamp(value, *change["clip"])
    return value


def perturbed(df: DataFrame, specs: Mapping[str, Mapping[str, Mapping]], out: str = "scenario") -> DataFrame:
    """What-if copies under one another, with the scenario's name in ``out``: one read of the table, however many there are."""
    if not specs:
        raise ValueError("no scenarios")
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has {out}")
    moved = [c for c in df.columns if any(c in spec for spec in specs.values())]
    case = lambda name, spec: F.struct(
        F.lit(name).alias(out), *[(_changed(c, spec[c]) if c in spec else F.col(c)).alias(c) for c in moved]
    )
    each = df.withColumn("_case", F.explode(F.array(*[case(name, spec) for name, spec in specs.items()])))
    return each.select(*[F.col("_case").getField(c).alias(c) if c in moved else F.col(c) for c in df.columns], F.col("_case").getField(out).alias(out))


def scenario_metrics(scenarios: DataFrame, y: str, yhat: str, scenario: str = "scenario") -> DataFrame:
    """(scenario, rmse, mae, r2) for all scenarios of a stacked table in one aggregation."""
    from demandframe.operators.metrics import regression_metrics

    return regression_metrics(scenarios, y, yhat, [scenario]).select(scenario, "rmse", "mae", "r2")


def delta_vs_baseline(summary: DataFrame, baseline: DataFrame, digits: int | None = None) -> DataFrame:
    """Add delta_rmse, delta_mae, delta_r2 against a one-row baseline; optionally round for display."""
    ready = attach_row(summary, baseline.select("rmse", "mae", "r2"))
    deltas = {f"delta_{m}": F.col(m) - F.col("_stats").getField(m) for m in ("rmse", "mae", "r2")}
    out = ready.withColumns(deltas).drop("_stats")
    if digits is None:
        return out
    shown = ["rmse", "mae", "r2", "delta_rmse", "delta_mae", "delta_r2"]
    return out.withColumns({c: F.round(c, digits) for c in shown})


def with_dataset_name(summary: DataFrame, path: str, out: str = "dataset_name") -> DataFrame:
    return summary.withColumn(out, fc.base_name(path))


def worst_scenario(summary: DataFrame, tie: str = "scenario") -> DataFrame:
    """The row with the largest absolute change of rmse."""
    return summary.where(F.col("delta_rmse").isNotNull()).orderBy(F.desc(F.abs("delta_rmse")), F.asc(tie)).limit(1)


def alert_level(summary: DataFrame) -> DataFrame:
    """Add ``alert``: red, yellow or green."""
    rmse, mae = F.abs("delta_rmse"), F.abs("delta_mae")
    red = (rmse > RED) | (mae > RED) | (-F.col("delta_r2") > RED_R2_DROP)
    yellow = (rmse > YELLOW) | (mae > YELLOW)
    level = F.when(F.coalesce(red, F.lit(False)), "red").when(F.coalesce(yellow, F.lit(False)), "yellow").otherwise("green")
    return summary.withColumn("alert", level)
