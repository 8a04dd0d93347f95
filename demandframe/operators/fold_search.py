"""Hyper-parameter search with the preparation fitted anew inside every fold.

Imputing, scaling and encoding are learned from the rows outside the held-out fold, so nothing of it leaks into a score.
The statistics of "all folds but one" come from counts per fold of which one fold is left out on the driver; the table is
not read again for each fold.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.operators import models
from demandframe.operators.prep import TablePrep, TablePrepModel
from demandframe.operators.profile import CELLS, SKETCH, _cell

# Points of a fold's sketch; brackets of a rank are taken from the points of the folds put together.
POINTS = 500


def _number(c: str) -> Column:
    """The column as DOUBLE, NaN as NULL."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _fold_sketches(train: DataFrame, cols: Sequence[str], fold_col: str) -> dict[int, list]:
    """Per fold and column (n, least, most, points of the distribution), in one aggregation."""
    marks = [i / POINTS for i in range(POINTS + 1)]
    cells = [F.struct(F.count(v), F.min(v), F.max(v), F.percentile_approx(v, marks, 2 * SKETCH)).alias(f"s{i}") for i, v in enumerate(map(_number, cols))]
    return {r["fold"]: [tuple(r[f"s{i}"]) for i in range(len(cols))] for r in train.groupBy(F.col(fold_col).cast("int").alias("fold")).agg(F.count("*"), *cells).collect()}


def _bracket(sketches: Iterable[tuple], rank: int) -> tuple[float, float]:
    """Values between which the rank lies in these folds together, unless a sketch is off."""
    parts = [s for s in sketches if s[0]]
    n = sum(s[0] for s in parts)
    points = sorted((v, s[0] / POINTS) for s in parts for v in s[3])
    upto = np.cumsum([w for _, w in points])
    margin = n * 4.0 / POINTS + len(parts)
    low, high = bisect_left(upto, rank - margin), bisect_left(upto, rank + margin)
    least, most = min(s[1] for s in parts), max(s[2] for s in parts)
    return (points[low - 1][0] if low else least), (points[high][0] if high < len(points) else most)


def _cell_counts(rows: DataFrame, brackets: Mapping[tuple, int]) -> dict[tuple[int, int], list[tuple]]:
    """(bracket, fold) -> its cells with rows, (cell, n, least, most) in order; one job that counts map-side."""
    within, placed = F.lit(False), []
    for (i, low, high), k in brackets.items():
        v = F.col(f"v{i}")
        within = within | v.between(low, high)
        placed.append(F.struct(F.lit(k).alias("k"), _cell(v, low, high).alias("cell"), v.alias("v")))
    near = rows.where(within).select("fold", F.inline(F.array(*placed))).where("cell IS NOT NULL")
    found: dict[tuple[int, int], list[tuple]] = {}
    for r in sorted(near.groupBy("k", "fold", "cell").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect(), key=lambda r: (r.k, r.fold, r.cell)):
        found.setdefault((r.k, r.fold), []).append((r.cell, r.n, r.low, r.high))
    return found


def _merged(lists: Iterable[list[tuple]]) -> list[tuple]:
    """Cells of several folds added up."""
    total: dict[int, tuple] = {}
    for cell, n, low, high in (c for cells in lists for c in cells):
        m, a, b = total.get(cell, (0, low, high))
        total[cell] = m + n, min(a, low), max(b, high)
    return [(c, *total[c]) for c in sorted(total)]


def fold_medians(train: DataFrame, cols: Sequence[str], fold_col: str = "fold", sketches: Mapping[int, list] | None = None) -> dict[int | None, list[float | None]]:
    """Exact median of each column in all folds but one, by that fold; key None: in all rows. NULL and NaN do not count.

    Sketches per fold bracket every rank. Rounds then count the rows of a bracket by (fold, cell); leaving a fold's counts out
    gives the cell of the rank, the next bracket, until it holds one value. A round is one job for all columns and folds,
    and at most folds x CELLS counts of each bracket come to the driver. A column without values gives None.
    """
    sketches = _fold_sketches(train, cols, fold_col) if sketches is None else sketches
    kept = {h: [f for f in sketches if f != h] for h in [None, *sketches]}
    rows = train.select(F.col(fold_col).cast("int").alias("fold"), *[_number(c).alias(f"v{i}") for i, c in enumerate(cols)])
    sizes = {(h, i): sum(sketches[f][i][0] for f in folds) for h, folds in kept.items() for i in range(len(cols))}
    done: dict[tuple, float] = {}
    open_: dict[tuple, tuple] = {}  # (held out, column, rank) -> (low, high, rows below low)
    for (h, i), n in sizes.items():
        for rank in {(n - 1) // 2, n // 2} if n else ():
            low, high = _bracket((sketches[f][i] for f in kept[h]), rank)
            open_[h, i, rank] = low, high, None
    starts = {b: k for k, b in enumerate(dict.fromkeys((i, low) for (_, i, _), (low, _, _) in open_.items()))}
    below: dict[int | None, list[int]] = {}
    if starts:
        counts = [F.count_if(F.col(f"v{i}") < low).alias(f"b{k}") for (i, low), k in starts.items()]
        under = {r["fold"]: r for r in rows.groupBy("fold").agg(F.count("*"), *counts).collect()}
        below = {h: [sum(under[f][f"b{k}"] for f in folds) for k in range(len(starts))] for h, folds in kept.items()}
    while open_:
        brackets = {b: k for k, b in enumerate(dict.fromkeys((i, low, high) for (_, i, _), (low, high, _) in open_.items()))}
        counted, following = _cell_counts(rows, brackets), {}
        for (h, i, rank), (low, high, before) in open_.items():
            upto = below[h][starts[i, low]] if before is None else before
            for _, n, least, most in _merged(counted.get((brackets[i, low, high], f), []) for f in kept[h]):
                if upto <= rank < upto + n:
                    if least == most:
                        done[h, i, rank] = least
                    else:
                        following[h, i, rank] = least, most, upto
                    break
                upto += n
            else:  # not between the sketch's values: the bracket becomes the whole column
                parts = [sketches[f][i] for f in kept[h] if sketches[f][i][0]]
                following[h, i, rank] = min(p[1] for p in parts), max(p[2] for p in parts), 0
        open_ = following
    middle = lambda h, i, n: (done[h, i, (n - 1) // 2] + (done[h, i, n // 2] - done[h, i, (n - 1) // 2]) * (0.5 if n % 2 == 0 else 0.0)) if n else None
    return {h: [middle(h, i, sizes[h, i]) for i in range(len(cols))] for h in kept}


def _fold_levels(train: DataFrame, cols: Sequence[str], fold_col: str, max_levels: int | None) -> list[dict]:
    """Per column {value: {fold: rows}}. Levels become columns of the model, so they are named on the driver; more than ``max_levels`` are refused."""
    out = []
    for c in cols:
        counted = train.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v"), F.col(fold_col).cast("int").alias("fold")).agg(F.count("*").alias("n"))
        by_value = counted.groupBy("v").agg(F.map_from_entries(F.collect_list(F.struct("fold", "n"))).alias("folds"))
        found = (by_value.limit(max_levels + 1) if max_levels else by_value).collect()
        if max_levels and len(found) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} distinct values, too many for one-hot columns")
        out.append({r["v"]: r["folds"] for r in sorted(found, key=lambda r: r["v"])})
    return out


def fit_folds(train: DataFrame, prep: TablePrep, fold_col: str = "fold", max_levels: int | None = None) -> dict[int | None, TablePrepModel]:
    """The preparation fitted without each fold, by that fold; key None: fitted on all rows.

    Ranges and counts of levels are partial results per fold, medians are selected as in ``fold_medians``: the number of jobs
    does not grow with the number of folds. ValueError if a column has no value outside a fold, or a table only one fold.
    """
    num, cat = prep.getOrDefault(prep.numeric), prep.getOrDefault(prep.categorical)
    sketches = _fold_sketches(train, num, fold_col)
    if len(sketches) < 2 or None in sketches:
        raise ValueError("a search needs two folds or more, and a fold in every row")
    medians = fold_medians(train, num, fold_col, sketches) if num else {h: [] for h in [None, *sketches]}
    levels = _fold_levels(train, cat, fold_col, max_levels)
    fitted = {}
    for h in [None, *sorted(sketches)]:
        folds = [f for f in sketches if f != h]
        ranges, domains = {}, {}
        for i, c in enumerate(num):
            parts = [sketches[f][i] for f in folds if sketches[f][i][0]]
            if not parts:
                raise ValueError(f"{c} has no value outside fold {h}")
            ranges[c] = [medians[h][i], min(p[1] for p in parts), max(p[2] for p in parts)]
        for c, values in zip(cat, levels):
            counts = {v: sum(n for f, n in by.items() if f != h) for v, by in values.items()}
            seen = [v for v, n in counts.items() if n]  # in order of the values
            if not seen:
                raise ValueError(f"{c} has no value outside fold {h}")
            domains[c] = [str(max(seen, key=lambda v: counts[v])), [str(v) for v in seen]]
        fitted[h] = TablePrepModel(
            numeric=num, categorical=cat, passthrough=prep.getOrDefault(prep.passthrough), outputCol=prep.getOrDefault(prep.outputCol), ranges=ranges, levels=domains
        )
    return fitted


def _raw_products(train: DataFrame, label: str, whole: TablePrepModel, fold_col: str) -> tuple[list[str], np.ndarray, dict[int, np.ndarray]]:
    """(names, centre, cross-products per fold) of the columns of which every preparation is a linear map.

    These are each number with its mean where it is missing, a mark of the missing ones, a mark of each level and of no level,
    and the columns passed through: one pass over the table serves all folds and points.
    """
    num, cat, rest = (whole.getOrDefault(p) for p in (whole.numeric, whole.categorical, whole.passthrough))
    levels = whole.getOrDefault(whole.levels)
    centres = train.agg(*[F.coalesce(F.avg(_number(c)), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate([*num, *rest, label])]).first()
    mean = dict(zip([*num, *rest, label], map(float, centres)))
    columns, about = {}, []
    for i, c in enumerate(num):
        columns[f"x{i}"] = F.coalesce(_number(c), F.lit(mean[c]))
        columns[f"m{i}"] = _number(c).isNull().cast("double")
        about += [mean[c], 0.0]
    for i, c in enumerate(cat):
        for j, v in enumerate(levels[c][1]):
            columns[f"c{i}_{j}"] = F.coalesce((F.col(c).cast("string") == v).cast("double"), F.lit(0.0))
        columns[f"c{i}_none"] = F.col(c).isNull().cast("double")
        about += [0.0] * (len(levels[c][1]) + 1)
    for i, c in enumerate(rest):
        columns[f"r{i}"] = F.col(c).cast("double")
        about.append(mean[c])
    about = np.array([*about, mean[label]])
    shaped = train.select(*[e.alias(n) for n, e in columns.items()], F.col(label).cast("double").alias("y"), F.col(fold_col).cast("int").alias("fold"))
    return list(columns), about, models.fold_products(shaped, "y", list(columns), "fold", about)


def _prep_matrix(model: TablePrepModel, whole: TablePrepModel, names: Sequence[str], about: np.ndarray, centred: bool) -> np.ndarray:
    """The preparation as a matrix: raw columns about their centre, label and 1 -> prepared features, label and 1.

    With ``centred`` the label and the columns passed through stay about their means, which only moves the intercept.
    """
    at = {n: i for i, n in enumerate(names)}
    width = len(names) + 2
    rows = []

    def row(**cells: float) -> np.ndarray:
        r = np.zeros(width)
        for n, v in cells.items():
            r[width - 1 if n == "one" else at[n]] += v
        return r

    ranges, levels, known = (m.getOrDefault(p) for m, p in ((model, model.ranges), (model, model.levels), (whole, whole.levels)))
    for i, c in enumerate(model.getOrDefault(model.numeric)):
        median, low, high = ranges[c]
        scale, mean = (high - low) or 1.0, about[at[f"x{i}"]]
        rows.append(row(**{f"x{i}": 1 / scale, f"m{i}": (median - mean) / scale, "one": (mean - low) / scale}))
    for i, c in enumerate(model.getOrDefault(model.categorical)):
        mode, values = levels[c]
        for v in values[1:]:
            rows.append(row(**{f"c{i}_{known[c][1].index(v)}": 1.0, f"c{i}_none": float(v == mode)}))
    for i, _ in enumerate(model.getOrDefault(model.passthrough)):
        rows.append(row(**{f"r{i}": 1.0, "one": 0.0 if centred else about[at[f"r{i}"]]}))
    y = np.zeros(width)
    y[-2], y[-1] = 1.0, 0.0 if centred else about[-1]
    one = np.zeros(width)
    one[-1] = 1.0
    return np.array([*rows, y, one])


def _linear_scores(
    name: str, points: Sequence[Mapping], train: DataFrame, label: str, fitted: Mapping[int | None, TablePrepModel], fold_col: str
) -> list[float]:
    """Negative mean squared error of each point, averaged over the folds, from one pass over the table."""
    names, about, products = _raw_products(train, label, fitted[None], fold_col)
    whole = sum(products.values())
    errors: list[list[float]] = [[] for _ in points]
    for f, part in products.items():
        for centred in (True, False):
            chosen = [i for i, p in enumerate(points) if bool(p.get("fit_intercept", True)) == centred]
            if not chosen:
                continue
            m = _prep_matrix(fitted[f], fitted[None], names, about, centred)
            inside, outside = m @ (whole - part) @ m.T, m @ part @ m.T
            for i in chosen:
                w = models.linear_from_products(name, points[i], inside)
                v = np.concatenate([-w[:-1], [1.0], -w[-1:]])
                errors[i].append(max(0.0, float(v @ outside @ v)) / outside[-1, -1])
    return [-float(np.mean(e)) for e in errors]


def _fitted_scores(
    name: str, points: Sequence[Mapping], train: DataFrame, label: str, fitted: Mapping[int | None, TablePrepModel], fold_col: str, scoring: str, parallelism: int
) -> list[float]:
    """The same for any model: one fit per fold and point, over rows prepared once per fold."""
    vector = fitted[None].getOrDefault(fitted[None].outputCol)
    judge = RegressionEvaluator(labelCol=label, metricName={"neg_mean_squared_error": "mse", "neg_mean_absolute_error": "mae"}[scoring])
    scores = np.zeros((len(fitted) - 1, len(points)))
    for row, f in enumerate(f for f in fitted if f is not None):
        made = fitted[f].transform(train).select(F.col(vector).alias("features"), label, (F.col(fold_col) == f).alias("held")).persist()
        try:
            inside, outside = made.where("NOT held"), made.where("held")
            with ThreadPoolExecutor(parallelism) as pool:
                scores[row] = list(pool.map(lambda p: -judge.evaluate(models.estimator(name, label, p).fit(inside).transform(outside)), points))
        finally:
            made.unpersist()
    return [float(s) for s in scores.mean(axis=0)]


def search(
    name: str, grid: Mapping[str, Sequence], train: DataFrame, label: str, prep: TablePrep, method: str = "grid", n_iter: int = 10, seed: int = 42,
    scoring: str = "neg_mean_squared_error", fold_col: str = "fold", parallelism: int = 4, max_levels: int | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """As ``models.search``, with the preparation refitted in every fold: (preparation and best model, both fitted on all rows; cv table).

    ``train`` holds raw columns and the fold column (``models.with_folds``). Its used columns are kept while the search runs, so the source
    is read once. Levels that a fold's training rows lack give zeros in its held-out rows. NULL or NaN in the label or in a
    column passed through is refused.
    """
    points = models.param_grid(grid) if method == "grid" else models.sampled_grid(grid, n_iter, seed)
    num, cat, rest = (prep.getOrDefault(p) for p in (prep.numeric, prep.categorical, prep.passthrough))
    used = train.select(*[_number(c).alias(c) for c in num], *cat, *rest, label, fold_col).persist()
    try:
        models.require_complete(used, [*rest, label])
        fitted = fit_folds(used, prep, fold_col, max_levels)
        if name in models.LINEAR and scoring == "neg_mean_squared_error":
            scores = _linear_scores(name, points, used, label, fitted, fold_col)
        else:
            scores = _fitted_scores(name, points, used, label, fitted, fold_col, scoring, parallelism)
        vector = prep.getOrDefault(prep.outputCol)
        best = models.estimator(name, label, points[models._first_best(scores)])
        made = fitted[None].transform(used).select(F.col(vector).alias("features"), label)
        final = best.fit(made)
    finally:
        used.unpersist()
    if vector != "features":
        final = final.copy().setFeaturesCol(vector)
    return PipelineModel(stages=[fitted[None], final]), models._cv_table(train, points, scores)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the features of a model that ``search`` gave, in the order of its coefficients."""
    return model.stages[0].feature_names()
